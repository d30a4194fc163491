"""Declared parameters of the churn analysis.

The reference hard-codes GitHub event types, two five-month periods of a year
and an outlier limit.  Here they are one immutable spec, with defaults mapped
onto the driver tables (see FIXTURES.md part 2).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class ChurnSpec:
    # Event types counted per user; each yields a column ``<type>_count``.
    event_types: tuple[str, ...] = ("click", "view", "purchase", "signup", "error")
    # Half-open periods [start, end): first = observation, second = outcome.
    first_period: tuple[dt.datetime, dt.datetime] = (
        dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 16))
    second_period: tuple[dt.datetime, dt.datetime] = (
        dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 17))
    # Users with this many events or more in either period are outliers.
    outlier_limit: int = 40
    # Event types that are not public (stand-in for the archive's flag).
    private_types: tuple[str, ...] = ("error",)
    # Profile count columns that are log-scaled with the event counts.
    scale_columns: tuple[str, ...] = (
        "followers_count", "following_count", "public_repos_count",
        "public_gists_count", "frequency")
    # Event types whose counts are binarised instead of log-scaled.
    binarised_types: tuple[str, ...] = ("signup", "error")
    # Event types treated as passive for the K-means activity feature.
    passive_types: tuple[str, ...] = ("view", "error")
    # Rare event types left out of the model features entirely.
    dropped_types: tuple[str, ...] = ()
    # What-if roles -> event types: "watch", "fork", "comment" (SURVEY B5).
    whatif_types: tuple[tuple[str, str], ...] = (("watch", "click"), ("fork", "purchase"),
                                                 ("comment", "view"))
    # Lifetime model: end of the study and the prediction horizon in weeks.
    lifetime_end: dt.datetime = dt.datetime(2024, 1, 16)
    horizon_weeks: float = 22.0
    seed: int = 1
    # Date-typed partition column of the event log, if it is laid out by day
    # (period filters then also prune whole partitions).
    partition_column: str | None = None
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def count_columns(self) -> list[str]:
        return [f"{t}_count" for t in self.event_types]

    def whatif_column(self, role: str) -> str:
        return f"{dict(self.whatif_types)[role]}_count"

    @classmethod
    def for_year(cls, year: int, **overrides) -> "ChurnSpec":
        """The yearly convention for the GitHub event archive.

        Fixed values: first period Jan 1 to Jun 1, second period Jun 2 to Nov 1
        of ``year``, last days included (periods here are half-open); outlier
        limit 200 events for 2016 and 600 for other years; the 14 counted event
        types below (columns ``PushEvent_count`` and so on).
        """
        fields = dict(
            event_types=GITHUB_EVENT_TYPES,
            first_period=(dt.datetime(year, 1, 1), dt.datetime(year, 6, 2)),
            second_period=(dt.datetime(year, 6, 2), dt.datetime(year, 11, 2)),
            outlier_limit=200 if year == 2016 else 600,
            private_types=(),
            binarised_types=("PublicEvent", "ReleaseEvent"),
            passive_types=("DeleteEvent", "GollumEvent", "IssueCommentEvent", "MemberEvent", "WatchEvent"),
            dropped_types=("GollumEvent", "CommitCommentEvent", "MemberEvent"),
            whatif_types=(("watch", "WatchEvent"), ("fork", "ForkEvent"), ("comment", "IssueCommentEvent")),
            lifetime_end=dt.datetime(year, 6, 1, 23, 59, 59),
        )
        fields.update(overrides)
        return cls(**fields)


# The GitHub event types counted per user.
GITHUB_EVENT_TYPES = (
    "CommitCommentEvent", "CreateEvent", "DeleteEvent", "ForkEvent", "GollumEvent", "IssueCommentEvent",
    "IssuesEvent", "MemberEvent", "PublicEvent", "PullRequestEvent", "PullRequestReviewCommentEvent",
    "PushEvent", "ReleaseEvent", "WatchEvent")


DEFAULT_SPEC = ChurnSpec()
