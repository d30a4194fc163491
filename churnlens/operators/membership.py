"""Membership tests.

The reference builds an OR chain of quoted names into SQL text (B10).  Here
a user list is a DataFrame and membership is a ``left_semi`` join; an empty
list gives an empty result and no text is ever spliced.  Whether a key list
is broadcast is left to its measured size (AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def members_only(events: DataFrame, users: DataFrame, event_key: str = "actor",
                 user_key: str = "login", public_only: bool = True) -> DataFrame:
    """events of users in ``users`` (public ones by default)."""
    keys = users.select(F.col(user_key).alias("__k")).distinct()
    ev = events.where(F.col("public")) if public_only else events
    return ev.join(keys, ev[event_key] == keys["__k"], "left_semi")


def not_yet_known(candidates: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is not in ``known``.

    ``known`` is reduced to its distinct keys first (partial aggregation
    before the shuffle), so a key repeated in a third of the rows of
    ``known`` travels once per map task.
    """
    return candidates.join(known.select(key).distinct(), key, "left_anti")
