from churnlens.streaming.activity import (event_stream, latest_profiles, live_activity_profile,
                                          run_profile_changelog)

__all__ = ["event_stream", "live_activity_profile", "run_profile_changelog", "latest_profiles"]
