from churnlens.sources.tables import (
    SCHEMAS, read_table, event_log, user_profiles, repo_contributors,
    read_csv, write_csv, write_parquet, read_parquet,
)

__all__ = ["SCHEMAS", "read_table", "event_log", "user_profiles", "repo_contributors",
           "read_csv", "write_csv", "write_parquet", "read_parquet"]
