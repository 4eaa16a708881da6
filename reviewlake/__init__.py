"""reviewlake: film box-office and audience-review analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from native
Spark expressions; nothing collects to the driver.

Layout
------
functions/   column expressions (text, dates, file names, tags, casts)
sources/     readers for landed files and tables, sinks, test-table adapters
operators/   unify, clean, metrics, keywords, box office, sentiment,
             incremental merges, candidate matching, skew-safe helpers
plans/       the registered queries and their DuckDB oracle SQL
streaming/   Structured Streaming versions of the daily increments
"""

from reviewlake.session import build_session, checkpoint_dir, cluster_settings

__all__ = ["build_session", "checkpoint_dir", "cluster_settings"]
