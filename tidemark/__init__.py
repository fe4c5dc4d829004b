"""tidemark: period-level text analytics and period classifiers on Spark DataFrames.

Posts (short texts tagged with a group ``match_id`` and a time slice
``period_id``) are cleaned with Column expressions and joins, turned into
features, aggregated to one row per period and scored with pyspark.ml.
"""

from tidemark.session import checkpoint_dir, get_session, release

__all__ = ["get_session", "checkpoint_dir", "release"]
