"""txnguard: fraud-transaction analytics on Spark.

Batch views, ingest validation, profiling, joins, Spark ML training and
scoring, Structured Streaming and serving, all as DataFrame / Spark SQL /
Spark ML / Structured Streaming jobs. Start with ``txnguard.session.get_spark``,
the operators in ``txnguard.operators`` and the services in ``txnguard.jobs``.
"""

from .session import ensure_checkpoint_dir, get_spark, scratch_path  # noqa: F401

__all__ = ["get_spark", "ensure_checkpoint_dir", "scratch_path"]
