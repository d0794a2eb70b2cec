"""tidemark: batch-quality, training-decision and inference analytics on Spark.

Every rule runs as DataFrame / SQL / Spark ML / Structured Streaming work over a
table of *all* batches, segments and model lines at once.
"""

from tidemark.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
