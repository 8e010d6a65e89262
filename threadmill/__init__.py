"""threadmill: forum ETL operators expressed as Spark DataFrame plans.

Sub-packages
------------
functions  column -> column building blocks (parsing, cleaning, tokenising)
operators  DataFrame -> DataFrame operators (word count, dedupe, upsert, ...)
sources    readers, writers, watermarks and versioned table state
plans      end-to-end compositions, HTML record jobs, the query catalogue
streaming  Structured Streaming ingestion with per-batch upserts
"""

from threadmill.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
