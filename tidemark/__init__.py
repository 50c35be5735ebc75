"""tidemark: change-data and incremental-load pipelines on PySpark.

Every operator is a function from DataFrames to DataFrames (or a small
job that writes a table and returns a DataFrame over it). Nothing in the
library collects data rows to the driver except bounded values: a
bookmark high-water mark, touched bucket ids and per-partition counts.
"""

from tidemark.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
