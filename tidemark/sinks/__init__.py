from tidemark.sinks.audit import append_audit, read_audit  # noqa: F401
from tidemark.sinks.parquet import staged, write_partitioned  # noqa: F401
