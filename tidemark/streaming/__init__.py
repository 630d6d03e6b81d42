from tidemark.streaming.dedup import stream_dedup, write_stream_files  # noqa: F401
from tidemark.streaming.ingest import file_stream, stream_ingest  # noqa: F401
