from tidemark.sources.files import discover, file_inventory, incremental_files, window_globs  # noqa: F401
from tidemark.sources.nested import read_nested  # noqa: F401
