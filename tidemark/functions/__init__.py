from tidemark.functions.casts import cast_rejects, cast_to, conform, resolve_columns  # noqa: F401
from tidemark.functions.ids import content_id, random_id, run_stamp  # noqa: F401
from tidemark.functions.paths import (  # noqa: F401
    partition_key,
    path_date,
    path_hour,
    trailing_days_on_date,
    trailing_days_on_timestamp,
)
