from tidemark.operators.audit import audit_record, job_watermark, latest_run, watermark  # noqa: F401
from tidemark.operators.dedup import dedup_by_key, dedup_latest, distinct_rows, dup_count  # noqa: F401
from tidemark.operators.flatten import explode_records, flatten_structs  # noqa: F401
from tidemark.operators.merge import (  # noqa: F401
    anti_by_keys,
    existing_partitions,
    merge_dedup,
    merge_insert_only,
    merge_union,
    touched_partitions,
)
from tidemark.operators.nest import attach_children, nest_children  # noqa: F401
