"""tidemark: incremental nested-log ETL expressed as Spark DataFrame plans.

Main entry points::

    from tidemark import transform, run_etl, upsert_partitions
    from tidemark.operators import flatten_structs, explode_records, dedup_latest
    from tidemark.functions import conform, cast_rejects, path_date
"""

__version__ = "0.1.0"

__all__ = ["transform", "run_etl", "upsert_partitions", "__version__"]


def __getattr__(name):  # lazy: importing the package does not need pyspark yet
    if name == "transform":
        from tidemark.plans.transform import transform

        return transform
    if name in ("run_etl", "upsert_partitions"):
        from tidemark.plans import etl

        return getattr(etl, name)
    raise AttributeError(name)
