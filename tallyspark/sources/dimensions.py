"""Account dimensions stored bucketed by ``oidaccount``.

Every daily run joins the log-side rows with ``rds_footprint`` and
``rds_staticaccount`` on ``oidaccount``. Plain tables are shuffled on that
key in every run; tables bucketed (and sorted) by it are read already
partitioned, so the sort-merge joins shuffle only the (pre-aggregated) log
side. Re-bucket when the dimensions change, not per run.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from tallyspark.sources.inputs import Inputs

KEY = "oidaccount"


def write_bucketed(df: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Save ``df`` as catalog table ``table`` bucketed and sorted by the
    account id (``path``: a shared folder for the files) and return it."""
    writer = df.write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def with_bucketed_dimensions(inputs: Inputs, buckets: int, database: str = "default",
                             root: str | None = None) -> Inputs:
    """Inputs whose two dimensions are bucketed catalog tables."""
    def path(name):
        return f"{root.rstrip('/')}/{name}" if root else None
    return replace(
        inputs,
        footprint=write_bucketed(inputs.footprint, f"{database}.rds_footprint_by_account", buckets,
                                 path("rds_footprint_by_account")),
        staticaccount=write_bucketed(inputs.staticaccount, f"{database}.rds_staticaccount_by_account", buckets,
                                     path("rds_staticaccount_by_account")))
