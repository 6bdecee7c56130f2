"""Checked sizes: nothing is broadcast on trust."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES = 64


def table_bytes(table: DataFrame) -> int:
    """Size of a table's rows in memory, about; one aggregate row reaches the driver."""
    size = F.lit(ROW_BYTES)
    for name, kind in table.dtypes:
        if kind.startswith(("struct", "array", "map")):
            size = size + F.coalesce(F.octet_length(F.to_json(name)), F.lit(0))
        elif kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
    return table.agg(F.sum(size.cast("long"))).first()[0] or 0


def broadcast_if_small(table: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a table for broadcast when it is small; else leave the join to Spark."""
    return F.broadcast(table) if table_bytes(table) <= limit else table


def spread(scan: DataFrame) -> DataFrame:
    """Spread a scan of fewer splits than cores over the cores, before dear row work.

    A table of any size has more splits than cores and is left as it is. Only for
    plain scans: the splits of other plans are not known before they run.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
