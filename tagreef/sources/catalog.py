"""The Parquet catalog ``(path, features, binary)``: append-only, no key."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tagreef.functions.images import data_uri
from tagreef.functions.text import upload_tag
from tagreef.schema import CATALOG, UPLOADS
from tagreef.sources.commits import (
    commit,
    committed,
    listing,
    read_committed,
    repeatable,
    replaced,
    table_root,
    write_committed,
)

ERROR = StructField("error", StringType())

#: Files of less are packed together.
SMALL_FILE = 64 << 20


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Scan a catalog: plain files, and of stream batches what is committed."""
    return read_committed(spark, path, CATALOG)


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """``(path, error)`` of the catalog rows whose text could not be read."""
    rows = read_committed(spark, path, StructType([CATALOG["path"], ERROR]))
    return rows.filter(F.col("error").isNotNull())


def _stored_columns(rows: DataFrame) -> DataFrame:
    """Catalog columns, and ``error`` where there is one: readers of the catalog skip it."""
    return rows.select(*CATALOG.names, *(["error"] if "error" in rows.columns else []))


def append_catalog(rows: DataFrame, path: str) -> None:
    _stored_columns(rows).write.mode("append").parquet(path)


def write_catalog_batch(rows: DataFrame, path: str, batch: str) -> str:
    """Commit one stream batch and return its folder; the same batch again replaces it.

    Readers see the rows of the one or of the other, never fewer. ``batch`` names the
    stream, the run of it and the number of the batch, see
    :func:`~tagreef.streaming.streams.batch_name`.
    """
    return write_committed(_stored_columns(rows), path, batch)


def compact_catalog(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite a catalog of many small files to a new folder, without a shuffle.

    A scan already packs small files into splits of
    ``spark.sql.files.maxPartitionBytes``, and each split becomes one file.
    """
    read_catalog(spark, path).write.mode("errorifexists").parquet(target)


def pack_catalog(spark: SparkSession, path: str, small: int = SMALL_FILE) -> int:
    """Pack the files of less than ``small`` bytes into larger ones, in place; returns how many.

    Other files stay as they are. The scan of the small ones packs them into splits,
    each of which becomes a file; nothing is shuffled. One commit then swaps the new
    files for the old, which stay on disk for readers that have begun. The last batch
    of each run of a stream is left alone, since it may be written again. The driver
    holds the names of the files, no more. One packing at a time.
    """
    if committed(spark, path) is None:
        commit(spark, path, "begin", [])
    found = committed(spark, path) or {}
    closed = [p for entry in found.keys() - repeatable(list(found)) for p in found[entry]]
    if not closed:
        return 0
    files = dict(tuple(row) for row in listing(spark, closed).collect())
    few = sorted(f for f, length in files.items() if length < small)
    if len(few) < 2:
        return 0
    target = f"packed-{uuid.uuid4().hex}"
    rows = spark.read.schema(StructType([*CATALOG.fields, ERROR])).parquet(*few)
    rows.write.parquet(f"{path}/{target}")
    root = table_root(spark, path)
    commit(spark, path, target, [f"+{target}", *replaced(root, closed, list(files), set(few))])
    return len(few)


def union_catalogs(*catalogs: DataFrame) -> DataFrame:
    """Bag union; a missing column reads as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), catalogs)


def to_catalog_rows(images: DataFrame, kind: str | None = None) -> DataFrame:
    """``(path, text, content)`` to catalog rows; ``kind`` overrides the type found."""
    uri = data_uri(F.col("content"), None if kind is None else F.lit(kind))
    return images.select(
        "path", upload_tag(F.col("text")).alias("features"), uri.alias("binary")
    )


def upload_rows(spark: SparkSession, uploads: list[tuple[str, bytes]]) -> DataFrame:
    """Uploads held in memory as a relation; a large lot belongs in a staging table."""
    return spark.createDataFrame(uploads, UPLOADS)
