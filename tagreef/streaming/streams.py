"""Line, upload and request streams in fixed micro-batches.

Each batch is written under the name of its stream, the id that the stream's
checkpoint holds, and its number, and then committed. Writing it again replaces it
in one step, so a batch replayed after a failure adds no row twice and hides none
meanwhile; another stream, or the same one begun anew with another checkpoint, never
touches it.
"""

import json
import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tagreef.functions.images import UPLOAD_EXTENSIONS
from tagreef.operators.extract import TextReader
from tagreef.operators.repeats import payload_hashes
from tagreef.operators.search import request_sizes, search_batch
from tagreef.plans.jobs import ingest_uploads
from tagreef.sources.catalog import read_catalog, write_catalog_batch
from tagreef.sources.commits import read_committed, write_committed
from tagreef.sources.hashes import HashIndex, write_hash_batch

# Batch length and the path of rows that came as lines.
BATCH_SECONDS = 5
STREAM_PATH = "fromStreaming"

LINES = StructType([StructField("value", StringType())])


def line_stream(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """Text lines ``(value)`` from ``socket`` (host, port) or ``text`` (path)."""
    return spark.readStream.format(source).options(**options).load().select("value")


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = False,
    seconds: int = BATCH_SECONDS,
) -> StreamingQuery:
    """Start ``handle`` on every batch; ``once`` ends after the data there is."""
    trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_run(spark: SparkSession, name: str, checkpoint: str) -> str:
    """``name-<id>``: a stream and the run of it that a checkpoint belongs to.

    Spark writes the id when it makes the checkpoint, before the first batch, and
    keeps it over restarts.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", name):
        raise ValueError(f"a stream name is made of letters, digits, '.', '_' and '-': {name!r}")
    held = spark.read.text(f"{checkpoint}/metadata").first()[0]
    return f"{name}-{json.loads(held)['id']}"


def batch_name(spark: SparkSession, name: str, checkpoint: str, batch_id: int) -> str:
    """Folder of one batch of a run of a stream."""
    return f"{stream_run(spark, name, checkpoint)}/batch-{batch_id:012d}"


def save_batches_as_text(
    lines: DataFrame,
    prefix: str,
    name: str,
    checkpoint: str,
    once: bool = False,
    start_ms: int = 0,
    seconds: int = BATCH_SECONDS,
) -> StreamingQuery:
    """Each batch to a committed text folder ``prefix-<ms>/<name>-<id>``.

    ``ms`` is ``start_ms`` plus the batch number times the batch length. It does
    not read the clock, so a replayed batch finds its old folder. Read them with
    :func:`read_batches_of_text`.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        run = stream_run(batch.sparkSession, name, checkpoint)
        folder = f"{prefix}-{start_ms + batch_id * seconds * 1000}"
        write_committed(batch.select("value"), folder, run, "text")

    return run_batches(lines, save, checkpoint, once, seconds)


def read_batches_of_text(spark: SparkSession, prefix: str) -> DataFrame:
    """The lines of all batches of all streams under a prefix."""
    return read_committed(spark, f"{prefix}-*", LINES, "text")


def preview(
    lines: DataFrame, checkpoint: str, n: int = 10, once: bool = False, show: Callable[[str], None] = print
) -> StreamingQuery:
    """Show the first ``n`` lines of each batch, by printing them."""

    def head(batch: DataFrame, batch_id: int) -> None:
        for row in batch.select("value").limit(n).collect():
            show(row["value"])

    return run_batches(lines, head, checkpoint, once)


def _catalog_columns() -> list[Column]:
    return [
        F.lit(STREAM_PATH).alias("path"),
        F.lit(None).cast("string").alias("features"),
        F.col("value").alias("binary"),
    ]


def line_rows(lines: DataFrame) -> DataFrame:
    """Lines as catalog rows, one each; they have no tag and are never found."""
    return lines.select(*_catalog_columns())


def ingest_lines(
    lines: DataFrame,
    catalog_path: str,
    name: str,
    checkpoint: str,
    once: bool = False,
    seconds: int = BATCH_SECONDS,
) -> StreamingQuery:
    """Append every line to a catalog."""

    def append(batch: DataFrame, batch_id: int) -> None:
        folder = batch_name(batch.sparkSession, name, checkpoint, batch_id)
        write_catalog_batch(line_rows(batch), catalog_path, folder)

    return run_batches(lines, append, checkpoint, once, seconds)


def ingest_upload_stream(
    uploads: DataFrame,
    catalog_path: str,
    refused_path: str,
    name: str,
    checkpoint: str,
    reader: Callable[[], TextReader],
    hashes_path: str | None = None,
    allowed: Iterable[str] = UPLOAD_EXTENSIONS,
    once: bool = False,
) -> StreamingQuery:
    """Uploads into a catalog as they come, refusals beside it.

    With ``hashes_path``, images whose hash is kept there are left out, and every
    batch adds the hashes of its own: a batch never reads the catalog's images, and
    of the hashes only files that may hold one of its own. See
    :mod:`tagreef.sources.hashes`; ``write_hashes`` there makes the first hashes of a
    catalog that has rows, ``pack_hashes`` files those of past batches by prefix. A
    replayed batch does not look at its own earlier hashes, or it would take every
    image for a repeat; the hashes are written from the rows that the catalog got.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = batch_name(spark, name, checkpoint, batch_id)
        seen = None
        if hashes_path is not None:
            seen = HashIndex(spark, hashes_path, without=folder)
        rows, refused = ingest_uploads(batch, reader, seen, allowed)
        written = write_catalog_batch(rows, catalog_path, folder)
        if hashes_path is not None:
            write_hash_batch(payload_hashes(read_catalog(spark, written)), hashes_path, folder)
        refused.write.mode("overwrite").parquet(f"{refused_path}/{folder}")

    return run_batches(uploads, ingest, checkpoint, once)


def search_stream(
    requests: DataFrame,
    catalog_path: str,
    target: str,
    name: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Answer requests as they come, on the catalog as it is at each batch.

    A batch writes the hits of its distinct keywords, ``(keyword, path)``, to
    ``target/hits`` and its requests with their result sizes to
    ``target/requests``. Images are not copied: a hit's image is in the catalog.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = batch_name(spark, name, checkpoint, batch_id)
        hits_path = f"{target}/hits/{folder}"
        hits = search_batch(read_catalog(spark, catalog_path), batch, "path").select("keyword", "path")
        hits.write.mode("overwrite").parquet(hits_path)
        written = spark.read.schema(hits.schema).parquet(hits_path)
        sizes = request_sizes(batch, written)
        sizes.write.mode("overwrite").parquet(f"{target}/requests/{folder}")

    return run_batches(requests, answer, checkpoint, once)


def batch_rows(lines: DataFrame, seconds: int = BATCH_SECONDS) -> DataFrame:
    """Stored lines ``(value, ts)`` as catalog rows with the ``batch`` they came in.

    A batch has the time of its end. A line that came on a batch border belongs
    to the batch that starts there.
    """
    end = F.window("ts", f"{seconds} seconds")["end"].alias("batch")
    return lines.select(end, *_catalog_columns())


def slice_batches(df: DataFrame, t0: str, t1: str, seconds: int = BATCH_SECONDS) -> DataFrame:
    """Rows of the batches from ``t0`` to ``t1``, with their ``batch``.

    Both times are taken down to a whole batch and both batches are included. A
    batch covers ``[end - seconds, end)``; the older stream interval was open at
    its start. The bounds are plain limits on ``ts``, so they reach the scan.
    """
    length = F.expr(f"INTERVAL {seconds} SECONDS")

    def floor(time: str) -> Column:
        whole = F.floor(F.unix_timestamp(F.lit(time).cast("timestamp")) / seconds) * seconds
        return F.timestamp_seconds(whole).cast(df.schema["ts"].dataType)

    within = (F.col("ts") >= floor(t0) - length) & (F.col("ts") < floor(t1))
    end = F.window("ts", f"{seconds} seconds")["end"]
    return df.filter(within).withColumn("batch", end)
