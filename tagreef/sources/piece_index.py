"""An inverted index of payload pieces, kept beside a catalog of images.

A text's pieces are cut by its content, so that each piece of a payload is a piece of
every text around it. The index has a row for each piece and image, as two 64-bit
hashes; only pieces of a sixteenth of all hashes are kept, a few for each kilobyte of
image. A payload is looked up by its rarest piece; what the index proposes is read
from the catalog in one scan and compared in full, however many payloads there are.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tagreef.operators.sizes import broadcast_if_small
from tagreef.shared import saved
from tagreef.sources.commits import read_committed, write_committed

PIECES = StructType([StructField("piece", LongType()), StructField("image", LongType())])

# Content-defined pieces: those that start with one of a few characters that are
# neither rare nor common in base64 and in prose. Any choice gives right results; it
# only sets how many pieces a text has.
PIECE_STARTS = "[bkv]"
PIECE_LENGTH = 24
#: One hash of so many is kept in the index.
KEPT = 16
#: A payload is filed under the rarest of so many of its pieces.
DRAWN = 8


def pieces_of(text: Column) -> Column:
    """Distinct pieces of a text, overlapping ones too (the regex is a look-ahead)."""
    regex = rf"(?s)(?=({PIECE_STARTS}.{{{PIECE_LENGTH - 1}}}))"
    return F.array_distinct(F.regexp_extract_all(text, F.lit(regex), F.lit(1)))


def kept_hashes(text: Column) -> Column:
    """Hashes of a text's pieces that the index keeps, distinct and in order."""
    hashed = F.transform(pieces_of(text), lambda p: F.xxhash64(p))
    return F.array_sort(F.array_distinct(F.filter(hashed, lambda h: F.pmod(h, F.lit(KEPT)) == 0)))


def image_key(key: Column) -> Column:
    """How the index names an image: images of one key, or hash, are proposed together."""
    return F.xxhash64(F.coalesce(key.cast("string"), F.lit("")))


def index_pieces(catalog: DataFrame, text: str = "binary", key: str = "path") -> DataFrame:
    """The ``(piece, image)`` rows of a catalog's texts; a null text has none."""
    found = catalog.select(F.explode(kept_hashes(F.col(text))).alias("piece"), image_key(F.col(key)).alias("image"))
    return found.distinct()


def write_pieces(catalog: DataFrame, path: str, entry: str | None = None, text: str = "binary", key: str = "path") -> None:
    """Add a catalog, or one committed batch of it, to the index at ``path``.

    Rows lie by ranges of the piece, so that a file holds a range. A batch written
    again replaces its rows.
    """
    rows = index_pieces(catalog, text, key).repartitionByRange("piece").sortWithinPartitions("piece")
    write_committed(rows, path, entry or f"pieces-{uuid.uuid4().hex}")


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    return read_committed(spark, path, PIECES)


def containing_images(
    catalog: DataFrame, pieces: DataFrame, payloads: DataFrame, text: str = "binary", key: str = "path"
) -> tuple[DataFrame, DataFrame]:
    """Rows of a catalog that contain a payload, by its index, and the payloads that the index cannot tell.

    The first frame is the catalog's columns, ``payload`` and ``needle_id``, the
    payload's SHA-256. The second has the ``payload`` of those without a kept piece:
    short ones, for which the catalog itself must be asked. Null payloads are in
    neither. Payloads, pieces and the proposed images meet on hashes; images are read
    once, and moved only if more are proposed than can be broadcast.
    """
    needles = payloads.select("payload").dropna().distinct()
    needles = saved(
        needles.select(F.sha2("payload", 256).alias("needle_id"), "payload", F.slice(kept_hashes(F.col("payload")), 1, DRAWN).alias("drawn"))
    )
    asked = needles.select("needle_id", F.explode("drawn").alias("piece"))
    held = pieces.join(broadcast_if_small(asked.select("piece").distinct()), "piece", "left_semi")
    held = saved(held)
    counts = held.groupBy("piece").agg(F.count("*").alias("n"))
    # A piece that no image holds rules its payload out.
    filed = asked.join(counts, "piece", "left").groupBy("needle_id")
    filed = filed.agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("best"))
    filed = filed.filter("best.n > 0").select("needle_id", F.col("best.piece").alias("piece"))
    proposed = saved(filed.join(held, "piece").select("needle_id", "image"))
    named = proposed.join(needles.select("needle_id", "payload"), "needle_id")
    found = catalog.withColumn("image", image_key(F.col(key))).join(broadcast_if_small(named), "image")
    found = found.filter(F.contains(F.col(text), F.col("payload"))).drop("image")
    return found, needles.filter(F.size("drawn") == 0).select("payload")
