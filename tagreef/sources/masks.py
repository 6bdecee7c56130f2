"""Character masks beside a catalog: files that cannot hold a keyword are not read.

A tag's mask has a bit for each of its characters, 64 of them; a file's is the union
of its rows'. The masks are a small committed table of their own, in the catalog's
folder; a file that has none yet is always read. Masks tell most where files are
small, or sorted, or a keyword has characters that few tags hold.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tagreef.functions.keyword import cleaned, fixed_chars, pattern_of
from tagreef.schema import CATALOG
from tagreef.sources.catalog import read_catalog
from tagreef.sources.commits import plain_path, read_committed, write_committed

MASKS = StructType([StructField("file", StringType()), StructField("mask", LongType())])
FOLDER = "_masks"
BITS = 64


def char_mask(text: Column) -> Column:
    """The bits of a text's characters; 0 for none."""
    chars = F.array_distinct(F.split(F.coalesce(text, F.lit("")), ""))
    bit = lambda c: F.when(c == "", F.lit(0).cast("long")).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(c), F.lit(BITS)).cast("int"))
    )
    return F.aggregate(chars, F.lit(0).cast("long"), lambda mask, c: mask.bitwiseOR(bit(c)))


def catalog_files(catalog: DataFrame) -> list[str]:
    return sorted(plain_path(f) for f in catalog.inputFiles())


def read_masks(spark: SparkSession, path: str) -> DataFrame:
    return read_committed(spark, f"{path}/{FOLDER}", MASKS)


def write_masks(spark: SparkSession, path: str) -> int:
    """Add the masks of the catalog's files that have none; returns how many. Reads tags alone."""
    files = catalog_files(read_catalog(spark, path))
    known = {r[0] for r in read_masks(spark, path).select("file").collect()} if _has_masks(spark, path) else set()
    fresh = [f for f in files if f not in known]
    if fresh:
        rows = spark.read.schema(CATALOG).parquet(*fresh)
        masks = rows.groupBy(F.col("_metadata.file_path").alias("at")).agg(F.bit_or(char_mask(F.col("features"))).alias("mask"))
        # As the list of files has it: a file's name may hold escaped characters.
        named = F.regexp_replace(F.url_decode(F.replace("at", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
        write_committed(masks.select(named.alias("file"), "mask"), f"{path}/{FOLDER}", f"masks-{uuid.uuid4().hex}")
    return len(fresh)


def _has_masks(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def possible_rows(spark: SparkSession, path: str, keyword: str) -> DataFrame:
    """The catalog without the files whose mask lacks a character of the keyword.

    The driver holds names of files, as it does for any scan.
    """
    catalog = read_catalog(spark, path)
    if not _has_masks(spark, path):
        return catalog
    chars = "".join(fixed_chars(pattern_of(cleaned(keyword))))
    need = spark.range(1).select(char_mask(F.lit(chars))).first()[0]
    lacking = F.col("mask").bitwiseAND(F.lit(need)) != F.lit(need)
    without = {r[0] for r in read_masks(spark, path).filter(lacking).select("file").collect()}
    if not without:
        return catalog
    kept = [f for f in catalog_files(catalog) if f not in without]
    return spark.read.schema(CATALOG).parquet(*kept) if kept else spark.createDataFrame([], CATALOG)
