"""Stored intermediates and counts that the operators share."""

import gc
from collections.abc import Callable
from typing import TypeVar

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagreef.shared import scratch_path

#: Text of one block of documents: what one task holds at a time.
BLOCK_BYTES = 8 << 20


Value = TypeVar("Value")


def sent(spark: SparkSession, value: Value) -> Callable[[], Value]:
    """A broadcast of an object of this package's own classes.

    Broadcasts name classes, which the workers would have to import; here the bytes
    of the object hold its class, so that workers need no copy of the package. The
    returned function loads it: call it once per task.
    """
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(held.value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame's rows, written to the shared folder and read again.

    Cuts the lineage, so that a lost executor costs no more than its running
    tasks. The shuffle files behind the rows are of no use any more; a garbage
    collection on the driver lets Spark remove them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    schema = df.schema
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def block_count(docs: DataFrame, text: str = "text", size: int = BLOCK_BYTES) -> int:
    """Blocks of about ``size`` bytes of text, no fewer than shuffle partitions."""
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // size))


def block_of(doc_id: str | Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(blocks)).cast("int")


def own_names(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The frame under names that no operator adds, and what gives its columns their names back.

    For operators whose added columns must not replace columns of the input.
    """
    names = docs.columns
    places = [f"_{k}" for k in range(len(names))]
    return docs.toDF(*places), lambda out: out.select(*places).toDF(*names)


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; 0 for a null id."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return (F.crc32(F.encode(text, "UTF-8")) % parts).cast("int")
