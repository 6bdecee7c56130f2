"""The account table as a snapshot in buckets of names.

A batch of sign-ups and profile changes reads and rewrites only the buckets of the
names it asks for. The new buckets take the place of the old ones in one commit, so
that a reader sees the accounts before a batch or after it; older files stay for
readers that have begun. One batch at a time.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagreef.operators.accounts import apply_profile_patches, apply_signups
from tagreef.schema import ACCOUNTS
from tagreef.sources.commits import commit, committed, table_root

BUCKETS = 256


def bucket_of(name: Column, buckets: int) -> Column:
    """The folder of a name: its bucket and how many there are."""
    number = F.pmod(F.xxhash64(F.coalesce(name, F.lit(""))), F.lit(buckets))
    return F.concat(number.cast("string"), F.lit(f"-of-{buckets}"))


def _write(accounts: DataFrame, path: str, buckets: int) -> list[str]:
    """Write accounts in buckets; returns the folders, as commit lines."""
    spark, target = accounts.sparkSession, f"version-{uuid.uuid4().hex}"
    rows = accounts.select(*ACCOUNTS.names).withColumn("bucket", bucket_of(F.col("username"), buckets))
    rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/{target}")
    written = spark.read.parquet(f"{path}/{target}").select("bucket").distinct() if not rows.isEmpty() else rows.select("bucket")
    return [f"+{target}/bucket={r[0]}" for r in sorted(written.collect())]


def write_accounts(accounts: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Begin a snapshot: all accounts, in buckets of their names."""
    commit(accounts.sparkSession, path, f"buckets-{buckets}", _write(accounts, path, buckets))


def _places(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """Folders in force and the number of buckets."""
    found = committed(spark, path) or {}
    buckets = [e.rpartition("/buckets-")[2] for e in found if "/buckets-" in e]
    entries = [p for places in found.values() for p in places]
    return entries, int(buckets[0]) if buckets else BUCKETS


def _read(spark: SparkSession, places: list[str]) -> DataFrame:
    if not places:
        return spark.createDataFrame([], ACCOUNTS)
    return spark.read.schema(ACCOUNTS).option("recursiveFileLookup", "true").parquet(*places)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """All accounts of a snapshot."""
    return _read(spark, _places(spark, path)[0])


def store_account_batch(spark: SparkSession, path: str, signups: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply sign-ups, then profile changes, to a snapshot; returns outcomes and unknown changes.

    The touched buckets' numbers reach the driver. Of other buckets the ids alone are
    read, for the greatest.
    """
    places, buckets = _places(spark, path)
    names = signups.select(F.lower("username").alias("username")).unionByName(patches.select("username"))
    touched = {r[0] for r in names.select(bucket_of(F.col("username"), buckets)).distinct().collect()}
    old = [p for p in places if p.rpartition("/bucket=")[2] in touched]
    last_id = _read(spark, places).agg(F.max("id")).first()[0] or 0
    grown, outcomes = apply_signups(_read(spark, old), signups, last_id)
    patched, unknown = apply_profile_patches(grown, patches)
    lines = _write(patched, path, buckets)
    root = table_root(spark, path)
    commit(spark, path, f"batch/{uuid.uuid4().hex}", lines + ["-" + p.removeprefix(root) for p in old])
    return outcomes, unknown
