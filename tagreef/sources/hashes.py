"""Payload hashes kept beside a catalog, so that repeats are found without its images.

Hashes lie sorted in files with a Parquet Bloom filter each. Those of single stream
batches are small files of their own; :func:`write_hashes` and :func:`pack_hashes`
file them in a folder for each of 256 prefixes. A look-up reads the folders of asked
prefixes only; asked hashes are sent to the files, which are never shuffled.
"""

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tagreef.operators.sizes import broadcast_if_small
from tagreef.sources.commits import commit, committed, repeatable, replaced, table_root, write_committed

HASHES = StructType([StructField("payload_sha", StringType())])

#: Hex digits of a prefix.
PREFIX = 2
#: Most hashes of a file.
FILE_ROWS = 4_000_000
#: So many asked hashes are literals that a file's Bloom filter answers.
LITERALS = 32


def _filtered(rows: int = FILE_ROWS) -> dict[str, str]:
    column = "payload_sha"
    return {
        f"parquet.bloom.filter.enabled#{column}": "true",
        f"parquet.bloom.filter.expected.ndv#{column}": str(max(rows, 1)),
        "maxRecordsPerFile": str(FILE_ROWS),
    }


def _filed(hashes: DataFrame, path: str, target: str) -> list[str]:
    """Write hashes by prefix; returns the folders, as commit lines."""
    prefixed = hashes.dropna().distinct().withColumn("prefix", F.substring("payload_sha", 1, PREFIX))
    # A prefix is a range of hashes: ranges of equal size, each cut where a prefix ends.
    dealt = prefixed.repartitionByRange("payload_sha").sortWithinPartitions("payload_sha")
    dealt.write.partitionBy("prefix").options(**_filtered()).parquet(f"{path}/{target}")
    digits = [f"{k:0{PREFIX}x}" for k in range(16**PREFIX)]
    held = {r[0] for r in prefixed.select("prefix").distinct().collect()}
    return [f"+{target}/prefix={d}" for d in digits if d in held]


def write_hashes(hashes: DataFrame, path: str) -> None:
    """Add the hashes ``(payload_sha)`` of a whole catalog to an index, by prefix; nulls are left out."""
    target = f"filed-{uuid.uuid4().hex}"
    commit(hashes.sparkSession, path, target, _filed(hashes, path, target))


def write_hash_batch(hashes: DataFrame, path: str, entry: str) -> None:
    """Commit the hashes of one stream batch; written again they replace the first."""
    fresh = hashes.select("payload_sha").dropna().sort("payload_sha")
    write_committed(fresh, path, entry, **_filtered(FILE_ROWS // 16))


def _places(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """By commit the places of an index; of one without commits its folder, if there is any."""
    found = committed(spark, path)
    return {"": [path]} if found is None else found


def _read(spark: SparkSession, places: list[str]) -> DataFrame:
    if not places:
        return spark.createDataFrame([], HASHES)
    return spark.read.schema(HASHES).option("recursiveFileLookup", "true").parquet(*places)


def read_hashes(spark: SparkSession, path: str) -> DataFrame:
    """All hashes of an index."""
    return _read(spark, [p for places in _places(spark, path).values() for p in places])


@dataclass
class HashIndex:
    """An index of stored hashes; the commit ``without`` is not looked at."""

    spark: SparkSession
    path: str
    without: str = ""

    def asked_places(self, prefixes: set[str]) -> list[str]:
        """Folders and files that may hold a hash with one of the prefixes."""
        found = _places(self.spark, self.path)
        kept = [p for entry, places in found.items() if not (self.without and entry.endswith("/" + self.without)) for p in places]
        return [p for p in kept if "/prefix=" not in p or p.rpartition("/prefix=")[2][:PREFIX] in prefixes]

    def among(self, shas: DataFrame) -> DataFrame:
        """Those of the distinct hashes ``(payload_sha)`` that the index holds.

        At most 256 prefixes and ``LITERALS`` hashes reach the driver. The asked
        hashes are broadcast to the index behind a size check.
        """
        prefixes = {r[0] for r in shas.select(F.substring("payload_sha", 1, PREFIX)).distinct().collect()}
        index = _read(self.spark, self.asked_places(prefixes))
        few = [r[0] for r in shas.limit(LITERALS + 1).collect()]
        if len(few) <= LITERALS:
            index = index.filter(_any_of(F.col("payload_sha"), few))
        return index.join(broadcast_if_small(shas), "payload_sha", "left_semi").distinct()


def _any_of(column: Column, values: list[str]) -> Column:
    """Equalities rather than a list: a scan looks each up in a file's Bloom filter."""
    return reduce(lambda a, b: a | b, [column == v for v in values], F.lit(False))


def pack_hashes(spark: SparkSession, path: str) -> int:
    """File the hashes of past batches by prefix, in one commit; returns how many places went.

    The last batch of each run of a stream stays, since it may be written again, and so
    do hashes that are filed already. One packing at a time.
    """
    found = committed(spark, path)
    if found is None:
        commit(spark, path, "begin", [])
        found = committed(spark, path) or {}
    loose = [p for e in found.keys() - repeatable(list(found)) for p in found[e] if "/prefix=" not in p]
    if loose:
        target = f"filed-{uuid.uuid4().hex}"
        lines = _filed(_read(spark, loose), path, target)
        commit(spark, path, target, lines + replaced(table_root(spark, path), loose, loose, set(loose)))
    return len(loose)
