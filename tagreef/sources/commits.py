"""Committed writes: a reader sees what a batch held before or what it holds now.

A batch is written to a folder of its own, one for each attempt, and then named by
a small file in the table's list of commits, put there in one step. Readers follow
the list; a batch written again replaces its commit, and attempts that never were
committed are never read. Files that stand beside the list, as plain appends leave
them, are part of the table too.

A commit file has a line for each folder or file, ``+`` and its path in the table;
``-`` takes one away that another commit or a plain append brought.
"""

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS = "_commits"


def _folder(spark: SparkSession, path: str):
    """The file system of a path and the path, in Hadoop's own terms."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(found)


def commit(spark: SparkSession, path: str, entry: str, lines: list[str]) -> None:
    """Put a commit in place, whole or not at all; an earlier one of that name goes."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    _, target = _folder(spark, f"{path}/{COMMITS}/{entry}")
    system, written = _folder(spark, f"{path}/{COMMITS}/.{uuid.uuid4().hex}")
    out = system.create(written)
    out.write("".join(line + "\n" for line in lines).encode())
    out.close()
    system.mkdirs(target.getParent())
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(written, target, how)


def write_committed(rows: DataFrame, path: str, entry: str, form: str = "parquet", **options: str) -> str:
    """Write one batch of a table and commit it as ``entry``; returns the attempt's folder."""
    attempt = f"{entry}/attempt-{uuid.uuid4().hex}"
    rows.write.format(form).options(**options).save(f"{path}/{attempt}")
    commit(rows.sparkSession, path, entry, [f"+{attempt}"])
    return f"{path}/{attempt}"


def committed(spark: SparkSession, path: str) -> dict[str, list[str]] | None:
    """By commit, the paths in force of the tables that match ``path``; None where nothing is committed.

    Paths are whole ones. Commits are as many as batches since the last packing; the
    driver holds their lines, no more.
    """
    system, place = _folder(spark, f"{path}/{COMMITS}")
    roots = [s.getPath().toString() for s in system.globStatus(place) or []]
    if not roots:
        return None
    lines = spark.read.option("recursiveFileLookup", "true").text(roots)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), "value").collect()
    added: dict[str, list[str]] = {}
    gone = set()
    for file, line in lines:
        base, _, entry = plain_path(file).rpartition(f"/{COMMITS}/")
        whole = f"{base}/{line[1:]}"
        if line.startswith("-"):
            gone.add(whole)
        else:
            added.setdefault(f"{base}/{entry}", []).append(whole)
    found = {entry: [p for p in paths if p not in gone] for entry, paths in added.items()}
    for root in roots:
        plain = system.globStatus(_folder(spark, f"{root.removesuffix('/' + COMMITS)}/*")[1]) or []
        plain = [s.getPath() for s in plain if s.isFile() and s.getPath().getName()[:1] not in "._"]
        own = [p for p in (_plain(p.toString()) for p in plain) if p not in gone]
        if own:
            found[root] = own
    return found


def _plain(path: str) -> str:
    """Local paths in one form: Spark writes file:/x here and file:///x there."""
    return re.sub("^file:/+", "file:/", path)


def plain_path(file: str) -> str:
    """The path of a file that a scan names."""
    return _plain(unquote(file))


def read_committed(spark: SparkSession, path: str, schema: StructType, form: str = "parquet") -> DataFrame:
    """The rows of a table's commits and plain files; of a table without commits, all it holds."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    found = committed(spark, path)
    if found is None:
        return reader.format(form).load(path)
    paths = [p for entry in found.values() for p in entry]
    return reader.format(form).load(paths) if paths else spark.createDataFrame([], schema)


def table_root(spark: SparkSession, path: str) -> str:
    """A table's path as it stands before the paths of its files."""
    return _plain(_folder(spark, path)[1].toString()) + "/"


def repeatable(entries: list[str]) -> set[str]:
    """Of some commits those that may be written again: the last batch of each run of a stream."""
    last: dict[str, str] = {}
    for entry in entries:
        run, _, name = entry.rpartition("/")
        if name.startswith("batch-"):
            last[run] = max(last.get(run, entry), entry)
    return set(last.values())


def replaced(root: str, places: list[str], files: list[str], gone: set[str]) -> list[str]:
    """Commit lines that take some files out of a table's places: folders, or files by themselves.

    A folder goes whole; those of its files that stay come back by name.
    """
    lines = []
    for place in places:
        own = [f for f in files if f == place or f.startswith(place + "/")]
        if gone.intersection(own):
            lines.append("-" + place.removeprefix(root))
            lines += ["+" + f.removeprefix(root) for f in own if f not in gone]
    return lines


def listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, length)`` of all files in folders; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "length")
