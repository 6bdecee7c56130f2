"""Image folders, pages and accounts."""

import os
from collections.abc import Iterator
from itertools import islice
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagreef.functions.images import LONGEST_HEAD, is_folder_image
from tagreef.functions.text import file_name
from tagreef.schema import ACCOUNTS, BINARY_FILES, PAGES
from tagreef.shared import saved

# Any-case form of the folder filter, so that other files are never opened.
FOLDER_GLOB = "{*.[pP][nN][gG]*,*.[jJ][pP][gG]*,*.[gG][iI][fF]*}"


#: Bytes of files that a task opens; opening a file counts as some bytes more.
TASK_BYTES = 64 << 20
OPEN_BYTES = 16 << 10

#: Bytes of files that a reading task holds at a time, unless one file has more.
HELD_BYTES = 8 << 20

#: Files that a listing task names at a time.
NAMED = 10_000


def read_image_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Files directly in a folder: ``(name, content)`` of images, names of the rest."""
    images, _, others = open_image_folder(spark, folder)
    return images, others


def open_image_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As :func:`read_image_folder`; between them the images once more, of whose content only the head is sure.

    A local folder, as all executors see it, is listed by a task, once, into a table of
    names and lengths, which are dealt out by bytes and read where they are dealt. Of
    another file system Spark's own scan lists the files, on the driver.
    """
    image = is_folder_image(F.col("name"))
    places = _local_places(spark, folder)
    if not places:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "false")
        name = file_name(F.col("path")).alias("name")
        found = files.option("pathGlobFilter", FOLDER_GLOB).load(folder).select(name, "content").filter(image)
        return found, found, files.option("pathGlobFilter", "*").load(folder).select(name).filter(~image)
    listed = _listed(spark, places)
    found = listed.filter(image)
    return _contents(found), _contents(found, LONGEST_HEAD), listed.filter(~image).select("name")


def _local_places(spark: SparkSession, folder: str) -> list[str]:
    """The local folders and files that a path or pattern names; none on another file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getUri().getScheme() != "file":
        return []
    return [s.getPath().toUri().getPath() for s in system.globStatus(place) or []]


def _listed(spark: SparkSession, places: list[str]) -> DataFrame:
    """``(path, name, length)`` of the files directly in local folders, without those
    that a scan of Spark leaves out: hidden and empty ones, names that are not UTF-8.

    One task for each folder goes through its names; it holds ``NAMED`` of them.
    """

    def files(place: str) -> Iterator[tuple[str, str, int]]:
        for entry in os.scandir(place) if os.path.isdir(place) else [Path(place)]:
            name = entry.name
            hidden = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
            try:
                name.encode()
                if not hidden and entry.is_file() and entry.stat().st_size:
                    yield os.fspath(entry), name, entry.stat().st_size
            except (FileNotFoundError, UnicodeEncodeError):  # gone meanwhile; bytes that are no text
                continue

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column("place").to_pylist():
                found = files(place)
                while rows := list(islice(found, NAMED)):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["path", "name", "length"])

    cores = spark.sparkContext.defaultParallelism
    asked = spark.createDataFrame([(place,) for place in places], "place string").repartition(len(places), "place")
    return saved(asked.mapInArrow(listing, "path string, name string, length long").repartition(cores, "path"))


def _contents(files: DataFrame, most: int | None = None) -> DataFrame:
    """``(name, content)`` of listed files, whole or the first ``most`` bytes, in tasks of about equal bytes."""
    length = F.col("length") if most is None else F.least("length", F.lit(most))
    total = files.agg(F.sum(length + OPEN_BYTES)).first()[0] or 0
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["name", "content"])

        for batch in batches:
            names, contents, held = [], [], 0
            for path, name in zip(batch.column("path").to_pylist(), batch.column("name").to_pylist()):
                with open(path, "rb") as file:
                    contents.append(file.read() if most is None else file.read(most))
                names.append(name)
                held += len(contents[-1])
                if held >= HELD_BYTES:
                    yield rows()
                    names, contents, held = [], [], 0
            if names:
                yield rows()

    return files.select("path", "name").repartition(tasks, "path").mapInArrow(read, "name string, content binary")


def stream_image_folder(spark: SparkSession, folder: str) -> DataFrame:
    """New files of a folder as an unbounded table ``(path, content)``."""
    stream = spark.readStream.format("binaryFile").schema(BINARY_FILES).load(folder)
    return stream.select(file_name(F.col("path")).alias("path"), "content")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored web pages ``(page_id, url, html)``."""
    return spark.read.schema(PAGES).parquet(path)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ACCOUNTS).parquet(path)
