"""Token counts of documents in flat token files, by a scan for separators.

A token file is a run of little-endian unsigned ids of one width, documents one
after the other, each closed by an end-of-document id; there is no index. Files
are cut into blocks, whatever their size. Every block finds its separators with
one vectorised comparison; a prefix scan over the blocks of a file, in two
levels, tells each block how many documents closed before it and where the last
one ended, and so gives every document its number, start and length.
"""

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagreef.llm.tables import stored

BLOCK_BYTES = 8 << 20
#: Blocks that one step of the upper level of the scan stands for.
GROUP = 1024


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def token_ranks(file: str) -> dict[bytes, int]:
    """The vocabulary of a ``.tiktoken`` file."""
    with open(file, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def write_token_files(
    docs: DataFrame, folder: str, ranks: dict[bytes, int], pattern: str, separator: int, width: int = 2,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Write texts as token files under ``folder``; returns (path, length, doc, doc_id).

    Each task writes one file, named anew at each attempt; the rows returned, kept
    as a table, name the files that count, so that what a lost or repeated task
    left behind is never read. ``doc`` is the place of the document in its file.
    A null or empty text has no tokens, only its separator. Special tokens'
    strings in a text are ordinary text.
    """
    if separator in ranks.values() or max([separator, *ranks.values()]) >= 1 << (8 * width):
        raise ValueError("the separator must be an id of its own, and ids must fit the width")
    held = docs.sparkSession.sparkContext.broadcast(ranks)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=held.value, special_tokens={})
        system, place = _opened(folder)
        system.create_dir(place, recursive=True)
        name = f"{uuid.uuid4().hex}.tokens"
        ids: list[int | None] = []
        length = 0
        first = next(batches, None)
        if first is None:
            return
        with system.open_output_stream(f"{place}/{name}") as out:
            while first is not None:
                ids += first.column(0).to_pylist()
                for whole in first.column(1):
                    tokens = coder.encode_ordinary(whole.as_py() or "")
                    length += out.write(np.array([*tokens, separator], f"<u{width}").tobytes())
                first = next(batches, None)
        n = len(ids)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f"{folder}/{name}"] * n), pa.array([length] * n, pa.int64()),
                pa.array(np.arange(n)), pa.array(ids, pa.int64()),
            ],
            ["path", "length", "doc", "doc_id"],
        )

    slim = docs.select(F.col(doc_id).cast("long"), F.col(text))
    return stored(slim.mapInArrow(write, "path string, length long, doc long, doc_id long"), "token-files")


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the files in a folder; contents are not read."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


def _separators(files: DataFrame, separator: int, width: int, block: int) -> DataFrame:
    """(path, length, block, ends): places of the separators in each block, in tokens."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for path, length, k in zip(*(c.to_pylist() for c in batch.columns)):
                if length % width:
                    raise ValueError(f"{path}: {length} bytes are no whole number of tokens")
                system, place = _opened(path)
                with system.open_input_file(place) as file:
                    raw = file.read_at(min(block, length - k * block), k * block)
                ends.append(np.flatnonzero(np.frombuffer(raw, f"<u{width}") == separator) + k * block // width)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ends, pa.list_(pa.int64()))], ["path", "length", "block", "ends"]
            )

    last = F.ceil(F.col("length") / block) - 1
    blocks = files.filter("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    # Blocks of one file go to many tasks.
    blocks = blocks.repartition(F.xxhash64("path", "block"))
    return blocks.mapInArrow(find, "path string, length long, block long, ends array<long>")


def count_tokens(files: DataFrame, separator: int, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, doc, start, n_tokens, closed) of every document in token files.

    ``files`` has ``path`` and ``length`` (of repeated paths one counts); nulls are
    left out. ``doc`` counts from 0 in each file, ``start`` is in tokens. Tokens
    behind the last separator of a file are one more document that is not
    ``closed``; an empty file has no documents. A file whose length is no
    multiple of the width is an error.
    """
    block = max(block_bytes // width, 1) * width
    files = files.select("path", "length").dropna().dropDuplicates(["path"])
    found = stored(_separators(files, separator, width, block), "separators")

    # Upper level: a row per GROUP blocks; lower level: the blocks of one group.
    marks = found.select(
        "path", "block", F.floor(F.col("block") / GROUP).alias("group"),
        F.size("ends").cast("long").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("end"),
    )
    groups = marks.groupBy("path", "group").agg(F.sum("n").alias("n"), F.max("end").alias("end"))
    before = Window.partitionBy("path").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "path", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.max("end").over(before).alias("end0")
    )
    inside = Window.partitionBy("path", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.select(
        "path", "group", "block",
        F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("n1"), F.max("end").over(inside).alias("end1"),
    )
    marks = marks.join(groups, ["path", "group"]).select(
        "path", "block", (F.col("n0") + F.col("n1")).alias("closed"),
        (F.coalesce("end1", "end0", F.lit(-1)) + 1).alias("open"),
    )
    blocks = found.join(marks, ["path", "block"])
    # The last block of a file also closes what no separator does.
    final = (F.col("block") + 1) * block >= F.col("length")
    whole = (F.col("length") / width).cast("long")
    rest = F.when(final & (whole > F.coalesce(F.try_element_at("ends", F.lit(-1)) + 1, F.col("open"))), F.array(whole))
    ends = F.concat("ends", F.coalesce(rest, F.array().cast("array<long>")))
    starts = F.concat(F.array("open"), F.transform("ends", lambda e: e + 1))
    # Each document takes its own start and end along, not its block's.
    docs = blocks.select("path", "closed", F.size("ends").alias("n"), starts.alias("starts"), ends.alias("ends"))
    spans = F.arrays_zip(F.slice("starts", F.lit(1), F.size("ends")).alias("start"), F.col("ends").alias("end"))
    docs = docs.select("path", "closed", "n", F.posexplode(spans).alias("k", "span"))
    return docs.select(
        "path",
        (F.col("closed") + F.col("k")).alias("doc"),
        F.col("span.start").alias("start"),
        (F.col("span.end") - F.col("span.start")).alias("n_tokens"),
        (F.col("k") < F.col("n")).alias("closed"),
    )
