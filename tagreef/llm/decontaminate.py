"""Benchmark decontamination: a broadcast set of item n-grams, scanned over all texts."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagreef.llm.tables import own_names, sent, stored
from tagreef.llm.words import ALNUM, Words, spans_of, word_pieces

NGRAM = 13
#: Most bytes of item texts that one pass over the documents holds. A word has a byte
#: and a gap at least, and a window 32 bytes in the table: 17 bytes a byte at most.
SLICE_BYTES = 8 << 20

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)


class Grams:
    """Windows of items: by length sorted hashes, and for each the bytes of its words and its item.

    The items' words stand once, one blank apart, in ``data``; a window is a range of
    it. Of equal windows of one item the first is held.
    """

    def __init__(self, items: list[tuple[int, str]], size: int):
        ids = np.array([item for item, _ in items], np.int64)
        texts, rows, offset = [], {}, 0
        for low, _, words in word_pieces(pa.array([text for _, text in items], pa.string()), ALNUM, True):
            sizes = words.ends - words.starts
            begin = offset + np.cumsum(sizes + 1) - sizes - 1
            texts.append(_spaced(words, sizes))
            offset += len(texts[-1])
            counts = words.counts
            for length in {size, *counts[(counts > 0) & (counts < size)].tolist()}:
                at, hashes = words.windows(length)
                text = np.searchsorted(words.first, at, "right") - 1
                if length < size:
                    whole = counts[text] == length
                    at, hashes, text = at[whole], hashes[whole], text[whole]
                last = at + length - 1
                rows.setdefault(length, []).append((hashes, begin[at], begin[last] + sizes[last], ids[low + text]))
        self.data = np.concatenate([np.zeros(0, np.uint8), *texts])
        self.tables = {}
        for length, parts in rows.items():
            code, start, end, item = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((start, item, code))
            code, start, end, item = code[order], start[order], end[order], item[order]
            keep = np.ones(len(code), bool)
            for k in np.flatnonzero((code[1:] == code[:-1]) & (item[1:] == item[:-1])).tolist():
                keep[k + 1] = self._gram(start[k], end[k]) != self._gram(start[k + 1], end[k + 1])
            self.tables[length] = code[keep], start[keep], end[keep], item[keep]

    def _gram(self, start: int, end: int) -> bytes:
        return self.data[start:end].tobytes()

    @property
    def nbytes(self) -> int:
        return self.data.nbytes + sum(x.nbytes for table in self.tables.values() for x in table)

    def hits(self, words: Words) -> dict[int, list[tuple[int, int, set[int]]]]:
        """By text of a piece: (start, length, items) of each window that is an item's."""
        out: dict[int, list[tuple[int, int, set[int]]]] = {}
        for length, (code, start, end, item) in self.tables.items():
            at, hashes = words.windows(length)
            near = np.searchsorted(code, hashes)
            near[near == len(code)] = 0
            found = np.flatnonzero(code[near] == hashes) if len(code) else near[:0]
            past = np.searchsorted(code, hashes[found], "right").tolist()
            for k, low, high in zip(found.tolist(), near[found].tolist(), past):
                place = int(at[k])
                gram = b" ".join(
                    words.data[words.starts[j] : words.ends[j]].tobytes() for j in range(place, place + length)
                )
                items = {int(item[n]) for n in range(low, high) if self._gram(start[n], end[n]) == gram}
                if items:
                    text = int(np.searchsorted(words.first, place, "right")) - 1
                    out.setdefault(text, []).append((place - int(words.first[text]), length, items))
        return out


def _spaced(words: Words, sizes: np.ndarray) -> np.ndarray:
    """The bytes of the words, each followed by a blank."""
    out = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    inside = spans_of(sizes)
    out[np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes) + inside] = words.data[np.repeat(words.starts, sizes) + inside]
    return out


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _slices(items: DataFrame, limit: int) -> Iterator[list[tuple[int, str]]]:
    """Items in runs whose texts have ``limit`` bytes at most, or one item."""
    run: list[tuple[int, str]] = []
    held = 0
    for row in items.toLocalIterator():
        size = len(row["text"].encode())
        if run and held + size > limit:
            yield run
            run, held = [], 0
        run.append((row["item_id"], row["text"]))
        held += size
    if run:
        yield run


def _scan(docs: DataFrame, grams, text: str) -> DataFrame:
    """Add or extend the hit columns of each row; ``grams`` returns what was sent."""
    old = set(HITS.names) <= set(docs.columns)
    kept = [c for c in docs.columns if c not in HITS.names]
    schema = T.StructType([*docs.select(*kept).schema.fields, *HITS.fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = grams()
        for batch in batches:
            n_words, spans, items = [], [], []
            for low, _, words in word_pieces(batch.column(text), ALNUM, True):
                found = table.hits(words)
                for k, n in enumerate(words.counts.tolist()):
                    hits = found.get(k, [])
                    held = [(a, a + n) for a, n, _ in hits]
                    names = set().union(*(x[2] for x in hits))
                    if old:
                        held += map(tuple, batch.column("spans")[low + k].as_py())
                        names |= set(batch.column("items")[low + k].as_py())
                    n_words.append(n)
                    spans.append(_merged(held))
                    items.append(sorted(names))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                    pa.array(items, pa.list_(pa.int64())),
                ],
                [*kept, *HITS.names],
            )

    return docs.select(*kept, *(HITS.names if old else [])).mapInArrow(scan, schema)


def find_benchmark_spans(
    docs: DataFrame, items: DataFrame, text: str = "text", size: int = NGRAM, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Every row of ``docs`` with the words that lie in an occurrence of an item's window.

    Words are runs of lower-cased ASCII letters, digits and characters beyond
    ASCII. A window is ``size`` consecutive words of an item, or the whole item
    if it has fewer. Added are ``n_words``, ``spans`` (merged [start, end) word
    ranges) and ``items`` (ids of the items with an occurring window, sorted). A
    null or empty text has no words and no spans; null or wordless items have no
    windows; an item with a null id is left out. Repeated rows are judged each
    for itself; input columns of the names added are replaced.

    Item windows are broadcast in slices of ``slice_bytes`` of text: one pass for
    a usual benchmark, and for more of them one stored pass per slice.
    """
    spark = docs.sparkSession
    out = docs.drop(*HITS.names)
    first = True
    for run in _slices(items.select("item_id", "text").dropna(), slice_bytes):
        if not first:
            out = stored(out, "benchmark-pass")
        out = _scan(out, sent(spark, Grams(run, size)), text)
        first = False
    if first:
        out = _scan(out, sent(spark, Grams([], size)), text)
    return out


def n_hit():
    """Words in the spans."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])


def is_contaminated():
    """A twentieth of the words or more are hit."""
    hit = n_hit()
    return (hit > 0) & (20 * hit >= F.col("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", remove: str = "documents", **how) -> DataFrame:
    """The rows of ``docs`` without contaminated documents, or with spans cut out.

    ``remove="documents"`` drops rows of which a twentieth of the words are hit.
    ``remove="spans"`` keeps every row and cuts each span's bytes out of the
    text, from its first word's first byte to its last word's end. The rows come
    back with their own columns, whatever these are called.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(remove)
    own, back = own_names(docs)
    text = own.columns[docs.columns.index(text)]
    found = find_benchmark_spans(own, items, text, **how)
    if remove == "documents":
        return back(found.filter(~is_contaminated()))
    columns, schema = own.columns, own.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for low, _, words in word_pieces(batch.column(text), ALNUM, True):
                for k in range(len(words.first) - 1):
                    whole = batch.column(text)[low + k].as_py()
                    spans = batch.column("spans")[low + k].as_py()
                    texts.append(_without(whole, spans, words, k))
            arrays = [pa.array(texts, batch.schema.field(c).type) if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return back(found.mapInArrow(cut, schema))


def _without(whole: str | None, spans: list, words: Words, k: int) -> str | None:
    """The text without the bytes of the spans' words and what lies between them."""
    if not spans:
        return whole
    raw, base, low = whole.encode(), int(words.cuts[k]), int(words.first[k])
    parts, at = [], 0
    for start, end in spans:
        parts.append(raw[at : int(words.starts[low + start]) - base])
        at = int(words.ends[low + end - 1]) - base
    return b"".join([*parts, raw[at:]]).decode()
