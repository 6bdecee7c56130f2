"""Substring dedup: passages that occur again, found whole and cut out.

1. Every window of ``size`` words files itself under its least 5-gram (a seed),
   runs of windows with one seed together. Only seeds that recur go on.
2. A run equal to an earlier run of its seed is a copy of it. Where runs of one
   seed differ, their windows are compared one by one. Either way each window
   that has been before knows one earlier place (by hash).
3. The passages at these places are fetched from their documents as words.
4. Documents are dealt into blocks; each block gets the passages asked for by
   its documents, compiles them into an Aho-Corasick automaton and streams all
   its documents through it. What the automaton finds, word for word and at a
   later place, is removed.

Automata are sharded by block: a shard holds no more than its block's repeated
text, and each document is streamed once.
"""

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagreef.llm.tables import block_count, block_of, stored
from tagreef.llm.words import PLAIN, Words, span_sums, spans_of, word_pieces

SIZE = 20
SEED = 5
#: Passages are cut where their place in the source passes a multiple of this.
CELL = 64

ADDED = ("n_words", "n_removed", "spans")


def seed_runs(words: Words, size: int) -> tuple[np.ndarray, ...]:
    """(seed, run, text, start, n): n windows from start on that share a seed's place.

    Equal runs of a text follow one another, in the order of their starts.
    """
    at, _ = words.windows(size)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    total = len(words.hashes)
    grams = span_sums(words.hashes, np.arange(total - SEED + 1), np.arange(SEED, total + 1))
    # Leftmost least gram of each window: its place fills the low bits.
    low = np.uint64((1 << max(20, total.bit_length())) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, left = 1, size - SEED + 1
    while width < left:
        step = min(width, left - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    anchor = (least[at] & low).astype(np.int64)
    cut = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    n = np.diff(np.append(cut, len(at)))
    start, seed = at[cut], grams[anchor[cut]].view(np.int64)
    text = np.searchsorted(words.first, start, "right") - 1
    run = span_sums(words.hashes, start, start + n + size - 1).view(np.int64)
    order = np.lexsort((start, run, seed, text))
    seed, run, text, start, n = (part[order] for part in (seed, run, text, start, n))
    return seed, run, text, start - words.first[text], n


def _seeds(docs: DataFrame, size: int) -> DataFrame:
    """(seed, run, id, start, more, n): equal runs of a text are one row.

    ``start`` is the first of them, ``more`` holds the starts of all others, null if none.
    """

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, words in word_pieces(batch.column("text")):
                seed, run, text, start, n = seed_runs(words, size)
                fresh = np.ones(len(seed), bool)
                fresh[1:] = (text[1:] != text[:-1]) | (seed[1:] != seed[:-1]) | (run[1:] != run[:-1])
                others = np.diff(np.append(np.flatnonzero(fresh), len(fresh))) - 1
                more = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(others)).astype(np.int32)),
                    pa.array(start[~fresh].astype(np.int32)),
                    mask=pa.array(others == 0),
                )
                seed, run, text, start, n = (part[fresh] for part in (seed, run, text, start, n))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(seed), pa.array(run), batch.column("id").take(pa.array(low + text)),
                        pa.array(start.astype(np.int32)), more, pa.array(n.astype(np.int32)),
                    ],
                    ["seed", "run", "id", "start", "more", "n"],
                )

    return docs.mapInArrow(seeds, "seed long, run long, id long, start int, more array<int>, n int")


def _windows(docs: DataFrame, size: int) -> DataFrame:
    """(window, id, start) of the windows in each row's ``runs``."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("runs")
            for low, high, words in word_pieces(batch.column("text")):
                held = runs[low:high]
                own = np.repeat(np.arange(high - low), np.asarray(held.value_lengths()))
                flat = held.flatten()
                start, n = (np.asarray(flat.field(k)).astype(np.int64) for k in (0, 1))
                text = np.repeat(own, n)
                place = np.repeat(start, n) + spans_of(n)
                # A row whose id is another text's too may be shorter.
                fits = place + size <= words.counts[text]
                text, place = text[fits], place[fits]
                begin = words.first[text] + place
                codes = span_sums(words.hashes, begin, begin + size).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes), batch.column("id").take(pa.array(low + text)), pa.array(place.astype(np.int32))],
                    ["window", "id", "start"],
                )

    return docs.mapInArrow(windows, "window long, id long, start int")


def _cells(matches: DataFrame) -> DataFrame:
    """(block, source, start, n): merged matches of each row, cut by source place."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("matches")
            row = np.repeat(np.arange(len(held)), np.asarray(held.value_lengths()))
            flat = held.flatten()
            start, n, source, there = (np.asarray(flat.field(k)).astype(np.int64) for k in range(4))
            # Every place of a run asks, but for the one asked for.
            more = flat.field(4)
            again = np.repeat(np.arange(len(row)), np.asarray(more.value_lengths().fill_null(0)))
            start = np.concatenate([start, np.asarray(more.flatten()).astype(np.int64)])
            row, n, source, there = (np.concatenate([x, x[again]]) for x in (row, n, source, there))
            copy = (np.asarray(batch.column("id"))[row] != source) | (start != there)
            row, start, n, source, there = (x[copy] for x in (row, start, n, source, there))
            order = np.lexsort((start, row))
            row, start, n, source, there = (x[order] for x in (row, start, n, source, there))
            fresh = np.ones(len(row), bool)
            fresh[1:] = (
                (row[1:] != row[:-1]) | (source[1:] != source[:-1])
                | (start[1:] != start[:-1] + n[:-1]) | (there[1:] != there[:-1] + n[:-1])
            )
            first = np.flatnonzero(fresh)
            n = np.add.reduceat(n, first) if len(first) else n
            row, source, there = row[first], source[first], there[first]
            parts = (there + n - 1) // CELL - there // CELL + 1
            k = spans_of(parts)
            row, source, begin, end = (np.repeat(x, parts) for x in (row, source, there, there + n))
            cell = begin // CELL + k
            begin, end = np.maximum(begin, cell * CELL), np.minimum(end, (cell + 1) * CELL)
            # A word or line said over and over asks for the same few cells each time.
            block = np.asarray(batch.column("block")).astype(np.int64)[row]
            asked = np.unique(np.column_stack([block, source, begin, end - begin]), axis=0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(asked[:, 0].astype(np.int32)), pa.array(asked[:, 1]),
                    pa.array(asked[:, 2].astype(np.int32)), pa.array(asked[:, 3].astype(np.int32)),
                ],
                ["block", "source", "start", "n"],
            )

    return matches.mapInArrow(cells, "block int, source long, start int, n int").distinct()


def _passages(docs: DataFrame, size: int) -> DataFrame:
    """(source, start, n, words): the words of each row's ``runs``, one blank between."""

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, words in word_pieces(batch.column("text")):
                rows = []
                for k, own in enumerate(words.texts()):
                    source = batch.column("id")[low + k].as_py()
                    for run in batch.column("runs")[low + k].as_py():
                        start, n = run["start"], run["n"]
                        if start + n + size - 1 <= len(own):
                            rows.append((source, start, n, b" ".join(own[start : start + n + size - 1]).decode()))
                columns = list(zip(*rows)) or [[], [], [], []]
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["source", "start", "n", "words"]
                )

    return docs.mapInArrow(passages, "source long, start int, n int, words string")


def word_code(number: int, width: int) -> str:
    """A word's number as ``width`` letters; the first is of an alphabet of its own.

    So a match can only begin where a word does, and no letter has more than 64
    successors, which the automaton tries one after the other.
    """
    letters = [chr(0x100 + number % 64)]
    for _ in range(width - 1):
        number //= 64
        letters.append(chr(0x30 + number % 64))
    return "".join(letters)


class Phrases:
    """An automaton over the words of one block's passages."""

    def __init__(self, passages: pa.Table):
        columns = [passages.column(c).to_pylist() for c in ("source", "start", "words")]
        vocabulary = {w for words in columns[2] for w in words.split(" ")}
        self.width = 1
        while 64**self.width < len(vocabulary):
            self.width += 1
        self.codes = {w.encode(): word_code(k, self.width) for k, w in enumerate(vocabulary)}
        first: dict[str, tuple[int, int]] = {}
        for source, start, words in zip(*columns):
            key = self.coded(words.encode().split(b" "))
            first[key] = min(first.get(key, (source, start)), (source, start))
        self.automaton = ahocorasick.Automaton()
        for key, place in first.items():
            self.automaton.add_word(key, (len(key) // self.width, place))
        if first:
            self.automaton.make_automaton()

    def coded(self, words: list[bytes]) -> str:
        code, unknown = self.codes.get, "\0" * self.width
        return "".join([code(w, unknown) for w in words])

    def removed(self, doc_id: int | None, words: list[bytes]) -> list[list[int]]:
        """Merged [start, end) ranges of words that a passage at an earlier place covers."""
        if doc_id is None or not len(self.automaton):
            return []
        found = []
        for last, (length, place) in self.automaton.iter(self.coded(words)):
            end = (last + 1) // self.width
            if place < (doc_id, end - length):
                found.append((end - length, end))
        out: list[list[int]] = []
        for start, end in sorted(found):
            if out and start <= out[-1][1]:
                out[-1][1] = max(out[-1][1], end)
            else:
                out.append([start, end])
        return out


def _kept(words: Words, k: int, own: list[bytes], spans: list[list[int]], whole: str | None, form: str) -> str | None:
    """What is left of text ``k`` of a piece, whose words are ``own``."""
    if form == "text" and not spans:
        return whole
    bounds = [0, *(x for span in spans for x in span), len(own)]
    pairs = list(zip(bounds[::2], bounds[1::2]))
    if form == "words":
        return b" ".join(w for a, b in pairs for w in own[a:b]).decode()
    raw, base, low = whole.encode(), int(words.cuts[k]), int(words.first[k])
    parts, at = [], 0
    for start, end in spans:
        parts.append(raw[at : int(words.starts[low + start]) - base])
        at = int(words.ends[low + end - 1]) - base
    return b"".join([*parts, raw[at:]]).decode()


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, form: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with its repeated passages cut out of ``text``.

    A window is ``size`` consecutive words (runs of bytes without ASCII white
    space) of one document. Words covered by a window whose words also start
    earlier (at a smaller id, or before in the same document) are removed;
    windows are judged on the input. Added are ``n_words``, ``n_removed`` and
    ``spans``, the removed [start, end) word ranges. The text becomes, by
    ``form``, either the old one without the bytes from the first to the last
    word of each range ("text"), or the kept words with one blank between
    ("words", "" for null).

    Null, empty and short texts have no windows. Rows that share an id are one
    document to the rule, each cut by itself. A row with a null id has no place
    in the order: it keeps all its words and no other loses any to it. Columns
    of ``docs`` with the names added are replaced.
    """
    docs = docs.drop(*ADDED)
    slim = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).filter("id IS NOT NULL")
    blocks = block_count(docs, text)

    seeds = _seeds(slim, size)
    again = seeds.groupBy("seed").agg((F.count("*") + F.count("more")).alias("times"))
    again = again.filter("times > 1").select("seed")
    again = stored(seeds.join(again, "seed", "left_semi"), "seeds")
    runs = again.groupBy("seed", "run").agg(F.min(F.struct("id", "start")).alias("first"), F.min("n").alias("n"))
    runs = stored(runs, "runs")

    several = runs.groupBy("seed").agg(F.count("*").alias("times")).filter("times > 1").select("seed")
    mixed = runs.join(several, "seed", "left_semi").select("first.id", "first.start", "n")
    mixed = mixed.groupBy("id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    windows = stored(_windows(slim.join(mixed, "id"), size), "windows")
    firsts = windows.groupBy("window").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("times"))
    firsts = firsts.filter("times > 1").select("window", "first")

    place = F.struct("id", "start")
    source, there = F.col("first.id").alias("source"), F.col("first.start").alias("there")
    copies = again.select("seed", "run", "id", "start", "more").join(runs, ["seed", "run"])
    copies = copies.filter((place != F.col("first")) | F.col("more").isNotNull())
    copies = copies.select("id", "start", "n", source, there, "more")
    single = windows.join(firsts, "window").filter(place != F.col("first"))
    single = single.select("id", "start", F.lit(1).alias("n"), source, there, F.lit(None).cast("array<int>").alias("more"))
    matches = copies.unionAll(single).groupBy("id")
    matches = matches.agg(F.collect_list(F.struct("start", "n", "source", "there", "more")).alias("matches"))
    matches = matches.select(block_of("id", blocks).alias("block"), "id", "matches")
    cells = stored(_cells(matches), "cells")

    asked = cells.select("source", "start", "n").distinct().groupBy("source")
    asked = asked.agg(F.collect_list(F.struct("start", "n")).alias("runs")).withColumnRenamed("source", "id")
    passages = _passages(slim.join(asked, "id"), size)
    passages = stored(cells.join(passages, ["source", "start", "n"]), "passages")

    return _streamed(docs, passages, doc_id, text, blocks, form)


def _streamed(docs: DataFrame, passages: DataFrame, doc_id: str, text: str, blocks: int, form: str) -> DataFrame:
    """Each block's documents, streamed through the automaton of its passages."""
    columns = docs.columns
    places = [str(k) for k in range(len(columns))]  # names that cannot clash
    own = docs.toDF(*places)
    at, what = places[columns.index(doc_id)], places[columns.index(text)]
    spread = F.coalesce(F.col(at).cast("long"), F.xxhash64(what))
    own = own.withColumn("block", block_of(spread, blocks))
    fields = [T.StructField(n, f.dataType) for n, f in zip(places, docs.schema.fields)]
    schema = T.StructType(
        [
            *fields,
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        ]
    )

    def stream(mine: pa.Table, passages: pa.Table) -> pa.Table:
        phrases = Phrases(passages)
        n_words, n_removed, spans, texts = [], [], [], []
        ids, wholes = mine.column(at).to_pylist(), mine.column(what)
        for low, _, words in word_pieces(wholes):
            for k, own_words in enumerate(words.texts()):
                cut = phrases.removed(ids[low + k], own_words)
                n_words.append(len(own_words))
                n_removed.append(sum(b - a for a, b in cut))
                spans.append(cut)
                texts.append(_kept(words, k, own_words, cut, wholes[low + k].as_py(), form))
        arrays = [pa.array(texts, mine.schema.field(c).type) if c == what else mine.column(c) for c in places]
        arrays += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        arrays.append(pa.array(spans, pa.list_(pa.list_(pa.int32()))))
        return pa.table(arrays, [*places, *ADDED])

    both = own.groupBy("block").cogroup(passages.select("block", "source", "start", "words").groupBy("block"))
    return both.applyInArrow(stream, schema).toDF(*columns, *ADDED)
