"""Language-model scores from a hidden Markov model over words.

Frequent words have emissions of their own; the rest share those of their class
(a hash of the last three bytes) and are drawn within it by their smoothed
count: P(word | state) = P(class | state) * (c + 0.5) / (N + 0.5 * (V + 1)), with N
tokens and V distinct words of the class in training, and c = 0 for a word never
seen. So the emission table has a fixed size, while counts of every word, of all
training texts, are kept in a table that is joined, never broadcast.

Baum-Welch: each step sums expected counts over the partitions of all training
texts. A text's probability is the scaled forward recursion over its words and
one end mark, times the choice of words within classes.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagreef.llm.fitting import summed
from tagreef.llm.tables import sent, stored
from tagreef.llm.words import PLAIN, Words, word_pieces

STATES = 4
STEPS = 4
#: Words with emissions of their own, and classes of the others.
TOP, KINDS = 2048, 1024
#: Most frequent words whose counts are broadcast (16 bytes each); others are joined.
HEAD = 1 << 17
#: Tokens whose states are worked out together.
GROUP_TOKENS = 1 << 21

END = TOP + KINDS
CLASSES = END + 1


def word_kinds(words: Words) -> np.ndarray:
    """A class for each word from its last three bytes."""
    code = np.zeros(len(words.ends), np.int64)
    for back in (1, 2, 3):
        at = words.ends - back
        held = at >= words.starts
        code = code * 257 + np.where(held, words.data[np.maximum(at, 0)].astype(np.int64) + 1, 0)
    return ((code * 0x9E3779B1) >> 12) % KINDS


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, kind, c) of all words of ``text``; words are 64-bit hashes."""

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        word, kind, c = (np.concatenate(x) for x in zip(*parts))
        word, first, inverse = np.unique(word, return_index=True, return_inverse=True)
        return word, kind[first], np.bincount(inverse, c, len(word)).astype(np.int64)

    def batch_of(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        word, kind, c = part
        return pa.RecordBatch.from_arrays(
            [pa.array(word.view(np.int64)), pa.array(kind.astype(np.int32)), pa.array(c)], ["word", "kind", "c"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for _, _, words in word_pieces(batch.column("text"), PLAIN, True):
                one = (words.hashes, word_kinds(words), np.ones(len(words.hashes), np.int64))
                held.append(merged([one]))
                size += len(held[-1][0])
                if size > 2_000_000:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > 1_000_000:
                        yield batch_of(held.pop())
                        size = 0
        if held:
            yield batch_of(merged(held))

    counts = docs.select("text").mapInArrow(count, "word long, kind int, c long")
    return counts.groupBy("word").agg(F.min("kind").alias("kind"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Counts of the most frequent words and of the classes; ``place`` is -1 beyond the top."""

    word: np.ndarray
    count: np.ndarray
    place: np.ndarray
    tokens: int
    distinct: int
    texts: int
    kind_tokens: np.ndarray
    kind_words: np.ndarray

    @property
    def log_base(self) -> float:
        """log10 of the base model's denominator."""
        return float(np.log10(self.tokens + 0.5 * (self.distinct + 1)))

    @property
    def log_kind(self) -> np.ndarray:
        return np.log10(self.kind_tokens + 0.5 * (self.kind_words + 1))

    def class_shares(self) -> np.ndarray:
        """Share of each class among training tokens, a little of it for every class."""
        c = np.full(CLASSES, 0.5)
        top = self.place >= 0
        c[self.place[top]] += self.count[top]
        c[TOP:END] += self.kind_tokens
        c[END] += self.texts
        return c / c.sum()


def read_vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    head = counts.orderBy("c", "word", ascending=[False, True]).limit(HEAD).toArrow()
    word, kind, c = (head.column(k).to_numpy() for k in range(3))
    kinds = counts.groupBy("kind").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    tokens, distinct = np.zeros(KINDS), np.zeros(KINDS)
    for row in kinds:
        tokens[row.kind], distinct[row.kind] = row.n, row.v
    total, kept = int(tokens.sum()) + texts, int(distinct.sum()) + (texts > 0)
    tokens -= np.bincount(kind[:TOP], c[:TOP], KINDS)
    distinct -= np.bincount(kind[:TOP], minlength=KINDS)
    place = np.where(np.arange(len(word)) < TOP, np.arange(len(word)), -1)
    word = word.view(np.uint64)
    order = np.argsort(word)
    return Vocabulary(word[order], c[order], place[order], total, kept, texts, tokens, distinct)


def _described(docs: DataFrame, vocabulary) -> DataFrame:
    """Each text as a class sequence, sums over its words, and its words beyond the head."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocabulary()
        known = np.append(v.word, np.uint64(2**64 - 1))
        count, place = np.append(v.count, 0), np.append(v.place, -1)
        log_kind, end = v.log_kind, np.array([END], np.int16).tobytes()
        for batch in batches:
            for low, high, words in word_pieces(batch.column("text"), PLAIN, True):
                n = high - low
                of = np.repeat(np.arange(n), words.counts)
                at = np.minimum(np.searchsorted(v.word, words.hashes), len(v.word))
                head = known[at] == words.hashes
                head &= at < len(v.word)
                top = np.where(head, place[at], -1)
                kind = word_kinds(words)
                classes = np.where(top >= 0, top, TOP + kind).astype(np.int16)
                log_c = np.where(head, np.log10(count[at] + 0.5), 0)

                def per_text(part: np.ndarray, value: np.ndarray) -> np.ndarray:
                    return np.bincount(of[part], value[part], n).astype(float)

                far = np.flatnonzero(~head)
                order = far[np.lexsort((words.hashes[far], of[far]))]
                fresh = np.ones(len(order), bool)
                fresh[1:] = (of[order][1:] != of[order][:-1]) | (words.hashes[order][1:] != words.hashes[order][:-1])
                begin = np.flatnonzero(fresh)
                tail, times = words.hashes[order[begin]].view(np.int64), np.diff(np.append(begin, len(order)))
                cuts = pa.array(np.searchsorted(of[order[begin]], np.arange(n + 1)).astype(np.int32))
                raw, first = classes.tobytes(), (2 * words.first).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id")[low:high], batch.column("held_out")[low:high],
                        pa.array([raw[a:b] + end for a, b in zip(first, first[1:])], pa.binary()),
                        pa.array(np.bincount(of[head], minlength=n).astype(np.int64)),
                        pa.array(per_text(head, log_c)),
                        pa.array(per_text(head & (top < 0), log_c) - per_text(top < 0, log_kind[kind])),
                        pa.ListArray.from_arrays(cuts, pa.array(tail)),
                        pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
                    ],
                    ["id", "held_out", "classes", "n_head", "head", "within", "tail", "times"],
                )

    return docs.mapInArrow(
        describe,
        "id long, held_out boolean, classes binary, n_head long, head double, within double, "
        "tail array<long>, times array<int>",
    )


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[tuple[pa.RecordBatch, np.ndarray]]]:
    """Batches with their class sequences, gathered to about ``GROUP_TOKENS`` tokens."""
    held: list[tuple[pa.RecordBatch, np.ndarray]] = []
    size = 0
    for batch in batches:
        lengths = np.array([len(x) // 2 for x in batch.column(column).to_pylist()], np.int64)
        low = 0
        while low < len(lengths):
            sums = size + np.cumsum(lengths[low:])
            high = low + max(1 if not held else 0, int(np.searchsorted(sums, GROUP_TOKENS, "right")))
            if high > low:
                held.append((batch.slice(low, high - low), lengths[low:high]))
                size += int(lengths[low:high].sum())
                low = high
            if low < len(lengths):
                yield held
                held, size = [], 0
    if held:
        yield held


@dataclass
class Sequences:
    """Sequences laid out time by time, longest first: step t holds ``active[t]`` of them."""

    order: np.ndarray
    active: np.ndarray
    offset: np.ndarray
    tokens: np.ndarray

    @classmethod
    def of(cls, parts: list[bytes]) -> "Sequences":
        lengths = np.array([len(x) // 2 for x in parts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        flat = np.frombuffer(b"".join(parts), np.int16)
        sorted_lengths = lengths[order]
        active = len(lengths) - np.searchsorted(sorted_lengths[::-1], np.arange(sorted_lengths[0]), "right")
        offset = np.concatenate([[0], np.cumsum(active)])
        starts = (np.cumsum(lengths) - lengths)[order]
        step = np.repeat(np.arange(len(active)), active)
        lane = np.arange(len(flat)) - offset[step]
        return cls(order, active, offset, flat[starts[lane] + step])


@dataclass
class HiddenMarkov:
    initial: np.ndarray
    moves: np.ndarray
    emissions: np.ndarray  # classes x states
    log: list[float] = field(default_factory=list)

    @classmethod
    def begin(cls, shares: np.ndarray, states: int = STATES, seed: int = 2) -> "HiddenMarkov":
        """Sticky states whose emissions are the overall shares, shaken apart."""
        rng = np.random.default_rng(seed)
        emissions = shares[:, None] * np.exp(rng.normal(size=(len(shares), states)))
        moves = np.full((states, states), 0.05 / max(states - 1, 1))
        np.fill_diagonal(moves, 0.95 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), moves, emissions / emissions.sum(0))

    def forward(self, seq: Sequences, keep: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log10 probability by lane, scaled forward values, scales); the last two if kept."""
        kind = np.float32 if keep else np.float64
        seen = self.emissions.astype(kind)[seq.tokens]
        moves = self.moves.astype(kind)
        total = np.zeros(int(seq.active[0]))
        values = np.empty_like(seen) if keep else seen[:0]
        scales = np.empty(len(seen), kind)
        now = self.initial.astype(kind)[None, :]
        for t, n in enumerate(seq.active.tolist()):
            low = int(seq.offset[t])
            now = (now[:n] @ moves if t else now) * seen[low : low + n]
            scale = now.sum(1)
            now /= scale[:, None]
            scales[low : low + n] = scale
            if keep:
                values[low : low + n] = now
        lane = np.arange(len(scales)) - np.repeat(seq.offset[:-1], seq.active)
        total = np.bincount(lane, np.log10(scales.astype(float)), len(total))
        return total, values, scales

    def expected(self, seq: Sequences) -> dict[str, np.ndarray]:
        """Expected counts of first states, moves and emissions, and the log likelihood."""
        total, values, scales = self.forward(seq, True)
        seen = self.emissions.astype(np.float32)[seq.tokens] / scales[:, None]
        back = self.moves.T.astype(np.float32)
        moves = np.zeros_like(self.moves)
        after = np.ones((int(seq.active[0]), self.moves.shape[0]), np.float32)
        for t in range(len(seq.active) - 1, 0, -1):
            n, low, before = int(seq.active[t]), int(seq.offset[t]), int(seq.offset[t - 1])
            ahead = seen[low : low + n] * after[:n]
            moves += values[before : before + n].T @ ahead
            values[low : low + n] *= after[:n]
            after[:n] = ahead @ back
        values[: len(after)] *= after
        emissions = np.column_stack(
            [np.bincount(seq.tokens, values[:, k], CLASSES) for k in range(values.shape[1])]
        )
        return {
            "initial": values[: len(after)].sum(0), "moves": moves * self.moves, "emissions": emissions,
            "log": np.array([total.sum()]),
        }

    def learned(self, sums: dict[str, np.ndarray], shares: np.ndarray) -> "HiddenMarkov":
        """The next model; every state keeps a little of the overall shares."""
        emissions = sums["emissions"] + 20 * shares[:, None]
        initial, moves = sums["initial"] + 0.1, sums["moves"] + 0.1
        return HiddenMarkov(
            initial / initial.sum(), moves / moves.sum(1, keepdims=True), emissions / emissions.sum(0),
            [*self.log, float(sums["log"][0])],
        )


def train(described: DataFrame, shares: np.ndarray, states: int = STATES, steps: int = STEPS) -> HiddenMarkov:
    """Baum-Welch over all sequences of ``classes``."""
    model = HiddenMarkov.begin(shares, states)
    shapes = {"initial": (states,), "moves": (states, states), "emissions": (CLASSES, states), "log": (1,)}
    for _ in range(steps):

        def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in _groups(batches, "classes"):
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([b.column("classes") for b, _ in group])], ["classes"])

        def expected(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
            return model.expected(Sequences.of(batch.column(0).to_pylist()))

        model = model.learned(summed(described.select("classes"), expected, shapes, grouped), shares)
    return model


def _forward_scores(described: DataFrame, model: HiddenMarkov) -> DataFrame:
    """(row, forward) of every sequence."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "classes"):
            rows = pa.concat_arrays([b.column("row") for b, _ in group])
            seq = Sequences.of(pa.concat_arrays([b.column("classes") for b, _ in group]).to_pylist())
            total, _, _ = model.forward(seq, False)
            out = np.empty(len(total))
            out[seq.order] = total
            yield pa.RecordBatch.from_arrays([rows, pa.array(out)], ["row", "forward"])

    return described.select("row", "classes").mapInArrow(score, "row long, forward double")


def score_texts(
    docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text",
    states: int = STATES, steps: int = STEPS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Words are runs of bytes without ASCII white space, A-Z lowered; one end mark
    closes each text and is a token, so that a null or empty text has one. The
    model learns from all rows that are not held out (a null ``held_out`` counts
    as not). Without training texts every word is as unknown as any other.
    Repeated rows are learned from and scored each for itself.
    """
    spark = docs.sparkSession
    slim = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text).alias("text"),
    )
    training = slim.filter("NOT held_out")
    counts = stored(word_counts(training), "counts")
    v = read_vocabulary(counts, training.select("id").count())
    described = _described(slim, sent(spark, v))
    described = stored(described.withColumn("row", F.monotonically_increasing_id()), "described")
    model = train(described.filter("NOT held_out"), v.class_shares(), states, steps)

    tail = described.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t"))
    tail = tail.select("row", F.col("t.tail").alias("word"), F.col("t.times").alias("times"))
    tail = tail.join(counts.select("word", "c"), "word", "left")
    tail = tail.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("far"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("n_far"),
    )
    sums = described.select(
        "row", "id", "held_out", "n_head", "head", "within", (F.octet_length("classes") / 2).cast("long").alias("n")
    )
    out = sums.join(tail, "row", "left").join(_forward_scores(described, model), "row")
    far = F.coalesce("far", F.lit(0.0))
    end = float(np.log10(v.texts + 0.5))
    return out.select(
        F.col("id").alias("doc_id"),
        "held_out",
        F.col("n").alias("n_tokens"),
        (F.col("n_head") + F.coalesce("n_far", F.lit(0)) + int(v.texts > 0)).cast("long").alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("head") + far + end - F.col("n") * v.log_base).alias("base_score"),
        (F.col("forward") + F.col("within") + far).alias("score"),
    )
