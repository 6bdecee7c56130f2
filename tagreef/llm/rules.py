"""Quality rules: fixed limits on counts, then a logistic model on hashed n-grams.

The model's features are the words, pairs of words and runs of three characters of
a text, hashed to ``BUCKETS`` buckets; a bucket's value is the logarithm of its
count, and a text's values have length 1. The model is fitted on labelled rows by
L-BFGS: every step sums the gradient over the partitions of the rows. A quarter of
the rows is kept out of the fit and calibrates the score to a probability (Platt's
sigmoid). Texts are scored in Arrow batches.
"""

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagreef.llm.fitting import FIT_ROWS, labelled, summed
from tagreef.llm.tables import stored
from tagreef.llm.words import PLAIN, Words, find_words, mixed, pieces

BUCKETS = 1 << 14
#: Weight of the squared weights against the mean loss.
RIDGE = 1e-5
STEPS = 16
MEMORY = 8
#: One row in so many calibrates.
HELD = 4
#: Scores are counted in steps of this for calibration, from -LIMIT to LIMIT.
STEP, LIMIT = 0.01, 30.0

# The limits of the rules and what counts as a symbol.
LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED = 30
SYMBOLS = b"#*$%&|<>"
#: Texts whose probability is less are not kept.
KEEP = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_LINE = np.ones(256, bool)
_LINE[0x0A] = False

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(sums[edges])


def _owners(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _sorted_repeats(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by text and hash (stable), and which rows of it repeat the row before."""
    order = np.lexsort((hashes, owner))
    same = np.zeros(len(order), bool)
    same[1:] = (owner[order[1:]] == owner[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
    return order, same


def base_counts(raw: np.ndarray, cuts: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    """The counts of each text. Lines and windows are equal if their 64-bit hashes are."""
    n = len(cuts) - 1
    sums = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64)])
    chars = sums[words.ends] - sums[words.starts]
    lines = find_words(raw, cuts, _LINE, False)
    filled = np.concatenate([[0], np.cumsum(PLAIN[raw], dtype=np.int64)])
    full = filled[lines.ends] > filled[lines.starts]
    holder = _owners(lines.first)[full]
    order, again = _sorted_repeats(holder, lines.hashes[full])
    dup_lines = np.bincount(holder[order[again]], minlength=n)
    at, hashes = words.windows(WINDOW)
    order, again = _sorted_repeats(np.searchsorted(words.first, at, "right") - 1, hashes)
    twice = again.copy()
    twice[:-1] |= again[1:]
    edges = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(edges, at[order[twice]], 1)
    np.add.at(edges, at[order[twice]] + WINDOW, -1)
    repeated = _per_text(np.cumsum(edges)[:-1] > 0, words.first)
    found = (words.counts, _per_text(chars, words.first), _per_text(_SYMBOL[raw], cuts), dup_lines, repeated)
    return {name: np.asarray(values, np.int64) for name, values in zip(COUNTS, found)}


def _char_runs(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each run of three characters within a text."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    sums = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64)])
    edges = np.minimum(sums[cuts], len(points))
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner = _owners(np.append(edges[:-1], len(points)))
    inside = owner[:-2] == owner[2:]
    h = mixed(points[:-2] | points[1:-1] << np.uint64(21) | points[2:] << np.uint64(42))
    return owner[:-2][inside], h[inside]


def ngrams(raw: np.ndarray, cuts: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of the texts' features, in order; values of a text have length 1."""
    at, pairs = words.windows(2)
    runs, codes = _char_runs(raw, cuts)
    owner = np.concatenate([_owners(words.first), np.searchsorted(words.first, at, "right") - 1, runs])
    # The kinds of feature share the buckets, with hashes of their own.
    hashes = np.concatenate([words.hashes, mixed(pairs + np.uint64(1)), mixed(codes + np.uint64(2))])
    key = owner.astype(np.uint64) << np.uint64(14) | hashes >> np.uint64(50)
    key, counts = np.unique(key, return_counts=True)
    owner, bucket = (key >> np.uint64(14)).astype(np.int64), (key & np.uint64(BUCKETS - 1)).astype(np.int32)
    value = np.log1p(counts)
    length = np.sqrt(np.bincount(owner, value**2, minlength=len(cuts) - 1))
    return owner, bucket, value / length[owner]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class RuleModel:
    """Weights by bucket (the last is the constant) and the calibrating line."""

    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, owner: np.ndarray, bucket: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(owner, self.weights[bucket] * value, minlength=n) + self.weights[-1]

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * margins + self.shift)


def minimised(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """L-BFGS with halved steps; ``loss`` returns a value and a gradient."""
    w, (value, slope) = start, loss(start)
    held: deque = deque(maxlen=MEMORY)
    for _ in range(steps):
        if np.abs(slope).max() < 1e-6:
            break
        way, alphas = slope.copy(), []
        for s, y in reversed(held):
            a = (s @ way) / (s @ y)
            alphas.append(a)
            way -= a * y
        if held:
            s, y = held[-1]
            way *= (s @ y) / (y @ y)
        for (s, y), a in zip(held, reversed(alphas)):
            way += (a - (y @ way) / (s @ y)) * s
        step = 1.0 if held else 1 / max(np.abs(slope).max(), 1e-12)
        for _ in range(6):
            new, grown = loss(w - step * way)
            if new <= value - 1e-4 * step * (slope @ way):
                break
            step /= 2
        else:
            break
        s, y = -step * way, grown - slope
        if s @ y > 1e-12:
            held.append((s, y))
        w, value, slope = w + s, new, grown
    return w


def platt(at: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid through ``y`` ones of ``n`` rows at each margin."""
    ones, all_rows = y.sum(), n.sum()
    # Targets a little inside 0 and 1, so that separable rows have a finite answer.
    high, low = (ones + 1) / (ones + 2), 1 / (all_rows - ones + 2)
    target = y * high + (n - y) * low
    x = np.column_stack([at, np.ones(len(at))])
    line = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(x @ line)
        slope = x.T @ (n * p - target) + 1e-6 * (line - [1, 0])
        bend = x.T @ (x * (n * p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        change = np.linalg.solve(bend, slope)
        line = line - np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-9:
            break
    # A margin that says nothing must not turn the order round.
    return (float(line[0]), float(line[1])) if line[0] > 0 else (0.0, float(np.log((ones + 1) / (all_rows - ones + 1))))


def fit_rules(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", rows: int = FIT_ROWS) -> RuleModel:
    """Fit on at most ``rows`` labelled documents; ``train`` says which rows of ``labels``.

    The sample is that of :func:`~tagreef.llm.fitting.labelled`: of several labels
    of an id the greatest counts, and ties are broken by the id, so that the same
    rows give the same model whatever their order. Null ids and labels are left
    out. Without labelled rows every probability is 0.5. Only the sums of
    gradients reach the driver, ``BUCKETS`` numbers a step.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, raw, cuts in pieces(batch.column("text")):
                owner, bucket, value = ngrams(raw, cuts, find_words(raw, cuts, PLAIN, False))
                edges = pa.array(np.searchsorted(owner, np.arange(high - low + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("held")[low:high], batch.column("y")[low:high],
                        pa.ListArray.from_arrays(edges, pa.array(bucket, pa.int32())),
                        pa.ListArray.from_arrays(edges, pa.array(value, pa.float32())),
                    ],
                    ["held", "y", "buckets", "vals"],
                )

    known = labelled(docs, labels, label, train, rows)
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(HELD)) == 0
    known = known.select(held.alias("held"), "y", "text").mapInArrow(
        describe, "held boolean, y double, buckets array<int>, vals array<float>"
    )
    known = stored(known, "ngrams")
    fit, kept = known.filter("NOT held"), known.filter("held")
    size = BUCKETS + 1

    def cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lists = batch.column("buckets")
        owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
        return owner, np.asarray(lists.flatten()), np.asarray(batch.column("vals").flatten(), float), np.asarray(batch.column("y"))

    n = max(fit.count(), 1)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        def sums(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
            owner, bucket, value, y = cells(batch)
            margin = RuleModel(w).margins(owner, bucket, value, len(y))
            off = sigmoid(margin) - y
            slope = np.append(np.bincount(bucket, off[owner] * value, minlength=BUCKETS), off.sum())
            return {"slope": slope, "loss": np.logaddexp(0, np.where(y > 0.5, -margin, margin)).sum()}

        found = summed(fit, sums, {"slope": (size,), "loss": (1,)})
        light = np.append(w[:-1], 0.0)  # the constant is free
        return found["loss"][0] / n + RIDGE / 2 * (light @ light), found["slope"] / n + RIDGE * light

    model = RuleModel(minimised(loss, np.zeros(size)))
    bins = int(2 * LIMIT / STEP) + 1

    def counted(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        owner, bucket, value, y = cells(batch)
        margin = np.clip(model.margins(owner, bucket, value, len(y)), -LIMIT, LIMIT)
        at = np.rint((margin + LIMIT) / STEP).astype(int)
        return {"n": np.bincount(at, minlength=bins), "y": np.bincount(at, y, minlength=bins)}

    found = summed(kept, counted, {"n": (bins,), "y": (bins,)})
    at = np.flatnonzero(found["n"])
    if len(at):
        model.slope, model.shift = platt(at * STEP - LIMIT, found["n"][at], found["y"][at])
    return model


ADDED = T.StructType(
    [
        *(T.StructField(name, T.LongType()) for name in COUNTS), T.StructField("base_failed", T.BooleanType()),
        T.StructField("probability", T.DoubleType()), T.StructField("kept", T.BooleanType()),
    ]
)


def apply_rules(docs: DataFrame, model: RuleModel, text: str = "text", keep: float = KEEP) -> DataFrame:
    """Every row of ``docs`` with its counts, ``base_failed``, ``probability`` and ``kept``.

    ``base_failed``: fewer than 20 words, or more than 30 of 100 words lie in
    8-word windows that occur twice or more in the text. ``kept``: not failed, and
    a calibrated probability of ``keep`` or more (equal is kept). A null text has
    no words and fails; so does an empty one. Repeated rows are judged each for
    itself. Input columns of the names added are replaced.
    """
    kept = [c for c in docs.columns if c not in ADDED.names]
    schema = T.StructType([*docs.select(*kept).schema.fields, *ADDED.fields])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, raw, cuts in pieces(batch.column(text)):
                words = find_words(raw, cuts, PLAIN, False)
                counts = base_counts(raw, cuts, words)
                failed = (counts["n_words"] < LEAST_WORDS) | (
                    100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"]
                )
                likely = model.probabilities(model.margins(*ngrams(raw, cuts, words), high - low))
                found = [*counts.values(), failed, likely, ~failed & (likely >= keep)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c)[low:high] for c in kept), *map(pa.array, found)], schema.names
                )

    return docs.select(*kept, *([] if text in kept else [text])).mapInArrow(judge, schema)
