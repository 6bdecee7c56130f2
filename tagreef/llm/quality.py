"""Quality classifier: ridge on random Fourier features of document statistics.

The features approximate a Gaussian kernel over the statistics. Normal equations
are summed over partitions, once per fold; the fit of the other folds scores
each fold, and isotonic regression of the labels on these scores calibrates.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagreef.llm.fitting import FIT_ROWS, labelled, matrix, summed
from tagreef.llm.tables import stored
from tagreef.llm.words import PLAIN, find_words, pieces

FEATURES = 255
WIDTH = 5.0
RIDGE = 1e-3
FOLDS = 2
#: Ridge scores are counted in steps of this for calibration.
STEP = 0.002

N_STATISTICS = 18


def _flags(chars: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(chars)] = True
    return flags


_DIGITS = _flags(b"0123456789")
_UPPER = _flags(bytes(range(0x41, 0x5B)))
_LETTERS = _flags(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))
_STOPS = _flags(b".,;:'\"?-()")
_SIGNS = _flags(bytes(b for b in range(0x21, 0x7F) if not (_DIGITS | _LETTERS | _STOPS)[b]))
_LINES = np.ones(256, bool)
_LINES[[0x0A, 0x0D]] = False


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and the greatest count of one, by owner."""
    keys = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    of = (keys[begin] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, of, np.diff(np.append(begin, len(keys))))
    return np.bincount(of, minlength=n).astype(float), most


def statistics(raw: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A row of document statistics for each text; zeros where there is nothing to count."""
    n = len(cuts) - 1
    words = find_words(raw, cuts, PLAIN, False)
    lines = find_words(raw, cuts, _LINES, False)
    length = np.diff(cuts).astype(float)
    counts, n_lines = words.counts.astype(float), lines.counts.astype(float)

    def per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return np.diff(sums[edges]).astype(float)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    letters = per_text(_LETTERS[raw], cuts)
    size = (words.ends - words.starts).astype(float)
    mean = share(per_text(size, words.first), counts)
    owner = np.repeat(np.arange(n), words.counts)
    spread = np.sqrt(share(per_text((size - mean[owner]) ** 2, words.first), counts))
    has_sign = np.concatenate([[0], np.cumsum(_SIGNS[raw])])
    has_letter = np.concatenate([[0], np.cumsum(_LETTERS[raw])])
    signed = per_text(has_sign[words.ends] > has_sign[words.starts], words.first)
    bare = per_text(has_letter[words.ends] == has_letter[words.starts], words.first)
    kinds, most = _distinct(owner, words.hashes, n)
    own_line = np.repeat(np.arange(n), lines.counts)
    line_kinds, _ = _distinct(own_line, lines.hashes, n)
    closed = per_text(raw[lines.ends - 1] == 0x2E, lines.first)
    at, triples = words.windows(3)
    of = np.searchsorted(words.first, at, "right") - 1
    triple_kinds, _ = _distinct(of, triples, n)
    n_triples = np.bincount(of, minlength=n).astype(float)
    signs = per_text(_SIGNS[raw], cuts)
    return np.column_stack(
        [
            np.log1p(counts), np.log1p(length), mean, spread,
            share(letters, length), share(per_text(_DIGITS[raw], cuts), length),
            share(per_text(_UPPER[raw], cuts), letters), share(signs, length),
            share(per_text(_STOPS[raw], cuts), length), share(signed, counts), share(bare, counts),
            share(kinds, counts), share(most, counts), share(line_kinds, n_lines), np.log1p(n_lines),
            np.log1p(share(length, n_lines)), share(closed, n_lines),
            np.where(n_triples > 0, share(triple_kinds, n_triples), 1.0),
        ]
    )


def monotone(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``value`` in weighted squares."""
    blocks: list[list[float]] = []  # mean, weight, length
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, u, k = blocks.pop()
            b = blocks[-1]
            b[0] = (b[0] * b[1] + m * u) / (b[1] + u)
            b[1] += u
            b[2] += k
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


@dataclass
class QualityModel:
    center: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.center) / self.scale, -6, 6)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / FEATURES)
        return np.column_stack([np.ones(len(z)), z])

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.features(stats) @ self.weights, self.steps, self.levels), 0, 1)

    def score(self, docs: DataFrame, text: str = "text", name: str = "score") -> DataFrame:
        """Every row of ``docs`` with its calibrated probability of label 1.

        Null and empty texts have the score of all-zero statistics. An input
        column called ``name`` is replaced.
        """
        kept = [c for c in docs.columns if c != name]
        schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(name, T.DoubleType())])

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = [self.scores(statistics(raw, cuts)) for _, _, raw, cuts in pieces(batch.column(text))]
                found = pa.array(np.concatenate([np.zeros(0), *parts]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), found], [*kept, name])

        return docs.select(*kept).mapInArrow(score, schema)


def fit_quality(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", rows: int = FIT_ROWS) -> QualityModel:
    """Fit on at most ``rows`` labelled documents; ``train`` says which rows of ``labels``.

    Without any labelled text every score is 0.5. Only statistics of the text
    enter a score.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, raw, cuts in pieces(batch.column("text")):
                stats = list(statistics(raw, cuts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("fold")[low:high], batch.column("y")[low:high], pa.array(stats, pa.list_(pa.float64()))],
                    ["fold", "y", "stats"],
                )

    known = labelled(docs, labels, label, train, rows)
    known = known.select(F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"), "y", "text")
    known = stored(known.mapInArrow(describe, "fold int, y double, stats array<double>"), "statistics")

    def moments(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        x = matrix(batch.column("stats"), N_STATISTICS)
        return {"n": np.array([len(x)]), "x": x.sum(0), "xx": (x * x).sum(0)}

    m = summed(known, moments, {"n": (1,), "x": (N_STATISTICS,), "xx": (N_STATISTICS,)})
    n = m["n"][0]
    rng = np.random.default_rng(3)
    directions = rng.normal(size=(N_STATISTICS, FEATURES)) / WIDTH
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    center = m["x"] / max(n, 1)
    scale = np.sqrt(np.maximum(m["xx"] / max(n, 1) - center**2, 0))
    scale[scale < 1e-9] = 1.0
    flat = np.array([0.0]), np.array([0.5])
    model = QualityModel(center, scale, directions, phases, np.zeros(FEATURES + 1), *flat)
    if not n:
        return model

    def normal(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        z = model.features(matrix(batch.column("stats"), N_STATISTICS))
        y, fold = np.asarray(batch.column("y")), np.asarray(batch.column("fold"))
        own = [fold == k for k in range(FOLDS)]
        return {
            "zz": np.array([(z[o].T @ z[o])[upper] for o in own]),
            "zy": np.array([z[o].T @ y[o] for o in own]),
            "n": np.array([o.sum() for o in own]),
        }

    size = FEATURES + 1
    upper = np.triu_indices(size)
    sums = summed(known, normal, {"zz": (FOLDS, len(upper[0])), "zy": (FOLDS, size), "n": (FOLDS,)})

    def solved(folds: list[int]) -> np.ndarray:
        a = np.zeros((size, size))
        a[upper] = sums["zz"][folds].sum(0)
        a = a + np.triu(a, 1).T + RIDGE * max(sums["n"][folds].sum(), 1) * np.eye(size) / size
        return np.linalg.solve(a, sums["zy"][folds].sum(0))

    others = np.array([solved([f for f in range(FOLDS) if f != k]) for k in range(FOLDS)])
    model.weights = solved(list(range(FOLDS)))
    low, bins = -1.0, int(3 / STEP) + 1

    def counted(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        z = model.features(matrix(batch.column("stats"), N_STATISTICS))
        y, fold = np.asarray(batch.column("y")), np.asarray(batch.column("fold"))
        at = np.clip(np.rint(((z * others[fold]).sum(1) - low) / STEP), 0, bins - 1).astype(int)
        return {"n": np.bincount(at, minlength=bins), "y": np.bincount(at, y, minlength=bins)}

    held = summed(known, counted, {"n": (bins,), "y": (bins,)})
    at = np.flatnonzero(held["n"])
    model.steps = low + STEP * at
    model.levels = monotone(held["y"][at] / held["n"][at], held["n"][at])
    return model
