"""Toxicity: a logistic classifier whose scores must not hang on identity terms.

A text is seen through the words and word beginnings it holds. Every labelled
text that names an identity has a counterfactual twin, in which each identity
term is swapped for the next of its group; a change of the linear score between
the two is penalised beside the log loss. The penalty is quadratic, so that one
matrix, summed over partitions once, serves every Newton step.
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
from tagreef.llm.words import ALNUM, Words, span_sums, word_pieces

#: Features are hashed to so many buckets, of which the model keeps the most telling.
BUCKETS = 1 << 20
FEATURES = 320
#: Beginnings of words by length in bytes, beside whole words.
BEGINNINGS = (4, 5, 6)
RIDGE = 0.1
#: Weight of a squared score change against the log loss of one text.
SWAP_PENALTY = 5.0
NEWTON_STEPS = 8

# Identity terms, by groups within which they are swapped.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("immigrant", "citizen"), ("immigrants", "citizens"), ("disabled", "deaf", "blind"),
    ("frauen", "männer"), ("juden", "christen", "muslime"),
    ("femmes", "hommes"), ("juifs", "chrétiens", "musulmans"),
    ("mujeres", "hombres"), ("judíos", "cristianos", "musulmanes"),
)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket): of whole words, then of the beginnings of longer ones."""
    size = words.ends - words.starts
    at, buckets = [np.arange(len(size))], [_buckets(words.hashes)]
    for length in BEGINNINGS:
        long = np.flatnonzero(size > length)
        at.append(long)
        raw = words.data.astype(np.uint64) + np.uint64(0x9E37 + length)
        buckets.append(_buckets(span_sums(raw * raw, words.starts[long], words.starts[long] + length)))
    return np.concatenate(at), np.concatenate(buckets)


def _features_of(terms: list[str]) -> list[np.ndarray]:
    """Buckets of each term."""
    out: list[np.ndarray] = []
    for _, _, words in word_pieces(pa.array(terms), ALNUM, True):
        at, buckets = word_features(words)
        out += [buckets[at == k] for k in range(len(words.hashes))]
    return out


def _pairs(texts: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs."""
    keys = np.unique(texts * BUCKETS + buckets)
    return keys // BUCKETS, keys % BUCKETS


@dataclass
class ToxicityModel:
    """``places[bucket]`` is a feature's place in the weights, or -1."""

    buckets: np.ndarray
    weights: np.ndarray

    def places(self) -> np.ndarray:
        out = np.full(BUCKETS, -1, np.int32)
        out[self.buckets] = np.arange(len(self.buckets))
        return out

    def score(self, docs: DataFrame, text: str = "text", name: str = "score") -> DataFrame:
        """Every row of ``docs`` with its probability of label 1.

        Null and empty texts have the score of no features at all. An input
        column called ``name`` is replaced.
        """
        kept = [c for c in docs.columns if c != name]
        schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(name, T.DoubleType())])

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            places = self.places()
            for batch in batches:
                parts = [np.zeros(0)]
                for _, _, words in word_pieces(batch.column(text), ALNUM, True):
                    x = present(words, places, len(self.buckets))
                    parts.append(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))))
                found = pa.array(np.concatenate(parts))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), found], [*kept, name])

        return docs.select(*kept).mapInArrow(score, schema)


def present(words: Words, places: np.ndarray, size: int) -> np.ndarray:
    """A row per text: 1, the logarithm of its length, and which features it holds."""
    n = len(words.first) - 1
    at, buckets = word_features(words)
    place = places[buckets]
    hit = np.flatnonzero(place >= 0)
    out = np.zeros((n, size + 2))
    out[:, 0] = 1
    out[:, 1] = np.log1p(words.counts) / 10
    out[np.searchsorted(words.first, at[hit], "right") - 1, 2 + place[hit]] = 1
    return out


def swapped(words: Words, places: np.ndarray, size: int) -> np.ndarray:
    """A row per text with an identity term: its features less its twin's."""
    terms = [t for group in IDENTITIES for t in group]
    after = {t: group[(k + 1) % len(group)] for group in IDENTITIES for k, t in enumerate(group)}
    (codes,) = [w.hashes for _, _, w in word_pieces(pa.array(terms), ALNUM, True)]
    sorted_codes, order = np.sort(codes), np.argsort(codes)
    near = np.minimum(np.searchsorted(sorted_codes, words.hashes), len(codes) - 1)
    hit = np.flatnonzero(sorted_codes[near] == words.hashes)
    if not len(hit):
        return np.zeros((0, size + 2))
    of = np.searchsorted(words.first, hit, "right") - 1
    texts = np.unique(of)
    own, own_buckets = word_features(words)
    plain = ~np.isin(own, hit)
    held = present(words, places, size)[texts]
    # The twin keeps every other word's features and has those of the new terms.
    twin = np.zeros_like(held)
    twin[:, :2] = held[:, :2]
    text_of = np.searchsorted(words.first, own[plain], "right") - 1
    place = places[own_buckets[plain]]
    use = (place >= 0) & np.isin(text_of, texts)
    twin[np.searchsorted(texts, text_of[use]), 2 + place[use]] = 1
    new = _features_of([after[terms[order[k]]] for k in near[hit].tolist()])
    for text, buckets in zip(np.searchsorted(texts, of).tolist(), new):
        place = places[buckets]
        twin[text, 2 + place[place >= 0]] = 1
    return held - twin


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic", rows: int = FIT_ROWS,
    penalty: float = SWAP_PENALTY,
) -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents; ``train`` says which rows of ``labels``.

    The features kept are those whose presence tells the labels apart most, by
    the z score of the two shares, and those of the identity terms. Without any
    labelled text every score is 0.5.
    """
    known = stored(labelled(docs, labels, label, train, rows).select("y", "text"), "labelled")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, toxic = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            y = np.asarray(batch.column("y")) > 0.5
            for low, _, words in word_pieces(batch.column("text"), ALNUM, True):
                at, buckets = word_features(words)
                text, bucket = _pairs(np.searchsorted(words.first, at, "right") - 1, buckets)
                total += np.bincount(bucket, minlength=BUCKETS)
                toxic += np.bincount(bucket[y[low + text]], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(total[seen]), pa.array(toxic[seen])], ["bucket", "n", "n1"]
        )

    classes = known.selectExpr("count(*) AS n", "coalesce(sum(y), 0) AS n1").first()
    if not classes.n:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(2))
    n1, n0 = classes.n1, classes.n - classes.n1
    counts = known.mapInArrow(counted, "bucket long, n long, n1 long").groupBy("bucket")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    share1, share0 = f"n1 / {max(n1, 1)}", f"(n - n1) / {max(n0, 1)}"
    spread = f"sqrt((n + 1) / {classes.n} * (1 + 1 / {classes.n} - n / {classes.n}) * ({1 / max(n1, 1)} + {1 / max(n0, 1)}))"
    telling = counts.selectExpr("bucket", f"abs({share1} - {share0}) / {spread} AS z")
    best = telling.orderBy("z", "bucket", ascending=[False, True]).limit(FEATURES).collect()
    identity = np.concatenate(_features_of([t for group in IDENTITIES for t in group]))
    buckets = np.unique(np.concatenate([[r.bucket for r in best], identity])).astype(np.int64)
    size = len(buckets)
    model = ToxicityModel(buckets, np.zeros(size + 2))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = model.places()
        for batch in batches:
            for low, high, words in word_pieces(batch.column("text"), ALNUM, True):
                x, d = present(words, places, size), swapped(words, places, size)
                y = [*np.asarray(batch.column("y"))[low:high].tolist(), *[None] * len(d)]
                rows = [*x.astype(np.float32), *d.astype(np.float32)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(y, pa.float64()), pa.array(rows, pa.list_(pa.float32()))], ["y", "x"]
                )

    seen = stored(known.mapInArrow(describe, "y double, x array<float>"), "features")
    upper = np.triu_indices(size + 2)

    def squares(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        d = matrix(batch.column("x"), size + 2)
        return {"dd": (d.T @ d)[upper]}

    def full(part: np.ndarray) -> np.ndarray:
        a = np.zeros((size + 2, size + 2))
        a[upper] = part
        return a + np.triu(a, 1).T

    swaps = full(summed(seen.filter("y IS NULL"), squares, {"dd": (len(upper[0]),)})["dd"])
    held = RIDGE * np.eye(size + 2) + penalty * swaps
    held[0, 0] -= RIDGE * (1 - 1e-6)
    texts = seen.filter("y IS NOT NULL")
    weights = model.weights
    for _ in range(NEWTON_STEPS):

        def step(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
            x, y = matrix(batch.column("x"), size + 2), np.asarray(batch.column("y"))
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            return {"g": x.T @ (p - y), "h": ((x * (p * (1 - p))[:, None]).T @ x)[upper]}

        sums = summed(texts, step, {"g": (size + 2,), "h": (len(upper[0]),)})
        move = np.linalg.solve(full(sums["h"]) + held, sums["g"] + held @ weights)
        weights = weights - move * min(1, 20 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-3:
            break
    model.weights = weights
    return model
