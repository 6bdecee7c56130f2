import random

import numpy as np
import pyarrow as pa
import pytest
from brute import SF_DIR, rest

from pyspark.sql import functions as F

from tagreef.llm.registry import QUERIES
from tagreef.llm.toxicity import BUCKETS, fit_toxicity, present, swapped, word_features
from tagreef.llm.words import ALNUM, word_pieces


def test_held_out_accuracy(spark):
    sf_dir = SF_DIR.replace("0.001", "0.1")
    rows = QUERIES["op10_toxicity"](spark, sf_dir).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == 10_000
    assert all(r.held_out == (rest(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    found = [p for p, y in held if y]
    false = [p for p, y in held if not y]
    assert np.mean(found) > 0.8
    assert np.mean(false) < 0.01


@pytest.fixture(scope="module")
def biased(spark):
    """Insults are toxic; one group is named mostly where there are insults."""
    rng = random.Random(2)
    filler = [f"word{k}" for k in range(200)]
    rows = []
    for k in range(1500):
        toxic = k % 4 == 0
        words = rng.choices(filler, k=20)
        words.append(rng.choice(["muslim", "muslim", "muslim", "christian"] if toxic else ["christian"] * 9 + ["muslim"]))
        if toxic and rng.random() < 0.8:
            words[0] = rng.choice(["dreckig", "vile", "nasty"])
        rng.shuffle(words)
        rows.append((k, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "toxic")


def test_neutral_mentions(biased, docs_of):
    docs, labels = biased
    rest = " ".join(f"word{k}" for k in range(3, 22))
    neutral = docs_of([(k, f"{two} {rest}") for k, two in enumerate(("a muslim", "a christian", "vile muslim"), 1)])
    gap = {}
    for penalty in (0.0, 5.0):
        model = fit_toxicity(docs, labels, F.lit(True), penalty=penalty)
        scores = {r.doc_id: r.score for r in model.score(neutral).collect()}
        gap[penalty] = scores[1] - scores[2]
        assert scores[3] > 0.5
    assert gap[0.0] > 0.2
    assert abs(gap[5.0]) < 0.1 * gap[0.0]
    assert scores[1] < 0.5


def test_twins_differ_by_the_swapped_terms_only():
    places = np.full(BUCKETS, -1, np.int32)
    (words,) = [w for _, _, w in word_pieces(pa.array(["a women men x", "none here", "Muslim muslims"]), ALNUM, True)]
    _, buckets = word_features(words)
    buckets = np.unique(buckets)
    places[buckets] = np.arange(len(buckets))
    held, change = present(words, places, len(buckets)), swapped(words, places, len(buckets))
    assert held.shape[0] == 3 and len(change) == 2
    # Women and men swap places; the twin of the third text has terms of no place.
    assert not change[0, :2].any()
    assert change[0].sum() == 0
    assert (change[1, 2:] == held[2, 2:]).all()


def test_edges(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "men " * 50000)])
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = fit_toxicity(docs, none, F.lit(True))
    assert [r.score for r in model.score(docs.withColumn("score", F.lit(7))).collect()] == [0.5] * 6
    some = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1), (4, 0)], "doc_id long, toxic int")
    scored = fit_toxicity(docs, some, F.lit(True)).score(docs).collect()
    assert len(scored) == 6 and all(0 <= r.score <= 1 for r in scored)
    assert model.score(docs.limit(0)).count() == 0
