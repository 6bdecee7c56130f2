import math
from collections import Counter

import numpy as np
import pytest
from brute import SF_DIR, plain
from pyspark.sql import functions as F

from tagreef.llm.registry import QUERIES
from tagreef.llm.rules import BUCKETS, COUNTS, RuleModel, apply_rules, fit_rules, minimised, ngrams, platt, sigmoid
from tagreef.llm.words import PLAIN, find_words


def counts(text):
    words = plain(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if plain(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, again, len(covered), failed


def test_base_of_the_query(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op12_quality_rules"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (*(r[c] for c in COUNTS), r.base_failed) == counts(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.probability >= 0.5)
    judged = [(r.probability >= 0.5) == (labels[r.doc_id] == 1) for r in rows if r.doc_id in labels and not r.base_failed]
    assert np.mean(judged) > 0.95


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a b\na b\n a b\na b"), (4, "a b\na b\n a b\na b"), (None, "é ü $$ #"),
    (5, "one two three four five six seven eight " * 3), (6, "w " * 100_000), (7, " ".join(map(str, range(300)))),
    (8, "\r\n".join(["x y z"] * 9)), (9, "日本 語 " * 12),
]


def test_odd_rows(spark, docs_of):
    docs = docs_of(ODD).selectExpr("doc_id", "text", "'mine' AS kept", "5 AS n_words", "'other' AS source")
    found = apply_rules(docs, RuleModel(np.zeros(BUCKETS + 1)))
    assert found.columns == ["doc_id", "text", "source", *COUNTS, "base_failed", "probability", "kept"]
    rows = found.collect()
    assert sorted((*(r[c] for c in COUNTS), r.base_failed) for r in rows) == sorted(counts(t) for _, t in ODD)
    # Without a model a probability is one half, which is kept.
    assert all(r.probability == 0.5 and r.kept == (not r.base_failed) for r in rows)
    assert apply_rules(docs.limit(0), RuleModel(np.zeros(BUCKETS + 1))).count() == 0


def test_held_out_accuracy_and_calibration(spark):
    """Fitted on the labels of half of the ids, right on the others'."""
    sf_dir = SF_DIR.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_rules(docs, labels, F.col("doc_id") % 2 == 0)
    known = {r.doc_id: r.quality for r in labels.filter("doc_id % 2 = 1 AND quality IS NOT NULL").collect()}
    rows = [(r.probability, known[r.doc_id]) for r in apply_rules(docs, model).collect() if r.doc_id in known]
    assert np.mean([(p >= 0.5) == y for p, y in rows]) > 0.9
    assert abs(np.mean([p for p, _ in rows]) - np.mean([y for _, y in rows])) < 0.08


def test_labels(spark, docs_of):
    docs = docs_of([(1, "good words"), (2, "bad $$"), (None, "x"), (3, None), (3, "")])
    for rows in ([], [(None, 1), (1, None)]):
        model = fit_rules(docs, spark.createDataFrame(rows, "doc_id long, quality int"), F.lit(True))
        assert not model.weights.any() and model.probabilities(np.zeros(1)) == 0.5
    one = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 1)], "doc_id long, quality int")
    assert all(r.probability > 0.5 for r in apply_rules(docs, fit_rules(docs, one, F.lit(True))).collect())


def test_ngrams_of_pieces_agree():
    texts = [b"", b"a", "ab é日本".encode(), b"x y z x y", b"  ", b"q"]
    raw, cuts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    owner, bucket, value = ngrams(raw, cuts, find_words(raw, cuts, PLAIN, False))
    for k, text in enumerate(texts):
        one, ends = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        _, b, v = ngrams(one, ends, find_words(one, ends, PLAIN, False))
        assert bucket[owner == k].tolist() == b.tolist()
        assert value[owner == k] == pytest.approx(v)
        assert not len(v) or math.isclose((v**2).sum(), 1)


def test_minimum_against_plain_steps():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(200, 5)), rng.integers(0, 2, 200)

    def loss(w):
        m = x @ w
        return np.logaddexp(0, np.where(y > 0, -m, m)).mean() + 0.05 * (w @ w), x.T @ (sigmoid(m) - y) / 200 + 0.1 * w

    w = np.zeros(5)
    for _ in range(5000):
        w = w - 0.5 * loss(w)[1]
    assert minimised(loss, np.zeros(5), 60) == pytest.approx(w, abs=1e-4)


def test_sigmoid_through_counts():
    at = np.array([-2.0, 0.0, 2.0])
    slope, shift = platt(at, np.array([1e6] * 3), 1e6 * sigmoid(0.7 * at + 0.3))
    assert (slope, shift) == (pytest.approx(0.7, abs=1e-3), pytest.approx(0.3, abs=1e-3))
    assert platt(at, np.array([9.0] * 3), np.array([9.0, 5.0, 0.0]))[0] == 0.0
