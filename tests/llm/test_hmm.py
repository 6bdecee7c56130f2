import itertools

import brute
import numpy as np
import pytest
from brute import SF_DIR

from pyspark.sql import functions as F

from tagreef.llm import hmm
from tagreef.llm.hmm import CLASSES, HiddenMarkov, Sequences, score_texts
from tagreef.llm.registry import QUERIES


def test_query_against_brute_force(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op2_lm_scoring"](spark, SF_DIR).collect()}
    for doc_id, want in brute.base_scores(documents).items():
        r = got.pop(doc_id)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4]
        assert r.base_score == pytest.approx(want[4], rel=1e-9)
        assert r.score < 0
    assert not got


def test_better_than_base_on_held_out_texts(spark):
    rows = QUERIES["op2_lm_scoring"](spark, SF_DIR.replace("0.001", "0.01")).collect()
    held = [r for r in rows if r.held_out]
    n = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / n > sum(r.base_score for r in held) / n + 0.03


def small_model(rng, states=3):
    def shares(*shape):
        a = rng.random(shape) + 0.1
        return a / a.sum(-1, keepdims=True)

    return HiddenMarkov(shares(states), shares(states, states), shares(states, CLASSES).T.copy())


def paths(model, seq):
    """Probability of every state path with the sequence."""
    for path in itertools.product(range(len(model.initial)), repeat=len(seq)):
        p = model.initial[path[0]] * model.emissions[seq[0], path[0]]
        for t in range(1, len(seq)):
            p *= model.moves[path[t - 1], path[t]] * model.emissions[seq[t], path[t]]
        yield path, p


def test_forward_and_expected_counts_by_enumeration():
    rng = np.random.default_rng(5)
    model = small_model(rng)
    seqs = [rng.integers(0, 4, n).astype(np.int16) for n in (3, 1, 5, 2, 5)]
    laid = Sequences.of([s.tobytes() for s in seqs])
    total, _, _ = model.forward(laid, False)
    initial, moves, emissions = np.zeros(3), np.zeros((3, 3)), np.zeros((CLASSES, 3))
    for lane, k in enumerate(laid.order):
        all_paths = list(paths(model, seqs[k]))
        whole = sum(p for _, p in all_paths)
        assert total[lane] == pytest.approx(np.log10(whole))
        for path, p in all_paths:
            initial[path[0]] += p / whole
            for t, s in enumerate(path):
                emissions[seqs[k][t], s] += p / whole
                if t:
                    moves[path[t - 1], s] += p / whole
    got = model.expected(laid)
    assert got["initial"] == pytest.approx(initial, rel=1e-4)
    assert got["moves"] == pytest.approx(moves, rel=1e-4)
    assert got["emissions"] == pytest.approx(emissions, rel=1e-4)


def test_steps_raise_the_likelihood(spark, docs_of, monkeypatch):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(300):
        words = rng.choice([f"a{i}" for i in range(30)] if k % 2 else [f"b{i}" for i in range(30)], 40)
        rows.append((k, " ".join(words)))
    seen = []
    monkeypatch.setattr(hmm, "train", lambda *a: seen.append(kept(*a)) or seen[-1])
    got = score_texts(docs_of(rows), F.col("doc_id") % 5 == 1, steps=6).collect()
    log = seen[0].log
    assert all(b > a for a, b in zip(log, log[1:]))
    # Half the words are out of the question once the state is known.
    gain = np.mean([(r.score - r.base_score) / r.n_tokens for r in got if r.held_out])
    assert gain > 0.2


kept = hmm.train


def test_edges(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "A a b"), (3, "A a b"), (None, "q"), (6, "w " * 30000)])
    frame = docs.selectExpr("doc_id", "text", "1 AS row", "2 AS id", "true AS held_out")
    none = score_texts(frame, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in none)
    got = score_texts(frame, F.col("doc_id") == 6).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [len(by[k]) for k in (1, 2, 3, None, 6)] == [1, 1, 2, 1, 1]
    assert by[1][0].n_tokens == by[2][0].n_tokens == 1
    assert by[3][0].train_tokens == 12 and by[3][0].n_known == 4
    assert by[3][0].base_score == pytest.approx(np.log10(np.array([4.5, 4.5, 2.5, 5.5]) / (12 + 0.5 * 5)).sum())
    assert by[6][0].n_tokens == 30001 and by[6][0].n_known == 1 and np.isfinite(by[6][0].score)
    assert score_texts(docs.limit(0), F.lit(False)).count() == 0
