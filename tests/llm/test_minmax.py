import random

import brute
import numpy as np
from brute import SF_DIR

from tagreef.llm.minmax import PERMUTATIONS, near_duplicates, signatures
from tagreef.llm.registry import QUERIES


def rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_query_equals_brute_force(spark, documents):
    got = rows(QUERIES["op7_minhash_near_dedup"](spark, SF_DIR))
    assert got == brute.near_duplicates(documents, 3, 85)
    assert not all(x[-1] for x in got.values())


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def test_chains_and_large_groups(spark, docs_of):
    """Near copies of near copies: links that no least document of a band settles."""
    rng = random.Random(3)
    docs = []
    for group in range(6):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(60, 200))]
        text = " ".join(words)
        for step in range(12):
            docs.append((rng.randrange(10**9), text))
            text = edited(text.split(" "), rng, 1 + group % 3)
        docs += [(rng.randrange(10**9), edited(words, rng, rng.randrange(5))) for _ in range(25)]
    got = rows(near_duplicates(docs_of(docs)))
    assert got == brute.near_duplicates(docs, 5, 80)


def test_edges(spark, docs_of):
    docs = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One  TWO"), (6, "one two three"),
        (7, "a b c d e f"), (7, "a b c d e f"), (8, "a b c d e f"), (9, "x " * 20000), (10, "X " * 30000),
    ]
    frame = docs_of(docs).selectExpr("doc_id", "text", "1 AS id", "2 AS component", "'x' AS bands")
    got = rows(near_duplicates(frame))
    assert got == brute.near_duplicates(dict(docs).items(), 5, 80)
    null = rows(near_duplicates(docs_of([(None, "a b"), (None, "a b"), (1, "a b")])))
    assert null == {None: (1, None, True), 1: (1, 1, True)}
    assert near_duplicates(docs_of([(1, "a")]).limit(0)).count() == 0


def test_votes_are_unbiased():
    rng = np.random.default_rng(1)
    mine = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    other = np.concatenate([mine[:600], rng.integers(0, 1 << 63, 300, dtype=np.uint64)])
    signs = signatures(np.concatenate([mine, other]), np.array([0, 900, 1800]))
    agree = (signs[0] == signs[1]).mean()
    assert abs(agree - 0.5) < 3 * 0.5 / (2 * PERMUTATIONS) ** 0.5


def test_several_texts_of_one_id(spark, docs_of):
    """Every text of an id proposes links, whichever of its rows comes first."""
    rng = random.Random(5)
    a, b, c, d = ([f"{name}{k}" for k in range(120)] for name in "abcd")
    docs = [(50, " ".join(x)) for x in (a, b, c, d)] + [(50, " ".join(a))]
    docs += [(9, edited(a, rng, 2)), (60, edited(b, rng, 2)), (61, edited(c, rng, 2)), (62, edited(d, rng, 2))]
    docs += [(None, " ".join(a)), (63, "alone"), (63, None)]
    found = sorted(near_duplicates(docs_of(docs)).collect(), key=lambda r: (r[0] or 0, r[1]))
    want = {None: None, 9: 9, 50: 9, 60: 50, 61: 50, 62: 50, 63: 63}
    assert [(r.doc_id, r.component_id) for r in found] == [(k, want[k]) for k in sorted((x[0] for x in docs), key=lambda k: k or 0)]
    assert all(r.kept == (r.doc_id == r.component_id or r.doc_id is None) for r in found)
    assert [r.n_shingles for r in found if r.doc_id == 50] == [116] * 5
