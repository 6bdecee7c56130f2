import random

import brute
import pytest
from brute import SF_DIR

from tagreef.llm.registry import QUERIES
from tagreef.llm.repeats import remove_repeats


def expected(docs, size=20):
    return {
        doc_id: (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
        for doc_id, (words, gone) in brute.repeats(docs, size).items()
    }


def rows(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.text) for r in df.collect()}


def test_query_equals_brute_force(spark, documents):
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op1_substring_dedup"](spark, SF_DIR).collect()}
    want = {k: (n, gone, brute.sha(kept)) for k, (n, gone, kept) in expected(documents).items()}
    assert got == want
    assert sum(x[1] > 0 for x in got.values()) > 5


@pytest.mark.parametrize("words", [3, 40])
def test_overlapping_passages(spark, docs_of, words):
    """Pieces of a few texts over a small vocabulary: nested, shifted, periodic."""
    rng = random.Random(words)
    pool = [[f"v{rng.randrange(words)}" for _ in range(rng.randrange(15, 90))] for _ in range(8)]
    docs = []
    for k in range(60):
        text = []
        for _ in range(rng.randrange(1, 6)):
            piece = rng.choice(pool)
            a = rng.randrange(len(piece))
            text += piece[a : a + rng.randrange(1, 80)]
        docs.append((rng.randrange(10**9), " \n".join(text)))
    docs.append((5, "ab cd " * 300))
    docs.append((6, "cd ab " * 300))
    assert rows(remove_repeats(docs_of(docs), form="words")) == expected(docs)
    assert rows(remove_repeats(docs_of(docs), size=7, form="words")) == expected(docs, 7)


def test_text_form_and_edges(spark, docs_of):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = [
        (1, f"é {passage} q"), (2, f"z\n {passage}\tend "), (3, None), (4, ""), (5, "short"), (None, passage),
        (None, passage), (7, "w " * 20000 + passage), (8, passage), (8, passage),
    ]
    frame = docs_of(docs).selectExpr("doc_id", "text", "'s' AS source", "1 AS block", "2 AS n_words")
    got = remove_repeats(frame)
    assert got.columns == ["doc_id", "text", "source", "block", "n_words", "n_removed", "spans"]
    found = sorted(
        ((r.doc_id, r.text, r.n_words, r.n_removed, r.source, r.block) for r in got.collect()),
        key=lambda r: (r[0] is None, r[0] or 0),
    )
    assert [r[:4] for r in found if r[0] != 7] == [
        (1, f"é {passage} q", 22, 0), (2, "z\n \tend ", 22, 20), (3, None, 0, 0), (4, "", 0, 0),
        (5, "short", 1, 0), (8, "", 20, 20), (8, "", 20, 20), (None, passage, 20, 0), (None, passage, 20, 0),
    ]
    assert next(r[2:4] for r in found if r[0] == 7) == (20020, 20019)
    assert all(r[4:] == ("s", 1) for r in found)
    assert remove_repeats(docs_of(docs).limit(0)).count() == 0


@pytest.mark.parametrize("length", [60, 100, 300])
def test_third_copy_of_a_part(spark, docs_of, length):
    """The second copy asks for more than the third holds: W P X Q W P X R V P Y."""

    def fresh(name, n):
        return [f"{name}{k}" for k in range(n)]

    docs = []
    for doc_id, shift in ((1, 0), (2, 17), (3, 41)):
        own = f"d{doc_id}"
        w, p, x = fresh(own + "w", 30 + shift), fresh(own + "p", length), fresh(own + "x", 30)
        text = w + p + x + fresh(own + "q", 25) + w + p + x + fresh(own + "r", 25)
        docs.append((doc_id, " ".join(text + fresh(own + "v", 30) + p + fresh(own + "y", 30))))
    # Later copies in another document: a whole one, then twice the shared part.
    docs.append((4, " ".join(text + fresh("a", 25) + p + fresh("b", 25) + p + fresh("c", 25) + p)))
    found = expected(docs)
    assert all(found[doc_id][1] >= 2 * length + 60 for doc_id in (1, 2, 3))
    assert rows(remove_repeats(docs_of(docs), form="words")) == found
