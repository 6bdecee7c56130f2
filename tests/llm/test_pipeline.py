import re

import brute
import corpus_pipeline
from brute import SF_DIR

from tagreef.llm.registry import QUERIES
from test_pieces import library  # noqa: F401  (a fixture)


def without(text, gone):
    """The text less the bytes from the first to the last word of each removed run."""
    out, at, start = [], 0, None
    spans = [m.span() for m in brute.PLAIN.finditer(text)]
    for k, (a, b) in enumerate(spans):
        if gone[k] and start is None:
            start = a
        if gone[k] and (k + 1 == len(spans) or not gone[k + 1]):
            out.append(text[at:start])
            at, start = b, None
    return "".join([*out, text[at:]])


def test_run_equals_brute_force(spark, documents, library):  # noqa: F811
    texts = dict(documents)
    scores = {r.doc_id: r.score for r in QUERIES["op3_quality_classifier"](spark, SF_DIR).collect()}
    texts = {d: t for d, t in texts.items() if scores[d] >= 0.7}
    groups = brute.near_duplicates(texts.items(), 5, 80)
    texts = {d: t for d, t in texts.items() if groups[d][2]}
    cut = brute.repeats(texts.items())
    texts = {d: without(t, cut[d][1]) for d, t in texts.items()}
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
    found = brute.contamination(texts.items(), items)
    texts = {d: t for d, t in texts.items() if not found[d][-1]}

    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.text for r in rows} == texts
    assert len(rows) == len(texts) < len(documents)
    assert all(r.n_pieces == len(r.ids) and r.n_chars == len(r.text) for r in rows)
    assert all("▁" in r.text or r.ids == library.encode(r.text) for r in rows)


def test_stages_keep_columns_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "a b", "en", "s", 3), (None, "a b", "en", "s", 3), (1, None, None, None, None), (2, "", "en", "s", 0),
            (3, "x y", "en", "s", 3), (3, "x y", "en", "s", 3), (4, "x y", "en", "s", 3)]
    docs = spark.createDataFrame(rows, schema)
    kept = {name: f(spark, docs, SF_DIR) for name, f in corpus_pipeline.STAGES}
    for name, found in kept.items():
        assert found.columns[:5] == docs.columns, name
        assert found.schema[:5] == docs.schema[:5] if name != "SentencePiece encoding" else True
    ids = sorted((r.doc_id or 0 for r in kept["MinHash near-dedup"].collect()))
    assert ids == [0, 0, 1, 2, 3]
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, docs.limit(0), SF_DIR).count() == 0, name


def test_near_dedup_keeps_each_text_of_an_id(spark):
    """Only near copies go, not other texts under an id; of equal texts the least row stays."""
    near = " ".join(f"n{k}" for k in range(100))
    rows = [(3, "one text", "en", "s", 8), (3, "other words", "en", "s", 11), (3, "one text", "de", "s", 8),
            (7, near, "en", "s", 1), (7, near + " more", "en", "s", 1), (8, near, "en", "s", 1), (8, "free", "en", "s", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = [tuple(r) for r in dict(corpus_pipeline.STAGES)["MinHash near-dedup"](spark, docs, SF_DIR).collect()]
    assert sorted(r for r in found if r[0] != 7) == [rows[2], rows[1], rows[6]]
    assert [r[0] for r in found].count(7) == 1


SAID = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"


def test_stages_give_back_clashing_columns_and_long_texts(spark):
    """Columns called as the operators call theirs, a text of a million words, nulls, ties and repeats."""
    long = " ".join(f"w{k % 9973}x{k // 9973}" for k in range(300_000))
    rows = [
        (1, f"{SAID} a b c.", "en", "s", 9), (2, f"{SAID} d e f.", None, None, None), (3, None, "en", "s", 0),
        (4, "", "en", "s", 0), (5, long, "en", "s", 1), (6, "short", "en", "s", 5), (6, "short", "en", "s", 5),
        (None, SAID, "en", "s", 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = {"_score": 9.5, "score": 1.5, "n_words": 77, "n_removed": 78, "spans": "mine", "items": "own", "block": -1, "id": "i"}
    docs = docs.selectExpr("*", *(f"{v!r} AS {k}" for k, v in clash.items()))
    stages = dict(corpus_pipeline.STAGES)
    for name in list(stages)[:4]:
        found = stages[name](spark, docs, SF_DIR)
        assert found.columns == docs.columns, name
        rows_found = found.collect()
        assert all(tuple(r)[5:] == tuple(type(v)(r[k]) for k, v in clash.items()) for r in rows_found), name
        if name in ("substring dedup", "benchmark decontamination"):
            assert len(rows_found) == len(rows), name
    cut = {r.doc_id: (r.text, r.n_chars) for r in stages["substring dedup"](spark, docs, SF_DIR).collect()}
    assert cut[1] == (rows[0][1], 9) and cut[2] == (" d e f.", 7) and cut[5][0] == long and cut[3] == (None, 0)
    last = stages["SentencePiece encoding"](spark, docs.drop("n_words"), SF_DIR)
    assert last.columns[-2:] == ["ids", "n_pieces"]
    coded = {r.doc_id: r.n_pieces for r in last.collect()}
    assert coded[3] == coded[4] == 0 and coded[5] > 300_000


def test_quality_stage_without_labels_accepts_none(spark):
    docs = spark.createDataFrame([(-5, "x", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.quality(spark, docs, SF_DIR).count() == 0
