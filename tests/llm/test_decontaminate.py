import brute
import pytest
from brute import SF_DIR

from tagreef.llm import decontaminate as module
from tagreef.llm.registry import QUERIES

ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"


def rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_query_equals_brute_force(spark, documents):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
    got = rows(QUERIES["op8_benchmark_decontamination"](spark, SF_DIR))
    assert got == brute.contamination(documents, items)
    assert any(x[-1] for x in got.values())


@pytest.mark.parametrize("slice_bytes", [10, 1 << 20])
def test_slices_agree(spark, docs_of, slice_bytes):
    items = [(1, ITEM), (2, "just three words"), (3, None), (4, "--"), (5, ITEM.upper()), (None, ITEM)]
    docs = [
        (1, f"x {ITEM.upper()}, y"), (2, "so just; three-words here"), (3, None), (4, ""), (None, ITEM),
        (6, "a " * 5000 + ITEM), (6, "a " * 5000 + ITEM), (7, "alpha beta gamma"),
    ]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = module.find_benchmark_spans(docs_of(docs), frame, slice_bytes=slice_bytes)
    got = [(r.doc_id, r.n_words, r.spans, r["items"]) for r in found.collect()]
    expected = [
        (1, 17, [[1, 16]], [1, 5]), (2, 5, [[1, 4]], [2]), (3, 0, [], []), (4, 0, [], []),
        (None, 15, [[0, 15]], [1, 5]), (6, 5015, [[5000, 5015]], [1, 5]),
        (6, 5015, [[5000, 5015]], [1, 5]), (7, 3, [], []),
    ]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_removal(spark, docs_of):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = docs_of([(1, f"É x! {ITEM}. Z"), (2, "clean"), (3, None), (4, "w " * 4000 + ITEM)])
    kept = rows(module.decontaminate(docs, items))
    assert sorted(kept) == [2, 3, 4]
    cut = rows(module.decontaminate(docs, items, remove="spans"))
    assert cut == {1: ("É x! . Z",), 2: ("clean",), 3: (None,), 4: ("w " * 4000,)}


def test_empty_tables_and_clashing_columns(spark, docs_of):
    items = spark.createDataFrame([], "item_id long, text string")
    docs = docs_of([(1, "a b")]).selectExpr("doc_id", "text", "'q' AS items", "1 AS n_words")
    found = module.find_benchmark_spans(docs, items)
    assert [(r.doc_id, r.n_words, r.spans, r["items"]) for r in found.collect()] == [(1, 2, [], [])]
    assert module.find_benchmark_spans(docs.limit(0), items).count() == 0


def test_table_is_bounded_by_the_text():
    """Bytes of the table, for ordinary words and for the shortest there are."""
    for text in (ITEM * 300, "a " * 20_000, "x y z " * 9000):
        grams = module.Grams([(k, f"{k} {text}") for k in range(3)], 13)
        assert grams.nbytes <= 17 * 3 * (len(text) + 2) + 64


def test_own_columns_come_back(spark, docs_of):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = docs_of([(1, ITEM), (2, "clean")]).selectExpr("doc_id", "text", "'mine' AS items", "77 AS n_words", "9.5 AS spans")
    for how in ("documents", "spans"):
        kept = module.decontaminate(docs, items, remove=how)
        assert kept.columns == docs.columns
        assert {tuple(r)[2:] for r in kept.collect()} == {("mine", 77, 9.5)}
