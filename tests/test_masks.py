from pyspark.sql import functions as F

from tagreef.plans.jobs import search_catalog
from tagreef.sources.catalog import append_catalog, read_catalog, write_catalog_batch
from tagreef.sources.masks import BITS, catalog_files, char_mask, possible_rows, read_masks, write_masks

KIND = "path string, features string, binary string"


def test_mask_has_the_bits_of_its_characters(spark):
    texts = ["", None, "abc", "cab", "aab", "\u4f60\u597d\U0001f600"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    masks = [r[0] for r in rows.orderBy("k").select(char_mask(F.col("t"))).collect()]
    assert masks[0] == masks[1] == 0 and masks[2] == masks[3]
    assert masks[4] & masks[2] == masks[4] and 1 <= bin(masks[5] % 2**BITS).count("1") <= 3


def test_files_that_cannot_hold_a_keyword_are_not_read(spark, tmp_path):
    path = str(tmp_path / "c d+e")  # names that a scan escapes
    for k, tags in enumerate((["abc", "bcd"], ["xyz", None], ["\u4f60\u597d", "NoTag"])):
        rows = spark.createDataFrame([(f"{k}{t}", t, f"img{t}") for t in tags], KIND).coalesce(1)
        append_catalog(rows, path) if k else write_catalog_batch(rows, path, "run-1/batch-000000000000")
    found = lambda keyword: sorted(r[0] for r in search_catalog(spark, path, keyword).collect())
    before = {k: found(k) for k in ("bc", "xz", "\u597d", "q", " ", "%", "o_a", "")}
    assert len(catalog_files(possible_rows(spark, path, "xz"))) == 3
    assert write_masks(spark, path) == 3 and write_masks(spark, path) == 0
    assert {k: found(k) for k in before} == before
    files = {k: catalog_files(possible_rows(spark, path, k)) for k in ("bc", "xz", "\u597d", " ")}
    assert [len(files[k]) for k in ("bc", "xz", "\u597d", " ")] == [1, 1, 1, 3]
    # The scan of the plan names no other file.
    assert [f for f in catalog_files(search_catalog(spark, path, "xz"))] == files["xz"]
    # A file without a mask is read; then it gets one.
    append_catalog(spark.createDataFrame([("n", "xaz", "new")], KIND).coalesce(1), path)
    assert found("xz") == sorted([*before["xz"], "new"])
    assert write_masks(spark, path) == 1
    assert read_masks(spark, path).count() == len(catalog_files(read_catalog(spark, path))) == 4
    assert len(catalog_files(possible_rows(spark, path, "xz"))) == 2
