import random

import pytest
from pyspark.sql import functions as F

from tagreef.operators.repeats import drop_repeats, is_new, payload_hashes
from tagreef.operators.sizes import broadcast_if_small
from tagreef.sources import piece_index


def rows(spark, values, schema):
    return spark.createDataFrame(values, schema)


@pytest.mark.parametrize("slice_bytes", [1 << 20, 300])
def test_is_new_equals_plain_containment(spark, slice_bytes):
    rng = random.Random(1)
    alphabet = "bkvAB27xyzäö中"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 300))) for _ in range(60)]
    boiler = "".join(rng.choices(alphabet, k=80))
    texts = [boiler + t if i % 3 == 0 else t for i, t in enumerate(texts)]
    payloads = {"", "b", "zz", "中ö", boiler, boiler[5:], "notthere" * 9, "k" * 40}
    for text in texts[:30]:
        start = rng.randint(0, max(0, len(text) - 1))
        payloads.add(text[start : start + rng.choice([1, 5, 24, 30, 100, 300])])
    index = rows(spark, [(t,) for t in texts] + [(None,)], "Base64 string")
    asked = rows(spark, [(p,) for p in payloads] * 2 + [(None,)], "payload string")
    found = {r["payload"]: (r["n_hits"], r["is_new"]) for r in
             is_new(index, asked, slice_bytes=slice_bytes).collect()}
    expected = {p: sum(p in t for t in texts) for p in payloads}
    assert found == {p: (n, n == 0) for p, n in expected.items()}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_a_stored_index_finds_the_same(spark, tmp_path, monkeypatch, limit):
    """Also where nothing is small enough to broadcast; repeated keys and null texts among the rows."""
    monkeypatch.setattr(piece_index, "broadcast_if_small", lambda t: broadcast_if_small(t, limit))
    rng = random.Random(2)
    texts = ["".join(rng.choices("bkvABCDEFGH0123456789xyz+/", k=rng.randint(0, 3000))) for _ in range(40)]
    boiler = "".join(rng.choices("bkvABC012xyz", k=900))
    texts += [boiler + t for t in texts[:15]] + [texts[3]]
    payloads = [t[n : n + size] for t in texts[:20] for n, size in ((0, 3000), (100, 1500), (5, 30))]
    payloads += [boiler, boiler[100:700], "gone" * 300, texts[4][:-1] + "!", "", "b"]
    index = rows(spark, [(f"p{k % 30}", t) for k, t in enumerate(texts)] + [(None, texts[5]), ("p1", None)], "path string, Base64 string")
    half = F.col("path") < "p2"
    path = str(tmp_path)
    piece_index.write_pieces(index.filter(half), path, "run-1/batch-000000000000", text="Base64")
    piece_index.write_pieces(index.filter(half), path, "run-1/batch-000000000000", text="Base64")
    piece_index.write_pieces(index.filter(~F.coalesce(half, F.lit(False))), path, text="Base64")
    asked = rows(spark, [(p,) for p in payloads] + [(None,)], "payload string")
    pieces = piece_index.read_pieces(spark, path)
    found = {r["payload"]: r["n_hits"] for r in is_new(index, asked, pieces=pieces).collect()}
    held = [*texts, texts[5]]
    assert found == {p: sum(p in t for t in held) for p in payloads}
    assert sum(n == 0 for n in found.values()) >= 2


def test_images_are_scanned_once_for_long_payloads(spark, tmp_path):
    rng = random.Random(3)
    texts = ["".join(rng.choices("bkvABCDEFGH0123456789xyz+/", k=4000)) for _ in range(30)]
    rows(spark, [(str(k), t) for k, t in enumerate(texts)], "path string, binary string").write.parquet(f"{tmp_path}/c")
    index = spark.read.parquet(f"{tmp_path}/c")
    piece_index.write_pieces(index, f"{tmp_path}/p")
    asked = rows(spark, [(t[500:3500],) for t in texts], "payload string")
    found, short = piece_index.containing_images(index, piece_index.read_pieces(spark, f"{tmp_path}/p"), asked)
    assert found.count() == 30 and short.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "NestedLoop" not in plan
    assert "hashpartitioning(image" not in plan  # the images stay where they are


def test_is_new_without_hits_or_payloads(spark):
    index = rows(spark, [("abc",)], "Base64 string")
    asked = rows(spark, [("zzz",)], "payload string")
    assert [tuple(r) for r in is_new(index, asked).collect()] == [("zzz", 0, True)]
    assert is_new(index, asked.limit(0)).count() == 0


URI = "data:image/png;base64,"
BATCH = [
    ("p2", "f", URI + "AAAA"), ("p1", "f", URI + "AAAA"), ("p1", "f", URI + "AAAA"),
    ("p3", "f", URI + "BBBBCCCC"), ("p4", "f", URI + "CCCC"), ("p5", "f", URI + "DDDD"),
]
HELD = [("h1", "f", URI + "DDDD"), ("h2", "f", URI + "XXCCCCXX"), ("h3", None, None)]
SCHEMA = "path string, features string, binary string"


@pytest.mark.parametrize(
    "how, expected", [("hash", ["p1", "p3", "p4"]), ("exact", ["p1", "p3"])]
)
def test_drop_repeats(spark, how, expected):
    batch, held = rows(spark, BATCH, SCHEMA), rows(spark, HELD, SCHEMA)
    kept = drop_repeats(batch, held, how)
    assert kept.columns == batch.columns
    assert sorted(r["path"] for r in kept.collect()) == expected
    if how == "hash":
        by_index = drop_repeats(batch, payload_hashes(held))
        assert sorted(r["path"] for r in by_index.collect()) == expected


def test_drop_repeats_on_empty_catalog(spark):
    batch, held = rows(spark, BATCH, SCHEMA), rows(spark, HELD, SCHEMA).limit(0)
    for how in ("hash", "exact"):
        assert drop_repeats(batch, held, how).count() == 4
    with pytest.raises(ValueError):
        drop_repeats(batch, held, "guess")


def test_no_nested_loop(spark):
    index = spark.range(100).select(F.col("id").cast("string").alias("Base64"))
    asked = spark.range(10).select(F.col("id").cast("string").alias("payload"))
    plan = is_new(index, asked)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("how", ["hash", "exact"])
def test_rows_without_an_image_stay(spark, how):
    rows = [("a", None), ("b", None), ("c", "data:image/png;base64,QUJD"), ("d", "data:image/png;base64,QUJD")]
    batch = spark.createDataFrame([(p, "f", b) for p, b in rows], "path string, features string, binary string")
    kept = drop_repeats(batch, batch.limit(0), how)
    assert sorted(r["path"] for r in kept.collect()) == ["a", "b", "c"]
    held = batch.filter("path = 'd'")
    assert sorted(r["path"] for r in drop_repeats(batch, held, how).collect()) == ["a", "b"]


def test_images_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.range(50).selectExpr("string(id) AS path", "'f' AS features", "concat('data:x,', id % 40) AS binary").write.parquet(path)
    batch = spark.read.parquet(path)
    kept = drop_repeats(batch, batch.limit(0))
    assert kept.count() == 40
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
