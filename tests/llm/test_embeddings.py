import numpy as np
import pyarrow as pa
import pytest
from brute import SF_DIR

from tagreef.llm import embeddings
from tagreef.llm.embeddings import bound, codes, near_vectors
from tagreef.llm.registry import QUERIES


def brute(rows, cosine=0.98):
    """(id, n_links, component, kept) of (id, vector, label) rows, all pairs."""
    unit = []
    for vec_id, v, label in rows:
        good = vec_id is not None and label is not None and v is not None and None not in v
        v = np.array(v, float) if good else np.zeros(0)
        good = good and len(v) and np.isfinite(v).all() and v.any()
        unit.append(v / np.linalg.norm(v) if good else None)
    linked = [set() for _ in rows]
    for i, u in enumerate(unit):
        for j in range(i):
            w = unit[j]
            if u is not None and w is not None and len(u) == len(w) and rows[i][2] == rows[j][2] and u @ w >= cosine:
                linked[i].add(j)
                linked[j].add(i)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for k in linked[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((vec_id, len(linked[i]), least, vec_id is None or least == vec_id))
    return sorted(out, key=str)


def ran(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_brute_force(spark):
    for sf_dir in (SF_DIR, SF_DIR.replace("0.001", "0.01")):
        rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
        got = ran(QUERIES["op9_embedding_near_dedup"](spark, sf_dir))
        assert got == brute(rows)


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("chunk", [8, 1024])
def test_large_groups(spark, monkeypatch, chunk):
    """Groups of near copies around the threshold, cut into blocks or not."""
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    rows = []
    for k, size in enumerate([64, 64, 32, 100]):
        center = rng.normal(size=size)
        for _ in range(120):
            v = center + rng.normal(size=size) * rng.choice([0.0, 0.02, 0.1, 0.14, 0.2])
            rows.append((int(rng.integers(1 << 40)), (v * rng.choice([1.0, 3.0])).tolist(), k % 2))
    got = ran(near_vectors(spark.createDataFrame(rows, SCHEMA)))
    want = brute(rows)
    # A pair at the very threshold may escape the bands (odds of 6e-5).
    assert sum(g[:2] == w[:2] for g, w in zip(got, want)) >= 0.99 * len(want)
    assert sum(g == w for g, w in zip(got, want)) >= 0.95 * len(want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [inf, 1.0], 0), (6, [nan, 1.0], 0),
        (7, [1.0, 2.0], None), (None, [1.0, 2.0], 0), (8, [1.0, 2.0], 0), (8, [1.0, 2.0], 0), (9, [2.0, 4.0], 0),
        (10, [1.0, 2.0], 1), (11, [-1.0, -2.0], 0), (12, [1e-300, 2e-300], 0), (13, [1e300, 2e300], 0),
        (14, [0.0, 1.0], -3), (15, [-0.0, 1.0], -3), (16, [1.0], 0), (17, [5.0], 0),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS class")
    got = ran(near_vectors(frame))
    assert len(got) == len(rows)
    by = {r[0]: r[1:] for r in got}
    for k in (1, 2, 3, 4, 5, 6, 7, 10, 11):
        assert by[k] == (0, k, True)
    assert by[None] == (0, None, True)
    assert by[8] == (4, 8, True) and by[9] == by[12] == by[13] == (4, 8, False)
    assert by[14] == (1, 14, True) and by[15] == (1, 14, False)
    assert by[16] == (1, 16, True) and by[17] == (1, 16, False)
    assert near_vectors(frame.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 64))
    y = x + rng.normal(size=x.shape) * 0.15
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    rotated, _, _ = codes(y)
    _, signs, factor = codes(x)
    near, true = (signs * rotated).sum(1) / factor, (x * y).sum(1)
    assert abs((near - true).mean()) < 0.002
    assert (near >= bound(factor, 64, rotated.shape[1], 0.97))[true >= 0.97].all()


def test_codes_alone_leave_no_near_pair_out():
    """Rows that the differing bits rule out have no partner at the threshold."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(300, 64))
    v = np.concatenate([centres, centres + rng.normal(size=centres.shape) * rng.choice([0.02, 0.13, 0.14, 1.0], (300, 1))])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    _, signs, factor = codes(unit)
    differing = ((signs[:300] > 0) != (signs[300:] > 0)).sum(1)
    true = (unit[:300] * unit[300:]).sum(1)
    # The share of differing bits estimates the angle without bias.
    assert abs((differing / signs.shape[1] - np.arccos(true) / np.pi).mean()) < 0.005
    n = len(v)
    rows = pa.table({
        "size": pa.array(np.full(n, 64)), "signs": pa.array([c.tobytes() for c in np.packbits(signs > 0, axis=1)]),
        "key": np.zeros(n, np.int64), "own": np.arange(n) % 2, "i": np.zeros(n, np.int64), "j": np.ones(n, np.int64),
    })
    for one_chunk in (False, True):
        if one_chunk:
            rows = rows.set_column(5, "j", pa.array(np.zeros(n, np.int64)))
        kept = embeddings.open_rows(rows, 0.98)
        near = unit @ unit.T >= 0.98
        near[np.arange(n), np.arange(n)] = False
        if not one_chunk:
            near &= (np.arange(n)[:, None] % 2) != (np.arange(n) % 2)
        assert kept[near.any(1)].all()
        assert kept.sum() < 0.9 * n


def test_vectors_travel_only_where_codes_leave_a_pair_open(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=64).tolist(), 0) for k in range(3000)] + [(5000 + k, [1.0 + k / 1e4] * 64, 1) for k in range(50)]
    seen = {}
    kept = embeddings.stored
    monkeypatch.setattr(embeddings, "stored", lambda df, name: seen.setdefault(name, kept(df, name)))
    found = ran(near_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert found == brute(rows)
    assert "vector" not in seen["undecided"].columns
    assert seen["undecided"].filter("id IS NOT NULL").select("id").distinct().count() < 300


def test_too_long_vectors_are_an_error(spark):
    rows = spark.createDataFrame([(1, [1.0] * 65536, 0)], SCHEMA)
    with pytest.raises(Exception, match="65536 parts"):
        near_vectors(rows).collect()
