import sys
from datetime import datetime

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tagreef.operators.repeats import payload_hashes
from tagreef.schema import CATALOG, REQUESTS
from tagreef.sources.catalog import append_catalog, read_catalog
from tagreef.sources.folders import stream_image_folder
from tagreef.streaming.streams import (
    batch_rows,
    ingest_lines,
    ingest_upload_stream,
    line_stream,
    preview,
    read_batches_of_text,
    save_batches_as_text,
    search_stream,
    slice_batches,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])
PNG = b"\x89PNG\r\n\x1a\n"


def send(folder, first, last):
    folder.mkdir(exist_ok=True)
    for i in range(first, last + 1):
        (folder / f"{i}.txt").write_text(f"base64xxxx{i}\n")


def test_lines_to_text_folders(spark, tmp_path):
    send(tmp_path / "in", 1, 5)

    def run():
        lines = line_stream(spark, "text", path=str(tmp_path / "in"), maxFilesPerTrigger="2")
        save_batches_as_text(
            lines, str(tmp_path / "out"), "lines", str(tmp_path / "ckpt"), once=True
        ).awaitTermination()
        return sorted(r[0] for r in read_batches_of_text(spark, f"{tmp_path}/out").collect())

    assert run() == [f"base64xxxx{i}" for i in range(1, 6)]
    assert sorted(p.name for p in tmp_path.glob("out-*")) == ["out-0", "out-10000", "out-5000"]
    assert run() == [f"base64xxxx{i}" for i in range(1, 6)]  # nothing doubled
    send(tmp_path / "in", 6, 6)
    assert len(run()) == 6


def test_lines_to_catalog(spark, tmp_path):
    send(tmp_path / "in", 1, 3)
    catalog = str(tmp_path / "c")
    append_catalog(spark.createDataFrame([("p", "cat", "u")], CATALOG), catalog)
    for _ in range(2):
        lines = line_stream(spark, "text", path=str(tmp_path / "in"))
        ingest_lines(lines, catalog, "lines", str(tmp_path / "ckpt"), once=True).awaitTermination()
    rows = read_catalog(spark, catalog).filter("path = 'fromStreaming'").collect()
    assert sorted(r["binary"] for r in rows) == ["base64xxxx1", "base64xxxx2", "base64xxxx3"]
    assert all(r["features"] is None for r in rows)


def test_preview_shows_the_head_of_each_batch(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    lines = [f"line {k:02d}" for k in range(25)]
    (tmp_path / "in" / "a.txt").write_text("".join(f"{line}\n" for line in lines))
    stream = line_stream(spark, "text", path=str(tmp_path / "in"))
    seen = []
    preview(stream, str(tmp_path / "c"), once=True, show=seen.append).awaitTermination()
    assert seen == lines[:10]
    (tmp_path / "in" / "b.txt").write_text("more\n")
    preview(stream, str(tmp_path / "c"), once=True).awaitTermination()
    assert capsys.readouterr().out.split("\n")[:1] == ["more"]


def reader():
    return lambda images, lang: [i[len(PNG):].decode() if lang == "eng" else "" for i in images]


def lose_commits(checkpoint):
    """Leave a checkpoint as a driver does that ends between a batch and its commit."""
    for file in (checkpoint / "commits").iterdir():
        file.unlink()


def test_a_replayed_batch_replaces_itself_only(spark, tmp_path):
    send(tmp_path / "in", 1, 3)
    catalog, checkpoint = str(tmp_path / "c"), tmp_path / "ckpt"

    def run(name, checkpoint):
        lines = line_stream(spark, "text", path=str(tmp_path / "in"))
        ingest_lines(lines, catalog, name, str(checkpoint), once=True).awaitTermination()
        return sorted(r["binary"][-1] for r in read_catalog(spark, catalog).collect())

    assert run("a", checkpoint) == ["1", "2", "3"]
    lose_commits(checkpoint)
    assert run("a", checkpoint) == ["1", "2", "3"]
    # Another stream, and the same one begun anew: nothing of the old is lost.
    assert run("b", tmp_path / "other") == ["1", "1", "2", "2", "3", "3"]
    send(tmp_path / "in", 4, 4)
    assert run("a", tmp_path / "anew") == sorted("123" * 3 + "4")
    with pytest.raises(Exception, match="stream name"):
        run("a/b", tmp_path / "bad")


def test_batches_on_a_clock(spark, tmp_path):
    """The usual trigger: batches go on until the stream is stopped."""
    send(tmp_path / "in", 1, 1)
    lines = line_stream(spark, "text", path=str(tmp_path / "in"))
    query = ingest_lines(lines, str(tmp_path / "c"), "lines", str(tmp_path / "ckpt"))
    assert query.lastProgress is None or query.isActive
    query.processAllAvailable()
    send(tmp_path / "in", 2, 2)
    query.processAllAvailable()
    query.stop()
    assert sorted(r["binary"] for r in read_catalog(spark, str(tmp_path / "c")).collect()) == [
        "base64xxxx1", "base64xxxx2",
    ]
    starts = [datetime.fromisoformat(p["timestamp"]).second for p in query.recentProgress if p["numInputRows"]]
    assert len(starts) == 2 and starts[-1] % 5 == 0


def test_upload_stream(spark, tmp_path):
    folder, catalog, hashes = tmp_path / "in", str(tmp_path / "c"), str(tmp_path / "h")
    folder.mkdir()
    held = spark.createDataFrame([("old.png", "old", "data:image/png;base64,iVBORw0KGgpPbGQ=")], CATALOG)
    append_catalog(held, catalog)
    payload_hashes(held).write.parquet(hashes)
    (folder / "a.png").write_bytes(PNG + b"One")
    (folder / "b.png").write_bytes(PNG + b"One")
    (folder / "c.txt").write_bytes(PNG)

    def run(checkpoint):
        ingest_upload_stream(
            stream_image_folder(spark, str(folder)), catalog, str(tmp_path / "no"), "uploads",
            str(tmp_path / checkpoint), reader, hashes_path=hashes, once=True,
        ).awaitTermination()
        rows = read_catalog(spark, catalog).filter("path <> 'old.png'").collect()
        return sorted((r["path"], r["features"]) for r in rows)

    assert run("ckpt") == [("a.png", "one")]
    # The same batch again, its commit lost: its own rows are no repeats.
    lose_commits(tmp_path / "ckpt")
    assert run("ckpt") == [("a.png", "one")]
    (folder / "d.png").write_bytes(PNG + b"Two")
    (folder / "e.png").write_bytes(PNG + b"One")
    assert run("ckpt") == [("a.png", "one"), ("d.png", "two")]
    # Begun anew, the stream finds every image there.
    assert run("anew") == [("a.png", "one"), ("d.png", "two")]
    refused = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "no"))
    assert [r["path"] for r in refused.collect()] == ["c.txt", "c.txt"]


def test_search_stream_sees_new_rows(spark, tmp_path):
    catalog, asked = str(tmp_path / "c"), str(tmp_path / "asked")
    append_catalog(spark.createDataFrame([("p", "cat", "u")], CATALOG), catalog)

    def ask(rows):
        spark.createDataFrame(rows, REQUESTS).coalesce(1).write.mode("append").parquet(asked)
        search_stream(
            spark.readStream.schema(REQUESTS).parquet(asked), catalog, str(tmp_path / "out"),
            "asked", str(tmp_path / "ckpt"), once=True,
        ).awaitTermination()
        answers = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out/requests")
        return {r["request_id"]: r["n_hits"] for r in answers.collect()}

    assert ask([(1, "ct"), (2, "ct"), (3, "dog"), (4, "")]) == {1: 2 - 1, 2: 1, 3: 0, 4: 0}
    append_catalog(spark.createDataFrame([("q", "hotdog", "v")], CATALOG), catalog)
    assert ask([(5, "Dog")]) == {1: 1, 2: 1, 3: 0, 4: 0, 5: 1}


def test_slices(spark):
    times = ["00:00:00", "00:00:04.9", "00:00:05", "00:00:09", "00:00:10", "00:00:14.999", "00:00:15"]
    rows = spark.createDataFrame([(f"2024-01-01 {t}", t) for t in times], "ts string, value string")
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    kept = slice_batches(rows, "2024-01-01 00:00:12", "2024-01-01 00:00:16")
    assert [(r["value"], str(r["batch"])) for r in kept.orderBy("ts").collect()] == [
        ("00:00:05", "2024-01-01 00:00:10"),
        ("00:00:09", "2024-01-01 00:00:10"),
        ("00:00:10", "2024-01-01 00:00:15"),
        ("00:00:14.999", "2024-01-01 00:00:15"),
    ]
    assert {str(r["batch"]) for r in batch_rows(rows).collect()} == {
        f"2024-01-01 00:00:{s}" for s in ("05", "10", "15", "20")
    }


def test_slice_bounds_reach_the_scan(spark, tmp_path):
    for kind in ("timestamp", "timestamp_ntz"):
        path = str(tmp_path / kind)
        spark.range(3).select(F.lit("2024-01-01 00:00:07").cast(kind).alias("ts")).write.parquet(path)
        kept = slice_batches(spark.read.parquet(path), "2024-01-01 00:00:12", "2024-01-01 00:00:16")
        assert kept.count() == 3
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
