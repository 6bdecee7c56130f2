import os
import sys
from datetime import datetime

import pytest
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tagreef.functions.images import is_folder_image
from tagreef.functions.text import file_name
from tagreef.operators.search import search_request
from tagreef.plans.jobs import (
    hit_files,
    index_folder,
    list_folder,
    search_catalog,
    search_tag_files,
    store_uploads,
)
from tagreef.schema import CATALOG, TAG_FILE
from tagreef.sources import folders
from tagreef.sources.catalog import (
    append_catalog,
    compact_catalog,
    read_catalog,
    read_errors,
    union_catalogs,
    upload_rows,
    write_catalog_batch,
)
from tagreef.sources.folders import read_accounts, read_image_folder
from tagreef.sources.text_files import (
    read_image_list,
    read_tag_file,
    stamped_path,
    write_tag_file,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])
PNG = b"\x89PNG\r\n\x1a\n"


def reader():
    def read(images, lang):
        if any(b"broken" in image for image in images):
            raise ValueError("no text")
        return [image[len(PNG):].decode("utf-8") if lang == "eng" else "" for image in images]

    return read


def test_tag_file_rules(spark, tmp_path):
    (tmp_path / "a.txt").write_text(
        "Image|Tag|Base64\nx.png|hello|data:image/png;base64,AAA=\n"
        'y.png||data:image/png;base64,BBB=\nbad|only\nw|"quo|ted"|z|extra\n'
    )
    (tmp_path / "b.txt").write_text("Image|Tag|Base64\nv.png|world|u\n")
    rows = read_tag_file(spark, str(tmp_path))
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("bad", "only", None),
        ("v.png", "world", "u"),
        ("w", "quo|ted", "z"),
        ("x.png", "hello", "data:image/png;base64,AAA="),
        ("y.png", None, "data:image/png;base64,BBB="),
    ]
    found = search_tag_files(spark, str(tmp_path), "H O")
    assert [r[0] for r in found.collect()] == ["data:image/png;base64,AAA="]
    assert search_tag_files(spark, str(tmp_path), "").count() == 0


def test_stamped_path():
    when = datetime(2019, 4, 12, 20, 39, 19, 21146)
    assert stamped_path("/tags/", when) == "/tags/04122019203919021146.txt"


def test_written_tag_file_is_plain_text(spark, tmp_path):
    rows = spark.createDataFrame([("a b.png", 'say"hi"', "u"), (" c.png", "\\x,y", "v ")], TAG_FILE)
    write_tag_file(rows.coalesce(1), str(tmp_path / "t"))
    write_tag_file(rows.limit(1), str(tmp_path / "t"))
    files = [f.read_text() for f in (tmp_path / "t").glob("part-*")]
    assert sorted(files, key=len)[-1] == 'Image|Tag|Base64\na b.png|say"hi"|u\nc.png|\\x,y|v\n'
    assert read_tag_file(spark, str(tmp_path / "t")).count() == 3


def test_catalog_parts_and_compaction(spark, tmp_path):
    path = str(tmp_path / "c d%20ü+x=1")
    rows = spark.createDataFrame([("p", "cat", "u"), ("q", "dog", None)], CATALOG)
    append_catalog(rows, path)
    append_catalog(rows, path)
    for _ in range(2):  # a replayed batch
        write_catalog_batch(rows.limit(1), path, "lines-1/batch-3")
    assert read_catalog(spark, path).count() == 5
    compact_catalog(spark, path, str(tmp_path / "d"))
    assert sorted(map(str, read_catalog(spark, str(tmp_path / "d")).collect())) == sorted(
        map(str, read_catalog(spark, path).collect())
    )
    for keyword in ("ct", "zzz", "", "og"):
        plain = sorted(r[0] for r in search_request(read_catalog(spark, path), keyword).collect())
        assert sorted(r[0] for r in search_catalog(spark, path, keyword).collect()) == plain
    plan = hit_files(read_catalog(spark, path), "ct")._jdf.queryExecution().executedPlan().toString()
    assert "binary" not in plan
    assert union_catalogs(rows, rows.drop("features")).count() == 4


@pytest.fixture
def folder(tmp_path):
    images = tmp_path / "images"
    images.mkdir()
    (images / "a.png").write_bytes(PNG + "Hello World|\n".encode())
    (images / "b.PNG").write_bytes(PNG + b" \n")
    (images / "c.png.txt").write_bytes(PNG + b"Tab\tbed")
    (images / "d.jpg").write_bytes(PNG + b"broken")
    (images / "e.gif").write_bytes(b"no image")
    (images / "f.jpeg").write_bytes(PNG + b"x")
    (images / "sub").mkdir()
    (images / "sub" / "g.png").write_bytes(PNG + b"x")
    return images


def test_folder_scan(spark, folder):
    images, others = read_image_folder(spark, str(folder))
    assert sorted(r["name"] for r in images.collect()) == [
        "a.png", "b.PNG", "c.png.txt", "d.jpg", "e.gif",
    ]
    assert [r["name"] for r in others.collect()] == ["f.jpeg"]


def test_folder_is_listed_by_tasks(spark, tmp_path):
    """Many small files are few tasks, and the driver holds no listing."""
    images = tmp_path / "a b%20é"
    images.mkdir()
    for k in range(400):
        (images / f"{k}.png").write_bytes(PNG + b"%d" % k)
    found, others = read_image_folder(spark, str(images))
    assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    for files in (found, others):
        assert "FileScan" not in files._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == sorted((f"{k}.png", PNG + b"%d" % k) for k in range(400))
    assert others.count() == 0


def test_folder_packs_by_bytes(spark, tmp_path, monkeypatch):
    """More bytes are more tasks; a task reads large files one after the other."""
    monkeypatch.setattr(folders, "TASK_BYTES", 100_000)
    monkeypatch.setattr(folders, "HELD_BYTES", 1_000)
    for k in range(40):
        (tmp_path / f"{k}.png").write_bytes(b"%d" % k * 20_000)
    images, heads, _ = folders.open_image_folder(spark, str(tmp_path))
    assert images.rdd.getNumPartitions() > heads.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, images.collect())) == sorted((f"{k}.png", b"%d" % k * 20_000) for k in range(40))
    assert {r["name"]: bytes(r["content"]) for r in heads.collect()} == {f"{k}.png": (b"%d" % k * 12)[:12] for k in range(40)}


def test_folder_names_as_a_scan_takes_them(spark, tmp_path):
    """Hidden names, empty files, links, patterns and single files: as Spark's own scan has them."""
    for part in ("x1", "x2", "y"):
        (tmp_path / part).mkdir()
        for name in (".png", "_a.png", "_a=b.png", "_metadata.png", "a.png._COPYING_", "b c%20.PNG", f"{part}.gif", "é.txt", "|"):
            (tmp_path / part / name).write_bytes(f"{part} {name}".encode())
    (tmp_path / "y" / "empty.png").write_bytes(b"")
    (tmp_path / "y" / "link.png").symlink_to(tmp_path / "x1" / "x1.gif")
    (tmp_path / "y" / "sub.png").mkdir()
    (tmp_path / "none").mkdir()
    with open(os.fsencode(tmp_path) + b"/y/\xff.png", "wb") as file:
        file.write(b"no name")
    image = is_folder_image(F.col("name"))
    for place in ("y", "x*", "{x1,y}", "y/link.png", "y/_a.png", "none"):
        files = spark.read.format("binaryFile").load(str(tmp_path / place)).select(file_name(F.col("path")).alias("name"), "content")
        images, others = read_image_folder(spark, f"file:{tmp_path}/{place}")
        assert sorted(map(tuple, images.collect())) == sorted(map(tuple, files.filter(image).collect())), place
        assert sorted(map(tuple, others.collect())) == sorted(map(tuple, files.filter(~image).select("name").collect())), place
    with pytest.raises(AnalysisException):
        read_image_folder(spark, str(tmp_path / "missing"))


def detector():
    return lambda images: [["dog", "person"] if b"Hello" in image else [] for image in images]


def test_folder_index(spark, folder, tmp_path):
    left_out = index_folder(spark, str(folder), str(tmp_path / "t"), reader)
    assert sorted(r["name"] for r in left_out.collect()) == ["e.gif", "f.jpeg"]
    tags = {r["Image"]: r["Tag"] for r in read_tag_file(spark, str(tmp_path / "t")).collect()}
    assert tags == {"a.png": "helloworld", "b.PNG": "NoTag", "c.png.txt": "tab\tbed", "d.jpg": "NoTag"}


def test_folder_index_with_objects(spark, folder, tmp_path):
    words = spark.createDataFrame(
        [("en", "dog", "zh-CN", "狗")],
        "src_lang string, term string, dst_lang string, translation string",
    )
    index_folder(spark, str(folder), str(tmp_path / "t"), reader, detector, words)
    tags = {r["Image"]: r["Tag"] for r in read_tag_file(spark, str(tmp_path / "t")).collect()}
    assert tags["a.png"] == "helloworlddogperson狗" and tags["b.PNG"] == "NoTag"


def test_folder_list(spark, folder, tmp_path):
    list_folder(spark, str(folder), str(tmp_path / "l"))
    rows = read_image_list(spark, str(tmp_path / "l")).collect()
    assert sorted(r["file"] for r in rows) == ["a.png", "b.PNG", "c.png.txt", "d.jpg"]
    assert all(r["uri"].startswith("data:image/png;base64,") for r in rows)


def test_uploads(spark, tmp_path):
    uploads = upload_rows(
        spark,
        [("a.png", PNG + b"A\tb c"), ("b.GIF", PNG), ("c.png", b"?"), ("d.bmp", PNG + b"broken")],
    )
    refused = store_uploads(uploads, str(tmp_path / "c"), reader)
    assert sorted((r["path"], r["error"]) for r in refused.collect()) == [
        ("b.GIF", 1001), ("c.png", None),
    ]
    rows = read_catalog(spark, str(tmp_path / "c")).collect()
    assert sorted((r["path"], r["features"]) for r in rows) == [("a.png", "abc"), ("d.bmp", "NoTag")]
    assert [tuple(r) for r in read_errors(spark, str(tmp_path / "c")).collect()] == [
        ("d.bmp", "ValueError: no text")
    ]


def test_accounts_table(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, username string").write.parquet(str(tmp_path / "a"))
    assert [tuple(r) for r in read_accounts(spark, str(tmp_path / "a")).collect()] == [
        (1, "a", None, None)
    ]
