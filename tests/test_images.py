import base64

from pyspark.sql import functions as F

from tagreef.functions import images
from tagreef.operators.rename import rename_plan

NAMES = [
    "a.png", "a.PNG", "a.Png", "a.GIF", "a.jpeg", "a.bmp", "a.png.txt", "png", "a", ".png", "a.tar.gz",
]


def kept(spark, test):
    rows = spark.createDataFrame([(n,) for n in NAMES], "name string")
    return [r[0] for r in rows.filter(test(F.col("name"))).collect()]


def test_name_filters(spark):
    assert kept(spark, images.is_folder_image) == [
        "a.png", "a.PNG", "a.Png", "a.GIF", "a.png.txt", ".png",
    ]
    assert kept(spark, images.is_upload_allowed) == ["a.png", "a.PNG", "a.jpeg", "a.bmp", ".png"]
    assert kept(spark, lambda c: images.is_upload_allowed(c, images.OLD_UPLOAD_EXTENSIONS)) == [
        "a.png", "a.PNG", "a.bmp", ".png",
    ]
    assert kept(spark, images.is_rename_image) == ["a.png", "a.png.txt", ".png"]


HEADS = [
    (b"\x89PNG\r\n\x1a\n" + b"x" * 90, "png"),
    (b"\xff\xd8\xff\xe0\x00\x10JFIF\x00", "jpeg"),
    (b"\xff\xd8\xff\xe1\x00\x10Exif\x00", "jpeg"),
    (b"\xff\xd8\xff\xdb", "jpeg"),
    (b"GIF87a", "gif"),
    (b"GIF89a", "gif"),
    (b"BM", "bmp"),
    (b"II*\x00", "tiff"),
    (b"MM\x00*", "tiff"),
    (b"RIFF\x00\x00\x00\x00WEBP", "webp"),
    (b"RIFF\x00\x00\x00\x00WAVE", None),
    (b"\x01\xda", "rgb"),
    (b"P4\n", "pbm"),
    (b"P5 ", "pgm"),
    (b"P6\t", "ppm"),
    (b"P7\n", None),
    (b"\x59\xa6\x6a\x95", "rast"),
    (b"#define x", "xbm"),
    (b"\x76\x2f\x31\x01", "exr"),
    (b"text", None),
    (b"", None),
]


def test_image_types(spark):
    rows = spark.createDataFrame(HEADS, "content binary, kind string")
    assert [r[0] for r in rows.select(images.image_type(F.col("content"))).collect()] == [
        kind for _, kind in HEADS
    ]


def test_data_uri_is_one_line(spark):
    content = HEADS[0][0]
    rows = spark.createDataFrame([(content,)], "content binary")
    for chunked in ("true", "false"):
        spark.conf.set("spark.sql.chunkBase64String.enabled", chunked)
        try:
            uri = images.data_uri(F.col("content"))
            row = rows.select(
                uri, images.uri_payload(uri), images.from_b64(images.uri_payload(uri))
            ).first()
        finally:
            spark.conf.unset("spark.sql.chunkBase64String.enabled")
        payload = base64.b64encode(content).decode()
        assert row[0] == f"data:image/png;base64,{payload}"
        assert row[1] == payload and bytes(row[2]) == content


def test_record_line(spark):
    row = spark.createDataFrame([(" a", "b\u3000", None)], "a string, b string, c string")
    assert row.select(images.record_line(F.col("a"), F.col("b"))).first()[0] == "a|b"


def test_rename_plan(spark):
    files = spark.createDataFrame([("b.jpg",), ("a.png",), ("c.txt",)], "name string")
    plan = rename_plan(files, "20190412203919021146")
    assert sorted(tuple(r) for r in plan.collect()) == [
        ("a.png", "20190412203919021146.png"),
        ("b.jpg", "20190412203919021145.jpg"),
    ]
