import pyarrow as pa
from pyspark.sql import functions as F

from tagreef.operators.extract import IMAGES_PER_CALL, detect_objects, label_reader, read_texts, text_reader


reader = lambda: lambda images, lang: [f"{lang} {image.decode()}" for image in images]
detector = lambda: lambda images: [[image.decode(), "image"] for image in images]


def test_results_go_back_list_by_list(spark):
    """Of a large batch no more than the results of one list are held."""
    taken, held = [], []

    def batches():
        for k in range(3):
            held.append(pa.total_allocated_bytes())
            taken.append(k)
            yield pa.array([b"%d" % n * 10_000 for n in range(2 * IMAGES_PER_CALL + 1)], pa.binary())

    for slot in (text_reader(reader), label_reader(detector)):
        taken.clear(), held.clear()
        sizes = []
        for results in slot.func(batches()):
            sizes.append(len(results))
            if len(sizes) == 3:
                assert taken == [0]
            del results
        assert sizes == [IMAGES_PER_CALL, IMAGES_PER_CALL, 1] * 3
        # A batch is let go before the next one comes.
        assert held[2] - held[1] < 500_000


def test_more_images_than_a_list(spark):
    n = 3 * IMAGES_PER_CALL + 5
    images = spark.range(n).coalesce(1).select(
        F.col("id").cast("string").alias("path"), F.encode(F.col("id").cast("string"), "UTF-8").alias("content")
    )
    read = read_texts(images, reader, "eng").collect()
    assert sorted(map(tuple, read)) == sorted((str(k), "eng", f"eng {k}", None) for k in range(n))
    found = detect_objects(images, detector).collect()
    assert sorted(map(tuple, found)) == sorted((str(k), p, x, None) for k in range(n) for p, x in ((0, str(k)), (1, "image")))


def test_odd_results(spark):
    """No image, no text and no labels; a failure is the one image's."""
    images = spark.createDataFrame([("a", None), ("b", b""), ("c", b"x")], "path string, content binary").coalesce(1)
    texts = read_texts(images, lambda: lambda images, lang: [None if not len(i) else i.decode() for i in images], "eng")
    a, b, c = sorted(map(tuple, texts.collect()))
    assert a[:3] == ("a", None, None) and a[3].startswith("TypeError")
    assert b == ("b", "eng", None, None) and c == ("c", "eng", "x", None)
    found = detect_objects(images, lambda: lambda images: [None if not len(i) else ["d"] for i in images])
    a, c = sorted(map(tuple, found.collect()), key=str)
    assert a[:3] == ("a", None, None) and a[3].startswith("TypeError") and c == ("c", 0, "d", None)
