"""Slots for the text reader and the object detector of a user.

Both are Arrow UDFs over the image column. The image stays in the row on the
JVM side and only the result comes back, so nothing is shuffled or joined to put
text and image together again. A slot takes a *factory*: it is called once per
task, where it loads the model, and returns the function for a list of images.
When that fails for a list, it is called again for each image alone, so that a
failure is the one image's, and is told in ``error``.

Image rows are big: an Arrow batch of them is bounded by
``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB unless set), and a list has
``IMAGES_PER_CALL`` images at most. The results of a list go back before the next
list is taken, so a task holds one Arrow batch and the results of one list.
"""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagreef.functions.text import strip_tag
from tagreef.operators.labels import LANGUAGES

TextReader = Callable[[list[bytes], str], list[str]]
Detector = Callable[[list[bytes]], list[list[str]]]

IMAGES_PER_CALL = 64


def _each(call: Callable[[list[bytes]], list], images: list[bytes]) -> list[tuple[object, str | None]]:
    """(result, error) of each image."""
    try:
        results = list(call(images))
        if len(results) != len(images):
            raise ValueError(f"{len(results)} results for {len(images)} images")
        return [(result, None) for result in results]
    except Exception as failure:  # any failure of a user's function
        if len(images) == 1:
            return [(None, f"{type(failure).__name__}: {failure}")]
    return [one for image in images for one in _each(call, [image])]


def _lists(batches: Iterator[pa.Array]) -> Iterator[list[bytes]]:
    """The images of all batches in lists; a batch is let go before the next one comes."""
    for images in batches:
        for low in range(0, len(images), IMAGES_PER_CALL):
            yield images.slice(low, IMAGES_PER_CALL).to_pylist()
        del images


def text_reader(
    factory: Callable[[], TextReader], language: str = "all"
) -> Callable[[str], Column]:
    """UDF giving ``struct<texts: array<struct<lang, text>>, error>`` of an image.

    Languages are read in order. A failure ends the reading of that image, keeps
    the texts before it and sets ``error``; other images are not affected.
    """
    languages = LANGUAGES if language == "all" else (language,)

    @F.arrow_udf("texts array<struct<lang string, text string>>, error string")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = factory()
        text = pa.struct({"lang": pa.string(), "text": pa.string()})
        for images in _lists(batches):
            yield _results(_read_all(reader, images, languages), "texts", pa.list_(text))

    return read


def _results(rows: list[tuple[list, str | None]], name: str, kind: pa.DataType) -> pa.Array:
    """(result, error) rows as the structs that a slot returns."""
    results, errors = (list(column) for column in zip(*rows))
    return pa.StructArray.from_arrays([pa.array(results, kind), pa.array(errors, pa.string())], [name, "error"])


def _read_all(
    reader: TextReader, images: list[bytes], languages: tuple[str, ...]
) -> list[tuple[list, str | None]]:
    texts: list[list] = [[] for _ in images]
    errors: list[str | None] = [None] * len(images)
    for lang in languages:
        live = [k for k, error in enumerate(errors) if error is None]
        if live:
            for k, (text, error) in zip(live, _each(lambda part: reader(part, lang), [images[k] for k in live])):
                errors[k] = error
                if error is None:
                    texts[k].append({"lang": lang, "text": text})
    return list(zip(texts, errors))


def joined_text(read: Column) -> Column:
    """The texts of one :func:`text_reader` result in order, without separators."""
    return strip_tag(F.array_join(F.transform(read["texts"], lambda t: t["text"]), ""))


def label_reader(factory: Callable[[], Detector]) -> Callable[[str], Column]:
    """UDF giving ``struct<labels: array<string>, error>`` of an image, labels in order."""

    @F.arrow_udf("labels array<string>, error string")
    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        detector = factory()
        for images in _lists(batches):
            rows = [(list(labels or []), error) for labels, error in _each(detector, images)]
            yield _results(rows, "labels", pa.list_(pa.string()))

    return detect


def read_texts(
    images: DataFrame, factory: Callable[[], TextReader], language: str = "all"
) -> DataFrame:
    """``(path, lang, text, error)``: one row per text read from ``(path, content)`` images.

    An image whose first text fails has one row with NULL text and the error.
    """
    read = text_reader(factory, language)
    rows = images.select("path", read("content").alias("_read"))
    rows = rows.select("path", F.explode_outer("_read.texts").alias("_text"), "_read.error")
    return rows.select("path", "_text.lang", "_text.text", "error")


def detect_objects(images: DataFrame, factory: Callable[[], Detector]) -> DataFrame:
    """``(path, pos, name, error)``: the labels of ``(path, content)`` images, in order.

    An image without labels has no row; one whose detection failed has a row with
    the error and no label.
    """
    detect = label_reader(factory)
    found = images.select("path", detect("content").alias("_found"))
    rows = found.select("path", F.posexplode_outer("_found.labels").alias("pos", "name"), "_found.error")
    return rows.filter(F.col("name").isNotNull() | F.col("error").isNotNull())
