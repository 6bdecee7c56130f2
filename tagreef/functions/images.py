"""Image types, data URIs, record lines and file name filters."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagreef.functions.text import last_ext, trim_space

# The leading bytes (hex) by which an image type is told, in the
# order they are tried: type, offset in bytes, hex alternatives.
IMAGE_HEADS = (
    ("jpeg", 6, ("4A464946", "45786966")),
    ("jpeg", 0, ("FFD8FFDB",)),
    ("png", 0, ("89504E470D0A1A0A",)),
    ("gif", 0, ("474946383761", "474946383961")),
    ("tiff", 0, ("4D4D", "4949")),
    ("rgb", 0, ("01DA",)),
    ("pbm", 0, ("503120", "503109", "50310A", "50310D", "503420", "503409", "50340A", "50340D")),
    ("pgm", 0, ("503220", "503209", "50320A", "50320D", "503520", "503509", "50350A", "50350D")),
    ("ppm", 0, ("503320", "503309", "50330A", "50330D", "503620", "503609", "50360A", "50360D")),
    ("rast", 0, ("59A66A95",)),
    ("xbm", 0, ("23646566696E6520",)),
    ("bmp", 0, ("424D",)),
)
LONGEST_HEAD = 12

# What the file name filters accept.
FOLDER_MARKS = (".png", ".jpg", ".gif")
UPLOAD_EXTENSIONS = ("png", "jpg", "JPG", "PNG", "bmp", "gif", "jpeg", "JPEG")
OLD_UPLOAD_EXTENSIONS = ("png", "jpg", "JPG", "PNG", "bmp", "gif")


def image_type(content: Column) -> Column:
    """Image type from the leading bytes, NULL when unknown."""
    head = F.hex(F.substring(content, 1, LONGEST_HEAD))
    # A one-element array names the head: were it written out in every rule, a
    # computed image would be computed once per rule.
    return F.get(F.transform(F.array(head), _type_of_head), F.lit(0))


def _type_of_head(head: Column) -> Column:
    rules = [
        (name, F.substring(head, 2 * offset + 1, len(marks[0])).isin(*marks))
        for name, offset, marks in IMAGE_HEADS
    ]
    webp = head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250")
    rules += [("webp", webp), ("exr", head.startswith("762F3101"))]
    kind = F.lit(None).cast("string")
    for name, test in reversed(rules):
        kind = F.when(test, F.lit(name)).otherwise(kind)
    return kind


def b64(content: Column) -> Column:
    """Base64 on one line, whatever ``spark.sql.chunkBase64String.enabled`` says."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def from_b64(text: Column) -> Column:
    return F.unbase64(text)


def data_uri(content: Column, kind: Column | None = None) -> Column:
    """``data:image/<type>;base64,<payload>``; NULL when the type is unknown."""
    kind = image_type(content) if kind is None else kind
    return F.concat(F.lit("data:image/"), kind, F.lit(";base64,"), b64(content))


def uri_payload(uri: Column) -> Column:
    """Base64 part of a data URI (the whole text when it is not one)."""
    return F.substring_index(uri, ",", -1)


def record_line(*cols: Column) -> Column:
    """Fields joined by ``|``, white space at both ends removed."""
    return trim_space(F.concat_ws("|", *cols))


def _contains_any(text: Column, marks: Iterable[str]) -> Column:
    test = F.lit(False)
    for mark in marks:
        test = test | F.contains(text, F.lit(mark))
    return test


def is_folder_image(name: Column) -> Column:
    """The name *contains* .png, .jpg or .gif in any case (``a.png.txt`` passes)."""
    return _contains_any(F.lower(name), FOLDER_MARKS)


def is_rename_image(name: Column) -> Column:
    """As :func:`is_folder_image`, but case matters."""
    return _contains_any(name, FOLDER_MARKS)


def is_upload_allowed(name: Column, allowed: Iterable[str] = UPLOAD_EXTENSIONS) -> Column:
    """There is a dot and the text after the last one is in the allow list."""
    return F.contains(name, F.lit(".")) & last_ext(name).isin(*allowed)
