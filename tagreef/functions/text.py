"""Tag normalisation, names and time stamps."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``\s`` matches. The ASCII ones are
# listed one by one because Java tests such a class with one table look-up;
# the rest stand behind a cheap "not ASCII" test for the same reason.
ASCII_SPACE = r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ]+"
OTHER_SPACE = (
    r"[[^\x00-\x84]&&"
    r"[\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]+"
)

# The same characters, as text to trim.
SPACES = "".join(
    chr(code)
    for code in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# Fixed value: the tag of an image without text.
NO_TAG = "NoTag"

# Time stamp layouts of file names.
STAMPS = {"ymd": "yyyyMMddHHmmssSSSSSS", "mdy": "MMddyyyyHHmmssSSSSSS"}


def strip_tag(text: Column) -> Column:
    """Remove line feeds, blanks and the field separator."""
    for char in ("\n", " ", "|"):
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def strip_space(text: Column) -> Column:
    """Remove all Unicode white space, as Python's ``\\s`` defines it."""
    return F.regexp_replace(F.regexp_replace(text, ASCII_SPACE, ""), OTHER_SPACE, "")


def trim_space(text: Column) -> Column:
    """Remove white space at both ends, as Python's ``strip`` does."""
    return F.btrim(text, F.lit(SPACES))


def finish_tag(text: Column) -> Column:
    """Lower-case a tag; nothing left (or no text at all) becomes ``NoTag``."""
    # The text is named once: a filter on the tag would compute every mention anew.
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"^\z", NO_TAG)


def upload_tag(text: Column) -> Column:
    """Tag of an uploaded image: every white space character goes."""
    return finish_tag(strip_space(strip_tag(text)))


def folder_tag(text: Column) -> Column:
    """Tag of an image from a folder: tabs and wide blanks stay."""
    return finish_tag(strip_tag(text))


def stamp_name(ts: Column, style: str = "ymd") -> Column:
    """Time stamp with microseconds as a file name, ``ymd`` or ``mdy``."""
    return F.date_format(ts, STAMPS[style])


def last_ext(name: Column) -> Column:
    """Text after the last dot; the whole text when there is none."""
    return F.substring_index(name, ".", -1)


def fetch_url(link: Column, repair: bool = False) -> Column:
    """Put ``https:`` before a link without ``https``.

    This also turns ``http://x`` into ``https:http://x``; ``repair=True``
    leaves links that start with ``http://`` as they are.
    """
    complete = F.contains(link, F.lit("https"))
    if repair:
        complete = complete | link.startswith("http://")
    return F.when(complete, link).otherwise(F.concat(F.lit("https:"), link))


def utf8_as_latin1(text: Column) -> Column:
    """UTF-8 bytes of a text read again as Latin-1."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def file_name(path: Column) -> Column:
    """Last part of a path."""
    return F.substring_index(path, "/", -1)
