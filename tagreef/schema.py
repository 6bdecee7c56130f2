"""Declared schemas of every stored table; no read ever infers one."""

from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


CATALOG = StructType(_strings("path", "features", "binary"))
TAG_FILE = StructType(_strings("Image", "Tag", "Base64"))
IMAGE_LIST = StructType(_strings("file", "uri"))
ACCOUNTS = StructType(
    [StructField("id", IntegerType()), *_strings("username", "password_hash", "email")]
)
SIGNUPS = StructType(
    [
        StructField("seq", LongType()),
        StructField("username", StringType()),
        StructField("password_length", IntegerType()),
        *_strings("password_hash", "email"),
    ]
)
PAGES = StructType([StructField("page_id", LongType()), *_strings("url", "html")])
UPLOADS = StructType([StructField("path", StringType()), StructField("content", BinaryType())])
BINARY_FILES = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
    ]
)
REQUESTS = StructType([StructField("request_id", LongType()), StructField("keyword", StringType())])
