"""Tag files and image lists: ``|`` separated text, one folder per write."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagreef.functions.images import record_line
from tagreef.schema import CATALOG, IMAGE_LIST, TAG_FILE


def read_tag_file(spark: SparkSession, path: str) -> DataFrame:
    """Tag files with a header each; short rows pad with NULL, extra fields drop."""
    return spark.read.schema(TAG_FILE).csv(path, sep="|", header=True)


def stamped_path(folder: str, when: datetime) -> str:
    """Where a tag file or image list goes that is given no name."""
    return f"{folder.rstrip('/')}/{when:%m%d%Y%H%M%S%f}.txt"


def write_tag_file(rows: DataFrame, path: str) -> None:
    """Write ``Image|Tag|Base64`` records as they are, unquoted, below a header.

    Every part file carries the header, so it is a line of the written text: the
    value column's name. A partition without records writes no file.
    """
    header = "|".join(TAG_FILE.names)
    line = record_line(*(F.coalesce(F.col(name), F.lit("")) for name in TAG_FILE.names))
    (
        rows.select(line.alias(header))
        .write.mode("append")
        .csv(path, sep="\u0001", header=True, quote="", escape="", emptyValue="",
             ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    )


def tag_file_to_catalog(rows: DataFrame) -> DataFrame:
    return rows.select(*TAG_FILE.names).toDF(*CATALOG.names)


def catalog_to_tag_file(rows: DataFrame) -> DataFrame:
    return rows.select(*CATALOG.names).toDF(*TAG_FILE.names)


def write_image_list(rows: DataFrame, path: str) -> None:
    """Write ``file|uri`` records without a header."""
    rows.select(record_line(*(F.col(name) for name in IMAGE_LIST.names))).write.mode(
        "append"
    ).text(path)


def read_image_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(IMAGE_LIST).csv(path, sep="|", header=False)
