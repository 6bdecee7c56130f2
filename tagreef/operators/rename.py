"""Rename plan of an image folder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagreef.functions.images import is_rename_image
from tagreef.functions.text import last_ext
from tagreef.operators.numbering import with_index


def rename_plan(files: DataFrame, start: str, order: tuple[str, ...] = ("name",)) -> DataFrame:
    """``files`` with ``new_name``: a counter from ``start`` down, then the extension.

    Only image files are renamed and counted. The counter has 20 digits, which a
    64-bit number cannot hold. ``order`` must tell any two files apart.
    """
    images = files.filter(is_rename_image(F.col("name")))
    counter = F.lit(start).cast("decimal(20,0)") - F.col("_nth").cast("decimal(20,0)")
    new_name = F.concat(
        counter.cast("decimal(20,0)").cast("string"), F.lit("."), last_ext(F.col("name"))
    )
    return (
        with_index(images, list(order), "_nth").withColumn("new_name", new_name).drop("_nth")
    )
