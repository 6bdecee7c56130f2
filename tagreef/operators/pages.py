"""Tags and image links of stored pages, and the download manifest."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagreef.functions.links import attribute, attributes_of, image_link, tags_of
from tagreef.functions.text import fetch_url, last_ext, stamp_name
from tagreef.operators.numbering import with_index


# The attributes of an image tag that may hold its link, by column.
IMAGE_ATTRIBUTES = {"src": "src", "data_original": "data-original", "org_src": "org_src"}


def extract_tags(pages: DataFrame, tag: str, attrs: dict[str, str]) -> DataFrame:
    """One row per tag of a page, in document order: ``(page_id, url, pos, attributes)``.

    ``attrs`` maps column names to attribute names. A page without such a tag
    has no row.
    """
    # Parsed below the generator, so that no later expression parses a tag again.
    parsed = F.transform(tags_of(F.col("html"), tag), attributes_of)
    found = pages.select("page_id", "url", F.posexplode(parsed).alias("pos", "_attributes"))
    values = [attribute(F.col("_attributes"), attr).alias(name) for name, attr in attrs.items()]
    return found.select("page_id", "url", "pos", *values)


def extract_images(pages: DataFrame) -> DataFrame:
    """The image tags that carry ``src``."""
    return extract_tags(pages, "img", IMAGE_ATTRIBUTES).filter(F.col("src").isNotNull())


def choose_links(images: DataFrame) -> DataFrame:
    """``(page_id, pos, link)`` of the image tags whose site rule gives a link."""
    link = image_link(F.col("url"), {name: F.col(c) for c, name in IMAGE_ATTRIBUTES.items()})
    return images.select("page_id", "pos", link.alias("link")).filter(F.col("link").isNotNull())


def extract_image_links(pages: DataFrame) -> DataFrame:
    return choose_links(extract_images(pages))


def download_manifest(links: DataFrame, ts: Column, repair: bool = False) -> DataFrame:
    """``(page_id, pos, link, fetch_url, file_name)``: what to fetch and how to name it.

    A name is the time stamp of the batch plus one microsecond per link, in page
    order, so that no two links of a batch share one.
    """
    link = F.col("link")
    stamp = stamp_name(F.timestamp_micros(F.unix_micros(ts) + F.col("_nth")))
    return with_index(links, ["page_id", "pos"], "_nth").select(
        "page_id",
        "pos",
        "link",
        fetch_url(link, repair).alias("fetch_url"),
        F.concat(stamp, F.lit("."), last_ext(link)).alias("file_name"),
    )


def skip_existing(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Drop downloads whose file is in a folder listing with column ``name``."""
    there = files.select(F.col("name").alias("file_name")).distinct()
    return manifest.join(there, "file_name", "left_anti").select(*manifest.columns)
