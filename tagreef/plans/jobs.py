"""Search, ingest, index, crawl and account jobs."""

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagreef.functions.images import (
    UPLOAD_EXTENSIONS,
    data_uri,
    from_b64,
    image_type,
    is_upload_allowed,
    uri_payload,
)
from tagreef.functions.keyword import matches_keyword
from tagreef.functions.text import folder_tag, strip_tag, upload_tag
from tagreef.operators.accounts import apply_profile_patches, apply_signups
from tagreef.operators.extract import (
    Detector,
    TextReader,
    joined_text,
    label_reader,
    text_reader,
)
from tagreef.operators.grouping import first_per_key
from tagreef.operators.labels import known_translations, label_texts, row_label_text
from tagreef.operators.pages import download_manifest, extract_image_links, skip_existing
from tagreef.operators.repeats import drop_repeats
from tagreef.operators.search import search, search_request
from tagreef.operators.sizes import broadcast_if_small, table_bytes
from tagreef.shared import saved
from tagreef.sources.catalog import append_catalog, read_catalog
from tagreef.sources.folders import open_image_folder, read_image_folder
from tagreef.sources.hashes import HashIndex
from tagreef.sources.masks import possible_rows
from tagreef.sources.text_files import (
    read_tag_file,
    tag_file_to_catalog,
    write_image_list,
    write_tag_file,
)

# The answer to an upload with a refused name.
NAME_ERROR = 1001
NAME_MESSAGE = "Only support .png .PNG .jpg .JPG .bmp .gif"
TYPE_MESSAGE = "Unknown image type"

# A dictionary of up to this size is a map that every task gets.
MAP_BYTES = 8 << 20

# A search that hits more files than this reads all of them in one pass.
FEW_FILES = 10_000


def hit_files(catalog: DataFrame, keyword: str) -> DataFrame:
    """``(file)``: files of a stored catalog with a hit; only the tags are read."""
    hits = catalog.filter(matches_keyword(F.col("features"), keyword))
    return hits.select(F.col("_metadata.file_path").alias("file")).distinct()


def search_catalog(spark: SparkSession, path: str, keyword: str) -> DataFrame:
    """The images a keyword finds in a catalog.

    Almost all bytes of a catalog are images. Files whose character mask rules the
    keyword out are not read at all, see :mod:`tagreef.sources.masks`; of the others
    the tags alone are scanned first, and then images are read from the files with a
    hit only. A keyword that hits more files than the driver should list finds them
    in one pass over all; the answer is the same.
    """
    if keyword == "":
        return search_request(read_catalog(spark, path), keyword)
    catalog = possible_rows(spark, path, keyword)
    if not catalog.inputFiles():
        return search(catalog, keyword)
    files = [row[0] for row in hit_files(catalog, keyword).limit(FEW_FILES + 1).collect()]
    if len(files) > FEW_FILES:
        return search(catalog, keyword)
    return search(catalog.filter(F.col("_metadata.file_path").isin(files)), keyword)


def search_tag_files(spark: SparkSession, path: str, keyword: str) -> DataFrame:
    """The images a keyword finds in tag files."""
    return search_request(tag_file_to_catalog(read_tag_file(spark, path)), keyword)


def ingest_uploads(
    uploads: DataFrame,
    reader: Callable[[], TextReader],
    seen: DataFrame | HashIndex | None = None,
    allowed: Iterable[str] = UPLOAD_EXTENSIONS,
) -> tuple[DataFrame, DataFrame]:
    """``(path, content)`` uploads to new catalog rows, and ``(path, error, msg)`` refusals.

    A refused name or an unknown image type ends an upload before its text is
    read. With ``seen`` (a catalog, its payload hashes or an index of them), known images are left
    out. Rows have a fourth column ``error``: why a text could not be read, NULL
    if it was. It is stored beside the catalog's columns; see
    :func:`~tagreef.sources.catalog.read_errors`.
    """
    allowed = list(allowed)
    named = F.coalesce(is_upload_allowed(F.col("path"), allowed), F.lit(False))
    typed = uploads.select(
        "path", "content", named.alias("_named"), image_type(F.col("content")).alias("_type")
    )
    refused = typed.filter(~F.col("_named") | F.col("_type").isNull()).select(
        "path",
        F.when(~F.col("_named"), F.lit(NAME_ERROR)).alias("error"),
        F.when(~F.col("_named"), F.lit(NAME_MESSAGE)).otherwise(F.lit(TYPE_MESSAGE)).alias("msg"),
    )
    good = typed.filter(F.col("_named") & F.col("_type").isNotNull())
    images = good.select(
        "path", "content", data_uri(F.col("content"), F.col("_type")).alias("binary")
    )
    if seen is not None:
        # Before the reading of texts, the dear step; the image travels once.
        images = drop_repeats(images.drop("content"), seen).withColumn(
            "content", from_b64(uri_payload(F.col("binary")))
        )
    read = text_reader(reader, "all")
    features = upload_tag(joined_text(F.col("_read")))
    rows = images.withColumn("_read", read("content"))
    error = F.col("_read.error").alias("error")
    return rows.select("path", features.alias("features"), "binary", error), refused


def store_uploads(
    uploads: DataFrame,
    catalog_path: str,
    reader: Callable[[], TextReader],
    allowed: Iterable[str] = UPLOAD_EXTENSIONS,
) -> DataFrame:
    """Append the accepted uploads to a catalog and return the refusals."""
    rows, refused = ingest_uploads(uploads, reader, allowed=allowed)
    append_catalog(rows, catalog_path)
    return refused


def index_images(
    images: DataFrame,
    reader: Callable[[], TextReader],
    detector: Callable[[], Detector] | None = None,
    dictionary: DataFrame | None = None,
    map_bytes: int = MAP_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """``(name, content)`` images to ``(Image, Tag, Base64, error)`` rows, and refused names.

    Text and labels are found in the image's own row, so images of one name keep
    apart. Labels are translated by a map that goes to the rows; a dictionary beyond
    ``map_bytes`` is joined instead, with the same result: labels are found and
    kept first, without the images, under a key of their own, and the label texts
    meet the images again. ``error`` tells the first failure, of the reader or the
    detector.
    """
    typed = images.withColumn("_type", image_type(F.col("content")))
    refused = _untyped(images)
    good = typed.filter(F.col("_type").isNotNull())
    read = text_reader(reader, "eng")
    labels, failed = F.lit(""), F.lit(None).cast("string")
    if detector is not None:
        known = None if dictionary is None else saved(known_translations(dictionary))
        if known is not None and table_bytes(known) > map_bytes:
            good = _with_joined_labels(good, detector, known)
            labels, failed = F.col("_labels"), F.col("_failed")
        else:
            good = good.withColumn("_found", label_reader(detector)("content"))
            translations = None
            if known is not None:
                entries = F.map_from_entries(F.collect_list(F.struct("name", "translation")))
                good = good.withColumn("_known", known.agg(entries.alias("_known")).scalar())
                translations = F.col("_known")
            labels, failed = row_label_text(F.col("_found.labels"), translations), F.col("_found.error")
    rows = good.withColumn("_read", read("content"))
    tag = folder_tag(F.concat(joined_text(F.col("_read")), strip_tag(labels)))
    out = rows.select(
        F.col("name").alias("Image"),
        tag.alias("Tag"),
        data_uri(F.col("content"), F.col("_type")).alias("Base64"),
        F.coalesce(F.col("_read.error"), failed).alias("error"),
    )
    return out, refused


def _untyped(images: DataFrame) -> DataFrame:
    """Names of images whose type is unknown; heads will do."""
    return images.filter(image_type(F.col("content")).isNull()).select("name")


def _with_joined_labels(images: DataFrame, detector: Callable[[], Detector], known: DataFrame) -> DataFrame:
    """Images with their label texts ``_labels``, by joins with ``known`` of any size.

    The key of an image is its content's hash: equal images have the labels that were
    found for one of them, and the detector runs once for each image row. As long as
    the label texts are small the images are not moved to meet them.
    """
    key = F.sha2("content", 256)
    found = images.select(key.alias("image"), label_reader(detector)("content").alias("_found"))
    found = saved(found.select("image", F.col("_found.labels").alias("names"), F.col("_found.error").alias("_failed")))
    # Of equal images one stands for all: one without a failure, if there is any.
    found = first_per_key(found.withColumn("_bad", F.col("_failed").isNotNull()), ["image"], ["_bad", "names"])
    found = saved(found.select("image", F.coalesce("names", F.array().cast("array<string>")).alias("names"), "_failed"))
    texts = label_texts(found.select("image", "names"), known).withColumnRenamed("labels", "_labels")
    texts = saved(texts.join(found.select("image", "_failed"), "image"))
    return images.withColumn("image", key).join(broadcast_if_small(texts), "image").drop("image")


def index_folder(
    spark: SparkSession,
    folder: str,
    target: str,
    reader: Callable[[], TextReader],
    detector: Callable[[], Detector] | None = None,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """Write the tag file of an image folder and return the names left out."""
    images, heads, others = open_image_folder(spark, folder)
    rows, _ = index_images(images, reader, detector, dictionary)
    write_tag_file(rows, target)
    return others.unionByName(_untyped(heads))


def image_list(images: DataFrame) -> DataFrame:
    """``(file, uri)`` of the images whose type is known."""
    uri = data_uri(F.col("content"))
    listed = images.select(F.col("name").alias("file"), uri.alias("uri"))
    return listed.filter(F.col("uri").isNotNull())


def list_folder(spark: SparkSession, folder: str, target: str) -> None:
    """Write the image list of a folder."""
    images, _ = read_image_folder(spark, folder)
    write_image_list(image_list(images), target)


def crawl_manifest(
    pages: DataFrame, ts: Column, files: DataFrame | None = None, repair: bool = False
) -> DataFrame:
    """What to download for stored pages, files that exist left out."""
    manifest = download_manifest(extract_image_links(pages), ts, repair)
    return manifest if files is None else skip_existing(manifest, files)


def account_batch(
    accounts: DataFrame, signups: DataFrame, patches: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sign-ups, then profile changes: the new accounts, outcomes, unknown changes."""
    grown, outcomes = apply_signups(accounts, signups)
    patched, unknown = apply_profile_patches(grown, patches)
    return patched, outcomes, unknown
