"""Images that are already in an index."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagreef.functions.images import uri_payload
from tagreef.operators.grouping import first_per_key
from tagreef.operators.needles import SLICE_BYTES, match_needles
from tagreef.operators.sizes import broadcast_if_small
from tagreef.shared import saved
from tagreef.sources.hashes import HashIndex
from tagreef.sources.piece_index import DRAWN, containing_images, pieces_of

# Up to this many payloads without a piece are literal tests of one scan.
LITERAL_PAYLOADS = 200


def containing_rows(
    index: DataFrame, column: str, payloads: DataFrame, slice_bytes: int = SLICE_BYTES
) -> DataFrame | None:
    """``(index columns, payload, needle_id)`` for each index row and distinct payload
    in it; ``needle_id`` is the payload's SHA-256.

    Every piece of a payload is a piece of each text around it, so a payload is
    filed under its rarest one. Payloads without a piece (short ones) are literal
    tests; many of them are filed under their rarest character, and only then are
    texts split into characters. The empty payload is in every row.
    """
    text = F.col(column)
    index = index.filter(text.isNotNull())
    pieces = pieces_of(F.col("needle"))
    # Any part of the pieces will do as keys; the smallest hashes are a fair draw.
    hashed = F.transform(pieces, lambda p: F.struct(F.xxhash64(p).alias("h"), p.alias("p")))
    drawn = F.transform(F.slice(F.array_sort(hashed), 1, DRAWN), lambda d: d["p"])
    needles = saved(
        payloads.select(F.col("payload").alias("needle")).filter(F.col("needle").isNotNull())
        .distinct()
    )
    long = match_needles(
        index,
        needles.filter(F.size(pieces) > 0),
        row_keys=pieces_of(text),
        needle_keys=drawn,
        verify=F.contains(text, F.col("needle")),
        slice_bytes=slice_bytes,
    )
    short = _short_matches(index, text, needles.filter(F.size(pieces) == 0), slice_bytes)
    parts = [part for part in (long, short) if part is not None]
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("needle", "payload")


def _short_matches(index: DataFrame, text: Column, needles: DataFrame, slice_bytes: int) -> DataFrame | None:
    few = [row["needle"] for row in needles.limit(LITERAL_PAYLOADS + 1).collect()]
    if not few:
        return None
    if len(few) <= LITERAL_PAYLOADS:
        tests = [F.when(F.contains(text, F.lit(needle)), F.lit(needle)) for needle in few]
        found = index.withColumn("needle", F.explode(F.array_compact(F.array(*tests))))
        return found.withColumn("needle_id", F.sha2("needle", 256))
    nothing = F.array(F.lit(""))
    chars = F.array_distinct(F.split("needle", ""))
    return match_needles(
        index,
        needles,
        row_keys=F.concat(F.array_distinct(F.split(text, "")), nothing),
        needle_keys=F.when(F.col("needle") == "", nothing).otherwise(chars),
        verify=F.contains(text, F.col("needle")),
        slice_bytes=slice_bytes,
    )


def containing_rows_by(
    index: DataFrame, column: str, payloads: DataFrame, slice_bytes: int, pieces: DataFrame | None, key: str
) -> DataFrame | None:
    """``(payload, needle_id)`` of all matches: by a stored index of pieces, where there is one.

    With it the images are scanned once, whatever the number of payloads; only
    payloads too short to have a kept piece are looked for in the images themselves.
    """
    if pieces is None:
        return containing_rows(index.select(column), column, payloads, slice_bytes)
    found, short = containing_images(index.select(*{column, key}), pieces, payloads, column, key)
    found = found.select("payload", "needle_id")
    rest = containing_rows(index.select(column), column, short, slice_bytes)
    return found if rest is None else found.unionByName(rest.select("payload", "needle_id"))


def is_new(
    index: DataFrame, payloads: DataFrame, column: str = "Base64", slice_bytes: int = SLICE_BYTES,
    pieces: DataFrame | None = None, key: str = "path",
) -> DataFrame:
    """``(payload, n_hits, is_new)`` for each distinct payload.

    ``n_hits`` counts the index rows whose text contains the payload, and
    ``is_new`` says that there is none. ``pieces`` is the stored index of the texts,
    by ``key``, see :mod:`tagreef.sources.piece_index`.
    """
    asked = payloads.select("payload").filter(F.col("payload").isNotNull()).distinct()
    found = containing_rows_by(index, column, payloads, slice_bytes, pieces, key)
    if found is None:
        counted = asked.withColumn("n_hits", F.lit(0).cast("long"))
    else:
        counts = saved(found.groupBy("needle_id").agg(F.count("*").alias("n_hits")))
        counted = (
            asked.withColumn("needle_id", F.sha2("payload", 256))
            .join(broadcast_if_small(counts), "needle_id", "left")
            .select("payload", F.coalesce("n_hits", F.lit(0)).alias("n_hits"))
        )
    return counted.withColumn("is_new", F.col("n_hits") == 0)


def payload_hashes(catalog: DataFrame) -> DataFrame:
    """What to keep beside a catalog: ``payload_sha`` of every image.

    With it, a batch is checked without reading the images of the catalog again; see
    :mod:`tagreef.sources.hashes`.
    """
    return catalog.select(payload_sha(F.col("binary")).alias("payload_sha"))


def payload_sha(uri: Column) -> Column:
    return F.sha2(uri_payload(uri), 256)


def drop_repeats(
    batch: DataFrame,
    catalog: DataFrame | HashIndex,
    how: str = "hash",
    order: tuple[str, ...] = ("path",),
    slice_bytes: int = SLICE_BYTES,
    pieces: DataFrame | None = None,
) -> DataFrame:
    """Catalog rows of ``batch`` whose image the catalog does not hold yet.

    Within the batch the first row by ``order`` of each image stays; rows without
    an image are no repeats of one another and all stay. ``exact`` drops an image
    whose payload lies anywhere in a catalog image, at a cost of one catalog scan
    if its index of ``pieces`` is given, else one per slice of payloads; ``hash`` compares whole payloads in one pass. They
    differ when one payload is a proper part of another. For ``hash``, ``catalog`` may
    be a table made by :func:`payload_hashes`, or a stored index of hashes. The
    catalog's hashes meet the batch's, which are broadcast behind a size check: they
    are not shuffled.

    The choice is made on hashes and ``order`` alone. What is dropped, usually
    little, then meets the images; they are not shuffled as long as it is small.
    """
    hashed = batch.withColumn("_sha", payload_sha(F.col("binary"))).withColumn("_place", F.struct(*order))
    known = hashed.filter(F.col("_sha").isNotNull())
    places = known.groupBy("_sha", "_place").agg(F.count("*").alias("_copies"))
    places = saved(places)
    first = saved(places.groupBy("_sha").agg(F.min("_place").alias("_place")))
    if how == "hash":
        asked = first.select(F.col("_sha").alias("payload_sha"))
        if isinstance(catalog, HashIndex):
            held = catalog.among(asked)
        else:
            seen = catalog if "payload_sha" in catalog.columns else payload_hashes(catalog)
            held = seen.select("payload_sha").join(broadcast_if_small(asked), "payload_sha", "left_semi").distinct()
        held = held.withColumnRenamed("payload_sha", "_sha")
    elif how == "exact":
        asked = _rows_at(known, first)
        payloads = asked.select(uri_payload(F.col("binary")).alias("payload"))
        found = containing_rows_by(catalog, "binary", payloads, slice_bytes, pieces, "path")
        held = first.limit(0) if found is None else found.select(F.col("needle_id").alias("_sha")).distinct()
    else:
        raise ValueError(f"how must be 'hash' or 'exact', not {how!r}")
    # Kinds of rows by image and place: held by the catalog, or not the first, or several at the first.
    held = held.select("_sha", F.lit(True).alias("_held"))
    kinds = places.join(first.withColumnRenamed("_place", "_first"), "_sha").join(held, "_sha", "left")
    dropped = F.col("_held").isNotNull() | (F.col("_place") != F.col("_first"))
    kinds = saved(kinds.select("_sha", "_place", dropped.alias("_drop"), (F.col("_copies") > 1).alias("_several")))
    special = broadcast_if_small(kinds.filter("_drop OR _several"))
    kept = hashed.join(special.select("_sha", "_place"), ["_sha", "_place"], "left_anti")
    kept = kept.select(*batch.columns)
    several = kinds.filter("_several AND NOT _drop")
    if not several.isEmpty():
        # The same image at the same place: any of the copies will do.
        copies = _rows_at(hashed, several).select(*batch.columns, "_sha")
        kept = kept.unionByName(first_per_key(copies, ["_sha"], list(order)).select(*batch.columns))
    return kept


def _rows_at(hashed: DataFrame, first: DataFrame) -> DataFrame:
    places = broadcast_if_small(first.select("_sha", "_place"))
    return hashed.join(places, ["_sha", "_place"], "left_semi")
