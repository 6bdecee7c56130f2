"""Near-duplicate documents by min-max hashing.

Under each random permutation of the shingle hashes both the least and the
greatest value are kept: two signature values for one evaluation. Agreement of
either is an unbiased vote for the Jaccard similarity, and the two votes vary
less together than two minima do. Bands of these values propose links, full
shingle sets confirm them.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagreef.llm.components import components
from tagreef.llm.tables import stored
from tagreef.llm.words import PLAIN, Words, mixed, powers, span_sums, word_pieces
from tagreef.operators.numbering import with_index

#: Bands of ``ROWS`` values each: a link at 0.8 escapes all bands with odds of 3e-6.
BANDS, ROWS = 32, 5
PERMUTATIONS = BANDS * ROWS // 2
#: Sides of a block of classes that are compared with one another.
OUTSIDERS, MEMBERS = 512, 4096

_rng = np.random.default_rng(7)
_MASKS = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_FACTORS = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin.

    A text with fewer words than ``size`` has its whole sequence as one shingle.
    """
    counts = words.counts
    at, hashes = words.windows(size)
    owner = np.searchsorted(words.first, at, "right") - 1
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        hashes = np.concatenate([hashes, span_sums(words.hashes, words.first[short], words.first[short + 1])])
        owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[fresh], np.searchsorted(owner[fresh], np.arange(len(counts) + 1))


def signatures(hashes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Least and greatest value under every permutation, for each non-empty set."""
    starts = cuts[:-1][np.diff(cuts) > 0]
    out = np.empty((len(starts), 2 * PERMUTATIONS), np.uint64)
    for k in range(PERMUTATIONS):
        values = (hashes ^ _MASKS[k]) * _FACTORS[k]
        out[:, 2 * k] = np.minimum.reduceat(values, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(values, starts)
    return out


def band_keys(signs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    # A band takes every BANDS-th value, so that the two ends of one permutation part.
    values = mixed(signs).reshape(len(signs), ROWS, BANDS)
    keys = (values * powers(0xD1342543DE82EF95, ROWS)[:ROWS, None]).sum(axis=1, dtype=np.uint64)
    return mixed(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _describe(docs: DataFrame, doc_id: str, text: str, size: int, lower: bool) -> DataFrame:
    """(id, n, key, bands, sign): size and digest of the shingle set, band keys and the
    last byte of every signature value; null without a set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_pieces(batch.column(1), PLAIN, lower):
                hashes, cuts = shingle_sets(words, size)
                full = np.diff(cuts) > 0
                keys: list[bytes | None] = [None] * (high - low)
                bands: list[np.ndarray | None] = [None] * (high - low)
                bytes_: list[bytes | None] = [None] * (high - low)
                if full.any():
                    signs = signatures(hashes, cuts)
                    found = zip(band_keys(signs), mixed(signs).astype(np.uint8))
                    for k, (own, last) in zip(np.flatnonzero(full).tolist(), found):
                        keys[k] = hashlib.blake2b(hashes[cuts[k] : cuts[k + 1]], digest_size=16).digest()
                        bands[k], bytes_[k] = own, last.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high],
                        pa.array(np.diff(cuts), pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(bytes_, pa.binary()),
                    ],
                    ["id", "n", "key", "bands", "sign"],
                )

    columns = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return columns.mapInArrow(describe, "id long, n long, key binary, bands array<long>, sign binary")


def _sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, size: int, lower: bool) -> DataFrame:
    """(id, hashes, brief): shingle sets of the wanted ids, as bytes of sorted 64-bit hashes,
    and of the last 16 bits of each."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_pieces(batch.column(1), PLAIN, lower):
                hashes, cuts = shingle_sets(words, size)
                whole = [hashes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                brief = [hashes[a:b].astype(np.uint16).tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], pa.array(whole, pa.binary()), pa.array(brief, pa.binary())],
                    ["id", "hashes", "brief"],
                )

    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    found = texts.join(wanted, "id", "left_semi").mapInArrow(sets, "id long, hashes binary, brief binary")
    return found.dropDuplicates(["id"])


def _tested(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, united): sizes of the intersection and the union of each pair's sets."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, np.zeros(0, np.uint64)
        for batch in batches:
            shared, united = [], []
            for b, x, y in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if b != last:
                    last, mine = b, np.frombuffer(y.as_buffer(), np.uint64)
                other = np.frombuffer(x.as_buffer(), np.uint64)
                shared.append(len(np.intersect1d(mine, other, assume_unique=True)))
                united.append(len(mine) + len(other) - shared[-1])
            arrays = [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(united, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "shared", "united"])

    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(test, "a long, b long, shared long, united long")


def _is_link(percent: int):
    return 100 * F.col("shared") >= percent * F.col("united")


def _crossed(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs of a band's classes in different components, one outside the head's, that may be links.

    Outsiders and members meet in blocks of bounded size. A pair goes on if
    neither the sizes of the sets, nor their distances from the head (Jaccard
    distance obeys the triangle inequality), nor their signatures, by six
    standard deviations, rule a link out, and if 16 bits of each shingle leave
    room for one: equal shingles have equal bits, so these never count too few.
    """
    band = placed.groupBy("band").agg(
        F.count("*").alias("m"), F.count(F.when(F.col("of") != F.col("head"), 1)).alias("o")
    )
    rows = placed.join(band.filter("o > 0"), "band")
    parts_o, parts_m = F.ceil(F.col("o") / OUTSIDERS).cast("int"), F.ceil(F.col("m") / MEMBERS).cast("int")
    own_o, own_m = (F.pmod(F.xxhash64("a"), n).cast("int") for n in (parts_o, parts_m))
    fields = ["a", "na", "of", "far", "sign", "brief"]
    left = rows.filter("of <> head").select(
        "band", own_o.alias("i"), F.explode(F.sequence(F.lit(0), parts_m - 1)).alias("j"), F.lit(True).alias("out"), *fields
    )
    right = rows.select(
        "band", F.explode(F.sequence(F.lit(0), parts_o - 1)).alias("i"), own_m.alias("j"), F.lit(False).alias("out"), *fields
    )
    blocks = left.unionAll(right).repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    share = percent / 100
    agree = (share - 6 * (share * (1 - share) / (2 * PERMUTATIONS)) ** 0.5) * 2 * PERMUTATIONS
    reach = 1 - share + 1e-9

    def block_pairs(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        out = np.asarray(block.column("out"))
        a, na, of, far = (block.column(c).to_numpy() for c in ("a", "na", "of", "far"))
        signs = np.frombuffer(b"".join(block.column("sign").to_pylist()), np.uint8).reshape(len(a), -1)
        mine, others = np.flatnonzero(out), np.flatnonzero(~out)
        brief = [np.frombuffer(x, np.uint16) for x in block.column("brief").to_pylist()]
        sizes = np.array([len(x) for x in brief])
        holds, found = np.zeros(1 << 16, bool), []
        for x in mine.tolist():
            y = others[(of[others] != of[x]) & (sizes[others] > 0)]
            small, large = np.minimum(na[y], na[x]), np.maximum(na[y], na[x])
            y = y[(100 * small >= percent * large) & ~(np.abs(far[y] - far[x]) > reach)]
            y = y[(signs[y] == signs[x]).sum(1) >= agree] if len(y) else y
            if len(y):
                holds[brief[x]] = True
                hits = holds[np.concatenate([brief[k] for k in y.tolist()])]
                shared = np.add.reduceat(hits.astype(np.int64), np.cumsum(sizes[y]) - sizes[y])
                holds[brief[x]] = False
                y = y[100 * shared >= percent * (sizes[y] + sizes[x] - shared)]
            found.append(np.column_stack([np.full(len(y), a[x]), a[y]]))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        return pairs.max(1, initial=0), pairs.min(1, initial=1 << 62)

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(part: pa.Table) -> pa.RecordBatch:
            a, b = block_pairs(part)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        last = None
        for batch in batches:
            key = np.column_stack([batch.column(c).to_numpy() for c in ("band", "i", "j")])
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                if held and tuple(key[low]) != last:
                    yield done(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(low, high - low))
                last = tuple(key[low])
        if held:
            yield done(pa.Table.from_batches(held))

    return blocks.mapInArrow(cross, "a long, b long").distinct()


def _similar_sizes(percent: int):
    """Sets whose sizes differ more than this cannot share ``percent`` of their union."""
    return 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")


def _ids_repeat(docs: DataFrame, doc_id: str) -> bool:
    ids = docs.select(F.col(doc_id).cast("long").alias("id")).filter("id IS NOT NULL")
    return bool(ids.groupBy("id").agg(F.count("*").alias("rows")).filter("rows > 1").take(1))


def _digest(text: str):
    return F.coalesce(F.sha2(F.encode(text, "UTF-8"), 256), F.lit(""))


def _numbered(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(number, id, text) rows, and (id, digest, number): a number for each text of each id.

    Numbers rise with the ids, so the least number of a group has its least id.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).filter("id IS NOT NULL")
    rows = rows.withColumn("digest", _digest("text"))
    numbers = stored(with_index(rows.select("id", "digest").distinct(), ["id", "digest"], "number"), "numbers")
    return stored(rows.join(numbers, ["id", "digest"]).select("number", "id", "text"), "numbered"), numbers


def first_of_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """One row of ``docs`` of each group of near duplicates, and every row with a null id.

    It is the row with the least id. Where ids repeat, every text is a document
    of its own: of a group's texts under its least id the one with the least
    SHA-256 stays, and of rows equal in id and text the least by all columns.
    """
    named, columns = docs.filter(F.col(doc_id).isNotNull()), docs.columns
    if not _ids_repeat(docs, doc_id):
        found = _unique_near_duplicates(named, doc_id, text, size, percent, True).filter("kept")
        named = named.join(found.select(F.col("doc_id").alias(doc_id)), doc_id, "left_semi")
        return named.select(*columns).unionAll(docs.filter(F.col(doc_id).isNull()))
    rows, numbers = _numbered(docs, doc_id, text)
    found = _unique_near_duplicates(rows, "number", "text", size, percent, True).filter("kept")
    kept = numbers.join(found.select(F.col("doc_id").alias("number")), "number", "left_semi").select("id", "digest")
    named = named.select(F.col(doc_id).cast("long").alias("id"), _digest(text).alias("digest"), F.struct(*columns).alias("row"))
    named = named.join(kept, ["id", "digest"], "left_semi").groupBy("id", "digest").agg(F.min("row").alias("row"))
    return named.select("row.*").unionAll(docs.filter(F.col(doc_id).isNull()))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    lower: bool = True,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    A document's set holds its distinct shingles of ``size`` words (runs of
    bytes without ASCII white space, A-Z lowered if asked); fewer words are one
    shingle. Documents are linked if their sets share ``percent`` of their
    union; the component is the smallest id reachable. Null, empty or blank
    texts have no set and link with nothing. Rows that share an id take the
    least component that any of them has; a row with a null id links with
    nothing, has a null component and is kept. Other columns play no part.
    """
    if not _ids_repeat(docs, doc_id):
        return _unique_near_duplicates(docs, doc_id, text, size, percent, lower)
    rows, numbers = _numbered(docs, doc_id, text)
    found = stored(_unique_near_duplicates(rows, "number", "text", size, percent, lower), "numbered-found")
    found = found.select(F.col("doc_id").alias("number"), "n_shingles", F.col("component_id").alias("least"))
    least = numbers.select(F.col("number").alias("least"), F.col("id").alias("component_id"))
    found = stored(found.join(numbers.select("number", "id"), "number").join(least, "least"), "found")
    reached = found.groupBy("id").agg(F.min("component_id").alias("component_id"))
    out = found.select("id", "n_shingles").join(reached, "id")
    out = out.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("component_id") == F.col("id")).alias("kept")
    )
    null = docs.filter(F.col(doc_id).cast("long").isNull())
    return out.unionAll(_unique_near_duplicates(null, doc_id, text, size, percent, lower))


def _unique_near_duplicates(
    docs: DataFrame, doc_id: str, text: str, size: int, percent: int, lower: bool
) -> DataFrame:
    """As :func:`near_duplicates`, where rows that share an id have one text.

    Equal sets are one class, and classes meet in bands: every class of a band
    is compared with its least one, by full sets. Classes that are not in that
    one's component by then meet all the others of the band outside their own component,
    so that nothing proposed by a band stays undecided.
    """
    described = stored(_describe(docs, doc_id, text, size, lower), "shingles")
    full = described.filter("key IS NOT NULL AND id IS NOT NULL")
    classes = full.groupBy("key").agg(F.min("id").alias("class"))
    member = stored(full.join(classes, "key").select("id", "class", "n", "bands", "sign"), "members")

    bands = member.filter("id = class").select(F.explode("bands").alias("band"), F.col("class").alias("a"), "n")
    heads = bands.groupBy("band").agg(F.min(F.struct("a", "n")).alias("head"), F.max("a").alias("last"))
    heads = heads.filter("head.a <> last").select("band", F.col("head.a").alias("b"), F.col("head.n").alias("nb"))
    met = bands.withColumnRenamed("n", "na").join(heads, "band")
    met = stored(met.select("band", "a", "na", "b", "nb").distinct(), "bands")

    first = met.filter(F.col("a") != F.col("b")).filter(_similar_sizes(percent)).select("a", "b").distinct()
    wanted = met.select(F.col("a").alias("id")).distinct()
    sets = stored(_sets(docs, wanted, doc_id, text, size, lower), "sets")
    tested = stored(_tested(first, sets), "tested")
    linked = components(tested.filter(_is_link(percent)))

    # Second pass: what the least class of a band did not settle.
    of = linked.withColumnRenamed("id", "a").withColumnRenamed("component", "of")
    placed = met.join(of, "a", "left").withColumn("of", F.coalesce("of", "a"))
    head = of.withColumnRenamed("a", "b").withColumnRenamed("of", "head")
    placed = placed.join(head, "b", "left").withColumn("head", F.coalesce("head", "b"))
    open_ = placed.filter("of <> head").select("band").distinct()
    placed = placed.join(open_, "band", "left_semi")
    far = tested.select("a", "b", (1 - F.col("shared") / F.col("united")).alias("far"))
    placed = placed.join(far, ["a", "b"], "left").withColumn(
        "far", F.when(F.col("a") == F.col("b"), 0.0).otherwise(F.col("far"))
    )
    signs = member.filter("id = class").select(F.col("class").alias("a"), "sign").dropDuplicates(["a"])
    briefs = sets.select(F.col("id").alias("a"), "brief")
    placed = stored(placed.join(signs, "a").join(briefs, "a"), "placed")
    more = _tested(_crossed(placed, percent), sets).filter(_is_link(percent)).select("a", "b")
    final = components(linked.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(more))

    reached = member.select("id", "class").distinct().join(final.withColumnRenamed("id", "class"), "class", "left")
    reached = reached.select("id", F.coalesce("component", "class").alias("component"))
    reached = reached.groupBy("id").agg(F.min("component").alias("component"))
    out = described.select("id", "n").join(reached, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
