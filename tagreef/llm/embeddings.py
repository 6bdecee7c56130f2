"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector, rotated at random, is stored as its signs and a correction
factor: the inner product of the vector with its own code. Bits of the code propose
pairs (vectors of one label whose 12 bits agree in one of 16 bands), and buckets of
codes alone, a bit for each direction, are compared first: the share of bits that
differ estimates the angle without bias, and vectors that no pair within its
confidence bound needs go no further. Only for the others the vectors are fetched.
Signs times another rotated vector, divided by the stored factor, then estimate the
inner product of the two without bias; the factor also bounds the error. Pairs
whose bound reaches the threshold are computed exactly, in doubles.
"""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagreef.llm.components import components
from tagreef.llm.tables import stored
from tagreef.llm.words import spans_of
from tagreef.operators.sizes import broadcast_if_small

#: A pair at cosine 0.98 shares a band's bits with odds of 0.45: all bands miss it with 6e-5.
BANDS, BITS = 16, 12
#: Standard deviations of an estimate that its bound allows for.
SURE = 5.0
#: The same for the share of differing bits, whose upper tail is heavier.
SURE_BITS = 6.0
#: Vectors of one side of a block.
CHUNK = 1024
#: Pairs worked out at once where buckets are small.
PAIRS = 1 << 16
#: Parts that a bucket's number has room for.
MOST_PARTS = 1 << 16

PLACE = ["id", "key", "band", "own", "i", "j"]

_rotations: dict[int, np.ndarray] = {}


def rotations(size: int) -> np.ndarray:
    """Random orthogonal matrices side by side, enough for all bits; the same at every call."""
    if size not in _rotations:
        rng = np.random.default_rng(size)
        many = -(-BANDS * BITS // size)
        _rotations[size] = np.concatenate([np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(many)], axis=1)
    return _rotations[size]


def rotate(unit: np.ndarray) -> np.ndarray:
    """Unit vectors under all rotations together, shortened to unit length."""
    rotated = unit @ rotations(unit.shape[1])
    return rotated / np.sqrt(rotated.shape[1] // unit.shape[1])


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rotated, signs, factor) of unit vectors; ``signs`` are -1 and 1, shortened to unit length."""
    rotated = rotate(unit)
    signs = np.where(rotated >= 0, 1.0, -1.0) / np.sqrt(rotated.shape[1])
    return rotated, signs, np.abs(rotated).sum(1) / np.sqrt(rotated.shape[1])


def bound(factor: np.ndarray, size: int, width: int, cosine: float) -> np.ndarray:
    """Least estimate that a pair of ``cosine`` or more may have, by the code's factor."""
    spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / np.sqrt(max(size - 1, 1) * width / size)
    return cosine - SURE * np.sqrt(max(1 - cosine**2, 0)) * spread


def most_differing(width: int, cosine: float) -> float:
    """Most bits of ``width`` in which a pair of ``cosine`` or more may differ, by the bound."""
    share = np.arccos(np.clip(cosine, -1, 1)) / np.pi
    return width * share + SURE_BITS * np.sqrt(width * share * (1 - share))


def band_bits(signs: np.ndarray) -> np.ndarray:
    bits = (signs[:, : BANDS * BITS] > 0).reshape(len(signs), BANDS, BITS)
    return (bits * (1 << np.arange(BITS))).sum(2).astype(np.int32)


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors that can be compared: not null or zero, without null or non-finite parts."""
    out: list[np.ndarray | None] = []
    for one in column:
        if not one.is_valid or one.values.null_count:
            out.append(None)
            continue
        v = one.values.to_numpy(zero_copy_only=False).astype(np.float64)
        out.append(v if len(v) and np.isfinite(v).all() and v.any() else None)
    return out


def _units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _described(rows: DataFrame) -> DataFrame:
    """(id, label, size, digest, vector, signs, factor, bands) of each row; nulls where it links with nothing."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column("v"))
            sizes = [None if v is None else len(v) for v in vectors]
            if max((n for n in sizes if n), default=0) >= MOST_PARTS:
                raise ValueError(f"a vector of {MOST_PARTS} parts or more")
            bands: list[np.ndarray | None] = [None] * len(vectors)
            packed: list[bytes | None] = [None] * len(vectors)
            factors: list[float | None] = [None] * len(vectors)
            for size in {len(v) for v in vectors if v is not None}:
                at = [k for k, v in enumerate(vectors) if v is not None and len(v) == size]
                _, signs, factor = codes(_units(np.array([vectors[k] for k in at])))
                for k, b, c, f in zip(at, band_bits(signs), np.packbits(signs > 0, axis=1), factor.tolist()):
                    bands[k], packed[k], factors[k] = b, c.tobytes(), f
            # Adding zero makes -0.0 the same as 0.0.
            raw = [None if v is None else (v + 0.0).tobytes() for v in vectors]
            digests = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("label"), pa.array(sizes, pa.int32()),
                    pa.array(digests, pa.binary()), pa.array(raw, pa.binary()), pa.array(packed, pa.binary()),
                    pa.array(factors, pa.float64()), pa.array(bands, pa.list_(pa.int32())),
                ],
                ["id", "label", "size", "digest", "vector", "signs", "factor", "bands"],
            )

    kind = "id long, label long, size int, digest binary, vector binary, signs binary, factor double, bands array<int>"
    return rows.mapInArrow(describe, kind)


def _unpacked(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Signs of stored codes as -1 and 1."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return np.where(np.unpackbits(raw, axis=1)[:, :width] > 0, 1.0, -1.0)


def width_of(size: int) -> int:
    """Bits of the code of a vector."""
    return size * -(-BANDS * BITS // size)


def open_rows(rows: pa.Table, cosine: float) -> np.ndarray:
    """Rows of blocks of codes that have a partner within the bound on differing bits."""
    size = rows.column("size")[0].as_py()
    width = width_of(size)
    signs = _unpacked(rows.column("signs"), width).astype(np.float32)
    # The product of two codes is the width less twice the differing bits.
    least = width - 2 * most_differing(width, cosine)
    key, i, j, own = (rows.column(c).to_numpy() for c in ("key", "i", "j", "own"))
    out = np.zeros(len(key), bool)
    cuts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
    for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)]):
        at = np.arange(low, high)
        mine = at if i[low] == j[low] else at[own[at] == i[low]]
        others = at if i[low] == j[low] else at[own[at] != i[low]]
        step = max(1, PAIRS // max(len(others), 1))
        for a in range(0, len(mine), step):
            near = signs[mine[a : a + step]] @ signs[others].T >= least
            if i[low] == j[low]:
                near[np.arange(len(near)), a + np.arange(len(near))] = False
            out[mine[a : a + step]] |= near.any(1)
            out[others] |= near.any(0)
    return out


class Block:
    """Vectors of one size in buckets, with their codes."""

    def __init__(self, rows: pa.Table):
        self.key, self.i, self.j = (rows.column(c).to_numpy() for c in ("key", "i", "j"))
        self.band, self.own = (rows.column(c).to_numpy() for c in ("band", "own"))
        self.id, self.copies = (rows.column(c).to_numpy() for c in ("id", "copies"))
        raw = b"".join(rows.column("vector").to_pylist())
        self.unit = _units(np.frombuffer(raw).reshape(len(self.id), -1))
        self.bands = np.array(rows.column("bands").to_pylist(), np.int32)
        self.width = width_of(self.unit.shape[1])
        self.signs = _unpacked(rows.column("signs"), self.width) / np.sqrt(self.width)
        self.factor = rows.column("factor").to_numpy()
        self.rotated = rotate(self.unit)

    def links(self, x: np.ndarray, y: np.ndarray, near: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs whose estimate reaches the bound, those that exact cosines confirm."""
        keep = near >= bound(self.factor[x], self.unit.shape[1], self.width, cosine)
        x, y = x[keep], y[keep]
        exact = np.concatenate(
            [np.einsum("ij,ij->i", self.unit[x[a : a + PAIRS]], self.unit[y[a : a + PAIRS]]) for a in range(0, len(x), PAIRS)]
            or [np.zeros(0)]
        )
        return x[exact >= cosine], y[exact >= cosine]

    def pairwise(self, x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        near = np.einsum("ij,ij->i", self.signs[x], self.rotated[y]) / self.factor[x]
        return self.links(x, y, near, cosine)

    def square(self, mine: np.ndarray, others: np.ndarray, same: bool, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of two chunks, by products of matrices, some rows at a time."""
        step = max(1, PAIRS // max(len(others), 1))
        for a in range(0, len(mine), step):
            rows = mine[a : a + step]
            near = (self.signs[rows] @ self.rotated[others].T) / self.factor[rows, None]
            x, y = np.nonzero(near >= bound(self.factor[rows], self.unit.shape[1], self.width, cosine)[:, None])
            if same:
                x, y = x[y > x + a], y[y > x + a]
            yield self.links(rows[x], others[y], near[x, y], cosine)

    def found(self, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, links, least): for each row its new links, and the least id it is tied to here."""
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        cuts = np.flatnonzero(
            np.append(True, (self.key[1:] != self.key[:-1]) | (self.i[1:] != self.i[:-1]) | (self.j[1:] != self.j[:-1]))
        )
        lengths = np.diff(np.append(cuts, len(self.key)))
        small = (lengths <= 32) & (self.i[cuts] == self.j[cuts])
        # Small buckets: every row with the rows behind it, all buckets at once.
        begin, n = cuts[small], lengths[small]
        row = np.repeat(begin, n) + spans_of(n)
        rest = np.repeat(begin + n, n) - row - 1
        x, y = np.repeat(row, rest), np.repeat(row + 1, rest) + spans_of(rest)
        for a in range(0, len(x), PAIRS):
            pairs.append(self.pairwise(x[a : a + PAIRS], y[a : a + PAIRS], cosine))
        for low, length in zip(cuts[~small].tolist(), lengths[~small].tolist()):
            at = np.arange(low, low + length)
            if self.i[low] == self.j[low]:
                pairs += self.square(at, at, True, cosine)
            else:
                mine = self.own[at] == self.i[low]
                pairs += self.square(at[mine], at[~mine], False, cosine)
        x, y = (np.concatenate(p) for p in zip(*pairs)) if pairs else (row[:0], row[:0])
        counts = np.zeros(len(self.id), np.int64)
        for a in range(0, len(x), PAIRS):
            p, q = x[a : a + PAIRS], y[a : a + PAIRS]
            # A pair counts in the first band in which it meets.
            new = (self.bands[p] == self.bands[q]).argmax(1) == self.band[p]
            np.add.at(counts, p[new], self.copies[q[new]])
            np.add.at(counts, q[new], self.copies[p[new]])
        return self.id, counts, self._least(x, y)

    def _least(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The least id in each row's component of the pairs."""
        root = np.arange(len(self.id))
        while len(x):
            low = np.where(self.id[root[x]] <= self.id[root[y]], root[x], root[y])
            old = root.copy()
            for side in (x, y):
                # Of several candidates for one root any smaller one will do; rounds repeat.
                better = self.id[low] < self.id[root[old[side]]]
                root[old[side[better]]] = low[better]
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
            apart = root[x] != root[y]
            x, y = x[apart], y[apart]
        return self.id[root]


def _block_rows(classes: DataFrame) -> DataFrame:
    """A row for each bucket (or block of two chunks of a large bucket) that a vector is in: its code, not itself."""
    slim = classes.select("id", "label", "size", "signs", F.posexplode("bands").alias("band", "bits"))
    # One number per label, size, band and bits; labels are 32-bit numbers.
    key = F.shiftleft(F.col("label"), 32) + F.shiftleft(F.col("size").cast("long"), 16)
    key = key + F.col("band") * (1 << BITS) + F.col("bits")
    slim = slim.select("id", "size", "signs", "band", key.alias("key"))
    full = slim.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    met = slim.join(broadcast_if_small(stored(full, "buckets")), "key")
    parts = F.ceil(F.col("m") / CHUNK).cast("int")
    met = met.withColumn("own", F.pmod(F.xxhash64("id"), parts).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    i, j = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    return met.select("id", "size", "signs", "key", "band", "own", i, j)


def _by_block(blocks: DataFrame, done: Callable[[pa.Table], pa.RecordBatch], kind: str) -> DataFrame:
    """What ``done`` makes of whole blocks, of one size and a few thousand rows at a time."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            mark = np.column_stack([batch.column(c).to_numpy() for c in ("size", "key", "i", "j")])
            changes = np.flatnonzero((mark[1:] != mark[:-1]).any(1)) + 1
            for low, high in zip([0, *changes.tolist()], [*changes.tolist(), len(mark)]):
                fresh = tuple(mark[low]) != last
                if held and fresh and (mark[low][0] != last[0] or sum(b.num_rows for b in held) >= 4 * CHUNK):
                    yield done(pa.Table.from_batches(held))
                    held.clear()
                held.append(batch.slice(low, high - low))
                last = tuple(mark[low])
        if held:
            yield done(pa.Table.from_batches(held))

    dealt = blocks.repartition("key", "i", "j").sortWithinPartitions("size", "key", "i", "j")
    return dealt.mapInArrow(compare, kind)


def near_vectors(
    rows: DataFrame, cosine: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Vectors of one label are linked if their cosine, in doubles, is ``cosine`` or
    more; no pair below it is. ``n_links`` counts the other vectors linked
    directly, ``component_id`` is the least id reachable. Vectors that are null,
    empty or zero or hold null or non-finite parts, rows with a null label or id,
    and vectors of different sizes link with nothing; a null id has a null
    component and is kept. Repeated rows are vectors of their own that are
    linked; rows that share an id but no vector are judged each for itself.
    Labels must be 32-bit numbers; a vector of 65536 parts or more is an error.

    Equal vectors are one class and compared once. Large buckets meet in blocks
    of chunks; each block returns a row per vector, never pairs. Blocks of codes
    come first, 24 bytes and a place a row; vectors join only the rows that these
    leave open.
    """
    slim = rows.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("int").cast("long").alias("label"), F.col(vector).alias("v")
    )
    described = stored(_described(slim), "vectors")
    valid = described.filter("digest IS NOT NULL AND label IS NOT NULL AND id IS NOT NULL")
    # Of the rows of a class one stands for it; a class's number must be its own.
    valid = valid.withColumn("class", F.xxhash64("label", "digest"))
    classes = valid.groupBy("class").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.min("label").alias("label"),
        F.min("size").alias("size"), *(F.first(c).alias(c) for c in ("vector", "signs", "factor", "bands")),
    )
    classes = stored(classes.withColumnRenamed("class", "id"), "classes")

    def undecided(rows: pa.Table) -> pa.RecordBatch:
        kept = rows.filter(pa.array(open_rows(rows, cosine)))
        return pa.RecordBatch.from_arrays([kept.column(c).combine_chunks() for c in PLACE], PLACE)

    def linked(rows: pa.Table) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in Block(rows).found(cosine)], ["id", "links", "least"])

    kind = "id long, key long, band int, own int, i int, j int"
    open_ = stored(_by_block(_block_rows(classes), undecided, kind), "undecided")
    blocks = open_.join(classes.select("id", "size", "copies", "vector", "signs", "factor", "bands"), "id")
    found = stored(_by_block(blocks, linked, "id long, links long, least long"), "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    tied = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")))
    # Components of class numbers, then the least vector id of each.
    member = classes.select("id", "least", "copies").join(counts, "id", "left").join(tied, "id", "left")
    member = member.withColumn("component", F.coalesce("component", "id"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    member = member.join(least, "component").select(
        F.col("id").alias("class"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = described.select("id", F.when(F.col("digest").isNotNull(), F.xxhash64("label", "digest")).alias("class"), "label")
    out = out.withColumn("class", F.when(F.col("label").isNotNull() & F.col("id").isNotNull(), F.col("class")))
    out = out.join(member, "class", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
