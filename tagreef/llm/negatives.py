"""Hard negatives by bounds along spanning trees of anchors.

Anchors near each other form a block of at most ``ANCHORS``, joined by the least
spanning tree of their distances. Against a chunk of rows only the root is scored
outright. A child's score of a row lies within the parent's plus or minus the
length of the edge times the row's norm; only rows whose bounds overlap what the
child still looks for are scored anew, all others keep their bounds for the
child's own children.

The search runs twice: first for the positives, then, with the windows of scores
that these set, for the negatives. Rows stay in chunks of bounded size, each in one
task; the blocks of anchors are sent past every chunk one after the other, and a
task keeps no more than the best few of each anchor and chunk.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagreef.llm.tables import stored
from tagreef.operators.numbering import with_index
from tagreef.operators.sizes import broadcast_if_small

SCALE = 256
ANCHORS = 1024
#: Rows of a chunk, at most and at least (on average).
CHUNK, LEAST_CHUNK = 1 << 15, 512
#: Bits of the code that brings near anchors into one block.
BITS = 16
#: Norms below this keep every score an exact double.
NORM_LIMIT = 1 << 26

VECTOR = "row long, id long, label long, size int, norm double, vector binary"


def whole_vectors(column: pa.Array, scale: int = SCALE) -> list[np.ndarray | None]:
    """``floor(scale * x)`` of the vectors that take part, as doubles; None for the others."""
    out: list[np.ndarray | None] = []
    for one in column:
        v = None
        if one.is_valid and not one.values.null_count:
            v = one.values.to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore"):
                v = np.floor(v * scale) if np.isfinite(v).all() else None
        out.append(v if v is not None and np.abs(v).max(initial=0) < NORM_LIMIT and np.linalg.norm(v) < NORM_LIMIT else None)
    return out


def signs(v: np.ndarray) -> int:
    """Signs of a vector's products with random directions, as a number."""
    directions = np.random.default_rng(len(v)).normal(size=(len(v), BITS))
    return int(((v @ directions) > 0) @ (1 << np.arange(BITS)))


def spanning_tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of the least spanning tree of vectors.

    ``order`` lists the vectors as a walk from the root visits them, ``parent`` and
    ``edge`` go with it, parents as places in the walk. Of several children the one
    with the most vectors below it comes last, so that a walk holds the bounds of no
    more than log2(n) vectors that still have children to come.
    """
    n = len(v)
    squares = (v * v).sum(1)
    near = np.full(n, np.inf)
    up = np.full(n, -1)
    done = np.zeros(n, bool)
    joined = []
    node = 0
    for _ in range(n):
        done[node] = True
        joined.append(node)
        d = squares + squares[node] - 2 * (v @ v[node])
        closer = ~done & (d < near)
        near[closer], up[closer] = d[closer], node
        node = int(np.where(done, np.inf, near).argmin())
    below = np.ones(n, int)
    children: list[list[int]] = [[] for _ in range(n)]
    for node in reversed(joined[1:]):
        below[up[node]] += below[node]
        children[up[node]].append(node)
    order, stack = [], [0]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += sorted(children[node], key=lambda c: -below[c])
    place = np.empty(n, int)
    place[order] = np.arange(n)
    parent = np.array([-1 if up[k] < 0 else place[up[k]] for k in order])
    edge = np.array([0.0 if up[k] < 0 else np.sqrt(((v[k] - v[up[k]]) ** 2).sum()) for k in order])
    return np.array(order), parent, edge


@dataclass
class Rows:
    """Rows of one chunk."""

    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    norm: np.ndarray
    vector: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> "Rows":
        n, size = len(rows), rows.column("size")[0].as_py()
        vector = np.frombuffer(b"".join(rows.column("vector").to_pylist()), "<i4").reshape(n, size).astype(float)
        return cls(*(rows.column(c).to_numpy() for c in ("row", "id", "label", "norm")), vector)

    def first(self, at: np.ndarray, score: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``n`` best of some rows with their scores; of equal scores the smaller id."""
        best = np.lexsort((self.id[at], -score))[:n]
        return at[best], score[best]


Bounds = tuple[np.ndarray, np.ndarray]


def walked(
    chunk: Rows, anchors: Rows, parent: np.ndarray, edge: np.ndarray, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores) down a tree: the rows that ``wanted`` names by the bounds, scored exactly.

    ``wanted(k, low, high)`` flags rows of the chunk that anchor ``k`` needs.
    """
    children = np.bincount(parent[parent >= 0], minlength=len(parent))
    held: dict[int, Bounds] = {}
    for k, up in enumerate(parent.tolist()):
        if up < 0:
            low = high = chunk.vector @ anchors.vector[k]
            flags = wanted(k, low, high)
        else:
            low, high = held[up]
            children[up] -= 1
            if not children[up]:
                del held[up]
            if edge[k]:
                # An equal vector has its parent's very bounds, and what it scores is the parent's too.
                gap = edge[k] * (1 + 1e-9) * chunk.norm
                low, high = low - gap, high + gap
            flags = wanted(k, low, high)
            open_ = np.flatnonzero(flags & (low < high))
            if len(open_):
                exact = chunk.vector[open_] @ anchors.vector[k]
                if low is high:
                    low, high = low.copy(), high.copy()
                low[open_] = exact
                high[open_] = exact
        if children[k]:
            held[k] = low, high
        at = np.flatnonzero(flags)
        yield k, at, low[at]


def least_of_best(values: np.ndarray, n: int) -> float:
    """The n-th greatest value; below all if there are fewer."""
    return float(np.partition(values, len(values) - n)[len(values) - n]) if len(values) >= n else -np.inf


def positives_of(chunk: Rows, anchors: Rows, parent: np.ndarray, edge: np.ndarray, n: int) -> Iterator[tuple]:
    """(anchor's row, id, score) of the best ``n`` rows of the anchor's label in a chunk, itself left out."""

    def wanted(k: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        same = (chunk.label == anchors.label[k]) & (chunk.row != anchors.row[k])
        return same & (high >= least_of_best(low[same], n))

    for k, at, score in walked(chunk, anchors, parent, edge, wanted):
        best, score = chunk.first(at, score, n)
        for i, s in zip(best.tolist(), score.tolist()):
            yield int(anchors.row[k]), int(chunk.id[i]), int(s)


def negatives_of(
    chunk: Rows, anchors: Rows, parent: np.ndarray, edge: np.ndarray, windows: list[list[tuple[int, int, int]]], n: int
) -> Iterator[tuple]:
    """(anchor's row, window, id, score) of the best ``n`` rows of other labels in each window.

    ``windows`` has the (number, least, most) of every anchor.
    """

    def wanted(k: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        other = chunk.label != anchors.label[k]
        low, high = np.where(other, low, -np.inf), np.where(other, high, -np.inf)
        flags = np.zeros(len(low), bool)
        for least, most in {w[1:] for w in windows[k]}:
            # Rows that are surely not above the window show what must be reached.
            floor = max(least_of_best(low[high <= most], n), least)
            flags |= (high >= floor) & (low <= most)
        return flags

    for k, at, score in walked(chunk, anchors, parent, edge, wanted):
        for number, least, most in windows[k]:
            inside = (score >= least) & (score <= most)
            best, found = chunk.first(at[inside], score[inside], n)
            for i, s in zip(best.tolist(), found.tolist()):
                yield int(anchors.row[k]), number, int(chunk.id[i]), int(s)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The sorted rows of a partition, one table for each run of equal keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        marks = np.column_stack([batch.column(c).to_numpy() for c in keys])
        edges = (np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1).tolist()
        for low, high in zip([0, *edges], [*edges, len(marks)]):
            mark = tuple(marks[low].tolist()) if high > low else last
            if held and mark != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = mark
    if held and last is not None:
        yield last, pa.Table.from_batches(held)


PLACE = ["size", "chunk", "block"]


def _search(chunks: DataFrame, anchors: DataFrame, count: int, search: Callable[[Rows, pa.Table], Iterator[tuple]], kind: str) -> DataFrame:
    """What ``search`` finds for each block of anchors in each chunk of its size.

    ``chunks`` come with block -1, before the anchors of their chunk.
    """
    names = [part.split()[0] for part in kind.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, at = None, None
        for (size, number, block), rows in _runs(batches, PLACE):
            if block < 0:
                chunk, at = Rows.of(rows), (size, number)
            elif at == (size, number):
                found = list(search(chunk, rows)) or [()]
                columns = zip(*found) if found[0] else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    met = chunks.withColumn("block", F.lit(-1).cast("long")).unionByName(anchors, allowMissingColumns=True)
    met = met.repartition(count, "size", "chunk").sortWithinPartitions(*PLACE, "place")
    return met.mapInArrow(run, kind)


def _tree(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("place")
    order, parent, edge = spanning_tree(Rows.of(rows).vector)
    rows = rows.take(pa.array(order))
    place = rows.schema.get_field_index("place")
    rows = rows.set_column(place, "place", pa.array(np.arange(len(order))))
    return rows.append_column("parent", pa.array(parent)).append_column("edge", pa.array(edge))


def mine_negatives(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components x become ``floor(SCALE * x)``, x as double; a score is the integer
    inner product. Higher scores come first, of equal ones the smaller id. An
    anchor's positives are its first ``positives`` other rows of its label; for each
    of them the first ``negatives`` rows of other labels whose score is between
    ``low`` and ``high`` hundredths of the positive's are returned, both ends
    included. ``anchor`` tells which rows are anchors, over the columns of ``rows``.

    Rows with a null id, label or vector, or with a null or non-finite component,
    take no part, nor do vectors so long (``NORM_LIMIT``) that doubles could not hold
    their scores. Vectors of other sizes than the anchor's are not scored; empty
    vectors score 0. Repeated rows are rows of their own: each may be the positive
    or negative of any other, and an anchor that repeats is mined once for each.
    Other columns play no part. An empty table gives no rows.
    """
    slim = rows.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector).alias("v"),
    ).dropna(subset=["id", "label", "v"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = whole_vectors(batch.column("v"))
            at = pa.array([k for k, v in enumerate(vectors) if v is not None], pa.int64())
            good = [v for v in vectors if v is not None]
            flags = batch.column("anchor").to_pylist()
            codes = [signs(v) if flags[k] else 0 for k, v in zip(at.to_pylist(), good)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(at) for c in ("id", "label", "anchor")), pa.array([len(v) for v in good], pa.int32()),
                    pa.array([float(np.linalg.norm(v)) for v in good], pa.float64()), pa.array(codes, pa.int32()),
                    pa.array([v.astype("<i4").tobytes() for v in good], pa.binary()),
                ],
                ["id", "label", "anchor", "size", "norm", "code", "vector"],
            )

    kind = "id long, label long, anchor boolean, size int, norm double, code int, vector binary"
    valid = slim.mapInArrow(describe, kind).withColumn("row", F.monotonically_increasing_id())
    valid = stored(valid, "whole-vectors")
    fields = [part.split()[0] for part in VECTOR.split(", ")]

    # Near anchors side by side; blocks of one size; a tree for each block.
    placed = with_index(valid.filter("anchor").select(*fields, "code"), ["size", "code", "row"], "place")
    placed = placed.withColumn("block", F.floor(F.col("place") / ANCHORS)).select(*fields, "block", "place")
    kind = f"{VECTOR}, block long, place long, parent long, edge double"
    trees = stored(placed.groupBy("size", "block").applyInArrow(_tree, kind), "trees")

    total = valid.count()
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = min(max(-(-total // tasks), LEAST_CHUNK), CHUNK)
    sizes = valid.groupBy("size").agg(F.ceil(F.count("*") / each).alias("chunks"))
    sizes = stored(sizes, "sizes")
    count = sizes.agg(F.sum("chunks")).first()[0] or 1
    sizes = broadcast_if_small(sizes)
    chunks = valid.join(sizes, "size").withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks"))).select(*fields, "chunk")

    def sent(anchors: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
        return anchors.join(sizes, "size").withColumn("chunk", every).drop("chunks")

    def nearest(chunk: Rows, anchors: pa.Table) -> Iterator[tuple]:
        tree = anchors.column("parent").to_numpy(), anchors.column("edge").to_numpy()
        return positives_of(chunk, Rows.of(anchors), *tree, positives)

    near = _search(chunks, sent(trees), count, nearest, "row long, positive_id long, positive_score long")
    best = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("number", F.row_number().over(best).cast("long")).filter(F.col("number") <= positives)
    near = stored(near, "positives")

    span = F.struct("number", "positive_score")
    spans = near.groupBy("row").agg(F.collect_list(span).alias("spans"))
    looking = stored(trees.join(spans, "row", "left"), "windows")

    def windows(spans: list[dict] | None) -> list[tuple[int, int, int]]:
        found = [(s["number"], -(-low * s["positive_score"] // 100), high * s["positive_score"] // 100) for s in spans or []]
        return [w for w in found if w[1] <= w[2]]

    def hard(chunk: Rows, anchors: pa.Table) -> Iterator[tuple]:
        tree = anchors.column("parent").to_numpy(), anchors.column("edge").to_numpy()
        return negatives_of(chunk, Rows.of(anchors), *tree, [windows(s) for s in anchors.column("spans").to_pylist()], negatives)

    found = _search(chunks, sent(looking), count, hard, "row long, number long, negative_id long, negative_score long")
    best = Window.partitionBy("row", "number").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    found = found.join(near, ["row", "number"]).join(trees.select("row", "id"), "row")
    return found.select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
