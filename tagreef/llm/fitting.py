"""What the classifiers share: a bounded labelled sample and sums over partitions."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows that a classifier is fitted on.
FIT_ROWS = 50_000


def labelled(docs: DataFrame, labels: DataFrame, label: str, train: Column, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled documents that ``train`` allows.

    The sample holds the smallest hashes of ids, so that it is the same at every
    run; its ids and labels, 16 bytes a row, are broadcast to the documents. Ids
    with several labels have the greatest; null ids and labels are left out.
    """
    known = labels.filter(train).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y")).dropna()
    known = known.groupBy("doc_id").agg(F.max("y").cast("double").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(sample), "doc_id")


Batches = Iterator[pa.RecordBatch]


def summed(
    rows: DataFrame,
    sums: Callable[[pa.RecordBatch], dict[str, np.ndarray]],
    shapes: dict[str, tuple],
    grouped: Callable[[Batches], Batches] = iter,
) -> dict[str, np.ndarray]:
    """Arrays that ``sums`` makes of each batch, added up over all rows.

    ``grouped`` may gather or split a partition's batches first.

    Every partition adds up its own batches; Spark adds the partitions, cell by
    cell. Only the sums, whose size is that of ``shapes``, reach the driver.
    """
    names = list(shapes)
    sizes = [int(np.prod(shapes[n])) for n in names]
    starts = np.cumsum([0, *sizes])

    def cells(batches: Batches) -> Batches:
        total = np.zeros(starts[-1])
        for batch in grouped(batches):
            for name, part in sums(batch).items():
                k = names.index(name)
                total[starts[k] : starts[k + 1]] += np.asarray(part, float).ravel()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "value"])

    added = rows.mapInArrow(cells, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    total = np.zeros(starts[-1])
    for cell, value in added.collect():
        total[cell] = value
    return {n: total[a:b].reshape(shapes[n]) for n, a, b in zip(names, starts, starts[1:])}


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An array column of equal lengths as a matrix."""
    return np.asarray(column.flatten(), float).reshape(len(column), width)
