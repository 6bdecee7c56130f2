"""A training corpus from documents, in stages: each is written and read again.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``documents``; the last adds the piece ids. Columns that ``docs`` has
beside these come back unchanged, whatever they are called (the last stage's own
two excepted). Rows without an id pass the near-duplicate and passage stages
unchanged, since both go by ids. An empty table stays empty.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagreef.llm import decontaminate as contamination
from tagreef.llm.minmax import first_of_groups
from tagreef.llm.pieces import encode_texts
from tagreef.llm.quality import fit_quality
from tagreef.llm.registry import PIECES
from tagreef.llm.repeats import remove_repeats
from tagreef.llm.tables import own_names, remainder, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents whose score is lower are rejected.
QUALITY = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labelled ones of them, accepts.

    A score of exactly ``QUALITY`` is accepted. Null and empty texts have the score
    of a text without anything to count. Repeated rows are judged each for itself;
    without any labelled document every score is 0.5 and none is accepted.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    own, back = own_names(docs)
    scored = model.score(own, text=own.columns[docs.columns.index("text")], name="score")
    return back(scored.filter(F.col("score") >= QUALITY))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Texts that share an id are documents of their own; see :func:`first_of_groups`.
    Null and empty texts are nobody's duplicates.
    """
    return first_of_groups(docs, size=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their passages of 20 words or more that came before.

    ``n_chars`` of a document that lost words is counted anew. Null, empty and short
    texts keep all they have; rows that share an id are one document, each cut by
    itself; see :func:`remove_repeats`.
    """
    own, back = own_names(docs)
    doc_id, text, n_chars = (own.columns[docs.columns.index(c)] for c in ("doc_id", "text", "n_chars"))
    cut = remove_repeats(own, doc_id, text, form="text")
    counted = F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col(n_chars))
    return back(cut.withColumn(n_chars, counted))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages.

    Null and empty texts have no words and stay; a document of which exactly a
    twentieth is hit goes. Repeated rows are judged each for itself.
    """
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its piece ids ``ids`` and their number ``n_pieces``.

    A null text has null ids and no pieces, an empty one none. Input columns of
    these two names are replaced.
    """
    coded = encode_texts(docs, PIECES)
    return coded.withColumn("n_pieces", F.coalesce(F.size("ids"), F.lit(0)).cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", sentencepiece),
]

#: Several stages are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
