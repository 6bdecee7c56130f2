"""The queries of this subpackage: one per operator, and their SQL where SQL can say it."""

from collections.abc import Callable

from public_tokenizers import PATTERN
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagreef.llm import decontaminate as contamination
from tagreef.llm import oracle
from tagreef.llm.embeddings import near_vectors
from tagreef.llm.hmm import score_texts
from tagreef.llm.manifest import leaf_of, merkle_manifest
from tagreef.llm.minmax import near_duplicates
from tagreef.llm.negatives import mine_negatives
from tagreef.llm.pieces import decode_ids, encode_texts
from tagreef.llm.quality import fit_quality
from tagreef.llm.repeats import remove_repeats
from tagreef.llm.rules import COUNTS, apply_rules, fit_rules
from tagreef.llm.tables import remainder, table
from tagreef.llm.tokens import count_tokens, token_ranks, write_token_files
from tagreef.llm.toxicity import fit_toxicity
from tagreef.llm.urls import RULES, judge_urls
from tagreef.shared import scratch_path

#: A public SentencePiece model with byte fallback.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"

#: A public byte-level vocabulary; the id behind its last one is free and separates documents.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SEPARATOR = 50256

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLE[query.__name__] = sql
        return query

    return add


@register(oracle.DECONTAMINATION)
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.find_benchmark_spans(docs, table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        contamination.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(names, "UTF-8"), 256).alias("items_sha256"),
        contamination.is_contaminated().alias("contaminated"),
    )


@register(oracle.NEAR_DUPLICATES)
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@register(oracle.SUBSTRING_DEDUP)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), form="words")
    digest = F.sha2(F.encode("text", "UTF-8"), 256)
    return found.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


@register()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    scored = model.score(docs)
    return scored.select(
        "doc_id",
        (remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@register()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    scored = model.score(docs)
    return scored.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@register()
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, remainder("doc_id", 5) == 1)


RULES_SQL = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in RULES)


@register(
    f"""WITH parts AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        split AS (
            SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(regexp_replace(coalesce(rest, ''), '^[^/?#]*', ''), '^[^?#]*') AS path
            FROM parts),
        rules(verdict, host, path) AS (VALUES {RULES_SQL}),
        ranked AS (
            SELECT s.page_id, s.host, s.path, r.host || r.path AS rule, r.verdict,
                row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC) AS place
            FROM split AS s LEFT JOIN rules AS r
            ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE place = 1"""
)
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@register()
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode_ids(encode_texts(docs, PIECES), PIECES, name="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        (F.col("decoded").eqNullSafe(F.col("text"))).alias("exact"),
    )


@register()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token files, counted again by their separators."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = scratch_path(spark, "tokens")
    written = write_token_files(docs, folder, token_ranks(RANKS), PATTERN, SEPARATOR)
    counted = count_tokens(written, SEPARATOR)
    return counted.join(written.select("path", "doc", "doc_id"), ["path", "doc"]).select("doc_id", "n_tokens")


@register(oracle.NEAR_VECTORS)
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


LEAF = ("doc_id", "source", "lang", "n_chars", "text")


@register(oracle.MANIFEST)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of all documents; where 7 divides an id's checksum, ``n_chars`` has been tampered with."""
    docs = table(spark, sf_dir, "documents").select(*LEAF)
    changed = (F.col(c) + 1 if c == "n_chars" else F.col(c) for c in LEAF)
    tampered = F.col("doc_id").isNotNull() & (remainder("doc_id", 7) == 0)
    return merkle_manifest(docs, leaf_of(*map(F.col, LEAF)), F.when(tampered, leaf_of(*changed)))


@register()
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_rules(docs, table(spark, sf_dir, "labels"), F.lit(True))
    judged = apply_rules(docs, model)
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "probability")


@register(oracle.HARD_NEGATIVES)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; labels of every seventh are wrong on purpose."""
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", wrong)
    return mine_negatives(rows, F.col("vec_id") % 50 == 0)
