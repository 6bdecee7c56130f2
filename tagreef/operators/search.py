"""Keyword search: one keyword, or a table of requests."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagreef.functions.keyword import clean_keyword, compile_keyword, fixed_chars, matches_keyword, pattern_of
from tagreef.operators.automaton import TRIE_BYTES, walk_keywords
from tagreef.operators.sizes import broadcast_if_small
from tagreef.shared import saved

# Up to this many distinct keywords become literal predicates of one scan.
LITERAL_KEYWORDS = 200


def image_text() -> Column:
    """The image column of a hit; a missing one prints as ``None``."""
    return F.coalesce("binary", F.lit("None")).alias("binary")


def search(catalog: DataFrame, keyword: str, *keep: str) -> DataFrame:
    """Images whose features match the keyword, in scan order.

    ``keep`` names further catalog columns to return before the image.
    """
    hits = catalog.filter(matches_keyword(F.col("features"), keyword))
    return hits.select(*keep, image_text())


def search_request(catalog: DataFrame, keyword: str, *keep: str) -> DataFrame:
    """A user's request: the empty keyword gives no result, a blank gives all."""
    if keyword == "":
        return catalog.select(*keep, image_text()).limit(0)
    return search(catalog, keyword, *keep)


def asked_keywords(requests: DataFrame) -> DataFrame:
    """Distinct keywords of a request table; empty ones ask for nothing."""
    return requests.filter(F.col("keyword") != "").select("keyword").distinct()


def search_batch(
    catalog: DataFrame,
    requests: DataFrame,
    *keep: str,
    literal_keywords: int = LITERAL_KEYWORDS,
    slice_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """``(keyword, kept columns, binary)``: the hits of every distinct keyword asked.

    Requests with the same keyword share one result set, so a keyword asked by
    a third of all requests is searched and returned once; see
    :func:`request_sizes` for the way back to requests.

    Few keywords are literal predicates of one scan. More are walked over the tags
    together, see :mod:`tagreef.operators.automaton`. Neither way shuffles the catalog.
    """
    keywords = asked_keywords(requests)
    columns = ["keyword", *keep, image_text()]
    both = keywords.select("keyword", clean_keyword(F.col("keyword")))
    few = [tuple(row) for row in both.limit(literal_keywords + 1).collect()]
    if len(few) <= literal_keywords:
        return catalog.withColumn("keyword", F.explode(_literal_hits(few))).select(*columns)

    found = walk_keywords(catalog, saved(both.toDF("keyword", "clean")), slice_bytes)
    return reduce(DataFrame.unionAll, [hits.select(*columns) for hits in found])


def _literal_hits(keywords: list[tuple[str, str]]) -> Column:
    """Array of the keywords a row matches; the empty array without keywords.

    A keyword comes with its cleaned form.

    One SQL expression: hundreds of tests built column by column would take the
    driver longer than many a search. The lambda names the text, so that it is
    computed once for all tests.
    """
    tests = ", ".join(_literal_hit(keyword, clean) for keyword, clean in keywords)
    hits = f"array_compact(CAST(array({tests}) AS array<string>))"
    return F.expr(f"flatten(transform(array(features), t -> {hits}))")


def _literal_hit(keyword: str, clean: str) -> str:
    """:func:`matches_keyword` on ``t`` in SQL, giving the keyword or NULL."""
    pattern = pattern_of(clean)
    tests = [f"contains(t, {_literal(char)})" for char in fixed_chars(pattern)]
    if pattern.strip("%"):
        tests.append(f"rlike(t, {_literal(compile_keyword(pattern))})")
    return f"CASE WHEN {' AND '.join(tests) or 't IS NOT NULL'} THEN {_literal(keyword)} END"


def _literal(text: str) -> str:
    """A text as SQL, by its bytes: no quoting rule applies."""
    return f"CAST(X'{text.encode().hex()}' AS STRING)"


def request_sizes(requests: DataFrame, hits: DataFrame) -> DataFrame:
    """``(request_id, keyword, n_hits)``: each request and the size of its result.

    Hits are counted per keyword before they meet the requests, so the join is
    many to one: no request row is multiplied, and none is shuffled either as
    long as the counts are small.
    """
    counts = saved(hits.groupBy("keyword").agg(F.count("*").alias("n_hits")))
    return requests.join(broadcast_if_small(counts), "keyword", "left").select(
        "request_id", "keyword", F.coalesce("n_hits", F.lit(0)).alias("n_hits")
    )
