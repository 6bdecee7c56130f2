"""Tables in which one key holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from tagreef.operators.accounts import apply_signups
from tagreef.operators.labels import add_translations
from tagreef.operators.repeats import drop_repeats
from tagreef.operators.search import request_sizes, search_batch
from tagreef.schema import ACCOUNTS

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """``id`` and a name that is ``hot`` for a third of the rows, else unique."""
    name = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), F.col("id")))
    return spark.range(N).select("id", name.alias("name"))


def test_requests_are_not_multiplied(spark, hot):
    catalog = hot.select(
        F.col("id").cast("string").alias("path"),
        F.col("name").alias("features"),
        F.lit("u").alias("binary"),
    )
    words = F.array(F.lit("hot"), F.lit("n29999"), F.lit("29998"))
    requests = hot.select(
        F.col("id").alias("request_id"),
        F.when(F.col("name") == "hot", F.lit("HOT"))
        .otherwise(F.element_at(words, (F.col("id") % 3 + 1).cast("int")))
        .alias("keyword"),
    )
    for literal in (200, 0):
        hits = search_batch(catalog, requests, "path", literal_keywords=literal)
        counts = {r["keyword"]: r["count"] for r in hits.groupBy("keyword").count().collect()}
        assert counts == {"HOT": N // 3, "n29999": 1, "29998": 1}
        sizes = request_sizes(requests, hits)
        assert sizes.count() == N
        assert sizes.agg(F.sum("n_hits")).first()[0] == (N // 3) * (N // 3) + 2 * (N // 3)


def test_signups_for_one_name(spark, hot):
    signups = hot.select(
        F.col("id").alias("seq"), F.col("name").alias("username"), F.lit(8).alias("password_length"),
        F.lit("h").alias("password_hash"), F.lit("").alias("email"),
    )
    accounts, outcomes = apply_signups(spark.createDataFrame([], ACCOUNTS), signups)
    distinct = N - N // 3 + 1
    assert accounts.count() == distinct
    ids = accounts.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(ids) == (1, distinct, distinct)
    status = {r["status"]: r["count"] for r in outcomes.groupBy("status").count().collect()}
    assert status == {"Signup successful": distinct, "Username taken": N // 3 - 1}


def test_labels_of_one_word(spark, hot):
    labels = hot.select(F.col("id").alias("path"), F.lit(0).alias("pos"), "name")
    words = spark.createDataFrame(
        [("en", "hot", "zh-CN", "热")],
        "src_lang string, term string, dst_lang string, translation string",
    )
    translated = add_translations(labels, words)
    assert translated.count() == N
    assert translated.filter("translation = '热'").count() == N // 3
    plan = translated._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_copies_of_one_image(spark, hot):
    batch = hot.select(
        F.lit("p").alias("path"), F.lit("f").alias("features"),
        F.concat(F.lit("data:image/png;base64,"), F.col("name")).alias("binary"),
    )
    assert drop_repeats(batch, batch.limit(0)).count() == N - N // 3 + 1
    held = batch.filter(F.col("binary").endswith("hot"))
    assert drop_repeats(batch, held).count() == N - N // 3
