"""URL rules by host suffix and path prefix, found through short hash prefixes.

Every URL stands for the expressions that could rule it: its host and each
domain above, with each beginning of its path that ends in "/". Expressions and
rules meet on the first four bytes of their SHA-256, as if the list of rules
were published in that form; full digests confirm, the longest rule wins.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagreef.llm.tables import stored
from tagreef.operators.sizes import broadcast_if_small

PREFIX_BYTES = 4

# Fixed values: (verdict, host, path) of the rules of the query.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """What stands between the first "://" and the next "/", "?" or "#", A-Z lowered."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def digest(expression: Column) -> Column:
    return F.sha2(F.encode(expression, "UTF-8"), 256)


def _depth(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _heads(path: Column, depth: int) -> Column:
    """Beginnings of a path that end in "/", of up to ``depth`` slashes."""
    parts = F.split(F.substring_index(path, "/", depth), "/", -1)
    whole = F.when(_depth(path, "/") < depth, F.size(parts) - 1).otherwise(F.size(parts))
    count = F.least(whole, F.lit(depth))
    ends = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(ends, lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))


def _tails(host: Column, labels: int) -> Column:
    """A host and the domains above it, of up to ``labels`` labels."""
    parts = F.split(F.substring_index(host, ".", -labels), r"\.", -1)
    sizes = F.sequence(F.lit(1), F.size(parts))
    return F.transform(sizes, lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has string columns ``verdict``, ``host`` and ``path``; a path ends in
    "/". A rule fits its host and all subdomains, if the path of the URL starts
    with the rule's. Of fitting rules the longest text (host and path) wins, and
    of one rule listed with several verdicts "block". ``rule`` is that text, or
    null where none fits; then the verdict is ``otherwise``. Rules with a null
    are left out. A null URL, or one without "://", has an empty host and path,
    which no rule fits. Input columns of the names added are replaced.

    URLs are judged once per distinct host and beginning of the path, cut to the
    deepest rule: the expressions of a URL are no more than labels times slashes
    of the rules, however long it is.
    """
    rules = rules.select("verdict", F.col("host").alias("rule_host"), F.col("path").alias("rule_path")).dropna()
    rules = rules.filter("rule_host <> ''")
    wrong = rules.filter(~F.col("rule_path").endswith("/") | ~F.col("rule_path").startswith("/")).limit(1).count()
    if wrong:
        raise ValueError("the path of a rule begins and ends with /")
    labels, slashes = rules.agg(
        F.coalesce(F.max(_depth(F.col("rule_host"), ".")) + 1, F.lit(1)),
        F.coalesce(F.max(_depth(F.col("rule_path"), "/")), F.lit(1)),
    ).first()
    text = F.concat("rule_host", "rule_path")
    listed = rules.groupBy(text.alias("rule")).agg(F.max("verdict").alias("ruled"))
    listed = listed.withColumn("full", digest(F.col("rule"))).withColumn("short", F.substring("full", 1, 2 * PREFIX_BYTES))

    places = [f"_{k}" for k in range(len(pages.columns))]  # names that cannot clash
    own = pages.toDF(*places)
    address = F.col(places[pages.columns.index(url)])
    own = own.withColumn("host", host_of(address)).withColumn("path", path_of(address))
    head = F.when(_depth(F.col("path"), "/") < slashes, F.regexp_replace("path", "[^/]*$", "")).otherwise(
        F.concat(F.substring_index("path", "/", slashes), F.lit("/"))
    )
    tail = F.substring_index("host", ".", -labels)
    own = own.withColumn("head", head).withColumn("tail", tail)

    kinds = own.filter("host <> '' AND head <> ''").select("tail", "head").distinct()
    expressions = kinds.select("tail", "head", F.explode(_tails(F.col("tail"), labels)).alias("h"))
    expressions = expressions.select("tail", "head", "h", F.explode(_heads(F.col("head"), slashes)).alias("p"))
    expressions = expressions.withColumn("key", digest(F.concat("h", "p")))
    expressions = expressions.withColumn("short", F.substring("key", 1, 2 * PREFIX_BYTES))
    fitting = expressions.join(listed, "short").filter("key = full")
    best = fitting.groupBy("tail", "head").agg(F.max(F.struct(F.length("rule"), "rule", "ruled")).alias("best"))
    best = best.select("tail", "head", F.col("best.rule").alias("rule"), F.col("best.ruled").alias("ruled"))

    # One row for each host and beginning that a rule fits: while they are small, no
    # page moves, and a host with most of the pages is no key of a shuffle.
    best = broadcast_if_small(stored(best, "ruled"))
    out = own.join(best, ["tail", "head"], "left")
    added = {"host", "path", "rule", "verdict"}
    kept = [F.col(p).alias(c) for p, c in zip(places, pages.columns) if c not in added]
    return out.select(*kept, "host", "path", "rule", F.coalesce("ruled", F.lit(otherwise)).alias("verdict"))
