"""Keyword to pattern: the keyword's characters in order, gaps allowed.

A keyword ``k1 k2 .. kn`` (lower-cased, blanks dropped) stands for the LIKE
pattern ``%k1%k2%..%kn%``. Nothing is escaped, so ``%`` and ``_`` stay wildcards
and a backslash makes the ``%`` after it a literal one.

Spark runs such a LIKE as a backtracking regex whose time grows with a power of
the text length. Taking the leftmost occurrence of each part is always safe for
an in-order match, so the same test is written with possessive quantifiers,
which makes it linear in the text.
"""

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def clean_keyword(keyword: Column) -> Column:
    return F.replace(F.lower(keyword), F.lit(" "), F.lit(""))


def cleaned(keyword: str) -> str:
    """:func:`clean_keyword` of one keyword held by the driver.

    Spark lowers it, as it lowers tags and keyword columns: Python's own rules
    differ for a few letters, and with the versions of both.
    """
    text = F.lit(keyword)
    return SparkSession.active().range(1).select(clean_keyword(text)).first()[0]


def keyword_pattern(keyword: Column) -> Column:
    """The LIKE pattern of a keyword column."""
    return F.concat(
        F.lit("%"), F.array_join(F.split(clean_keyword(keyword), ""), "%"), F.lit("%")
    )


def keyword_regex(keyword: Column) -> Column:
    """Linear-time regex equal to the keyword's LIKE pattern, as a column.

    Written with array functions over the tokens of the LIKE pattern: an
    escaped character, a wildcard, or a plain character. Wildcards ``%`` cut the
    tokens into segments, and each segment is skipped to by its first occurrence.
    A pattern that does not end in ``%`` must match up to the end of the text.
    """
    pattern = keyword_pattern(keyword)
    tokens = F.regexp_extract_all(pattern, F.lit(r"(?s)\\.|."), F.lit(0))
    cut = F.lit("\n")  # no regex piece below holds a line feed
    pieces = F.transform(
        tokens,
        lambda t: F.when(t == "%", cut)
        .when(t == "_", F.lit("."))
        .otherwise(_hex_char(F.substr(t, F.length(t)))),
    )
    joined = F.array_join(pieces, "")
    segments = F.filter(F.split(joined, "\n"), lambda s: s != "")
    skips = F.transform(segments, lambda s: F.concat(F.lit("(?:(?!"), s, F.lit(").)*+"), s))
    floating = F.concat(F.lit("(?s)^"), F.array_join(skips, ""))
    n = F.size(segments)
    head = F.array_join(F.slice(skips, F.lit(1), F.greatest(n - 1, F.lit(0))), "")
    anchored = F.concat(F.lit("(?s)^"), head, F.lit(".*"), F.element_at(segments, -1), F.lit(r"\z"))
    return F.when(F.element_at(tokens, -1) == "%", floating).otherwise(anchored)


def _hex_char(char: Column) -> Column:
    """One character as a regex that needs no quoting rules."""
    return F.concat(F.lit(r"\x{"), F.hex(F.encode(char, "UTF-32")), F.lit("}"))


def literal_chars(keyword: Column) -> Column:
    """Distinct characters every matching text must hold."""
    tokens = F.regexp_extract_all(keyword_pattern(keyword), F.lit(r"(?s)\\.|."), F.lit(0))
    fixed = F.filter(tokens, lambda t: ~t.isin("%", "_"))
    return F.array_distinct(F.transform(fixed, lambda t: F.substr(t, F.length(t))))


def compile_keyword(pattern: str) -> str:
    """Linear-time regex of one LIKE pattern held by the driver.

    Same language as :func:`keyword_regex`; a one-character segment is written
    as a negated class, which the regex engine scans faster than a look-ahead.
    """
    segments: list[list[str]] = [[]]
    for token in re.findall(r"\\.|.", pattern, re.DOTALL):
        if token == "%":
            segments.append([])
        else:
            segments[-1].append("." if token == "_" else rf"\x{{{ord(token[-1]):x}}}")
    anchored = segments[-1]
    skips = []
    for segment in filter(None, segments[:-1]):
        text = "".join(segment)
        if text == ".":
            skips.append(".")
        elif len(segment) == 1:
            skips.append(f"[^{text}]*+{text}")
        else:
            skips.append(f"(?:(?!{text}).)*+{text}")
    end = ".*" + "".join(anchored) + r"\z" if anchored else ""
    return "(?s)^" + "".join(skips) + end


def pattern_of(clean: str) -> str:
    """The LIKE pattern of one cleaned keyword held by the driver."""
    return "%" + "%".join(clean) + "%"


def fixed_chars(pattern: str) -> list[str]:
    """Distinct characters that every text matching a LIKE pattern holds."""
    tokens = re.findall(r"\\.|.", pattern, re.DOTALL)
    return list(dict.fromkeys(token[-1] for token in tokens if token not in ("%", "_")))


def matches_keyword(features: Column, keyword: str) -> Column:
    """Does a row match the keyword? The regex is a literal, compiled once per task.

    Most rows that do not match lack one of the characters. Finding that out on
    the bytes is several times cheaper than running the regex to the row's end.
    ``features`` is mentioned once per character, so it should be a stored column.
    """
    pattern = pattern_of(cleaned(keyword))
    if not pattern.strip("%"):
        return features.isNotNull()
    test = features.rlike(compile_keyword(pattern))
    for char in reversed(fixed_chars(pattern)):
        test = F.contains(features, F.lit(char)) & test
    return test
