"""All keywords of a table walked over each tag at once.

Keywords are a trie of what they ask for in turn: a character further on, any one
character, or (around an escaped wildcard) a few in a row. For a batch of tags the
places of every character are one sorted array, so that the next occurrence of a
character after a place is a binary search, and all living branches of the trie, of
all tags of the batch, take a step together. A branch is left as soon as its beginning
does not occur. Nothing is compiled and no tag is read twice.
"""

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagreef.functions.keyword import pattern_of
from tagreef.shared import sent

#: Most bytes of the keywords walked in one scan.
TRIE_BYTES = 2 << 20
#: Branches (tags x nodes of a level) and characters worked out together, about.
BRANCHES = 1 << 20
CHARS = 1 << 20

#: Steps that are not a character: any one character, or one of ``segments``.
ANY = -1

Segment = tuple[str | None, ...]


def segments_of(clean: str) -> tuple[list[Segment], Segment]:
    """What a cleaned keyword asks for in turn, and what the tag must end with.

    A segment is a run of characters, None for any one. Nothing but the wildcards of
    its LIKE pattern stands between two segments.
    """
    found: list[list[str | None]] = [[]]
    for token in re.findall(r"\\.|.", pattern_of(clean), re.DOTALL):
        if token == "%":
            found.append([])
        else:
            found[-1].append(None if token == "_" else token[-1])
    return [tuple(s) for s in found[:-1] if s], tuple(found[-1])


def _stands(segment: Segment, text: str, at: int) -> bool:
    return all(c is None or text[at + k] == c for k, c in enumerate(segment))


def place_after(segment: Segment, text: str, at: int) -> int:
    """Behind the first occurrence of a segment from a place on; -1 without one."""
    if None not in segment:
        found = text.find("".join(segment), at)
        return found + len(segment) if found >= 0 else -1
    last = len(text) - len(segment)
    return next((k + len(segment) for k in range(at, last + 1) if _stands(segment, text, k)), -1)


@dataclass
class Level:
    """Nodes of one depth, in order of their parents.

    ``first[p]:first[p + 1]`` are the children of node ``p`` of the level above,
    ``step`` is a character's number, ANY, or -2 - k for segment k.
    """

    first: np.ndarray
    step: np.ndarray
    ends: np.ndarray  # ends[n]:ends[n + 1] of ``keyword`` end at node n
    keyword: np.ndarray


class KeywordTrie:
    """Cleaned keywords by their beginnings; a keyword is known by its place in the list."""

    def __init__(self, keywords: list[str]):
        chars: dict[str, int] = {}
        self.segments: list[Segment] = []
        numbered: dict[Segment, int] = {}
        self.anchors: dict[int, Segment] = {}
        children: list[dict[int, int]] = [{}]
        depth, ending = [0], [[]]
        for number, clean in enumerate(keywords):
            parts, anchor = segments_of(clean)
            if anchor:
                self.anchors[number] = anchor
            node = 0
            for part in parts:
                if len(part) == 1:
                    step = ANY if part[0] is None else chars.setdefault(part[0], len(chars))
                else:
                    if part not in numbered:
                        numbered[part] = len(self.segments)
                        self.segments.append(part)
                    step = -2 - numbered[part]
                after = children[node].get(step)
                if after is None:
                    after = children[node][step] = len(children)
                    children.append({})
                    depth.append(depth[node] + 1)
                    ending.append([])
                node = after
            ending[node].append(number)
        self.chars = np.array(sorted(ord(c) for c in chars), np.uint32)
        rank = {chars[chr(c)]: k for k, c in enumerate(self.chars.tolist())}
        self.levels: list[Level] = []
        above, here = [], [0]
        while here:
            first = np.cumsum([0, *(len(children[p]) for p in above)])
            steps = [rank[s] if s >= 0 else s for p in above for s in children[p]] or [ANY] * len(here)
            ends = np.cumsum([0, *(len(ending[n]) for n in here)])
            self.levels.append(Level(first, np.array(steps, np.int64), ends, np.array([k for n in here for k in ending[n]], np.int64)))
            above, here = here, [c for n in here for c in children[n].values()]
        self.width = max(len(level.step) for level in self.levels)

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, keyword) of every keyword that a text matches, in order."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        low = 0
        most = max(1, BRANCHES // self.width)
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and high - low < most and (high == low or size + len(texts[high]) <= CHARS):
                size += len(texts[high])
                high += 1
            text, keyword = self._walk(texts[low:high])
            found.append((text + low, keyword))
            low = high
        text, keyword = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((keyword, text))
        return text[order], keyword[order]

    def _walk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(texts)), lengths)
        place = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        wide = int(lengths.max(initial=0)) + 1
        kinds = max(len(self.chars), 1)
        number = np.searchsorted(self.chars, points)
        known = np.zeros(len(points), bool)
        if len(self.chars):
            known = self.chars[np.minimum(number, len(self.chars) - 1)] == points
        keys = np.sort((owner[known] * kinds + number[known]) * wide + place[known])

        found = []
        text, node, at = np.arange(len(texts)), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for depth, level in enumerate(self.levels):
            if depth:
                many = level.first[node + 1] - level.first[node]
                text, at = np.repeat(text, many), np.repeat(at, many)
                before = np.cumsum(many) - many
                node = np.repeat(level.first[node], many) + np.arange(many.sum()) - np.repeat(before, many)
                at = self._stepped(level.step[node], text, at, keys, kinds, wide, lengths, texts)
                alive = at >= 0
                text, node, at = text[alive], node[alive], at[alive]
            many = level.ends[node + 1] - level.ends[node]
            if many.any():
                before = np.cumsum(many) - many
                which = np.repeat(level.ends[node], many) + np.arange(many.sum()) - np.repeat(before, many)
                found.append((np.repeat(text, many), level.keyword[which], np.repeat(at, many)))
        if not found:
            return text[:0], text[:0]
        text, keyword, at = (np.concatenate(x) for x in zip(*found))
        if self.anchors:
            keep = np.ones(len(text), bool)
            for k in np.flatnonzero(np.isin(keyword, list(self.anchors))).tolist():
                whole, anchor = texts[text[k]], self.anchors[int(keyword[k])]
                start = len(whole) - len(anchor)
                keep[k] = start >= at[k] and _stands(anchor, whole, start)
            text, keyword = text[keep], keyword[keep]
        return text, keyword

    def _stepped(
        self, step: np.ndarray, text: np.ndarray, at: np.ndarray, keys: np.ndarray, kinds: int, wide: int, lengths: np.ndarray, texts: list[str]
    ) -> np.ndarray:
        """Where each branch stands after its step, -1 where the step fails."""
        after = np.where(at < lengths[text], at + 1, -1)  # ANY
        plain = np.flatnonzero(step >= 0)
        group = text[plain] * kinds + step[plain]
        key = group * wide + at[plain]
        near = np.searchsorted(keys, key)
        found = np.append(keys, -1)[near]
        after[plain] = np.where(found // wide == group, found % wide + 1, -1)
        for k in np.flatnonzero(step < ANY).tolist():
            after[k] = place_after(self.segments[-2 - int(step[k])], texts[text[k]], int(at[k]))
        return after


def keyword_numbers(spark: SparkSession, features: Column, clean: list[str]) -> Column:
    """The places in ``clean`` of the keywords that a tag matches; none for a null tag.

    Only the tags travel to the Python workers.
    """
    trie = sent(spark, KeywordTrie(clean))

    @F.pandas_udf("array<int>")
    def numbers(batches: pd.Series) -> pd.Series:
        texts = batches.tolist()
        held = [k for k, t in enumerate(texts) if t is not None]
        text, keyword = trie().hits([texts[k] for k in held])
        cuts = np.searchsorted(text, np.arange(len(held) + 1))
        out: list = [[]] * len(texts)
        for k, a, b in zip(held, cuts.tolist(), cuts[1:].tolist()):
            out[k] = keyword[a:b].astype(np.int32)
        return pd.Series(out)

    return numbers(features)


def walk_keywords(rows: DataFrame, keywords: DataFrame, slice_bytes: int = TRIE_BYTES) -> list[DataFrame]:
    """``(keyword, row columns)`` of every match, one frame for each slice of the keywords.

    ``keywords`` are distinct ``(keyword, clean)``. Slices hold about ``slice_bytes`` of
    cleaned text, measured; each is one scan of the tags and one trie, which has a
    node for each character at most.
    """
    total = keywords.agg(F.sum(F.octet_length("clean").cast("long") + 1)).first()[0] or 0
    parts = -(-total // slice_bytes)
    spark = rows.sparkSession
    found = []
    for part in range(parts):
        held = keywords if parts == 1 else keywords.filter(F.pmod(F.xxhash64("keyword"), F.lit(parts)) == part)
        held = [tuple(r) for r in held.select("keyword", "clean").collect()]
        if not held:
            continue
        number = keyword_numbers(spark, F.col("features"), [clean for _, clean in held])
        named = spark.createDataFrame(list(enumerate(k for k, _ in held)), "_number int, keyword string")
        hits = rows.withColumn("_number", F.explode(number))
        found.append(hits.join(F.broadcast(named), "_number").drop("_number"))
    return found
