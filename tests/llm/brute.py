"""Plain Python versions of the contracts, one document at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter

SF_DIR = "/root/testdata/sf0.001"

PLAIN = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(text):
    return PLAIN.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rest(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def contamination(docs, items, size=13):
    windows = {}
    for item, text in items:
        words = ALNUM.findall(lower(text))
        if words:
            n = min(size, len(words))
            for i in range(len(words) - n + 1):
                windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = {}
    for doc_id, text in docs:
        words = ALNUM.findall(lower(text))
        hit, names = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                found = windows.get(tuple(words[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    names |= found
        out[doc_id] = (
            len(words), len(hit), len(names), sha(",".join(sorted(map(str, names)))),
            bool(hit) and 20 * len(hit) >= len(words),
        )
    return out


def shingles(text, size, low=True):
    words = plain(lower(text) if low else text)
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_duplicates(docs, size, percent):
    """(n_shingles, component, kept) by id, all pairs compared through an inverted index."""
    sets = {doc_id: shingles(text, size) for doc_id, text in docs}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for doc_id, found in sets.items():
        for shingle in found:
            holders.setdefault(shingle, []).append(doc_id)
    shared = Counter()
    for ids in holders.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {x: (len(sets[x]), root(x), root(x) == x) for x in sets}


def repeats(docs, size=20):
    """(words, flags of the removed) by id; docs in order of their ids."""
    first = {}
    texts = sorted((doc_id, plain(text)) for doc_id, text in docs)
    out = {}
    for doc_id, words in texts:
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if first.setdefault(tuple(words[i : i + size]), (doc_id, i)) < (doc_id, i):
                gone[i : i + size] = [True] * size
        out[doc_id] = (words, gone)
    return out


def base_scores(docs, parts=5, held=1):
    """(held_out, n_tokens, n_known, train_tokens, base_score) by id."""
    counts = Counter()
    texts = {doc_id: [*plain(lower(text)), None] for doc_id, text in docs}
    for doc_id, words in texts.items():
        if rest(doc_id, parts) != held:
            counts.update(words)
    total, distinct = sum(counts.values()), len(counts)
    return {
        doc_id: (
            rest(doc_id, parts) == held, len(words), sum(counts[w] > 0 for w in words), total,
            sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words),
        )
        for doc_id, words in texts.items()
    }
