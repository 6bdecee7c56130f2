"""Whole scores of the model queries against plain versions, text by text."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import ALNUM, SF_DIR, lower, plain, rest
from pyspark.sql import functions as F

from tagreef.llm import hmm, quality, toxicity
from tagreef.llm.registry import QUERIES
from tagreef.llm.words import ALNUM as ALNUM_FLAGS
from tagreef.llm.words import PLAIN, find_words


def hashes(words, flags=PLAIN):
    """The package's hash of each word, which breaks ties and names buckets."""
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return find_words(raw, np.array([0, len(raw)]), flags, False).hashes if words else np.zeros(0, np.uint64)


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()


# --- hidden Markov model ------------------------------------------------------


def kind_of(word):
    raw, code = word.encode(), 0
    for back in (1, 2, 3):
        code = code * 257 + (raw[-back] + 1 if len(raw) >= back else 0)
    return ((code * 0x9E3779B1) >> 12) % hmm.KINDS


def forward(model, seq):
    initial, moves, emissions = model
    values, scales, now = [], [], None
    for token in seq:
        now = (initial if now is None else now @ moves) * emissions[token]
        scales.append(now.sum())
        now = now / scales[-1]
        values.append(now)
    return np.array(values), np.array(scales)


def test_hidden_markov_scores(spark, documents):
    texts = {d: plain(lower(t)) for d, t in documents}
    training = [d for d in texts if rest(d, 5) != 1]
    counts = Counter(w for d in training for w in texts[d])
    words = list(counts)
    codes = dict(zip(words, hashes(words).view(np.int64).tolist()))
    order = sorted(words, key=lambda w: (-counts[w], codes[w]))
    place = {w: k for k, w in enumerate(order[: hmm.TOP])}
    tokens, distinct = defaultdict(float), defaultdict(float)
    for w in words:
        if w not in place:
            tokens[kind_of(w)] += counts[w]
            distinct[kind_of(w)] += 1
    shares = np.full(hmm.CLASSES, 0.5)
    for w, k in place.items():
        shares[k] += counts[w]
    for k, n in tokens.items():
        shares[hmm.TOP + k] += n
    shares[hmm.END] += len(training)
    shares /= shares.sum()
    sequences = {d: [*(place.get(w, hmm.TOP + kind_of(w)) for w in texts[d]), hmm.END] for d in texts}

    begin = hmm.HiddenMarkov.begin(shares)
    model = begin.initial, begin.moves, begin.emissions
    for _ in range(hmm.STEPS):
        initial, moves, emissions = model
        first, moved, emitted = np.full(len(initial), 0.1), np.full(moves.shape, 0.1), 20 * shares[:, None] * np.ones(len(initial))
        for d in training:
            values, scales = forward(model, sequences[d])
            after = np.ones(len(initial))
            for t in range(len(values) - 1, -1, -1):
                emitted[sequences[d][t]] += values[t] * after
                if t:
                    ahead = emissions[sequences[d][t]] * after / scales[t]
                    moved += np.outer(values[t - 1], ahead) * moves
                    after = moves @ ahead
                else:
                    first += values[0] * after
        model = first / first.sum(), moved / moved.sum(1, keepdims=True), emitted / emitted.sum(0)

    got = {r.doc_id: r.score for r in QUERIES["op2_lm_scoring"](spark, SF_DIR).collect()}
    assert len(got) == len(texts)
    for d, seq in sequences.items():
        want = np.log10(forward(model, seq)[1]).sum()
        for w in texts[d]:
            if w not in place:
                k = kind_of(w)
                want += math.log10(counts[w] + 0.5) - math.log10(tokens[k] + 0.5 * (distinct[k] + 1))
        assert got[d] == pytest.approx(want, rel=2e-3)


# --- quality ------------------------------------------------------------------


def statistics(text):
    """The 18 statistics of one text, counted one by one."""
    raw = (text or "").encode()
    words = [w.encode() for w in plain(text)]
    lines = [line for line in raw.replace(b"\r", b"\n").split(b"\n") if line]
    digit = lambda b: 0x30 <= b <= 0x39
    letter = lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80
    stop = lambda b: b in b".,;:'\"?-()"
    sign = lambda b: 0x21 <= b < 0x7F and not (digit(b) or letter(b) or stop(b))
    share = lambda part, whole: part / max(whole, 1)
    letters = sum(map(letter, raw))
    sizes = [len(w) for w in words]
    mean = share(sum(sizes), len(words))
    triples = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(words).most_common(1)
    return [
        math.log1p(len(words)), math.log1p(len(raw)), mean, math.sqrt(share(sum((s - mean) ** 2 for s in sizes), len(words))),
        share(letters, len(raw)), share(sum(map(digit, raw)), len(raw)), share(sum(0x41 <= b <= 0x5A for b in raw), letters),
        share(sum(map(sign, raw)), len(raw)), share(sum(map(stop, raw)), len(raw)),
        share(sum(any(map(sign, w)) for w in words), len(words)), share(sum(not any(map(letter, w)) for w in words), len(words)),
        share(len(set(words)), len(words)), share(often[0][1] if often else 0, len(words)), share(len(set(lines)), len(lines)),
        math.log1p(len(lines)), math.log1p(share(len(raw), len(lines))), share(sum(line.endswith(b".") for line in lines), len(lines)),
        share(len(set(triples)), len(triples)) if triples else 1.0,
    ]


def isotonic(x, y):
    """The non-decreasing fit of y on x by its max-min formula."""
    levels = sorted(set(x))
    n = [sum(v == level for v in x) for level in levels]
    s = [sum(b for v, b in zip(x, y) if v == level) for level in levels]
    n0, s0 = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(s)])
    k = len(levels)
    return levels, [max(min((s0[b + 1] - s0[a]) / (n0[b + 1] - n0[a]) for b in range(i, k)) for a in range(i + 1)) for i in range(k)]


def test_quality_scores(spark, documents):
    texts = dict(documents)
    labels = {r.doc_id: r.quality for r in table(spark, "labels") if rest(r.doc_id, 4) != 2 and r.quality is not None and r.doc_id in texts}
    folds = spark.createDataFrame([(d,) for d in labels], "doc_id long")
    folds = folds.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(quality.FOLDS)).alias("fold"))
    fold = {r.doc_id: r.fold for r in folds.collect()}
    ids = sorted(labels)
    stats = {d: np.array(statistics(t)) for d, t in texts.items()}
    x, y = np.array([stats[d] for d in ids]), np.array([float(labels[d]) for d in ids])
    center, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1
    rng = np.random.default_rng(3)
    directions = rng.normal(size=(x.shape[1], quality.FEATURES)) / quality.WIDTH
    phases = rng.uniform(0, 2 * np.pi, quality.FEATURES)

    def features(s):
        z = np.cos(np.clip((s - center) / scale, -6, 6) @ directions + phases) * math.sqrt(2 / quality.FEATURES)
        return np.concatenate([[1.0], z])

    z = np.array([features(s) for s in x])

    def ridge(rows):
        """Least squares with the penalty as rows of their own."""
        a, b = z[rows], y[rows]
        extra = math.sqrt(quality.RIDGE * max(len(b), 1) / z.shape[1]) * np.eye(z.shape[1])
        return np.linalg.lstsq(np.vstack([a, extra]), np.concatenate([b, np.zeros(z.shape[1])]), rcond=None)[0]

    of = np.array([fold[d] for d in ids])
    others = {k: ridge(np.flatnonzero(of != k)) for k in range(quality.FOLDS)}
    held = [float(-1 + quality.STEP * np.rint((z[i] @ others[of[i]] + 1) / quality.STEP)) for i in range(len(ids))]
    steps, levels = isotonic(held, y)
    weights = ridge(np.arange(len(ids)))
    got = {r.doc_id: r.score for r in QUERIES["op3_quality_classifier"](spark, SF_DIR).collect()}
    want = {d: float(np.clip(np.interp(features(s) @ weights, steps, levels), 0, 1)) for d, s in stats.items()}
    # A held-out score on the very border of a step may fall to either side.
    off = [d for d in want if abs(got[d] - want[d]) > 1e-6]
    assert len(off) <= 0.02 * len(want) and max(abs(got[d] - want[d]) for d in want) < 0.1


# --- toxicity -----------------------------------------------------------------


def bucket_sets(words):
    """The buckets of a list of words: of the words and of their beginnings."""
    if not words:
        return set()
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    found = find_words(raw, np.array([0, len(raw)]), ALNUM_FLAGS, False)
    return set(toxicity.word_features(found)[1].tolist())


def test_toxicity_scores(spark, documents):
    texts = {d: ALNUM.findall(lower(t)) for d, t in documents}
    labels = {r.doc_id: r.toxic for r in table(spark, "labels") if rest(r.doc_id, 5) != 0 and r.toxic is not None and r.doc_id in texts}
    ids = sorted(labels)
    y = np.array([float(labels[d]) for d in ids])
    sets = {d: bucket_sets(w) for d, w in texts.items()}
    n1, n0, n = y.sum(), (1 - y).sum(), len(y)
    seen, toxic = Counter(), Counter()
    for d in ids:
        seen.update(sets[d])
        if labels[d]:
            toxic.update(sets[d])

    def z(bucket):
        total, ones = seen[bucket], toxic[bucket]
        spread = math.sqrt((total + 1) / n * (1 + 1 / n - total / n) * (1 / max(n1, 1) + 1 / max(n0, 1)))
        return abs(ones / max(n1, 1) - (total - ones) / max(n0, 1)) / spread

    best = sorted(seen, key=lambda b: (-round(z(b), 9), b))[: toxicity.FEATURES]
    border = round(z(best[-1]), 9)
    terms = [t for group in toxicity.IDENTITIES for t in group]
    after = {t: g[(k + 1) % len(g)] for g in toxicity.IDENTITIES for k, t in enumerate(g)}
    kept = sorted(set(best) | set().union(*(bucket_sets([t]) for t in terms)))
    at = {b: k for k, b in enumerate(kept)}

    def row(words, count):
        x = np.zeros(len(kept) + 2)
        x[0], x[1] = 1, math.log1p(count) / 10
        for b in bucket_sets(words) & at.keys():
            x[2 + at[b]] = 1
        return x

    x = np.array([row(texts[d], len(texts[d])) for d in ids])
    swaps = [row(texts[d], len(texts[d])) - row([after.get(w, w) for w in texts[d]], len(texts[d])) for d in ids if set(texts[d]) & set(terms)]
    held = toxicity.RIDGE * np.eye(len(kept) + 2)
    held[0, 0] = toxicity.RIDGE * 1e-6
    if swaps:
        held += toxicity.SWAP_PENALTY * np.array(swaps).T @ np.array(swaps)
    weights = np.zeros(len(kept) + 2)
    for _ in range(toxicity.NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        move = np.linalg.solve(x.T @ np.diag(p * (1 - p)) @ x + held, x.T @ (p - y) + held @ weights)
        weights = weights - move * min(1, 20 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-3:
            break
    got = {r.doc_id: r.score for r in QUERIES["op10_toxicity"](spark, SF_DIR).collect()}
    want = {d: 1 / (1 + math.exp(-np.clip(row(w, len(w)) @ weights, -30, 30))) for d, w in texts.items()}
    # Buckets whose z score ties at the border of the kept ones may differ.
    tied = sum(round(z(b), 9) == border for b in seen)
    assert max(abs(got[d] - want[d]) for d in want) < (0.05 if tied > 1 else 1e-4)
