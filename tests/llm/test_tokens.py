import random
import re
import time

import numpy as np
import pytest
import tiktoken
from brute import SF_DIR
from public_tokenizers import PATTERN
from pyspark.sql import functions as F

from tagreef.llm.registry import QUERIES, RANKS, SEPARATOR
from tagreef.llm.tokens import count_tokens, token_files, token_ranks, write_token_files


def test_query_equals_tokenizer(spark, documents):
    ranks = token_ranks(RANKS)
    coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = dict(map(tuple, QUERIES["op5_token_counts"](spark, SF_DIR).collect()))
    assert got == {d: len(coder.encode_ordinary(t or "")) for d, t in documents}


def brute(tokens, separator):
    out, start = [], 0
    for at, token in enumerate(tokens):
        if token == separator:
            out.append((len(out), start, at - start, True))
            start = at + 1
    if start < len(tokens):
        out.append((len(out), start, len(tokens) - start, False))
    return out


@pytest.mark.parametrize(("width", "block"), [(2, 7), (2, 64), (4, 4), (4, 1 << 20)])
def test_blocks(spark, tmp_path, monkeypatch, width, block):
    """Documents across, at and between block ends; blocks without a separator."""
    monkeypatch.setattr("tagreef.llm.tokens.GROUP", 3)
    rng = random.Random(block)
    want = {}
    for k, share in enumerate([0.0, 0.02, 0.3, 0.9, 1.0]):
        tokens = [9 if rng.random() < share else rng.randrange(9) for _ in range(300 + k)]
        (tmp_path / f"f{k}").write_bytes(np.array(tokens, f"<u{width}").tobytes())
        want[f"f{k}"] = brute(tokens, 9)
    (tmp_path / "empty").write_bytes(b"")
    files = token_files(spark, str(tmp_path))
    files = files.unionAll(files)
    got = {}
    for r in count_tokens(files, 9, width, block).collect():
        got.setdefault(r.path.rsplit("/", 1)[1], []).append((r.doc, r.start, r.n_tokens, r.closed))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_edges(spark, docs_of, tmp_path):
    ranks = token_ranks(RANKS)
    docs = docs_of([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "<|endoftext|>"), (5, "word " * 30000)])
    written = write_token_files(docs, f"file://{tmp_path}", ranks, PATTERN, SEPARATOR)
    found = count_tokens(written, SEPARATOR, block_bytes=1000).join(written, ["path", "doc"]).collect()
    got = sorted(((r.doc_id or 0, r.n_tokens) for r in found))
    assert got[1:] == [(1, 0), (2, 0), (3, 2), (3, 2), (5, 30001)] and got[0][1] > 3
    none = write_token_files(docs.limit(0), f"file://{tmp_path}", ranks, PATTERN, SEPARATOR)
    assert count_tokens(none, SEPARATOR).count() == 0
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "x").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole number"):
        count_tokens(token_files(spark, str(tmp_path / "odd")), SEPARATOR).collect()
    with pytest.raises(ValueError):
        write_token_files(docs, str(tmp_path), ranks, PATTERN, 5)


def test_many_documents_of_one_block(spark, tmp_path):
    """Time goes with the documents, not with their square."""
    lengths = np.random.default_rng(1).integers(0, 9, 200_000)
    tokens = np.concatenate([np.append(np.full(n, 3), 9) for n in lengths]).astype("<u2")
    (tmp_path / "f").write_bytes(tokens.tobytes())
    found = count_tokens(token_files(spark, str(tmp_path)), 9)
    began = time.time()
    rows = found.agg(F.count("*"), F.sum("n_tokens"), F.max("doc"), F.sum("start")).first()
    assert tuple(rows) == (200_000, lengths.sum(), 199_999, sum(np.cumsum(lengths + 1) - lengths - 1))
    assert time.time() - began < 60
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    explode = next(line for line in plan.splitlines() if "Generate posexplode" in line)
    # Neither of the block's two arrays goes along with a document.
    assert re.search(r"start, end\)\), \[3, 4\], false", explode)
