"""Truncation by a public vocabulary, against merges made one by one."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from casegrid.functions import subword as SW
from casegrid.plans import catalog


@pytest.fixture(scope="module")
def ranks():
    return SW.read_ranks(catalog.RANKS_PATH)


def merged(ranks, text):
    """Byte-pair coding, step by step: of a piece's neighbours, those of least rank are merged first."""
    out = []
    for piece in regex.findall(SW.SPLIT, text):
        parts = [bytes([b]) for b in piece.encode()]
        while len(parts) > 1:
            rank, i = min((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out += parts
    return out


def plain(ranks, text, head, tail):
    tokens = merged(ranks, text)
    if len(tokens) <= head + tail:
        return text, len(tokens)
    first, last = b"".join(tokens[:head]), b"".join(tokens[len(tokens) - tail :])
    return first.decode("utf-8", "replace") + "[...]" + last.decode("utf-8", "replace"), len(tokens)


def test_tokens_like_merges_and_back(ranks):
    rng = random.Random(1)
    codec = SW.encoding(ranks)
    texts = ["", " ", "It's the judge's  order.\n\n", "Überprüfung – 12,345 €", "日本の裁判所", "a" * 300, "\U0001f600 ok"]
    texts += ["".join(rng.choices("aeinrst  'lé\n.9ß中", k=rng.randrange(80))) for _ in range(200)]
    for t in texts:
        tokens = codec.encode_ordinary(t)
        assert [codec.decode_single_token_bytes(x) for x in tokens] == merged(ranks, t) and codec.decode(tokens) == t
        for head, tail in ((4, 3), (0, 2), (5, 0)):
            assert SW.shortened(codec, t, head, tail, "[...]") == plain(ranks, t, head, tail)


def test_requests_by_subwords(spark, sf_small, ranks):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = catalog.queries()["build_requests_subword"](spark, sf_small).collect()
    assert len(got) == len(texts) and any(r["truncated"] for r in got) and not all(r["truncated"] for r in got)
    for r in got:
        text, n = plain(ranks, texts[r["doc_id"]], 300, 200)
        assert (r["user"], r["n_tokens"], r["truncated"]) == ("Court transcript:\n" + text, n, n > 500)


def test_odd_texts(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 20_000)], "id long, text string")
    got = {r["id"]: r["s"] for r in rows.select("id", SW.truncate_middle(spark, F.col("text"), catalog.RANKS_PATH, 3, 2).alias("s")).collect()}
    assert got[1] is None and tuple(got[2]) == ("", 0) and got[3]["n_tokens"] == 20_001 and got[3]["text"] == "word word word[...] word "
