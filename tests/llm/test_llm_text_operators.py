"""Classifier, line dedup, SimHash and decontamination against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm_rows import make, words
from pyspark.sql import functions as F

from casegrid.llm import decontaminate as D
from casegrid.llm import line_dedup as L
from casegrid.llm import quality as Q
from casegrid.llm import registry as R
from casegrid.llm import simhash as S
from casegrid.llm.components import connected_components


def texts_of(df):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in df.collect()))


# -- line dedup


def brute_lines(rows, least):
    def key(line):
        return line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})

    found = Counter()
    for r in rows:
        found.update({key(x) for x in (r[1] or "").split("\n")} - {""})
    return [(r[0], "\n".join(x for x in (r[1] or "").split("\n") if not (key(x) and found[key(x)] >= least))) for r in rows]


@pytest.fixture(scope="module")
def liney():
    rng = random.Random(1)
    pool = [words(rng, 3, 30) for _ in range(40)]
    rows = [(i, "\n".join(rng.choice([p, p.upper(), f" {p}\t"]) for p in rng.choices(pool, k=rng.randrange(1, 9)))) for i in range(120)]
    return [*rows, (200, None), (201, ""), (202, "\n\n"), (5, rows[5][1])]


@pytest.mark.parametrize("limit", [L.BROADCAST_KEYS, 0])
@pytest.mark.parametrize("bits", [L.FILTER_BITS, 64 * L._RANGE])
def test_lines_like_brute_force(spark, liney, limit, bits):
    docs = make(spark, liney).repartition(5)
    got = L.dedup_lines(docs, min_docs=10, broadcast_keys=limit, filter_bits=bits).select("row.doc_id", "kept_text").collect()
    assert sorted(map(tuple, got)) == sorted(brute_lines(liney, 10))


@pytest.mark.parametrize("limit", [L.BROADCAST_KEYS, 0])
def test_first_line_stays(spark, limit):
    docs = make(spark, [(3, "a\nb\na"), (1, "b\nc"), (2, "a\nc\nd"), (None, "a")]).repartition(2)
    got = L.dedup_lines(docs, min_docs=2, keep_first_by="doc_id", broadcast_keys=limit).select("row.doc_id", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(3, ""), (1, "b\nc"), (2, "a\nd"), (None, "")], key=str)


def test_lines_of_odd_rows(odd, none, odd_rows):
    got = L.dedup_lines(odd, min_docs=3).select("row.doc_id", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_lines(odd_rows, 3), key=str)
    assert L.dedup_lines(none).count() == 0


# -- decontamination


def brute_hits(text, items, n):
    def split(t):
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in low).split(" ")

    w = [x for x in split(text) if x]
    hit, names = set(), set()
    for item, t in items:
        v = [x for x in split(t) if x]
        size = min(n, len(v))
        for i in range(len(v) - size + 1 if size else 0):
            for j in range(len(w) - size + 1):
                if w[j : j + size] == v[i : i + size]:
                    hit |= set(range(j, j + size))
                    names |= {item} if item else set()
    return len(w), hit, sorted(names)


@pytest.mark.parametrize("most, shared", [(D.MAX_WINDOWS, D.MAX_SHARED), (7, D.MAX_SHARED), (D.MAX_WINDOWS, 1), (7, 2)])
def test_windows_like_brute_force(spark, most, shared):
    rng = random.Random(2)
    items = [(str(i), words(rng, rng.choice([3, 10, 14]), 400)) for i in range(8)] + [("8", None), ("9", ""), (None, words(rng, 12))]
    items += [(f"copy {i}", items[0][1]) for i in range(3)] + [("part", " ".join(items[1][1].split()[:10])), (None, items[2][1]), ("last", items[10][1])]
    docs = [(i, words(rng, rng.randrange(30), 400)) for i in range(30)]
    docs += [(100 + i, f"{words(rng, 5)}, {items[i % 8][1].upper()}! {words(rng, i)}") for i in range(16)] + [(200, None), (201, items[10][1])]
    bench = spark.createDataFrame([(a, b) for a, b in items], "item_id string, text string")
    got = D.find_contamination(make(spark, docs).repartition(3), bench, max_windows=most, max_shared=shared).select(
        "row.doc_id", "n_words", "spans", "items").collect()
    assert len(got) == len(docs)
    by_id = dict(docs)
    for r in got:
        n, hit, names = brute_hits(by_id[r["doc_id"]], items, 10)
        assert (r["n_words"], {i for s in r["spans"] for i in range(s["start"], s["stop"])}, r["items"]) == (n, hit, names)
    kept = {r["doc_id"] for r in D.decontaminate(make(spark, docs), bench, max_windows=most, max_shared=shared).collect()}
    assert kept == {i for i, t in docs if not brute_hits(t, items, 10)[1]}


def test_a_window_of_very_many_items_is_scanned_for_once(spark, monkeypatch):
    scans = []
    scan = D._scan
    monkeypatch.setattr(D, "_scan", lambda shard: (scans.append(len(shard.value)), scan(shard))[1])
    shared = "one two three four five six seven eight nine ten"
    bench = spark.range(300_000).select(F.col("id").cast("string").alias("item_id"), F.lit(shared).alias("text")).unionByName(
        spark.createDataFrame([("own", "a b c d e f g h i j")], "item_id string, text string"))
    docs = make(spark, [(1, f"x {shared} y"), (2, f"{shared.upper()} a b c d e f g h i j"), (3, "a b c d e f g h i j"), (4, "one two"), (2, f"x {shared} y")])
    got = D.find_contamination(docs, bench).select("row.doc_id", F.size("items").alias("n"), F.array_contains("items", "own").alias("own"),
                                                   (F.col("items") == F.array_sort("items")).alias("sorted"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 300_000, False, True), (2, 300_000, False, True), (2, 300_001, True, True), (3, 1, True, True), (4, 0, False, True)]
    assert scans == [2]


def test_spans_are_cut(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = make(spark, [(1, "a. One, two -- THREE! b one two three"), (2, "plain one two"), (3, None)])
    got = D.decontaminate(docs, bench, drop_documents=False)
    assert got.columns == docs.columns
    assert texts_of(got) == [(False, 1, "a. ! b "), (False, 2, "plain one two"), (False, 3, "")]


def test_decontamination_of_odd_rows(spark, odd, none, odd_rows):
    bench = spark.createDataFrame([(1, odd_rows[4][1]), (1, odd_rows[4][1]), (2, None)], "item_id long, text string")
    assert {r["doc_id"] for r in D.decontaminate(odd, bench).collect()} == {1, 2, 3, 4, 7, 8, 9, None}
    assert D.decontaminate(none, bench).count() == 0
    assert D.decontaminate(odd, bench.limit(0)).count() == len(odd_rows)


# -- SimHash


def brute_print(text):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    w = [x for x in w if x]
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows, bits=4):
    prints = {p: None for p in {brute_print(t) for _, t in rows}}
    codes = list(prints)
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for i, t in rows:
        if i is not None:
            least[find(brute_print(t))].append(i)
    return {(i, f"{brute_print(t):016x}"): min(least[find(brute_print(t))], default=None) for i, t in rows}


@pytest.fixture(scope="module")
def near():
    rng = random.Random(3)
    rows, at = [], 0
    for _ in range(25):
        base = words(rng, 150).split()
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = "new"
            rows.append((at, " ".join(copy)))
            at += 1
    return [*rows, (900, None), (901, ""), (902, "ab cd"), (903, "AB cd"), (0, rows[0][1])]


@pytest.mark.parametrize("group", [S.MAX_GROUP, 3])
def test_groups_like_brute_force(spark, near, group):
    got = S.near_duplicates(make(spark, near).repartition(4), max_group=group)
    got = got.select("id", S.fingerprint_text(F.col("fp")), "component_id").collect()
    assert len(got) == len(near)
    assert {(r[0], r[1]): r[2] for r in got} == brute_groups(near)


def test_index_finds_every_link():
    import numpy as np

    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    codes = []
    for c in centres:
        for _ in range(20):
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                c = c ^ (np.uint64(1) << np.uint64(b))
            codes.append(c)
    codes = np.unique(np.array(codes, np.uint64))

    def rank(c):
        for s in (1, 2, 4, 8, 16, 32):
            c = c ^ (c >> np.uint64(s))
        return c

    codes = codes[np.argsort(rank(codes))]
    comp = S.link_group(codes, 4)
    linked = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4
    want = np.arange(len(codes))
    while True:
        new = np.where(linked, want[None, :], len(codes)).min(axis=1)
        if (new == want).all():
            break
        want = new
    assert (comp == want).all() and len(set(want)) < len(codes)


def test_one_of_each_group_stays(spark, near, odd, none, odd_rows):
    docs = make(spark, near)
    groups = brute_groups(near)
    got = S.drop_near_duplicates(docs.repartition(3))
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(groups.values()))
    kept = S.drop_near_duplicates(odd).collect()
    # null, empty and blank texts are one group; the copies of doc 5 are another, as is what has no id but its text
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == sorted(
        (i is None, i or 0) for i in {**{v: 0 for k, v in brute_groups([r[:2] for r in odd_rows]).items() if v is not None}, None: 0})
    assert S.drop_near_duplicates(none).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert connected_components(edges.limit(0), "a", "b").count() == 0


# -- quality classifier


def test_held_out_accuracy(spark, sf_small):
    sf = sf_small.replace("sf0.001", "sf0.01")
    got = {r["doc_id"]: r for r in R.op1_quality_classifier(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    right = sum(got[r["doc_id"]]["predicted"] == r["quality"] for r in labels)
    assert right >= 0.97 * len(labels) and len(labels) > 40


def test_scores_do_not_see_labels_of_the_fold(spark, odd, none, odd_rows):
    labels = spark.createDataFrame([(4, 1), (5, 0), (9, 1), (10, 0), (7, None), (77, 1), (8, 1), (8, 0)], "doc_id long, quality int")
    model = Q.learn(odd, labels, F.col("id") != 8, "doc_id", "text", "quality")
    assert model.counts == (3.0, 2.0)  # the row that repeats counts twice
    scored = Q.score_documents(odd, model).collect()
    assert len(scored) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in scored)
    kept = Q.filter_by_quality(odd, labels, F.col("id") != 8)
    assert kept.columns == odd.columns and 0 < kept.count() <= len(odd_rows)
    assert Q.filter_by_quality(none, labels, F.lit(True)).count() == 0
    # one label only: the smoothed prior, for all rows
    assert Q.filter_by_quality(odd, labels.where("quality = 1"), F.lit(True)).count() == len(odd_rows)
    assert Q.filter_by_quality(odd, labels.limit(0), F.lit(True)).count() == len(odd_rows)


def plain_statistics(text):
    """The thirteen statistics, counted one by one."""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    size = max(1, sum(len(w.encode()) for w in words))
    n = len(words)
    threes = [tuple(words[i : i + 3]) for i in range(n - 2)]
    lines = [x.strip(" \t\n\x0b\x0c\r") for x in text.split("\n")]
    lines = [x for x in lines if x]

    def rate(count, of):
        return math.log((count + 0.5) / (of + 1))

    def found(chars):
        return sum(text.count(c) for c in chars)

    return [math.log(1 + n), math.log(size / max(1, n)), rate(found("#*$%&|<>{}[]^~=+@_\\/"), size), rate(found("!?"), size),
            rate(sum("A" <= c <= "Z" or "À" <= c <= "Þ" for c in text), size), rate(found("0123456789"), size), rate(found(".,;:"), n),
            rate(sum(len(w) == 1 and w.isascii() and not w.isalnum() for w in words), n), rate(sum(a == b for a, b in zip(words, words[1:], strict=False)), n),
            rate(len(threes) - len(set(threes)), n), rate(len(set(words)), n), rate(len(lines), n), rate(len(lines) - len(set(lines)), max(1, len(lines)))]


def test_statistics_like_plain_ones():
    rng = random.Random(16)
    texts = ["", " \n", "a", "a a a a a", "Ärger & Öl!\nÄrger & Öl!\n- 3.5 %", "É\u00a0x \x85y", "x\x1cy \x0b z"]
    texts += ["".join(rng.choices("abAB 01.,!?#&\n\tÀéß-", k=rng.randrange(200))) for _ in range(60)]
    for t in texts:
        assert np.allclose(Q.statistics(t.encode()), plain_statistics(t), rtol=1e-12, atol=1e-12), t


def test_scores_like_a_plain_discriminant(spark, sf_small):
    """Fitted and scored step by step: covariances shrunk, inverted and log-densities compared without a factor."""
    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    marks = [(r["doc_id"], r["quality"]) for r in labels.collect() if r["quality"] in (0, 1) and r["doc_id"] in texts and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    x = {i: np.array(plain_statistics(t)) for i, t in texts.items()}
    means, spreads, counts = [], [], []
    for k in (0, 1):
        mine = np.array([x[i] for i, q in marks if q == k])
        means.append(mine.mean(axis=0))
        spreads.append(np.mean([np.outer(v - means[k], v - means[k]) for v in mine], axis=0))
        counts.append(len(mine))
    common = sum(c * s for c, s in zip(counts, spreads, strict=True)) / sum(counts)
    shrunk = [(1 - Q.POOLED) * s + Q.POOLED * common for s in spreads]
    shrunk = [(1 - Q.ROUND) * s + Q.ROUND * np.trace(s) / len(s) * np.eye(len(s)) for s in shrunk]

    def density(v, k):
        return -0.5 * (np.linalg.slogdet(shrunk[k])[1] + (v - means[k]) @ np.linalg.inv(shrunk[k]) @ (v - means[k])) + math.log(counts[k] + 1)

    got = {r["doc_id"]: r["score"] for r in R.op1_quality_classifier(spark, sf_small).collect()}
    assert len(got) == len(texts)
    for i, v in x.items():
        assert math.isclose(got[i], 1 / (1 + math.exp(min(700, density(v, 0) - density(v, 1)))), rel_tol=1e-6, abs_tol=1e-9)


def test_more_labels_than_the_bound(spark):
    docs = make(spark, [(i, ("good words here. " if i % 2 else "## $$ !! ") * (1 + i % 7)) for i in range(400)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    model = Q.learn(docs, labels, F.lit(True), "doc_id", "text", "quality", max_labels=100)
    assert 40 <= sum(model.counts) <= 180
    assert sum((r["score"] > 0.5) == (r["row"]["doc_id"] % 2 == 1) for r in Q.score_documents(docs, model).collect()) == 400


def test_digest_of_items(spark, sf_small):
    r = R.op6_decontamination(spark, sf_small).where("n_items = 0").first()
    assert r["items_sha256"] == hashlib.sha256(b"").hexdigest()
