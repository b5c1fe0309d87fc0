"""Hard negatives, substring de-duplication and periodic runs against brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from llm_rows import make, words
from pyspark.sql import functions as F

from casegrid.llm import hard_negatives as H
from casegrid.llm import periodic_runs as P
from casegrid.llm import registry as R
from casegrid.llm import substring_dedup as S

# -- hard negatives

DDL = "vec_id long, embedding array<float>, label int, id long, score string, cell string, x string, number string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 5, "mine", "mine", "mine", "mine") for r in rows], DDL)


def brute_negatives(rows, n_positives=5, n_negatives=10, low=30, high=90, every=100, scale=256):
    def whole(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    use = [(i, np.floor(scale * np.array(v, np.float32).astype(float)), k) for i, v, k in rows if i is not None and k is not None and whole(v)]
    width = max((len(v) for _, v, _ in use), default=0)
    use = [(i, np.pad(v, (0, width - len(v))), k) for i, v, k in use]
    out = []
    for i, v, k in use:
        if i % every:
            continue
        scored = [(int(v @ w), j, m) for j, w, m in use]
        positives = sorted((-s, j) for s, j, m in scored if m == k and j != i)[:n_positives]
        for s, j in positives:
            fits = sorted((-t, n) for t, n, m in scored if m != k and -low * s <= 100 * t <= -high * s)[:n_negatives]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(fits)]
    return sorted(out)


def clustered(rng, n, width=12, centers=9):
    book = rng.normal(0, 0.4, (centers, width))
    return [(i, (book[rng.integers(centers)] + rng.normal(0, 0.08, width)).tolist(), int(rng.integers(4))) for i in range(n)]


@pytest.mark.parametrize("budget", [H.BUDGET, 40])
def test_negatives_like_brute_force(spark, budget, monkeypatch):
    monkeypatch.setattr(H, "CELL_ROWS", 16)
    monkeypatch.setattr(H, "PACK_ROWS", 8)
    monkeypatch.setattr(H, "SAMPLE", 60)
    rows = clustered(np.random.default_rng(3), 700)
    got = H.mine_hard_negatives(vectors(spark, rows).repartition(5), F.col("id") % 50 == 0, budget=budget)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows, every=50)


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = clustered(rng, 120, 6, 2)
    same = rows[7][1]
    rows += [(200 + i, same, i % 3) for i in range(90)]  # one vector holds a third of the rows
    rows += [(100, [float("nan")] * 6, 1), (300, None, 1), (400, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (500, [0.1] * 6, None), (None, [0.1] * 6, 1), (600, [], 2),
             (700, [0.5, 0.5], 2), (800, [float("inf")] * 6, 0), (900, [0.0] * 6, 0), (900, [0.0] * 6, 0), (1000, [0.3] * 6, 77)]
    got = H.mine_hard_negatives(vectors(spark, rows).repartition(3), F.col("id") % 100 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)
    assert H.mine_hard_negatives(vectors(spark, []), F.col("id") % 100 == 0).count() == 0
    assert H.mine_hard_negatives(vectors(spark, [(1, [0.1], 1)]), F.col("id") % 100 == 0).count() == 0


def test_visits_fall_and_bounds_hold():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(0, 60, (400, 10))).astype(np.int64)
    books = (H.codebook(x[:, :5], 6, 1), H.codebook(x[:, 5:], 6, 1))
    (a, far_a), (b, far_b) = H._nearest(x[:, :5], books[0]), H._nearest(x[:, 5:], books[1])
    cell = a * 6 + b
    radii = np.array([[far[cell == c].max(initial=0) for far in (far_a, far_b)] for c in range(36)])
    half = tuple(np.array([far[code == k].max(initial=0) for k in range(6)]) for code, far in ((a, far_a), (b, far_b)))
    index = H.Index(5, books, half, radii, np.bincount(cell, minlength=36), np.arange(0), np.arange(0), x[:0])
    for q in x[:20]:
        order = list(H.visit_order(q, index))
        assert sorted(c for _, c in order) == list(range(36)) and all(u >= v - 1e-9 for (u, _), (v, _) in zip(order, order[1:], strict=False))
        scores = x @ q
        for bound, c in order:
            assert scores[cell == c].max(initial=-(1 << 60)) <= bound + 1e-6
        least = int(np.sort(scores)[-8])
        wanted = H.wanted_cells(q, index, least, 1 << 60, 0, None)
        assert set(cell[scores >= least]) <= set(wanted)
        first = H.wanted_cells(q, index, least, 1 << 60, 0, 100)
        assert first + H.wanted_cells(q, index, least, 1 << 60, 100, None) == wanted


def test_products_are_exact():
    a = np.array([[1 << 25, 3], [-(1 << 25), 1]], np.int32)
    b = np.array([[1 << 25, 1 << 25], [7, (1 << 25) - 1]], np.int32)
    assert H.products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]


# -- substring de-duplication


def brute_passages(rows, window):
    first = {}
    for i, text, *_ in rows:
        w = (text or "").encode().split()
        for k in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, text, *_ in rows:
        w = (text or "").encode().split()
        gone = set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def passages(docs, window=13, **options):
    got = S.dedup_passages(docs, window=window, **options).select("row.doc_id", "n_words", "n_removed", "kept_text")
    return sorted((tuple(r) for r in got.collect()), key=str)


def planted(rng, n=150):
    shared = [words(rng, rng.randrange(8, 70)) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [words(rng, rng.randrange(1, 60)), *rng.sample(shared, rng.randrange(3)), words(rng, rng.randrange(40))]
        rows.append((i * 3 % 101, "  ".join(parts)))  # some ids come twice
    return rows + [(500 + i, rows[4][1]) for i in range(60)]


@pytest.mark.parametrize(("window", "max_copies"), [(13, S.MAX_COPIES), (1, 0), (5, S.MAX_COPIES), (20, 7)])
def test_passages_like_brute_force(spark, window, max_copies):
    rows = planted(random.Random(window))
    assert passages(make(spark, rows).repartition(6), window, max_copies=max_copies) == brute_passages(rows, window)


def test_odd_passages(spark, odd, none, odd_rows):
    assert passages(odd) == brute_passages(odd_rows, 13)
    assert passages(odd, 2) == brute_passages(odd_rows, 2)
    assert passages(odd, 2, max_copies=0) == brute_passages(odd_rows, 2)
    assert S.dedup_passages(none).count() == 0
    assert S.dedup_passages(odd).columns == ["row", "n_words", "n_removed", "kept_text"]


def test_full_sketch_loses_nothing(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, words(rng, 900, 10**6)) for i in range(200)]  # three minimisers for each cell
    rows += [(300 + i, f"{words(rng, 30)} {' '.join(t.split()[100:140])}") for i, t in rows[:20]]
    monkeypatch.setattr(S, "_FLUSH", 1000)
    got = passages(make(spark, rows).repartition(4), cells=1 << 16)
    assert got == brute_passages(rows, 13) and sum(r[2] > 0 for r in got) == 20


def test_estimates_are_never_too_low(spark):
    rng = random.Random(9)
    rows = planted(rng)
    bits = S.repeated_cells(make(spark, rows).select(F.col("doc_id").alias("id"), "text").repartition(4), 13, 1 << 16)
    seen = {}
    for i, text in rows:
        for m in set(S.Windows([text.encode().split()], 13, S._Hashes()).minimiser.tolist()):
            seen.setdefault(m, []).append(i)
    many = np.array([m for m, ids in seen.items() if len(ids) > 1], np.uint64)
    for row in range(S.DEPTH):
        at = S.cells_of(many, row, 1 << 16)
        assert ((bits[row][at >> 3] >> (at & 7)) & 1).all()


def test_width_follows_the_words():
    assert S.width_for(0) == S.MIN_CELLS and S.width_for(10**12) == S.MAX_CELLS
    assert 10**8 / 2 <= S.width_for(10**8) <= 10**8


# -- periodic runs


def brute_runs(w, least):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - start + q
            part = w[start : start + length]
            if i > start and length >= max(least, 2 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_like_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        docs = []
        for _ in range(rng.randrange(1, 4)):
            n, kinds = rng.randrange(90), rng.choice([1, 2, 2, 3, 4, 8])
            w = [b"%d" % rng.randrange(kinds) for _ in range(n)]
            for _ in range(rng.randrange(3) if n > 3 else 0):
                a, p = rng.randrange(n), rng.randrange(1, max(2, n // 3))
                for i in range(a + p, min(n, a + rng.randrange(1, 60))):
                    w[i] = w[i - p]
            docs.append(w)
        least = rng.choice([12, 12, 13, 5, 2])
        assert P.runs_of(docs, least) == [brute_runs(w, least) for w in docs]


def test_runs_with_structure():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 300:
        a, b = b, b + a
    two = [b"a", b"b"] * 60
    for w in (b, [b"a"] * 200, [*two, b"a", *two], ([b"a"] * 20 + [b"b"]) * 8, (b[:60] + [b"c"]) * 4, (b[:60] + [b"c"]) * 4 + b):
        assert P.runs_of([w])[0] == brute_runs(w, 12)


def test_pairs_grow_with_the_words(monkeypatch):
    made = []
    plain = P._seed_pairs
    monkeypatch.setattr(P, "_seed_pairs", lambda *x: made.append(len(x[0])) or made.append(len(plain(*x)[0])) or plain(*x))
    assert P.runs_of([[b"a"] * 60_000])[0] == [(0, 60_000, 1)]
    assert sum(made[1::2]) < 4 * 60_000


def test_collapsed():
    w = b"x a b c a b c a b c a b c y".split()
    (found,) = P.runs_of([w])
    assert found == [(1, 12, 3)] and P.collapsed(w, found) == b"x a b c y".split()


def test_runs_of_documents(spark, odd, none, odd_rows):
    got = P.find_runs(odd, min_length=4).collect()
    assert P.find_runs(none).count() == 0
    for r in got:
        w = (r["row"]["text"] or "").encode().split()
        if len(w) < 200:
            assert [tuple(x) for x in r["runs"]] == brute_runs(w, 4)
        assert r["collapsed_text"] == b" ".join(P.collapsed(w, [tuple(x) for x in r["runs"]])).decode()
    assert sorted(str(r["row"]["doc_id"]) for r in got) == sorted(str(r[0]) for r in odd_rows)


def test_runs_query(spark, sf_small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()}
    got = R.op13_periodic_runs(spark, sf_small).collect()
    assert len(got) == len(texts) and sum(r["n_runs"] > 0 for r in got) > len(got) // 20
    for r in got:
        w, h = (texts[r["doc_id"]] or "").encode().split(), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if len(w) > 400:
            continue
        runs = brute_runs(w, 12)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (best[1] * 1000 // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()
