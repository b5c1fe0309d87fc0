"""Benchmark decontamination by a broadcast set of n-gram windows.

A window is ``n`` consecutive words of an item; an item of fewer words, but not
none, is one window. The windows travel as a broadcast set of proven size: they
are counted first, and a benchmark of more than ``max_windows`` windows is dealt
into as many shards as keep each within that bound. Documents are then scanned
shard by shard, and written in between. Each task hashes its token windows with
numpy, looks them up, and verifies every hit word by word. A window that more
than ``max_shared`` items have travels once, with a number in place of its items;
these are joined afterwards, once for each set of such windows that a document has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import as_bytes, staged, with_results

WINDOW = 10
MAX_WINDOWS = 1 << 18
MAX_SHARED = 1 << 10
_BLOCK_WORDS = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)

#: A-Z in lower case; every other byte that isn't 0-9, a-z or part of a code point over U+007F becomes a space.
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_NOT_WORD = bytes(c if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, n: int) -> DataFrame:
    """(item, size, words): the distinct windows of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for item, text in zip(ids, as_bytes(batch.column(1)), strict=True):
                w = words_of(text)
                size = min(n, len(w))
                made = list({b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)}) if size else []
                for i in range(0, len(made), 10_000):
                    part = made[i : i + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(part), pa.string()), pa.array([size] * len(part), pa.int32()),
                         pa.array(part, pa.binary())], names=["item", "size", "words"])

    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "item string, size int, words binary").distinct()


class WindowSet:
    """Windows of one shard, ready for look-ups within one process."""

    def __init__(self, windows: list[tuple[str | None, int, bytes, int | None]]):
        self.items: dict[bytes, list[str]] = {}
        self.numbers: dict[bytes, int] = {}  # of the windows whose items are joined afterwards
        sizes: dict[int, set[bytes]] = {}
        for item, size, words, number in windows:
            self.items.setdefault(words, [])
            if item is not None:
                self.items[words].append(item)
            if number is not None:
                self.numbers[words] = number
            sizes.setdefault(size, set()).add(words)
        self.bits = max(20, math.ceil(math.log2(len(windows) + 1)) + 6)
        self.marks: dict[int, np.ndarray] = {}
        for size, texts in sizes.items():
            mark = np.zeros(1 << self.bits, bool)
            split = [t.split(b" ") for t in texts]
            h = np.array([hash(w) for ws in split for w in ws], dtype=np.int64).view(np.uint64).reshape(-1, size)
            code = h[:, 0].copy()
            for j in range(1, size):
                code = code * _ODD + h[:, j]
            mark[self._slot(code)] = True
            self.marks[size] = mark

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return (code * _ODD) >> np.uint64(64 - self.bits)

    def search(self, words: list[bytes], doc_of: np.ndarray) -> Iterator[tuple[int, int, list[str], int | None]]:
        """(first word, size, items, number) of every occurrence that lies within one document."""
        h = np.array(list(map(hash, words)), dtype=np.int64).view(np.uint64)
        code = h
        for size in range(1, max(self.marks, default=0) + 1):
            if len(h) < size:
                return
            if size > 1:
                code = code[:-1] * _ODD + h[size - 1 :]
            if size in self.marks:
                for i in np.flatnonzero(self.marks[size][self._slot(code)]).tolist():
                    if doc_of[i] == doc_of[i + size - 1]:
                        window = b" ".join(words[i : i + size])
                        found = self.items.get(window)
                        if found is not None:
                            yield i, size, found, self.numbers.get(window)


_last: list = [None, None]


def _window_set(shard) -> WindowSet:
    """The set is built once in a Python worker for each broadcast, not once a batch."""
    if _last[0] is not shard.value:
        _last[:] = [shard.value, WindowSet(shard.value)]
    return _last[1]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_FOUND = pa.struct([("n_words", pa.int64()),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    ("items", pa.list_(pa.string())), ("shared", pa.list_(pa.int64()))])
_FOUND_DDL = "found struct<n_words:long,spans:array<struct<start:long,stop:long>>,items:array<string>,shared:array<long>>"


def _scan(shard):
    def fn(texts: pa.Array, before: pa.Array | None = None) -> list[pa.Array]:
        windows, out = _window_set(shard), []
        old = before.to_pylist() if before is not None else None
        words: list[bytes] = []
        sizes: list[int] = []

        def flush() -> None:
            doc_of = np.repeat(np.arange(len(sizes)), sizes)
            start = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            spans: dict[int, list] = {}
            items: dict[int, set] = {}
            shared: dict[int, set] = {}
            for i, size, found, number in windows.search(words, doc_of):
                d = int(doc_of[i])
                spans.setdefault(d, []).append((i - start[d], i - start[d] + size))
                items.setdefault(d, set()).update(found)
                if number is not None:
                    shared.setdefault(d, set()).add(number)
            for d, size in enumerate(sizes):
                mine, names, numbers = spans.get(d, []), items.get(d, set()), shared.get(d, set())
                if old is not None:
                    was = old[len(out)]
                    mine = mine + [(s["start"], s["stop"]) for s in was["spans"]]
                    names = names | set(was["items"])
                    numbers = numbers | set(was["shared"])
                out.append({"n_words": size, "spans": [{"start": a, "stop": b} for a, b in _merged(mine)], "items": sorted(names),
                            "shared": sorted(numbers)})
            words.clear()
            sizes.clear()

        for text in as_bytes(texts):
            w = words_of(text)
            words += w
            sizes.append(len(w))
            if len(words) >= _BLOCK_WORDS:
                flush()
        flush()
        return [pa.array(out, _FOUND)]

    return fn


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", n: int = WINDOW, max_windows: int = MAX_WINDOWS,
                       max_shared: int = MAX_SHARED) -> DataFrame:
    """Columns ``row`` (the document), ``n_words``, ``spans`` (hit words, merged: start, stop) and ``items``.

    Null and empty texts have no words and no hits; items without words have no
    window. An item without an id still marks words but isn't listed; items that
    repeat count once. Works on empty tables on either side.
    """
    spark = docs.sparkSession
    there = staged(benchmark_windows(benchmark, item_col, item_text_col, n), "windows")
    common = there.groupBy("words").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size")).where(F.col("n") > max_shared)
    common = staged(common.select("size", "words", F.monotonically_increasing_id().alias("number")), "shared-windows")
    windows, by_number = there.withColumn("number", F.lit(None).cast("long")), not common.isEmpty()
    if by_number:
        numbered = common.select(F.lit(None).cast("string").alias("item"), "size", "words", "number")
        windows = staged(windows.join(common.select("words"), "words", "left_anti").unionByName(numbered), "windows")
    shards = max(1, math.ceil(windows.count() / max_windows))
    while True:  # the largest shard is measured, too
        dealt = windows.withColumn("shard", F.pmod(F.xxhash64("words"), F.lit(shards)))
        most = dealt.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
        if most <= max_windows or shards >= windows.count():
            break
        shards += 1 + shards // 4
    rows = docs
    for k in range(shards):
        part = dealt.where(F.col("shard") == k).drop("shard")
        known = spark.sparkContext.broadcast([(r["item"], r["size"], bytes(r["words"]), r["number"]) for r in part.toLocalIterator()])
        if k == 0:
            rows = with_results(docs, [text_col], _FOUND_DDL, _scan(known))
        else:
            rows = rows.select(F.col(f"row.`{text_col}`").cast("string").alias("text"), "found", "row")
            rows = with_results(rows, ["text", "found"], "after " + _FOUND_DDL.removeprefix("found "), _scan(known))
            rows = rows.select("row.row", F.col("after").alias("found"))
        if k + 1 < shards:
            rows = staged(rows, "scanned")
    rows = rows.select("row", "found.*")
    return _with_shared(staged(rows, "scanned"), there, common) if by_number else rows.drop("shared")


def _with_shared(rows: DataFrame, windows: DataFrame, common: DataFrame) -> DataFrame:
    """Adds the items of the windows that go by number. Documents without any aren't shuffled."""
    hit = F.size("shared") > 0
    named = windows.where(F.col("item").isNotNull()).join(common.select("words", "number"), "words").select("number", "item")
    sets = rows.where(hit).select("shared").distinct().select("shared", F.explode("shared").alias("number"))
    more = sets.join(named, "number").groupBy("shared").agg(F.collect_set("item").alias("more"))
    items = F.array_sort(F.array_union("items", F.coalesce("more", F.array().cast("array<string>"))))
    found = rows.where(hit).join(more, "shared", "left").select("row", "n_words", "spans", items.alias("items"))
    return rows.where(~hit).drop("shared").unionByName(found)


def remove_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the bytes from the first to the last word of each span of words."""
    if not spans:
        return text
    plain = text.translate(_NOT_WORD)
    ends, at = [], 0
    for w in plain.split():
        at = plain.index(w, at)
        ends.append((at, at + len(w)))
        at += len(w)
    out, last = [], 0
    for start, stop in spans:
        out.append(text[last : ends[start][0]])
        last = ends[stop - 1][1]
    return b"".join([*out, text[last:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", drop_documents: bool = True,
                  **options) -> DataFrame:
    """``docs`` without the documents that hold a window; or, with ``drop_documents=False``, without the spans."""
    found = find_contamination(docs, benchmark, text_col, **options)
    if drop_documents:
        return found.where(F.size("spans") == 0).select("row.*")

    def cut(texts: pa.Array, spans: pa.Array) -> list[pa.Array]:
        return [pa.array([remove_spans(t, [(s["start"], s["stop"]) for s in ss])
                          for t, ss in zip(as_bytes(texts), spans.to_pylist(), strict=True)], pa.binary()).cast(pa.string())]

    rows = with_results(found.select(F.col(f"row.`{text_col}`").cast("string").alias("text"), "spans", "row"),
                        ["text", "spans"], "cut string", cut)
    hit = F.size("row.spans") > 0
    return rows.select(*[F.when(hit, F.col("cut")).otherwise(F.col(f"row.row.`{c}`")).alias(c) if c == text_col
                         else F.col(f"row.row.`{c}`") for c in docs.columns])
