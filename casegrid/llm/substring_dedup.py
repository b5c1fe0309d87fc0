"""Substring de-duplication: windows of words, a count-min prefilter, exact grouping of what it suspects.

A window is ``window`` consecutive words of one document. Every word is removed
that a window covers whose words also start, as a window, in a document with a
smaller id. Removal is judged on the input, not on what is left.

Exact copies of a text with a smaller id lose all their words, and take no part in
what follows: their windows are those of the other text. (Up to ``MAX_COPIES`` of them,
which are broadcast; beyond that, copies are found window by window like any other.)

1. *Sketch.* Equal windows have the same least ``GRAM``-word hash (their
   minimiser), so a window is found in two documents only if its minimiser is.
   Each task counts the minimisers of its documents (once a document) into
   ``DEPTH`` rows of cells and sends the cells it touched; cells of all tasks are
   added up by blocks, saturating at two. A minimiser with a cell under two in any
   row is in one document only; estimates are never too low, so none is lost.
2. *Exact pass.* Windows whose minimiser is estimated repeated are sent once a
   document as 96-bit digests. Spark groups them (partial aggregates first) for the
   least and the largest document id; digests of one document only go away.
3. What is left is joined back to the suspects, and each document removes the
   words of those of its windows that a smaller id has, too.

The width of the sketch follows the counted words, up to ``MAX_CELLS``. Its bits
are all that reaches the driver and is broadcast: DEPTH * cells / 8 bytes, 64 MB at
most. A corpus beyond that fills the sketch, which sends more windows to the exact
pass and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import as_bytes, staged, with_results

WINDOW = 13
GRAM = 8
DEPTH = 2
MIN_CELLS, MAX_CELLS = 1 << 20, 1 << 28
MAX_COPIES = 1 << 20
_BLOCK_BITS = 16  # cells of a block have two-byte places
_FLUSH = 1 << 22  # cells that a task holds
_WORDS = 1 << 18  # words that are hashed at a time
_VOCABULARY = 1 << 20  # hashed words that a task remembers
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _VOCABULARY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    return (x ^ (x >> np.uint64(29))) * by


class Windows:
    """The windows of a few documents, which are lists of words: digests, minimisers and the document of each."""

    def __init__(self, documents: list[list[bytes]], window: int, hashes: dict[bytes, int]):
        gram = min(GRAM, window)
        sizes = np.array([len(d) for d in documents], np.int64)
        words = np.array([hashes[w] for d in documents for w in d], np.uint64)
        n = max(0, len(words) - window + 1)
        owner = np.repeat(np.arange(len(documents)), sizes)
        within = np.flatnonzero(owner[:n] == owner[window - 1 :]) if n else np.zeros(0, np.int64)
        self.owner = owner[within]
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
        self.place = within - first[self.owner]
        if not n:
            self.digest, self.check, self.minimiser = (np.zeros(0, np.uint64) for _ in range(3))
            return
        code, grams = words, words
        for j in range(1, window):
            code = code[:-1] * _A + words[j:]
            if j == gram - 1:
                grams = _mixed(code, _C)
        if gram == 1:
            grams = _mixed(words, _C)
        least = grams[:n]
        for j in range(1, window - gram + 1):
            least = np.minimum(least, grams[j : j + n])
        other = _mixed(words, _B)
        check = other
        for j in range(1, window):
            check = check[:-1] * _B + other[j:]
        self.digest, self.minimiser = code[within], least[within]
        self.check = check[within] >> np.uint64(32)


def _grouped(texts: Iterator[tuple[object, bytes]]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Keys and words of some texts at a time."""
    keys, documents, size = [], [], 0
    for key, text in texts:
        keys.append(key)
        documents.append(text.split())
        size += len(documents[-1])
        if size >= _WORDS:
            yield keys, documents
            keys, documents, size = [], [], 0
    if keys:
        yield keys, documents


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True)


def cells_of(minimisers: np.ndarray, row: int, cells: int) -> np.ndarray:
    """The cell of each minimiser in one row of the sketch."""
    shift = np.uint64(64 - (cells.bit_length() - 1))
    return (_mixed(minimisers, (_A, _B, _C)[row % 3]) * _A >> shift).astype(np.int64)


def _count_cells(window: int, cells: int):
    """Task side: the cells touched by minimisers, once a document; by block, those touched once and more often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = _Hashes(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for row in range(DEPTH):
                at, counts = np.unique(cells_of(np.concatenate(held), row, cells), return_counts=True)
                block, place = at >> _BLOCK_BITS, (at & ((1 << _BLOCK_BITS) - 1)).astype("<u2")
                starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                ends = np.append(starts[1:], len(at))
                once = [place[a:b][counts[a:b] == 1].tobytes() for a, b in zip(starts, ends, strict=True)]
                more = [place[a:b][counts[a:b] > 1].tobytes() for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(starts), pa.int32()), pa.array(block[starts], pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())],
                    names=["line", "block", "once", "more"])

        for _, documents in _grouped(_pairs(batches)):
            w = Windows(documents, window, hashes)
            fresh = np.flatnonzero(np.concatenate([[True], (w.minimiser[1:] != w.minimiser[:-1]) | (w.owner[1:] != w.owner[:-1])])) if len(w.owner) else []
            if not len(fresh):
                continue
            order = np.lexsort((w.minimiser[fresh], w.owner[fresh]))
            m, o = w.minimiser[fresh][order], w.owner[fresh][order]
            held.append(m[np.concatenate([[True], (m[1:] != m[:-1]) | (o[1:] != o[:-1])])])
            size += len(held[-1])
            if size >= _FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run


def _add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bits of the cells counted twice or more, by block; one counter is held for each cell of the partition's blocks."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for line, block, once, more in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            counts = held.get((line, block))
            if counts is None:
                counts = held[line, block] = np.zeros(1 << _BLOCK_BITS, np.uint8)
            counts[np.frombuffer(more, "<u2")] = 2
            at = np.frombuffer(once, "<u2")
            counts[at] = np.minimum(counts[at] + 1, 2)
    for (line, block), counts in held.items():
        if (counts > 1).any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([line], pa.int32()), pa.array([block], pa.int32()), pa.array([np.packbits(counts > 1, bitorder="little").tobytes()], pa.binary())],
                names=["line", "block", "bits"])


def width_for(words: int) -> int:
    """Cells in a row of the sketch: a power of two, a half to one for each word, within the bounds (a word in about four is a minimiser)."""
    return min(MAX_CELLS, max(MIN_CELLS, 1 << (max(1, int(words)).bit_length() - 1)))


def repeated_cells(docs: DataFrame, window: int, cells: int) -> np.ndarray:
    """Of (id, text) rows: DEPTH rows of bits, one for each cell, set where a cell was counted twice or more."""
    parts = docs.mapInArrow(_count_cells(window, cells), "line int, block int, once binary, more binary")
    merged = parts.repartition("line", "block").mapInArrow(_add_cells, "line int, block int, bits binary").toArrow()
    bits = np.zeros((DEPTH, cells >> _BLOCK_BITS, 1 << (_BLOCK_BITS - 3)), np.uint8)
    for line, block, data in zip(*[merged[c].to_pylist() for c in ("line", "block", "bits")], strict=True):
        bits[line, block] = np.frombuffer(data, np.uint8)
    return bits.reshape(DEPTH, -1)


def _suspects(window: int, cells: int, shared):
    """Task side: the digests of windows whose minimiser is estimated repeated, once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = _Hashes(), shared.value
        for keys, documents in _grouped(_pairs(batches)):
            w = Windows(documents, window, hashes)
            hit = np.ones(len(w.owner), bool)
            for row in range(DEPTH):
                at = cells_of(w.minimiser, row, cells)
                hit &= (bits[row][at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            found = np.flatnonzero(hit)
            order = found[np.lexsort((w.check[found], w.digest[found], w.owner[found]))]
            d, c, o = w.digest[order], w.check[order], w.owner[order]
            new = np.ones(len(order), bool)
            new[1:] = (d[1:] != d[:-1]) | (c[1:] != c[:-1]) | (o[1:] != o[:-1])
            ids = np.array(keys, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[new].view(np.int64)), pa.array(c[new].astype(np.uint32).view(np.int32)), pa.array(ids[o[new]])],
                names=["digest", "check", "id"])

    return run


def _cover(window: int):
    def fn(texts: pa.Array, hits: pa.Array, copies: pa.Array) -> list[pa.Array]:
        hashes, copied, n_words, n_removed, kept = _Hashes(), copies.to_pylist(), [], [], []
        at = 0
        for _, documents in _grouped((None, t) for t in as_bytes(texts)):
            mine, whole = hits.slice(at, len(documents)), copied[at : at + len(documents)]
            at += len(documents)
            marked = [i for i, h in enumerate(mine) if h.is_valid]
            w = Windows([documents[i] for i in marked], window, hashes)
            bounds = np.searchsorted(w.owner, np.arange(len(marked) + 1))
            gone: dict[int, np.ndarray] = {}
            for k, i in enumerate(marked):
                wanted = mine[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                span = slice(bounds[k], bounds[k + 1])
                starts = w.place[span][np.isin(w.digest[span], wanted)]
                edges = np.zeros(len(documents[i]) + 1, np.int64)
                edges[starts] += 1
                np.add.at(edges, starts + window, -1)
                gone[i] = np.cumsum(edges[:-1]) > 0
            for i, words in enumerate(documents):
                out = gone.get(i) if not whole[i] or len(words) < window else np.ones(len(words), bool)
                n_words.append(len(words))
                n_removed.append(int(out.sum()) if out is not None else 0)
                kept.append(b" ".join(words if out is None else [x for x, g in zip(words, out, strict=True) if not g]))
        return [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]

    return fn


def later_copies(rows: DataFrame, most: int) -> DataFrame:
    """(id, hash) of the (id, text) rows whose whole text a smaller id has, too; none if there are more than ``most``."""
    marked = staged(rows.select("id", F.md5("text").alias("whole"), F.xxhash64("text").alias("hash")), "whole-texts")
    groups = marked.groupBy("whole").agg(F.min("id").alias("first"), F.max("id").alias("last")).where(F.col("first") < F.col("last"))
    found = staged(marked.join(groups, "whole").where(F.col("id") > F.col("first")).select("id", "hash").distinct(), "copies")
    return found if found.count() <= most else found.where(F.lit(False))


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   cells: int | None = None, max_copies: int = MAX_COPIES) -> DataFrame:
    """Columns ``row`` (the document), ``n_words``, ``n_removed`` and ``kept_text`` (the kept words, joined by a space).

    Words are what white space parts; a null text has none. The id is an integer.
    A document without an id neither removes words nor loses any, since it is not
    before or after another; documents of the same id (repeated rows) don't remove
    each other's words, and windows repeated within one document only stay. Texts
    with fewer words than a window are kept whole. Works on an empty table.
    ``cells`` overrides the sketch's width (a power of two of 2^16 or more).
    """
    spark = docs.sparkSession
    text, number = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    rows = docs.where(number.isNotNull() & text.isNotNull()).select(number.alias("id"), text.alias("text"))
    if cells is None:
        # a word takes two bytes at least; measured words are about six
        cells = width_for((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6)
    copies = F.broadcast(later_copies(rows, max_copies))  # MAX_COPIES pairs of numbers
    rows = rows.withColumn("hash", F.xxhash64("text")).join(copies, ["id", "hash"], "left_anti").select("id", "text")
    shared = spark.sparkContext.broadcast(repeated_cells(rows, window, cells))
    suspects = staged(rows.mapInArrow(_suspects(window, cells, shared), "digest long, check int, id long"), "windows")
    ends = suspects.groupBy("digest", "check").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    firsts = staged(ends.where(F.col("first") < F.col("last")).select("digest", "check", "first"), "repeated")
    hits = suspects.join(firsts, ["digest", "check"]).where(F.col("id") > F.col("first"))
    hits = hits.groupBy(F.col("id").alias("hit_id"), F.lit(-1).alias("hit_salt")).agg(F.collect_list("digest").alias("hits"))  # windows of one id
    # rows without an id have no hits: their salt deals them out
    salt = F.when(number.isNull(), F.pmod(F.xxhash64(text), F.lit(1 << 20))).otherwise(F.lit(-1)).cast("int")
    placed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.coalesce(number, F.lit(0)).alias("at"), salt.alias("salt"))
    joined = placed.join(hits, (F.col("at") == F.col("hit_id")) & (F.col("salt") == F.col("hit_salt")), "left")
    whole = F.col(f"doc.`{text_col}`").cast("string")
    joined = joined.withColumn("own_hash", F.xxhash64(whole)).join(
        copies.withColumn("copy", F.lit(True)), (F.col("salt") == -1) & (F.col("at") == F.col("id")) & (F.col("own_hash") == F.col("hash")), "left")
    joined = joined.select("doc", whole.alias("text"), "hits", F.coalesce("copy", F.lit(False)).alias("copy"))
    done = with_results(joined, ["text", "hits", "copy"], "n_words long, n_removed long, kept_text string", _cover(window))
    return done.select(F.col("row.doc").alias("row"), "n_words", "n_removed", "kept_text")
