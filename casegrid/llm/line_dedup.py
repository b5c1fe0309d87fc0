"""Line de-duplication with two Bloom filters.

A line's key is the line without white space at both ends and with A-Z in lower
case. Keys found in ``min_docs`` documents or more lose their lines.

1. Each task enters the keys of its documents (each key once a document) into
   two bit arrays of one fixed size: *once* (seen) and *twice* (seen again).
   The arrays of all tasks are merged by word ranges: a bit set in *once* of two
   tasks counts as *twice*, so every key of two documents is in the merged *twice*.
2. Only keys found in *twice* - the suspected repeats - leave the tasks, as
   128-bit digests that Spark counts with map-side aggregation.
3. Confirmed keys drop their lines. Up to ``broadcast_keys`` of them travel as a
   broadcast array; beyond that, only documents with a suspected line are
   joined with the confirmed keys.

The size of the bit arrays (``filter_bits``) is fixed, so memory does not grow;
fuller arrays send more suspects to the exact count and change no result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import as_bytes, staged, with_results

FILTER_BITS = 1 << 26
HASHES = 3
BROADCAST_KEYS = 1 << 20
_RANGE = 1 << 12  # words of the bit arrays that one merging group holds


def line_keys(text: bytes, min_chars: int) -> list[bytes | None]:
    """The key digest of every line; None where the key is shorter than ``min_chars`` code points."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip().lower()
        short = len(key) < min_chars or (min_chars > 1 and len(key.decode()) < min_chars)
        out.append(None if short else xxhash.xxh3_128_digest(key))
    return out


def _positions(digests: list[bytes], bits: int) -> np.ndarray:
    """Bit positions, a row of HASHES for each digest."""
    halves = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    steps = np.arange(HASHES, dtype=np.uint64)
    return ((halves[:, :1] + steps * (halves[:, 1:] | np.uint64(1))) % np.uint64(bits)).astype(np.int64)


def _contains(filled: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((filled[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


def _enter(filled: np.ndarray, at: np.ndarray) -> None:
    flat = at.ravel()
    np.bitwise_or.at(filled, flat >> 6, np.uint64(1) << (flat & 63).astype(np.uint64))


def _local_filters(bits: int, min_chars: int):
    """Task side: documents -> the non-zero words of the task's two bit arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits >> 6, np.uint64), np.zeros(bits >> 6, np.uint64)
        for batch in batches:
            seen: list[bytes] = []
            for text in as_bytes(batch.column(0)):
                seen += {k for k in line_keys(text, min_chars) if k}
            if not seen:
                continue
            counts = Counter(seen)
            at = _positions(list(counts), bits)
            again = (np.fromiter(counts.values(), np.int64) > 1) | _contains(once, at)
            _enter(twice, at[again])
            _enter(once, at)
        words = np.flatnonzero(once | twice)
        for i in range(0, len(words), 1 << 16):
            w = words[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(w // _RANGE, pa.int64()), pa.array(w, pa.int64()),
                 pa.array(once[w].view(np.int64)), pa.array(twice[w].view(np.int64))],
                names=["part", "word", "once", "twice"])

    return run


def _merge_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge words of equal index, whatever task they come from; holds one pair of words for each index."""
    state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        word = batch.column(1).to_numpy(zero_copy_only=False)
        once = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        twice = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
        for part in np.unique(word // _RANGE):
            mine = np.flatnonzero(word // _RANGE == part)
            have = state.setdefault(int(part), (np.zeros(_RANGE, np.uint64), np.zeros(_RANGE, np.uint64)))
            while len(mine):
                _, first = np.unique(word[mine], return_index=True)
                rows = mine[first]
                slot = word[rows] % _RANGE
                have[1][slot] |= twice[rows] | (have[0][slot] & once[rows])
                have[0][slot] |= once[rows]
                mine = np.delete(mine, first)
    for part, (_, twice) in state.items():
        if (slot := np.flatnonzero(twice)).size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot + part * _RANGE, pa.int64()), pa.array(twice[slot].view(np.int64))], names=["word", "twice"])


def twice_seen(docs: DataFrame, text_col: str, min_chars: int, filter_bits: int) -> np.ndarray:
    """The merged *twice* bit array, as 64-bit words (``filter_bits / 8`` bytes at most reach the driver)."""
    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        _local_filters(filter_bits, min_chars), "part long, word long, once long, twice long")
    merged = parts.repartition("part").mapInArrow(_merge_filters, "word long, twice long").toArrow()
    filled = np.zeros(filter_bits >> 6, np.uint64)
    filled[merged["word"].to_numpy()] = merged["twice"].to_numpy().view(np.uint64)
    return filled


def repeated_keys(docs: DataFrame, text_col: str, min_docs: int, min_chars: int, filled, filter_bits: int,
                  order_col: str | None) -> DataFrame:
    """Digests of keys in ``min_docs`` documents or more: (digest, first), first by ``order_col``."""

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = filled.value
        for batch in batches:
            ids = batch.column(1)
            keys = [list({k for k in line_keys(t, min_chars) if k}) for t in as_bytes(batch.column(0))]
            rows = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            flat = [k for ks in keys for k in ks]
            if flat:
                hit = np.flatnonzero(_contains(twice, _positions(flat, filter_bits)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([flat[i] for i in hit], pa.binary()), ids.take(pa.array(rows[hit]))], names=["digest", "at"])

    at = F.col(order_col) if order_col else F.lit(0)
    rows = docs.select(F.col(text_col).cast("string").alias("text"), at.cast("long").alias("at"))
    found = rows.mapInArrow(suspects, "digest binary, at long")
    return (found.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
            .where(F.col("n") >= min_docs).select("digest", "first"))


def _kept(text: bytes, drop: list[bool]) -> tuple[bytes, int, int]:
    lines = text.split(b"\n")
    return b"\n".join([x for x, d in zip(lines, drop, strict=True) if not d]), len(lines), sum(drop)


def dedup_lines(docs: DataFrame, text_col: str = "text", min_docs: int = 2, min_chars: int = 1,
                keep_first_by: str | None = None, filter_bits: int = FILTER_BITS,
                broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Columns ``row`` (the document), ``kept_text``, ``n_lines`` and ``n_dropped``.

    A null or empty text is one empty line; a text that loses all lines becomes
    empty. With ``keep_first_by`` (an integer column) the first line with the key
    in the documents of the smallest value stays (documents that tie all keep
    theirs; if all values are null, every line with the key goes). Without it every
    line with the key goes. Documents are rows: repeated rows count as documents
    of their own. Works on an empty table.
    """
    spark = docs.sparkSession
    filled = spark.sparkContext.broadcast(twice_seen(docs, text_col, min_chars, filter_bits))
    keys = staged(repeated_keys(docs, text_col, min_docs, min_chars, filled, filter_bits, keep_first_by), "line-keys")
    inputs = [text_col, *([keep_first_by] if keep_first_by else [])]
    if keys.count() <= broadcast_keys:
        known = spark.sparkContext.broadcast({bytes(r[0]): r[1] for r in keys.toLocalIterator()})

        def drop(texts: pa.Array, at: pa.Array | None = None) -> list[pa.Array]:
            firsts, out = known.value, []
            for i, text in enumerate(as_bytes(texts)):
                mine, done, marks = at[i].as_py() if at is not None else None, set(), []
                for k in line_keys(text, min_chars):
                    gone = k is not None and k in firsts
                    if gone and at is not None and mine is not None and firsts[k] == mine and k not in done:
                        done.add(k)
                        gone = False
                    marks.append(gone)
                out.append(_kept(text, marks))
            return [pa.array([x[0] for x in out], pa.binary()).cast(pa.string()),
                    pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64())]

        return with_results(docs, inputs, "kept_text string, n_lines long, n_dropped long", drop)
    return _drop_by_join(docs, text_col, keys, min_chars, keep_first_by, filled, filter_bits)


def _drop_by_join(docs: DataFrame, text_col: str, keys: DataFrame, min_chars: int, keep_first_by: str | None,
                  filled, filter_bits: int) -> DataFrame:
    """The same for more confirmed keys than a broadcast may hold: documents with suspected lines are
    written with a row number, their suspects are joined with the keys, and the finds return by that number."""
    inputs = [text_col, *([keep_first_by] if keep_first_by else [])]

    def mark(texts: pa.Array, at: pa.Array | None = None) -> list[pa.Array]:
        out = []
        for text in as_bytes(texts):
            ks = line_keys(text, min_chars)
            full = [i for i, k in enumerate(ks) if k]
            hit = _contains(filled.value, _positions([ks[i] for i in full], filter_bits)) if full else []
            out.append([{"line": i, "digest": ks[i]} for i, h in zip(full, hit, strict=True) if h])
        return [pa.array(out, pa.list_(pa.struct([("line", pa.int32()), ("digest", pa.binary())]))),
                at.cast(pa.int64()) if at is not None else pa.nulls(len(out), pa.int64())]

    marked = with_results(docs, inputs, "suspects array<struct<line:int,digest:binary>>, at long", mark)
    marked = staged(marked.withColumn("number", F.monotonically_increasing_id()), "line-suspects")
    lines = marked.select("number", "at", F.explode("suspects").alias("s")).select("number", "at", "s.line", "s.digest")
    found = lines.join(keys, "digest")
    if keep_first_by:
        firsts = found.where(F.col("at") == F.col("first")).groupBy("number", "digest").agg(F.min("line").alias("line"))
        found = found.join(firsts, ["number", "digest", "line"], "left_anti")
    gone = found.groupBy("number").agg(F.collect_list("line").alias("gone"))  # of one document at most
    joined = (marked.drop("suspects", "at").join(gone, "number", "left")
              .select(F.col(f"row.`{text_col}`").cast("string").alias("text"), "gone", "row"))

    def drop(texts: pa.Array, gones: pa.Array) -> list[pa.Array]:
        out = []
        for text, lost in zip(as_bytes(texts), gones.to_pylist(), strict=True):
            lost = set(lost or ())
            out.append(_kept(text, [i in lost for i in range(text.count(b"\n") + 1)]))
        return [pa.array([x[0] for x in out], pa.binary()).cast(pa.string()),
                pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64())]

    done = with_results(joined, ["text", "gone"], "kept_text string, n_lines long, n_dropped long", drop)
    return done.select("row.row", "kept_text", "n_lines", "n_dropped")
