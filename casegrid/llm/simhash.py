"""SimHash near-duplicates with a hierarchical index in Gray order.

Fingerprints: bit i is set if more than half of the shingles' hashes have it.
Linking: two fingerprints link at ``max_bits`` or fewer differing bits.

Distinct fingerprints are routed by blocks of their bits: cut into
``max_bits + 1`` blocks, two that link agree in at least one. Within a routed
group the fingerprints lie in Gray order, so neighbours share bits; the index
factors the bits that all codes below a node share into that node, each level
holding only what the level above hasn't. A search walks down and adds up the
differences met so far; a node is left out, with all its codes, when they
exceed ``max_bits``, or when all its codes are in the searcher's component
already. A group hands on a spanning star of each component it finds, never all
pairs. Groups of more than ``max_group`` fingerprints are cut into parts, and
every pair of parts is searched by a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import as_bytes, staged, with_results
from casegrid.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
MAX_GROUP = 1 << 16
FAN = 16
_FRONTIER = 1 << 20
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint as a signed integer; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    digest, joined = xxhash.xxh64_digest, b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    n, ones = len(starts), np.zeros(64, np.int64)
    for i in range(0, n, _SHINGLES_AT_ONCE):
        spans = zip(starts[i : i + _SHINGLES_AT_ONCE].tolist(), ends[i : i + _SHINGLES_AT_ONCE].tolist(), strict=True)
        hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Columns ``row`` (the document) and ``fp`` (signed 64 bits). A null text counts as empty."""

    def fn(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([fingerprint(t, shingle) for t in as_bytes(texts)], pa.int64())]

    return with_results(docs, [text_col], "fp long", fn)


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def gray_rank(code: Column) -> Column:
    """The place of ``code`` in the Gray sequence: bit i is the parity of the bits from the top to i."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


class GrayIndex:
    """The hierarchical index over codes that lie in Gray order."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # (shared mask, bits), leaves first
        mask, bits = np.full(len(codes), ~np.uint64(0)), codes
        while len(bits) > 1:
            at = np.arange(0, len(bits), FAN)
            first = bits[at]
            other = np.bitwise_or.reduceat(bits ^ np.repeat(first, np.diff(np.append(at, len(bits)))), at)
            mask = np.bitwise_and.reduceat(mask, at) & ~other
            bits = first & mask
            self.levels.append((mask, bits))

    def ranges(self, comp: np.ndarray) -> list[np.ndarray]:
        """For each level, the component that all codes below a node are in, or -1."""
        out, low, high = [], comp, comp
        for _ in self.levels:
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            out.append(np.where(low == high, low, -1))
        return out

    def search(self, asking: np.ndarray, comp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j), i in ``asking`` and j > i, in different components and at most ``max_bits`` apart."""
        whole = self.ranges(comp)
        top = len(self.levels) - 1
        who = asking
        node = np.zeros(len(who), np.int64)
        mask, bits = self.levels[top]
        spent = np.bitwise_count((self.codes[who] ^ bits[0]) & mask[0])
        for level in range(top, -1, -1):
            span = FAN ** (level + 1)
            keep = (spent <= max_bits) & (whole[level][node] != comp[who]) & ((node + 1) * span - 1 > who)
            who, node, spent = who[keep], node[keep], spent[keep]
            above = self.levels[level][0][node]
            below = len(self.levels[level - 1][0]) if level else len(self.codes)
            child = (node[:, None] * FAN + np.arange(FAN)).ravel()
            who, spent, above = np.repeat(who, FAN), np.repeat(spent, FAN), np.repeat(above, FAN)
            real = child < below
            who, spent, above, child = who[real], spent[real], above[real], child[real]
            if level:
                mask, bits = self.levels[level - 1]
                spent = spent + np.bitwise_count((self.codes[who] ^ bits[child]) & mask[child] & ~above)
            else:
                spent = spent + np.bitwise_count((self.codes[who] ^ self.codes[child]) & ~above)
            node = child
        keep = (spent <= max_bits) & (node > who)
        keep[keep] &= comp[node[keep]] != comp[who[keep]]
        return who[keep], node[keep]


def _union(comp: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``comp`` after uniting the components of each pair; every component is named by its least member."""
    if not len(i):
        return comp
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    for a, b in np.unique(np.stack([comp[i], comp[j]], 1), axis=0).tolist():
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    names = np.arange(len(comp))
    changed = np.array(list(parent), np.int64)
    names[changed] = [root(x) for x in changed.tolist()]
    return names[comp]


def link_group(codes: np.ndarray, max_bits: int) -> np.ndarray:
    """The component of each code within the group; ``codes`` are distinct and in Gray order."""
    n = len(codes)
    near = np.bitwise_count(codes[1:] ^ codes[:-1]) <= max_bits
    starts = np.concatenate([[True], ~near])
    comp = np.flatnonzero(starts)[np.cumsum(starts) - 1]
    if n <= 2 or not starts[1:].any():
        return comp
    index = GrayIndex(codes)
    step = max(1, _FRONTIER * FAN // (n + FAN))
    for at in range(0, n, step):
        comp = _union(comp, *index.search(np.arange(at, min(n, at + step)), comp, max_bits))
    return comp


def _link(max_bits: int):
    """Task side: rows (block, key, one, two, fp) in order of group and Gray rank -> spanning stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest = None, []
        found: list[np.ndarray] = []

        def close() -> None:
            codes = np.concatenate(rest)
            if len(codes) > 1:
                comp = link_group(codes, max_bits)
                linked = np.flatnonzero(comp != np.arange(len(codes)))
                if len(linked):
                    found.append(np.stack([codes[linked], codes[comp[linked]]]))

        def flush() -> pa.RecordBatch:
            pairs = np.concatenate(found, axis=1).view(np.int64)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], 1)
            codes = batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(codes)], strict=True):
                key = tuple(keys[a])
                if key != rest_key:
                    if rest:
                        close()
                    rest_key, rest = key, []
                rest.append(codes[a:b].copy())
            if sum(x.shape[1] for x in found) > 10_000:
                yield flush()
        if rest:
            close()
        if found:
            yield flush()

    return run


def link_fingerprints(codes: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """Edges (a, b) that span the components of ``codes`` (distinct ``fp``), of at most ``max_bits`` differing bits each chain link."""
    blocks, at, groups = max_bits + 1, 0, []
    for k in range(blocks):
        width = 64 // blocks + (k < 64 % blocks)
        key = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1))
        groups.append(F.struct(F.lit(k).alias("block"), key.cast("int").alias("key")))
        at += width
    routed = codes.select("fp", F.explode(F.array(*groups)).alias("g")).select("fp", "g.block", "g.key")
    # at most (max_bits + 1) * 2 ** ceil(64 / (max_bits + 1)) groups
    large = (routed.groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_group)
             .select("block", "key", F.ceil(F.col("n") / max_group).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), parts - 1),
                        lambda p: F.struct(F.least(p, F.col("own")).alias("one"), F.greatest(p, F.col("own")).alias("two")))
    tiled = (routed.join(large, ["block", "key"], "left").withColumn("own", own).withColumn("parts", parts)
             .select("block", "key", "fp", F.explode(tiles).alias("t")).select("block", "key", "t.one", "t.two", "fp"))
    dealt = (tiled.repartition("block", "key", "one", "two").withColumn("rank", gray_rank(F.col("fp")))
             .sortWithinPartitions("block", "key", "one", "two", "rank").drop("rank"))
    return dealt.mapInArrow(_link(max_bits), "a long, b long").distinct()


def _rows_and_roots(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int,
                    max_group: int) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every document, and (fp, root, component_id) of every distinct fingerprint."""
    rows = fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "text", shingle)
    rows = staged(rows.select("row.id", "fp"), "fingerprints")
    codes = staged(rows.groupBy("fp").agg(F.min("id").alias("least")), "codes")
    groups = connected_components(link_fingerprints(codes.select("fp"), max_bits, max_group), "a", "b")
    rooted = codes.join(groups, codes["fp"] == groups["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows, rooted.join(named, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """Columns ``id``, ``fp`` and ``component_id`` (the least id reachable), a row for each document.

    Null and empty texts have fingerprint 0 and link like any other. Documents
    without an id get the component of their fingerprint; a component without any
    id has a null ``component_id``. Works on an empty table.
    """
    rows, roots = _rows_and_roots(docs, id_col, text_col, shingle, max_bits, max_group)
    return rows.join(roots, "fp").select("id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """``docs`` with one document of each group: that with the least id.

    Where rows repeat that id, the one of least text stays. Rows without an id stay
    only where no row of the group has one, again the one of least text.
    """
    rows, roots = _rows_and_roots(docs, id_col, text_col, shingle, max_bits, max_group)
    roots = staged(roots, "roots")
    many = rows.where(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    single = roots.select(F.col("component_id").alias("id")).distinct().join(many.where("n = 1"), "id", "left_semi")
    first = docs.join(single, docs[id_col] == single["id"], "left_semi")
    # rows that share an id, or have none, are told apart by their fingerprint
    repeated = many.where("n > 1")
    odd = docs.where(F.col(id_col).isNull()).unionAll(docs.join(repeated, docs[id_col] == repeated["id"], "left_semi"))
    odd = fingerprints(odd, text_col, shingle).join(roots, "fp").where(F.col(f"row.`{id_col}`").eqNullSafe(F.col("component_id")))
    order = F.struct(F.col(f"row.`{text_col}`"), F.xxhash64("row"))
    return first.unionAll(odd.groupBy("root").agg(F.min_by("row", order).alias("row")).select("row.*"))
