"""Hard negatives by an inverted multi-index, with exact results.

Vectors are cut into two halves, each with a codebook of its own; a pair of
codewords is a cell. The codebooks are fitted on a bounded sample (``SAMPLE``), the
index holds every row: its cell, with the cell's row count and the largest distance
(radius) of its rows' halves from their codewords.

For an anchor q, no row of a cell scores more than

    q1 . c1 + |q1| * r1 + q2 . c2 + |q2| * r2.

The multi-sequence search visits cells in falling order of that sum: both halves'
codewords are sorted by their own bounds, and a heap gives the next pair. It stops
as soon as the next bound is under the score that a row must have to count, which is
certified by rows already scored (first those of the sample, which every task has):
the n-th best of the anchor's own label for positives, and the m-th best within each
window of scores for negatives. So nothing that counts is left out.

Positives are searched first, then negatives within the windows that the positives'
scores open. A search asks for cells in two rounds: the first up to ``BUDGET`` rows an anchor,
the second, with the scores of the first, for what isn't certified yet. Rows lie in packs, a
cell of very many rows in many of them; what an anchor asks for is joined with packs
by cell and pack, and blocks of anchors are multiplied with whole packs.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegrid.llm.common import staged

SAMPLE = 8192
CELL_ROWS = 1024
PACK_ROWS = 1024
MAX_CODES = 256
BUDGET = 1 << 16
LARGEST = 1 << 25
_ANCHORS = 512  # of a block
_HELD = 1 << 14  # anchors whose finds a task holds
_LEAST = -(1 << 62)


@dataclass(frozen=True)
class Index:
    """What every task knows: codebooks, cells and the sample; MAX_CODES**2 cells and 2 * SAMPLE rows at most."""

    cut: int  # components of the first half
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]  # by codeword
    cell_radii: np.ndarray  # by cell: one for each half
    counts: np.ndarray  # by cell
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    pack_rows: int = PACK_ROWS

    def packs(self, cell: int) -> int:
        return -(-int(self.counts[cell]) // self.pack_rows)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact: by floating point where no sum can leave its integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top = a.shape[1] * float(np.abs(a.astype(np.int64)).max()) * float(np.abs(b.astype(np.int64)).max())
    if top < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest codeword of each row, and the distance to it."""
    x = x.astype(float)
    code = ((book * book).sum(axis=1) - 2 * (x @ book.T)).argmin(axis=1)
    return code, np.sqrt(((x - book[code]) ** 2).sum(axis=1))


def codebook(x: np.ndarray, size: int, seed: int) -> np.ndarray:
    """``size`` codewords by Lloyd's steps from rows drawn at random."""
    rng = np.random.default_rng(seed)
    book = x[rng.choice(len(x), min(size, len(x)), replace=False)].astype(float)
    for _ in range(8):
        code, _ = _nearest(x, book)
        sums, counts = np.zeros_like(book), np.bincount(code, minlength=len(book))
        np.add.at(sums, code, x.astype(float))
        book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
    return book


def visit_order(query: np.ndarray, index: Index) -> Iterator[tuple[float, int]]:
    """(bound, cell) in falling order of the bound: the multi-sequence walk over the two sorted half bounds."""
    halves, orders = [], []
    for part, book, radius in zip((query[: index.cut], query[index.cut :]), index.books, index.radii, strict=True):
        part = part.astype(float)
        bound = book @ part + math.sqrt(part @ part) * radius
        orders.append(np.argsort(-bound, kind="stable"))
        halves.append(bound[orders[-1]])
    a, b = halves
    heap, seen = [(-(a[0] + b[0]), 0, 0)], {(0, 0)}
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(orders[0][i]) * len(b) + int(orders[1][j])
        for k, m in ((i + 1, j), (i, j + 1)):
            if k < len(a) and m < len(b) and (k, m) not in seen:
                seen.add((k, m))
                heapq.heappush(heap, (-(a[k] + b[m]), k, m))


def wanted_cells(query: np.ndarray, index: Index, least: float, most: float, start: int, budget: int | None) -> list[int]:
    """The cells to score for one anchor: those after the first ``start`` rows, up to ``budget`` rows in all, until a bound is
    under ``least``. Cells all of whose rows score under ``least`` or over ``most`` by their own radii are passed over."""
    one, two = query[: index.cut].astype(float), query[index.cut :].astype(float)
    norms = math.sqrt(one @ one), math.sqrt(two @ two)
    at_one, at_two = index.books[0] @ one, index.books[1] @ two
    slack = 1e-6 + 1e-9 * sum(n * float(np.abs(b).max(initial=0)) * math.sqrt(len(query)) for n, b in zip(norms, index.books, strict=True))
    out, rows = [], 0
    for bound, cell in visit_order(query, index):
        if bound + slack < least or budget is not None and rows >= budget:
            break
        count = int(index.counts[cell])
        rows += count
        if not count or rows - count < start:
            continue
        i, j = divmod(cell, len(index.books[1]))
        middle, spread = at_one[i] + at_two[j], norms[0] * index.cell_radii[cell, 0] + norms[1] * index.cell_radii[cell, 1]
        if middle + spread + slack >= least and middle - spread - slack <= most:
            out.append(cell)
    return out


def _best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Indices of the ``n`` highest scores of each row, ties by smaller id; in order of row and rank."""
    order = np.lexsort((ids, -scores, rows))
    r = rows[order]
    first = np.concatenate([[0], np.flatnonzero(r[1:] != r[:-1]) + 1]) if len(r) else np.zeros(0, np.int64)
    rank = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
    return order[rank < n]


class Finds:
    """The best rows that a task has found for each anchor and slot."""

    def __init__(self, n: int):
        self.n = n
        self.held: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (-score, id), best first

    def least(self, number: int, slot: int) -> int:
        have = self.held.get((number, slot), ())
        return -have[-1][0] if len(have) == self.n else _LEAST

    def add(self, numbers: np.ndarray, slot: int, allowed: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        r, c = np.nonzero(allowed)
        if not len(r):
            return
        s = scores[r, c]
        top = _best(r, s, ids[c], self.n)
        found: dict[int, list[tuple[int, int]]] = {}
        for k, score, row_id in zip(r[top].tolist(), s[top].tolist(), ids[c[top]].tolist(), strict=True):
            found.setdefault(k, []).append((-score, row_id))
        for k, new in found.items():
            key = (int(numbers[k]), slot)
            self.held[key] = sorted(self.held.get(key, []) + new)[: self.n]

    def batch(self) -> pa.RecordBatch:
        rows = [(number, slot, -s, i) for (number, slot), best in self.held.items() for s, i in best]
        self.held = {}
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                          names=["number", "slot", "score", "id"])


def _matrix(data: list[bytes] | bytes, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(data if isinstance(data, bytes) else b"".join(data), kind).reshape(-1, width)


def _windows(lists: list[list[int]], slots: int) -> np.ndarray:
    out = np.full((len(lists), slots), _LEAST, np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _allowed(index_labels: np.ndarray, index_ids: np.ndarray, ids: np.ndarray, labels: np.ndarray, same: bool) -> np.ndarray:
    if same:
        return (labels[:, None] == index_labels[None, :]) & (ids[:, None] != index_ids[None, :])
    return labels[:, None] != index_labels[None, :]


def _asks(shared, kind: str, width: int, same: bool, slots: int, n: int, start: int, budget: int | None):
    """Anchors -> (cell, pack, and the anchors of the block that ask for it, with what their rows must score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, _ANCHORS):
                batch = whole.slice(at, _ANCHORS)
                number, ids = (np.array(batch.column(c).to_pylist(), np.int64) for c in ("number", "id"))
                labels = np.array(batch.column("label").to_pylist(), np.int32)
                v = _matrix(batch.column("v").to_pylist(), kind, width)
                low, high, known = (_windows(batch.column(c).to_pylist(), slots) for c in ("low", "high", "known"))
                scores = products(v, index.vectors)
                fits = _allowed(index.labels, index.ids, ids, labels, same)
                least = np.maximum(low, known)
                for k in range(slots):  # the sample's rows certify a first bound
                    finds = Finds(n)
                    finds.add(np.arange(len(ids)), 0, fits & (scores >= least[:, k : k + 1]) & (scores <= high[:, k : k + 1]), scores, index.ids)
                    for i in range(len(ids)):
                        least[i, k] = max(least[i, k], finds.least(i, 0))
                by_cell: dict[int, list[int]] = {}
                for i in range(len(ids)):
                    used = high[i] > _LEAST
                    if used.any():
                        for cell in wanted_cells(v[i], index, float(least[i, used].min()), float(high[i, used].max()), start, budget):
                            by_cell.setdefault(cell, []).append(i)
                rows = [(cell, pack, number[mine].tobytes(), ids[mine].tobytes(), labels[mine].tobytes(), v[mine].tobytes(),
                         least[mine].tobytes(), high[mine].tobytes())
                        for cell, mine in by_cell.items() for pack in range(index.packs(cell))]
                for k in range(0, len(rows), 256):
                    part = rows[k : k + 256]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[c] for r in part], pa.int32() if c < 2 else pa.binary()) for c in range(8)],
                        names=["cell", "pack", "number", "anchor", "own", "q", "least", "most"])

    return run


_ASKS = "cell int, pack int, number binary, anchor binary, own binary, q binary, least binary, most binary"
_FOUND = "number long, slot int, score long, id long"


def _score(kind: str, width: int, same: bool, slots: int, n: int):
    """Asks joined with packs -> the best rows of each anchor and slot that the task has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finds = Finds(n)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("number", "anchor", "own", "q", "least", "most", "ids", "labels", "v")]
            for number, anchor, own, q, least, most, ids, labels, v in zip(*columns, strict=True):
                number, anchor, own = np.frombuffer(number, np.int64), np.frombuffer(anchor, np.int64), np.frombuffer(own, np.int32)
                least, most = (np.frombuffer(x, np.int64).reshape(-1, slots) for x in (least, most))
                ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int32)
                scores = products(_matrix(q, kind, width), _matrix(v, kind, width))
                fits = _allowed(labels, ids, anchor, own, same)
                for k in range(slots):
                    bar = np.array([max(x, finds.least(a, k)) for x, a in zip(least[:, k].tolist(), number.tolist(), strict=True)])
                    finds.add(number, k, fits & (scores >= bar[:, None]) & (scores <= most[:, k : k + 1]), scores, ids)
                if len(finds.held) >= _HELD * slots:
                    yield finds.batch()
        if finds.held:
            yield finds.batch()

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of cell, pack and id -> one row for each pack."""
    key, ids, labels, vectors = None, [], [], []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
             pa.array([np.array(labels, np.int32).tobytes()], pa.binary()), pa.array([b"".join(vectors)], pa.binary())],
            names=["cell", "pack", "ids", "labels", "v"])

    for batch in batches:
        for cell, pack, row_id, label, v in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
            if (cell, pack) != key:
                if key is not None:
                    yield made()
                key, ids, labels, vectors = (cell, pack), [], [], []
            ids.append(row_id)
            labels.append(label)
            vectors.append(v)
    if key is not None:
        yield made()


def _top(found: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("number", "slot").orderBy(F.desc("score"), F.asc("id"))  # a few rows of each task, which Spark cuts to n before the shuffle
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def usable_rows(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """(id, label, x) of the rows that take part, x in whole numbers: floor of ``scale`` times the component."""
    x = F.col(vector_col).cast("array<double>")
    whole = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    made = F.transform(x, lambda v: F.floor(F.least(F.greatest(v * scale, F.lit(-1.0 * LARGEST)), F.lit(1.0 * LARGEST))).cast("int"))
    return rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & whole).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"), made.alias("x"))


def build_index(rows: DataFrame, n_rows: int, width: int, kind: str, seed: int) -> tuple[Index, DataFrame]:
    """The index of (id, label, x) rows, and their packs: (cell, pack, ids, labels, v), ids in order."""
    spread = 1 << 20
    share = min(spread, math.ceil(spread * SAMPLE / n_rows))
    drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(spread)) < share).limit(2 * SAMPLE).toArrow()
    if not drawn.num_rows:
        drawn = rows.limit(SAMPLE).toArrow()

    def filled(lists: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(lists), width), kind)
        for i, x in enumerate(lists):
            out[i, : len(x)] = x
        return out

    sample, cut = filled(drawn["x"].to_pylist()), width // 2
    codes = min(MAX_CODES, max(1, round(math.sqrt(n_rows / CELL_ROWS))))
    books = tuple(codebook(part, codes, seed) for part in (sample[:, :cut], sample[:, cut:]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = filled(batch.column(2).to_pylist())
            one, far_one = _nearest(v[:, :cut], books[0])
            two, far_two = _nearest(v[:, cut:], books[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x.tobytes() for x in v], pa.binary()),
                 pa.array((one * len(books[1]) + two).astype(np.int32)), pa.array(far_one), pa.array(far_two)],
                names=["id", "label", "v", "cell", "far_one", "far_two"])

    placed = staged(rows.mapInArrow(place, "id long, label int, v binary, cell int, far_one double, far_two double")
                    .withColumn("number", F.monotonically_increasing_id()), "cells")
    counts, radii = np.zeros(len(books[0]) * len(books[1]), np.int64), np.zeros((len(books[0]) * len(books[1]), 2))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far_one").alias("one"), F.max("far_two").alias("two")).collect():
        counts[r["cell"]], radii[r["cell"]] = r["n"], (r["one"], r["two"])
    by_half = radii.reshape(len(books[0]), len(books[1]), 2)
    index = Index(cut, books, (by_half[:, :, 0].max(axis=1), by_half[:, :, 1].max(axis=0)), radii, counts,
                  np.array(drawn["id"].to_pylist(), np.int64), np.array(drawn["label"].to_pylist(), np.int32), sample, PACK_ROWS)
    sizes = placed.sparkSession.createDataFrame([(c, index.packs(c)) for c in np.flatnonzero(counts).tolist()], "cell int, packs int")
    # a pack of a cell by hash: some hold a few rows more, none holds a hot cell
    dealt = placed.join(F.broadcast(sizes), "cell").withColumn("pack", F.pmod(F.xxhash64("number"), F.col("packs")).cast("int"))
    ordered = dealt.repartition(_parts(n_rows, 1 << 17), "cell", "pack").sortWithinPartitions("cell", "pack", "id")
    packs = staged(ordered.select("cell", "pack", "id", "label", "v").mapInArrow(_packed, "cell int, pack int, ids binary, labels binary, v binary"), "packs")
    return index, packs, placed.select("number", "id", "label", "v")


def _parts(work: int, of_one: int) -> int:
    return int(min(1 << 17, max(8, math.ceil(work / of_one))))


def mine_hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                        scale: float = 256, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, seed: int = 7,
                        budget: int = BUDGET) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a column over ``id`` that marks the rows to mine for. An anchor's positives
    are the ``n_positives`` highest scored other rows of its label; for each, the negatives are the
    ``n_negatives`` highest scored rows of other labels that score ``low`` to ``high`` per cent of
    the positive's score. Scores are inner products of whole numbers, ties go to the smaller id.

    Rows with a null id, label, vector or component, or a component that isn't finite, take no part;
    components beyond LARGEST after scaling count as LARGEST, so that sums fit 64 bits; shorter vectors count as filled up with zeros. Rows
    of the same id are not each other's positives, and each is an anchor of its own. Works on an empty table.
    """
    spark = rows.sparkSession
    usable = staged(usable_rows(rows, id_col, vector_col, label_col, scale), "vectors")
    found = usable.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width"), F.count(F.when(anchors, 1)).alias("anchors"),
                       F.max(F.array_max(F.transform("x", lambda v: F.abs(v)))).alias("top")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not found["anchors"]:
        return spark.createDataFrame([], schema)
    width, kind = max(2, found["width"] or 0), "<i2" if (found["top"] or 0) < 1 << 15 else "<i4"
    index, packs, placed = build_index(usable, found["n"], width, kind, seed)
    shared = spark.sparkContext.broadcast(index)
    parts = _parts(found["n"] * found["anchors"], 1 << 21)
    mine = placed.where(anchors)
    rounds = [(0, None)] if found["n"] <= budget else [(0, budget), (budget, None)]

    def search(asking: DataFrame, same: bool, slots: int, n: int) -> DataFrame:
        """The best rows for each anchor and slot; ``asking`` has low, high and known scores for each slot."""
        best = None
        for start, upto in rounds:
            asks = asking.mapInArrow(_asks(shared, kind, width, same, slots, n, start, upto), _ASKS)
            joined = asks.repartition(parts, "cell", "pack").join(packs.repartition(parts, "cell", "pack"), ["cell", "pack"])
            made = joined.select("number", "anchor", "own", "q", "least", "most", "ids", "labels", "v").mapInArrow(_score(kind, width, same, slots, n), _FOUND)
            both = made if best is None else made.unionByName(best.drop("rank"))
            best = staged(_top(both, n), "best")
            if upto is not None:
                bars = best.where(F.col("rank") == n).groupBy("number").agg(F.collect_list(F.struct("slot", "score")).alias("bars"))  # one for each slot
                bar = F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), lambda k: F.coalesce(
                    F.get(F.transform(F.filter("bars", lambda b: b["slot"] == k), lambda b: b["score"]), F.lit(0)), F.lit(_LEAST)))
                asking = staged(asking.drop("known").join(bars, "number", "left").withColumn("known", bar).drop("bars"), "asking")
        return best

    one = F.array(F.lit(_LEAST + 1).cast("long"))
    asking = mine.select("number", "id", "label", "v", one.alias("low"), F.array(F.lit(1 << 62).cast("long")).alias("high"), one.alias("known"))
    positives = search(asking, True, 1, n_positives)
    lists = positives.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("p"))  # n_positives entries
    def hundredth(x: Column) -> Column:
        return ((x - F.pmod(x, F.lit(100))) / 100).cast("long")  # rounded down

    least, most = (F.transform("p", lambda p: -hundredth(-low * p["score"])), F.transform("p", lambda p: hundredth(high * p["score"])))
    windows = staged(mine.join(lists, "number").select("number", "id", "label", "v", "p", least.alias("low"), most.alias("high"), least.alias("known")), "windows")
    negatives = search(windows.drop("p"), False, n_positives, n_negatives)
    pairs = windows.select("number", F.col("id").alias("anchor_id"), F.posexplode("p").alias("slot", "p"))
    return pairs.join(negatives, ["number", "slot"]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
