"""Log-bilinear language model with noise-contrastive estimation.

Tokens are the words of a text (A-Z in lower case) and one end. The most frequent
words - half as many as the root of the number of training tokens, so their number grows
with the corpus - have vectors of their own as context and as output; all other
words share ``TAILS`` vectors by their last two bytes. All words have a
probability, by two levels of classes:

    P(word | context) = P(class | context) * P(word | class, context)

A class is the end, a run of the model's words in order of frequency, or one of the tails;
within a tail, a word has its share of the training counts, each raised by one, and
one more share is for unseen words. Both factors are normalised, so all words and the
unseen ones sum to one. The context's vectors, each weighted by a vector of its place, add
up to a prediction; its product with the vector of a class or word and that one's bias
is its score (Mnih and Hinton's model with diagonal weights).

* Counts come from all training documents. The ``HEAD`` most frequent words
  travel as a broadcast table; the counts of all others are joined.
* Training reads every training document once, in ``ROUNDS`` rounds. Documents are dealt into
  shards by a hash of id and content, about ``SHARD_TOKENS`` tokens each, and shards into
  rounds. Every shard's learner starts from the parameters of the round before, reads its
  documents in order of that hash, and learns by AdaGrad to tell the next class from noise drawn by frequency, and the next
  word from noise of its class. Then each parameter row is averaged over the shards,
  weighted by how often they used it, in order of the shards. So the model depends on the rows alone, not on
  their order, partitions or the cluster.
* Scores come from matrix products of whole blocks with all classes, and with all words of a class.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import as_bytes, staged, with_results

HEAD = 1 << 17
LONGEST_WORD = 64  # bytes of a word in the head
MOST_WORDS = 1 << 15  # with vectors of their own
TAILS = 16
END = 0
WIDTH = 16
CONTEXT = 3
NOISE, WORD_NOISE = 16, 2
BATCH = 8192
RATE = 0.03
ROUNDS = 4
SHARD_TOKENS = 1 << 20
_BLOCK = 1 << 18
_ROWS = 1 << 11
_FLUSH = 1 << 19
_CHUNK = 512  # parameter rows that travel together


def tokenise(text: bytes) -> list[bytes]:
    return text.lower().split()


def _tail(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, c) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            words, counts = list(held), list(held.values())
            for i in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[i : i + (1 << 16)], pa.binary()), pa.array(counts[i : i + (1 << 16)], pa.int64())], names=["word", "c"])
            held.clear()

        for batch in batches:
            for text in as_bytes(batch.column(0)):
                held.update(tokenise(text))
                if len(held) >= _FLUSH:
                    yield from flush()
        yield from flush()

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word binary, c long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Layout:
    """How outputs are numbered: the end, the model's words in order of frequency, the tails; and after them, as context only, the start."""

    words: int

    @property
    def outputs(self) -> int:
        return 1 + self.words + TAILS

    @property
    def size(self) -> int:
        """Words of a class."""
        return max(1, math.isqrt(self.words))

    @property
    def word_classes(self) -> int:
        return -(-self.words // self.size)

    @property
    def classes(self) -> int:
        return 1 + self.word_classes + TAILS

    def class_of(self, outputs: np.ndarray) -> np.ndarray:
        outputs = outputs.astype(np.int64)
        return np.where(outputs > self.words, outputs - self.words + self.word_classes, np.where(outputs > 0, 1 + (outputs - 1) // self.size, 0))


@dataclass(frozen=True)
class Counts:
    """What the tasks need to know of the counts."""

    total: int  # training tokens, ends included
    distinct: int  # distinct training tokens, the end included
    ends: int
    head: list[tuple[bytes, int]]  # the most frequent words with their counts, in order
    layout: Layout
    tail_total: np.ndarray  # by tail: counts raised by one, and one more
    output_count: np.ndarray  # by output

    @staticmethod
    def of(vocabulary: DataFrame, documents: int, head: int, most_words: int = MOST_WORDS) -> Counts:
        sums = vocabulary.agg(F.sum("c"), F.count(F.lit(1))).first()
        # the head is all words from a count on, so that none are sorted: by sixteenths of a doubling, as many as fit
        short = vocabulary.where(F.octet_length("word") <= LONGEST_WORD)
        grade = F.floor(F.log2("c") * 16).cast("int")
        least, have, parts = None, 0, 1
        for r in sorted(short.groupBy(grade.alias("g")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
            have += r["n"]
            if have > head and least is None and head:  # as many of the first grade, by hash, as fit
                least, parts = r["g"], -(-r["n"] // head)
            if have > head:
                break
            least = r["g"]
        top = []
        if least is not None:
            top = [(bytes(r[0]), r[1]) for r in short.where((grade >= least) & (F.pmod(F.xxhash64("word"), F.lit(parts)) == 0)).collect()]
            top.sort(key=lambda x: (-x[1], x[0]))
        total = (sums[0] or 0) + documents
        layout = Layout(min(len(top), most_words, max(64, math.isqrt(total) // 2)))
        by_tail = vocabulary.groupBy(F.pmod(F.crc32(F.expr("substring(word, -2, 2)")), F.lit(TAILS)).alias("k")).agg(
            F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
        count, kinds = np.zeros(TAILS), np.zeros(TAILS)
        for r in by_tail:
            count[r["k"]], kinds[r["k"]] = r["c"], r["v"]
        for word, c in top[: layout.words]:
            count[_tail(word)] -= c
            kinds[_tail(word)] -= 1
        outputs = np.concatenate([[documents], [c for _, c in top[: layout.words]], count])
        return Counts(total, sums[1] + (documents > 0), documents, top, layout, count + kinds + 1, outputs)


class Table:
    """The head as look-up arrays, made once in a Python worker; the last entry is the end."""

    END_WORD = b" "  # no word has white space

    def __init__(self, counts: Counts):
        self.place = {w: i for i, (w, _) in enumerate(counts.head)} | {self.END_WORD: len(counts.head)}
        self.words = counts.layout.words
        self.output = np.array([*[1 + (i if i < self.words else self.words + _tail(w)) for i, (w, _) in enumerate(counts.head)], END], np.uint16)
        c = np.array([*[c for _, c in counts.head], counts.ends], float)
        self.known = (c > 0).astype(np.int64)
        self.base = np.log10((c + 1) / (counts.total + counts.distinct + 1))
        tail = np.maximum(self.output.astype(np.int64) - self.words - 1, 0)
        self.within = np.where(self.output > self.words, np.log10((c + 1) / counts.tail_total[tail]), 0.0)
        self.tail_log = np.log10(counts.tail_total)
        self.all_log = np.log10(counts.total + counts.distinct + 1)

    def encode(self, documents: list[list[bytes]]) -> list:
        """For each document, which ends in END_WORD: known tokens, sums of base and tail logarithms, outputs, other words."""
        stream = [w for words in documents for w in words]
        first = np.concatenate([[0], np.cumsum([len(words) for words in documents])[:-1]]).astype(np.int64)
        get = self.place.get
        at = np.array([get(w, -1) for w in stream], np.int64)
        missing = np.flatnonzero(at < 0)
        others = [stream[i] for i in missing.tolist()]
        outputs, base, within, known = self.output[at], self.base[at], self.within[at], self.known[at]
        tails = np.array([_tail(w) for w in others], np.int64)
        outputs[missing] = 1 + self.words + tails
        base[missing], known[missing] = -self.all_log, 0
        within[missing] = -self.tail_log[tails]
        cuts = np.searchsorted(missing, [*first, len(stream)]).tolist()
        return [*zip(np.add.reduceat(known, first).tolist(), np.add.reduceat(base, first).tolist(), np.add.reduceat(within, first).tolist(),
                     [x[:-1].tobytes() for x in np.split(outputs, first[1:])],
                     [others[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True)]


_made: list = [None, None]


def _table(shared) -> Table:
    if _made[0] is not shared.value:
        _made[:] = [shared.value, Table(shared.value)]
    return _made[1]


_CODED = ("n_tokens long, n_known long, base double, within double, outputs binary, "
          "rest array<binary>")


def _encode(shared):
    """Texts -> outputs, and the sums of what the head knows; ``rest`` are the other words, whose counts are to be joined."""

    def fn(texts: pa.Array) -> list[pa.Array]:
        table, out, held, size = _table(shared), [], [], 0
        for text in as_bytes(texts):
            held.append([*tokenise(text), Table.END_WORD])
            size += len(held[-1])
            if size >= _BLOCK:
                out += table.encode(held)
                held, size = [], 0
        if held:
            out += table.encode(held)
        flat = [w for x in out for w in x[4]]
        cuts = np.concatenate([[0], np.cumsum([len(x[4]) for x in out])]).astype(np.int32)
        return [pa.array([len(x[3]) // 2 + 1 for x in out], pa.int64()), pa.array([x[0] for x in out], pa.int64()),
                pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.float64()),
                pa.array([x[3] for x in out], pa.binary()), pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat, pa.binary()))]

    return fn


@dataclass
class LogBilinear:
    """Vectors of context tokens and of places, vectors and biases of classes and of the words within their class."""

    layout: Layout
    tokens: np.ndarray
    places: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray
    word_bias: np.ndarray
    class_noise: np.ndarray
    word_count: np.ndarray

    TABLES = ("tokens", "places", "classes", "class_bias", "words", "word_bias")

    @staticmethod
    def initial(layout: Layout, output_count: np.ndarray, seed: int) -> LogBilinear:
        rng = np.random.default_rng(seed)
        noise = np.bincount(layout.class_of(np.arange(layout.outputs)), output_count, layout.classes) + 1
        noise /= noise.sum()
        count = output_count[1 : 1 + layout.words] + 1.0
        own = np.bincount(np.arange(layout.words) // layout.size, count, max(1, layout.word_classes))

        def drawn(n: int) -> np.ndarray:
            return rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32)

        return LogBilinear(layout, drawn(layout.outputs + 1), np.full((CONTEXT, WIDTH), 1 / CONTEXT, np.float32), drawn(layout.classes),
                           np.log(noise).astype(np.float32)[:, None], drawn(layout.words),
                           np.log(count / own[np.arange(layout.words) // layout.size]).astype(np.float32)[:, None], noise, count)

    def copy(self) -> LogBilinear:
        return LogBilinear(self.layout, *[getattr(self, k).copy() for k in self.TABLES], self.class_noise, self.word_count)

    def predicted(self, context: np.ndarray) -> np.ndarray:
        if context.shape[1] < len(self.tokens):
            return sum(self.tokens.take(context[i], axis=0) * self.places[i] for i in range(CONTEXT))
        total = (self.tokens * self.places[0]).take(context[0], axis=0)
        for i in range(1, CONTEXT):
            total += (self.tokens * self.places[i]).take(context[i], axis=0)
        return total

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log10 of the normalised probability of each target output."""
        layout, predicted = self.layout, self.predicted(context)
        kind = layout.class_of(target).astype(np.uint16)
        out = _own_log(predicted, self.classes, self.class_bias, kind)
        order = np.argsort(kind, kind="stable")
        edges = np.searchsorted(kind[order], np.arange(1, 2 + layout.word_classes))
        for k in range(layout.word_classes):
            mine = order[edges[k] : edges[k + 1]]
            if len(mine):
                words = slice(k * layout.size, min(layout.words, (k + 1) * layout.size))
                out[mine] += _own_log(predicted.take(mine, axis=0), self.words[words], self.word_bias[words], target[mine].astype(np.int64) - 1 - words.start)
        return out / np.log(10)


def _own_log(predicted: np.ndarray, vectors: np.ndarray, bias: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Natural logarithm of the softmax of each row's own column."""
    out, ones, turned = np.empty(len(own)), np.ones(len(vectors)), np.ascontiguousarray(vectors.T.astype(float))
    for i in range(0, len(own), _ROWS):
        # sums in double precision, so that they don't depend on what else is in the block
        scores = predicted[i : i + _ROWS].astype(float) @ turned
        scores += bias[:, 0]
        mine = scores[np.arange(len(scores)), own[i : i + _ROWS]]
        high = scores.max()
        if high > 60:  # exp() would leave the range of its type
            high = scores.max(axis=1)
            scores -= high[:, None]
            mine -= high
        out[i : i + _ROWS] = mine - np.log(np.exp(scores.astype(np.float32)).astype(float) @ ones)
    return out


def _positions(coded: list[bytes], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context (a row for each place before), target, and the first position of each document; ends included."""
    pad, end = np.full(CONTEXT, start, np.uint16).tobytes(), np.array([END], np.uint16).tobytes()
    stream = np.frombuffer(b"".join([pad + x + end for x in coded]), np.uint16)
    sizes = np.array([len(x) // 2 + 1 for x in coded])
    at = np.ones(len(stream), bool)
    first = np.concatenate([[0], np.cumsum(sizes + CONTEXT)[:-1]])
    for i in range(CONTEXT):
        at[first + i] = False
    here = np.flatnonzero(at)
    return np.stack([stream[here - i - 1] for i in range(CONTEXT)]), stream[here], np.concatenate([[0], np.cumsum(sizes)[:-1]])


def _blocks(values: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for x in values:
        held.append(x)
        size += len(x) // 2 + 1
        if size >= _BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


class Learner:
    """AdaGrad on the noise-contrastive objectives of both levels, from given parameters."""

    def __init__(self, model: LogBilinear, seed: int):
        self.model = model.copy()
        self.squares = {k: np.full_like(getattr(model, k), 1e-2) for k in model.TABLES}
        self.uses = {k: np.zeros(len(getattr(model, k))) for k in model.TABLES}
        self.rng = np.random.default_rng(seed)
        self.class_bar = np.log(NOISE * model.class_noise).astype(np.float32)
        layout = model.layout
        self.ends = np.concatenate([[0], np.cumsum(model.word_count)])  # counts up to each word, for drawing
        starts = np.minimum(np.arange(layout.word_classes + 1) * layout.size, layout.words)
        self.class_start, self.class_count = self.ends[starts[:-1]], np.diff(self.ends[starts])
        share = model.word_count / np.repeat(self.class_count, np.diff(starts)) if layout.words else model.word_count
        self.word_bar = np.log(WORD_NOISE * share).astype(np.float32)

    def _step(self, name: str, rows: np.ndarray, gradient: np.ndarray, uses: np.ndarray) -> None:
        square = self.squares[name][rows] + gradient * gradient
        self.squares[name][rows] = square
        getattr(self.model, name)[rows] += RATE * gradient / np.sqrt(square)
        self.uses[name][rows] += uses

    def learn(self, context: np.ndarray, target: np.ndarray) -> None:
        order = self.rng.permutation(len(target))
        noise = self.rng.choice(self.model.layout.classes, (len(order) // BATCH + 1, NOISE), p=self.model.class_noise)
        for k, at in enumerate(range(0, len(order), BATCH)):
            rows = order[at : at + BATCH]
            self._batch(context.take(rows, axis=1).astype(np.int64), target.take(rows).astype(np.int64), noise[k])

    def _batch(self, context: np.ndarray, target: np.ndarray, noise: np.ndarray) -> None:
        m, n = self.model, np.float32(len(target))
        predicted, kind = m.predicted(context), m.layout.class_of(target)
        # classes, with noise that the batch shares
        own = m.classes.take(kind, axis=0)
        true = _missed(np.einsum("ij,ij->i", predicted, own) + m.class_bias[kind, 0] - self.class_bar[kind])
        other = _missed(predicted @ m.classes[noise].T + (m.class_bias[noise, 0] - self.class_bar[noise])) - 1
        back = true[:, None] * own + other @ m.classes[noise]
        steps = [("classes", "class_bias", np.concatenate([kind, noise]), np.concatenate([true[:, None] * predicted, other.T @ predicted]),
                  np.concatenate([true, other.sum(axis=0)]))]
        # words of the model, with noise of their class for each
        mine = np.flatnonzero((target > 0) & (target <= m.layout.words))
        if len(mine):
            word, at = target[mine] - 1, predicted.take(mine, axis=0)
            group = word // m.layout.size
            drawn = self.class_start[group][:, None] + self.rng.random((len(mine), WORD_NOISE)) * self.class_count[group][:, None]
            drawn = np.minimum(np.searchsorted(self.ends, drawn, side="right") - 1, m.layout.words - 1)
            both = np.concatenate([word[:, None], drawn], axis=1)
            vectors = m.words.take(both.ravel(), axis=0).reshape(*both.shape, WIDTH)
            missed = _missed(np.einsum("ij,ikj->ik", at, vectors) + m.word_bias[both, 0] - self.word_bar[both])
            missed[:, 1:] -= 1
            back[mine] += np.einsum("ik,ikj->ij", missed, vectors)
            steps.append(("words", "word_bias", both.ravel(), (missed[:, :, None] * at[:, None, :]).reshape(-1, WIDTH), missed.ravel()))
        by_place = [(context[i], back * m.places[i]) for i in range(CONTEXT)]
        places = np.stack([np.einsum("ij,ij->j", back, m.tokens.take(context[i], axis=0)) for i in range(CONTEXT)])
        steps.append(("tokens", None, np.concatenate([c for c, _ in by_place]), np.concatenate([g for _, g in by_place]), None))
        for name, bias, rows, gradient, slope in steps:
            at, uses, sums = _summed(rows, gradient if slope is None else np.concatenate([gradient, slope[:, None]], axis=1))
            sums /= uses[:, None]
            self._step(name, at, sums[:, :WIDTH], uses)
            if bias:
                self._step(bias, at, sums[:, WIDTH:], uses)
        self._step("places", np.arange(CONTEXT), places / n, np.full(CONTEXT, n))


def _missed(score: np.ndarray) -> np.ndarray:
    """How far a score is from certainty that its output isn't noise."""
    return (1 / (1 + np.exp(np.clip(score, -30, 30)))).astype(np.float32)


def _summed(where: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of ``where``, how often each is there, and the rows of ``what`` summed for each."""
    order = np.argsort(where.astype(np.uint16), kind="stable")
    places = where.take(order)
    starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    return places[starts], np.diff(np.append(starts, len(places))).astype(np.float32), np.add.reduceat(what.take(order, axis=0), starts)


def _learn_shards(shared, seed: int):
    """Rows in order of shard and spot -> for each shard and chunk of rows of a table: parameters times uses, and uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, learner, held, size = None, None, [], 0

        def learn() -> None:
            nonlocal held, size
            for block in _blocks(held):
                context, target, _ = _positions(block, learner.model.layout.outputs)
                learner.learn(context, target)
            held, size = [], 0

        def made() -> Iterator[pa.RecordBatch]:
            learn()
            for name in LogBilinear.TABLES:
                values, uses = getattr(learner.model, name), learner.uses[name]
                for at in range(0, len(values), _CHUNK):
                    use = uses[at : at + _CHUNK]
                    if use.any():
                        total = (values[at : at + _CHUNK] * use[:, None]).astype(np.float64)
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at], pa.int32()), pa.array([shard], pa.int64()),
                                                          pa.array([total.tobytes()], pa.binary()), pa.array([use.tobytes()], pa.binary())],
                                                         names=["name", "at", "shard", "total", "uses"])

        for batch in batches:
            for key, outputs in zip(batch.column("shard").to_pylist(), batch.column("outputs").to_pylist(), strict=True):
                if key != shard:
                    if learner is not None:
                        yield from made()
                    shard, learner = key, Learner(shared.value, seed + key)
                held.append(outputs)
                size += len(outputs) // 2 + 1
                if size >= _BLOCK:
                    learn()
        if learner is not None:
            yield from made()

    return run


def _add_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of table, chunk and shard: sums over the shards, one chunk is held."""
    key, total, uses = None, None, None

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([total.tobytes()], pa.binary()),
                                           pa.array([uses.tobytes()], pa.binary())], names=["name", "at", "total", "uses"])

    for batch in batches:
        for name, at, more, used in zip(*[batch.column(c).to_pylist() for c in ("name", "at", "total", "uses")], strict=True):
            more, used = np.frombuffer(more), np.frombuffer(used)
            if (name, at) == key:
                total, uses = total + more, uses + used
            else:
                if key is not None:
                    yield made()
                key, total, uses = (name, at), more, used
    if key is not None:
        yield made()


def train(coded: DataFrame, model: LogBilinear, shards: int, rounds: int, seed: int) -> LogBilinear:
    """``coded`` has (shard, spot, outputs), and is read once: round ``k`` takes the shards that are ``k`` modulo the rounds."""
    spark = coded.sparkSession
    for k in range(min(rounds, shards)):
        shared = spark.sparkContext.broadcast(model)
        own = -(-(shards - k) // rounds)
        rows = coded.where((F.col("round") == k)).select("shard", "spot", "outputs")
        dealt = rows.repartition(min(own, 1 << 17), "shard").sortWithinPartitions("shard", "spot", "outputs").select("shard", "outputs")
        parts = dealt.mapInArrow(_learn_shards(shared, seed), "name string, at int, shard long, total binary, uses binary")
        chunks = sum(-(-len(getattr(model, t)) // _CHUNK) for t in model.TABLES)
        sums = (parts.repartition(min(chunks, 64), "name", "at").sortWithinPartitions("name", "at", "shard")
                .mapInArrow(_add_shards, "name string, at int, total binary, uses binary").collect())  # the parameters, once
        model = model.copy()
        for r in sums:
            values, uses = getattr(model, r["name"]), np.frombuffer(r["uses"])
            used = np.flatnonzero(uses)
            total = np.frombuffer(r["total"]).reshape(len(uses), -1)
            values[r["at"] + used] = (total[used] / uses[used, None]).astype(np.float32)
    return model


def score_texts(docs: DataFrame, learning: Column, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD,
                seed: int = 7, shard_tokens: int = SHARD_TOKENS, rounds: int = ROUNDS, most_words: int = MOST_WORDS) -> DataFrame:
    """(id, learns, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    ``learning`` is a column over ``id`` that marks the rows to learn from. A null
    text is empty: its one token is the end. Rows that repeat are scored, and learnt
    from, each. Without any row to learn from, counts are 0 and the model is the
    initial one. Works on an empty table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("learns", F.coalesce(learning, F.lit(False))).withColumn("spot", F.xxhash64("id", "text"))
    vocabulary = staged(count_words(rows.where("learns"), "text"), "vocabulary")
    counts = Counts.of(vocabulary, rows.where("learns").count(), head, most_words)
    shared = spark.sparkContext.broadcast(counts)
    names = ["id", "learns", "spot"]
    coded = with_results(rows, ["text"], _CODED, _encode(shared)).select(*[f"row.{c}" for c in names], *[c.split()[0] for c in _CODED.split(", ")])
    shards = max(1, -(-counts.total // shard_tokens))
    shards = -(-shards // rounds) * rounds if shards > 1 else 1  # as many in each round
    shard = F.pmod("spot", F.lit(shards))
    coded = staged(coded.withColumns({"number": F.monotonically_increasing_id(), "shard": shard, "round": F.when(F.col("learns"), F.pmod(shard, F.lit(rounds))).otherwise(-1)}), "coded")
    rest = coded.select("number", F.explode("rest").alias("word")).join(vocabulary, "word", "left")
    sums = rest.groupBy("number").agg(F.count("c").alias("known"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("logs"))
    model = train(coded, LogBilinear.initial(counts.layout, counts.output_count, seed), shards, rounds, seed)
    learnt = spark.sparkContext.broadcast(model)

    def fn(outputs: pa.Array) -> list[pa.Array]:
        out, model = [], learnt.value
        for block in _blocks(outputs.to_pylist()):
            context, target, first = _positions(block, model.layout.outputs)
            out += np.add.reduceat(model.log_probabilities(context, target), first).tolist()
        return [pa.array(out, pa.float64())]

    scored = with_results(coded.drop("rest", "spot", "shard", "round"), ["outputs"], "log double", fn).select("row.*", "log").drop("outputs")
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.join(sums, "number", "left").select(
        "id", "learns", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"),
        (F.col("log") + F.col("within") + logs).alias("score"))
