"""Quality rules by robust distances: minimum covariance determinant per language and source.

Base rules reject texts that are too short or repeat themselves. Every other
text becomes a vector of transformed counts. For each language and source the
half of the vectors ((n + d + 1) / 2 of n, or ``SUPPORT`` if that is more) with the
least determinant is sought by concentration steps: distances under the present
estimate, the half with the smallest distances, their mean and covariance, and
again until the determinant stops falling. There are three starts: the median and
the median deviation of each coordinate, alone and with the correlations of the
vectors' hyperbolic tangents and of their spatial signs; the least determinant is
kept. Within the steps the squares of the least deviations are added to the
variances, as in the regularised form of the method: that sum has a determinant
that the steps can't raise. The covariance is scaled to be right for normal data,
one step re-weights all vectors within its 97.5 % ellipsoid, with the least
deviations as lower bounds, and vectors beyond the ``CUTOFF`` quantile are rejected.

All of it is DataFrame expressions. Estimates live in a table with a row for each
group; quantiles come from counts of fixed bins, which Spark sums before the
shuffle, so a group of any size is never in one place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegrid.llm.common import WHITE_SPACE, let, staged

MIN_WORDS = 50
REPEAT_SHARE = 50
SUPPORT = 0.5
STEPS = 100  # at most
FALL = 1e-3  # of the determinant's logarithm
MIN_ROWS = 50
CUTOFF = 1 - 1e-10

#: Name, expression over the base counts, and the least standard deviation of each coordinate.
COORDINATES: list[tuple[str, str, float]] = [
    ("length", "ln(1 + n_words)", 0.1),
    ("word_length", "ln(word_chars / n_words)", 0.1),
    ("symbols", "ln(0.01 + n_symbols / word_chars)", 0.25),
    ("marks", "ln(0.01 + n_marks / word_chars)", 0.25),
    ("dup_lines", "ln(0.1 + n_dup_lines / n_words)", 0.35),
    ("repeats", "ln(0.05 + n_repeat_words / n_words)", 0.35),
]
_D = len(COORDINATES)
_KEYS = ["level", "lang_key", "source_key"]
_RIDGE = 1e-3


def chi2_share(x: float, d: int) -> float:
    """Share of a chi-squared variable of even ``d`` below ``x``."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**k / math.factorial(k) for k in range(d // 2))


def chi2_quantile(p: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_share(mid, d) < p else (low, mid)
    return high


def _covered(windows: Column) -> Column:
    """Words within the windows (sorted starts) of three words."""
    return F.aggregate(
        windows, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that are found twice or more: windows are sorted by hash, equal neighbours keep
    their places, and the places are put in order again."""

    def places(hashes: Column) -> Column:
        rows = F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(hashes) - 3),
            lambda i: F.struct(F.xxhash64(hashes[i], hashes[i + 1], hashes[i + 2]).alias("h"), i.alias("i"))))
        return let(rows, lambda r: F.sort_array(F.transform(
            F.filter(F.transform(r, lambda x, k: F.struct(
                x["i"].alias("i"),
                (((k > 0) & (F.get(r, k - 1)["h"] == x["h"])) | ((k + 1 < F.size(r)) & (F.get(r, k + 1)["h"] == x["h"]))).alias("twice"))),
                lambda x: x["twice"]), lambda x: x["i"])))

    return F.when(F.size(words) >= 3, _covered(let(F.transform(words, lambda w: F.xxhash64(w)), places))).otherwise(F.lit(0).cast("long"))


def base_counts(text: Column) -> Column:
    """A struct of the counts of one text; null has no words."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, WHITE_SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            F.length(F.regexp_replace(text, r"[^!?]+", "")).cast("long").alias("n_marks"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).alias("n_repeat_words"))

    return let(words, counts)


def _scale_of(n: Column, of: Column) -> Column:
    """What makes the covariance of the closest ``n`` of ``of`` vectors right for normal data."""
    grades = [k / 200 for k in range(1, 200)]
    table = F.array(*[F.lit(g / chi2_share(chi2_quantile(g, _D), _D + 2)) for g in grades], F.lit(1.0))
    return F.element_at(table, F.greatest(F.lit(1), F.round(n / of * 200).cast("int")))


def _inverse(matrix: Column) -> Column:
    """The inverse of a positive definite matrix (an array of rows) by elimination in place."""
    return _eliminated(matrix)["a"]


def _eliminated(matrix: Column) -> Column:
    """The inverse ``a``, and ``log_det``: the sum of the pivots' logarithms."""

    def step(a: Column, k: Column) -> Column:
        pivot = F.get(a, k * _D + k)

        def entry(v: Column, at: Column) -> Column:
            i, j = F.floor(at / _D).cast("int"), at % _D
            left, up = F.get(a, i * _D + k), F.get(a, k * _D + j)
            return (F.when((i == k) & (j == k), 1 / pivot).when(i == k, v / pivot).when(j == k, -v / pivot)
                    .otherwise(v - left * up / pivot))

        return F.transform(a, entry)

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(_D - 1)), F.struct(matrix.alias("a"), F.lit(0.0).alias("log_det")),
        lambda s, k: F.struct(step(s["a"], k).alias("a"), (s["log_det"] + F.ln(F.get(s["a"], k * _D + k))).alias("log_det")))


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` under ``mean`` and ``inverse``."""
    z = [F.col("x")[i] - F.col("mean")[i] for i in range(_D)]
    total = F.lit(0.0)
    for i in range(_D):
        for j in range(i, _D):
            total = total + z[i] * z[j] * F.col("inverse")[i * _D + j] * (1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(0.0))


_SUMS = [f"s{i}" for i in range(_D)] + [f"p{i}_{j}" for i in range(_D) for j in range(i, _D)]


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, sums, sums of products) of the vectors."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(_D)],
        *[F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(_D) for j in range(i, _D)])


def _estimated(made: DataFrame, scale: float | None, keys: list[str] = _KEYS, added: bool = True) -> DataFrame:
    """Group keys, ``mean``, ``inverse`` and ``log_det`` of the covariance times ``scale`` (None: what its share of the
    group, ``all``, calls for), with the squares of the least deviations added, or else as lower bounds of the variances."""
    mean = [F.col(f"s{i}") / F.col("n") for i in range(_D)]
    factor = _scale_of(F.col("n"), F.col("all")) if scale is None else F.lit(scale)

    def entry(i: int, j: int) -> Column:
        i, j = min(i, j), max(i, j)
        spread = (F.col(f"p{i}_{j}") / F.col("n") - mean[i] * mean[j]) * factor
        least = COORDINATES[i][2] ** 2
        return spread if i != j else spread + least if added else F.greatest(spread, F.lit(least)) + _RIDGE * least

    matrix = F.array(*[entry(i, j) for i in range(_D) for j in range(_D)])
    done = made.select(*keys, F.array(*mean).alias("mean"), let(matrix, _eliminated).alias("e"))
    return done.select(*keys, "mean", F.col("e.a").alias("inverse"), F.col("e.log_det").alias("log_det"))


def _bin_quantile(rows: DataFrame, keys: list[str], place: str, share: float) -> DataFrame:
    """(keys, upto): the least bin so that ``share`` of the rows lie in it or below."""
    counts = rows.groupBy(*keys, place).agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy(*keys)
    counts = counts.withColumn("below", F.sum("n").over(within.orderBy(place))).withColumn("all", F.sum("n").over(within))
    return counts.where(F.col("below") >= F.col("all") * share).groupBy(*keys).agg(F.min(place).alias("upto"))


def _closest(rows: DataFrame, estimate: DataFrame, share: float, keys: list[str] = _KEYS) -> DataFrame:
    """The moments of the rows of the smallest distances, ``share`` of each group, (n + d + 1) / 2 at least (and all that share the last
    bin), and ``all``, how many rows there are: moments are summed by bins of the distance, so the rows are read once."""
    placed = rows.join(estimate, _KEYS).withColumn("place", F.floor(F.ln(_distance() + 1e-9) * 64))
    within = Window.partitionBy(*keys)
    bins = _moments(placed, [*keys, "place"]).withColumn("all", F.sum("n").over(within)).withColumn(
        "below", F.coalesce(F.sum("n").over(within.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    need = F.least(F.col("all"), F.greatest(F.col("all") * share, F.floor((F.col("all") + _D + 1) / 2)))
    return bins.where(F.col("below") < need).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("all").alias("all"), *[F.sum(c).alias(c) for c in _SUMS])


def _start(rows: DataFrame) -> DataFrame:
    """Median and median deviation of each coordinate, as an estimate with a diagonal covariance."""
    width = 64
    long = rows.select(*_KEYS, F.posexplode("x").alias("k", "v")).withColumn("place", F.floor(F.col("v") * width))
    keys = [*_KEYS, "k"]
    middle = staged(_bin_quantile(long, keys, "place", 0.5).select(*keys, F.col("upto").alias("middle")), "medians")
    off = long.join(middle, keys).withColumn("place", F.abs(F.col("place") - F.col("middle")))
    spread = _bin_quantile(off, keys, "place", 0.5).join(middle, keys)
    least = F.element_at(F.array(*[F.lit(c[2]) for c in COORDINATES]), F.col("k") + 1)
    deviation = F.greatest(F.col("upto") / width * 1.4826, least)
    made = spread.groupBy(*_KEYS).agg(F.sort_array(F.collect_list(  # one entry for each coordinate
        F.struct("k", (F.col("middle") / width).alias("m"), (1 / (deviation * deviation)).alias("w")))).alias("c"))
    matrix = F.array(*[F.col("c")[i]["w"] if i == j else F.lit(0.0) for i in range(_D) for j in range(_D)])
    return staged(made.select(*_KEYS, F.transform("c", lambda c: c["m"]).alias("mean"), matrix.alias("inverse")), "start")


def _starts(rows: DataFrame) -> DataFrame:
    """Three estimates for each group by ``start``: medians and median deviations alone (0), and with the correlations of
    the hyperbolic tangents (1) and of the spatial signs (2) of the vectors in their units."""
    plain = _start(rows)
    joined = rows.join(plain.withColumnRenamed("mean", "m"), _KEYS)
    z = F.array(*[(F.col("x")[i] - F.col("m")[i]) * F.sqrt(F.col("inverse")[i * _D + i]) for i in range(_D)])
    size = F.sqrt(F.aggregate("z", F.lit(0.0), lambda a, v: a + v * v) + 1e-12)
    turned = joined.select(*_KEYS, z.alias("z")).select(
        *_KEYS, F.posexplode(F.array(F.transform("z", lambda v: F.tanh(v)), F.transform("z", lambda v: v / size))).alias("k", "t"))
    sums = turned.groupBy(*_KEYS, (F.col("k") + 1).alias("start")).agg(
        *[F.sum(F.col("t")[i] * F.col("t")[j]).alias(f"p{i}_{j}") for i in range(_D) for j in range(i, _D)])

    def entry(i: int, j: int) -> Column:
        i, j = min(i, j), max(i, j)
        weight = 1 / F.sqrt(F.col("inverse")[i * _D + i] * F.col("inverse")[j * _D + j])
        if i == j:
            return weight
        both = F.sqrt(F.col(f"p{i}_{i}") * F.col(f"p{j}_{j}"))
        return weight * F.when(both > 1e-9, F.col(f"p{i}_{j}") / both).otherwise(0.0) * (1 - _RIDGE)

    matrix = F.array(*[entry(i, j) for i in range(_D) for j in range(_D)])
    turned = sums.join(plain, _KEYS).select(*_KEYS, "start", "mean", let(matrix, _inverse).alias("inverse"))
    return staged(plain.select(*_KEYS, F.lit(0).alias("start"), "mean", "inverse").unionByName(turned), "starts")


def _least_determinant(rows: DataFrame, support: float, steps: int) -> DataFrame:
    """For each group the estimate that has the least determinant of those where the concentration steps end."""
    keys = [*_KEYS, "start"]
    estimate, before, done = _starts(rows), None, []
    for k in range(steps):
        made = _estimated(_closest(rows, estimate, support, keys), 1.0, keys)
        # starts that met go on as one
        met = Window.partitionBy(*_KEYS, F.round("log_det", 9)).orderBy("start")
        now = made.withColumn("place", F.row_number().over(met)).where(F.col("place") == 1)
        if before is not None:
            now = now.join(before, keys, "left").withColumn("falls", F.col("log_det") < F.col("before") - FALL)
        else:
            now = now.withColumn("falls", F.lit(True))
        now = staged(now.select(*keys, "mean", "inverse", "log_det", "falls"), f"state-{k}")
        done.append(now.where(~F.col("falls") if k + 1 < steps else F.lit(True)))
        estimate = now.where("falls").select(*keys, "mean", "inverse")
        before = now.select(*keys, F.col("log_det").alias("before"))
        if estimate.isEmpty():
            break
    ends = done[0]
    for x in done[1:]:
        ends = ends.unionByName(x)
    best = ends.groupBy(*_KEYS).agg(F.min_by(F.struct("mean", "inverse"), F.struct("log_det", "start")).alias("e"))
    return staged(best.select(*_KEYS, "e.mean", "e.inverse"), "least")


def _grouped(rows: DataFrame, min_rows: int) -> DataFrame:
    """Adds the keys of the group whose estimate judges a row: its language and source (level 0), or if those have fewer than
    ``min_rows`` vectors, the whole language (1), or if that has fewer too, the whole corpus (2)."""
    keyed = rows.select("*", F.coalesce("lang", F.lit("")).alias("lang_key"), F.coalesce("source", F.lit("")).alias("source_key"))
    sizes = staged(keyed.where(F.col("x").isNotNull()).groupBy("lang_key", "source_key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    whole = sizes.groupBy("lang_key").agg(F.sum("n").alias("of_lang"))
    level = F.when(F.col("n") >= min_rows, 0).when(F.col("of_lang") >= min_rows, 1).otherwise(2)
    levels = sizes.join(whole, "lang_key").select("lang_key", "source_key", level.alias("level"))
    return keyed.join(levels, ["lang_key", "source_key"], "left").select(
        *rows.columns, "level", F.when(F.col("level") == 2, "").otherwise(F.col("lang_key")).alias("lang_key"),
        F.when(F.col("level") > 0, "").otherwise(F.col("source_key")).alias("source_key"))


def _vectors(rows: DataFrame) -> DataFrame:
    """(keys, x): the vectors of every group that judges any row, all those of its language or of the corpus."""
    wanted = staged(rows.where(F.col("x").isNotNull()).select(*_KEYS).distinct(), "groups")
    lang, source = F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))
    groups = [F.struct(F.lit(k).alias("level"), a.alias("lang_key"), b.alias("source_key"))
              for k, (a, b) in enumerate([(lang, source), (lang, F.lit("")), (F.lit(""), F.lit(""))])]
    each = rows.where(F.col("x").isNotNull()).select("x", F.explode(F.array(*groups)).alias("g")).select("g.*", "x")
    return each.join(wanted, _KEYS, "left_semi").select(*_KEYS, "x")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_words: int = MIN_WORDS, repeat_share: int = REPEAT_SHARE, support: float = SUPPORT, steps: int = STEPS,
          min_rows: int = MIN_ROWS, cutoff: float = CUTOFF) -> DataFrame:
    """(id, the base counts, ``base_failed``, ``distance``, ``kept``) for each document.

    ``base_failed``: fewer than ``min_words`` words, or more than ``repeat_share`` % of
    them in repeated windows; such texts (null and empty ones too) take no part in
    the estimates and have no distance. Null languages or sources count as ``""``.
    Documents of a source with fewer than ``min_rows`` vectors are judged by the estimate
    of the whole language, or of the whole corpus if that has fewer too, whatever its
    size. Works on an empty table.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(source_col).cast("string").alias("source"), base_counts(F.col(text_col).cast("string")).alias("c"))
    base = base.select("id", "lang", "source", "c.*")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_share * F.col("n_words"))
    base = base.withColumn("base_failed", failed)
    vector = F.when(~F.col("base_failed"), F.array(*[F.expr(e) for _, e, _ in COORDINATES]))
    rows = staged(_grouped(staged(base.withColumn("x", vector), "counts"), min_rows), "vectors")
    vectors = staged(_vectors(rows), "judging")
    estimate = staged(_estimated(_closest(vectors, _least_determinant(vectors, support, steps), support), None), "scaled")
    near = chi2_quantile(0.975, _D)
    inner = vectors.join(estimate, _KEYS).where(_distance() <= near)
    estimate = staged(_estimated(_moments(inner, _KEYS), 0.975 / chi2_share(near, _D + 2), added=False), "reweighted")
    judged = rows.join(estimate, _KEYS, "left").withColumn("distance", F.when(F.col("x").isNotNull(), _distance()))
    far = F.coalesce(F.col("distance") > chi2_quantile(cutoff, _D), F.lit(False))
    return judged.select("id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "distance", (~F.col("base_failed") & ~far).alias("kept"))
