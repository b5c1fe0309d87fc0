"""Substring search by an index of character trigrams.

The index has a posting for each trigram of each searched text, in lower case, stored by
field and bucket of the trigram, and the texts themselves, by field and bucket of their id.
A search takes the trigrams of the literal parts of its pattern, reads
the buckets of the rarest of them, keeps the ids that have all, and confirms those with the very
``ILIKE`` that a scan uses. So it reads a few buckets and the texts of its candidates;
patterns without a trigram (under three characters between wildcards) scan the
field's texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
RAREST = 4  # trigrams that are intersected
_SALTS = 8  # tasks that write a bucket, so that no task has all ids of a frequent trigram; more where a field has many texts
_ROWS_A_TASK = 1_000_000
TEXTS = "id string, text string, field string, bucket int"
POSTINGS = "gram string, id string, field string, bucket int"
COUNTS = "gram string, n long, field string"


def bucket_of(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("int")


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a text in lower case; none for a shorter one."""
    low = F.lower(text)
    return F.when(F.length(low) >= 3, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(low) - 2), lambda i: F.substring(low, i, F.lit(3))))).otherwise(
        F.array().cast("array<string>"))


def literal_parts(pattern: str) -> list[str]:
    """The parts of a LIKE pattern between wildcards; an escaped character stands for itself."""
    parts, now, i = [], "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            now += pattern[i + 1]
            i += 2
            continue
        if c in "%_":
            parts.append(now)
            now = ""
        else:
            now += c
        i += 1
    return [p for p in [*parts, now] if p]


def pattern_trigrams(pattern: str) -> list[str]:
    """The trigrams that any match must have. Parts outside ASCII count in pieces, since lower case may differ there."""
    found = set()
    for part in literal_parts(pattern):
        low = part.lower()
        found |= {low[i : i + 3] for i in range(len(low) - 2) if low[i : i + 3].isascii()}
    return sorted(found)


def contains_ci(col: Column | str, q: str) -> Column:
    """Case-insensitive substring match with SQL wildcard semantics kept for
    '%' and '_' inside ``q``; a trailing lone backslash is taken literally."""
    c = F.col(col) if isinstance(col, str) else col
    return c.ilike(f"%{_closed(q)}%")


def _closed(q: str) -> str:
    return q + "\\" if (len(q) - len(q.rstrip("\\"))) % 2 else q


def _salt(n: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n))


def _postings(texts: DataFrame) -> DataFrame:
    """The distinct (field, id, gram, bucket), dealt out once, in parts whose number follows the rows: what a task holds
    doesn't grow with the table, nor do the ids of a frequent trigram that meet in one part."""
    sizes = texts.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.sum(F.greatest(F.length("text") - 2, F.lit(0))).alias("grams")).collect()
    salts = max([_SALTS, *(math.ceil(r["n"] / _ROWS_A_TASK) for r in sizes)])
    parts = max(math.ceil(sum(r["grams"] for r in sizes) / _ROWS_A_TASK), texts.sparkSession.sparkContext.defaultParallelism)
    found = texts.select("field", "id", F.explode(trigrams(F.col("text"))).alias("gram"))
    # the salt stays a key of the distinct, so that this needs no other shuffle
    dealt = found.withColumns({"bucket": bucket_of(F.col("gram")), "salt": _salt(salts)}).repartition(parts, "field", "bucket", "salt").distinct()
    return dealt.sortWithinPartitions("field", "bucket", "gram", "id").drop("salt")


@dataclass(frozen=True)
class GramIndex:
    """An index below ``root``; ``build`` writes one."""

    spark: SparkSession
    root: str

    @staticmethod
    def build(entries: DataFrame, root: str) -> GramIndex:
        """``entries``: (field, id, text); null texts are in no result. Ids are compared as text."""
        rows = entries.where(F.col("text").isNotNull() & F.col("id").isNotNull()).select("field", F.col("id").cast("string").alias("id"), "text")
        rows.withColumn("bucket", bucket_of(F.col("id"))).repartition("field", "bucket", _salt(_SALTS)).sortWithinPartitions("field", "bucket", "id").write.partitionBy(
            "field", "bucket").parquet(f"{root}/texts")
        index = GramIndex(entries.sparkSession, root)
        _postings(index.texts()).write.partitionBy("field", "bucket").parquet(f"{root}/postings")
        index.postings().groupBy("field", "gram").agg(F.count(F.lit(1)).alias("n")).repartition("field").sortWithinPartitions("field", "gram").write.partitionBy(
            "field").parquet(f"{root}/counts")
        return index

    def texts(self) -> DataFrame:
        return self.spark.read.schema(TEXTS).parquet(f"{self.root}/texts")

    def postings(self) -> DataFrame:
        return self.spark.read.schema(POSTINGS).parquet(f"{self.root}/postings")

    def rarest(self, field: str, grams: list[str]) -> list[str] | None:
        """The RAREST of the trigrams by their number of ids; None if one of them is in no text."""
        counts = self.spark.read.schema(COUNTS).parquet(f"{self.root}/counts")
        known = counts.where((F.col("field") == field) & F.col("gram").isin(grams)).select("gram", "n").collect()  # a row for each asked
        if len(known) < len(grams):
            return None
        return [r["gram"] for r in sorted(known, key=lambda r: (r["n"], r["gram"]))[:RAREST]]

    def candidates(self, field: str, q: str) -> DataFrame | None:
        """Ids that have the rarest trigrams of the pattern; None if it has none."""
        grams = pattern_trigrams(_closed(q))
        if not grams:
            return None
        wanted = self.rarest(field, grams)
        if wanted is None:
            return self.postings().where(F.lit(False)).select("id")
        buckets = [r[0] for r in self.spark.range(1).select(F.explode(F.array(*[bucket_of(F.lit(g)) for g in wanted]))).distinct().collect()]
        asked = self.postings().where((F.col("field") == field) & F.col("bucket").isin(buckets) & F.col("gram").isin(wanted))
        return asked.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(wanted)).select("id")

    def matches(self, field: str, q: str) -> DataFrame:
        """The ids whose text has the pattern, as ``contains_ci`` says."""
        texts = self.texts().where(F.col("field") == field)
        found = self.candidates(field, q)
        if found is not None:
            texts = texts.join(found.withColumn("bucket", bucket_of(F.col("id"))), ["bucket", "id"])
        return texts.where(contains_ci("text", q)).select("id")
