"""Fuzzy judge matching by a stored index of the known judges.

``resolve.match_judges`` works out the keys of all known judges for each batch. Here
they are kept: each judge is entered once, and a batch reads the folders that its own names ask
for. Both hold every match at the index's threshold, and say the same.

* *Tokens* of a judge, by bucket of the token; those among its rarest are marked. Which are the rarest
  is decided when the judge is entered: any order will do, since it is their share of the characters that counts.
* *Deletion keys* for pairs (length of the judge, length of a name), by bucket of the latter. A pair
  is covered when the first name of such a length asks for it: the judges of that length are read
  then, and later ones get the keys of all covered pairs of theirs when they are entered.
* *Characters*, a prefix of each judge's rarest, by bucket. Both sides need the same order here, so it is fixed by the
  first judges. They are read only where a string has too many deletion keys for a pair of lengths.

The tables lie in a ``Warehouse``. ``add`` writes to the commit that brings the judges, so
index and judges can't differ. What ``match`` covers is a commit of its own, which holds
whatever becomes of the load. One writer at a time is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from casegrid import schemas as S
from casegrid.operators import resolve as RS
from casegrid.session import stage_table

if TYPE_CHECKING:
    from casegrid.operators.upsert import Commit, Warehouse

BUCKETS = 64
_SALTS = 8  # tasks that write a bucket, so that no task has all judges of a frequent token or length
TABLES = {
    "judges": "s string, tokens array<string>, length int, mass int, bucket int",
    "lengths": "length int",
    "tokens": "el string, s string, rare boolean, bucket int",
    "pairs": "length int, other int",
    "keys": "key long, s string, length int, other int, bucket int",
    "crowded": "s string, length int, other int, bucket int",
    "order": "el string, freq long",
    "chars": "el string, s string, length int, bucket int",
}

_KEYED = pa.struct([("keys", pa.list_(pa.struct([("other", pa.int32()), ("key", pa.int64())]))), ("crowded", pa.list_(pa.int32()))])


@F.arrow_udf(from_arrow_type(_KEYED))
def _keyed(tokens: pa.Array, needs: pa.Array) -> pa.Array:
    """Deletion keys for each needed length; ``crowded`` are the lengths that would take too many."""
    out = []
    for mine, asked in zip(tokens.to_pylist(), needs.to_pylist(), strict=True):
        keys, crowded = [], []
        for need in asked or []:
            made = RS.deletion_keys(mine, [need])["keys"]
            if made is None:
                crowded.append(need["other"])
            else:
                keys += made
        out.append({"keys": keys, "crowded": crowded})
    return pa.array(out, _KEYED)


_keyed_udf = _keyed.asNondeterministic()


def _hashed(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("int")


def _by_length(value: Column) -> Column:
    return F.pmod(value, F.lit(BUCKETS)).cast("int")


def _only(stored: DataFrame, asked: DataFrame, bucket: Column) -> DataFrame:
    """The stored rows of the buckets that the asked rows fall in; the scan reads no other folder."""
    there = [r[0] for r in asked.select(bucket.alias("bucket")).distinct().collect()]  # BUCKETS at most
    return stored.where(F.col("bucket").isin(there))


@dataclass(frozen=True)
class JudgeIndex:
    """An index of judge names within a warehouse, for one threshold."""

    warehouse: Warehouse
    threshold: float = S.JUDGE_MATCH_THRESHOLD

    def __post_init__(self) -> None:
        RS.slack_of(self.threshold)

    @property
    def slack(self) -> float:
        return RS.slack_of(self.threshold)

    def _name(self, table: str) -> str:
        return f"judge_index_{f'{self.threshold:g}'.replace('.', '_')}_{table}"

    def read(self, table: str) -> DataFrame:
        return self.warehouse.read(self._name(table), TABLES[table])

    def _write(self, commit: Commit, table: str, rows: DataFrame) -> DataFrame:
        bucket = "bucket" if "bucket" in rows.columns else None
        return commit.write(self._name(table), rows, partition_by=bucket, spread=F.pmod(F.xxhash64("s"), F.lit(_SALTS)) if bucket else None)

    # -- building ----------------------------------------------------------

    def add(self, commit: Commit, judges: DataFrame) -> int:
        """Enter the ``judge_name`` rows that the index hasn't, and return their number. Names that are null or have no
        token match nothing, and aren't entered. The caller publishes the commit."""
        new = RS.with_tokens(judges.select(F.col("judge_name").alias("s")).where(F.col("judge_name").isNotNull()).distinct())
        new = stage_table(new.withColumn("bucket", _by_length(F.col("length"))), "judges-to-enter")
        known = _only(self.read("judges"), new, F.col("bucket")).select("s")
        new = self._write(commit, "judges", new.join(known, "s", "left_anti").select("s", "tokens", "length", "mass", "bucket"))
        entered = commit.written[self._name("judges")][1]
        if not entered:
            return 0
        self._write(commit, "lengths", new.select("length").distinct().join(self.read("lengths"), "length", "left_anti"))

        single = new.select("s", F.col("mass").alias("total"), F.explode("tokens").alias("el")).withColumn("weight", F.length("el"))
        probe = RS.rarest(single, ["s"], self._rare_enough(), self._token_counts(single, also=single)).withColumn("rare", F.lit(True))
        tokens = single.join(probe, ["s", "el"], "left").select("el", "s", F.coalesce("rare", F.lit(False)).alias("rare"), _hashed(F.col("el")).alias("bucket"))
        self._write(commit, "tokens", tokens)

        bags = self._bags(new)
        order = self.read("order")
        if order.isEmpty():
            order = self._write(commit, "order", bags.groupBy("el").agg(F.count(F.lit(1)).alias("freq")))
        chars = self._prefixes(bags, order).select("el", "s", "length", _hashed(F.col("el")).alias("bucket"))
        self._write(commit, "chars", chars)
        self._enter_keys(commit, new, self.read("pairs"))
        return entered

    def _enter_keys(self, commit: Commit, judges: DataFrame, pairs: DataFrame) -> None:
        """Write the keys of ``judges`` for ``pairs`` of lengths."""
        keyed = stage_table(self._with_keys(judges, pairs), "judge-keys")
        side = _by_length(F.col("other")).alias("bucket")
        keys = keyed.select("s", "length", F.explode("made.keys").alias("k")).select(F.col("k.key").alias("key"), "s", "length", F.col("k.other").alias("other"))
        self._write(commit, "keys", keys.select("*", side))
        self._write(commit, "crowded", keyed.select("s", "length", F.explode("made.crowded").alias("other")).select("*", side))

    def _with_keys(self, strings: DataFrame, pairs: DataFrame) -> DataFrame:
        """``strings`` with what ``_keyed`` makes of the (length, other) ``pairs``; only those of a length among these."""
        needs = pairs.groupBy("length").agg(F.collect_list(F.struct("other", RS.deletions(self.slack).alias("n"))).alias("needs"))
        return strings.join(needs, "length").withColumn("made", _keyed_udf("tokens", "needs")).drop("needs")

    def _rare_enough(self) -> Column:
        return F.col("before") <= F.col("total") * RS.token_share(self.slack) + 1e-9

    def _token_counts(self, elements: DataFrame, also: DataFrame | None = None) -> DataFrame:
        """(el, freq): how many judges have each token of ``elements``, and how many rows of ``also``."""
        asked = elements.select("el").distinct()
        there = _only(self.read("tokens"), asked, _hashed(F.col("el"))).join(asked, "el", "left_semi").select("el")
        return (there if also is None else there.unionByName(also.select("el"))).groupBy("el").agg(F.count(F.lit(1)).alias("freq"))

    @staticmethod
    def _bags(strings: DataFrame) -> DataFrame:
        return strings.select("s", "length", F.col("mass").alias("total"), F.explode(RS.char_bag(F.array_join("tokens", ""))).alias("el"), F.lit(1).alias("weight"))

    def _prefixes(self, bags: DataFrame, order: DataFrame) -> DataFrame:
        return RS.rarest(bags, ["s", "length"], F.col("rank") <= F.col("total") - RS.char_overlap(self.slack) + 1, order)

    # -- matching ----------------------------------------------------------

    def match(self, raw_names: DataFrame, name_col: str = "name") -> DataFrame:
        """(name, matched_name, score) for each distinct incoming name, as ``resolve.match_judges`` says of the entered judges."""
        names = stage_table(raw_names.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull()).distinct(), "names")
        return RS.best_matches(names, self.candidates(names), self.threshold)

    def candidates(self, names: DataFrame) -> DataFrame:
        """Distinct (name, judge_name) pairs that may reach the threshold."""
        strings = stage_table(RS.with_tokens(names.select(F.col("name").alias("s"))), "name-strings")
        pairs = self._cover(strings)
        mine = pairs.select(F.col("other").alias("length"), F.col("length").alias("other"))  # as a name sees them
        keyed = stage_table(self._with_keys(strings, mine).select("s", "length", "made"), "name-keys")
        found = self._by_token(strings).unionByName(self._by_key(keyed))
        crowded = self._by_chars(strings, keyed)
        return (found if crowded is None else found.unionByName(crowded)).distinct()

    def _cover(self, strings: DataFrame) -> DataFrame:
        """The pairs of a judge's and a name's length that the batch asks for; those that are new get their keys."""
        asked = strings.select(F.col("length").alias("other")).distinct()
        there = self.read("lengths").distinct()
        wide = there.select("length", F.explode(RS.other_lengths(self.slack)).alias("other")).join(asked, "other")
        pairs = stage_table(wide.where(RS.deletions(self.slack) >= 0).select("length", "other"), "length-pairs")
        new = stage_table(pairs.join(self.read("pairs"), ["length", "other"], "left_anti"), "new-pairs")
        if not new.isEmpty():
            commit = self.warehouse.start()
            self._enter_keys(commit, _only(self.read("judges"), new, _by_length(F.col("length"))), new)
            self._write(commit, "pairs", new)
            commit.publish()
        return pairs

    def _by_token(self, strings: DataFrame) -> DataFrame:
        single = strings.select("s", F.col("mass").alias("total"), F.explode("tokens").alias("el")).withColumn("weight", F.length("el"))
        probe = RS.rarest(single, ["s"], self._rare_enough(), self._token_counts(single)).withColumn("first", F.lit(True))
        mine = single.join(probe, ["s", "el"], "left").select(F.col("s").alias("name"), "el", F.coalesce("first", F.lit(False)).alias("first"))
        theirs = _only(self.read("tokens"), single, _hashed(F.col("el"))).select("el", F.col("s").alias("judge_name"), "rare")
        return mine.join(theirs, "el").where(F.col("first") | F.col("rare")).select("name", "judge_name")

    def _by_key(self, keyed: DataFrame) -> DataFrame:
        mine = keyed.select(F.col("s").alias("name"), F.col("length").alias("other"), F.explode("made.keys").alias("k")).select(
            "name", "other", F.col("k.other").alias("length"), F.col("k.key").alias("key"))
        theirs = _only(self.read("keys"), keyed, _by_length(F.col("length"))).select("key", F.col("s").alias("judge_name"), "length", "other")
        return mine.join(theirs, ["key", "length", "other"]).select("name", "judge_name")

    def _by_chars(self, strings: DataFrame, keyed: DataFrame) -> DataFrame | None:
        """Pairs of which a side has too many keys; None if there is no such string."""
        lengths = keyed.select(F.col("length").alias("other")).distinct()
        full = _only(self.read("crowded"), keyed, _by_length(F.col("length"))).join(lengths, "other", "left_semi").select(
            F.col("s").alias("judge_name"), "length", "other")
        if full.isEmpty() and keyed.where(F.size("made.crowded") > 0).isEmpty():
            return None
        crowds = keyed.select("s", F.col("made.crowded").alias("crowded"))
        touched = strings.join(crowds, "s").join(full.select(F.col("other").alias("length")).distinct().withColumn("theirs", F.lit(True)), "length", "left")
        touched = touched.where((F.size("crowded") > 0) | F.col("theirs"))
        rare = stage_table(self._prefixes(self._bags(touched), self.read("order")), "name-chars")
        chars = _only(self.read("chars"), rare, _hashed(F.col("el"))).select("el", F.col("s").alias("judge_name"), F.col("length").alias("lb"))
        close = F.abs(F.col("la") - F.col("lb")) <= (F.col("la") + F.col("lb")) * self.slack + 1e-9
        met = rare.select("el", F.col("s").alias("name"), F.col("length").alias("la")).join(chars, "el").where(close).select("name", "la", "judge_name", "lb").distinct()
        met = met.join(crowds.withColumnRenamed("s", "name"), "name").join(
            full.select("judge_name", F.col("other").alias("la")).distinct().withColumn("theirs", F.lit(True)), ["judge_name", "la"], "left")
        return met.where(F.array_contains("crowded", F.col("lb")) | F.coalesce("theirs", F.lit(False))).select("name", "judge_name")
