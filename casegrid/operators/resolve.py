"""Entity resolution: fuzzy judge matching and scoped tag merging.

Both are similarity joins that don't compare all pairs. Candidates come from
equality joins on parts that any pair above the threshold must share; every
bound below is worked out from the threshold that the caller gives, so the
candidates hold every match at any threshold. The exact score is then computed
once for each candidate pair (Arrow UDF).
"""

from __future__ import annotations

import math
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from casegrid import schemas as S
from casegrid.functions import similarity as SIM
from casegrid.functions import text as TX
from casegrid.session import stage_table

_WS = r"(?U)\s+"
# Most deletion keys that one string may have; strings beyond it go by their rarest characters.
MAX_KEYS = 4096


# ---------------------------------------------------------------------------
# shared helpers
# ---------------------------------------------------------------------------

def char_bag(text: Column) -> Column:
    """Characters of a string with their occurrence number, as an array made within the row."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(chars, lambda c, i: F.concat(
        c, F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x == c)).cast("string")))


def rarest(elements: DataFrame, owner: list[str], keep: Column, freq: DataFrame | None = None) -> DataFrame:
    """Rows of ``elements`` (owner, el, weight, total) in the owner's rarest-first prefix. ``keep`` may use
    ``before`` (the weight of rarer elements), ``rank`` and ``total``. ``freq`` (el, freq) gives the order if it isn't
    that of the elements themselves; those it lacks come first."""
    if freq is None:
        freq = elements.groupBy("el").agg(F.count(F.lit(1)).alias("freq"))
    order = Window.partitionBy(*owner).orderBy(F.coalesce("freq", F.lit(0)), "el")
    ranked = elements.join(freq, "el", "left").select(
        "*", F.row_number().over(order).alias("rank"),
        F.coalesce(F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return ranked.where(keep).select(*owner, "el")


# ---------------------------------------------------------------------------
# Fuzzy judge matching
# ---------------------------------------------------------------------------

def deletion_keys(tokens: list[str], needs: list[dict]) -> dict:
    """Keys under which one string meets others: for every split of its tokens into shared ones and a rest, and for
    every other length, the shared tokens with the rest after ``n`` deletions. ``keys`` is None beyond MAX_KEYS."""
    splits = []
    for k in range(1 << len(tokens)) if len(tokens) <= 12 else ():
        rest = " ".join(t for i, t in enumerate(tokens) if not k >> i & 1)
        splits.append(("\0".join(t for i, t in enumerate(tokens) if k >> i & 1), rest))
    if not splits or sum(math.comb(len(r), min(n["n"], len(r))) for _, r in splits for n in needs) > MAX_KEYS:
        return {"keys": None}
    found = set()
    for shared, rest in splits:
        for need in needs:
            n = min(need["n"], len(rest))
            for gone in combinations(range(len(rest)), n):
                kept = "".join(c for i, c in enumerate(rest) if i not in gone)
                found.add((need["other"], xxhash.xxh3_64_intdigest(f"{shared}\1{kept}".encode()) - (1 << 63)))
    return {"keys": [{"other": o, "key": k} for o, k in found]}


_KEYS = pa.struct([("keys", pa.list_(pa.struct([("other", pa.int32()), ("key", pa.int64())])))])


@F.arrow_udf(from_arrow_type(_KEYS))
def _key_udf(tokens: pa.Array, needs: pa.Array) -> pa.Array:
    return pa.array([deletion_keys(t, n or []) for t, n in zip(tokens.to_pylist(), needs.to_pylist(), strict=True)], _KEYS)


_deletion_key_udf = _key_udf.asNondeterministic()


def other_lengths(slack: float) -> Column:
    """The lengths that a string of ``length`` may match by its rest."""
    low, high = F.ceil(F.col("length") * (1 - slack) / (1 + slack) - 1e-9), F.floor(F.col("length") * (1 + slack) / (1 - slack) + 1e-9)
    return F.sequence(low.cast("int"), high.cast("int"))


def deletions(slack: float) -> Column:
    """The deletions that a match of ``length`` with ``other`` takes at most on the side of ``length``: at most
    ``slack * (sum of lengths)`` insertions and deletions are allowed in all."""
    allowed = F.floor((F.col("length") + F.col("other")) * slack + 1e-9)
    return F.floor((allowed + F.col("length") - F.col("other")) / 2).cast("int")


def _needs(sides: DataFrame, slack: float) -> DataFrame:
    """(side, length, needs): the lengths on the other side that may match one of ``length``, with the deletions it
    takes on this side."""
    lengths = sides.select("side", "length").distinct()
    wanted = lengths.select("side", "length", F.explode(other_lengths(slack)).alias("other"))
    there = lengths.select(F.when(F.col("side") == "n", "j").otherwise("n").alias("side"), F.col("length").alias("other"))
    n = deletions(slack)
    return (wanted.join(there, ["side", "other"]).where(n >= 0).groupBy("side", "length")
            .agg(F.collect_list(F.struct(F.col("other").cast("int").alias("other"), n.alias("n"))).alias("needs")))


def with_tokens(strings: DataFrame) -> DataFrame:
    """Strings (``s``) with their distinct sorted tokens, the length of these joined by spaces, and without spaces (``mass``); none without a token."""
    tokens = F.array_sort(F.filter(F.array_distinct(F.split(F.col("s"), _WS)), lambda t: t != ""))
    return strings.withColumn("tokens", tokens).where(F.size("tokens") > 0).withColumn(
        "length", F.length(F.array_join("tokens", " "))).withColumn("mass", F.length(F.array_join("tokens", "")))


def token_share(slack: float) -> float:
    """The share of a side's characters that its rest has at most, where that rest is all that differs."""
    part = 2 * slack / (1 - slack)
    return 2 * part / (1 + 2 * part)


def char_overlap(slack: float) -> Column:
    """The characters that a string of ``total`` has in common with any that it matches by its rest."""
    return F.greatest(F.lit(0), F.ceil((F.col("total") - F.col("length") * slack) / (1 + 2 * slack) - 1e-9))


def slack_of(threshold: float) -> float:
    if not 50 <= threshold <= 100:
        raise ValueError(f"a threshold between 50 and 100 is needed, not {threshold}")
    return 1 - threshold / 100


def judge_candidates(names: DataFrame, judges: DataFrame, threshold: float) -> DataFrame:
    """(name, judge_name) pairs that may reach ``threshold`` on token-set similarity.

    With I the shared tokens, A and B the rest of each side and d = 1 - threshold/100:

    * one side's rest is empty, or I against I + A reaches the threshold: then A has at most
      2c/(1+2c) of its side's characters, c = 2d/(1-d). So among a side's rarest tokens, up to
      the first beyond that share, one is shared: these are looked up among the other's tokens.
    * I + A against I + B reaches it: then A and B are at most d * (sum of lengths) insertions
      and deletions apart, so both have a common rest after as many deletions as the lengths
      leave open; they meet under the key (I, that rest).
    * strings with too many such keys meet by characters: without spaces, at least
      (m - d * length) / (1 + 2d) of a string's m characters are in both, so the rarest
      m - that + 1 of each side have one in common.
    """
    slack = slack_of(threshold)
    share = token_share(slack)
    sides = names.select(F.lit("n").alias("side"), F.col("name").alias("s")).unionByName(
        judges.select(F.lit("j").alias("side"), F.col("judge_name").alias("s")))
    sides = with_tokens(sides)
    needs = _needs(sides, slack)
    # a string is few bytes and many keys: by its bytes, AQE would leave the keys of all to some tasks
    sides = sides.join(needs, ["side", "length"], "left").repartition(names.sparkSession.sparkContext.defaultParallelism, "side", "s")
    sides = stage_table(sides.withColumn("keys", _deletion_key_udf("tokens", "needs")["keys"]), "judge-strings")

    def side(df: DataFrame, which: str, name: str, *more) -> DataFrame:
        return df.where(F.col("side") == which).select(F.col("s").alias(name), *more)

    single = sides.select("side", "s", F.col("mass").alias("total"), F.explode("tokens").alias("el")).withColumn("weight", F.length("el"))
    probe = rarest(single, ["side", "s"], F.col("before") <= F.col("total") * share + 1e-9)
    by_token = side(probe, "n", "name", "el").join(side(single, "j", "judge_name", "el"), "el").select("name", "judge_name").unionByName(
        side(single, "n", "name", "el").join(side(probe, "j", "judge_name", "el"), "el").select("name", "judge_name"))
    keyed = sides.select("side", "s", "length", F.explode("keys").alias("k")).select("side", "s", "length", "k.other", "k.key")
    by_key = side(keyed, "n", "name", "length", "other", "key").join(
        side(keyed, "j", "judge_name", F.col("other").alias("length"), F.col("length").alias("other"), "key"),
        ["length", "other", "key"]).select("name", "judge_name")
    found = by_token.unionByName(by_key)
    crowded = F.col("keys").isNull() & F.col("needs").isNotNull()
    if not sides.where(crowded).isEmpty():
        bags = sides.select("side", "s", "length", F.col("mass").alias("total"), crowded.alias("crowded"),
                            F.explode(char_bag(F.array_join("tokens", ""))).alias("el")).withColumn("weight", F.lit(1))
        rare = rarest(bags, ["side", "s", "length", "crowded"], F.col("rank") <= F.col("total") - char_overlap(slack) + 1)
        a = side(rare, "n", "name", "el", F.col("length").alias("la"), F.col("crowded").alias("ca"))
        b = side(rare, "j", "judge_name", "el", F.col("length").alias("lb"), F.col("crowded").alias("cb"))
        close = F.abs(F.col("la") - F.col("lb")) <= (F.col("la") + F.col("lb")) * slack + 1e-9
        found = found.unionByName(a.join(b, "el").where((F.col("ca") | F.col("cb")) & close).select("name", "judge_name"))
    return found.distinct()


def match_judges(raw_names: DataFrame, judges: DataFrame, name_col: str = "name",
                 threshold: float = S.JUDGE_MATCH_THRESHOLD) -> DataFrame:
    """(name, matched_name, score) per distinct incoming name.

    The known judge of that very name; else the best with token-set score >=
    threshold (ties: smallest name); else the name with titles stripped (R1).
    ``judges`` is the pre-insert snapshot, so names within one batch are not
    matched to each other.
    """
    slack_of(threshold)
    names = stage_table(raw_names.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull()).distinct(), "judge-names")
    known = judges.select("judge_name").where(F.col("judge_name").isNotNull()).distinct()
    if names.isEmpty() or known.isEmpty():  # as in the first load, and in one that is done again
        return names.select("name", TX.strip_judge_titles("name").alias("matched_name"), F.lit(None).cast("double").alias("score"))
    return best_matches(names, judge_candidates(names, known, threshold), threshold)


def best_matches(names: DataFrame, candidates: DataFrame, threshold: float) -> DataFrame:
    """What ``match_judges`` says of distinct names, given (name, judge_name) pairs that hold all matches."""
    scored = candidates.withColumn(
        "score", SIM.token_set_ratio_udf("name", "judge_name")).where(F.col("score") >= threshold)
    order = F.struct(F.col("name") != F.col("judge_name"), -F.col("score"), F.col("judge_name"))
    best = scored.groupBy("name").agg(F.min_by(F.struct("judge_name", "score"), order).alias("b"))
    return names.join(best, "name", "left").select(
        "name", F.coalesce("b.judge_name", TX.strip_judge_titles("name")).alias("matched_name"), F.col("b.score").alias("score"))


# ---------------------------------------------------------------------------
# Scoped tag merging
# ---------------------------------------------------------------------------

SYNONYMS_SCHEMA = T.StructType([T.StructField("word", T.StringType()),
                                T.StructField("lemma", T.StringType())])


def synonym_edges(distinct_tags: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(scope_id, tag, target) where target is a tag of the same scope and
    a capitalised thesaurus lemma of one of tag's words (minus the word itself,
    checked against that word and every later word of the phrase)."""
    words = distinct_tags.select("scope_id", "tag", F.posexplode(F.split("tag", " ")).alias("j", "word"))
    syn = synonyms.select(F.lower("word").alias("lw"), "lemma").distinct()
    lem = words.join(syn, F.lower(words.word) == syn.lw).select(
        "scope_id", "tag", "j", TX.capitalize("lemma").alias("target"))
    last = lem.groupBy("scope_id", "tag", "target").agg(F.max("j").alias("j"))
    words_left = F.slice(F.split("tag", " "), F.col("j") + 1, F.size(F.split("tag", " ")))
    kept = last.where(~F.exists(words_left, lambda w: w == F.col("target")))
    present = distinct_tags.select("scope_id", F.col("tag").alias("target"))
    return kept.join(present, ["scope_id", "target"], "left_semi").where(F.col("target") != F.col("tag")) \
        .select("scope_id", "tag", "target")


def similar_tag_pairs(distinct_tags: DataFrame, threshold: float = S.TAG_SIMILARITY_THRESHOLD) -> DataFrame:
    """J15 pair stage: (scope_id, tag, similar_tag, jw) with Jaro-Winkler > threshold.

    A common prefix of up to four characters lifts a Jaro similarity j above 0.7 to
    j + 0.4 (1 - j) at most; and j is at most (m/a + m/b + 1)/3 with m characters in
    both, so m > (3 j - 2) of the longer string. Tags of a scope meet when their
    rarest characters, as many as that leaves open, have one in common. Pairs are
    scored once, whatever the number of scopes, and the found ones go back to them.
    """
    return _similar_pairs(stage_table(distinct_tags.select("scope_id", "tag").distinct(), "scope-tag-names"), threshold)


def _similar_pairs(there: DataFrame, threshold: float) -> DataFrame:
    """``there``: a written table of distinct (scope_id, tag), which is read several times."""
    least = max(0.7, (threshold - 0.4) / 0.6) if threshold >= 0.7 else threshold
    share = max(0.0, 3 * least - 2)
    tags = there.select("tag").distinct().withColumn("bag", char_bag(F.col("tag"))).withColumn("n", F.size("bag"))
    tags = tags.where("n > 0")
    elements = tags.select("tag", F.col("n").alias("total"), F.explode("bag").alias("el"), F.lit(1).alias("weight"))
    rare = rarest(elements, ["tag"], F.col("rank") <= F.col("total") - F.ceil(F.col("total") * share - 1e-9) + 1)
    placed = there.join(rare, "tag")
    met = placed.join(placed.select("scope_id", "el", F.col("tag").alias("other")), ["scope_id", "el"])
    pairs = met.where(F.col("tag") < F.col("other")).select("tag", "other").distinct()
    pairs = pairs.join(tags, "tag").join(tags.select(F.col("tag").alias("other"), F.col("bag").alias("bag2"), F.col("n").alias("n2")), "other")
    both = F.size(F.array_intersect("bag", "bag2"))
    high = (both / F.col("n") + both / F.col("n2") + F.lit(1.0)) / 3.0
    prefix = F.aggregate(F.sequence(F.lit(1), F.lit(4)), F.lit(0), lambda k, i: F.when(
        (F.length("tag") >= i) & (F.length("other") >= i) & (F.substring(F.col("tag"), F.lit(1), i) == F.substring(F.col("other"), F.lit(1), i)), i).otherwise(k))
    pairs = pairs.where(F.when(high > 0.7, high + prefix * 0.1 * (1.0 - high)).otherwise(high) > threshold)
    ways = F.array(F.struct("tag", F.col("other").alias("similar_tag")), F.struct(F.col("other").alias("tag"), F.col("tag").alias("similar_tag")))
    scored = pairs.select(F.explode(ways).alias("w")).select("w.*").withColumn("jw", SIM.jaro_winkler_udf("tag", "similar_tag"))
    scored = scored.where(F.col("jw") > threshold)
    return there.join(scored, "tag").join(there.select("scope_id", F.col("tag").alias("similar_tag")), ["scope_id", "similar_tag"]).select(
        "scope_id", "tag", "similar_tag", "jw")


def _merged(nodes: Column) -> Column:
    """R5 for the tags of one scope, in order: each tag that is still there gives way to the first present synonym,
    else to the first present similar tag. ``nodes``: (tag, syn, sim); returns what each has become."""
    def step(now: Column, node: Column) -> Column:
        becomes = F.get(F.concat(F.array_intersect(now, node["syn"]), F.array_intersect(now, node["sim"])), F.lit(0))
        return F.transform(now, lambda t: F.when(t == node["tag"], F.coalesce(becomes, t)).otherwise(t))

    # a tag without a synonym or a similar tag changes nothing
    return F.aggregate(F.filter(nodes, lambda n: (F.size(n["syn"]) > 0) | (F.size(n["sim"]) > 0)), F.transform(nodes, lambda n: n["tag"]), step)


def canonical_tags(tags: DataFrame, synonyms: DataFrame | None = None,
                   threshold: float = S.TAG_SIMILARITY_THRESHOLD) -> DataFrame:
    """Map every (scope_id, case_ord, tag_ord, tag) row to its canonical tag.

    A scope is one listing page (50 cases at most), so the array of its distinct
    tags, with the synonyms and similar tags that the same page has, is bounded.
    The merge goes over that array in order of first occurrence.
    """
    rows = stage_table(tags.where(F.col("tag").isNotNull()), "tag-rows")
    return mapped_tags(rows, stage_table(tag_mapping(rows, synonyms, threshold), "tag-mapping"))


def mapped_tags(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Tag rows with their ``canonical`` tag. Only tags that have become another are looked up, mostly few."""
    changed = mapping.where(F.col("tag") != F.col("canonical"))
    found = rows.join(changed, null_safe(rows, changed, "scope_id") & (rows["tag"] == changed["tag"]), "left")
    return found.select(rows["*"], F.coalesce(changed["canonical"], rows["tag"]).alias("canonical"))


def null_safe(a: DataFrame, b: DataFrame, column: str) -> Column:
    return a[column].eqNullSafe(b[column])


def tag_mapping(rows: DataFrame, synonyms: DataFrame | None = None, threshold: float = S.TAG_SIMILARITY_THRESHOLD) -> DataFrame:
    """(scope_id, tag, canonical): what each tag of a scope becomes, given its rows (scope_id, case_ord, tag_ord, tag)."""
    spark = rows.sparkSession
    if synonyms is None:
        synonyms = spark.createDataFrame([], SYNONYMS_SCHEMA)
    first = rows.groupBy("scope_id", "tag").agg(F.min(F.struct("case_ord", "tag_ord")).alias("at"))
    first = stage_table(first, "scope-tags")
    syn = synonym_edges(first, synonyms).select("scope_id", "tag", F.col("target").alias("other"), F.lit(True).alias("is_syn"))
    sim = _similar_pairs(first.select("scope_id", "tag"), threshold).select("scope_id", "tag", F.col("similar_tag").alias("other"), F.lit(False).alias("is_syn"))
    edges = syn.unionByName(sim).groupBy("scope_id", "tag").agg(
        F.collect_set(F.when(F.col("is_syn"), F.col("other"))).alias("syn"), F.collect_set(F.when(~F.col("is_syn"), F.col("other"))).alias("sim"))
    none = F.array().cast("array<string>")
    nodes = first.join(edges, ["scope_id", "tag"], "left").select(
        "scope_id", F.struct("at", "tag", F.coalesce("syn", none).alias("syn"), F.coalesce("sim", none).alias("sim")).alias("node"))
    pages = nodes.groupBy("scope_id").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    mapping = pages.select("scope_id", F.explode(F.arrays_zip(
        F.transform("nodes", lambda n: n["tag"]).alias("tag"), _merged(F.col("nodes")).alias("canonical"))).alias("m"))
    return mapping.select("scope_id", "m.tag", "m.canonical")


def replace_in_array(arr: Column, old: Column | str, new: Column | str) -> Column:
    """Replace every element equal to ``old`` by ``new``."""
    old_c = F.lit(old) if isinstance(old, str) else old
    new_c = F.lit(new) if isinstance(new, str) else new
    return F.transform(arr, lambda x: F.when(x == old_c, new_c).otherwise(x))
