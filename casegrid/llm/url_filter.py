"""URL rules by hashed host-suffix and path-prefix expressions.

A rule is a host and a path; it fits its host and all subdomains where the path
of the URL starts with the rule's. The rules are looked up by equality: every
URL is expanded into host suffixes (cut at dots, of as many labels as rules' hosts have) times
path prefixes (of the lengths that rules have), each expression is hashed, and a short prefix of the
hash is joined with the rules'. Candidates are confirmed by the full digest.

What a verdict depends on is the host and as many first characters of the path
as the longest rule has; the expressions are made once for each such pair, so a
host with very many pages is expanded once for each start of a path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm.common import ascii_lower, staged

#: Hexadecimal digits of the digest that are joined on.
SHORT = 8


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, action) rows from a list; the action is allow or block."""
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("action")) for h, p, a in rules])
    return spark.range(1).select(F.inline(rows))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host in lower case and the path; both empty for null or without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring_index(url, "://", 1)).otherwise(F.lit(None))
    after = F.coalesce(F.substring(url, F.length(rest) + 4, F.length(url)), F.lit(""))
    return (ascii_lower(F.regexp_extract(after, r"^([^/?#]*)", 1)),
            F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1))


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Every host suffix of one of the label counts with every path prefix of one of the lengths."""
    suffixes = F.array(*[F.substring_index(host, ".", -n) for n in labels])  # of a host with fewer labels, all of it
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull())
    return F.flatten(F.transform(F.array_distinct(suffixes), lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Columns ``row`` (the page), ``host``, ``path``, ``rule`` (host and path joined, or null) and ``verdict``.

    The longest rule that fits wins; of equally long ones that with the longer host,
    and of equal rules block. Rules with a null part are left out. URLs that are null
    or have no ``://`` have an empty host and path, which no rule with a host fits.
    Without a rule that fits, the verdict is ``default``. Works on an empty table of
    pages or rules.
    """
    digest = F.sha2(F.col("expression"), 256)
    known = (rules.where("host IS NOT NULL AND path IS NOT NULL AND action IS NOT NULL")
             .select(F.concat("host", "path").alias("expression"), F.length("host").alias("host_length"), "path", "action")
             .withColumn("digest", digest).withColumn("short", F.substring("digest", 1, SHORT)))
    # path lengths and label counts of rules: a few, and never more than the length of a URL
    shapes = rules.where("host IS NOT NULL AND path IS NOT NULL AND action IS NOT NULL").select(
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length")).distinct().collect()
    labels, lengths = sorted({r["labels"] for r in shapes}), sorted({r["length"] for r in shapes})
    host, path = host_and_path(F.col(f"row.`{url_col}`"))
    placed = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row")).select(
        "row", host.alias("host"), path.alias("path")).withColumn("start", F.substring("path", 1, max([0, *lengths])))
    if not lengths:
        return placed.select("row", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    starts = placed.select("host", "start").distinct()
    asked = (starts.select("host", "start", F.explode(F.array_distinct(expressions(F.col("host"), F.col("start"), labels, lengths))).alias("expression"))
             .withColumn("digest", digest).withColumn("short", F.substring("digest", 1, SHORT)))
    rule = known.select("short", F.col("digest").alias("full"), "host_length", "action", F.col("expression").alias("rule"))
    fits = asked.join(rule, "short").where(F.col("digest") == F.col("full"))
    order = F.struct(F.length("rule"), "host_length", F.col("action") == "block")
    # written, so that the join below has an exchange of its own and AQE can split a host with very many pages
    best = staged(fits.groupBy("host", "start").agg(F.max_by(F.struct("rule", "action"), order).alias("best")), "verdicts")
    return placed.join(best, ["host", "start"], "left").select(
        "row", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
