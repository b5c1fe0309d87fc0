"""DuckDB SQL pieces for the oracles, written over the driver tables and not over the star views."""

from __future__ import annotations

COURT = "'Court of ' || translate(CAST(c_nationkey AS VARCHAR), '0123456789', 'ABCDEFGHIJ')"

CASES = f"""cases AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, c_custkey, c_name, c_nationkey, c_mktsegment, o_orderstatus, o_orderpriority,
         'Case ' || c_name AS title, {COURT} AS court, substring(o_orderpriority, 3) AS outcome,
         CASE WHEN o_orderkey % 211 <> 7 THEN CAST(o_orderdate AS DATE) END AS day,
         CASE WHEN o_orderkey % 211 <> 7 THEN strftime(o_orderdate, '%-d %b %Y') || ', midnight' ELSE '' END AS day_text
  FROM orders JOIN customer ON c_custkey = o_custkey)"""

# What each case has, one row for each value.
FACTS = {
    "verdict": "SELECT k, outcome AS v FROM cases",
    "court": "SELECT k, court AS v FROM cases",
    "judge": "SELECT DISTINCT l_orderkey AS k, s_name AS v FROM lineitem JOIN supplier ON s_suppkey = l_suppkey",
    "tag": "SELECT DISTINCT l_orderkey AS k, p_name AS v FROM lineitem JOIN part ON p_partkey = l_partkey",
}
NAMES = {"verdict": "verdict", "court": "court_name", "judge": "judge_name", "tag": "tag_name"}

# The lawyer of a part is the first part of its type and brand; every nineteenth works for no firm.
PARTIES = """parties AS (
  SELECT x.k, who, defendant, c_name AS participant, p_type AS lawyer, CASE WHEN p_partkey % 19 <> 0 THEN p_brand END AS firm
  FROM (SELECT l_orderkey AS k, (l_orderkey * 7 + l_suppkey) % (SELECT count(*) FROM customer) AS who,
               min(l_returnflag) = 'R' AS defendant, min(first) AS advocate
        FROM lineitem JOIN (SELECT p_partkey AS pk, min(p_partkey) OVER (PARTITION BY p_type, p_brand) AS first FROM part) ON pk = l_partkey
        GROUP BY ALL) x
  LEFT JOIN customer ON c_custkey = who
  LEFT JOIN part ON p_partkey = advocate AND x.k % 23 <> 5)"""


def over(body: str, *ctes: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' * recursive}" + ",\n".join([CASES, *ctes]) + "\n" + body


def facts(**relations: str) -> list[str]:
    """CTEs: name -> the facts of that kind."""
    return [f"{name} AS ({FACTS[kind]})" for name, kind in relations.items()]


def title_case(x: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(lower(" + x + "), '(\\p{L}+|[^\\p{L}]+)', 1), "
            "lambda r: upper(r[1]) || r[2:]), '')")


def capitalised(x: str) -> str:
    return f"(upper({x}[1]) || lower({x}[2:]))"


def folded(tags: str, similar: float = 0.9, synonym: str = "NULL") -> list[str]:
    """CTEs up to ``canonical(page, tag, canonical)``: the tags of each page merged in order.

    ``tags``: SQL with (page, tag, spot), ``spot`` a value to order by. ``synonym``: the
    target of a tag ``w``, or NULL. The list of a page is gone through once; a tag
    that is still in it is replaced by the first one present that is its synonym, or
    else similar.
    """
    return [
        f"first_seen AS (SELECT page, tag, min(spot) AS spot FROM ({tags}) GROUP BY ALL)",
        "page_lists AS (SELECT page, list(tag ORDER BY spot, tag) AS words FROM first_seen GROUP BY page)",
        f"""fold AS (
  SELECT page, 1 AS i, words, words AS now FROM page_lists
  UNION ALL
  SELECT page, i + 1, words, list_transform(now, lambda t: CASE WHEN t = w THEN coalesce(target, t) ELSE t END)
  FROM (SELECT *, coalesce(CASE WHEN list_contains(now, syn) THEN syn END,
                           list_filter(now, lambda t: t <> w AND jaro_winkler_similarity(t, w) > {similar})[1]) AS target
        FROM (SELECT *, {synonym} AS syn FROM (SELECT *, words[i] AS w FROM fold WHERE i <= len(words)))))""",
        """canonical AS (SELECT page, unnest(words) AS tag, unnest(now) AS canonical FROM fold WHERE i = len(words) + 1)""",
    ]


def reply_rows(fault_names: dict[int, str]) -> str:
    """CTE ``replies``: the cases with what their reply says and why it is rejected."""
    faults = " ".join(f"WHEN {k} THEN '{v}'" for k, v in fault_names.items())
    return f"""replies AS (
  SELECT *, CASE k % 40 {faults} END AS broken,
         CASE WHEN k % 40 = 22 THEN 'bad_date' ELSE CASE k % 40 {faults} END END AS reason,
         CASE WHEN k % 40 = 21 THEN NULL ELSE title END AS said_title,
         CASE WHEN k % 40 = 20 THEN 'Privy Council' ELSE court END AS said_court,
         CASE WHEN k % 40 = 21 THEN DATE '2003-03-03' WHEN k % 40 = 22 THEN NULL ELSE day END AS said_day,
         ['Guilty', 'Dismissed', 'Claimant Wins', 'Other', 'Appeal Allowed'][CAST(o_orderpriority[1] AS INT)] AS said_verdict,
         'Order ' || id || ' for ' || c_name AS said_summary
  FROM cases)"""
