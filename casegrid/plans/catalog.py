"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables. The oracles are written over the driver tables themselves, not
over the star views, so a fault in a view shows; every computed column is
aliased identically on both sides.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid import schemas as S
from casegrid.functions import text as TX
from casegrid.operators import constraints as CN
from casegrid.operators import maintain as MT
from casegrid.operators import reply as RP
from casegrid.operators import resolve as RS
from casegrid.operators import upsert as UP
from casegrid.operators.judge_index import JudgeIndex
from casegrid.plans import enrich as EN
from casegrid.plans import insights as I
from casegrid.plans import oracles as O
from casegrid.plans import search as SR
from casegrid.session import shared_dir, stage_table
from casegrid.sources import fixtures as FX
from casegrid.sources import html as HT
from casegrid.sources.tables import read_table, star
from casegrid.streaming import incremental as INC

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    build: Builder
    oracle: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Entry(fn, oracle)
        return fn
    return deco


# ---------------------------------------------------------------------------
# A1–A8 / Q15–Q22 pair counts, Q28–Q30 distributions
# ---------------------------------------------------------------------------

PAIRS = {
    "verdict_by_judge": ("verdict", "judge"),
    "tag_by_judge": ("tag", "judge"),
    "court_by_judge": ("court", "judge"),
    "verdict_by_court": ("verdict", "court"),
    "tag_by_court": ("tag", "court"),
    "judge_by_court": ("judge", "court"),
    "verdict_by_tag": ("verdict", "tag"),
    "judge_by_tag": ("judge", "tag"),
}


def _counted(field: str, other: str, rest: str = "", distinct: bool = False, more: str = "") -> str:
    """Cases for each value of ``field``, by way of ``other``."""
    number = "count(DISTINCT cases.k)" if distinct else "count(*)"
    return O.over(f"""SELECT CAST({number} AS BIGINT) AS count, a.v AS {O.NAMES[field]}{more}
FROM cases JOIN a USING (k) JOIN b USING (k) {rest}""", *O.facts(a=field, b=other))


def _top(field: str, where: str = "") -> str:
    return f"{where} GROUP BY a.v ORDER BY count DESC, {O.NAMES[field]} LIMIT 12"


def _top_of_each(field: str, other: str) -> str:
    return _counted(field, other, f"""GROUP BY a.v, b.v
QUALIFY row_number() OVER (PARTITION BY b.v ORDER BY count(*) DESC, a.v) <= 12""", more=f", b.v AS {O.NAMES[other]}")


for _name, (_a, _b) in PAIRS.items():
    register(_name, _counted(_a, _b, "GROUP BY a.v, b.v", more=f", b.v AS {O.NAMES[_b]}"))(
        lambda spark, sf, a=_a, b=_b: I.pair_counts(star(spark, sf), a, b))

for _field in ("verdict", "court", "tag"):
    register(f"overall_{_field}_top12", _counted(_field, "judge", _top(_field)))(
        lambda spark, sf, f=_field: I.overall_distribution(star(spark, sf), f, "judge"))

for _tab, _fields in (("judge", ("verdict", "tag", "court")), ("court", ("verdict", "tag", "judge"))):
    for _field in _fields:
        register(f"{_tab}_{_field}_top12", _top_of_each(_field, _tab))(
            lambda spark, sf, f=_field, t=_tab: I.filtered_distribution(star(spark, sf), f, t))

# Tag selection of the registered query (a dashboard multiselect value).
SELECTED_TAGS = ["red plate", "hot ring", "blue gear", "small widget"]
_SELECTED = "WHERE b.v IN (" + ", ".join(f"'{t}'" for t in SELECTED_TAGS) + ")"

for _field in ("verdict", "judge"):
    register(f"tagset_{_field}_top12", _counted(_field, "tag", _top(_field, _SELECTED)))(
        lambda spark, sf, f=_field: I.tagset_distribution(star(spark, sf), f, SELECTED_TAGS))

# The same pies with every case counted once for each value.
register("overall_verdict_top12_cases", _counted("verdict", "judge", _top("verdict"), distinct=True))(
    lambda spark, sf: I.overall_distribution(star(spark, sf), "verdict", "judge", distinct_cases=True))
register("tagset_judge_top12_cases", _counted("judge", "tag", _top("judge", _SELECTED), distinct=True))(
    lambda spark, sf: I.tagset_distribution(star(spark, sf), "judge", SELECTED_TAGS, distinct_cases=True))

# ---------------------------------------------------------------------------
# Q23 cases per month, Q24–Q27 cumulative series, Q9 lists
# ---------------------------------------------------------------------------

register("cases_per_month", O.over("""
SELECT CAST(month(day) AS INT) AS month_num, strftime(day, '%b') AS month, CAST(count(*) AS BIGINT) AS case_count
FROM cases GROUP BY ALL"""))(lambda spark, sf: I.cases_per_month(star(spark, sf)))

for _entity in ("court", "judge", "tag"):
    register(f"cumulative_by_{_entity}", O.over(f"""
SELECT day AS court_date, v AS {O.NAMES[_entity]}, CAST(count(*) AS BIGINT) AS case_count,
       CAST(sum(count(*)) OVER (PARTITION BY v ORDER BY day NULLS LAST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS overall_sum
FROM cases JOIN a USING (k) GROUP BY day, v""", *O.facts(a=_entity)))(
        lambda spark, sf, e=_entity: I.cumulative_cases(star(spark, sf), e))

register("cumulative_by_selected_courts", O.over("""
SELECT day AS court_date, court AS court_name, CAST(count(*) AS BIGINT) AS case_count,
       CAST(sum(count(*)) OVER (PARTITION BY court ORDER BY day NULLS LAST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS overall_sum
FROM cases WHERE c_nationkey IN (1, 12) GROUP BY day, court"""))(
    lambda spark, sf: I.cumulative_cases(star(spark, sf), "court", ["Court of B", "Court of BC"]))

register("list_judges", "SELECT s_name AS judge_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)")(
    lambda spark, sf: I.list_judges(star(spark, sf)))
register("list_courts", O.over("SELECT DISTINCT court AS court_name FROM cases"))(
    lambda spark, sf: I.list_courts(star(spark, sf)))
register("list_tags", "SELECT DISTINCT p_name AS tag_name FROM part")(
    lambda spark, sf: I.list_tags(star(spark, sf)))
register("list_titles", O.over("SELECT DISTINCT title FROM cases ORDER BY title"))(
    lambda spark, sf: I.list_titles(star(spark, sf)))

# ---------------------------------------------------------------------------
# Q10–Q14 case view by title
# ---------------------------------------------------------------------------

_HEADERS = """headers AS (
  SELECT DISTINCT ON (title) title, id, 'Status ' || o_orderstatus || ' priority ' || o_orderpriority AS summary, outcome, day,
         'https://judgments.example/case/' || id AS url, court
  FROM cases ORDER BY title, day NULLS LAST, id)"""

register("case_header", O.over("""
SELECT title, id AS court_case_id, summary, outcome AS verdict, day AS court_date, url AS case_url, court AS court_name,
       outcome AS verdict_summary FROM headers""", _HEADERS))(lambda spark, sf: I.case_header(star(spark, sf)))
register("case_judges", O.over("SELECT title, v AS judge_name FROM cases JOIN a USING (k)", *O.facts(a="judge")))(
    lambda spark, sf: I.case_judges(star(spark, sf)))
register("case_tags", O.over("SELECT title, v AS tag_name FROM cases JOIN a USING (k)", *O.facts(a="tag")))(
    lambda spark, sf: I.case_tags(star(spark, sf)))


def _parties_sql(where: str = "") -> str:
    return O.over(f"""
SELECT participant AS participant_name, lawyer AS lawyer_name, firm AS law_firm_name, title, defendant AS is_defendant,
       {O.title_case("participant")} AS participant_display, {O.title_case("lawyer")} AS lawyer_display, firm AS law_firm_display
FROM parties JOIN cases USING (k) WHERE participant IS NOT NULL AND lawyer IS NOT NULL AND firm IS NOT NULL {where}""", O.PARTIES)


register("case_parties", _parties_sql())(lambda spark, sf: I.case_parties(star(spark, sf)))

_VIEW = """
SELECT h.title, h.id AS court_case_id, url AS case_url, outcome AS verdict, strftime(day, '%d-%m-%Y') AS date, court AS court_name,
       coalesce((SELECT string_agg(DISTINCT j.v, ', ' ORDER BY j.v) FROM cases c JOIN j USING (k) WHERE c.title = h.title), '') AS judges,
       coalesce((SELECT string_agg(DISTINCT lower(t.v), ', ' ORDER BY lower(t.v)) FROM cases c JOIN t USING (k) WHERE c.title = h.title), '') AS tags,
       outcome AS verdict_summary, summary
FROM headers h"""
register("case_view", O.over(_VIEW, _HEADERS, *O.facts(j="judge", t="tag")))(lambda spark, sf: I.case_view(star(spark, sf)))

# One title, one side
_TITLE = "Case Customer#000000007"
register("case_header_by_title", O.over(f"""
SELECT title, id AS court_case_id, summary, outcome AS verdict, day AS court_date, url AS case_url, court AS court_name,
       outcome AS verdict_summary FROM headers WHERE title = '{_TITLE}'""", _HEADERS))(
    lambda spark, sf: I.case_header(star(spark, sf), _TITLE))
for _side, _flag in (("defendants", True), ("claimants", False)):
    register(f"case_{_side}_by_title", _parties_sql(f"AND title = '{_TITLE}' AND defendant = {_flag}"))(
        lambda spark, sf, flag=_flag: I.case_parties(star(spark, sf), _TITLE, is_defendant=flag))
register("case_view_by_title", O.over(f"{_VIEW} WHERE title = '{_TITLE}'", _HEADERS, *O.facts(j="judge", t="tag")))(
    lambda spark, sf: I.case_view(star(spark, sf), _TITLE))

# ---------------------------------------------------------------------------
# Q1–Q8 search endpoints (parameter sets of the registered queries)
# ---------------------------------------------------------------------------

_COURTS = f"courts AS (SELECT CAST(c_nationkey AS INT) AS court_id, {O.COURT} AS court_name FROM (SELECT n_nationkey AS c_nationkey FROM nation))"
_LAWYERS = """lawyers AS (
  SELECT min(p_partkey) AS no, p_type AS lawyer_name, CASE WHEN min(p_partkey) % 19 <> 0 THEN p_brand END AS law_firm_name FROM part GROUP BY p_type, p_brand)"""

register("search_courts", f"WITH {_COURTS} SELECT * FROM courts WHERE court_name ILIKE '%of_b%' ORDER BY ALL LIMIT 100")(
    lambda spark, sf: SR.courts(star(spark, sf), search="of_B"))
register("search_judges",
         "SELECT s_name AS judge_name FROM supplier WHERE s_name ILIKE '%000001%' ORDER BY s_name LIMIT 100")(
    lambda spark, sf: SR.judges(star(spark, sf), search="000001"))
register("search_lawyers", f"WITH {_LAWYERS} SELECT lawyer_name, law_firm_name FROM lawyers WHERE lawyer_name ILIKE '%promo%'")(
    lambda spark, sf: SR.lawyers(star(spark, sf), lawyer="promo", limit=-1, nested=False))
register("search_lawyers_by_firm", f"""WITH {_LAWYERS}
SELECT lawyer_name, law_firm_name FROM lawyers WHERE law_firm_name ILIKE '%#1%' ORDER BY lawyer_name, no LIMIT 100""")(
    lambda spark, sf: SR.lawyers(star(spark, sf), law_firm="#1", nested=False))
register("search_law_firms", "SELECT DISTINCT p_brand AS law_firm_name FROM part WHERE p_brand ILIKE '%brand#2%'")(
    lambda spark, sf: SR.law_firms(star(spark, sf), search="brand#2", limit=-1))
register("search_tags", "SELECT DISTINCT p_name AS tag_name FROM part ORDER BY p_name LIMIT 100")(
    lambda spark, sf: SR.tags(star(spark, sf), search=""))
register("search_verdicts", "SELECT DISTINCT substring(o_orderpriority, 3) AS verdict FROM orders")(
    lambda spark, sf: SR.verdicts(star(spark, sf)))
_PARTY_COLUMNS = "CAST(k AS VARCHAR) AS court_case_id, defendant AS is_defendant, participant AS participant_name, lawyer AS lawyer_name, firm AS law_firm_name"
register("search_participants", f"""WITH {O.PARTIES}
SELECT {_PARTY_COLUMNS} FROM parties WHERE participant ILIKE '%customer#00000001%' AND lawyer ILIKE '%a%'
ORDER BY CAST(k AS VARCHAR), who LIMIT 100""")(
    lambda spark, sf: SR.participants(star(spark, sf), participant="customer#00000001", lawyer="a"))
# parties without a lawyer or firm stay
register("search_participants_outer", f"WITH {O.PARTIES} SELECT {_PARTY_COLUMNS} FROM parties WHERE participant ILIKE '%#0000000%'")(
    lambda spark, sf: SR.participants(star(spark, sf), participant="#0000000", limit=-1))

_CHILDREN = [*O.facts(j="judge", t="tag"), O.PARTIES]


def _documents(found: str, columns: str) -> str:
    return O.over(f"""SELECT id AS court_case_id, 'Status ' || o_orderstatus || ' priority ' || o_orderpriority AS summary, title, day AS court_date,
       'No. ' || id AS case_number, 'https://judgments.example/case/' || id AS case_url, outcome AS verdict_summary, {columns}
FROM found""", *_CHILDREN, f"found AS ({found})")


def _flat_documents(found: str) -> str:
    return _documents(found, """court AS court_name, outcome AS verdict,
       coalesce((SELECT string_agg(v, '; ' ORDER BY v) FROM t WHERE t.k = found.k), '') AS tags,
       coalesce((SELECT string_agg(v, '; ' ORDER BY v) FROM j WHERE j.k = found.k), '') AS judges,
       coalesce((SELECT string_agg(CAST(defendant AS VARCHAR) || ':' || coalesce(participant, '') || ':' || coalesce(lawyer, '') || ':' || coalesce(firm, ''), '; '
                        ORDER BY defendant, participant NULLS FIRST, lawyer NULLS FIRST, firm NULLS FIRST)
                 FROM parties p WHERE p.k = found.k), '') AS parties""")


_TAG_JUDGE_DATES = """SELECT * FROM cases WHERE day BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'
  AND k IN (SELECT k FROM t WHERE v ILIKE '%red%') AND k IN (SELECT k FROM j WHERE v ILIKE '%00000002%') ORDER BY id LIMIT 100"""
_PARTY_CASES = """SELECT * FROM cases WHERE k IN (SELECT k FROM parties
  WHERE lower(participant) = 'customer#000000042' AND lawyer ILIKE '%promo%' AND firm ILIKE '%brand#1%')"""
_VERDICT_COURT_TITLE = """SELECT * FROM cases WHERE title ILIKE '%00000012%' AND outcome ILIKE '%urgent%' AND court ILIKE '%court%' ORDER BY id LIMIT 50"""

register("search_cases_tag_judge_dates", _flat_documents(_TAG_JUDGE_DATES))(
    lambda spark, sf: SR.court_cases(star(spark, sf), nested=False, tag="red", judge="00000002",
                                     start_date="1996-01-01", end_date="1997-12-31"))
register("search_cases_parties", _flat_documents(_PARTY_CASES))(
    lambda spark, sf: SR.court_cases(star(spark, sf), nested=False, limit=-1, participant="CUSTOMER#000000042",
                                     lawyer="promo", law_firm="brand#1"))
register("search_cases_verdict_court_title", _flat_documents(_VERDICT_COURT_TITLE))(
    lambda spark, sf: SR.court_cases(star(spark, sf), nested=False, limit=50, title="00000012",
                                     citation="no. ", verdict="urgent", court="COURT", tag=""))


def _limits(spark, sf):
    """The cases that limits of 0, 3, 100 and -1 leave of one search."""
    found = SR.court_case_ids(star(spark, sf), verdict="urgent", court="COURT")
    parts = [SR.apply_limit(found, n, ["court_case_id"]).select(F.lit(n).alias("asked"), "court_case_id") for n in (0, 3, 100, -1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


register("search_cases_limit_0", O.over("""
SELECT n AS asked, id AS court_case_id FROM (SELECT *, row_number() OVER (ORDER BY id) AS place FROM cases WHERE outcome ILIKE '%urgent%'), (VALUES (0), (3), (100), (-1)) AS x(n)
WHERE place <= n OR n = -1"""))(_limits)

# The same searches by way of a trigram index.


def _indexed(fields: list[str], search: Callable[..., DataFrame]) -> Builder:
    def build(spark, sf):
        st = star(spark, sf)
        return search(st, SR.build_index(st, shared_dir(spark, f"casegrid-runs/{uuid.uuid4().hex}/grams"), fields))
    return build


for _name, _fields, _search in (
        ("search_courts", ["court_name"], lambda st, ix: SR.courts(st, search="of_B", index=ix)),
        ("search_judges", ["judge_name"], lambda st, ix: SR.judges(st, search="000001", index=ix)),
        ("search_lawyers_by_firm", ["law_firm_name"], lambda st, ix: SR.lawyers(st, law_firm="#1", nested=False, index=ix)),
        ("search_participants", ["participant_name", "lawyer_name"], lambda st, ix: SR.participants(st, participant="customer#00000001", lawyer="a", index=ix)),
        ("search_cases_tag_judge_dates", ["tag_name", "judge_name"], lambda st, ix: SR.court_cases(
            st, nested=False, tag="red", judge="00000002", start_date="1996-01-01", end_date="1997-12-31", index=ix)),
        ("search_cases_parties", ["lawyer_name", "law_firm_name"], lambda st, ix: SR.court_cases(
            st, nested=False, limit=-1, participant="CUSTOMER#000000042", lawyer="promo", law_firm="brand#1", index=ix)),
        ("search_cases_verdict_court_title", ["title", "case_number", "verdict", "court_name"], lambda st, ix: SR.court_cases(
            st, nested=False, limit=50, title="00000012", citation="no. ", verdict="urgent", court="COURT", tag="", index=ix))):
    register(f"{_name}_indexed", REGISTRY[_name].oracle)(_indexed(_fields, _search))


def _nested(spark, sf):
    """The document as the service gives it, its parts as JSON texts."""
    docs = SR.court_cases(star(spark, sf), tag="red", judge="00000002", start_date="1996-01-01", end_date="1997-12-31")
    parts = ["court", "verdict", "tags", "judges", "participant_assignments"]
    return docs.select(*[F.to_json(c, {"ignoreNullFields": "false"}).alias(c) if c in parts else F.col(c) for c in docs.columns])


register("search_cases_nested", _documents(_TAG_JUDGE_DATES, """
       CAST(to_json({'court_name': court}) AS VARCHAR) AS court, CAST(to_json({'verdict': outcome}) AS VARCHAR) AS verdict,
       CAST(to_json(coalesce((SELECT list({'tag_name': v} ORDER BY v) FROM t WHERE t.k = found.k), [])) AS VARCHAR) AS tags,
       CAST(to_json(coalesce((SELECT list({'judge_name': v} ORDER BY v) FROM j WHERE j.k = found.k), [])) AS VARCHAR) AS judges,
       CAST(to_json(coalesce((SELECT list({'is_defendant': defendant, 'participant_name': participant, 'lawyer_name': lawyer, 'law_firm_name': firm}
              ORDER BY defendant, participant NULLS FIRST, lawyer NULLS FIRST, firm NULLS FIRST) FROM parties p WHERE p.k = found.k), [])) AS VARCHAR)
         AS participant_assignments"""))(_nested)


# ---------------------------------------------------------------------------
# Text functions: judge-name rules, truncation + requests, dates, cost
# ---------------------------------------------------------------------------

# Planted title prefixes for the judge-name query (built from supplier rows).
_TITLE_PREFIXES = ["Judge", "His Honour Judge", "The Hon. Mr Justice",
                   "Deputy District Judge (MC)", "  lord  JUSTICE  of  appeal"]
_STOP_SQL = "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in S.JUDGE_STOP_TOKENS) + "]"


def _raw_judges(spark, sf):
    sup = read_table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    prefixes = F.array(*[F.lit(p) for p in _TITLE_PREFIXES])
    raw = F.concat(F.element_at(prefixes, (F.col("s_nationkey") % len(_TITLE_PREFIXES) + 1).cast("int")),
                   F.lit(" "), F.col("s_name"), F.lit(" CBE"))
    return sup.select(F.col("s_suppkey").cast("int").alias("judge_id"), raw.alias("raw"))


def _judge_names(spark, sf):
    raw = _raw_judges(spark, sf)
    return raw.select("judge_id", "raw", TX.capwords("raw").alias("capworded"),
                      TX.strip_judge_titles("raw").alias("stripped"),
                      TX.strip_judge_titles(TX.capwords("raw")).alias("standardised"))


_CAPWORDS_SQL = "array_to_string(list_transform(string_split_regex(trim({c}), '\\s+'), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
_STRIP_SQL = ("array_to_string(list_filter(string_split({c}, ' '), lambda t: NOT list_contains(" + _STOP_SQL +
              ", t) AND regexp_matches(t, '^\\p{{L}}')), ' ')")
_PREFIX_SQL = "[" + ", ".join("'" + p + "'" for p in _TITLE_PREFIXES) + "]"

register("judge_names_standardise", f"""
WITH r AS (SELECT CAST(s_suppkey AS INT) AS judge_id,
                  {_PREFIX_SQL}[CAST(s_nationkey % {len(_TITLE_PREFIXES)} + 1 AS INT)] || ' ' || s_name || ' CBE' AS raw
           FROM supplier)
SELECT judge_id, raw, {_CAPWORDS_SQL.format(c='raw')} AS capworded,
       {_STRIP_SQL.format(c='raw')} AS stripped,
       {_STRIP_SQL.format(c=_CAPWORDS_SQL.format(c='raw'))} AS standardised
FROM r""")(_judge_names)


def _requests(head, tail):
    def build(spark, sf):
        docs = read_table(spark, sf, "documents").select("doc_id", "text")
        return EN.build_requests(docs, head=head, tail=tail)
    return build


def _requests_sql(head, tail):
    system = EN.SYSTEM_INSTRUCTIONS.replace("'", "''")
    return f"""
WITH d AS (SELECT doc_id, text, regexp_extract_all(text, '(\\s*\\S+|\\s+$)', 1) AS toks FROM documents)
SELECT doc_id, '{system}' AS system,
       'Court transcript:' || chr(10) || CASE WHEN len(toks) <= {head + tail} THEN text
            ELSE array_to_string(toks[1:{head}], '') || '{S.TRUNCATE_PLACEHOLDER}'
                 || array_to_string(toks[len(toks) - {tail} + 1:], '') END AS "user",
       CAST(len(toks) AS INT) AS n_tokens, len(toks) > {head + tail} AS truncated
FROM d"""


register("build_requests", _requests_sql(S.TRUNCATE_HEAD_TOKENS, S.TRUNCATE_TAIL_TOKENS))(
    _requests(S.TRUNCATE_HEAD_TOKENS, S.TRUNCATE_TAIL_TOKENS))
#: A public vocabulary of the model's kind; any file of ranks will do.
RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# SQL has no byte-pair codec: tests compare this query with merges made one by one.
register("build_requests_subword", None)(lambda spark, sf: EN.build_requests(
    read_table(spark, sf, "documents").select("doc_id", "text"), head=300, tail=200, ranks_path=RANKS_PATH))
register("build_requests_small_budget", _requests_sql(100, 50))(_requests(100, 50))


def _dates(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    raw = F.concat(F.date_format("o_orderdate", "d MMM yyyy"),
                   F.when(F.col("o_orderkey") % 2 == 0, F.lit(", midnight")).otherwise(F.lit("")))
    parsed = o.select(F.col("o_orderkey").cast("string").alias("court_case_id"), raw.alias("raw")) \
        .withColumn("court_date", TX.parse_listing_date("raw"))
    return parsed.select("court_case_id", "raw", "court_date",
                         TX.format_ddmmyyyy("court_date").alias("log_date"),
                         TX.parse_ddmmyyyy(TX.format_ddmmyyyy("court_date")).alias("log_date_parsed"))


register("parse_dates", """
WITH r AS (SELECT CAST(o_orderkey AS VARCHAR) AS court_case_id,
                  strftime(o_orderdate, '%-d %b %Y') || CASE WHEN o_orderkey % 2 = 0 THEN ', midnight' ELSE '' END AS raw
           FROM orders),
p AS (SELECT *, CAST(try_strptime(trim(replace(raw, ', midnight', '')), '%d %b %Y') AS DATE) AS court_date FROM r)
SELECT court_case_id, raw, court_date, strftime(court_date, '%d-%m-%Y') AS log_date,
       CAST(try_strptime(strftime(court_date, '%d-%m-%Y'), '%d-%m-%Y') AS DATE) AS log_date_parsed
FROM p""")(_dates)

_USAGE_SQL = """
WITH per AS (SELECT conv_id,
                    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS c,
                    sum(CASE WHEN role = 'assistant' THEN 0 ELSE length(text) END) AS p
             FROM conversations GROUP BY conv_id),
t AS (SELECT CAST(sum(c) AS BIGINT) AS completion_tokens, CAST(sum(p) AS BIGINT) AS prompt_tokens FROM per)
SELECT completion_tokens, prompt_tokens,
       printf('$%.2f', completion_tokens / 1e6 * 0.60) AS output_cost,
       printf('$%.2f', prompt_tokens / 1e6 * 0.15) AS input_cost,
       printf('$%.2f', completion_tokens / 1e6 * 0.60 + prompt_tokens / 1e6 * 0.15) AS total_cost
FROM t"""


def _usage_lines(spark, sf):
    return EN.usage_lines_from_conversations(read_table(spark, sf, "conversations"))


def _usage_log(spark, sf):
    """The lines as a text log, written and read again."""
    path = shared_dir(spark, f"casegrid-runs/{uuid.uuid4().hex}/usage-log")
    _usage_lines(spark, sf).write.text(path)
    return EN.usage_cost(EN.read_usage_log(spark, path))


register("usage_cost", _USAGE_SQL)(lambda spark, sf: EN.usage_cost(_usage_lines(spark, sf)))
register("usage_cost_log", _USAGE_SQL)(_usage_log)


# ---------------------------------------------------------------------------
# HTML sources over the pages table
# ---------------------------------------------------------------------------

def _unescape_sql(x: str) -> str:
    out = x
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{ent}', '{ch}')"
    return out


def _text_sql(x: str) -> str:
    return _unescape_sql(f"regexp_replace({x}, '<[^>]*>', '', 'g')")


register("article_text", f"""
SELECT page_id, url,
       CASE WHEN html LIKE '%<article%' THEN
            {_text_sql("regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1)")} END AS text_raw
FROM pages""")(lambda spark, sf: HT.article_text(read_table(spark, sf, "pages")))

register("page_extent", """
SELECT page_id, url, CASE WHEN html LIKE '%aria-label="Results pagination"%' THEN NULL ELSE 0 END AS max_page
FROM pages""")(lambda spark, sf: HT.page_extent(read_table(spark, sf, "pages")))

_CELLS_SQL = f"""
c AS (SELECT page_id, regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1) AS cells FROM pages),
cells AS (SELECT page_id, CAST(pos AS INT) AS pos, {_text_sql("cell")} AS text
          FROM (SELECT page_id, unnest(range(len(cells))) AS pos, unnest(cells) AS cell FROM c))"""

register("table_cells", f"WITH {_CELLS_SQL.strip()} SELECT page_id, pos, text FROM cells")(
    lambda spark, sf: HT.table_cells(read_table(spark, sf, "pages"), cell_tag="li",
                                     cell_container_class=None))


def _selector_sql(name):
    mod, rem, excluded, first_alpha, drop_last = HT.SELECTORS[name]
    cond = [f"pos % {mod} = {rem}", "length(text) > 0",
            "text NOT IN (" + ", ".join(f"'{e}'" for e in excluded) + ")"]
    if first_alpha:
        cond.append("regexp_matches(text, '^\\p{L}')")
    name_expr = ("CASE WHEN NOT regexp_matches(text, '\\p{L}$') THEN substring(text, 1, length(text) - 1) "
                 "ELSE text END") if drop_last else "text"
    return (f"SELECT page_id, pos, {name_expr} AS judge_name, '{name}' AS selector FROM cells "
            f"WHERE {' AND '.join(cond)}")


register("judges_from_cells",
         f"WITH {_CELLS_SQL.strip()} " + " UNION ALL ".join(_selector_sql(n) for n in HT.SELECTORS))(
    lambda spark, sf: HT.gather_judges(HT.table_cells(read_table(spark, sf, "pages"), cell_tag="li",
                                                      cell_container_class=None)))


def _seed_judges(spark, sf):
    """Names picked by all selectors, where those of the first are known already."""
    cells = HT.table_cells(read_table(spark, sf, "pages"), cell_tag="li", cell_container_class=None)
    known = UP.seed_judges(HT.select_cells(cells, "bench"), spark.createDataFrame([], UP.SCHEMAS["judge"]))
    return UP.seed_judges(HT.gather_judges(cells), known).select("judge_name")


register("seed_judges", f"WITH {_CELLS_SQL.strip()}, picked AS ({' UNION ALL '.join(_selector_sql(n) for n in HT.SELECTORS)}), "
         f"named AS (SELECT {_STRIP_SQL.format(c='judge_name')} AS judge_name, selector FROM picked) "
         "SELECT DISTINCT judge_name FROM named WHERE judge_name <> '' "
         "AND judge_name NOT IN (SELECT judge_name FROM named WHERE selector = 'bench')")(_seed_judges)

register("page_extent_listing", O.over("""
SELECT k AS page_id, 'https://judgments.example/case/' || id AS url,
       CAST(CASE k % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 * (k % 5 + 1) END AS INT) AS max_page FROM cases"""))(
    lambda spark, sf: HT.page_extent(FX.site_pages(star(spark, sf))))

register("listing_items", O.over(f"""
SELECT k AS page_id, CAST(pos AS INT) AS pos, title, '{HT.BASE_URL}/case/' || id AS url, CASE WHEN k % 9 <> 4 THEN court END AS court,
       id AS citation, CASE WHEN k % 7 <> 3 THEN day_text END AS date
FROM cases, unnest([0, 1]) AS two(pos)"""))(lambda spark, sf: HT.listing_items(FX.site_pages(star(spark, sf))))


def _checked_listing(spark, sf):
    rows = FX.listing_rows(star(spark, sf))
    n = F.col("citation").cast("long")
    rows = rows.withColumn("title", F.when(n % 13 != 1, F.col("title"))).withColumn(
        "court", F.when(n % 17 == 2, F.lit(" ")).otherwise(F.col("court")))
    return INC.validate_listing(rows).select("citation", "reason")


register("validate_listing", O.over("""
SELECT id AS citation, nullif('blank:' || array_to_string(list_filter([CASE WHEN k % 13 = 1 THEN 'title' END, CASE WHEN k % 17 = 2 THEN 'court' END,
       CASE WHEN day IS NULL THEN 'date' END], lambda x: x IS NOT NULL), ','), 'blank:') AS reason FROM cases"""))(_checked_listing)


# ---------------------------------------------------------------------------
# Reply parsing, validation, merge and party flattening, constraints
# ---------------------------------------------------------------------------

_REPLIES = O.reply_rows(FX.FAULTS)


def _assembled(spark, sf):
    st = star(spark, sf)
    return RP.assemble(FX.listing_rows(st), FX.synthetic_replies(st))


def _party_str(col):
    return F.array_join(F.transform(col, lambda p: F.concat_ws(
        "|", F.coalesce(p["participant"], F.lit("")), F.coalesce(p["lawyer"], F.lit("")),
        F.coalesce(p["law_firm"], F.lit("")))), "; ")


def _parse_replies(spark, sf):
    a = _assembled(spark, sf)
    return a.select("court_case_id", "reason", "verdict", "title", "court_name", "court_date",
                    "case_number", "summary",
                    F.array_join("judges", "; ").alias("judges"),
                    F.array_join("tags", "; ").alias("tags"),
                    _party_str(F.col("first_side")).alias("first_side"),
                    _party_str(F.col("second_side")).alias("second_side"))


register("parse_replies", O.over(f"""
SELECT id AS court_case_id, reason, said_title AS title, said_court AS court_name, said_day AS court_date,
       CASE WHEN broken IS NULL THEN said_verdict END AS verdict, CASE WHEN broken IS NULL THEN 'No. ' || id END AS case_number,
       CASE WHEN broken IS NULL THEN said_summary END AS summary, CASE WHEN broken IS NULL THEN 'Judge ' || c_name || '; The Hon. ' || c_name END AS judges,
       CASE WHEN broken IS NULL THEN {O.capitalised("c_mktsegment")} || '; Status ' || lower(o_orderstatus) END AS tags,
       CASE WHEN broken IS NULL THEN c_name || '|Counsel ' || c_custkey || '|Firm ' || c_nationkey END AS first_side,
       CASE WHEN broken IS NULL THEN '||' END AS second_side
FROM replies""", _REPLIES))(_parse_replies)

register("party_rows", O.over("""
SELECT id AS court_case_id, side, CAST(0 AS INT) AS ord, side = 2 AS is_defendant, CASE side WHEN 1 THEN c_name END AS participant_name,
       CASE side WHEN 1 THEN 'Counsel ' || c_custkey END AS lawyer_name, CASE side WHEN 1 THEN 'Firm ' || c_nationkey END AS law_firm_name
FROM replies, unnest([1, 2]) AS two(side) WHERE reason IS NULL""", _REPLIES))(
    lambda spark, sf: RP.party_rows(RP.split(_assembled(spark, sf))[0]))

register("quarantine", O.over(
    "SELECT id AS citation, reason, CAST(k // 50 AS VARCHAR) AS scope_id FROM replies WHERE reason IS NOT NULL", _REPLIES))(
    lambda spark, sf: RP.split(_assembled(spark, sf))[1].select("citation", "reason", "scope_id"))


def _constraint_quarantine(spark, sf):
    good, _ = RP.split(_assembled(spark, sf))
    n = F.col("court_case_id").cast("long") % 50
    longer = F.transform("tags", lambda t: F.repeat(t, 40))
    rows = good.withColumns({
        "title": F.when(n == 2, F.repeat("title", 30)).otherwise(F.col("title")),
        "tags": F.when(n == 4, longer).otherwise(F.col("tags")),
        "judges": F.when(n == 6, F.array(F.lit(None).cast("string"))).otherwise(F.col("judges")),
        "first_side": F.when(n == 8, F.transform("first_side", lambda p: p.withField("lawyer", F.repeat(p["lawyer"], 30)))).otherwise(F.col("first_side")),
        "court_case_id": F.when(n != 10, F.col("court_case_id"))})
    return CN.split_by_constraints(rows)[1].select("case_url", "reason")


register("constraint_quarantine", O.over("""
SELECT 'https://judgments.example/case/' || id AS case_url,
       CASE k % 50 WHEN 2 THEN 'long:title' WHEN 4 THEN 'long:tags' WHEN 6 THEN 'null:judges' WHEN 8 THEN 'long:lawyer' WHEN 10 THEN 'null:court_case_id' END AS reason
FROM replies WHERE reason IS NULL AND k % 50 IN (2, 4, 6, 8, 10) AND NOT (k % 50 = 2 AND said_title IS NULL)""", _REPLIES))(_constraint_quarantine)


# ---------------------------------------------------------------------------
# Entity resolution: fuzzy judge match, tag merging by listing page
# ---------------------------------------------------------------------------


def incoming_judge_names(spark, sf):
    """Raw judge strings as replies would carry them: titled supplier names,
    supplier names with a trailing character, titled customer names."""
    sup = read_table(spark, sf, "supplier").select("s_name")
    cust = read_table(spark, sf, "customer").select("c_name")
    return (sup.select(F.concat(F.lit("Judge "), "s_name", F.lit(" KC")).alias("name"))
            .unionByName(sup.select(F.concat("s_name", F.lit("1")).alias("name")))
            .unionByName(cust.select(F.concat(F.lit("His Honour "), "c_name").alias("name"))))


def _matched_sql(columns: str, names: str, known: str) -> str:
    """The best match of each of ``names`` (a name, and ``batch`` if asked for) among the suppliers that ``known`` admits."""
    return f"""
WITH names AS ({names}), scored AS (
  SELECT *, CASE WHEN list_has_all(a, b) OR list_has_all(b, a) THEN 100e0
                 WHEN NOT list_has_any(a, b) AND levenshtein(na, nb) = 1 AND abs(len(na) - len(nb)) = 1
                 THEN 100e0 * (1e0 - 1e0 / (len(na) + len(nb))) END AS score
  FROM (SELECT names.*, s_name, string_split(name, ' ') AS a, string_split(s_name, ' ') AS b, array_to_string(list_sort(string_split(name, ' ')), ' ') AS na, s_name AS nb
        FROM names, supplier WHERE {known})
), best AS (SELECT DISTINCT ON ({columns}) * FROM scored WHERE score >= 95 ORDER BY {columns}, name <> s_name, score DESC, s_name)
SELECT {columns}, coalesce(s_name, {_STRIP_SQL.format(c="name")}) AS matched_name, score FROM names LEFT JOIN best USING ({columns})"""


register("fuzzy_match_judges", _matched_sql("name", """
  SELECT 'Judge ' || s_name || ' KC' AS name FROM supplier UNION SELECT s_name || '1' FROM supplier UNION SELECT 'His Honour ' || c_name FROM customer""", "true"))(
    lambda spark, sf: RS.match_judges(incoming_judge_names(spark, sf), star(spark, sf).judge))


def _judge_index_batches(spark, sf):
    """J14, R2, R3, S9 by a stored index: judges and names come in three batches; each batch's names meet all judges so far."""
    index = JudgeIndex(_warehouse(spark))
    sup = read_table(spark, sf, "supplier").select("s_name", F.pmod("s_suppkey", F.lit(3)).alias("batch"))
    cust = read_table(spark, sf, "customer").select(F.concat(F.lit("His Honour "), "c_name").alias("name"), F.pmod("c_custkey", F.lit(3)).alias("batch"))
    names = sup.select(F.explode(F.array(F.concat(F.lit("Judge "), "s_name", F.lit(" KC")), F.concat("s_name", F.lit("1")))).alias("name"), "batch").unionByName(cust)
    out = None
    for batch in range(3):
        commit = index.warehouse.start()
        index.add(commit, sup.where(F.col("batch") == batch).select(F.col("s_name").alias("judge_name")))
        commit.publish()
        found = index.match(names.where(F.col("batch") == batch)).select(F.lit(batch).alias("batch"), "name", "matched_name", "score")
        out = found if out is None else out.unionByName(found)
    return out


register("judge_index_batches", _matched_sql("batch, name", """
  SELECT CAST(s_suppkey % 3 AS INT) AS batch, 'Judge ' || s_name || ' KC' AS name FROM supplier UNION SELECT CAST(s_suppkey % 3 AS INT), s_name || '1' FROM supplier
  UNION SELECT CAST(c_custkey % 3 AS INT), 'His Honour ' || c_name FROM customer""", "s_suppkey % 3 <= batch"))(_judge_index_batches)


def scoped_tags(spark, sf):
    """Tags per case with scope = listing page of fifty cases, ordered by case then tag id."""
    st = star(spark, sf)
    number = F.col("court_case_id").cast("long")
    links = st.tag_links.join(st.court_case.select("court_case_id"), "court_case_id", "left_semi").distinct()
    return links.join(st.tag, "tag_id").select(
        F.floor(number / 50).cast("string").alias("scope_id"), "court_case_id", number.alias("case_ord"),
        F.col("tag_id").cast("long").alias("tag_ord"), TX.capitalize("tag_name").alias("tag"))


def _page_tags(spark, sf):
    """(scope_id, tag): the tags of each listing page."""
    st = star(spark, sf)
    links = st.tag_links.join(st.court_case.select("court_case_id"), "court_case_id", "left_semi")
    pages = links.select(F.floor(F.col("court_case_id").cast("long") / 50).cast("string").alias("scope_id"), "tag_id").distinct()
    return pages.join(st.tag, "tag_id").select("scope_id", TX.capitalize("tag_name").alias("tag"))


def tag_synonyms(spark, sf):
    """(word, lemma): words before "m" stand for the first tag that begins with them."""
    part = read_table(spark, sf, "part").select(F.split("p_name", " ")[0].alias("word"), "p_name")
    return part.where(F.col("word") < "m").groupBy("word").agg(F.min("p_name").alias("lemma"))


_TAGS = f"""tagged AS (
  SELECT k, k // 50 AS page, {O.capitalised("v")} AS tag, (k, id) AS spot FROM a JOIN (SELECT p_name AS v, min(p_partkey) AS id FROM part GROUP BY ALL) USING (v))"""
_LEMMAS = f"lemmas AS (SELECT word, {O.capitalised('least')} AS lemma FROM (SELECT split_part(p_name, ' ', 1) AS word, min(p_name) AS least FROM part GROUP BY 1) WHERE word < 'm')"

register("tag_similar_pairs", O.over("""
SELECT CAST(x.page AS VARCHAR) AS scope_id, x.tag, y.tag AS similar_tag, jaro_winkler_similarity(x.tag, y.tag) AS jw
FROM there x JOIN there y ON x.page = y.page AND x.tag <> y.tag WHERE jaro_winkler_similarity(x.tag, y.tag) > 0.9""",
    *O.facts(a="tag"), _TAGS, "there AS (SELECT DISTINCT page, tag FROM tagged)"))(
    lambda spark, sf: RS.similar_tag_pairs(_page_tags(spark, sf)))

register("tag_canonical", O.over("""
SELECT CAST(page AS VARCHAR) AS scope_id, CAST(k AS VARCHAR) AS court_case_id, tag, canonical FROM tagged JOIN canonical USING (page, tag)""",
    *O.facts(a="tag"), _TAGS, _LEMMAS,
    *O.folded("SELECT page, tag, spot FROM tagged",
              synonym="(SELECT lemma FROM lemmas WHERE word = lower(split_part(w, ' ', 1)) AND lemma <> w)"), recursive=True))(
    lambda spark, sf: RS.canonical_tags(scoped_tags(spark, sf), tag_synonyms(spark, sf)).select(
        "scope_id", "court_case_id", "tag", "canonical"))


# ---------------------------------------------------------------------------
# Idempotent loading: first writer wins, bridges union on re-ingest
# ---------------------------------------------------------------------------


def _upsert_court_cases(spark, sf):
    st = star(spark, sf)
    cc = st.court_case.select("court_case_id", "title", "court_date")
    batch_a = cc.where(F.col("court_date") < F.lit("1997-01-01").cast("date")).select(
        "court_case_id", F.lit("A").alias("summary"), "title", "court_date", F.lit(0).alias("ord"))
    li = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("court_case_id"), "l_linenumber")
    line = F.coalesce(F.col("l_linenumber").cast("int"), F.lit(99))
    batch_b = cc.join(li, "court_case_id", "left").select(
        "court_case_id", F.concat(F.lit("B line "), line.cast("string")).alias("summary"), "title", "court_date", line.alias("ord"))
    state = UP.first_wins(batch_a, ["court_case_id"], ["ord"])
    new_b = UP.insert_if_absent(UP.first_wins(batch_b, ["court_case_id"], ["ord"]), state, ["court_case_id"])
    return state.unionByName(new_b).drop("ord")


register("upsert_court_cases", O.over("""
SELECT id AS court_case_id, title, day AS court_date, CASE WHEN day < DATE '1997-01-01' THEN 'A'
       ELSE 'B line ' || coalesce((SELECT min(l_linenumber) FROM lineitem WHERE l_orderkey = k), 99) END AS summary FROM cases"""))(_upsert_court_cases)


def _upsert_judge_bridge(spark, sf):
    li = read_table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("court_case_id"),
        F.col("l_suppkey").cast("int").alias("judge_id"), "l_linenumber")
    keys = ["court_case_id", "judge_id"]
    batch_a = li.where(F.col("l_linenumber") <= 2).select(*keys).distinct()
    batch_b = li.select(*keys).distinct()
    return batch_a.unionByName(UP.insert_if_absent(batch_b, batch_a, keys))


register("upsert_judge_bridge", """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS court_case_id, CAST(l_suppkey AS INT) AS judge_id
FROM lineitem""")(_upsert_judge_bridge)


def _warehouse(spark: SparkSession) -> UP.Warehouse:
    return UP.Warehouse(spark, shared_dir(spark, f"casegrid-runs/{uuid.uuid4().hex}/wh"))


def _batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The cases of even key, and all cases with other summaries."""
    good = stage_table(RP.split(_assembled(spark, sf))[0], "good")
    return good.where(F.col("court_case_id").cast("long") % 2 == 0), good.withColumn("summary", F.concat(F.lit("Later "), "summary"))


def _files(spark: SparkSession, sf: str) -> tuple:
    """Path, size and time of the files that replies are made from."""
    parts = [read_table(spark, sf, t).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
             for t in ("orders", "customer", "nation")]
    return tuple(sorted(map(tuple, parts[0].unionByName(parts[1]).unionByName(parts[2]).collect())))


_LOADS: dict[tuple, UP.Warehouse] = {}


def loaded(spark: SparkSession, sf: str) -> UP.Warehouse:
    """A warehouse after both batches, and the first once more, which must change nothing. The queries that read its tables
    share one, as long as the input files are the same."""
    key = (spark.sparkContext.applicationId, sf, _files(spark, sf))
    if key not in _LOADS:
        wh = _warehouse(spark)
        even, later = _batches(spark, sf)
        for cases in (even, later):
            UP.load_into(wh, cases, staged=True)
        if any(UP.load_into(wh, even, staged=True).values()):
            raise AssertionError("a batch that was loaded again added rows")
        _LOADS[key] = wh
    return _LOADS[key]


def _load_cases(spark, sf):
    wh = loaded(spark, sf)
    return (wh.read("court_case").join(wh.read("court"), "court_id", "left").join(wh.read("verdict"), "verdict_id", "left")
            .select("court_case_id", "title", "court_date", "court_name", "verdict", "case_number", "summary"))


_VALID = "valid AS (SELECT * FROM replies WHERE reason IS NULL)"


def _load_sql(body: str, *ctes: str, recursive: bool = False) -> str:
    return O.over(body, _REPLIES, _VALID, *ctes, recursive=recursive)


register("load_batch_cases", _load_sql("""
SELECT id AS court_case_id, said_title AS title, said_day AS court_date, said_court AS court_name, said_verdict AS verdict, 'No. ' || id AS case_number,
       CASE WHEN k % 2 = 0 THEN '' ELSE 'Later ' END || said_summary AS summary FROM valid"""))(_load_cases)


def _values(names: list[str]) -> str:
    return "(VALUES " + ", ".join("('" + n.replace("'", "''") + "')" for n in names) + ")"


def _load_names(spark, sf):
    """Every dimension's names in one table."""
    wh = loaded(spark, sf)
    firms = wh.read("law_firm")
    parts = [wh.read(t).select(F.lit(t).alias("dimension"), F.col(UP.DIMENSIONS[t][1][0]).alias("name"), F.lit(None).cast("string").alias("firm"))
             for t in ("court", "verdict", "judge", "tag", "participant", "law_firm")]
    parts.append(wh.read("lawyer").join(firms, "law_firm_id", "left").select(
        F.lit("lawyer").alias("dimension"), F.col("lawyer_name").alias("name"), F.col("law_firm_name").alias("firm")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Judges: with none known, the first batch adds both names of a case without their titles. Later, a customer's two
# names are matched to the shorter one where the first batch had it.
_JUDGES = """sat AS (
  SELECT DISTINCT id, unnest(CASE WHEN k % 2 = 0 OR NOT known THEN [c_name, 'Hon. ' || c_name] ELSE [c_name] END) AS judge
  FROM (SELECT *, c_custkey IN (SELECT c_custkey FROM valid WHERE k % 2 = 0) AS known FROM valid))"""
# Tags are merged by page, once among the cases of the first batch and once among all.
_TAG_BATCHES = [f"""batches AS (
  SELECT b, k, id, b || ' ' || CAST(k // 50 AS VARCHAR) AS page, tag, (id, pos) AS spot
  FROM (SELECT *, unnest([{O.capitalised('c_mktsegment')}, 'Status ' || lower(o_orderstatus)]) AS tag, unnest([0, 1]) AS pos FROM valid), unnest(['a', 'b']) AS two(b)
  WHERE b = 'b' OR k % 2 = 0)""", *O.folded("SELECT page, tag, spot FROM batches"),
    "carried AS (SELECT DISTINCT id, canonical AS tag FROM batches JOIN canonical USING (page, tag))"]

register("load_batch_names", _load_sql(f"""
SELECT 'court' AS dimension, name, CAST(NULL AS VARCHAR) AS firm FROM (SELECT * FROM {_values(S.SEED_COURTS)} x(name) UNION SELECT said_court FROM valid)
UNION ALL SELECT 'verdict', name, NULL FROM {_values(S.ALLOWED_VERDICTS)} x(name)
UNION ALL SELECT DISTINCT 'judge', judge, NULL FROM sat
UNION ALL SELECT DISTINCT 'tag', tag, NULL FROM carried
UNION ALL SELECT DISTINCT 'participant', c_name, NULL FROM valid UNION ALL SELECT 'participant', NULL, NULL
UNION ALL SELECT DISTINCT 'law_firm', 'Firm ' || c_nationkey, NULL FROM valid UNION ALL SELECT 'law_firm', NULL, NULL
UNION ALL SELECT DISTINCT 'lawyer', 'Counsel ' || c_custkey, 'Firm ' || c_nationkey FROM valid UNION ALL SELECT 'lawyer', NULL, NULL""",
    _JUDGES, *_TAG_BATCHES, recursive=True))(_load_names)


def _load_judges(spark, sf):
    wh = loaded(spark, sf)
    return wh.read("judge_assignment").join(wh.read("judge"), "judge_id").select("court_case_id", "judge_name")


register("load_batch_judges", _load_sql("SELECT id AS court_case_id, judge AS judge_name FROM sat", _JUDGES))(_load_judges)


def _load_tags(spark, sf):
    wh = loaded(spark, sf)
    return wh.read("tag_assignment").join(wh.read("tag"), "tag_id").select("court_case_id", "tag_name")


register("load_batch_tags", _load_sql("SELECT id AS court_case_id, tag AS tag_name FROM carried", *_TAG_BATCHES, recursive=True))(_load_tags)


def _load_parties(spark, sf):
    wh = loaded(spark, sf)
    return (wh.read("participant_assignment").join(wh.read("participant"), "participant_id", "left").join(wh.read("lawyer"), "lawyer_id", "left")
            .join(wh.read("law_firm"), "law_firm_id", "left")
            .select("court_case_id", "participant_name", "lawyer_name", "law_firm_name", "is_defendant"))


register("load_batch_parties", _load_sql("""
SELECT id AS court_case_id, side = 2 AS is_defendant, CASE side WHEN 1 THEN c_name END AS participant_name,
       CASE side WHEN 1 THEN 'Counsel ' || c_custkey END AS lawyer_name, CASE side WHEN 1 THEN 'Firm ' || c_nationkey END AS law_firm_name
FROM valid, unnest([1, 2]) AS two(side)"""))(_load_parties)


# The tables of a state of the loads, counted; ``kept`` says which cases have come.
_COUNTED = f"""
SELECT 'court' AS name, count(*) AS n FROM (SELECT * FROM {_values(S.SEED_COURTS)} x(v) UNION SELECT said_court FROM valid)
UNION ALL SELECT 'verdict', count(*) FROM {_values(S.ALLOWED_VERDICTS)} x(v)
UNION ALL SELECT 'judge', count(DISTINCT judge) FROM sat
UNION ALL SELECT 'tag', count(DISTINCT tag) FROM carried
UNION ALL SELECT 'participant', count(DISTINCT c_name) + 1 FROM valid
UNION ALL SELECT 'law_firm', count(DISTINCT c_nationkey) + 1 FROM valid
UNION ALL SELECT 'lawyer', count(DISTINCT c_custkey) + 1 FROM valid
UNION ALL SELECT 'court_case', count(*) FROM valid
UNION ALL SELECT 'judge_assignment', count(*) FROM sat
UNION ALL SELECT 'tag_assignment', count(*) FROM carried
UNION ALL SELECT 'participant_assignment', 2 * count(*) FROM valid"""
_COUNTED_TABLES = ["court", "verdict", "judge", "tag", "law_firm", "participant", "lawyer", "court_case", "participant_assignment", "judge_assignment", "tag_assignment"]


def _state(wh: UP.Warehouse) -> dict[str, int]:
    """Rows that readers see, by table, in one job."""
    tables = wh.tables()
    parts = [tables[t].select(F.lit(t).alias("name")) for t in _COUNTED_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return {r["name"]: r["count"] for r in out.groupBy("name").count().collect()}


def _load_after_failures(spark, sf):
    """The second batch breaks off after each of its tables in turn, and is then loaded. For each failure, the
    rows that readers see before the load is done anew, and in the end; all contents of the cases' links in one checksum."""
    wh = _warehouse(spark)
    even, later = _batches(spark, sf)
    UP.load_into(wh, even, staged=True)

    def attempt(fail_after):
        if wh.committed("second") is not None:
            return
        commit = UP.Commit(wh, "second", fail_after)
        commit.clear()
        UP.load_into(wh, later, commit=commit, staged=True)
        commit.publish()

    between = {}
    for t in _COUNTED_TABLES:
        try:
            attempt(t)
        except UP.Crash:
            between[t] = _state(wh)
    for _ in range(2):  # the second time, it is known to be done
        attempt(None)
    after = _state(wh)
    rows = [(failed, t, seen.get(t, 0), after[t]) for failed, seen in between.items() for t in _COUNTED_TABLES]
    return spark.createDataFrame(rows, "failed_after string, name string, rows_between long, rows_after long")


def _counted_sql(alias: str, kept: str) -> str:
    """One state of the loads as a sub-query."""
    ctes = [O.CASES, _REPLIES, f"valid AS (SELECT * FROM replies WHERE reason IS NULL{kept})", _JUDGES, *_TAG_BATCHES]
    return "(WITH RECURSIVE " + ",\n".join(ctes) + _COUNTED + f") AS {alias}"


register("load_after_failures", f"""
SELECT failed_after, name, early.n AS rows_between, late.n AS rows_after
FROM {_counted_sql("early", " AND k % 2 = 0")} JOIN {_counted_sql("late", "")} USING (name), {_values(_COUNTED_TABLES)} f(failed_after)""")(_load_after_failures)


def _maintained(spark, sf):
    """A1-A8 kept up to date over the loads, all six pairs of kinds."""
    wh = loaded(spark, sf)
    out = None
    for a, b in (("verdict", "judge"), ("tag", "judge"), ("court", "judge"), ("verdict", "court"), ("tag", "court"), ("verdict", "tag")):
        part = MT.pair_counts(wh, a, b).select(F.lit(a).alias("kind"), F.lit(b).alias("by_kind"), F.col(MT.NAMES[a]).alias("name"),
                                               F.col(MT.NAMES[b]).alias("by_name"), "count")
        out = part if out is None else out.unionByName(part)
    return out


_LOADED_FACTS = """facts AS (
  SELECT id, 'judge' AS kind, judge AS name FROM sat UNION ALL SELECT id, 'tag', tag FROM carried
  UNION ALL SELECT id, 'court', said_court FROM valid UNION ALL SELECT id, 'verdict', said_verdict FROM valid)"""
register("pair_counts_maintained", _load_sql("""
SELECT a.kind, b.kind AS by_kind, a.name, b.name AS by_name, CAST(count(*) AS BIGINT) AS count FROM facts a JOIN facts b USING (id)
WHERE (a.kind, b.kind) IN (('verdict', 'judge'), ('tag', 'judge'), ('court', 'judge'), ('verdict', 'court'), ('tag', 'court'), ('verdict', 'tag')) GROUP BY ALL""",
    _JUDGES, *_TAG_BATCHES, _LOADED_FACTS, recursive=True))(_maintained)


# ---------------------------------------------------------------------------
# Incremental runs: unseen rows, cache, subscriptions, outbox, streaming
# ---------------------------------------------------------------------------


def _seen(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").cast("string").alias("citation"))


def _incremental_new(compat):
    def build(spark, sf):
        rows = INC.new_listing_rows(FX.listing_rows(star(spark, sf)), _seen(spark, sf),
                                    log_date="1997-06-01", compat=compat)
        return rows.select("citation", "title", "court", "date")
    return build


_NEW = "SELECT id AS citation, title, court, day_text AS date FROM cases WHERE o_orderstatus <> 'F'"
register("incremental_new", O.over(_NEW))(_incremental_new(False))
register("incremental_new_compat", O.over(f"{_NEW} AND day >= DATE '1997-06-01'"))(_incremental_new(True))

register("listing_in_scope", O.over(
    "SELECT id AS citation, court FROM cases WHERE c_nationkey IN (3, 14) AND day BETWEEN DATE '1996-02-01' AND DATE '1998-03-31'"))(
    lambda spark, sf: INC.listing_scope(FX.listing_rows(star(spark, sf)), ["Court of D", "Court of BE"], "1996-02-01", "1998-03-31")
    .select("citation", "court"))


def _enrich_cached(spark, sf):
    """A cache with the finished orders' replies, failures among them; the hook has none for every sixth."""
    st = star(spark, sf)
    replies = FX.synthetic_replies(st)
    n = F.col("citation").cast("long")
    cache = replies.join(_seen(spark, sf), "citation", "left_semi").withColumn("raw", F.when(n % 10 != 1, F.col("raw")))
    found = INC.enrich_cached(FX.listing_rows(st), cache, lambda misses: replies.where(n % 6 != 0).join(misses, "citation", "left_semi"))
    return found.select("citation", "hit", F.col("raw").isNotNull().alias("has_reply"))


register("enrich_cached", O.over("""
SELECT id AS citation, o_orderstatus = 'F' AS hit, CASE WHEN o_orderstatus = 'F' THEN k % 10 <> 1 ELSE k % 6 <> 0 END AS has_reply FROM cases"""))(_enrich_cached)


def _subscription_requests(spark, sf):
    cust = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    court = star(spark, sf).court
    email = F.when(F.col("c_custkey") % 5 == 0, F.lit("no email given")).otherwise(F.concat(
        F.lit("Contact "), F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.example.org today")))
    courts = F.when(F.col("c_acctbal") > 0, F.array("court_name")).otherwise(F.array().cast("array<string>"))
    return cust.join(court, cust.c_nationkey == court.court_id).select(email.alias("email_input"), courts.alias("courts"))




def _topic_sql(court: str) -> str:
    return "'c12-courts-' || regexp_replace(replace(" + court + ", ' ', '-'), '[^\\p{L}-]', '', 'g')"


def _subs_sql(where: str) -> str:
    return (f"subs AS (SELECT DISTINCT {_topic_sql(O.COURT)} AS topic, lower(replace(c_name, '#', '.')) || '@mail.example.org' AS email "
            f"FROM customer WHERE c_custkey % 5 <> 0 AND c_acctbal > 0 AND c_nationkey {where})")


register("subscriptions", f"WITH {_subs_sql('>= 0')} SELECT topic, email FROM subs")(
    lambda spark, sf: INC.subscribe(_subscription_requests(spark, sf)))


def _outbox(spark, sf):
    """Topics of the first ten courts only have subscribers, and new cases come from courts of even number."""
    new = _incremental_new(False)(spark, sf)
    court = star(spark, sf).court
    even = court.where(F.col("court_id") % 2 == 0).select(F.col("court_name").alias("court"))
    topics = INC.subscribe(_subscription_requests(spark, sf).join(
        court.where("court_id < 10"), F.array_contains("courts", F.col("court_name")), "left_semi"))
    return INC.notify_outbox(new.join(even, "court", "left_semi"), topics, 0)


register("notify_outbox", O.over(f"""
SELECT DISTINCT topic, substring(replace(topic, '-', ' '), 12) AS court_display, CAST(0 AS BIGINT) AS batch_id, 'New case(s) uploaded' AS subject,
       'A new case has been uploaded from the ' || substring(replace(topic, '-', ' '), 12) AS message
FROM cases JOIN subs ON topic = {_topic_sql("court")} WHERE o_orderstatus <> 'F' AND cases.c_nationkey % 2 = 0""", _subs_sql("< 10")))(_outbox)


def _event_dedup_stream(spark, sf):
    """Events replayed as a file stream (one file per day), every seventh event again in the files of the next day;
    the watermark is longer than the stream, so each event stays once in whatever order files come."""
    root = shared_dir(spark, f"casegrid-runs/{uuid.uuid4().hex}")
    ev = read_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type").withColumn("day", F.to_date("ts"))
    again = ev.where("event_id % 7 = 0").withColumn("day", F.date_add("day", 1))
    ev.unionByName(again).write.partitionBy("day").parquet(f"{root}/events")
    stream = (spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string")
              .option("maxFilesPerTrigger", 10).parquet(f"{root}/events"))
    kept = INC.dedup_stream(stream, "event_id", "ts", "90 days")
    q = (kept.writeStream.format("parquet").option("path", f"{root}/kept")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/kept").select("event_id", "ts", "user_id", "event_type")


register("event_dedup_stream", "SELECT event_id, ts, user_id, event_type FROM events")(_event_dedup_stream)


def _incremental_stream(spark, sf):
    """T1 end to end: listing rows land as files (one per year), a file-source
    stream processes them with foreachBatch into a fresh warehouse."""
    root = shared_dir(spark, f"casegrid-runs/{uuid.uuid4().hex}")
    st = star(spark, sf)
    listing = FX.listing_rows(st).withColumn("year", F.coalesce(F.regexp_extract("date", " ([0-9]{4})", 1), F.lit("none")))
    listing.repartition("year").write.partitionBy("year").parquet(f"{root}/listing")
    replies = FX.synthetic_replies(st)
    schema = "title string, url string, court string, citation string, date string, text_raw string, scope_id string, pos int"
    INC.run_incremental(spark, f"{root}/listing", schema, f"{root}/wh", f"{root}/ckpt",
                        lambda valid: replies.join(valid.select("citation"), "citation", "left_semi"),
                        dt.date(2024, 1, 1), max_files_per_trigger=4)
    wh = UP.Warehouse(spark, f"{root}/wh")
    return wh.read("court_case").select("court_case_id", "title", "court_date", "case_number")


register("incremental_stream", _load_sql("""
SELECT id AS court_case_id, said_title AS title, said_day AS court_date, 'No. ' || id AS case_number FROM valid WHERE day IS NOT NULL"""))(_incremental_stream)


def _sightings(spark, sf, root):
    """Events as sightings of citations, a folder of files for each day, written in order; every seventh comes again a day later."""
    ev = read_table(spark, sf, "events").select(F.concat_ws("-", "user_id", "event_type").alias("citation"), "ts", "event_id").withColumn("day", F.to_date("ts"))
    again = ev.where("event_id % 7 = 0").withColumn("day", F.date_add("day", 1))
    ev.unionByName(again).where("day IS NOT NULL").write.partitionBy("day").parquet(f"{root}/staged")
    both = spark.read.parquet(f"{root}/staged")
    for r in both.select("day").distinct().orderBy("day").collect():  # each step reads its own day's folder
        both.where(F.col("day") == F.lit(r["day"])).drop("day").coalesce(1).write.mode("append").parquet(f"{root}/sightings")


def _seen_expiry_stream(spark, sf):
    """T4: a citation counts as seen for the rest of its day, whenever it comes; the state of days gone by expires."""
    root = shared_dir(spark, f"casegrid-runs/{uuid.uuid4().hex}")
    _sightings(spark, sf, root)
    stream = (spark.readStream.schema("citation string, ts timestamp, event_id long").option("maxFilesPerTrigger", 6).parquet(f"{root}/sightings"))
    q = (INC.admit_daily(stream, "2 days").writeStream.outputMode("append").format("parquet").option("path", f"{root}/admitted")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("citation string, day date, event_id long").parquet(f"{root}/admitted")


register("seen_expiry_stream", """
SELECT user_id || '-' || event_type AS citation, CAST(ts AS DATE) AS day, arg_min(event_id, (ts, event_id)) AS event_id
FROM events GROUP BY ALL""")(_seen_expiry_stream)


_LASTS = 4  # days of a subscription


def _notify_stream(spark, sf):
    """Events as new cases of a court by their user, and subscriptions of customers that begin day by day."""
    root = shared_dir(spark, f"casegrid-runs/{uuid.uuid4().hex}")
    court = star(spark, sf).court.select("court_id", TX.topic_name("court_name").alias("topic"))
    ev = read_table(spark, sf, "events").withColumn("court_id", F.pmod("user_id", F.lit(25)).cast("int"))
    first = ev.agg(F.to_date(F.min("ts"))).first()[0]
    cases = ev.join(court, "court_id").select("topic", "ts", F.to_date("ts").alias("day"))
    cust = read_table(spark, sf, "customer").where("c_custkey % 3 = 0").withColumn("court_id", F.col("c_nationkey").cast("int"))
    day = F.date_add(F.lit(first), (F.col("c_custkey") * 7 % 29).cast("int"))
    subs = cust.join(court, "court_id").select("topic", F.timestamp_add("HOUR", (F.col("c_custkey") % 24).cast("int"), day.cast("timestamp")).alias("sub_ts"), day.alias("day"))
    for name, rows in (("cases", cases), ("subs", subs)):
        period = F.floor(F.date_diff("day", F.lit(first)) / 5).cast("int")
        rows.withColumn("period", period).drop("day").where("period BETWEEN 0 AND 6").write.partitionBy("period").parquet(f"{root}/staged-{name}")
        staged = spark.read.parquet(f"{root}/staged-{name}")
        for k in range(7):  # five days to a file, in order; each step reads its own folder
            staged.where(F.col("period") == k).drop("period").coalesce(1).write.mode("append").parquet(f"{root}/{name}")
    read = spark.readStream.option("maxFilesPerTrigger", 2)
    wh = UP.Warehouse(spark, f"{root}/wh")
    INC.notify_run(read.schema("topic string, ts timestamp").parquet(f"{root}/cases"), read.schema("topic string, sub_ts timestamp").parquet(f"{root}/subs"),
                   wh, f"{root}/ckpt", f"{_LASTS} DAYS", "1 day")
    return wh.read("day_message", "topic string, day date, message string")


def _court_of(key: str) -> str:
    return _topic_sql(O.COURT.replace("c_nationkey", key))


register("notify_stream", f"""
WITH subs AS (
  SELECT {_court_of("c_nationkey")} AS topic, (SELECT min(CAST(ts AS DATE)) FROM events) + CAST(c_custkey * 7 % 29 AS INT) + to_hours(c_custkey % 24) AS sub_ts
  FROM customer WHERE c_custkey % 3 = 0
), sent AS (SELECT {_court_of("(user_id % 25)")} AS topic, ts FROM events)
SELECT DISTINCT topic, CAST(ts AS DATE) AS day, 'A new case has been uploaded from the ' || substring(replace(topic, '-', ' '), 12) AS message
FROM sent SEMI JOIN subs ON sent.topic = subs.topic AND ts >= sub_ts AND ts < sub_ts + INTERVAL {_LASTS} DAYS""")(_notify_stream)


def _cases_per_month_stream(spark, sf):
    """Cases come year by year, every fiftieth after all others; those over a year late aren't counted, but are told."""
    root = shared_dir(spark, f"casegrid-runs/{uuid.uuid4().hex}")
    late = F.col("court_case_id").cast("long") % 50 == 3
    cases = stage_table(star(spark, sf).court_case.select(F.col("court_date").cast("timestamp").alias("ts"), F.year("court_date").alias("year"), late.alias("late")), "cases")
    years = [r[0] for r in cases.where("NOT late AND year IS NOT NULL").select("year").distinct().orderBy("year").collect()]
    for part in [*[(F.col("year") == y) & ~F.col("late") for y in years], F.col("late") & F.col("year").isNotNull()]:
        cases.where(part).select("ts").coalesce(1).write.mode("append").parquet(f"{root}/cases")
    wh = UP.Warehouse(spark, f"{root}/wh")
    INC.count_days_run(spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{root}/cases"), wh, f"{root}/ckpt", "365 days")
    days = INC.day_counts(wh).unionByName(cases.where("ts IS NULL").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n")))
    months = days.groupBy(F.month("day").cast("int").alias("month_num")).agg(F.sum("n").alias("case_count")).select(
        "month_num", TX.month_label("month_num").alias("month"), "case_count")
    missed = cases.agg(F.count(F.lit(1)).alias("all")).join(days.agg(F.sum("n").alias("counted")))  # a row each
    return months.unionByName(missed.select(F.lit(None).cast("int").alias("month_num"), F.lit("late").alias("month"), (F.col("all") - F.col("counted")).alias("case_count")))


# A row is late by the watermark of the batch before its own, so the last year is still open when the late ones come.
register("cases_per_month_stream", O.over("""
SELECT CAST(month(day) AS INT) AS month_num, strftime(day, '%b') AS month, CAST(count(*) AS BIGINT) AS case_count FROM marked WHERE NOT late GROUP BY ALL
UNION ALL SELECT NULL, NULL, count(*) FROM cases WHERE day IS NULL HAVING count(*) > 0
UNION ALL SELECT NULL, 'late', CAST(count(*) AS BIGINT) FROM marked WHERE late""",
    "top AS (SELECT max(day) AS top FROM cases WHERE k % 50 <> 3 AND year(day) < (SELECT max(year(day)) FROM cases WHERE k % 50 <> 3))",
    "marked AS (SELECT day, k % 50 = 3 AND day + 1 <= top - 365 AS late FROM cases, top WHERE day IS NOT NULL)"))(_cases_per_month_stream)


def _incremental_state(spark, sf):
    """What two runs leave behind, the first of which breaks off within its second batch."""
    root = shared_dir(spark, f"casegrid-runs/{uuid.uuid4().hex}")
    st = star(spark, sf)
    listing = FX.listing_rows(st).withColumn("part", F.pmod("pos", F.lit(2)))
    listing.where("part = 0").drop("part").write.parquet(f"{root}/listing")
    replies = stage_table(FX.synthetic_replies(st), "replies")
    schema = "title string, url string, court string, citation string, date string, text_raw string, scope_id string, pos int"

    def run(**options):
        INC.run_incremental(spark, f"{root}/listing", schema, f"{root}/wh", f"{root}/ckpt",
                            lambda valid: replies.join(valid.select("citation"), "citation", "left_semi"), dt.date(2024, 1, 1), **options)

    try:
        run(fail_after="outbox")
    except StreamingQueryException:
        listing.where("part = 1").drop("part").write.mode("append").parquet(f"{root}/listing")
    run()
    wh = UP.Warehouse(spark, f"{root}/wh")
    none = F.lit(None).cast("string")
    log = wh.read("run_log", "batch_id long, new_rows long, blank_rows long, cases long, rejected long, loaded long")
    sums = log.agg(*[F.sum(c).alias(c) for c in log.columns[1:]]).select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in log.columns[1:]]), F.array(*log.columns[1:]))).alias("key", "n"))
    return (wh.read("seen", "citation string, log_date date").select(F.lit("seen").alias("kind"), F.col("citation").alias("key"), F.col("log_date").cast("string").alias("detail"))
            .unionByName(wh.read("quarantine", "citation string, raw string, reason string, scope_id string").select(
                F.lit("quarantine").alias("kind"), F.col("citation").alias("key"), F.col("reason").alias("detail")))
            .unionByName(wh.read("court_case").select(F.lit("case").alias("kind"), F.col("court_case_id").alias("key"), none.alias("detail")))
            .unionByName(sums.select(F.lit("run_log").alias("kind"), "key", F.col("n").cast("string").alias("detail"))))


register("incremental_state", _load_sql("""
SELECT 'seen' AS kind, id AS key, '2024-01-01' AS detail FROM cases WHERE day IS NOT NULL
UNION ALL SELECT 'quarantine', id, CASE WHEN day IS NULL THEN 'blank:date' ELSE reason END FROM replies WHERE day IS NULL OR reason IS NOT NULL
UNION ALL SELECT 'case', id, NULL FROM valid WHERE day IS NOT NULL
UNION ALL SELECT 'run_log', 'new_rows', CAST(count(*) AS VARCHAR) FROM cases
UNION ALL SELECT 'run_log', 'blank_rows', CAST(count(*) AS VARCHAR) FROM cases WHERE day IS NULL
UNION ALL SELECT 'run_log', 'cases', CAST(count(*) AS VARCHAR) FROM cases WHERE day IS NOT NULL
UNION ALL SELECT 'run_log', 'rejected', CAST(count(*) AS VARCHAR) FROM replies WHERE day IS NOT NULL AND reason IS NOT NULL
UNION ALL SELECT 'run_log', 'loaded', CAST(count(*) AS VARCHAR) FROM valid WHERE day IS NOT NULL"""))(_incremental_state)


def _backfill_twice(spark, sf):
    """A backfill and its repetition: what was asked for, and what was kept."""
    st = star(spark, sf)
    wh, listing, replies = _warehouse(spark), stage_table(FX.listing_rows(st), "listing"), stage_table(FX.synthetic_replies(st), "replies")
    runs = [INC.backfill(wh, listing, lambda misses: replies.where("citation % 3 <> 0").join(misses, "citation", "left_semi")) for _ in range(2)]
    case = wh.read("court_case").select("court_case_id")
    out = None
    for i, r in enumerate(runs):
        part = r.select(F.lit(i + 1).alias("run"), "citation", "hit", F.col("raw").isNotNull().alias("has_reply"))
        out = part if out is None else out.unionByName(part)
    return out.join(case.withColumn("loaded", F.lit(True)), F.col("citation") == F.col("court_case_id"), "left").select(
        "run", "citation", "hit", "has_reply", F.coalesce("loaded", F.lit(False)).alias("loaded"))


register("backfill_twice", _load_sql("""
SELECT CAST(run AS INT) AS run, id AS citation, run = 2 AS hit, k % 3 <> 0 AS has_reply, reason IS NULL AND k % 3 <> 0 AS loaded FROM replies, (VALUES (1), (2)) x(run)"""))(_backfill_twice)


def queries() -> dict[str, Builder]:
    return {k: v.build for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.oracle for k, v in REGISTRY.items() if v.oracle is not None}
