"""Court-pipeline inputs derived from the driver tables.

Listing rows and enrichment replies are built row-by-row from
orders ⋈ customer (no grouping), so they grow with the data. Replies are
dict-literal text with a deterministic mix of valid and rejected shapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.sources.html import (
    CITATION_CLASS, COURT_CLASS, DATE_CLASS, LISTING_UL_CLASS, PAGE_LINK_CLASS, PAGINATION_LABEL, TITLE_CLASS,
)
from casegrid.sources.tables import Star

# Reply verdict per order-priority code 1..5 ('Undecided' is outside the
# closed vocabulary and must become 'Other').
REPLY_VERDICTS = ["Guilty", "Dismissed", "Claimant Wins", "Undecided", "Appeal Allowed"]


def listing_rows(star: Star) -> DataFrame:
    """Listing rows (title, url, court, citation, date text, text_raw, scope_id, pos).

    A scope is a listing page of fifty cases; ``pos`` is the place on it. Cases
    without a date have an empty date text.
    """
    cc = star.court_case.select("court_case_id", "title", "case_url", "court_id", "court_date")
    number = F.col("court_case_id").cast("long")
    date = F.coalesce(F.concat(F.date_format("court_date", "d MMM yyyy"), F.lit(", midnight")), F.lit(""))
    return cc.join(star.court, "court_id", "left").select(
        "title", F.col("case_url").alias("url"), F.col("court_name").alias("court"),
        F.col("court_case_id").alias("citation"), date.alias("date"),
        F.concat(F.lit("Judgment of "), F.col("title")).alias("text_raw"),
        F.floor(number / 50).cast("string").alias("scope_id"), (number % 50).cast("int").alias("pos"))


def _q(c) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


# What a reply does wrong, by order key modulo 40; other replies are valid. Replies of key 20
# name another court, those of key 21 another date, those of key 22 a date that is none.
FAULTS = {
    1: "missing:verdict", 3: "empty:tags", 5: "unparseable", 7: "missing:summary", 9: "side:second_side",
    11: "type:judge", 13: "blank:case_number", 15: "not_a_dict", 17: "element:tags", 19: "empty_party:first_side",
    23: "type:summary", 25: "empty:judge", 27: "missing:second_side", 29: "type:first_side", 31: "element:judge",
}


def synthetic_replies(star: Star) -> DataFrame:
    """(citation, raw): one reply text for each order, valid or with the fault of FAULTS."""
    o = star.raw("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    c = star.raw("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    df = o.join(c, o.o_custkey == c.c_custkey)
    key = F.col("o_orderkey").cast("string")
    fault = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in FAULTS.items() for x in kv]), (F.col("o_orderkey") % 40).cast("int")), F.lit(""))
    df = df.withColumn("fault", fault)

    def unless(plain: Column, **broken: str) -> Column:
        made = plain
        for name, text in broken.items():
            made = F.when(F.col("fault") == name.replace("__", ":"), F.lit(text)).otherwise(made)
        return made

    verdicts = F.array(*[F.lit(v) for v in REPLY_VERDICTS])
    verdict = _q(F.element_at(verdicts, F.substring("o_orderpriority", 1, 1).cast("int")))
    summary = _q(F.concat(F.lit("Order "), key, F.lit(" for "), F.col("c_name")))
    tags = F.concat(F.lit("["), _q(F.lower("c_mktsegment")), F.lit(", "),
                    _q(F.concat(F.lit("status "), F.lower("o_orderstatus"))), F.lit("]"))
    judges = F.concat(F.lit("["), _q(F.concat(F.lit("judge "), F.lower("c_name"))), F.lit(", "),
                      _q(F.concat(F.lit("THE HON. "), F.upper("c_name"))), F.lit("]"))
    first = F.concat(F.lit("{"), _q(F.col("c_name")), F.lit(": {"),
                     _q(F.concat(F.lit("Counsel "), F.col("c_custkey").cast("string"))), F.lit(": "),
                     _q(F.concat(F.lit("Firm "), F.col("c_nationkey").cast("string"))), F.lit("}}"))
    listing = F.when(F.col("o_orderkey") % 40 == 20, F.lit(", 'court': 'Privy Council'")).when(
        F.col("o_orderkey") % 40 == 21, F.lit(", 'date': '3 Mar 2003, midnight', 'title': None")).when(
        F.col("o_orderkey") % 40 == 22, F.lit(", 'date': 'some day'")).otherwise(F.lit(""))
    body = F.concat(
        F.lit("{'verdict': "), unless(verdict, missing__verdict="None"),
        F.lit(", 'summary': "), unless(summary, missing__summary="None", type__summary="12"),
        F.lit(", 'case_number': "), unless(_q(F.concat(F.lit("No. "), key)), blank__case_number="' \\t'"),
        F.lit(", 'verdict_summary': "), _q(F.col("o_orderstatus")),
        F.lit(", 'judge': "), unless(judges, type__judge="'one judge'", empty__judge="[]", element__judge="['a', 3]"),
        F.lit(", 'tags': "), unless(tags, empty__tags="[]", element__tags="['x', None]"),
        F.lit(", 'first_side': "), unless(first, empty_party__first_side="{'A': {}}", type__first_side="['A']"),
        F.lit(", 'second_side': "), unless(F.lit("{None: {None: None}}"), side__second_side="{'R': 'Crown'}", missing__second_side="None"),
        listing, F.lit("}"))
    raw = F.when(F.col("fault") == "unparseable", F.concat(F.lit("Sorry, I cannot summarise {'verdict': "), verdict)).when(
        F.col("fault") == "not_a_dict", F.lit("['verdict', 'summary']")).otherwise(body)
    return df.select(key.alias("citation"), raw.alias("raw"))


def site_pages(star: Star) -> DataFrame:
    """(page_id, url, html): a page of a listing site for each order - one item, with a field missing now and then,
    and page links, none, or no pagination."""
    rows = listing_rows(star).withColumn("n", F.col("citation").cast("long"))

    def span(name: str, text: Column) -> Column:
        return F.concat(F.lit(f'<span class="{name}">'), text, F.lit("</span>"))

    title = span(TITLE_CLASS, F.concat(F.lit('<a href="/case/'), "citation", F.lit('">'), F.replace("title", F.lit("#"), F.lit("&#35;")), F.lit("</a>")))
    court = F.when(F.col("n") % 9 == 4, F.lit("")).otherwise(span(COURT_CLASS, F.col("court")))
    date = F.when(F.col("n") % 7 == 3, F.lit("")).otherwise(F.concat(
        F.lit(f'<time class="{DATE_CLASS}" datetime="'), "date", F.lit('">on that day</time>')))
    item = F.concat(F.lit("<li>"), title, court, span(CITATION_CLASS, F.concat(F.lit(" "), "citation", F.lit("\n"))), date, F.lit("</li>"))
    link = F.transform(F.sequence(F.lit(1), F.col("n") % 5 + 1), lambda i: F.concat(
        F.lit(f'<a class="x {PAGE_LINK_CLASS}" href="?">Page '), (i * F.lit(3)).cast("string"), F.lit("</a>")))
    pages = F.when(F.col("n") % 4 == 0, F.lit("")).when(F.col("n") % 4 == 1, F.lit(f'<nav aria-label="{PAGINATION_LABEL}"><a class="{PAGE_LINK_CLASS}">Next</a></nav>')).otherwise(
        F.concat(F.lit(f'<nav aria-label="{PAGINATION_LABEL}">'), F.array_join(link, ""), F.lit("</nav>")))
    return rows.select(F.col("n").alias("page_id"), "url", F.concat(
        F.lit(f'<body><ul class="{LISTING_UL_CLASS}">'), item, item, F.lit("</ul>"), pages, F.lit("</body>")).alias("html"))
