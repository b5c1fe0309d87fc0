"""HTML page sources: article text, listing items, pagination extent, table cells.

Input is a ``pages(page_id, url, html)`` table (crawling is out of scope).
A page is parsed once a query, inside an Arrow-batched pandas UDF using the
standard-library ``html.parser`` (no HTML parser exists among Spark
built-ins). Everything downstream — exploding items, selecting cells,
validation, de-duplication, quarantine — is native DataFrame work.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the listing site's markup.
LISTING_UL_CLASS = "judgment-listing__list"
TITLE_CLASS = "judgment-listing__title"
COURT_CLASS = "judgment-listing__court"
CITATION_CLASS = "judgment-listing__neutralcitation"
DATE_CLASS = "judgment-listing__date"
PAGINATION_LABEL = "Results pagination"
PAGE_LINK_CLASS = "pagination__page-link"
CELL_CONTAINER_CLASS = "page__content [ flow ]"
BASE_URL = "https://caselaw.nationalarchives.gov.uk"

ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("href", T.StringType()),
    T.StructField("court", T.StringType()),
    T.StructField("citation", T.StringType()),
    T.StructField("date", T.StringType()),
])

PARSED_PAGE = T.StructType([
    T.StructField("article", T.StringType()),
    T.StructField("items", T.ArrayType(ITEM)),
    T.StructField("has_pagination", T.BooleanType()),
    T.StructField("page_links", T.ArrayType(T.StringType())),
    T.StructField("cells", T.ArrayType(T.StringType())),
])

_SKIP_TEXT = {"script", "style", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
         "param", "source", "track", "wbr"}


class _PageParser(HTMLParser):
    """One pass over a page collecting every extract we need."""

    def __init__(self, listing_ul_class: str | None, cell_tag: str,
                 cell_container_class: str | None):
        super().__init__(convert_charrefs=True)
        self.listing_ul_class = listing_ul_class
        self.cell_tag = cell_tag
        self.cell_container_class = cell_container_class
        self.stack: list[str] = []
        self.skip = 0
        # first <article>
        self.article_depth = 0
        self.article_done = False
        self.article_parts: list[str] = []
        # listing items
        self.listing_found = False
        self.in_listing = 0
        self.li_depth = 0
        self.item = None
        self.item_field = None
        self.item_field_depth = 0
        self.items: list[dict] = []
        # pagination
        self.nav_found = False
        self.in_pagination = 0
        self.page_link = None
        self.page_links: list[str] = []
        # cells
        self.container_found = cell_container_class is None
        self.in_container = 1 if cell_container_class is None else 0
        self.cell_depth = 0
        self.cell_parts: list[str] = []
        self.cells: list[str] = []

    # -- helpers --
    @staticmethod
    def _attr(attrs, name):
        for k, v in attrs:
            if k == name:
                return v
        return None

    def handle_starttag(self, tag, attrs):
        cls = self._attr(attrs, "class")
        void = tag in _VOID
        if not void:
            self.stack.append(tag)
        if tag in _SKIP_TEXT and not void:
            self.skip += 1
        if tag == "article" and not self.article_done:
            self.article_depth += 1
        # listing list / items
        if tag == "ul":
            if self.in_listing:
                self.in_listing += 1
            elif not self.listing_found and (
                    self.listing_ul_class is None or cls == self.listing_ul_class):
                self.listing_found = True
                self.in_listing = 1
        elif tag == "li" and self.in_listing:
            if self.li_depth == 0:
                self.item = {"title": None, "href": "", "court": None, "citation": None,
                             "date": None, "_title_found": False}
            self.li_depth += 1
        if self.item is not None and self.li_depth:
            if self.item_field:
                self.item_field_depth += 1 if not void else 0
            elif tag == "span" and cls in (TITLE_CLASS, COURT_CLASS, CITATION_CLASS):
                name = {TITLE_CLASS: "title", COURT_CLASS: "court", CITATION_CLASS: "citation"}[cls]
                if self.item.get("_" + name + "_found"):
                    pass
                else:
                    self.item["_" + name + "_found"] = True
                    self.item[name] = []
                    self.item_field = name
                    self.item_field_depth = 1
            elif tag == "time" and cls == DATE_CLASS and not self.item.get("_date_found"):
                self.item["_date_found"] = True
                self.item["date"] = self._attr(attrs, "datetime")
            if tag == "a" and self.item_field == "title" and not self.item.get("_href_found"):
                self.item["_href_found"] = True
                self.item["href"] = self._attr(attrs, "href") or ""
        # pagination
        if tag == "nav" and not self.nav_found and self._attr(attrs, "aria-label") == PAGINATION_LABEL:
            self.nav_found = True
            self.in_pagination = 1
        elif tag == "nav" and self.in_pagination:
            self.in_pagination += 1
        if tag == "a" and self.in_pagination and cls and PAGE_LINK_CLASS in cls.split():
            self.page_link = []
        # cells
        if tag == "div" and self.cell_container_class is not None:
            if self.in_container:
                self.in_container += 1
            elif not self.container_found and cls == self.cell_container_class:
                self.container_found = True
                self.in_container = 1
        if tag == self.cell_tag and self.in_container:
            if self.cell_depth == 0:
                self.cell_parts = []
            self.cell_depth += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in _VOID:
            return
        if tag in self.stack:
            while self.stack and self.stack.pop() != tag:
                pass
        if tag in _SKIP_TEXT and self.skip:
            self.skip -= 1
        if tag == "article" and self.article_depth and not self.article_done:
            self.article_depth -= 1
            if self.article_depth == 0:
                self.article_done = True
        if self.item is not None and self.item_field:
            self.item_field_depth -= 1
            if self.item_field_depth == 0:
                self.item[self.item_field] = "".join(self.item[self.item_field])
                self.item_field = None
        if tag == "li" and self.in_listing and self.li_depth:
            self.li_depth -= 1
            if self.li_depth == 0 and self.item is not None:
                self._finish_item()
        if tag == "ul" and self.in_listing:
            self.in_listing -= 1
        if tag == "a" and self.page_link is not None:
            self.page_links.append("".join(self.page_link))
            self.page_link = None
        if tag == "nav" and self.in_pagination:
            self.in_pagination -= 1
        if tag == self.cell_tag and self.cell_depth:
            self.cell_depth -= 1
            if self.cell_depth == 0:
                self.cells.append("".join(self.cell_parts))
        if tag == "div" and self.cell_container_class is not None and self.in_container:
            self.in_container -= 1

    def _finish_item(self):
        it = self.item
        if self.item_field:
            it[self.item_field] = "".join(it[self.item_field])
            self.item_field = None
        self.items.append({k: it[k] for k in ("title", "href", "court", "citation", "date")})
        self.item = None

    def handle_data(self, data):
        if self.skip:
            return
        if self.article_depth and not self.article_done:
            self.article_parts.append(data)
        if self.item_field and self.item is not None:
            stripped = data.strip()
            if stripped:
                self.item[self.item_field].append(stripped)
        if self.page_link is not None:
            stripped = data.strip()
            if stripped:
                self.page_link.append(stripped)
        if self.cell_depth:
            self.cell_parts.append(data)

    def result(self) -> dict:
        if self.item is not None:
            self._finish_item()
        return {
            "article": "".join(self.article_parts) if (self.article_done or self.article_depth) else None,
            "items": self.items,
            "has_pagination": self.nav_found,
            "page_links": self.page_links,
            "cells": self.cells,
        }


def parse_html(html: str | None, listing_ul_class: str | None = LISTING_UL_CLASS,
               cell_tag: str = "td", cell_container_class: str | None = CELL_CONTAINER_CLASS) -> dict | None:
    """Parse one page (plain Python; also used by unit tests)."""
    if html is None:
        return None
    p = _PageParser(listing_ul_class, cell_tag, cell_container_class)
    p.feed(html)
    p.close()
    return p.result()


def page_parser(listing_ul_class: str | None = LISTING_UL_CLASS, cell_tag: str = "td",
                cell_container_class: str | None = CELL_CONTAINER_CLASS):
    """An Arrow-batched UDF ``html -> PARSED_PAGE`` with the given selectors."""

    @F.pandas_udf(PARSED_PAGE)
    def _parse(htmls: pd.Series) -> pd.DataFrame:
        rows = [parse_html(h, listing_ul_class, cell_tag, cell_container_class) or
                dict.fromkeys(PARSED_PAGE.names) for h in htmls]
        return pd.DataFrame(rows, columns=PARSED_PAGE.names)

    return _parse.asNondeterministic()  # else a filter on its result makes Spark parse again


def parse_pages(pages: DataFrame, listing_ul_class: str | None = LISTING_UL_CLASS,
                cell_tag: str = "td", cell_container_class: str | None = CELL_CONTAINER_CLASS,
                html_col: str = "html") -> DataFrame:
    """Add a ``parsed`` struct column; the UDF runs once per page."""
    udf = page_parser(listing_ul_class, cell_tag, cell_container_class)
    return pages.withColumn("parsed", udf(F.col(html_col)))


def article_text(pages: DataFrame) -> DataFrame:
    """Text of the first <article> (NULL when the page has none)."""
    p = parse_pages(pages.select("page_id", "url", "html"))
    return p.select("page_id", "url", F.col("parsed.article").alias("text_raw"))


def page_extent(pages: DataFrame) -> DataFrame:
    """Pagination extent per listing page: 0 without pagination, 1 where no link names a page."""
    p = parse_pages(pages.select("page_id", "url", "html"))
    numbers = F.transform("parsed.page_links", lambda x: F.regexp_extract(x, r"^Page\s*([0-9]+)\s*$", 1).try_cast("int"))
    extent = F.when(F.col("parsed.has_pagination"), F.coalesce(F.array_max(numbers), F.lit(1))).when(
        ~F.col("parsed.has_pagination"), F.lit(0))
    return p.select("page_id", "url", extent.alias("max_page"))


def listing_items(pages: DataFrame, base_url: str = BASE_URL,
                  listing_ul_class: str | None = LISTING_UL_CLASS) -> DataFrame:
    """One row per listing item with its position on the page."""
    p = parse_pages(pages.select("page_id", "url", "html"), listing_ul_class=listing_ul_class)
    items = p.select("page_id", F.posexplode("parsed.items").alias("pos", "it"))
    return items.select(
        "page_id", "pos", F.col("it.title").alias("title"),
        F.concat(F.lit(base_url), F.col("it.href")).alias("url"),
        F.col("it.court").alias("court"), F.col("it.citation").alias("citation"),
        F.col("it.date").alias("date"))


def table_cells(pages: DataFrame, cell_tag: str = "td",
                cell_container_class: str | None = CELL_CONTAINER_CLASS) -> DataFrame:
    """Every cell's text in document order: (page_id, pos, text)."""
    p = parse_pages(pages.select("page_id", "html"), cell_tag=cell_tag,
                    cell_container_class=cell_container_class)
    return p.select("page_id", F.posexplode("parsed.cells").alias("pos", "text"))


# ---- P3 positional selectors ----------------------------------------------

def _first_alpha(c: Column) -> Column:
    return c.rlike(r"^\p{L}")


SELECTORS = {
    # name: (modulus, remainder, excluded texts, require first letter, drop non-letter last char)
    "bench": (2, 1, ["Name"], True, False),
    "district_magistrate": (3, 0, ["Judge", "Name"], False, False),
    "high_court": (2, 0, ["Name"], True, False),
    "judge_advocate": (2, 0, ["Judge", "Name"], True, False),
    "circuit_district": (3, 0, ["Judge", "Name"], False, True),
}


def _selected(selector: str) -> tuple[Column, Column]:
    """(which cells, the name) of one selector, over ``pos`` and ``text``."""
    mod, rem, excluded, first_alpha, drop_last = SELECTORS[selector]
    t = F.col("text")
    cond = (F.pmod(F.col("pos"), F.lit(mod)) == rem) & ~t.isin(*excluded) & (F.length(t) > 0)
    if first_alpha:
        cond = cond & _first_alpha(t)
    name = F.when(~t.rlike(r"\p{L}$"), F.expr("substring(text, 1, length(text) - 1)")).otherwise(t) if drop_last else t
    return cond, name


def select_cells(cells: DataFrame, selector: str) -> DataFrame:
    """P3a–e: pick judge names from flattened table cells by position.

    Blank cells are skipped (the original would fail on them).
    """
    cond, name = _selected(selector)
    return cells.where(cond).select("page_id", "pos", name.alias("judge_name"))


def gather_judges(cells: DataFrame, page_selectors: DataFrame | None = None) -> DataFrame:
    """What the selectors pick, in one pass over the cells.

    ``page_selectors(page_id, selector)`` says which selector applies to which
    page (a small config table); without it every selector runs on every page.
    """
    picks = [F.when(cond, F.struct(F.lit(n).alias("selector"), name.alias("judge_name")))
             for n in SELECTORS for cond, name in [_selected(n)]]
    found = cells.select("page_id", "pos", F.explode(F.array(*picks)).alias("p")).where(F.col("p").isNotNull()).select(
        "page_id", "pos", "p.judge_name", "p.selector")
    return found if page_selectors is None else found.join(page_selectors, ["page_id", "selector"], "left_semi").select(found.columns)
