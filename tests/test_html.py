import pytest
from pyspark.sql import functions as F

from casegrid.sources import html as HT


def _item(path, title, court, citation, date):
    parts = [f'<span class="{HT.TITLE_CLASS}"><a href="{path}">{title}</a></span>']
    parts += [f'<span class="{HT.COURT_CLASS}">\n{court} </span>'] if court else []
    parts += [f'<span class="{HT.CITATION_CLASS}">{citation}</span>', f'<time class="{HT.DATE_CLASS}" datetime="{date}">then</time>']
    return f"<li>{''.join(parts)}</li>"


LISTING = (f'<ul><li>menu</li></ul><ul class="{HT.LISTING_UL_CLASS}">' + _item("/x/1", "Alder &amp; Co v Birch", "Court of Ash", "[2011] X 1", "1 May 2011")
           + _item("/x/2", "Re <i>Cedar</i>", None, "[2012] X 2", "2 May 2012, midnight") + "</ul>")

CELLS = ["Name", "Judge 1", "Judge Dredd", "Judge 2", "12345", "Judge 3"]


def test_listing_items():
    out = HT.parse_html(LISTING)
    assert out["items"] == [
        {"title": "Alder & Co v Birch", "href": "/x/1", "court": "Court of Ash", "citation": "[2011] X 1", "date": "1 May 2011"},
        {"title": "ReCedar", "href": "/x/2", "court": None, "citation": "[2012] X 2", "date": "2 May 2012, midnight"}]
    assert not out["has_pagination"] and out["article"] is None


def test_article_and_pagination(spark):
    links = "".join(f'<a class="{HT.PAGE_LINK_CLASS}">{t}</a>' for t in ("Page 2", "Page 693", "Next", "Page x"))
    nav = f'<nav aria-label="{HT.PAGINATION_LABEL}">'
    pages = [f"{nav}{links}</nav><article><h1>T</h1><script>x()</script><p>a &amp; b</p></article><article>second</article>",
             f"{nav}</nav>", "<p>none</p>", None]
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    assert [r["max_page"] for r in HT.page_extent(df).orderBy("page_id").collect()] == [693, 1, 0, None]
    assert [r["text_raw"] for r in HT.article_text(df).orderBy("page_id").collect()] == ["Ta & b", None, None, None]


def test_cell_selectors(spark):
    cells = spark.createDataFrame([(1, i, t) for i, t in enumerate(CELLS)], "page_id long, pos int, text string")
    want = {"bench": ["Judge 1", "Judge 2", "Judge 3"], "district_magistrate": ["Judge 2"], "high_court": ["Judge Dredd"],
            "judge_advocate": ["Judge Dredd"], "circuit_district": ["Judge "]}
    got = {name: [r["judge_name"] for r in HT.select_cells(cells, name).orderBy("pos").collect()] for name in HT.SELECTORS}
    assert got == want
    everything = HT.gather_judges(cells).collect()
    assert sorted((r["selector"], r["judge_name"]) for r in everything) == sorted((k, v) for k, vs in want.items() for v in vs)
    chosen = spark.createDataFrame([(1, "bench"), (2, "high_court")], "page_id long, selector string")
    assert sorted(r["judge_name"] for r in HT.gather_judges(cells, chosen).collect()) == want["bench"]


def test_article_udf_on_pages(spark, sf_small):
    from casegrid.sources.tables import read_table
    pages = read_table(spark, sf_small, "pages")
    out = HT.article_text(pages)
    assert out.count() == pages.count()
    assert out.where("text_raw is null").count() == 0


@pytest.mark.parametrize("name,nodes", [("table_cells", 1), ("judges_from_cells", 1), ("party_rows", 1), ("quarantine", 1), ("parse_replies", 1)])
def test_each_python_function_is_planned_once(spark, sf_small, name, nodes):
    import __spark_entry__ as E
    plan = E.queries()[name](spark, sf_small).where(F.lit(True))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == nodes, plan
