"""The pipeline against brute force, stage by stage, and on odd rows."""

import duckdb
import pyarrow as pa
import pytest
from llm_rows import make
from test_llm_text_operators import brute_groups, brute_hits, brute_lines

import corpus_pipeline as P
from casegrid.llm import common, mixing, quality
from casegrid.llm import registry as R
from casegrid.llm.oracles import OP10

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_are_the_asked_ones():
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "mixing_to_weights"]


def test_run_like_brute_force(spark, sf_small, tmp_path):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select(DOCUMENTS).collect()]
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    good = {r["doc_id"] for r in R.op1_quality_classifier(spark, sf_small).collect() if r["predicted"]}
    rows = [r for r in docs if r[0] in good]
    lines = dict(brute_lines([r[:2] for r in rows], 10))
    rows = [(r[0], lines[r[0]], *r[2:4], len(lines[r[0]])) for r in rows]
    least = set(brute_groups([r[:2] for r in rows]).values())
    rows = [r for r in rows if r[0] in least]
    rows = [r for r in rows if not brute_hits(r[1], items, 10)[1]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    want = con.execute(f"SELECT d.doc_id, d.text, d.n_chars, m.domain, m.epoch FROM ({OP10}) m JOIN documents d USING (doc_id)").fetchall()
    got = P.run(spark, sf_small)
    assert got.columns == [*DOCUMENTS, "domain", "epoch"]
    assert sorted(map(tuple, got.select("doc_id", "text", "n_chars", "domain", "epoch").collect())) == sorted(want) and len(want) > 50


@pytest.fixture
def tables(spark, tmp_path, odd_rows):
    """labels and benchmark beside which the stages run."""
    def write(name, rows, ddl):
        spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / f"{name}.parquet"))

    write("labels", [(4, 1, 0), (5, 0, 1), (9, 1, 0), (10, None, None), (None, 1, 0), (7, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    write("benchmark", [(1, odd_rows[4][1]), (None, "a b"), (2, None)], "item_id long, text string")
    return str(tmp_path)


def test_stages_on_odd_rows(spark, odd, tables, tmp_path):
    for name, stage in P.STAGES:
        got = stage(spark, odd, tables)
        if name != "mixing_to_weights":
            assert got.columns == odd.columns
        path = str(tmp_path / "out" / name)
        got.write.parquet(path)
        ids = [r["doc_id"] for r in spark.read.parquet(path).collect()]
        if name == "line_dedup":
            assert len(ids) == odd.count()
        if name == "simhash_near_dedup":
            assert ids.count(5) == 1 and 1 in ids and 2 not in ids and 3 not in ids
        if name == "benchmark_decontamination":
            assert 5 not in ids and 10 not in ids and 4 in ids


def test_stages_on_an_empty_table(spark, none, tables):
    for _, stage in P.STAGES:
        assert stage(spark, none, tables).count() == 0


def test_columns_of_the_mix_replace_clashing_ones(spark, tables):
    docs = make(spark, [(1, "a b c", "en", "src1")])
    got = P.STAGES[-1][1](spark, docs, tables)
    assert got.columns.count("domain") == 1 and "epoch" in got.columns


def test_a_core_needs_one_python_worker(spark, odd, monkeypatch):
    """Workers outlive their stage, so two Python steps in a row, or tables made from Python rows, add to all later stages."""
    labelled = odd.selectExpr("doc_id % 2 AS label", "text")
    assert quality.moments(labelled)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    plans = []
    monkeypatch.setattr(mixing, "staged", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or common.staged(df, name))
    assert R.mixed(common.staged(odd, "odd")).count() > 0
    assert plans and not any("ExistingRDD" in p or "RDDScan" in p for p in plans)


def test_texts_come_in_slices_as_in_one(monkeypatch):
    texts = pa.array([None, "a", "", "\u00e9 b", None])
    monkeypatch.setattr(common, "TEXTS_AT_ONCE", 2)
    found = common.as_bytes(texts)
    assert iter(found) is found and list(found) == [b"", b"a", b"", "\u00e9 b".encode(), b""]
