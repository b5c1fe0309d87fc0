import random

import pytest
from pyspark.sql import functions as F

from casegrid.functions.similarity import jaro_winkler, token_set_ratio
from casegrid.operators import resolve as RS


def _match(spark, names, judges, **options):
    n = spark.createDataFrame([(x,) for x in names], "name string")
    j = spark.createDataFrame([(x,) for x in judges], "judge_name string")
    return {r["name"]: (r["matched_name"], r["score"]) for r in RS.match_judges(n, j, **options).collect()}


def _brute(names, judges, threshold):
    best = {}
    for n in set(names):
        scored = [(n != j, -token_set_ratio(n, j), j) for j in set(judges) if token_set_ratio(n, j) >= threshold]
        if scored:
            _, score, judge = min(scored)
            best[n] = (judge, -score)
    return best


def test_fuzzy_judge_vectors(spark):
    got = _match(spark, ["Justice James", "John", "Judge John"], ["James", "Terrence"])
    assert {k: v[0] for k, v in got.items()} == {"Justice James": "James", "John": "John", "Judge John": "John"}
    # the very name wins over a smaller one that scores as high
    assert _match(spark, ["Lee Smith"], ["Lee Smith", "Anna Lee Smith"])["Lee Smith"] == ("Lee Smith", 100.0)


@pytest.mark.parametrize("threshold", [95, 85, 70, 55])
def test_fuzzy_judges_like_brute_force(spark, threshold):
    rng = random.Random(threshold)
    parts = ["Anna", "Ana", "Lee", "Smith", "Smyth", "Lord", "Justice", "Jones", "Joness", "O'Neil", "ONeil", "de", "la", "Fontaine", "QC", "Ünal"]
    judges = {" ".join(rng.sample(parts, rng.randrange(1, 4))) for _ in range(40)} | {f"Supplier#{i:09d}" for i in range(30)}
    judges |= {" ".join(f"t{i}" for i in range(14)), "x" * 90}
    names = {f"{j}1" for j in list(judges)[:20]} | {f"Judge {j} KC" for j in list(judges)[20:40]} | {" ".join(rng.sample(parts, rng.randrange(1, 5))) for _ in range(40)}
    names |= {"", " ", " ".join(f"t{i}" for i in range(13)) + " u", "x" * 88 + "yx", "Supplier #000000001", "Lord  Lee", "Supplier#00000001", "upplier#000000002"}
    got = _match(spark, sorted(names), sorted(judges), threshold=threshold)
    want = _brute(names, judges, threshold)
    assert {n: g for n, g in got.items() if g[1] is not None} == want


def test_a_threshold_without_bounds_is_refused(spark):
    with pytest.raises(ValueError, match="threshold"):
        _match(spark, ["a"], ["b"], threshold=30)


@pytest.mark.parametrize("threshold", [0.9, 0.8, 0.6])
def test_similar_pairs_like_brute_force(spark, threshold):
    words = ["Contract", "Contracts", "Contact", "Fraud", "Frauds", "Martha", "Marhta", "Dixon", "Dicksonx", "Duane", "Dwayne", "A", "Ab", "", "Law of tort", "Tort law"]
    tags = spark.createDataFrame([(s, w) for s in ("p", "q") for w in words] + [("r", "Fraud"), ("s", "Frauds")], "scope_id string, tag string")
    got = {(r["scope_id"], r["tag"], r["similar_tag"]) for r in RS.similar_tag_pairs(tags, threshold).collect()}
    assert got == {(s, a, b) for s in ("p", "q") for a in words for b in words if a != b and jaro_winkler(a, b) > threshold}


def test_tag_merge_synonym_and_similarity(spark):
    tags = spark.createDataFrame(
        [("p", 0, 0, "Scarlet"), ("p", 0, 1, "Red"),
         ("q", 0, 0, "Able"), ("q", 0, 1, "Unable"), ("q", 1, 0, "Red"), ("q", 1, 1, "Red"),
         ("r", 0, 0, "Patent"), ("r", 1, 0, "Patents")],
        "scope_id string, case_ord long, tag_ord long, tag string")
    syn = spark.createDataFrame([("scarlet", "red"), ("red", "scarlet")], "word string, lemma string")
    out = {(r["scope_id"], r["case_ord"], r["tag_ord"]): r["canonical"]
           for r in RS.canonical_tags(tags, syn).collect()}
    assert out[("p", 0, 0)] == "Red" and out[("p", 0, 1)] == "Red"
    assert [out[("q", 0, 0)], out[("q", 0, 1)], out[("q", 1, 0)]] == ["Able", "Unable", "Red"]
    assert out[("r", 0, 0)] == out[("r", 1, 0)] == "Patents"


def test_replace_in_array(spark):
    df = spark.createDataFrame([(["a", "b", "a"],)], "x array<string>")
    assert df.select(RS.replace_in_array(F.col("x"), "a", "c")).first()[0] == ["c", "b", "c"]


def test_no_candidates_where_no_judge_or_no_name_is(spark, monkeypatch):
    def never(*args):
        raise AssertionError("candidates were asked for")

    monkeypatch.setattr(RS, "judge_candidates", never)
    assert _match(spark, ["Judge James CBE", None], []) == {"Judge James CBE": ("James", None)}
    assert _match(spark, [None], ["James"]) == {}
    with pytest.raises(ValueError, match="threshold"):
        _match(spark, [], [], threshold=20)


def test_merge_of_tags_goes_on_through_replaced_ones(spark):
    """A tag that others have become gives way itself, and a tag without edges stays."""
    nodes = [("a", ["c"], []), ("b", [], ["a", "c"]), ("c", [], ["d", "e"]), ("d", ["zz"], ["e"]), ("e", [], []), ("f", ["a"], ["e", "d"])]
    df = spark.createDataFrame([(nodes,)], "nodes array<struct<tag:string,syn:array<string>,sim:array<string>>>")
    now = [n[0] for n in nodes]
    for tag, syn, sim in nodes:
        to = next((t for t in now if t in syn), None) or next((t for t in now if t in sim), None) or tag
        now = [to if t == tag else t for t in now]
    assert df.select(RS._merged(F.col("nodes")).alias("m")).first()["m"] == now
