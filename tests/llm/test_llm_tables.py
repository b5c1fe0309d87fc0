"""Robust rules, URL filter, WARC, wrappers, language model and mixing."""

import base64
import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import make, words
from pyspark.sql import functions as F

from casegrid.llm import language_model as M
from casegrid.llm import mixing as X
from casegrid.llm import registry as R
from casegrid.llm import robust_rules as B
from casegrid.llm import url_filter as U
from casegrid.llm import warc as C
from casegrid.llm import wrappers as W

# -- robust rules


def brute_counts(text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    three = list(zip(w, w[1:], w[2:], strict=False))
    seen = Counter(three)
    covered = {i + k for i, t in enumerate(three) if seen[t] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("least", [B.MIN_ROWS, 3])
def test_base_counts_and_verdicts(spark, odd, none, odd_rows, least):
    got = B.judge(odd, min_rows=least).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(((r["id"], *[r[n] for n in names]) for r in got), key=str) == sorted(((r[0], *brute_counts(r[1])) for r in odd_rows), key=str)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert B.judge(none).count() == 0


def test_counts_of_repeats(spark):
    cases = ["", "a b", "a b c", "a a a a", "a b c a b c", "x a b c y a b c z", "a\na\n \na", "# $a| b"]
    got = make(spark, list(enumerate(cases))).select("doc_id", B.base_counts(F.col("text")).alias("c")).select("doc_id", "c.*").collect()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_counts(cases[r["doc_id"]])


def test_outliers_go_and_plain_texts_stay(spark):
    rng = random.Random(6)
    plain = [(i, " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(rng.randrange(60, 400)))) for i in range(300)]
    odd = [(1000 + i, " ".join(f"{w}###" for w in t.split())) for i, t in plain[:60]]
    got = {r["id"]: r["kept"] for r in B.judge(make(spark, plain + odd)).collect()}
    assert not any(got[i] for i, _ in odd) and all(got[i] for i, _ in plain)


@pytest.mark.parametrize("share", [0.3, 0.45])
def test_junk_of_nearly_half_a_source_goes(spark, share):
    rng = random.Random(13)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(rng.randrange(60, 400))) for _ in range(400)]
    junk = int(400 * share)
    rows = [(i, " ".join(f"{w}#!" for w in t.split()) if i < junk else t) for i, t in enumerate(texts)]
    got = {r["id"]: r["kept"] for r in B.judge(make(spark, rows)).collect()}
    assert not any(got[i] for i in range(junk)) and all(got[i] for i in range(junk, 400))


def test_small_sources_are_judged_too(spark):
    rng = random.Random(14)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(rng.randrange(60, 400))) for _ in range(230)]
    junk = [" ".join(f"{w}#!" for w in t.split()) for t in texts[200:]]
    rows = [(i, t, "en", "large") for i, t in enumerate(texts[:200])] + [(1000 + i, t, "en", "rare") for i, t in enumerate(junk)]
    rows += [(2000 + i, t, "fr", "alone") for i, t in enumerate(junk[:5])] + [(3000, texts[200], "fr", "alone")]
    got = {r["id"]: r["kept"] for r in B.judge(make(spark, rows)).collect()}
    assert all(got[i] == (i < 1000 or i == 3000) for i in got) and len(got) == 236


def test_estimate_like_numpy(spark):
    """The concentration steps end where numpy's end, from the same start."""
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (400, B._D)) @ rng.normal(0, 1, (B._D, B._D))
    x[:60] += 12
    rows = spark.createDataFrame([(0, "en", "s", v.tolist()) for v in x], "level int, lang_key string, source_key string, x array<double>")
    least = np.diag([c[2] ** 2 for c in B.COORDINATES])
    estimate = B._start(rows)
    first = estimate.first()
    mean, inverse = np.array(first["mean"]), np.array(first["inverse"]).reshape(B._D, B._D)
    assert np.allclose(mean, np.median(x, axis=0), atol=0.1)
    for _ in range(3):
        d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
        place = np.floor(np.log(d + 1e-9) * 64)
        inner = x[place <= np.sort(place)[math.ceil(0.75 * len(x)) - 1]]
        mean, inverse = inner.mean(axis=0), np.linalg.inv(np.cov(inner.T, bias=True) + least)
        estimate = B.staged(B._estimated(B._closest(rows, estimate, 0.75), 1.0), "t")
        got = estimate.first()
        assert np.allclose(got["mean"], mean) and np.allclose(np.array(got["inverse"]).reshape(B._D, B._D), inverse)


# -- URL filter


def brute_rule(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(h + p), len(h), a == "block", h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def test_rules_like_brute_force(spark):
    rng = random.Random(8)
    rules = [("net", "/", "block"), ("a.net", "/en", "allow"), ("b.a.net", "", "allow"), ("org", "/fr/x", "block"), ("org", "/fr/x", "allow"), ("é.de", "/", "block")]
    urls = [None, "", "x", "http://", "://a.net/", "http://A.NET", "http://a.net/en?x#y", "http://net./", "http://é.de/ü", "http://x..net/q", "HTTP://b.a.net#f/"]
    urls += [f"http://{'.'.join(rng.choices(['a', 'b', 'net', 'org', 'ORG'], k=rng.randrange(1, 6)))}{rng.choice(['', '/', '/en/', '/fr/x?', '/fr/', '?u=http://a.net/'])}"
             for _ in range(200)]
    pages = spark.createDataFrame([(i, u, "h", "r", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, verdict string")
    got = U.judge_urls(pages, U.rules_table(spark, rules)).collect()
    assert {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == {i: brute_rule(u, rules) for i, u in enumerate(urls)}
    assert U.judge_urls(pages.limit(0), U.rules_table(spark, rules)).count() == 0
    assert {r["verdict"] for r in U.judge_urls(pages, U.rules_table(spark, rules).limit(0)).collect()} == {"allow"}


def test_a_host_of_very_many_labels(spark):
    """Only suffixes as long as those of the rules are made."""
    hosts = [".".join(["a"] * 100_000) + ".net", ".".join(["b"] * 100_000) + ".org"]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts)], "page_id long, url string")
    got = U.judge_urls(pages, U.rules_table(spark, [("net", "/", "block"), ("a.a.net", "/x", "allow"), ("b.a.net", "/", "block")])).collect()
    assert {r["row"]["page_id"]: (r["rule"], r["verdict"]) for r in got} == {0: ("a.a.net/x", "allow"), 1: (None, "allow")}


# -- WARC


@pytest.mark.parametrize("chunk", [C.CHUNK, 7])
def test_round_trip(spark, chunk):
    texts = [None, "", "a", "WARC/1.1\r\n\r\nx\r\n\r\n", "é" * 50, "a", "b" * 100, "", "c\r\n\r\n"]
    rows = [(i if i != 3 else None, f"http://h/{i}\r\nX: y" if i != 1 else None, t, "mine") for i, t in enumerate(texts)]
    rows.append((6, "http://h/6", "b" * 100, "mine"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string").repartition(3)
    manifest = C.write_archives(pages, chunk=chunk)
    back = C.read_archives(manifest, chunk=chunk).collect()
    assert all(r["last"] == (r["bytes_so_far"] == r["length"]) for r in back)
    records: dict = {}
    for r in sorted(back, key=lambda r: r["chunk"]):
        assert len(r["data"] or b"") <= chunk
        records.setdefault(r["record"], []).append(r)
    assert len(records) == len(rows)
    for chunks in records.values():
        page = chunks[0]["page_id"]
        if chunks[0]["record_type"] == "response":
            assert b"".join(bytes(r["data"]) for r in chunks) == (texts[3 if page is None else page] or "").encode()
    last = [r for r in back if r["last"]]
    assert len(last) == len(rows)
    for r in last:
        text = (texts[r["page_id"]] if r["page_id"] is not None else texts[3]) or ""
        assert r["bytes_so_far"] == len(text.encode()) and bytes(r["sha1_so_far"]) == hashlib.sha1(text.encode()).digest()
    assert {r["page_id"]: r["refers_to"] for r in last if r["record_type"] == "revisit"} == {1: 0, 7: 0, 5: 2}
    assert C.read_archives(C.write_archives(pages.limit(0))).count() == 0
    none_equal = C.read_archives(C.write_archives(pages, min_bytes=2)).where("record_type = 'revisit'").count()
    assert none_equal == 0


def test_a_damaged_payload_is_an_error(spark, tmp_path):
    import gzip

    pages = spark.createDataFrame([(1, "http://h/", "good text")], "page_id long, url string, html string")
    manifest = C.write_archives(pages)
    path = tmp_path / "x.warc.gz"
    path.write_bytes(gzip.compress(gzip.open(manifest.first()["path"].removeprefix("file:")).read().replace(b"good", b"evil")))
    with pytest.raises(ValueError, match="digest"):
        list(C._records(str(path), 100, True))


def test_base32(spark):
    digests = [hashlib.sha1(bytes([i])).hexdigest() for i in range(50)]
    got = spark.createDataFrame([(d,) for d in digests], "h string").select("h", R.base32(F.col("h")).alias("b")).collect()
    assert all(base64.b32encode(bytes.fromhex(r["h"])).decode() == r["b"] for r in got)


# -- wrappers


def page(i, extra="", body=None):
    body = body if body is not None else f"<h1>Title {i}</h1><p>One <b>bold {i}</b>\n text &amp; more<p>Two {i}<br>x"
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a = '</p><p>no';</script></head><body>"
            f"<header><p>Site</p></header><nav><ul><li><a href=/a>Menu</a></ul></nav><!-- <p>no</p> --><div class='ad-box'><p>Buy {i}</p></div>"
            f"<div id=cookie-notice>We use cookies</div><article>{body}</article><aside><p>Side</p></aside>{extra}"
            f"<form><p>Name<input></p></form><div class=comments><p>Reader {i}</p></div><footer>&copy; me</footer></body></html>")


def test_article_of_every_page(spark):
    rows = [(i, f"http://h{i % 3}.org/{i}", page(i, "<section class=related><p>See</p></section>" * (i % 2)), "x") for i in range(30)]
    rows += [(40, None, None, "x"), (41, "nothing", "", "x"), (42, "http://solo.org/", page(42, body="<p>Only</p>"), "x"), (43, "http://z/", "<p>bare < text", "x"),
             (44, "http://deep/", "<div>" * 3000 + "deep" + "</div>" * 3000, "x"), (45, "http://junk/", "a<b <c> </p></div>'\"<p x='>q", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string").repartition(4)
    got = {r["row"]["page_id"]: r["main_text"] for r in W.extract_text(pages).collect()}
    assert len(got) == len(rows)
    for i in range(30):
        assert got[i] == f"Title {i}\n\nOne bold {i} text & more\n\nTwo {i} x"
    assert (got[40], got[41], got[42], got[44]) == ("", "", "Only", "deep") and got[43].startswith("bare")
    assert W.extract_text(pages.limit(0)).count() == 0


def test_given_pages_like_plain_extraction(spark, sf_small):
    got = {r["page_id"]: r for r in R.op2_html_extraction(spark, sf_small).collect()}
    for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        text = "\n\n".join(b for b in blocks if b)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (text, len(text))


def test_article_without_its_tag():
    pages = [f"<body><div class=top><a href=/>Home</a></div><div><div><h2>H {i}</h2>" + f"<p>long text {i} {'word ' * 40}</p>" * (1 + i % 3) +
             "<ul><li><a>x</a><li><a>y</a></ul></div><div class=more><p>short</p></div></div></body>" for i in range(6)]
    text = read_all(pages)[0]
    assert text.startswith("H 0\n\nlong text 0 word") and "Home" not in text and "x" not in text.split() and "short" not in text


def read_all(pages):
    folded = W.page_wrapper(pages[0])
    for p in pages[1:]:
        folded = W._merge(folded, W.page_wrapper(p))
    reader = W.Reader(W.reading(folded))
    return [reader.read(p) for p in pages]


@pytest.mark.parametrize("tag", ["article", "main", "section"])
@pytest.mark.parametrize("around", ["<body class='single has-sidebar'>{}</body>", "<body class=header-fixed><form action=x>{}</form></body>",
                                    "<body><div id=page-with-nav>{}</div></body>", "<body class=comments-open>{}</body>"])
def test_names_around_the_whole_page(tag, around):
    rest = "<nav><p>Some menu</p></nav><div class=sidebar><p>Side {}</p></div><div class=comments><article class=comment><p>Reader {}</p></article></div>"
    pages = [f"<{tag}><h1>H {i}</h1><p>Text {i} {'word ' * 60}</p></{tag}>{rest.replace('{}', str(i))}" for i in range(8)]
    wrapped = [around.replace("{}", p) if i % 4 == 0 else f"<body>{p}</body>" for i, p in enumerate(pages)]
    assert read_all(wrapped) == [f"H {i}\n\nText {i} {' '.join(['word'] * 60)}" for i in range(8)]


def test_all_names_are_read():
    many = "col-md-4 mt-2 p-3 d-flex"
    pages = [f"<body><div class='{many} shadow articleBody'><p>Text {i} {'word ' * 9}</p><div class='{many} border advert'><p>Buy {i}</p></div></div>"
             f"<div class='{many} sidebar'><p>Side {i} {'other ' * 30}</p></div></body>" for i in range(3)]
    assert read_all(pages) == [f"Text {i} {' '.join(['word'] * 9)}" for i in range(3)]
    # names that say nothing and differ between the pages don't make further signs
    assert W._sign("div", f" class='{many} tag-x'") == W._sign("div", f" class='{many} tag-y'")


@pytest.mark.parametrize("n", [3, 150, 3000])
def test_deep_tags_close_only_themselves(n):
    page = f"<body><div id=wrap><article><p>One</p>{'<div>' * n}Two{'</div>' * n}<p>Three</p></article><p>No</p></div></body>"
    assert read_all([page]) == ["One\n\nTwo\n\nThree"]
    page = f"<body><article>{'<div>' * n}<p>One<nav><p>Menu</p></nav><p>Two<div class=comments><div>Reader</div></div>Three<section>Four</article><p>No"
    assert read_all([page]) == ["One\n\nTwo\n\nThree\n\nFour"]


@pytest.mark.parametrize("head", ["<head><title>t</title><meta x><script>var a = '<p>no</p>';</script>", "<html><head><title>t</title>\n<noscript><img><p>no</p></noscript>\n",
                                  "<head><style>p{}</style></head><body>", "<head><title>t</title><body class=x>"])
def test_a_head_without_its_end(head):
    assert read_all([f"{head}<article><p>One</p>Two</article>"]) == ["One\n\nTwo"]
    assert read_all([f"{head}<p>One</p>"]) == ["One"] and read_all([f"{head}One<p>Two"]) == ["One\n\nTwo"]


def test_fixed_parts_without_names_are_template():
    imprint = "<div><p>" + "imprint " * 60 + "</p></div>"
    pages = [f"<body><div><p>All about things since 1990.</p><div><h2>H {i}</h2><p>Text {i} {'word ' * 20}</p><p>Subscribe for free.</p>{'<p>Own</p>' * (i == 2)}</div></div>"
             f"{imprint}</body>" for i in range(6)]
    want = [f"H {i}\n\nText {i} {' '.join(['word'] * 20)}" + "\n\nOwn" * (i == 2) for i in range(6)]
    for n in (2, 3, 4, 6):
        assert read_all(pages[:n]) == want[:n]
    # a marked article keeps all of its texts, fixed or not
    marked = [p.replace("<div><h2>", "<article><h2>").replace(f"</div></div>{imprint}", f"</article></div>{imprint}") for p in pages]
    full = [w.replace("\n\nOwn", "") + "\n\nSubscribe for free." + "\n\nOwn" * (i == 2) for i, w in enumerate(want)]
    for n in (1, 2, 3, 4, 6):
        assert read_all(marked[:n]) == full[:n]
    # copies of a page keep their text, and one page alone doesn't tell what is fixed
    for tag in ("article", "div"):
        assert all("word" in t for t in read_all([f"<{tag}><p>" + "word " * 50 + f"</p></{tag}>"] * 9))
    assert "1990" in read_all(pages[:1])[0]


def recipe(i, inner=""):
    return (f"<body><nav><a>Home</a></nav><article><h1>Dish {i}</h1><h2>Ingredients</h2><p>Salt and {i} eggs {'word ' * 30}</p><h2>Method</h2>"
            f"<p>Stir {i} times {'word ' * 20}</p>{inner}</article><footer>&copy; all of us</footer></body>")


@pytest.mark.parametrize("n", [1, 3, 4, 10])
@pytest.mark.parametrize(("inner", "text"), [
    ("", None), ("<h2>References</h2><ul><li><a href=a>First source</a></li><li><a href=b>Second source</a></li></ul>", "References\n\nFirst source\n\nSecond source"),
    ("<div class='market-share'><p>A third of the market in {}</p></div>", "A third of the market in {}"),
    ("<div class=first-reply-letter><p>Dear {}, thank you</p></div>", "Dear {}, thank you"),
    ("<p>Let <math><mi>x</mi></math> be {}</p>", "Let x be {}"), ("<object data=a>No picture of {}</object>", "No picture of {}"),
    ("<video src=a><p>No film of {}</p></video>", "No film of {}"), ("<p>Same on all pages</p>", "Same on all pages"),
    ("<div class=ad>Buy {}</div>", None), ("<div class='comments-area'><p>Reader {} {}</p></div>", None), ("<form><p>Your name {}</p></form>", None),
    ("<div class='social-share'><a>Post {}</a></div>", None), ("<aside>Aside {}</aside>", None), ("<script>x({})</script><style>y</style>", None)])
def test_an_article_keeps_its_text(n, inner, text):
    word, other = " ".join(["word"] * 30), " ".join(["word"] * 20)
    want = [f"Dish {i}\n\nIngredients\n\nSalt and {i} eggs {word}\n\nMethod\n\nStir {i} times {other}" + (f"\n\n{text.replace('{}', str(i))}" if text else "") for i in range(n)]
    assert read_all([recipe(i, inner.replace("{}", str(i))) for i in range(n)]) == want


def test_a_name_that_may_mean_more_needs_the_wrapper():
    """Names with other words beside: left out where the wrapper shows links, or the same on nearly all pages."""
    for name, inner, gone in (("quick-share-here", "<a>Send {} now</a>", True), ("promo-of-ours", "Buy our paper", True), ("promo-of-ours", "Letter {} of a reader", False)):
        pages = [recipe(i, f"<div class='{name}'><p>{inner.replace('{}', str(i))}</p></div>") for i in range(6)]
        assert all(("Stir" in t) and (t.rstrip("word ").endswith("times") == gone) for t in read_all(pages))


def test_neighbours_with_one_name_are_told_apart():
    """Two tags of the same sign are two items of the wrapper: the first, the same on all pages, is template, the second isn't."""
    pages = [f"<body><div class=x><p>Our house, {'old ' * 9}and yours.</p></div><h3>Now {i}</h3><div class=x><p>Text {i} {'word ' * 30}</p></div></body>" for i in range(5)]
    assert read_all(pages) == [f"Now {i}\n\nText {i} {' '.join(['word'] * 30)}" for i in range(5)]


def messy(rng, i):
    parts = [f"<p>Text {i} {rng.random()} {'word ' * rng.randrange(30)}</p>", "<h2>Part</h2>", f"<div class=x><p>{rng.random()}</p></div>", "<div class=x><p>Fixed part</p></div>",
             "<ul><li>a<li>b</ul>", "<p>Always the same</p>", f"<section><h3>{i}</h3><p>z {'long ' * rng.randrange(50)}</p></section>", "<div class=promo-z><a>more</a></div>"]
    rng.shuffle(parts)
    return f"<body><div class=top>Top</div><div>{''.join(parts[: rng.randrange(3, 9)])}</div><div class=foot>Imprint</div></body>"


def test_order_and_partitions_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(W, "SHARD_PAGES", 9)
    monkeypatch.setattr(W, "SHARDS_JOINED", 3)
    rng = random.Random(13)
    rows = [(i, f"http://{'ab'[i % 3 == 0]}.org/{i}", messy(rng, i)) for i in range(120)]
    seen = []
    for n in (1, 7, 64):
        rng.shuffle(rows)
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(n)
        seen.append(sorted((r["row"]["page_id"], r["main_text"]) for r in W.extract_text(pages).collect()))
    assert seen[0] == seen[1] == seen[2] and all(t and "Top" not in t and "Imprint" not in t for _, t in seen[0])


def slow_align(a, b):
    """The items of two sequences in an alignment of most matches, by trying all."""
    if not a or not b:
        return [(x, None) for x in a] + [(None, y) for y in b]
    options = [[(a[0], None), *slow_align(a[1:], b)], [(None, b[0]), *slow_align(a, b[1:])]]
    if a[0].key() == b[0].key():
        options.append([(a[0], b[0]), *slow_align(a[1:], b[1:])])
    return max(options, key=lambda o: sum(x is not None and y is not None for x, y in o))


def test_alignment_has_most_matches():
    rng = random.Random(14)
    for _ in range(150):
        one, two = ("".join(f"<{rng.choice(['p', 'ul', 'h2', 'pre'])}>{rng.random()}" + "</p></ul></h2></pre>" for _ in range(rng.randrange(5))) for _ in range(2))
        a, b = W.page_wrapper(one).items, W.page_wrapper(two).items
        best = sum(x is not None and y is not None for x, y in slow_align(a, b))
        total = sum(x.chars if x.sign == "#" else sum(k.chars for k in W._flat(x.items)) for x in [*W._flat(a), *W._flat(b)])
        keys = [x.key() for x in a], [x.key() for x in b]
        made = W._align([W.Item.load(x.dump()) for x in a], [W.Item.load(x.dump()) for x in b])
        flat = list(W._flat(made))
        assert sum(x.chars if x.sign == "#" else sum(k.chars for k in W._flat(x.items)) for x in flat) == total  # no text is lost
        if not any(x.repeated or x.sign == "()" for x in made):
            assert len(made) == len(keys[0]) + len(keys[1]) - best and sum(not x.optional for x in made) <= best


def test_texts_held_are_bounded():
    folded = W.page_wrapper("")
    for i in range(40):
        folded = W._merge(folded, W.page_wrapper("<p>Same</p>" + "".join(f"<p>{i} {k}</p>" for k in range(50))))
    item = folded.items[0].items[0]
    assert len(item.seen) <= 2 * W.SEEN and item.seen[zlib.crc32(b"Same")] == (40, 4)


def test_alignment_makes_groups_and_slots():
    def shape(*pages):
        folded = W.page_wrapper(pages[0])
        for p in pages[1:]:
            folded = W._merge(folded, W.page_wrapper(p))
        assert W.Item.load(folded.dump()) == folded and W._unpacked(W._packed(folded)) == folded
        return folded.render()

    assert shape("<div>a</div>", "<div>a</div>") == "<> <div> text </div> </>"
    assert shape("<div>a</div>", "<div>b</div>") == "<> <div> #text </div> </>"
    assert shape("<div>a</div>", "<div>a</div><p>c</p>") == "<> <div> text </div> ( <p> text </p> )? </>"
    assert shape("<p>a<p>b", "<p>a") == "<> ( <p> #text </p> )+ </>"
    assert shape("<dl><dt>a<dd>b<dt>c<dd>d</dl>") == "<> <dl> ( <dt> #text </dt> <dd> #text </dd> )+ </dl> </>"
    many = "".join(f"<{t}>x</{t}>" for t in (["h2", "p", "ul", "h3", "p", "p", "ol"] * 30)[:200:1] + ["pre", "p", "h2", "h2", "ul"] * 9)
    assert len(W._packed(W._merge(W.page_wrapper(many), W.page_wrapper(many[::1] + "<h4>q</h4>")))) < 2000


# -- language model


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(9)
    for words in (0, 1, 70, 150):
        layout = M.Layout(words)
        model = M.LogBilinear.initial(layout, rng.integers(0, 100, layout.outputs).astype(float), 1)
        context = np.repeat(rng.integers(0, layout.outputs + 1, (M.CONTEXT, 1)), layout.outputs, axis=1)
        logs = model.log_probabilities(context, np.arange(layout.outputs))
        assert abs((10**logs).sum() - 1) < 1e-5
    # and within a tail: seen words and one share for the unseen
    seen = [(f"q{i}ab".encode(), 5 - i % 3) for i in range(200)]
    total = sum(c + 1 for _, c in seen) + 1
    assert abs(sum((c + 1) / total for _, c in seen) + 1 / total - 1) < 1e-12


def plain_log(model, context, output):
    """log10 of the probability of one output, step by step."""
    layout = model.layout
    predicted = sum(model.tokens[c].astype(float) * model.places[i] for i, c in enumerate(context))

    def softmax(vectors, bias, own):
        scores = [float(predicted @ v + b) for v, b in zip(vectors.astype(float), bias[:, 0], strict=True)]
        return math.exp(scores[own]) / sum(map(math.exp, scores))

    if output == 0 or output > layout.words:
        return math.log10(softmax(model.classes, model.class_bias, 0 if output == 0 else output - layout.words + layout.word_classes))
    k, at = divmod(output - 1, layout.size)
    words = slice(k * layout.size, min(layout.words, (k + 1) * layout.size))
    return math.log10(softmax(model.classes, model.class_bias, 1 + k) * softmax(model.words[words], model.word_bias[words], at))


def test_log_probabilities_like_plain_ones():
    rng = np.random.default_rng(12)
    layout = M.Layout(75)
    model = M.LogBilinear.initial(layout, rng.integers(1, 50, layout.outputs).astype(float), 3)
    for k in ("tokens", "classes", "words", "word_bias"):
        getattr(model, k)[...] += rng.normal(0, 1, getattr(model, k).shape)
    model.class_bias[5] += 90  # beyond what exp() takes
    context, target = rng.integers(0, layout.outputs + 1, (M.CONTEXT, 300)), rng.integers(0, layout.outputs, 300)
    want = [plain_log(model, context[:, i], int(target[i])) for i in range(300)]
    got = model.log_probabilities(context, target)
    assert np.allclose(got, want, rtol=1e-5, atol=1e-5)
    for k in (1, 7, 100):  # whatever else is in a block
        assert np.abs(got - np.concatenate([model.log_probabilities(context[:, i : i + k], target[i : i + k]) for i in range(0, 300, k)])).max() < 1e-9


def chains(rng, n, size=60, kinds=90):
    """Streams in which the next word depends on the one before."""
    return [(1 + (np.arange(size) * s + a) % kinds).astype(np.uint16).tobytes() for s, a in zip(rng.integers(1, 4, n), rng.integers(0, kinds, n), strict=True)]


def test_training_beats_frequencies():
    rng = np.random.default_rng(10)
    streams, layout = chains(rng, 300), M.Layout(90)
    count = np.bincount(np.frombuffer(b"".join(streams), np.uint16), minlength=layout.outputs).astype(float)
    model = M.LogBilinear.initial(layout, count, 1)
    context, target, _ = M._positions(streams, layout.outputs)
    before = model.log_probabilities(context, target).mean()
    learner = M.Learner(model, 1)
    for _ in range(20):
        learner.learn(context, target)
    assert learner.model.log_probabilities(context, target).mean() > before + 0.3


def test_many_shards_beat_frequencies(spark):
    """64 learners, averaged in four rounds, on a corpus where the next word depends on the one before; unseen documents are scored."""
    rng = random.Random(15)

    def text():
        at, step = rng.randrange(90), rng.randrange(1, 4)
        return " ".join(f"w{(at + k * step) % 90}x" for k in range(200))

    docs = make(spark, [(i, text()) for i in range(12_800)]).repartition(6)
    got = M.score_texts(docs, F.col("id") % 8 != 0, shard_tokens=36_000).where("not learns").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert got[0] / got[2] > got[1] / got[2] + 0.05


def test_scores_depend_on_the_rows_alone(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    seen = []
    for n in (1, 8, 64):
        got = M.score_texts(docs.repartition(n, F.xxhash64("doc_id", F.lit(n))), F.col("id") % 7 != 2, shard_tokens=5000).collect()
        seen.append(sorted((r["id"], r["score"], r["base_score"]) for r in got))
    for other in seen[1:]:
        assert all(a[0] == b[0] and math.isclose(a[1], b[1], rel_tol=1e-9) and math.isclose(a[2], b[2], rel_tol=1e-9) for a, b in zip(seen[0], other, strict=True))


def test_the_head_is_bounded(spark):
    vocabulary = spark.createDataFrame([(f"w{i}".encode(), 1) for i in range(3000)] + [(b"x" * 100, 50)], "word binary, c long")
    counts = M.Counts.of(vocabulary, 10, 1000)
    assert 0 < len(counts.head) <= 1100 and all(len(w) <= M.LONGEST_WORD for w, _ in counts.head)
    assert counts.total == 3060 and counts.distinct == 3002 and counts.output_count.sum() == counts.total
    more = M.Counts.of(spark.createDataFrame([(f"w{i}".encode(), 100) for i in range(3000)], "word binary, c long"), 10, 1000)
    assert more.layout.words > counts.layout.words  # vectors grow with the corpus


def brute_base(rows, learns):
    c = Counter()
    for i, t in rows:
        if learns(i):
            c.update([*(t or "").translate({k: k + 32 for k in range(65, 91)}).encode().split(), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = [*(t or "").translate({k: k + 32 for k in range(65, 91)}).encode().split(), None]
        out.append((i, not learns(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)))
    return out


@pytest.mark.parametrize("head", [M.HEAD, 120, 0])
def test_base_scores_like_brute_force(spark, sf_small, head):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    from casegrid.llm.common import doc_remainder

    got = sorted(M.score_texts(docs, doc_remainder(F.col("id"), 7) != 2, head=head).collect(), key=lambda r: r["id"])
    want = sorted(brute_base([(r["doc_id"], r["text"]) for r in docs.collect()], lambda i: zlib.crc32(str(i).encode()) % 7 != 2))
    assert len(got) == len(want)
    for r, w in zip(got, want, strict=True):
        assert (r["id"], not r["learns"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:5]
        assert math.isclose(r["base_score"], w[5], rel_tol=1e-9)
        assert r["score"] < 0


def test_language_model_of_odd_rows(odd, none, odd_rows):
    got = M.score_texts(odd, F.col("id") != 5).collect()
    assert len(got) == len(odd_rows) and all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    assert [r["n_tokens"] for r in got if r["id"] == 1] == [1]
    assert all(r["n_known"] == 0 and r["base_score"] == 0 for r in M.score_texts(odd, F.lit(False)).where("n_tokens = 1").collect())
    assert M.score_texts(none, F.lit(True)).count() == 0


# -- mixing


def brute_deal(budget, kids):
    """kids: (name, weight, room); pour until nothing is left or all are full."""
    share = {k: 0.0 for k, _, _ in kids}
    open_ = [k for k in kids if k[1] and k[2]]
    while budget > 1e-9 and open_:
        unit = min(budget / sum(w for _, w, _ in open_), min((r - share[k]) / w for k, w, r in open_))
        for k, w, _ in open_:
            share[k] += unit * w
        budget -= unit * sum(w for _, w, _ in open_)
        open_ = [k for k in open_ if k[2] - share[k[0]] > 1e-9]
    return share


def test_budgets_like_pouring(spark):
    rng = random.Random(11)
    leaves = [(a, b, c, rng.choice([0, 10, 100, 1000])) for a in "xyz" for b in "pq" for c in ("s", "t", "u", "v")]
    weights = {"l0": {"x": 5, "y": 1, "z": 0}, "l1": {"p": 3}, "l2": {"t": 9}}
    for part in (0.1, 0.5, 0.9, 1.0):
        got = X.leaf_budgets(spark.createDataFrame(leaves, "l0 string, l1 string, l2 string, tokens long"), ["l0", "l1", "l2"], weights, part, 2)
        got = {(r["l0"], r["l1"], r["l2"]): r["share"] for r in got.collect()}
        rooms = {x[:3]: 2 * x[3] for x in leaves}

        def room(*path):
            return sum(v for k, v in rooms.items() if k[: len(path)] == path)

        total = math.floor(sum(x[3] for x in leaves) * part)
        first = brute_deal(total, [(a, weights["l0"].get(a, 1), room(a)) for a in "xyz"])
        for a in "xyz":
            second = brute_deal(first[a], [(b, weights["l1"].get(b, 1), room(a, b)) for b in "pq"])
            for b in "pq":
                third = brute_deal(second[b], [(c, weights["l2"].get(c, 1), room(a, b, c)) for c in "stuv"])
                for c in "stuv":
                    assert math.isclose(got[a, b, c], third[c], rel_tol=1e-6, abs_tol=1e-6), (a, b, c)


def test_mix_of_odd_rows(spark, odd, none, odd_rows):
    levels = {"domain": R.domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    got = X.mix(odd, levels, {}, 1.0).collect()
    assert sorted(str(r["row"]["doc_id"]) for r in got if r["n_tokens"]) == sorted(str(r[0]) for r in odd_rows if (r[1] or "").split())
    assert X.mix(none, levels, {}, 0.5).count() == 0
    few = X.mix(odd, levels, {"lang": {"en": 1, "de": 50}}, 0.01, 3).collect()
    assert {r["epoch"] for r in few} <= {0, 1, 2}
    assert X.mix(odd, levels, {}, 0.0).count() == 0


def test_tokens(spark):
    cases = ["", " ", "a", " a  b\t", "\x0b\x0c", "a b c", None]
    got = make(spark, list(enumerate(cases))).select("doc_id", X.token_count(F.col("text")).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == {i: len(re.findall("[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(cases)}


def test_more_epochs_when_a_source_is_short(spark):
    rng = random.Random(12)
    docs = make(spark, [(i, words(rng, 10), "en", "src1") for i in range(5)] + [(10 + i, words(rng, 10), "de", "src1") for i in range(20)])
    levels = {"lang": F.col("lang")}
    got = Counter((r["lang"], r["epoch"]) for r in X.mix(docs, levels, {"lang": {"en": 1, "de": 1}}, 0.6, 2).select("lang", "epoch").collect())
    # 150 tokens of 250: half to each; en has 50 and gives them one and a half times, rounded up to whole documents
    assert got == {("en", 0): 5, ("en", 1): 3, ("de", 0): 8}
