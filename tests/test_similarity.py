import functools
import random

import duckdb

from casegrid.functions.similarity import jaro_winkler, lcs_length, token_set_ratio


def test_token_set_ratio_vectors():
    assert token_set_ratio("Justice James", "James") == 100
    assert token_set_ratio("Lord Sales", "Sales") == 100
    assert round(token_set_ratio("John", "James"), 2) == 22.22
    assert token_set_ratio("", "James") == 0


def test_lcs_brute_force():
    rnd = random.Random(7)
    for _ in range(500):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 10)))
        b = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 10)))

        @functools.lru_cache(None)
        def lcs(i, j):
            if i == len(a) or j == len(b):
                return 0
            return lcs(i + 1, j + 1) + 1 if a[i] == b[j] else max(lcs(i + 1, j), lcs(i, j + 1))
        assert lcs(0, 0) == lcs_length(a, b)


def test_jaro_winkler_matches_duckdb():
    con = duckdb.connect()
    rnd = random.Random(3)
    for _ in range(300):
        a = "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 9)))
        b = "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 9)))
        d = con.execute("select jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
        assert abs(d - jaro_winkler(a, b)) < 1e-12
    assert jaro_winkler("Able", "Unable") == 0.75
    assert jaro_winkler("Patent", "Patents") > 0.9
