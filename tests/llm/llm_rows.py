"""Small tables for the tests of this folder."""

DDL = ("doc_id long, text string, lang string, source string, n_chars long, "
       "row string, fp string, score string, x string, found string, id string, epoch string, domain string, number string, label string, "
       "kept_text string, log string, outputs string, host string, path string, rule string, verdict string, tokens string, html string")
EXTRA = 19


def make(spark, rows):
    """documents with columns whose names are those of results and of inner columns; rows: (doc_id, text[, lang, source])."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, "en", "src1")[:4] if len(r) < 4 else r
        full.append((doc_id, text, lang, source, len(text or ""), *["mine"] * EXTRA))
    return spark.createDataFrame(full, DDL)


def words(rng, n, size=900):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))
