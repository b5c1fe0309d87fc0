"""Scalar string / date functions as native Column expressions.

Everything here compiles to Catalyst expressions (whole-stage codegen, no
Python in the data path).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casegrid import schemas as S


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def capitalize(c: Column | str) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    c = _c(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))


def capwords(c: Column | str) -> Column:
    """``string.capwords``: whitespace runs collapsed, each word capitalised."""
    c = _c(c)
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: capitalize(w)), " ")


def title_case(c: Column | str) -> Column:
    """Python ``str.title``: upper-case a letter that follows a non-letter."""
    runs = F.regexp_extract_all(F.lower(_c(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: capitalize(r)), "")


def null_if_blank_or_none(c: Column | str) -> Column:
    """Display rule: hide empty strings and the literal text 'None'."""
    c = _c(c)
    return F.when((c == "") | (c == "None"), F.lit(None)).otherwise(c)


def strip_judge_titles(c: Column | str) -> Column:
    """Drop title tokens and tokens not starting with a letter; single-space re-join."""
    stop = F.array(*[F.lit(t) for t in S.JUDGE_STOP_TOKENS])
    tokens = F.split(_c(c), " ")
    kept = F.filter(tokens, lambda t: ~F.array_contains(stop, t) & t.rlike(r"^\p{L}"))
    return F.array_join(kept, " ")


def month_label(month_num: Column | str) -> Column:
    """Month number 1..12 -> 'Jan'..'Dec' (NULL stays NULL)."""
    labels = F.array(*[F.lit(m) for m in S.MONTH_LABELS])
    number = _c(month_num).cast("int")
    return F.when(number.isNotNull(), F.element_at(labels, F.coalesce(number, F.lit(1))))


def parse_listing_date(c: Column | str) -> Column:
    """'5 Feb 2022' or '5 Feb 2022, midnight' -> DATE; blank/NULL/bad -> NULL."""
    c = F.trim(F.regexp_replace(_c(c), ", midnight", ""))
    return F.when(c == "", F.lit(None).cast("date")).otherwise(F.try_to_date(c, "d MMM yyyy"))


def format_ddmmyyyy(c: Column | str) -> Column:
    return F.date_format(_c(c), "dd-MM-yyyy")


def parse_ddmmyyyy(c: Column | str) -> Column:
    return F.try_to_date(_c(c), "dd-MM-yyyy")


def topic_name(court: Column | str, prefix: str = S.TOPIC_PREFIX) -> Column:
    """Per-court notification topic: prefix + court, spaces -> '-', only letters and '-'."""
    return F.concat(F.lit(prefix),
                    F.regexp_replace(F.replace(_c(court), F.lit(" "), F.lit("-")), r"[^\p{L}-]", ""))


def topic_display(topic: Column | str, prefix: str = S.TOPIC_PREFIX) -> Column:
    """Topic -> display name: '-' -> ' ', then drop the prefix length (lossy by design)."""
    return F.substring(F.replace(_c(topic), F.lit("-"), F.lit(" ")), F.lit(len(prefix) + 1), F.length(_c(topic)))


def extract_email(c: Column | str) -> Column:
    """First email-looking match, '' when none (Unicode word characters)."""
    return F.regexp_extract(_c(c), "(?U)" + S.EMAIL_PATTERN, 0)


# Tokens that re-concatenate to the input exactly: each token is a run of
# leading whitespace plus a non-space run, or trailing whitespace.
TOKEN_PATTERN = r"(\s*\S+|\s+$)"


def tokens(c: Column | str, pattern: str = TOKEN_PATTERN) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(pattern), 1)


def truncate_middle(c: Column | str, head: int = S.TRUNCATE_HEAD_TOKENS,
                    tail: int = S.TRUNCATE_TAIL_TOKENS,
                    placeholder: str = S.TRUNCATE_PLACEHOLDER,
                    pattern: str = TOKEN_PATTERN) -> Column:
    """Keep the first ``head`` and last ``tail`` tokens with a placeholder between.

    Unchanged when the text has at most head + tail tokens. Works on the whole
    text; the token array lives only inside one row's expression evaluation.
    """
    toks = tokens(c, pattern)
    n = F.size(toks)
    first = F.array_join(F.slice(toks, 1, head), "")
    last = F.array_join(F.slice(toks, n - F.lit(tail) + 1, F.lit(tail)), "") if tail > 0 else F.lit("")
    return F.when(n <= head + tail, _c(c)).otherwise(F.concat(first, F.lit(placeholder), last))


def standardise_verdict(c: Column | str) -> Column:
    c = _c(c)
    """P6: exact match against the closed vocabulary, else 'Other' (NULL stays NULL)."""
    return F.when(c.isNull(), c).when(c.isin(*S.ALLOWED_VERDICTS), c).otherwise(F.lit("Other"))
