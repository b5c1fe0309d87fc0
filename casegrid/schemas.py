"""Schemas of the star model and the fixed vocabularies it relies on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the published application's for equal results).
# ---------------------------------------------------------------------------

# Court names seeded into the court dimension, in seed order.
SEED_COURTS = [
    "United Kingdom Supreme Court",
    "Privy Council",
    "Court of Appeal (Civil Division)",
    "Court of Appeal (Criminal Division)",
    "High Court (Administrative Court)",
    "High Court (Chancery Division)",
    "High Court (Admiralty Court)",
    "High Court (Commercial Court)",
    "High Court (Family Division)",
    "High Court (Intellectual Property Enterprise Court)",
    "High Court (King's Bench Division)",
    "High Court (Queen's Bench Division)",
    "High Court (Mercantile Court)",
    "High Court (Patents Court)",
    "High Court (Senior Courts Costs Office)",
    "High Court (Technology and Construction Court)",
    "Court of Protection",
    "Family Court",
]

# Closed verdict vocabulary; anything else becomes "Other" (exact match).
ALLOWED_VERDICTS = [
    "Guilty",
    "Not Guilty",
    "Dismissed",
    "Acquitted",
    "Hung Jury",
    "Claimant Wins",
    "Defendant Wins",
    "Settlement",
    "Struck Out",
    "Appeal Dismissed",
    "Appeal Allowed",
    "Other",
]

# Title / honorific tokens removed from judge names (case-sensitive, whole
# space-separated tokens). Includes the empty token and one entry with a
# leading space, which can never equal a space-split token.
JUDGE_STOP_TOKENS = [
    "Senior", "(Magistrates’", " His", "Master", "King’s", "(The", "The",
    "King's", "Remembrancer)", "Bench", "Chief", "Chancery", "Costs", "Judge",
    "(Chief", "Taxing", "Master)", "Insolvency", "and", "Companies", "Court",
    "Registrar", "District", "(MC)", "His", "Her", "Honour", "Tribunal",
    "Employment", "Deputy", "Magistrate)", "CBE", "DL", "(Deputy", "Lead",
    "DCRJ)", "Upper", "Recorder", "of", "London,", "Regional", "ICC",
    "(Magistrates", "(Magistrates'", "Court)", "KC", "Assistant", "Advocate",
    "General", "Lieutenant", "Colonel", "(Retired)", "JP", "", "OBE",
]

# Fuzzy judge match threshold (token-set ratio, 0..100, inclusive).
JUDGE_MATCH_THRESHOLD = 95.0
# Tag merge threshold (Jaro-Winkler, strict).
TAG_SIMILARITY_THRESHOLD = 0.9

# Enrichment pricing, USD per one million tokens.
PRICE_INPUT_PER_M = 0.15
PRICE_OUTPUT_PER_M = 0.60

# Transcript budget: tokens kept from the start and from the end.
TRUNCATE_HEAD_TOKENS = 4000
TRUNCATE_TAIL_TOKENS = 4000
TRUNCATE_PLACEHOLDER = "[...]"

# Notification topic prefix for per-court topics.
TOPIC_PREFIX = "c12-courts-"

# Month labels for the cases-per-month chart.
MONTH_LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
                "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Email pattern used to validate subscriptions (first match is taken).
EMAIL_PATTERN = r"[\w_.-]+@[\w_.-]+[.]+[\w]+"

# Reply keys an enrichment record must carry.
REPLY_STRING_KEYS = ["verdict", "summary", "case_number", "verdict_summary"]
REPLY_LIST_KEYS = ["judge", "tags"]
REPLY_SIDE_KEYS = ["first_side", "second_side"]

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

COURT_CASE = T.StructType([
    T.StructField("court_case_id", T.StringType(), False),
    T.StructField("summary", T.StringType()),
    T.StructField("verdict_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("court_date", T.DateType()),
    T.StructField("case_number", T.StringType()),
    T.StructField("case_url", T.StringType()),
    T.StructField("court_id", T.LongType()),
    T.StructField("verdict_summary", T.StringType()),
])
