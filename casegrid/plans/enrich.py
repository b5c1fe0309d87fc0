"""Enrichment request building and cost accounting.

No model client is called here: requests are rows (one per transcript) for
an external enrichment hook, replies come back as a table (see
``operators.reply``). Truncation runs on the whole transcript text as a
native expression; usage lines are parsed with ``regexp_extract``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid import schemas as S
from casegrid.functions import subword as SW
from casegrid.functions import text as TX

# Request framing of our own wording; the hook decides the actual prompt.
SYSTEM_INSTRUCTIONS = (
    "Summarise the court transcript and return a dictionary with keys "
    "case_number, judge, first_side, second_side, verdict, verdict_summary, summary, tags.")
USER_PREAMBLE = "Court transcript:\n"


def build_requests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   head: int = S.TRUNCATE_HEAD_TOKENS, tail: int = S.TRUNCATE_TAIL_TOKENS,
                   system: str = SYSTEM_INSTRUCTIONS, preamble: str = USER_PREAMBLE, ranks_path: str | None = None) -> DataFrame:
    """F1 + F2: one request row per transcript: system text and user text
    (preamble + middle-truncated transcript), with the token counts. Tokens are
    those of the vocabulary in ``ranks_path``, or else runs of non-spaces."""
    if ranks_path is not None:
        short = SW.truncate_middle(docs.sparkSession, F.col(text_col), ranks_path, head, tail)
        made = docs.select(F.col(id_col), short.alias("short"))
        return made.select(id_col, F.lit(system).alias("system"), F.concat(F.lit(preamble), "short.text").alias("user"), "short.n_tokens",
                           (F.col("short.n_tokens") > head + tail).alias("truncated"))
    toks = F.size(TX.tokens(text_col))
    return docs.select(
        F.col(id_col),
        F.lit(system).alias("system"),
        F.concat(F.lit(preamble), TX.truncate_middle(text_col, head, tail)).alias("user"),
        toks.alias("n_tokens"),
        (toks > head + tail).alias("truncated"),
    )


USAGE_PATTERN = r"usage cost: \[(\d+), (\d+), (\d+)\]"


def usage_lines_from_conversations(conversations: DataFrame) -> DataFrame:
    """A usage log as one line per conversation: completion = assistant text,
    prompt = system + user text (characters stand in for tokens)."""
    is_out = F.col("role") == "assistant"
    n = F.length("text").cast("long")
    per = conversations.groupBy("conv_id").agg(
        F.sum(F.when(is_out, n).otherwise(0)).alias("c"),
        F.sum(F.when(~is_out, n).otherwise(0)).alias("p"))
    return per.select(F.format_string("INFO enrichment usage cost: [%d, %d, %d]",
                                      "c", "p", F.col("c") + F.col("p")).alias("value"))


def read_usage_log(spark: SparkSession, path: str) -> DataFrame:
    """A text log, one ``value`` line each."""
    return spark.read.text(path)


def usage_cost(lines: DataFrame, price_in: float = S.PRICE_INPUT_PER_M,
               price_out: float = S.PRICE_OUTPUT_PER_M) -> DataFrame:
    """Parse usage lines, sum tokens, price them (USD, 2 dp)."""
    usage = lines.where(F.col("value").contains("usage cost:")).select(
        F.regexp_extract("value", USAGE_PATTERN, 1).cast("long").alias("completion"),
        F.regexp_extract("value", USAGE_PATTERN, 2).cast("long").alias("prompt"))
    tot = usage.agg(F.sum("completion").alias("completion_tokens"),
                    F.sum("prompt").alias("prompt_tokens"))
    out_cost = F.col("completion_tokens") / 1e6 * price_out
    in_cost = F.col("prompt_tokens") / 1e6 * price_in
    return tot.select(
        "completion_tokens", "prompt_tokens",
        F.format_string("$%.2f", out_cost).alias("output_cost"),
        F.format_string("$%.2f", in_cost).alias("input_cost"),
        F.format_string("$%.2f", out_cost + in_cost).alias("total_cost"))
