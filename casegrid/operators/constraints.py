"""Quarantine of case rows that the published tables couldn't hold: lengths and NOT NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The longest text of each column, and the columns that must have a value.
LONGEST = {"court_case_id": 250, "title": 512, "case_number": 250, "case_url": 512, "court_name": 100, "verdict": 50}
LONGEST_ITEMS = {"judges": 200, "tags": 250}
LONGEST_PARTY = {"participant": 512, "lawyer": 200, "law_firm": 255}
NEEDED = ["court_case_id"]


def _any_longer(column: str, most: int, part: str | None = None) -> Column:
    return F.exists(column, lambda x: F.length(x[part] if part else x) > most)


def broken_constraint() -> Column:
    """The first constraint that a case row breaks, as ``null:column`` or ``long:column``; null if none."""
    checks = [(F.col(c).isNull(), f"null:{c}") for c in NEEDED]
    checks += [(F.length(c) > n, f"long:{c}") for c, n in LONGEST.items()]
    checks += [(F.exists(c, lambda x: x.isNull()), f"null:{c}") for c in LONGEST_ITEMS]
    checks += [(_any_longer(c, n), f"long:{c}") for c, n in LONGEST_ITEMS.items()]
    checks += [(_any_longer(side, n, k), f"long:{k}") for side in ("first_side", "second_side") for k, n in LONGEST_PARTY.items()]
    return F.coalesce(*[F.when(wrong, F.lit(name)) for wrong, name in checks])


def split_by_constraints(cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, the others with ``reason``)."""
    marked = cases.withColumn("reason", broken_constraint())
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())
