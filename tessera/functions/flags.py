"""Consent flag expressions.

The stored agreement flag is text. ``cast('1.0' AS INT)`` raises under ANSI
and gives null with ``try_cast``, so text goes through a double first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(c) -> Column:
    """Text or number to int; ``'1.0'`` and ``' 1 '`` give 1, junk gives null."""
    return _c(c).cast("string").try_cast("double").try_cast("int")


def law_a_flag(c) -> Column:
    """0 stays 0; anything else, null and junk included, counts as 1."""
    return F.when(F.coalesce(safe_int(c) == 0, F.lit(False)), F.lit(0)).otherwise(F.lit(1))


def law_b_flag(c) -> Column:
    """Trimmed '0' / '1' as such, else the int value; null stays null."""
    t = F.trim(_c(c).cast("string"))
    return (F.when(t == "0", F.lit(0))
            .when(t == "1", F.lit(1))
            .otherwise(safe_int(c)))


def prefer(c, value: str, rank_if: int = 2, rank_else: int = 1) -> Column:
    """Tie-break rank: higher for rows of the preferred source."""
    return F.when(_c(c) == value, F.lit(rank_if)).otherwise(F.lit(rank_else))
