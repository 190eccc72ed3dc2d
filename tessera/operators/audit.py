"""Row counts per stage.

The jobs print one ``count()`` per stage, each an action that recomputes the
lineage. Here the counts are one DataFrame: a union of global aggregates
(each a partial count per task and a one-row final), read in a single job.
Stages that are flags of one plan are counted side by side in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counts_of(plans: list[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """``(stage, row_count)``: of each plan one aggregate, which counts all its stages."""
    out = None
    for df, stages in plans:
        one = df.agg(*[count.alias(name) for name, count in stages.items()])
        pairs = ", ".join(f"'{name}', `{name}`" for name in stages)
        rows = one.selectExpr(f"stack({len(stages)}, {pairs}) AS (stage, row_count)")
        out = rows if out is None else out.unionByName(rows)
    return out


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """``(stage, row_count)`` for every named frame."""
    return counts_of([(df, {name: F.count(F.lit(1))}) for name, df in stages.items()])


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count collected while it runs (no extra job).

    Read ``obs.get["row_count"]`` after the action that executes ``df``.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("row_count")), obs

