"""Calendar spine: one row per population client and history month.

The original range-joins the population to the calendar's distinct months
with ``month BETWEEN start AND per_ref``.  The history window is a constant
``[start, mes]``, so the calendar side is filtered to it first: it then holds
at most ``mes - start + 1`` distinct integers (6 for a six-month window inside
one year, under 100 in any case), a size fixed by the parameters and not by
the data.  That side is broadcast and the range condition runs as a
broadcast nested-loop join on the (large) population, with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientincome.functions.periods import recency
from clientincome.semantics import REFERENCE, RunParams, Semantics


def history_months(calendar: DataFrame, params: RunParams) -> DataFrame:
    """Distinct months of the calendar inside the history window."""
    return (
        calendar.select("num_periodo_mes")
        .where(F.col("num_periodo_mes").between(params.start, params.mes))
        .distinct()
    )


def max_history_months(params: RunParams) -> int:
    """Proven upper bound of ``history_months`` rows (distinct ints in range)."""
    return params.mes - params.start + 1


def month_spine(
    population: DataFrame,
    calendar: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """Population x history months, left join (clients keep one row when the
    calendar has no month in range), with ``diff_mes``.

    REFERENCE measures ``diff_mes`` from the reference month to itself, so it
    is always 1 (Q1); CORRECTED measures it to the history month.
    """
    months = F.broadcast(history_months(calendar, params).alias("m"))
    p = population.alias("p")
    spine = p.join(
        months,
        F.col("m.num_periodo_mes").between(F.lit(params.start), F.col("p.per_ref")),
        "left",
    )
    if sem.service_recency_from_month:
        diff = recency(F.col("p.per_ref"), F.col("m.num_periodo_mes"))
    else:
        diff = recency(F.col("p.per_ref"), F.col("p.per_ref"))
    return spine.select("p.*", F.col("m.num_periodo_mes"), diff.cast("int").alias("diff_mes"))
