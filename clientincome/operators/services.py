"""Transfer (remittances, express money) and currency-exchange features.

Each population client gets one row of recency, frequency and amount features
over the history spine.  The original ranks every family's monthly amounts
with its own window sort; here the trimmed totals come from a sorted slice of
the client's monthly list inside the same ``groupBy`` (one shuffle, no window
sorts).

Copies (a client repeated in the population, a history row repeated) change
the original's results, so they are reproduced, but as weights: the
population arrives counted (``n`` copies per client) and the history is
reduced to distinct rows with a count ``w`` by a partial-combining aggregate.
A client's group then holds one entry per distinct (month, history row),
never its copies: sums and counts are weighted, minima are not, and trimmed
totals walk the weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientincome.functions.numeric import weighted_trimmed_sum
from clientincome.operators.populations import counted
from clientincome.operators.spine import month_spine
from clientincome.semantics import REFERENCE, RunParams, Semantics

SENTINEL_RECENCY = 99  # fixed value: "never happened" recency

TRANSFER_VALUES = (
    "mto_pag_rem", "num_pag_rem", "mto_env_rem", "num_env_rem",
    "mto_pag_dex", "num_pag_dex", "mto_env_dex", "num_env_dex",
)
FX_VALUES = ("mto_div_cpa", "num_div_cpa", "mto_div_vta", "num_div_vta")


def trim_bounds(params: RunParams, sem: Semantics) -> tuple[int, int, float]:
    """(first rank, count, scale) of the trimmed total.

    REFERENCE: ranks 2..5, divided by 4, times 6, whatever the history (Q7).
    CORRECTED: drop the smallest and largest month of ``historia`` and scale
    the middle back to the whole history.
    """
    if sem.trimmed_scaled_by_history and params.historia > 2:
        n = params.historia - 2
        return 2, n, params.historia / n
    return 2, 4, 6 / 4


# -- aggregates over weighted rows: every row stands for ``_wt`` copies ------
WEIGHT = "_wt"


def recency_agg(amount: str) -> Column:
    """Months back to the latest month with an amount (99 if none)."""
    return F.min(
        F.when(F.col(amount) > 0, F.col("diff_mes")).otherwise(F.lit(SENTINEL_RECENCY))
    )


def months_active_agg(count_expr: Column) -> Column:
    """Number of (copied) months whose count is positive."""
    return F.sum(F.when(count_expr > 0, F.col(WEIGHT)).otherwise(F.lit(0)))


def total_agg(col: str) -> Column:
    return F.sum(F.col(col) * F.col(WEIGHT))


def trimmed_agg(amount: str, params: RunParams, sem: Semantics) -> Column:
    first, n, scale = trim_bounds(params, sem)
    items = F.collect_list(F.struct(F.col(amount).alias("v"), F.col(WEIGHT).alias("w")))
    return weighted_trimmed_sum(items, first, n).cast("double") * F.lit(scale)


def last_month_agg(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(F.when(F.col("diff_mes") == 1, c * F.col(WEIGHT)).otherwise(F.lit(0)))


def flag_agg(flag_sum: str) -> Column:
    """Sum over the copied rows of the month-1 activity flag, from the
    population's per-client flag sum: NULL only when every copy's flag is NULL
    and every row is a month-1 row (as a plain sum over the copies gives)."""
    s = F.max(flag_sum)
    first_month = F.coalesce(F.col("diff_mes") == 1, F.lit(False))
    k = F.sum(F.when(first_month, F.col("_wh")).otherwise(F.lit(0)))
    other = F.sum(F.when(first_month, F.lit(0)).otherwise(F.col("_wh")))
    return F.when(s.isNull() & (other > 0), F.lit(0)).otherwise(s * k)


# -- spine x history -------------------------------------------------------
def history_counted(hist: DataFrame, params: RunParams, values: Sequence[str]) -> DataFrame:
    """Distinct history rows of the window with their copy count ``w``."""
    return (
        hist.where(F.col("num_periodo_mes").between(params.start, params.mes) & (F.col("id_master") > 0))
        .groupBy("id_master", "num_periodo_mes", *values)
        .agg(F.count(F.lit(1)).alias("w"))
    )


def _spine_rows(population, calendar, hist, params, sem, values, flags):
    """Counted spine joined to the history, counted here unless it has its copies ``w``.  ``_wh`` = history copies
    of the row (1 when no history), ``_wt`` = all copies (x population ``n``)."""
    pop = counted(population, flag_sums=flags)
    spine = month_spine(pop, calendar, params, sem).alias("s")
    h = (hist if "w" in hist.columns else history_counted(hist, params, values)).alias("h")
    j = spine.join(
        h,
        (F.col("s.id_master") == F.col("h.id_master"))
        & (F.col("s.num_periodo_mes") == F.col("h.num_periodo_mes")),
        "left",
    )
    wh = F.coalesce(F.col("h.w"), F.lit(1)).cast("bigint")
    return j, wh


def per_client(rows: DataFrame, aggs: Sequence[Column], totals: dict[str, str], params: RunParams, sem: Semantics) -> DataFrame:
    """One feature row for each client: ``aggs`` (named), and the trimmed total
    of each amount column (``totals``: column -> result), from one pass over
    the spine rows.

    A trimmed total reads the ranks first..first+count-1 of the amounts in
    ascending order, so only that many of the smallest distinct amounts can
    matter.  Each row goes to one group for the aggregates and to one for each
    of its amounts; equal amounts are added up, a rank limit keeps the smallest,
    and no list is longer.  All of it is by client, which the rows are already.

    The original groups by (client, per_ref).  Every population is cut to the
    run's reference month, so a client has one ``per_ref``: grouping by the
    client alone gives the same rows, and the result stays partitioned by
    client, which the unification joins reuse instead of shuffling again.
    """
    first, n, scale = trim_bounds(params, sem)
    of, v = F.col("_of"), F.col("_v")
    plain = F.struct(F.lit("").alias("of"), F.lit(None).alias("v"))
    entries = F.explode(F.array(plain, *[F.struct(F.lit(c).alias("of"), F.col(c).alias("v")) for c in totals]))
    grouped = (
        rows.withColumn("_e", entries)
        .groupBy("id_master", F.col("_e.of").alias("_of"), F.col("_e.v").alias("_v"))
        .agg(F.sum(WEIGHT).alias("_n"), *aggs)
    )
    rank = F.row_number().over(Window.partitionBy("id_master", "_of").orderBy("_v"))
    small = grouped.withColumn("_rank", rank).where(F.col("_rank") <= first + n - 1)
    names = [c for c in grouped.columns if c not in ("id_master", "_of", "_v", "_n")]
    entry = F.struct(v.alias("v"), F.col("_n").alias("w"))
    return small.groupBy("id_master").agg(
        *[F.max(F.when(of == "", F.col(c))).alias(c) for c in names],
        *[
            (weighted_trimmed_sum(F.collect_list(F.when(of == c, entry)), first, n).cast("double") * F.lit(scale)).alias(name)
            for c, name in totals.items()
        ],
    )


def trimmed_totals(rows: DataFrame, totals: dict[str, str], params: RunParams, sem: Semantics) -> DataFrame:
    """(id_master, trimmed totals) of weighted rows."""
    return per_client(rows, [], totals, params, sem)


def in_order(features: DataFrame, totals: Sequence[str], before: str) -> DataFrame:
    """The trimmed totals moved in front of the column ``before``, where the original has them."""
    rest = [c for c in features.columns if c not in totals]
    at = rest.index(before)
    return features.select(*rest[:at], *totals, *rest[at:])


def transfer_month_rows(
    population: DataFrame,
    calendar: DataFrame,
    hist: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """Weighted spine rows with absolute amounts (one per distinct month and
    history row of each client)."""
    flags = ("ind_activo_rem", "ind_activo_dex")
    j, wh = _spine_rows(population, calendar, hist, params, sem, TRANSFER_VALUES, flags)

    def amt(c):
        return F.abs(F.coalesce(F.col(f"h.{c}"), F.lit(0))).alias(c)

    def cnt(c, fill=True):
        return (F.coalesce(F.col(f"h.{c}"), F.lit(0)) if fill else F.col(f"h.{c}")).alias(c)

    fill_dex = sem.fill_dex_counts
    return j.select(
        F.col("s.id_master").alias("id_master"),
        F.col("s.per_ref").alias("per_ref"),
        F.col("s.diff_mes").alias("diff_mes"),
        F.col("s.num_periodo_mes").alias("num_periodo_mes"),
        *[F.col(f"s.{f}").alias(f) for f in flags],
        amt("mto_pag_rem"), cnt("num_pag_rem"),
        amt("mto_env_rem"), cnt("num_env_rem"),
        amt("mto_pag_dex"), cnt("num_pag_dex", fill_dex),
        amt("mto_env_dex"), cnt("num_env_dex", fill_dex),
        wh.alias("_wh"),
        (wh * F.col("s.n")).alias(WEIGHT),
    )


def transfer_features(
    population: DataFrame,
    calendar: DataFrame,
    hist: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """26 columns per client, in the original order.  ``population`` may be in
    row form or counted form (``populations.transfer_population_counted``)."""
    rows = transfer_month_rows(population, calendar, hist, params, sem)
    c = F.col
    aggs = [
        F.max("per_ref").alias("per_ref"),
        flag_agg("ind_activo_dex").alias("ind_activo_dex"),
        flag_agg("ind_activo_rem").alias("ind_activo_rem"),
        recency_agg("mto_pag_rem").alias("ult_pag_rem"),
        recency_agg("mto_env_rem").alias("ult_env_rem"),
        recency_agg("mto_pag_dex").alias("ult_pag_dex"),
        recency_agg("mto_env_dex").alias("ult_env_dex"),
        months_active_agg(c("num_pag_rem") + c("num_env_rem")).alias("num_meses_distintos_movs_rem"),
        months_active_agg(c("num_pag_rem")).alias("num_meses_distintos_pag_rem"),
        months_active_agg(c("num_env_rem")).alias("num_meses_distintos_env_rem"),
        months_active_agg(c("num_pag_dex") + c("num_env_dex")).alias("num_meses_distintos_movs_dex"),
        months_active_agg(c("num_pag_dex")).alias("num_meses_distintos_pag_dex"),
        months_active_agg(c("num_env_dex")).alias("num_meses_distintos_env_dex"),
    ]
    for fam in ("pag_rem", "env_rem", "pag_dex", "env_dex"):
        aggs.append(total_agg(f"mto_{fam}").alias(f"tot_mto_{fam}"))
        aggs.append(total_agg(f"num_{fam}").alias(f"tot_num_{fam}"))
    totals = {f"mto_{fam}": f"tot_mto_{fam}_corr" for fam in ("pag_dex", "env_dex", "pag_rem", "env_rem")}
    return in_order(per_client(rows, aggs, totals, params, sem), list(totals.values()), "tot_mto_pag_rem")


def fx_month_rows(
    population: DataFrame,
    calendar: DataFrame,
    hist: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    flags = ("ind_activo_div",) if sem.fx_flag_from_population else ()
    j, wh = _spine_rows(population, calendar, hist, params, sem, FX_VALUES, flags)
    if sem.fx_flag_from_population:
        flag = F.coalesce(F.col("s.ind_activo_div"), F.lit(0))
    else:
        flag = F.lit(0)  # Q2: the original writes a literal 0

    def amt(x):
        return F.abs(F.coalesce(F.col(f"h.{x}"), F.lit(0))).alias(x)

    def cnt(x):
        return F.coalesce(F.col(f"h.{x}"), F.lit(0)).alias(x)

    return j.select(
        F.col("s.id_master").alias("id_master"),
        F.col("s.per_ref").alias("per_ref"),
        F.col("s.diff_mes").alias("diff_mes"),
        F.col("s.num_periodo_mes").alias("num_periodo_mes"),
        flag.alias("ind_activo_div"),
        amt("mto_div_cpa"), cnt("num_div_cpa"),
        amt("mto_div_vta"), cnt("num_div_vta"),
        wh.alias("_wh"),
        (wh * F.col("s.n")).alias(WEIGHT),
    )


def fx_features(
    population: DataFrame,
    calendar: DataFrame,
    hist: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """14 columns per client, in the original order."""
    rows = fx_month_rows(population, calendar, hist, params, sem)
    c = F.col
    totals = {"mto_div_cpa": "tot_mto_cpa_div_corr", "mto_div_vta": "tot_mto_vta_div_corr"}
    aggs = [
        F.max("per_ref").alias("per_ref"),
        flag_agg("ind_activo_div").alias("ind_activo_div"),
        recency_agg("mto_div_cpa").alias("ult_cpa_div"),
        recency_agg("mto_div_vta").alias("ult_vta_div"),
        months_active_agg(c("num_div_cpa") + c("num_div_vta")).alias("num_meses_distintos_movs_div"),
        months_active_agg(c("num_div_cpa")).alias("num_meses_distintos_cpa_div"),
        months_active_agg(c("num_div_vta")).alias("num_meses_distintos_vta_div"),
        total_agg("mto_div_cpa").alias("tot_mto_cpa_div"),
        total_agg("num_div_cpa").alias("tot_num_cpa_div"),
        total_agg("mto_div_vta").alias("tot_mto_vta_div"),
        total_agg("num_div_vta").alias("tot_num_vta_div"),
    ]
    return in_order(per_client(rows, aggs, totals, params, sem), list(totals.values()), "tot_mto_cpa_div")
