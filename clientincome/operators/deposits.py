"""Deposit features: account-month extraction, client-month sums, client
features and enrichment with income and journey data.

Plan shape (see README, "Scale"): the account history is filtered to the
history window at the scan, reduced to client-months by two partial-combining
aggregations (whole-row dedupe, then sums), and only then joined to the
population.  A client with a third of all account rows is therefore combined
map-side before any shuffle on the client key, and every later per-client
step sees at most one row per history month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientincome.functions.numeric import floor_small, sum_nullable
from clientincome.functions.periods import recency
from clientincome.operators import copies
from clientincome.operators.populations import counted
from clientincome.operators.sampling import first_per_key
from clientincome.operators.services import (
    WEIGHT,
    last_month_agg,
    months_active_agg,
    recency_agg,
    total_agg,
    trimmed_agg,
)
from clientincome.semantics import REFERENCE, RunParams, Semantics
from clientincome.sources.fixtures import CHANNELS

WITHOUT_PAYROLL = tuple(c for c in CHANNELS if c != "nomina")

MEASURES = (
    "mto_dep_cap", "num_dep_cap", "mto_ret_cap", "num_ret_cap",
    "mto_dep_cte_cap", "num_dep_cte_cap", "mto_ret_cte_cap", "num_ret_cte_cap",
)


def _channel_sum(kind: str, direction: str, channels, fill: bool) -> Column:
    return sum_nullable(*[f"{kind}_{direction}_{c}" for c in channels], fill=fill)


def account_months(
    account_hist: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """Account-month rows of the history window with the eight channel sums.

    ``*_cap`` sums the five channels, ``*_cte_cap`` the four without payroll.
    A NULL channel nulls its sum (Q31) unless ``fill_null_measures``.
    REFERENCE then drops whole duplicate rows, which also merges identical
    account-months of different accounts (Q4).
    """
    fill = sem.fill_null_measures
    cols = []
    for channels, suffix in ((CHANNELS, "cap"), (WITHOUT_PAYROLL, "cte_cap")):
        for direction in ("dep", "ret"):
            for kind in ("mto", "num"):
                cols.append(_channel_sum(kind, direction, channels, fill).alias(f"{kind}_{direction}_{suffix}"))
    rows = account_hist.where(F.col("num_periodo_mes").between(params.start, params.mes)).select(
        "id_master",
        F.lit(params.mes).alias("per_ref"),
        "num_periodo_mes",
        recency(F.lit(params.mes), F.col("num_periodo_mes")).alias("diff_mes"),
        *cols,
    ).select("id_master", "per_ref", "num_periodo_mes", "diff_mes", *MEASURES)
    return rows.dropDuplicates() if sem.dedupe_account_months else rows


def client_months(account_rows: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """Client-month sums (A1): ``|sum| < 100 -> 0`` on deposits, ``|sum|`` on
    withdrawal amounts, plain sums on withdrawal counts.  REFERENCE floors the
    deposit counts too (Q3)."""

    def floored(c):
        return floor_small(F.sum(c)).alias(c)

    def counted(c):
        return floored(c) if sem.floor_deposit_counts else F.sum(c).alias(c)

    return account_rows.groupBy("id_master", "num_periodo_mes", "per_ref", "diff_mes").agg(
        floored("mto_dep_cap"),
        counted("num_dep_cap"),
        F.abs(F.sum("mto_ret_cap")).alias("mto_ret_cap"),
        F.sum("num_ret_cap").alias("num_ret_cap"),
        floored("mto_dep_cte_cap"),
        counted("num_dep_cte_cap"),
        F.abs(F.sum("mto_ret_cte_cap")).alias("mto_ret_cte_cap"),
        F.sum("num_ret_cte_cap").alias("num_ret_cte_cap"),
    )


def client_features(
    population: DataFrame,
    months: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """27 columns per (id_master, per_ref).

    A client repeated in the population by rank ties (Q10) counts its months
    once per copy, as in the original; the population arrives counted (or is
    counted here), so the copies are a weight ``n`` on the client's at most
    one row per history month, never extra rows.  REFERENCE drops clients
    without account rows (Q34).
    """
    flags = ("ind_activo_cap", "ind_activo_afr", "ind_activo_cre")
    p = counted(population, flag_maxes=flags).alias("p")
    m = months.drop("per_ref").alias("m")
    how = "left" if sem.deposits_keep_population else "inner"
    j = p.join(m, F.col("p.id_master") == F.col("m.id_master"), how).select(
        F.col("p.id_master").alias("id_master"),
        F.col("p.per_ref").alias("per_ref"),
        *[F.col(f"p.{f}").alias(f) for f in flags],
        "m.num_periodo_mes", "m.diff_mes",
        *[F.col(f"m.{c}") for c in MEASURES],
        F.col("p.n").cast("bigint").alias(WEIGHT),
    )
    c = F.col
    aggs = [
        F.max("ind_activo_cap").alias("ind_activo_cap"),
        F.max("ind_activo_afr").alias("ind_activo_afr"),
        F.max("ind_activo_cre").alias("ind_activo_cre"),
        recency_agg("mto_dep_cap").alias("ult_dep_cap"),
        recency_agg("mto_ret_cap").alias("ult_ret_cap"),
        recency_agg("mto_dep_cte_cap").alias("ult_dep_cte_cap"),
        recency_agg("mto_ret_cte_cap").alias("ult_ret_cte_cap"),
        months_active_agg(c("num_dep_cap") + c("num_ret_cap")).alias("num_meses_distintos_movs_cap"),
        months_active_agg(c("num_dep_cap")).alias("num_meses_distintos_dep_cap"),
        months_active_agg(c("num_ret_cap")).alias("num_meses_distintos_ret_cap"),
        months_active_agg(c("num_dep_cte_cap") + c("num_ret_cte_cap")).alias("num_meses_distintos_movs_cte_cap"),
        months_active_agg(c("num_dep_cte_cap")).alias("num_meses_distintos_dep_cte_cap"),
        months_active_agg(c("num_ret_cte_cap")).alias("num_meses_distintos_ret_cte_cap"),
    ]
    for m_ in MEASURES:
        total = total_agg(m_)
        if sem.deposits_keep_population:
            total = F.coalesce(total, F.lit(0))
        aggs.append(total.alias(f"tot_{m_}"))
    aggs += [
        trimmed_agg("mto_dep_cap", params, sem).alias("tot_mto_dep_cap_corr"),
        trimmed_agg("mto_dep_cte_cap", params, sem).alias("tot_mto_dep_cte_cap_corr"),
        last_month_agg("mto_dep_cap").alias("mto_tot_dep_cap_ult_mes"),
        last_month_agg("mto_dep_cte_cap").alias("mto_dep_cte_cap_ult_mes"),
    ]
    return j.groupBy("id_master", "per_ref").agg(*aggs)


def deposit_features(
    account_hist: DataFrame,
    population: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    # population ids are > 0: unresolved ids (which may be a large share of
    # the history) are dropped at the scan instead of being aggregated
    resolved = account_hist.where(F.col("id_master") > 0)
    months = client_months(account_months(resolved, params, sem), sem)
    return client_features(population, months, params, sem)


INCOME_COLS = (
    ("cod_flujo", "NO DISPONIBLE"), ("mto_ing_mes", 0), ("num_flujos", 0),
    ("cod_tipo_nomina", "NO DISPONIBLE"), ("cod_tipo_nomina_detalle", "NO DISPONIBLE"),
    ("ind_cre_ov", 0), ("cod_estabilidad_mto", "NO DISPONIBLE"),
    ("cod_estabilidad_periodidad", "NO DISPONIBLE"),
)
JOURNEY_COLS = (("cod_perfil_trx", "NO DISPONIBLE"), ("saldo", 0), ("potencial", 0), ("recorrido", 0))
FEATURE_COLS = (
    "ind_activo_cap", "ind_activo_afr", "ind_activo_cre",
    "ult_dep_cap", "ult_ret_cap", "ult_dep_cte_cap", "ult_ret_cte_cap",
    "num_meses_distintos_movs_cap", "num_meses_distintos_dep_cap", "num_meses_distintos_ret_cap",
    "num_meses_distintos_movs_cte_cap", "num_meses_distintos_dep_cte_cap",
    "num_meses_distintos_ret_cte_cap",
    "tot_mto_dep_cap", "tot_num_dep_cap", "tot_mto_ret_cap", "tot_num_ret_cap",
    "tot_mto_dep_cte_cap", "tot_num_dep_cte_cap", "tot_mto_ret_cte_cap", "tot_num_ret_cte_cap",
    "tot_mto_dep_cap_corr", "tot_mto_dep_cte_cap_corr",
)
LAST_MONTH_COLS = ("mto_tot_dep_cap_ult_mes", "mto_dep_cte_cap_ult_mes")


def month_slice(df: DataFrame, params: RunParams, cols, sem: Semantics) -> DataFrame:
    """A client-month dimension restricted to the reference month and to
    resolved ids (the only ones a population holds), as distinct rows with
    their copy count ``_c`` (one row per client when deduplicated)."""
    s = df.where((F.col("num_periodo_mes") == params.mes) & (F.col("id_master") > 0)).select(
        "id_master", *cols
    )
    if sem.dedupe_dimensions:
        return first_per_key(s, ["id_master"]).withColumn(copies.COUNT, F.lit(1).cast("bigint"))
    return copies.counted_rows(s, ["id_master"])


def enrich(
    features: DataFrame,
    income: DataFrame,
    journey: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """Deposit features + income + journey of the reference month.

    The original joins on (id, per_ref = month).  Every feature row has
    ``per_ref = mes``, so the dimensions are cut to that month at the scan and
    joined on the id alone: the features keep their id partitioning and only
    the dimensions shuffle.  Repeated dimension keys repeat clients (Q29)
    unless deduplicated; the repeats travel as the row weight ``_w`` (see
    ``operators.copies``; ``copies.expand`` turns them into rows).
    REFERENCE drops the two last-month columns (Q6).
    """
    f = features.alias("a")
    inc = month_slice(income, params, [c for c, _ in INCOME_COLS], sem).alias("b")
    jou = month_slice(journey, params, [c for c, _ in JOURNEY_COLS], sem).alias("c")
    j = f.join(inc, F.col("a.id_master") == F.col("b.id_master"), "left").join(
        jou, F.col("a.id_master") == F.col("c.id_master"), "left"
    )
    keep = FEATURE_COLS + (LAST_MONTH_COLS if sem.keep_dropped_columns else ())
    return j.select(
        F.col("a.id_master").alias("id_master"),
        F.col("a.per_ref").alias("per_ref"),
        *[F.coalesce(F.col(f"b.{c}"), F.lit(d)).alias(c) for c, d in INCOME_COLS],
        *[F.coalesce(F.col(f"c.{c}"), F.lit(d)).alias(c) for c, d in JOURNEY_COLS],
        *[F.col(f"a.{c}").alias(c) for c in keep],
        (copies.weight_of(features, "a") * copies.times_count("b") * copies.times_count("c")).alias(copies.WEIGHT),
    )
