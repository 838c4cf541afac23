"""Scored-client output table (X26) and the percentile report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientincome.functions.numeric import round4
from clientincome.operators.quantiles import exact_quantiles

# Output names of the scored-client table (source -> output).
RENAMES = {
    "valor_renta": "ing_renta_indirecta",
    "etiqueta": "cod_grupo_renta",
    "regla": "cod_ingreso_renta",
    "mto_ing_mes": "ing_renta_directa",
    "RFM_cap": "ing_rfm_cap_tot",
    "RFM_servicios": "ing_rfm_servicios",
    "RFM_div": "ing_rfm_div",
    "RFM_dex": "ing_rfm_dex",
    "RFM_rem": "ing_rfm_rem",
    "ing_extraordinarios_cap": "ing_rfm_cap_dif",
    "regr": "ing_pot",
    "ingreso_prom_succ": "ing_inegi",
    "ult_dep_cap": "rec_cap",
    "ult_cpa_div": "rec_div",
    "ult_pag_rem": "rec_rem",
    "ult_pag_dex": "rec_dex",
    "num_meses_distintos_dep_cte_cap": "frec_cap",
    "num_meses_distintos_cpa_div": "frec_div",
    "num_meses_distintos_pag_rem": "frec_rem",
    "num_meses_distintos_pag_dex": "frec_dex",
    "tot_mto_dep_cap_corr": "mto_cap",
    "tot_mto_cpa_div": "mto_cpa_div",
    "tot_mto_vta_div": "mto_vta_div",
    "tot_mto_pag_dex": "mto_pag_dex",
    "tot_mto_env_dex": "mto_env_dex",
    "tot_mto_pag_rem": "mto_pag_rem",
    "tot_mto_env_rem": "mto_env_rem",
    "score_dep_cap": "score_cap",
    "score_cpa_div": "score_div",
    "score_pag_dex": "score_dex",
    "score_pag_rem": "score_rem",
    "per_ref": "num_periodo_mes",
}

# Money and score columns rounded to 4 decimals (half-even).
ROUNDED = [
    "ing_renta_indirecta", "ing_renta_directa", "ing_rfm_cap_tot", "ing_rfm_cap_dif",
    "ing_rfm_servicios", "ing_rfm_rem", "ing_rfm_div", "ing_rfm_dex", "ing_pot", "ing_inegi",
    "mto_cap", "score_cap", "mto_rem", "score_rem", "mto_div", "score_div", "mto_dex", "score_dex",
]

# Output column order.
OUTPUT_COLUMNS = [
    "id_master", "cod_grupo_renta", "cod_ingreso_renta", "cod_tipo_nomina", "cod_flujo",
    "ind_activo_cap", "ind_activo_dex", "ind_activo_rem", "ind_activo_div", "ind_activo_afr",
    "ind_activo_cre", "ing_renta_indirecta", "ing_renta_directa", "ing_rfm_cap_tot",
    "ing_rfm_cap_dif", "ing_rfm_servicios", "ing_rfm_rem", "ing_rfm_div", "ing_rfm_dex",
    "ing_pot", "ing_inegi", "ind_renta_directa", "ind_rfm_cap_tot", "ind_rfm_cap_dif",
    "ind_rfm_servicios", "ind_rfm_rem", "ind_rfm_div", "ind_rfm_dex", "ind_pot", "ind_inegi",
    "rec_cap", "frec_cap", "mto_cap", "score_cap", "rec_rem", "frec_rem", "mto_rem",
    "score_rem", "rec_div", "frec_div", "mto_div", "score_div", "rec_dex", "frec_dex",
    "mto_dex", "score_dex", "edad", "cod_postal", "num_periodo_mes",
]

# Report percentiles and their column names.
REPORT_PERCENTILES = [0.01, 0.05, 0.1, 0.15, 0.25, 0.35, 0.5, 0.6, 0.75, 0.9, 0.95, 0.99]
REPORT_PERCENTILE_NAMES = ["p1", "p5", "p10", "p15", "p25", "p35", "p50", "p60", "p75", "p90", "p95", "p99"]
OVERALL_PERCENTILES = [0.25, 0.5, 0.75]
OVERALL_PERCENTILE_NAMES = ["p25", "p50", "p75"]


def scored_clients(scored: DataFrame) -> DataFrame:
    """Rename, round the 18 money/score columns, project the 49 outputs."""
    out = scored.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in scored.columns})
    out = out.withColumns({c: round4(c) for c in ROUNDED})
    return out.select(*OUTPUT_COLUMNS)


# Proven bound on report groups: 5 group labels x 12 rule labels (fixed
# vocabularies of the rule cascade, including the unmatched label).
MAX_REPORT_GROUPS = 5 * 12


def describe(
    df: DataFrame, value: str, group_cols, probs, names, accuracy: int = 10000,
    max_groups: int | None = None,
) -> DataFrame:
    """count / mean / std / min / percentiles / max of ``value`` per group.

    Count skips missing values but every group is kept (Q30).  Moments are
    partial aggregates in the first pass of the exact distributed percentiles;
    ``df`` is read twice in all.
    """
    x = F.col("_x")
    moments = [F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")]
    return exact_quantiles(df, value, probs, list(group_cols), accuracy, names, max_groups=max_groups, extra=moments)


def report(scored_out: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Per (cod_grupo_renta, cod_ingreso_renta): count, share of all counted
    clients (prop, %), mean, std, min, 12 percentiles, max; statistics are
    rounded half-even to 4 decimals.

    The grouped result has one row per label pair (a fixed vocabulary), so the
    share's total is a window over that small table.
    """
    keys = ["cod_grupo_renta", "cod_ingreso_renta"]
    d = describe(scored_out, "ing_renta_indirecta", keys, REPORT_PERCENTILES,
                 REPORT_PERCENTILE_NAMES, accuracy, max_groups=MAX_REPORT_GROUPS)
    # at most MAX_REPORT_GROUPS rows: a window over all of them is one small task
    total = F.sum("count").over(Window.partitionBy())
    # no counted client at all: the share is missing, not an error
    d = d.withColumn("prop", F.lit(100.0) * F.col("count") / F.nullif(total, F.lit(0)))
    stats = ["prop", "mean", "std", "min", *REPORT_PERCENTILE_NAMES, "max"]
    return d.select(*keys, "count", *[round4(c).alias(c) for c in stats])


def report_overall(scored_out: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Global describe of the estimated income (A13), rounded like ``report``."""
    d = describe(scored_out, "ing_renta_indirecta", [], OVERALL_PERCENTILES,
                 OVERALL_PERCENTILE_NAMES, accuracy)
    stats = ["mean", "std", "min", *OVERALL_PERCENTILE_NAMES, "max"]
    return d.select("count", *[round4(c).alias(c) for c in stats])
