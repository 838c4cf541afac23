"""Recency/frequency scores, RFM incomes, the rule cascade and indicators.

The original runs this stage in pandas on the driver after collecting every
client.  Here it is one narrow pass of column expressions over the client
table: two global maxima are computed by one aggregate and broadcast as a
one-row table, everything else is per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientincome.functions.numeric import dbl, ieee_div
from clientincome.semantics import REFERENCE, Semantics

SENTINEL = 99
GATE = 0.5           # fixed value: score threshold of every family
OTHER_FLOOR = 100    # fixed value: fallback incomes at or below it use census

# (score name, recency column) for the ten recency scores
RECENCY = [
    ("score_rec_dep_cap", "ult_dep_cap"), ("score_rec_ret_cap", "ult_ret_cap"),
    ("score_rec_dep_cte_cap", "ult_dep_cte_cap"), ("score_rec_ret_cte_cap", "ult_ret_cte_cap"),
    ("score_rec_cpa_div", "ult_cpa_div"), ("score_rec_vta_div", "ult_vta_div"),
    ("score_rec_pag_dex", "ult_pag_dex"), ("score_rec_env_dex", "ult_env_dex"),
    ("score_rec_pag_rem", "ult_pag_rem"), ("score_rec_env_rem", "ult_env_rem"),
]
FREQUENCY_FAMILIES = [
    "movs_cap", "dep_cap", "ret_cap", "movs_cte_cap", "dep_cte_cap", "ret_cte_cap",
    "movs_div", "cpa_div", "vta_div", "movs_rem", "pag_rem", "env_rem",
    "movs_dex", "pag_dex", "env_dex",
]
FREQUENCY = [(f"score_frec_{f}", f"num_meses_distintos_{f}") for f in FREQUENCY_FAMILIES]
# gate name -> (recency score, frequency score)
GATES = {
    "score_dep_cap": ("score_rec_dep_cte_cap", "score_frec_dep_cte_cap"),
    "score_cpa_div": ("score_rec_cpa_div", "score_frec_cpa_div"),
    "score_vta_div": ("score_rec_vta_div", "score_frec_vta_div"),
    "score_pag_dex": ("score_rec_pag_dex", "score_frec_pag_dex"),
    "score_env_dex": ("score_rec_env_dex", "score_frec_env_dex"),
    "score_pag_rem": ("score_rec_pag_rem", "score_frec_pag_rem"),
    "score_env_rem": ("score_rec_env_rem", "score_frec_env_rem"),
}
# service RFM -> (gate, inflow total, outflow total, months with inflow)
SERVICES = {
    "RFM_div": ("score_cpa_div", "tot_mto_cpa_div", "tot_mto_vta_div", "num_meses_distintos_cpa_div"),
    "RFM_dex": ("score_pag_dex", "tot_mto_pag_dex", "tot_mto_env_dex", "num_meses_distintos_pag_dex"),
    "RFM_rem": ("score_pag_rem", "tot_mto_pag_rem", "tot_mto_env_rem", "num_meses_distintos_pag_rem"),
}

# Rule and group labels.
L_DIRECT = "RENTA DIRECTA"
L_CAP = "RFM(CAPTACION)"
L_SERVICES = "SERVICIOS"
L_CENSUS = "INEGI"
L_POTENTIAL = "POTENCIALES"
L_EXTRA = "INGRESOS EXTRAORDINARIOS CAPTACION"
L_CAPACITY = "CAPACIDAD DE PAGO"
G_OBSERVED, G_ESTIMATED, G_NOT_ESTIMATED, G_NONE = (
    "01 NOMINA OBSERVADA", "02 NOMINA ESTIMADA", "03 NOMINA NO ESTIMADA", "04 SIN RENTA DIRECTA",
)
T_OBSERVED, T_ESTIMATED, T_NOT_ESTIMATED, T_EMPTY = (
    "01 OBSERVADA", "02 ESTIMADA", "03 NO ESTIMADA", "VACIO",
)
FLOW_CASH = "EFECTIVO"
UNMATCHED = "nan"  # what the original's float-NaN label turns into


def global_maxima(features: DataFrame) -> DataFrame:
    """One row: max deposit recency and max deposit frequency below 99.
    The same deposit maxima normalise every family (Q18)."""
    return features.agg(
        F.max(F.when(F.col("ult_dep_cap") < SENTINEL, F.col("ult_dep_cap"))).alias("max_rec"),
        F.max(
            F.when(F.col("num_meses_distintos_dep_cap") < SENTINEL, F.col("num_meses_distintos_dep_cap"))
        ).alias("max_frec"),
    )


def with_maxima(features: DataFrame) -> DataFrame:
    return features.crossJoin(F.broadcast(global_maxima(features)))


def recency_score(u: Column) -> Column:
    mx = dbl("max_rec")
    return F.when(u == SENTINEL, F.lit(0.0)).otherwise(ieee_div(mx - (dbl(u) - 1), mx))


def frequency_score(n: Column) -> Column:
    return F.when(n == 0, F.lit(0.0)).otherwise(ieee_div(n, F.col("max_frec")))


def gate(r: Column, q: Column) -> Column:
    """0 unless both scores exceed the threshold and recency >= frequency."""
    return F.when((q <= GATE) | (r <= GATE) | (r < q), F.lit(0.0)).otherwise((r + q) / 2)


def score_rfm(features_with_maxima: DataFrame) -> DataFrame:
    """Adds the 10 recency and 15 frequency scores."""
    cols = {name: recency_score(F.col(src)) for name, src in RECENCY}
    cols.update({name: frequency_score(F.col(src)) for name, src in FREQUENCY})
    return features_with_maxima.withColumns(cols)


def score_gates(scored: DataFrame) -> DataFrame:
    """Adds the seven gated scores."""
    return scored.withColumns({g: gate(F.col(r), F.col(q)) for g, (r, q) in GATES.items()})


def rfm_income(gated: DataFrame) -> DataFrame:
    """RFM incomes (X19) and extraordinary deposit income."""
    rfm_cap = F.when(F.col("score_dep_cap") == 0, F.lit(0.0)).otherwise(
        ieee_div("tot_mto_dep_cte_cap_corr", "num_meses_distintos_dep_cap")
    )
    cols = {"RFM_cap": rfm_cap}
    for name, (g, tin, tout, months) in SERVICES.items():
        cols[name] = F.when(
            F.col(g) > GATE, F.col(g) * ieee_div(dbl(tin) - dbl(tout), F.col(months))
        ).otherwise(F.lit(0.0))
    out = gated.withColumns(cols)
    svc = (
        F.coalesce(F.col("RFM_div"), F.lit(0.0))
        + F.coalesce(F.col("RFM_dex"), F.lit(0.0))
        + F.coalesce(F.col("RFM_rem"), F.lit(0.0))
    )
    out = out.withColumn("RFM_servicios", svc)
    gap = F.col("RFM_cap") - dbl("mto_ing_mes")
    return out.withColumn(
        "ing_extraordinarios_cap",
        F.when(gap > 0, gap).otherwise(F.lit(0.0)) * F.col("score_dep_cap"),
    )


def income_other(df: DataFrame) -> DataFrame:
    """Fallback income and its label."""
    best = F.greatest(dbl("mto_ing_mes"), F.col("RFM_cap"), F.col("RFM_servicios"), dbl("regr"))
    out = df.withColumn(
        "ingresos_otros",
        F.when(best > OTHER_FLOOR, best).otherwise(F.col("ingreso_prom_succ")),
    )
    o = F.col("ingresos_otros")
    label = (
        F.when(o == dbl("mto_ing_mes"), F.lit(L_DIRECT))
        .when(o == F.col("RFM_cap"), F.lit(L_CAP))
        .when(o == F.col("RFM_servicios"), F.lit(L_SERVICES))
        .when(o == F.col("ingreso_prom_succ"), F.lit(L_CENSUS))
        .otherwise(F.lit(L_POTENTIAL))
    )
    return out.withColumn("etiqueta_otros", label)


def _conditions(sem: Semantics):
    t, flow = F.col("cod_tipo_nomina"), F.col("cod_flujo")
    if sem.num_flujos_as_count:
        n = F.col("num_flujos")
        has_flow, no_flow = n >= 1, n == 0
        empty = t.isin(T_EMPTY, "NO DISPONIBLE") | no_flow
    else:
        # Q16: the flow count is replaced by "is not null", always true here
        has_flow, no_flow = F.col("num_flujos").isNotNull(), F.lit(False)
        empty = (t == T_EMPTY) | no_flow
    return {
        "observed": t == T_OBSERVED,
        "est_cash": (t == T_ESTIMATED) & (flow == FLOW_CASH),
        "est_other": (t == T_ESTIMATED) & (flow != FLOW_CASH),
        "estimated": t == T_ESTIMATED,
        "not_est": (t == T_NOT_ESTIMATED) & has_flow,
        "empty": empty,
    }


def income_rules(df: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """``valor_renta``, ``regla`` and ``etiqueta``.

    The original overwrites in sequence (later rules win); the chains below
    list the same rules from last to first.
    """
    c = _conditions(sem)
    inc, cap, svc = dbl("mto_ing_mes"), F.col("RFM_cap"), F.col("RFM_servicios")
    ext = F.col("ing_extraordinarios_cap")
    inc_ext = inc + ext
    value = (
        F.when(c["empty"], F.col("ingresos_otros"))
        .when(c["not_est"], F.when(inc_ext >= svc, inc_ext).otherwise(svc))
        .when(c["est_other"], inc + F.when(ext >= svc, ext).otherwise(svc))
        .when(c["est_cash"], F.when(inc_ext >= svc, inc_ext).otherwise(svc))
        .when(c["observed"], inc + F.when(cap >= svc, cap).otherwise(svc))
    )
    unmatched = F.lit(None).cast("string") if sem.null_unmatched_label else F.lit(UNMATCHED)
    extra_or_direct = F.when(ext > 0, F.lit(f"{L_DIRECT} + {L_EXTRA}")).otherwise(F.lit(L_DIRECT))
    svc_or_blank = F.when(svc > 0, F.lit(L_SERVICES)).otherwise(F.lit(""))
    direct_svc = F.when(svc > 0, F.lit(f"{L_DIRECT} + {L_SERVICES}")).otherwise(F.lit(L_DIRECT))
    rule = (
        F.when(
            c["empty"],
            F.when(F.col("etiqueta_otros") == L_DIRECT, F.lit(L_CAPACITY)).otherwise(F.col("etiqueta_otros")),
        )
        .when(c["not_est"], F.when(inc_ext >= svc, extra_or_direct).otherwise(svc_or_blank))
        .when(c["est_other"], F.when(ext >= svc, extra_or_direct).otherwise(direct_svc))
        .when(c["est_cash"], F.when(inc_ext >= svc, extra_or_direct).otherwise(svc_or_blank))
        .when(
            c["observed"],
            F.when(
                cap >= svc,
                F.when(cap > 0, F.lit(f"{L_DIRECT} + {L_CAP}")).otherwise(F.lit(L_DIRECT)),
            ).otherwise(direct_svc),
        )
        .otherwise(unmatched)
    )
    group = (
        F.when(c["empty"], F.lit(G_NONE))
        .when(c["not_est"], F.lit(G_NOT_ESTIMATED))
        .when(c["estimated"], F.lit(G_ESTIMATED))
        .when(c["observed"], F.lit(G_OBSERVED))
        .otherwise(unmatched)
    )
    return df.withColumns({"valor_renta": value, "regla": rule, "etiqueta": group})


def _has(label: str, regex: bool = False) -> Column:
    r = F.col("regla")
    hit = r.rlike(label) if regex else r.contains(label)
    return F.coalesce(hit, F.lit(False))


def indicators(df: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """Nine 1/0 indicators and three net positive amounts (X25), named as in
    the output table (Spark resolves names case-insensitively, so an
    indicator called like an income column would replace it).

    REFERENCE matches 'RFM(CAPTACION)' as a regular expression, as the
    original does, so that indicator never fires (Q17).
    """

    def flag(cond: Column) -> Column:
        return F.when(cond, F.lit(1)).otherwise(F.lit(0))

    def net(a: str, b: str) -> Column:
        d = dbl(a) - dbl(b)
        return F.when(d > 0, d).otherwise(F.lit(0.0))

    out = df.withColumns(
        {
            "ind_renta_directa": flag(
                (_has(L_DIRECT) | _has(L_CAPACITY)) & (dbl("mto_ing_mes") > 0)
            ),
            "ind_rfm_cap_dif": flag(
                _has(L_EXTRA) & (F.col("ing_extraordinarios_cap") > 0)
            ),
            "ind_rfm_cap_tot": flag(
                _has(L_CAP, regex=not sem.literal_rfm_label) & (F.col("RFM_cap") > 0)
            ),
            "ind_rfm_servicios": flag(_has(L_SERVICES) & (F.col("RFM_servicios") > 0)),
            "ind_pot": flag(_has(L_POTENTIAL) & (dbl("regr") > 0)),
            "ind_inegi": flag(_has(L_CENSUS) & (F.col("ingreso_prom_succ") > 0)),
        }
    )
    return out.withColumns(
        {
            "ind_rfm_div": flag((F.col("ind_rfm_servicios") == 1) & (F.col("RFM_div") > 0)),
            "ind_rfm_dex": flag((F.col("ind_rfm_servicios") == 1) & (F.col("RFM_dex") > 0)),
            "ind_rfm_rem": flag((F.col("ind_rfm_servicios") == 1) & (F.col("RFM_rem") > 0)),
            "mto_div": net("tot_mto_cpa_div", "tot_mto_vta_div"),
            "mto_dex": net("tot_mto_pag_dex", "tot_mto_env_dex"),
            "mto_rem": net("tot_mto_pag_rem", "tot_mto_env_rem"),
        }
    )


def score_all(clients: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """Scores through indicators on a client table that already carries
    ``regr`` and the (adjusted) ``ingreso_prom_succ``."""
    s = score_rfm(with_maxima(clients))
    s = rfm_income(score_gates(s))
    s = income_other(s)
    s = income_rules(s, sem)
    return indicators(s, sem)
