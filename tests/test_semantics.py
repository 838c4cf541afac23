"""One small hand-made table per documented quirk, under both presets."""

import pytest
from pyspark.sql import functions as F

from clientincome.operators import deposits, populations, scoring, services
from clientincome.semantics import CORRECTED, REFERENCE, RunParams

P = RunParams(200012, 6)

HIST_SCHEMA = (
    "id_master BIGINT, num_periodo_mes INT, ind_activo_div INT, mto_div_cpa DOUBLE, "
    "num_div_cpa BIGINT, mto_div_vta DOUBLE, num_div_vta BIGINT"
)


def _calendar(spark, months=(200007, 200008, 200009, 200010, 200011, 200012)):
    return spark.createDataFrame([(m,) for m in months], "num_periodo_mes INT")


def test_q1_q2_fx_recency_and_flag(spark):
    pop = spark.createDataFrame([(1, 200012, 1)], "id_master BIGINT, per_ref INT, ind_activo_div INT")
    hist = spark.createDataFrame(
        [(1, 200008, 1, 500.0, 2, None, None), (1, 200012, 1, 0.0, 0, 10.0, 1)], HIST_SCHEMA
    )
    ref = services.fx_features(pop.drop("ind_activo_div"), _calendar(spark), hist, P, REFERENCE).first()
    assert ref.ult_cpa_div == 1          # Q1: always 1 when any month has an amount
    assert ref.ind_activo_div == 0       # Q2: literal 0
    cor = services.fx_features(pop, _calendar(spark), hist, P, CORRECTED).first()
    assert cor.ult_cpa_div == 5          # 200008 is five months before 200012, counting it as 1
    assert cor.ult_vta_div == 1
    assert cor.ind_activo_div == 1


def test_spine_keeps_clients_without_calendar_months(spark):
    pop = spark.createDataFrame([(1, 200012, 1, 0)], "id_master BIGINT, per_ref INT, ind_activo_rem INT, ind_activo_dex INT")
    spine = services.month_spine(pop, _calendar(spark, (199901,)), P).collect()
    assert len(spine) == 1 and spine[0].num_periodo_mes is None
    spine = services.month_spine(pop, _calendar(spark), P).collect()
    assert sorted(r.num_periodo_mes for r in spine) == list(range(200007, 200013))


def _account_rows(spark, rows):
    cols = ["id_master BIGINT", "num_cuenta INT", "num_periodo_mes INT"]
    for d in ("dep", "ret"):
        for c in ("transferencia", "cheque", "efectivo", "nomina", "traspaso_terceros"):
            cols += [f"mto_{d}_{c} DOUBLE", f"num_{d}_{c} INT"]
    return spark.createDataFrame(rows, ", ".join(cols))


def _acct(id_, cuenta, per, dep_amt, dep_num, null_channel=False):
    vals = [id_, cuenta, per]
    for d in ("dep", "ret"):
        for c in range(5):
            if d == "dep" and c == 0:
                vals += [dep_amt, dep_num]
            elif null_channel and d == "dep" and c == 1:
                vals += [None, None]
            else:
                vals += [0.0, 0]
    return tuple(vals)


def test_q3_q4_q31_deposit_floors_and_dedupe(spark):
    rows = [
        _acct(1, 0, 200012, 300.0, 50),   # two identical accounts in one month (Q4)
        _acct(1, 1, 200012, 300.0, 50),
        _acct(1, 0, 200011, 50.0, 150, null_channel=True),  # NULL channel (Q31)
    ]
    hist = _account_rows(spark, rows)
    ref = {r.num_periodo_mes: r for r in deposits.client_months(deposits.account_months(hist, P, REFERENCE), REFERENCE).collect()}
    assert float(ref[200012].mto_dep_cap) == 300.0   # duplicates merged
    assert float(ref[200012].num_dep_cap) == 0       # count floored (Q3)
    assert ref[200011].mto_dep_cap is None            # NULL channel nulls the sum
    cor = {r.num_periodo_mes: r for r in deposits.client_months(deposits.account_months(hist, P, CORRECTED), CORRECTED).collect()}
    assert float(cor[200012].mto_dep_cap) == 600.0
    assert int(cor[200012].num_dep_cap) == 100
    assert float(cor[200011].mto_dep_cap) == 0.0      # |50| < 100 floors the amount
    assert int(cor[200011].num_dep_cap) == 150


def test_q10_rank_ties_repeat_clients(spark):
    dh = spark.createDataFrame(
        [(2, 200012, 1, 10.0, "PF"), (2, 200012, 1, 10.0, "PF"), (3, 200012, 0, 99.0, "PF"), (3, 200012, 1, 5.0, "PM")],
        "id_master BIGINT, num_periodo_mes INT, ind_activo_cap INT, sld_tot_prod_cap DOUBLE, cod_tipo_persona STRING",
    )
    inc = spark.createDataFrame([], "id_master BIGINT, num_periodo_mes INT, ind_cre INT, ind_afr INT")
    ref = populations.deposit_population(dh, inc, P, REFERENCE).collect()
    assert sorted(r.id_master for r in ref) == [2, 2]   # 3: rank-1 row is inactive (Q11)
    cor = populations.deposit_population(dh, inc, P, CORRECTED).collect()
    assert [r.id_master for r in cor] == [2]


def _scored_row(spark, **kw):
    base = dict(
        id_master=1, mto_ing_mes=0.0, RFM_cap=0.0, RFM_servicios=0.0, ing_extraordinarios_cap=0.0,
        ingresos_otros=50.0, etiqueta_otros="INEGI", cod_tipo_nomina="NO DISPONIBLE",
        cod_flujo="NO DISPONIBLE", num_flujos=0, regr=0.0, ingreso_prom_succ=50.0,
        RFM_div=0.0, RFM_dex=0.0, RFM_rem=0.0, tot_mto_cpa_div=0.0, tot_mto_vta_div=0.0,
        tot_mto_pag_dex=0.0, tot_mto_env_dex=0.0, tot_mto_pag_rem=0.0, tot_mto_env_rem=0.0,
    )
    base.update(kw)
    return spark.createDataFrame([tuple(base.values())], list(base.keys()))


def test_q15_q16_unmatched_and_flow_count(spark):
    df = _scored_row(spark)
    ref = scoring.income_rules(df, REFERENCE).first()
    assert ref.regla == "nan" and ref.etiqueta == "nan" and ref.valor_renta is None
    cor = scoring.income_rules(df, CORRECTED).first()
    assert cor.etiqueta == "04 SIN RENTA DIRECTA" and cor.valor_renta == 50.0 and cor.regla == "INEGI"


def test_q17_rfm_label_regex(spark):
    df = _scored_row(spark, cod_tipo_nomina="01 OBSERVADA", mto_ing_mes=1000.0, RFM_cap=500.0, num_flujos=1)
    ref = scoring.indicators(scoring.income_rules(df, REFERENCE), REFERENCE).first()
    assert ref.regla == "RENTA DIRECTA + RFM(CAPTACION)"
    assert ref.valor_renta == 1500.0
    assert ref.ind_rfm_cap_tot == 0 and ref.ind_renta_directa == 1
    cor = scoring.indicators(scoring.income_rules(df, CORRECTED), CORRECTED).first()
    assert cor.ind_rfm_cap_tot == 1


def test_rule_cascade_estimated_cash(spark):
    df = _scored_row(spark, cod_tipo_nomina="02 ESTIMADA", cod_flujo="EFECTIVO", mto_ing_mes=10.0,
                     RFM_servicios=30.0, ing_extraordinarios_cap=5.0)
    r = scoring.income_rules(df, REFERENCE).first()
    assert (r.valor_renta, r.regla, r.etiqueta) == (30.0, "SERVICIOS", "02 NOMINA ESTIMADA")
    df = _scored_row(spark, cod_tipo_nomina="02 ESTIMADA", cod_flujo="EFECTIVO", mto_ing_mes=0.0)
    assert scoring.income_rules(df, REFERENCE).first().regla == "RENTA DIRECTA"
    df = _scored_row(spark, cod_tipo_nomina="03 NO ESTIMADA", mto_ing_mes=-5.0, RFM_servicios=0.0)
    r = scoring.income_rules(df, REFERENCE).first()
    assert r.regla == "" and r.etiqueta == "03 NOMINA NO ESTIMADA"


def test_gate(spark):
    df = spark.createDataFrame([(0.9, 0.6), (0.6, 0.9), (0.5, 0.9), (1.0, 1.0)], "r DOUBLE, q DOUBLE")
    got = [x[0] for x in df.select(scoring.gate(F.col("r"), F.col("q"))).collect()]
    assert got == [0.75, 0.0, 0.0, 1.0]


ENV_SCHEMA = (
    "id_master BIGINT, num_periodo_mes INT, ind_activo_rem INT, ind_activo_dex INT, "
    "mto_pag_rem DOUBLE, num_pag_rem BIGINT, mto_env_rem DOUBLE, num_env_rem BIGINT, "
    "mto_pag_dex DOUBLE, num_pag_dex BIGINT, mto_env_dex DOUBLE, num_env_dex BIGINT"
)


def _env_hist(spark):
    rows = [
        # month, pag_rem, env_rem, pag_dex (count NULL), env_dex
        (1, 200007 + k, 1, None, float(10 * (k + 1)), 1, 0.0, 0, 5.0, None, 7.0, 2)
        for k in range(6)
    ]
    return spark.createDataFrame(rows, ENV_SCHEMA)


def test_q5_q7_q32_transfer_features(spark):
    hist = _env_hist(spark)
    pop_ref = services.transfer_features(
        populations.transfer_population(hist.withColumn("ind_activo_dex", F.lit(1)), _contact(spark), P),
        _calendar(spark), hist, P, REFERENCE,
    ).first()
    # Q5: NULL express-money counts stay NULL, so the combined month test fails
    assert pop_ref.num_meses_distintos_movs_dex == 0 and pop_ref.tot_num_pag_dex is None
    # ranks 2..5 of 10..60 -> (20+30+40+50)/4*6
    assert pop_ref.tot_mto_pag_rem_corr == 210.0
    # Q32: a NULL activity flag makes REFERENCE drop the client from the population
    assert populations.transfer_population(hist, _contact(spark), P, REFERENCE).count() == 0
    pop = populations.transfer_population(hist, _contact(spark), P, CORRECTED)
    assert pop.count() == 1
    cor = services.transfer_features(pop, _calendar(spark), hist, P, CORRECTED).first()
    assert cor.num_meses_distintos_movs_dex == 6 and cor.tot_num_pag_dex == 0
    assert cor.tot_mto_pag_rem_corr == 210.0  # six months: same trimmed window
    p8 = RunParams(200012, 8)
    cor8 = services.transfer_features(pop, _calendar(spark), hist, p8, CORRECTED).first()
    # Q7: history of 8 (6 months present): ranks 2..7 scaled by 8/6
    assert cor8.tot_mto_pag_rem_corr == pytest.approx((20 + 30 + 40 + 50 + 60) * 8 / 6)


def _contact(spark, dup=False):
    rows = [(1, "FI", "JALISCO", "M", None, 1000), (2, "MO", "JALISCO", "F", None, 1001)]
    if dup:
        rows.append((1, "FI", "JALISCO", "M", None, 1000))
    return spark.createDataFrame(
        rows, "id_master BIGINT, tipo_persona STRING, lentidad STRING, genero STRING, fecha_nacimiento DATE, cposta INT"
    )


def test_q8_q12_training_population_and_dimension_dedupe(spark):
    income = spark.createDataFrame(
        [(1, 200012, 100.0, "NOMINA"), (2, 200012, 200.0, "NOMINA"), (3, 200012, 50.0, "NOMINA"),
         (3, 200012, 70.0, "NOMINA")],
        "id_master BIGINT, num_periodo_mes INT, mto_ing_mes DOUBLE, cod_flujo STRING",
    )
    ref = populations.training_population(income, _contact(spark), P, REFERENCE).collect()
    assert sorted(r.id_master for r in ref) == [1, 2, 3]          # one row per client
    again = populations.training_population(income.repartition(3), _contact(spark), P, REFERENCE).collect()
    assert sorted(ref) == sorted(again)                            # seeded, partition-free pick
    cor = populations.training_population(income, _contact(spark), P, CORRECTED).collect()
    assert [r.id_master for r in cor] == [1]                       # Q8: natural persons only
    hist = spark.createDataFrame(
        [(1, 200012, 1, 1.0, 1, 0.0, 0)], HIST_SCHEMA
    )
    dup = _contact(spark, dup=True)
    assert populations.fx_population(hist, dup, P, REFERENCE).count() == 2   # Q12
    assert populations.fx_population(hist, dup, P, CORRECTED).count() == 1


def test_q14_factor_excludes_default_postal(spark):
    from clientincome.operators import census

    cen = spark.createDataFrame(
        [("Código postal", 1000, 1, 300.0, 4, 1), ("Código postal", 0, 1, 3000.0, 4, 1)],
        "nivel STRING, cod_postal INT, familias BIGINT, ingreso_familiar DOUBLE, poblacion BIGINT, pei BIGINT",
    )
    train = spark.createDataFrame([(100.0, 1000), (900.0, 0)], "mto_ing_mes DOUBLE, cod_postal INT")
    ref = census.adjustment_factor(train, cen, sem=REFERENCE).first()
    cor = census.adjustment_factor(train, cen, sem=CORRECTED).first()
    # census income per earner = ingreso / ((4-1)/1)
    assert ref.median_census == (100.0 + 1000.0) / 2 and ref.median_target == 500.0
    assert cor.median_census == 100.0 and cor.factor == 1.0


def test_q34_deposit_population_without_accounts(spark):
    pop = spark.createDataFrame(
        [(1, 200012, 1, 0, 0), (5, 200012, 0, 1, 0)],
        "id_master BIGINT, per_ref INT, ind_activo_cap INT, ind_activo_cre INT, ind_activo_afr INT",
    )
    hist = _account_rows(spark, [_acct(1, 0, 200012, 300.0, 150)])
    ref = deposits.deposit_features(hist, pop, P, REFERENCE).collect()
    assert [r.id_master for r in ref] == [1]
    cor = {r.id_master: r for r in deposits.deposit_features(hist, pop, P, CORRECTED).collect()}
    assert set(cor) == {1, 5}
    assert cor[5].ult_dep_cap == 99 and cor[5].num_meses_distintos_dep_cap == 0
    assert float(cor[5].tot_mto_dep_cap) == 0.0 and cor[5].tot_mto_dep_cap_corr == 0.0
    assert cor[1].ult_dep_cap == 1 and float(cor[1].tot_mto_dep_cap) == 300.0
