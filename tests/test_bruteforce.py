"""Spark operators against plain pandas brute force on random small tables.

The tables carry the hard cases: one client holding a third of all rows,
duplicate account-months, a population with repeated clients, months outside
the window and calendar gaps.
"""

import numpy as np
import pandas as pd
import pytest

from clientincome.operators import deposits, services
from clientincome.semantics import REFERENCE, RunParams
from clientincome.sources.fixtures import CHANNELS

P = RunParams(200012, 6)
MONTHS = [200005, 200006, 200007, 200008, 200009, 200010, 200011, 200012]


def _idx(p):
    return (p // 100) * 12 + p % 100


def _account_table(rng):
    rows = []
    for _ in range(900):
        cid = 7 if rng.random() < 1 / 3 else int(rng.integers(1, 40))
        month = int(rng.choice(MONTHS))
        vals = [cid, int(rng.integers(0, 3)), month]
        for _d in ("dep", "ret"):
            for _c in CHANNELS:
                vals += [float(rng.integers(0, 4) * 25), int(rng.integers(0, 40))]
        rows.append(vals)
    rows += rows[:50]  # exact duplicate account-months
    cols = ["id_master", "num_cuenta", "num_periodo_mes"]
    for d in ("dep", "ret"):
        for c in CHANNELS:
            cols += [f"mto_{d}_{c}", f"num_{d}_{c}"]
    return pd.DataFrame(rows, columns=cols)


def _brute_deposits(acct: pd.DataFrame, pop: pd.DataFrame) -> pd.DataFrame:
    a = acct[(acct.num_periodo_mes >= P.start) & (acct.num_periodo_mes <= P.mes)].copy()
    a["per_ref"] = P.mes
    a["diff_mes"] = _idx(P.mes) - _idx(a.num_periodo_mes) + 1
    no_pay = [c for c in CHANNELS if c != "nomina"]
    for chans, suf in ((CHANNELS, "cap"), (no_pay, "cte_cap")):
        for d in ("dep", "ret"):
            for k in ("mto", "num"):
                a[f"{k}_{d}_{suf}"] = sum(a[f"{k}_{d}_{c}"] for c in chans)
    keys = ["id_master", "per_ref", "num_periodo_mes", "diff_mes"]
    a = a[keys + list(deposits.MEASURES)].drop_duplicates()
    g = a.groupby(["id_master", "num_periodo_mes", "per_ref", "diff_mes"], as_index=False).sum()

    def floor(x):
        return np.where(np.abs(x) < 100, 0, np.abs(x))

    for c in ("mto_dep_cap", "num_dep_cap", "mto_dep_cte_cap", "num_dep_cte_cap"):
        g[c] = floor(g[c])
    for c in ("mto_ret_cap", "mto_ret_cte_cap"):
        g[c] = np.abs(g[c])
    j = pop.merge(g.drop(columns="per_ref"), on="id_master", how="inner")
    out = []
    for (cid, per), grp in j.groupby(["id_master", "per_ref"]):
        r = {"id_master": cid, "per_ref": per}
        for f in ("ind_activo_cap", "ind_activo_afr", "ind_activo_cre"):
            r[f] = grp[f].max()
        for name, amt in (("ult_dep_cap", "mto_dep_cap"), ("ult_ret_cap", "mto_ret_cap"),
                          ("ult_dep_cte_cap", "mto_dep_cte_cap"), ("ult_ret_cte_cap", "mto_ret_cte_cap")):
            r[name] = np.where(grp[amt] > 0, grp.diff_mes, 99).min()
        r["num_meses_distintos_movs_cap"] = int(((grp.num_dep_cap + grp.num_ret_cap) > 0).sum())
        r["num_meses_distintos_dep_cap"] = int((grp.num_dep_cap > 0).sum())
        r["num_meses_distintos_dep_cte_cap"] = int((grp.num_dep_cte_cap > 0).sum())
        for m in deposits.MEASURES:
            r[f"tot_{m}"] = grp[m].sum()
        for name, amt in (("tot_mto_dep_cap_corr", "mto_dep_cap"), ("tot_mto_dep_cte_cap_corr", "mto_dep_cte_cap")):
            s = np.sort(grp[amt].to_numpy())
            r[name] = s[1:5].sum() * 1.5
        r["mto_tot_dep_cap_ult_mes"] = grp.loc[grp.diff_mes == 1, "mto_dep_cap"].sum()
        out.append(r)
    return pd.DataFrame(out)


def test_deposit_features_brute_force(spark):
    rng = np.random.default_rng(11)
    acct = _account_table(rng)
    pop_rows = [(i, P.mes, int(i % 2), int(i % 3 == 0), 0) for i in range(1, 45)] + [(7, P.mes, 1, 0, 0)]
    pop = pd.DataFrame(pop_rows, columns=["id_master", "per_ref", "ind_activo_cap", "ind_activo_cre", "ind_activo_afr"])
    exp = _brute_deposits(acct, pop).set_index("id_master")
    got = deposits.deposit_features(spark.createDataFrame(acct), spark.createDataFrame(pop), P, REFERENCE)
    got = got.toPandas().set_index("id_master")
    assert set(got.index) == set(exp.index)
    assert len(got) == len(exp)
    for col in exp.columns:
        assert np.allclose(got.loc[exp.index, col].astype(float), exp[col].astype(float)), col


def test_transfer_features_brute_force(spark):
    rng = np.random.default_rng(5)
    cal = [200007, 200008, 200010, 200012]  # calendar gaps
    hist = []
    for cid in range(1, 30):
        for m in MONTHS:
            if rng.random() < 0.6:
                hist.append((cid, m, 1, 1, float(rng.integers(0, 500)), int(rng.integers(0, 3)),
                             float(rng.integers(0, 300)), int(rng.integers(0, 3)),
                             None if rng.random() < 0.3 else float(rng.integers(0, 100)), None if rng.random() < 0.3 else 1,
                             float(rng.integers(0, 50)), int(rng.integers(0, 2))))
    cols = ["id_master", "num_periodo_mes", "ind_activo_rem", "ind_activo_dex",
            "mto_pag_rem", "num_pag_rem", "mto_env_rem", "num_env_rem",
            "mto_pag_dex", "num_pag_dex", "mto_env_dex", "num_env_dex"]
    schema = ("id_master BIGINT, num_periodo_mes INT, ind_activo_rem INT, ind_activo_dex INT, "
              "mto_pag_rem DOUBLE, num_pag_rem BIGINT, mto_env_rem DOUBLE, num_env_rem BIGINT, "
              "mto_pag_dex DOUBLE, num_pag_dex BIGINT, mto_env_dex DOUBLE, num_env_dex BIGINT")
    h = pd.DataFrame(hist, columns=cols)
    pop = pd.DataFrame([(c, P.mes, 1, c % 2) for c in range(1, 35)],
                       columns=["id_master", "per_ref", "ind_activo_rem", "ind_activo_dex"])
    got = services.transfer_features(
        spark.createDataFrame(pop), spark.createDataFrame([(m,) for m in cal], "num_periodo_mes INT"),
        spark.createDataFrame(hist, schema), P, REFERENCE,
    ).toPandas().set_index("id_master")
    months = [m for m in cal if P.start <= m <= P.mes]
    for cid in pop.id_master:
        rows = h[(h.id_master == cid) & h.num_periodo_mes.isin(months)]
        n_spine = len(months)
        pag_rem = sorted(list(rows.mto_pag_rem.abs()) + [0.0] * (n_spine - len(rows)))
        r = got.loc[cid]
        assert r.tot_mto_pag_rem_corr == pytest.approx(sum(pag_rem[1:5]) * 1.5)
        assert r.ind_activo_rem == n_spine  # Q1: every spine row counts as the last month
        assert r.ult_pag_rem == (1 if (rows.mto_pag_rem > 0).any() else 99)
        both = rows.num_pag_dex.notna() & (rows.num_pag_dex + rows.num_env_dex > 0)
        assert r.num_meses_distintos_movs_dex == int(both.sum())
        assert float(r.tot_mto_env_rem) == pytest.approx(rows.mto_env_rem.abs().sum())


def _brute_transfer(hist: pd.DataFrame, contact: pd.DataFrame, cal) -> pd.DataFrame:
    """The original's row semantics with every copy spelled out."""
    m = hist[(hist.num_periodo_mes == P.mes) & (hist.id_master > 0)
             & ((hist.ind_activo_rem + hist.ind_activo_dex) > 0)]
    pop = m.merge(contact[contact.tipo_persona == "FI"][["id_master"]], on="id_master")
    months = sorted({c for c in cal if P.start <= c <= P.mes})
    rows = []
    for _, p in pop.iterrows():
        for mo in months or [None]:
            h = hist[(hist.id_master == p.id_master) & (hist.num_periodo_mes == mo)]
            for _, r in (h.iterrows() if len(h) else [(None, None)]):
                get = (lambda c: None if r is None or pd.isna(r[c]) else r[c])
                rows.append({
                    "id_master": p.id_master, "dex": p.ind_activo_dex, "rem": p.ind_activo_rem,
                    **{f"mto_{f}": abs(get(f"mto_{f}") or 0.0) for f in ("pag_rem", "env_rem", "pag_dex", "env_dex")},
                    "num_pag_rem": get("num_pag_rem") or 0, "num_env_rem": get("num_env_rem") or 0,
                    "num_pag_dex": get("num_pag_dex"), "num_env_dex": get("num_env_dex"),
                })
    out = {}
    for cid, g in pd.DataFrame(rows).groupby("id_master"):
        srt = sorted(g.mto_pag_rem)
        both = g.num_pag_dex.notna() & g.num_env_dex.notna() & ((g.num_pag_dex.fillna(0) + g.num_env_dex.fillna(0)) > 0)
        out[cid] = {
            "ind_activo_dex": g.dex.sum(), "ind_activo_rem": g.rem.sum(),
            "ult_pag_rem": 1 if (g.mto_pag_rem > 0).any() else 99,
            "num_meses_distintos_movs_rem": int(((g.num_pag_rem + g.num_env_rem) > 0).sum()),
            "num_meses_distintos_movs_dex": int(both.sum()),
            "tot_mto_pag_rem_corr": sum(srt[1:5]) * 1.5,
            "tot_mto_env_dex": g.mto_env_dex.sum(),
            "tot_num_pag_rem": g.num_pag_rem.sum(),
        }
    return pd.DataFrame.from_dict(out, orient="index")


def test_transfer_copies_are_weights(spark):
    """Duplicate contact keys and duplicate history rows multiply the result
    exactly as repeated rows would, without the copies being carried."""
    rng = np.random.default_rng(9)
    hist = []
    for cid in range(1, 16):
        for mth in MONTHS:
            if rng.random() < 0.7:
                row = (cid, mth, int(rng.integers(0, 2)), int(rng.integers(0, 2)),
                       float(rng.integers(0, 400)), int(rng.integers(0, 3)), float(rng.integers(0, 200)),
                       int(rng.integers(0, 3)), float(rng.integers(0, 90)),
                       None if rng.random() < 0.3 else int(rng.integers(0, 3)),
                       float(rng.integers(0, 50)), int(rng.integers(0, 2)))
                hist += [row] * (3 if cid == 4 else 1)      # client 4: every row copied 3x
    schema = ("id_master BIGINT, num_periodo_mes INT, ind_activo_rem INT, ind_activo_dex INT, "
              "mto_pag_rem DOUBLE, num_pag_rem BIGINT, mto_env_rem DOUBLE, num_env_rem BIGINT, "
              "mto_pag_dex DOUBLE, num_pag_dex BIGINT, mto_env_dex DOUBLE, num_env_dex BIGINT")
    cols = [c.split()[0] for c in schema.split(", ")]
    contact = [(c, "FI") for c in range(1, 16)] + [(7, "FI")] * 4 + [(9, "MO")]
    cal = [200007, 200008, 200009, 200011, 200012]
    exp = _brute_transfer(pd.DataFrame(hist, columns=cols),
                          pd.DataFrame(contact, columns=["id_master", "tipo_persona"]), cal)
    from clientincome.operators import populations

    h = spark.createDataFrame(hist, schema)
    c = spark.createDataFrame(contact, "id_master BIGINT, tipo_persona STRING")
    calendar = spark.createDataFrame([(m,) for m in cal], "num_periodo_mes INT")
    pop = populations.transfer_population_counted(h, c, P, REFERENCE)
    got = services.transfer_features(pop, calendar, h, P, REFERENCE).toPandas().set_index("id_master")
    assert set(got.index) == set(exp.index)
    for col in exp.columns:
        assert np.allclose(got.loc[exp.index, col].astype(float), exp[col].astype(float)), col
    # the row-form population gives the same features
    rowform = populations.transfer_population(h, c, P, REFERENCE)
    got2 = services.transfer_features(rowform, calendar, h, P, REFERENCE).toPandas().set_index("id_master")
    assert got2.sort_index().equals(got.sort_index())


def test_deposit_population_counted_matches_rows(spark, inputs_small):
    from pyspark.sql import functions as F

    from clientincome.operators import populations

    rows = populations.deposit_population(inputs_small.deposit_hist, inputs_small.income, P, REFERENCE)
    cnt = populations.deposit_population_counted(inputs_small.deposit_hist, inputs_small.income, P, REFERENCE)
    expanded = cnt.withColumn("_r", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("_r", "n")
    assert sorted(expanded.collect()) == sorted(rows.collect())
    assert cnt.where(F.col("n") > 1).count() > 0  # the fixture has rank ties
    a = deposits.deposit_features(inputs_small.account_hist, rows, P, REFERENCE)
    b = deposits.deposit_features(inputs_small.account_hist, cnt, P, REFERENCE)
    assert sorted(a.collect()) == sorted(b.collect())


def test_dimension_copies_repeat_rows(spark, inputs_small):
    """Repeated contact and journey keys repeat unified rows (REFERENCE),
    carried as weights and expanded at the end."""
    import dataclasses
    from collections import Counter

    from pyspark.sql import functions as F

    from clientincome.plans import inference as plan

    base = plan.features(inputs_small, P, REFERENCE)
    dep_ids = {r.id_master for r in base.deposits.select("id_master").collect()}
    svc_ids = {r.id_master for r in base.fx.select("id_master").union(base.transfers.select("id_master")).collect()}
    only_dep = sorted(dep_ids - svc_ids)[:3]
    a, b, c = only_dep
    contact = inputs_small.contact
    journey = inputs_small.journey
    contact2 = contact.unionByName(contact.where(F.col("id_master").isin(a, c))).unionByName(
        contact.where(F.col("id_master").isin(a, c)))
    journey2 = journey.unionByName(journey.where(F.col("id_master").isin(b, c)))
    copied = dataclasses.replace(inputs_small, contact=contact2, journey=journey2)
    got = Counter(plan.features(copied, P, REFERENCE).unified.collect())
    want = Counter()
    mult = {a: 3, b: 2, c: 6}
    for r in base.unified.collect():
        want[r] += mult.get(r.id_master, 1)
    assert got == want
    # the inference plan's spread expansion gives the same rows
    spread = Counter(plan.unified_cut(plan.features(copied, P, REFERENCE)).collect())
    assert spread == want


def test_expand_spread_equals_expand(spark):
    from collections import Counter

    from clientincome.operators import copies

    df = spark.createDataFrame([(1, "x", 1), (2, "y", 7), (3, "z", 23)], "id_master BIGINT, v STRING, _w BIGINT")
    plain = Counter(copies.expand(df).collect())
    spread = Counter(copies.expand(df, chunk=5).collect())
    assert plain == spread and sum(plain.values()) == 31
