"""DuckDB oracle for every query key.

Written independently of the Spark operators: the pipeline's steps are
spelled out the way the original states them (window ranks where the engine
uses sorted slices, composite-key joins, date functions for periods, the
rule cascade as successive overwrites), over the same input views.  Only
column-name lists are shared with the library.  Parameters are the fixture
ones: reference month 200012, six months of history, seed 123.
"""

from __future__ import annotations

import math

from clientincome.operators.deposits import FEATURE_COLS, INCOME_COLS, JOURNEY_COLS, MEASURES
from clientincome.operators.report import OUTPUT_COLUMNS, RENAMES, ROUNDED
from clientincome.operators.unify import FX_COLS, TRANSFER_COLS
from clientincome.sources.catalog import states_values_sql
from clientincome.sources.fixtures import CHANNELS, VIEWS

MES, START, SEED = 200012, 200007, 123
STAND_IN = (-2500.0, 0.1, 0.001, 20.0, 5.0)

CTE: dict[str, str] = {}


def _months_between_first(d: str) -> str:
    """Spark ``months_between(DATE '2000-12-01', d)`` for a DATE ``d``."""
    return (f"((2000 - year({d})) * 12 + (12 - month({d})) "
            f"+ CASE WHEN day({d}) = 1 THEN 0 ELSE (1 - day({d})) / 31.0 END)")


def _period_date(p: str) -> str:
    return f"CAST(strptime(CAST({p} * 100 + 1 AS VARCHAR), '%Y%m%d') AS DATE)"


def _diff(p: str) -> str:
    """months from period p to the reference month, plus one."""
    return f"(date_diff('month', {_period_date(p)}, DATE '2000-12-01') + 1)"


# ---------------------------------------------------------------- populations
CTE["pop_fx"] = f"""
SELECT h.id_master, h.num_periodo_mes AS per_ref
FROM fx_hist h LEFT JOIN contact c ON h.id_master = c.id_master
WHERE h.num_periodo_mes = {MES} AND h.id_master IS NOT NULL AND h.id_master > 0
  AND h.ind_activo_div = 1 AND c.tipo_persona = 'FI'"""

CTE["pop_env"] = f"""
SELECT h.id_master, h.num_periodo_mes AS per_ref, h.ind_activo_rem, h.ind_activo_dex
FROM transfer_hist h LEFT JOIN contact c ON h.id_master = c.id_master
WHERE h.num_periodo_mes = {MES} AND h.id_master IS NOT NULL AND h.id_master > 0
  AND h.ind_activo_rem + h.ind_activo_dex > 0 AND c.tipo_persona = 'FI'"""

CTE["cap_ranked"] = """
SELECT id_master, ind_activo_cap, num_periodo_mes, cod_tipo_persona,
  dense_rank() OVER (PARTITION BY id_master, num_periodo_mes
                     ORDER BY ind_activo_cap DESC NULLS LAST, sld_tot_prod_cap DESC NULLS LAST) AS prio
FROM deposit_hist"""

CTE["pop_cap"] = f"""
SELECT coalesce(a.id_master, b.id_master) AS id_master,
  coalesce(a.num_periodo_mes, b.num_periodo_mes) AS per_ref,
  coalesce(a.ind_activo_cap, 0) AS ind_activo_cap,
  coalesce(b.ind_activo_cre, 0) AS ind_activo_cre,
  coalesce(b.ind_activo_afr, 0) AS ind_activo_afr
FROM (SELECT id_master, ind_activo_cap, num_periodo_mes FROM cap_ranked
      WHERE num_periodo_mes = {MES} AND id_master IS NOT NULL AND id_master > 0
        AND ind_activo_cap = 1 AND cod_tipo_persona = 'PF' AND prio = 1) a
FULL OUTER JOIN
     (SELECT id_master, num_periodo_mes, coalesce(ind_cre, 0) AS ind_activo_cre,
             CAST(coalesce(ind_afr, 0) AS INT) AS ind_activo_afr
      FROM income WHERE num_periodo_mes = {MES} AND id_master > 0) b
ON a.id_master = b.id_master"""

CTE["pop_train"] = f"""
SELECT id_master, per_ref, mto_ing_mes FROM (
  SELECT id_master, num_periodo_mes AS per_ref, mto_ing_mes,
    row_number() OVER (PARTITION BY id_master ORDER BY
      md5(concat_ws('|', '{SEED}', CAST(id_master AS VARCHAR), CAST(num_periodo_mes AS VARCHAR),
                    CAST(mto_ing_mes AS VARCHAR))), num_periodo_mes, mto_ing_mes) AS rn
  FROM income
  WHERE num_periodo_mes = {MES} AND cod_flujo = 'NOMINA' AND id_master > 0 AND mto_ing_mes > 0
) t WHERE rn = 1"""

CTE["months"] = "SELECT DISTINCT num_periodo_mes FROM calendar"

# ------------------------------------------------------------------- deposits
def _chan(kind: str, direction: str, channels) -> str:
    return " + ".join(f"{kind}_{direction}_{c}" for c in channels)


_NO_PAYROLL = [c for c in CHANNELS if c != "nomina"]
_acct_cols = []
for _chs, _suffix in ((CHANNELS, "cap"), (_NO_PAYROLL, "cte_cap")):
    for _d in ("dep", "ret"):
        for _k in ("mto", "num"):
            _acct_cols.append(f"({_chan(_k, _d, _chs)}) AS {_k}_{_d}_{_suffix}")

CTE["acct_rows"] = f"""
SELECT DISTINCT id_master, {MES} AS per_ref, num_periodo_mes,
  CAST({_diff('num_periodo_mes')} AS INT) AS diff_mes,
  {', '.join(_acct_cols)}
FROM account_hist WHERE num_periodo_mes BETWEEN {START} AND {MES}"""

CTE["cap_cm"] = """
SELECT id_master, num_periodo_mes, per_ref, diff_mes,
  CASE WHEN abs(SUM(mto_dep_cap)) < 100 THEN 0 ELSE abs(SUM(mto_dep_cap)) END AS mto_dep_cap,
  CASE WHEN abs(SUM(num_dep_cap)) < 100 THEN 0 ELSE abs(SUM(num_dep_cap)) END AS num_dep_cap,
  abs(SUM(mto_ret_cap)) AS mto_ret_cap, SUM(num_ret_cap) AS num_ret_cap,
  CASE WHEN abs(SUM(mto_dep_cte_cap)) < 100 THEN 0 ELSE abs(SUM(mto_dep_cte_cap)) END AS mto_dep_cte_cap,
  CASE WHEN abs(SUM(num_dep_cte_cap)) < 100 THEN 0 ELSE abs(SUM(num_dep_cte_cap)) END AS num_dep_cte_cap,
  abs(SUM(mto_ret_cte_cap)) AS mto_ret_cte_cap, SUM(num_ret_cte_cap) AS num_ret_cte_cap
FROM acct_rows GROUP BY id_master, num_periodo_mes, per_ref, diff_mes"""

CTE["cap_join"] = f"""
SELECT p.id_master, p.per_ref, p.ind_activo_cap, p.ind_activo_afr, p.ind_activo_cre,
  m.num_periodo_mes, m.diff_mes, {', '.join('m.' + c for c in MEASURES)},
  row_number() OVER (PARTITION BY p.id_master ORDER BY m.mto_dep_cap ASC NULLS FIRST) AS ord_nom,
  row_number() OVER (PARTITION BY p.id_master ORDER BY m.mto_dep_cte_cap ASC NULLS FIRST) AS ord_cte
FROM pop_cap p JOIN cap_cm m ON p.id_master = m.id_master"""


def _ult(amount: str, name: str) -> str:
    return f"MIN(CASE WHEN {amount} > 0 THEN diff_mes ELSE 99 END) AS {name}"


def _nmd(cond: str, name: str) -> str:
    return f"SUM(CASE WHEN {cond} > 0 THEN 1 ELSE 0 END) AS {name}"


def _corr(rank: str, amount: str, name: str) -> str:
    return f"CAST(SUM(CASE WHEN {rank} BETWEEN 2 AND 5 THEN {amount} ELSE 0 END) AS DOUBLE) * 1.5 AS {name}"


CTE["feat_cap"] = f"""
SELECT id_master, per_ref,
  MAX(ind_activo_cap) AS ind_activo_cap, MAX(ind_activo_afr) AS ind_activo_afr, MAX(ind_activo_cre) AS ind_activo_cre,
  {_ult('mto_dep_cap', 'ult_dep_cap')}, {_ult('mto_ret_cap', 'ult_ret_cap')},
  {_ult('mto_dep_cte_cap', 'ult_dep_cte_cap')}, {_ult('mto_ret_cte_cap', 'ult_ret_cte_cap')},
  {_nmd('num_dep_cap + num_ret_cap', 'num_meses_distintos_movs_cap')},
  {_nmd('num_dep_cap', 'num_meses_distintos_dep_cap')},
  {_nmd('num_ret_cap', 'num_meses_distintos_ret_cap')},
  {_nmd('num_dep_cte_cap + num_ret_cte_cap', 'num_meses_distintos_movs_cte_cap')},
  {_nmd('num_dep_cte_cap', 'num_meses_distintos_dep_cte_cap')},
  {_nmd('num_ret_cte_cap', 'num_meses_distintos_ret_cte_cap')},
  {', '.join(f'SUM({m}) AS tot_{m}' for m in MEASURES)},
  {_corr('ord_nom', 'mto_dep_cap', 'tot_mto_dep_cap_corr')},
  {_corr('ord_cte', 'mto_dep_cte_cap', 'tot_mto_dep_cte_cap_corr')},
  SUM(CASE WHEN diff_mes = 1 THEN mto_dep_cap ELSE 0 END) AS mto_tot_dep_cap_ult_mes,
  SUM(CASE WHEN diff_mes = 1 THEN mto_dep_cte_cap ELSE 0 END) AS mto_dep_cte_cap_ult_mes
FROM cap_join GROUP BY id_master, per_ref"""


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


CTE["enr_cap"] = f"""
SELECT a.id_master, a.per_ref,
  {', '.join(f'coalesce(b.{c}, {_lit(d)}) AS {c}' for c, d in INCOME_COLS)},
  {', '.join(f'coalesce(c.{n}, {_lit(d)}) AS {n}' for n, d in JOURNEY_COLS)},
  {', '.join('a.' + c for c in FEATURE_COLS)}
FROM feat_cap a
LEFT JOIN income b ON a.id_master = b.id_master AND a.per_ref = b.num_periodo_mes
LEFT JOIN journey c ON a.id_master = c.id_master AND a.per_ref = c.num_periodo_mes"""

# ------------------------------------------------------------------- currency
CTE["fx_rows"] = f"""
SELECT s.id_master, s.per_ref, s.diff_mes, s.num_periodo_mes, 0 AS ind_activo_div,
  abs(coalesce(h.mto_div_cpa, 0)) AS mto_div_cpa, coalesce(h.num_div_cpa, 0) AS num_div_cpa,
  abs(coalesce(h.mto_div_vta, 0)) AS mto_div_vta, coalesce(h.num_div_vta, 0) AS num_div_vta
FROM (SELECT p.id_master, p.per_ref, m.num_periodo_mes, 1 AS diff_mes
      FROM pop_fx p LEFT JOIN months m ON m.num_periodo_mes BETWEEN {START} AND p.per_ref) s
LEFT JOIN fx_hist h ON s.id_master = h.id_master AND s.num_periodo_mes = h.num_periodo_mes"""

CTE["feat_fx"] = f"""
SELECT id_master, per_ref,
  SUM(CASE WHEN diff_mes = 1 THEN ind_activo_div ELSE 0 END) AS ind_activo_div,
  {_ult('mto_div_cpa', 'ult_cpa_div')}, {_ult('mto_div_vta', 'ult_vta_div')},
  {_nmd('num_div_cpa + num_div_vta', 'num_meses_distintos_movs_div')},
  {_nmd('num_div_cpa', 'num_meses_distintos_cpa_div')},
  {_nmd('num_div_vta', 'num_meses_distintos_vta_div')},
  {_corr('ord_cpa', 'mto_div_cpa', 'tot_mto_cpa_div_corr')},
  {_corr('ord_vta', 'mto_div_vta', 'tot_mto_vta_div_corr')},
  SUM(mto_div_cpa) AS tot_mto_cpa_div, SUM(num_div_cpa) AS tot_num_cpa_div,
  SUM(mto_div_vta) AS tot_mto_vta_div, SUM(num_div_vta) AS tot_num_vta_div
FROM (SELECT *,
        row_number() OVER (PARTITION BY id_master ORDER BY mto_div_cpa) AS ord_cpa,
        row_number() OVER (PARTITION BY id_master ORDER BY mto_div_vta) AS ord_vta
      FROM fx_rows) r
GROUP BY id_master, per_ref"""

# ------------------------------------------------------------------- transfer
CTE["env_spine"] = f"""
SELECT p.id_master, p.per_ref, p.ind_activo_rem, p.ind_activo_dex, m.num_periodo_mes, 1 AS diff_mes
FROM pop_env p LEFT JOIN months m ON m.num_periodo_mes BETWEEN {START} AND p.per_ref"""

CTE["env_rows"] = """
SELECT s.id_master, s.per_ref, s.diff_mes, s.num_periodo_mes, s.ind_activo_rem, s.ind_activo_dex,
  abs(coalesce(h.mto_pag_rem, 0)) AS mto_pag_rem, coalesce(h.num_pag_rem, 0) AS num_pag_rem,
  abs(coalesce(h.mto_env_rem, 0)) AS mto_env_rem, coalesce(h.num_env_rem, 0) AS num_env_rem,
  abs(coalesce(h.mto_pag_dex, 0)) AS mto_pag_dex, h.num_pag_dex AS num_pag_dex,
  abs(coalesce(h.mto_env_dex, 0)) AS mto_env_dex, h.num_env_dex AS num_env_dex
FROM env_spine s
LEFT JOIN transfer_hist h ON s.id_master = h.id_master AND s.num_periodo_mes = h.num_periodo_mes"""

_ENV_FAMS = ("pag_rem", "env_rem", "pag_dex", "env_dex")
CTE["feat_env"] = f"""
SELECT id_master, per_ref,
  SUM(CASE WHEN diff_mes = 1 THEN ind_activo_dex ELSE 0 END) AS ind_activo_dex,
  SUM(CASE WHEN diff_mes = 1 THEN ind_activo_rem ELSE 0 END) AS ind_activo_rem,
  {', '.join(_ult('mto_' + f, 'ult_' + f) for f in _ENV_FAMS)},
  {_nmd('num_pag_rem + num_env_rem', 'num_meses_distintos_movs_rem')},
  {_nmd('num_pag_rem', 'num_meses_distintos_pag_rem')},
  {_nmd('num_env_rem', 'num_meses_distintos_env_rem')},
  {_nmd('num_pag_dex + num_env_dex', 'num_meses_distintos_movs_dex')},
  {_nmd('num_pag_dex', 'num_meses_distintos_pag_dex')},
  {_nmd('num_env_dex', 'num_meses_distintos_env_dex')},
  {', '.join(_corr('ord_' + f, 'mto_' + f, f'tot_mto_{f}_corr') for f in ('pag_dex', 'env_dex', 'pag_rem', 'env_rem'))},
  {', '.join(f'SUM(mto_{f}) AS tot_mto_{f}, SUM(num_{f}) AS tot_num_{f}' for f in _ENV_FAMS)}
FROM (SELECT *, {', '.join(f'row_number() OVER (PARTITION BY id_master ORDER BY mto_{f}) AS ord_{f}' for f in _ENV_FAMS)}
      FROM env_rows) r
GROUP BY id_master, per_ref"""

# -------------------------------------------------------------------- unify


def _dflt(c: str) -> str:
    return "99" if c.startswith("ult_") else "0"


_uni = [
    "coalesce(a.id_master, b.id_master, c.id_master) AS id_master",
    "coalesce(a.per_ref, b.per_ref, c.per_ref) AS per_ref",
]
_uni += [f"coalesce(a.{c}, {_lit(d)}) AS {c}" for c, d in INCOME_COLS + JOURNEY_COLS]
_uni += [f"coalesce(a.{c}, {_dflt(c)}) AS {c}" for c in FEATURE_COLS]
_uni += [f"coalesce(b.{c}, {_dflt(c)}) AS {c}" for c in FX_COLS]
_uni += [f"coalesce(c.{c}, {_dflt(c)}) AS {c}" for c in TRANSFER_COLS]
CTE["uni"] = f"""
SELECT {', '.join(_uni)}
FROM enr_cap a FULL OUTER JOIN feat_fx b ON a.id_master = b.id_master
FULL OUTER JOIN feat_env c ON coalesce(a.id_master, b.id_master) = c.id_master"""

CTE["states"] = states_values_sql()

_folded = ("CASE WHEN trim(lentidad) IN ('VERACRUZ', 'VERACRUZ DE IGNACIO DE LA LLAVE') "
           "THEN 'VERACRUZ' ELSE trim(lentidad) END")
_gender = "CASE WHEN trim(genero) IN ('N', 'E') THEN 'X' ELSE genero END"
_age = f"CAST(round(round({_months_between_first('fecha_nacimiento')}, 8) / 12, 0) AS INT)"

CTE["sdm"] = f"""
SELECT k.id_master, k.genero, k.edad, k.cod_postal, coalesce(s.clave, 'N/A') AS entidad
FROM (SELECT id_master, {_gender} AS genero, {_age} AS edad, cposta AS cod_postal, {_folded} AS entidad_nombre
      FROM contact) k
LEFT JOIN states s ON trim(k.entidad_nombre) = s.descripcion"""

CTE["unid"] = """
SELECT u.*, coalesce(d.genero, 'NO DISPONIBLE') AS genero, coalesce(d.edad, 0) AS edad,
  coalesce(d.entidad, 'NO DISPONIBLE') AS entidad, coalesce(d.cod_postal, 0) AS cod_postal
FROM uni u LEFT JOIN sdm d ON u.id_master = d.id_master"""

# ------------------------------------------------------------------- training
CTE["tsdm"] = f"""
SELECT id_master, {_age} AS edad, {_gender} AS genero, cposta AS cod_postal, {_folded} AS entidad
FROM contact"""

CTE["train_feat"] = f"""
SELECT p.id_master, p.per_ref, p.mto_ing_mes,
  coalesce(d.genero, 'VACIO') AS genero, coalesce(d.edad, 0) AS edad,
  coalesce(d.entidad, 'VACIO') AS entidad, coalesce(d.cod_postal, 0) AS cod_postal,
  coalesce(r.saldo, 0) AS saldo, coalesce(r.potencial, 0) AS potencial, coalesce(r.recorrido, 0) AS recorrido
FROM pop_train p
LEFT JOIN tsdm d ON p.id_master = d.id_master
LEFT JOIN (SELECT * FROM journey WHERE num_periodo_mes = {MES}) r ON p.id_master = r.id_master"""

CTE["tprep"] = """
SELECT DISTINCT saldo, potencial, recorrido, edad,
  log10(CAST(mto_ing_mes AS DOUBLE) + 1) AS log_mto_ing_mes
FROM train_feat WHERE edad >= 18 AND edad < 100"""

# --------------------------------------------------------------------- census
# ------------------------------------------------------------ forest of stumps
TREES = 20
_BUCKET = (f"CAST('0x' || substr(md5(concat_ws('|', '{SEED}', CAST(saldo AS VARCHAR), CAST(potencial AS VARCHAR), "
           f"CAST(recorrido AS VARCHAR), CAST(edad AS VARCHAR))), 1, 8) AS UBIGINT) % 100 < 80")
CTE["test_rows"] = f"SELECT * FROM tprep WHERE NOT ({_BUCKET})"
# a row is in a tree as often as a draw from Poisson(1) says
_DRAW = (f"CAST('0x' || substr(md5(concat_ws('|', '{SEED}:' || t, CAST(saldo AS VARCHAR), CAST(potencial AS VARCHAR), "
         f"CAST(recorrido AS VARCHAR), CAST(edad AS VARCHAR))), 1, 8) AS UBIGINT) / 4294967296.0")
_CHANCES = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(8)]
CTE["tree_rows"] = f"""
SELECT *, {" + ".join(f"(u >= {c!r})::INT" for c in _CHANCES)} AS w
FROM (SELECT t, tprep.*, {_DRAW} AS u FROM tprep CROSS JOIN range({TREES}) AS trees(t) WHERE {_BUCKET}) d"""
_FEATURES = ("saldo", "potencial", "recorrido", "edad")
CTE["tree_values"] = " UNION ALL ".join(
    f"SELECT t, {k} AS f, '{c}' AS feature, CAST({c} AS DOUBLE) AS x, SUM(w) AS w, SUM(w * log_mto_ing_mes) AS s, "
    f"SUM(w * log_mto_ing_mes * log_mto_ing_mes) AS q FROM tree_rows WHERE w > 0 GROUP BY t, {c}" for k, c in enumerate(_FEATURES))
CTE["tree_cuts"] = """
SELECT *, SUM(w) OVER below AS wl, SUM(s) OVER below AS sl, SUM(q) OVER below AS ql, lead(x) OVER below AS above,
  SUM(w) OVER whole AS wt, SUM(s) OVER whole AS st, SUM(q) OVER whole AS qt
FROM tree_values WINDOW below AS (PARTITION BY t, f ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), whole AS (PARTITION BY t, f)"""
CTE["stumps"] = """
SELECT t, feature, (x + above) / 2 AS threshold, sl / wl AS low, (st - sl) / (wt - wl) AS high FROM (
  SELECT *, row_number() OVER (PARTITION BY t ORDER BY
      (qt / wt - (st / wt) * (st / wt)) - wl / wt * (ql / wl - (sl / wl) * (sl / wl))
      - (wt - wl) / wt * ((qt - ql) / (wt - wl) - ((st - sl) / (wt - wl)) * ((st - sl) / (wt - wl))) DESC, f, x) AS best
  FROM tree_cuts WHERE above IS NOT NULL) c WHERE best = 1"""


def _stump_mean(source: str) -> str:
    value = " ".join(f"WHEN '{c}' THEN CAST({c} AS DOUBLE)" for c in _FEATURES)
    sums = f"list_transform((SELECT list({{'f': feature, 'x': threshold, 'a': low, 'b': high}}) FROM stumps), lambda s: CASE WHEN (CASE s.f {value} END) <= s.x THEN s.a ELSE s.b END)"
    return f"SELECT *, list_avg({sums}) AS prediction FROM {source}"


CTE["stump_test"] = _stump_mean("test_rows")
CTE["stump_clients"] = _stump_mean("unid")

CTE["succ"] = """
SELECT cod_postal,
  CAST(ingreso_familiar AS DOUBLE) / ((CAST(poblacion AS DOUBLE) - CAST(pei AS DOUBLE)) / CAST(familias AS DOUBLE))
    AS ingreso_prom_succ
FROM census WHERE nivel = 'Código postal'"""

CTE["factor"] = """
SELECT median(CAST(t.mto_ing_mes AS DOUBLE)) AS median_target,
  median(coalesce(k.ingreso_prom_succ, 0)) AS median_census,
  median(CAST(t.mto_ing_mes AS DOUBLE)) / median(coalesce(k.ingreso_prom_succ, 0)) AS factor
FROM train_feat t LEFT JOIN succ k ON t.cod_postal = k.cod_postal
WHERE t.cod_postal <> 99999 AND coalesce(k.ingreso_prom_succ, 0) > 0"""


def _linear() -> str:
    c0, c1, c2, c3, c4 = (f"CAST({c!r} AS DOUBLE)" for c in STAND_IN)
    e = c0
    for c, f in zip((c1, c2, c3, c4), ("saldo", "potencial", "recorrido", "edad")):
        e = f"({e} + {c} * CAST({f} AS DOUBLE))"
    return e


CTE["clients"] = f"""
SELECT u.*,
  CASE WHEN u.ind_activo_cap = 1 THEN {_linear()} WHEN u.ind_activo_cap = 0 THEN 0.0 END AS regr,
  coalesce(k.ingreso_prom_succ, 0) * f.factor AS ingreso_prom_succ
FROM unid u LEFT JOIN succ k ON u.cod_postal = k.cod_postal CROSS JOIN factor f"""

# -------------------------------------------------------------------- scoring
_REC = [("dep_cap", "ult_dep_cap"), ("ret_cap", "ult_ret_cap"), ("dep_cte_cap", "ult_dep_cte_cap"),
        ("ret_cte_cap", "ult_ret_cte_cap"), ("cpa_div", "ult_cpa_div"), ("vta_div", "ult_vta_div"),
        ("pag_dex", "ult_pag_dex"), ("env_dex", "ult_env_dex"), ("pag_rem", "ult_pag_rem"),
        ("env_rem", "ult_env_rem")]
_FREQ = ["movs_cap", "dep_cap", "ret_cap", "movs_cte_cap", "dep_cte_cap", "ret_cte_cap",
         "movs_div", "cpa_div", "vta_div", "movs_rem", "pag_rem", "env_rem",
         "movs_dex", "pag_dex", "env_dex"]
REC_NAMES = [f"score_rec_{n}" for n, _ in _REC]
FREQ_NAMES = [f"score_frec_{n}" for n in _FREQ]

_scores = [
    f"CASE WHEN {u} = 99 THEN 0.0 ELSE (CAST(mx.max_rec AS DOUBLE) - (CAST({u} AS DOUBLE) - 1)) "
    f"/ CAST(mx.max_rec AS DOUBLE) END AS score_rec_{n}"
    for n, u in _REC
]
_scores += [
    f"CASE WHEN num_meses_distintos_{n} = 0 THEN 0.0 ELSE CAST(num_meses_distintos_{n} AS DOUBLE) "
    f"/ CAST(mx.max_frec AS DOUBLE) END AS score_frec_{n}"
    for n in _FREQ
]
CTE["s1"] = f"""
SELECT c.*, {', '.join(_scores)}
FROM clients c CROSS JOIN (
  SELECT MAX(CASE WHEN ult_dep_cap < 99 THEN ult_dep_cap END) AS max_rec,
         MAX(CASE WHEN num_meses_distintos_dep_cap < 99 THEN num_meses_distintos_dep_cap END) AS max_frec
  FROM clients) mx"""

_GATES = {"score_dep_cap": "dep_cte_cap", "score_cpa_div": "cpa_div", "score_vta_div": "vta_div",
          "score_pag_dex": "pag_dex", "score_env_dex": "env_dex", "score_pag_rem": "pag_rem",
          "score_env_rem": "env_rem"}


def _gate(f: str, name: str) -> str:
    r, q = f"score_rec_{f}", f"score_frec_{f}"
    return f"CASE WHEN {q} <= 0.5 OR {r} <= 0.5 OR {r} < {q} THEN 0.0 ELSE ({r} + {q}) / 2 END AS {name}"


CTE["s2"] = f"SELECT *, {', '.join(_gate(f, n) for n, f in _GATES.items())} FROM s1"


def _svc(gate: str, tin: str, tout: str, n: str, name: str) -> str:
    return (f"CASE WHEN {gate} > 0.5 THEN {gate} * ((CAST({tin} AS DOUBLE) - CAST({tout} AS DOUBLE)) "
            f"/ CAST({n} AS DOUBLE)) ELSE 0.0 END AS {name}")


CTE["s3"] = f"""
SELECT *,
  CASE WHEN score_dep_cap = 0 THEN 0.0
       ELSE tot_mto_dep_cte_cap_corr / CAST(num_meses_distintos_dep_cap AS DOUBLE) END AS RFM_cap,
  {_svc('score_cpa_div', 'tot_mto_cpa_div', 'tot_mto_vta_div', 'num_meses_distintos_cpa_div', 'RFM_div')},
  {_svc('score_pag_dex', 'tot_mto_pag_dex', 'tot_mto_env_dex', 'num_meses_distintos_pag_dex', 'RFM_dex')},
  {_svc('score_pag_rem', 'tot_mto_pag_rem', 'tot_mto_env_rem', 'num_meses_distintos_pag_rem', 'RFM_rem')}
FROM s2"""

CTE["s4"] = """
SELECT *,
  coalesce(RFM_div, 0) + coalesce(RFM_dex, 0) + coalesce(RFM_rem, 0) AS RFM_servicios,
  CASE WHEN RFM_cap - CAST(mto_ing_mes AS DOUBLE) > 0 THEN RFM_cap - CAST(mto_ing_mes AS DOUBLE) ELSE 0 END
    * score_dep_cap AS ing_extraordinarios_cap
FROM s3"""

CTE["s5"] = """
SELECT *,
  CASE WHEN greatest(CAST(mto_ing_mes AS DOUBLE), RFM_cap, RFM_servicios, regr) > 100
       THEN greatest(CAST(mto_ing_mes AS DOUBLE), RFM_cap, RFM_servicios, regr)
       ELSE ingreso_prom_succ END AS ingresos_otros
FROM s4"""

CTE["s6"] = """
SELECT *,
  CASE WHEN ingresos_otros = CAST(mto_ing_mes AS DOUBLE) THEN 'RENTA DIRECTA'
       WHEN ingresos_otros = RFM_cap THEN 'RFM(CAPTACION)'
       WHEN ingresos_otros = RFM_servicios THEN 'SERVICIOS'
       WHEN ingresos_otros = ingreso_prom_succ THEN 'INEGI'
       ELSE 'POTENCIALES' END AS etiqueta_otros,
  CAST(mto_ing_mes AS DOUBLE) AS inc,
  cod_tipo_nomina = '01 OBSERVADA' AS c_obs,
  cod_tipo_nomina = '02 ESTIMADA' AND cod_flujo = 'EFECTIVO' AS c_cash,
  cod_tipo_nomina = '02 ESTIMADA' AND cod_flujo <> 'EFECTIVO' AS c_other,
  cod_tipo_nomina = '03 NO ESTIMADA' AND num_flujos IS NOT NULL AS c_noest,
  cod_tipo_nomina = 'VACIO' AS c_empty
FROM s5"""

# the cascade as successive overwrites, first rule first
_V = "NULL::DOUBLE"
for _cond, _val in (
    ("c_obs", "inc + CASE WHEN RFM_cap >= RFM_servicios THEN RFM_cap ELSE RFM_servicios END"),
    ("c_cash", "CASE WHEN inc + ing_extraordinarios_cap >= RFM_servicios THEN inc + ing_extraordinarios_cap ELSE RFM_servicios END"),
    ("c_other", "inc + CASE WHEN ing_extraordinarios_cap >= RFM_servicios THEN ing_extraordinarios_cap ELSE RFM_servicios END"),
    ("c_noest", "CASE WHEN inc + ing_extraordinarios_cap >= RFM_servicios THEN inc + ing_extraordinarios_cap ELSE RFM_servicios END"),
    ("c_empty", "ingresos_otros"),
):
    _V = f"CASE WHEN {_cond} THEN {_val} ELSE {_V} END"

_EXTRA = "CASE WHEN ing_extraordinarios_cap > 0 THEN 'RENTA DIRECTA + INGRESOS EXTRAORDINARIOS CAPTACION' ELSE 'RENTA DIRECTA' END"
_R = "'nan'"
for _cond, _val in (
    ("c_obs", "CASE WHEN RFM_cap >= RFM_servicios THEN CASE WHEN RFM_cap > 0 THEN 'RENTA DIRECTA + RFM(CAPTACION)' ELSE 'RENTA DIRECTA' END "
              "ELSE CASE WHEN RFM_servicios > 0 THEN 'RENTA DIRECTA + SERVICIOS' ELSE 'RENTA DIRECTA' END END"),
    ("c_cash", f"CASE WHEN inc + ing_extraordinarios_cap >= RFM_servicios THEN {_EXTRA} "
               "ELSE CASE WHEN RFM_servicios > 0 THEN 'SERVICIOS' ELSE '' END END"),
    ("c_other", f"CASE WHEN ing_extraordinarios_cap >= RFM_servicios THEN {_EXTRA} "
                "ELSE CASE WHEN RFM_servicios > 0 THEN 'RENTA DIRECTA + SERVICIOS' ELSE 'RENTA DIRECTA' END END"),
    ("c_noest", f"CASE WHEN inc + ing_extraordinarios_cap >= RFM_servicios THEN {_EXTRA} "
                "ELSE CASE WHEN RFM_servicios > 0 THEN 'SERVICIOS' ELSE '' END END"),
    ("c_empty", "CASE WHEN etiqueta_otros = 'RENTA DIRECTA' THEN 'CAPACIDAD DE PAGO' ELSE etiqueta_otros END"),
):
    _R = f"CASE WHEN {_cond} THEN {_val} ELSE {_R} END"

_G = "'nan'"
for _cond, _val in (
    ("c_obs", "'01 NOMINA OBSERVADA'"),
    ("cod_tipo_nomina = '02 ESTIMADA'", "'02 NOMINA ESTIMADA'"),
    ("c_noest", "'03 NOMINA NO ESTIMADA'"),
    ("c_empty", "'04 SIN RENTA DIRECTA'"),
):
    _G = f"CASE WHEN {_cond} THEN {_val} ELSE {_G} END"

CTE["s7"] = f"SELECT *, {_V} AS valor_renta, {_R} AS regla, {_G} AS etiqueta FROM s6"


def _ind(cond: str, name: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END AS {name}"


CTE["s8"] = f"""
SELECT *,
  {_ind("(contains(regla, 'RENTA DIRECTA') OR contains(regla, 'CAPACIDAD DE PAGO')) AND inc > 0", 'ind_renta_directa')},
  {_ind("contains(regla, 'INGRESOS EXTRAORDINARIOS CAPTACION') AND ing_extraordinarios_cap > 0", 'ind_rfm_cap_dif')},
  {_ind("regexp_matches(regla, 'RFM(CAPTACION)') AND RFM_cap > 0", 'ind_rfm_cap_tot')},
  {_ind("contains(regla, 'SERVICIOS') AND RFM_servicios > 0", 'ind_rfm_servicios')},
  {_ind("contains(regla, 'POTENCIALES') AND regr > 0", 'ind_pot')},
  {_ind("contains(regla, 'INEGI') AND ingreso_prom_succ > 0", 'ind_inegi')},
  CASE WHEN CAST(tot_mto_cpa_div AS DOUBLE) - CAST(tot_mto_vta_div AS DOUBLE) > 0
       THEN CAST(tot_mto_cpa_div AS DOUBLE) - CAST(tot_mto_vta_div AS DOUBLE) ELSE 0 END AS mto_div,
  CASE WHEN CAST(tot_mto_pag_dex AS DOUBLE) - CAST(tot_mto_env_dex AS DOUBLE) > 0
       THEN CAST(tot_mto_pag_dex AS DOUBLE) - CAST(tot_mto_env_dex AS DOUBLE) ELSE 0 END AS mto_dex,
  CASE WHEN CAST(tot_mto_pag_rem AS DOUBLE) - CAST(tot_mto_env_rem AS DOUBLE) > 0
       THEN CAST(tot_mto_pag_rem AS DOUBLE) - CAST(tot_mto_env_rem AS DOUBLE) ELSE 0 END AS mto_rem
FROM s7"""

CTE["s9"] = f"""
SELECT *,
  {_ind('ind_rfm_servicios = 1 AND RFM_div > 0', 'ind_rfm_div')},
  {_ind('ind_rfm_servicios = 1 AND RFM_dex > 0', 'ind_rfm_dex')},
  {_ind('ind_rfm_servicios = 1 AND RFM_rem > 0', 'ind_rfm_rem')}
FROM s8"""

_OUT_SRC = {v: k for k, v in RENAMES.items()}
CTE["scored_out"] = "SELECT " + ", ".join(
    (f"round_even(CAST({_OUT_SRC.get(c, c)} AS DOUBLE), 4) AS {c}" if c in ROUNDED
     else f"{_OUT_SRC.get(c, c)} AS {c}")
    for c in OUTPUT_COLUMNS
) + " FROM s9"


# ------------------------------------------------------------------- helpers
def _with() -> str:
    """WITH clause holding the input views plus every derived CTE (DuckDB
    skips the ones a query does not reference)."""
    parts = [f"{n} AS ({s.strip()})" for n, s in VIEWS.items()]
    parts += [f"{n} AS ({s.strip()})" for n, s in CTE.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def _typed(source: str, cols: list[tuple[str, str]], where: str = "") -> str:
    """Final projection with explicit output types: B=BIGINT D=DOUBLE S=VARCHAR
    R=round_even(DOUBLE, 4), L=round_even(DOUBLE, 10), ''=as is."""
    sel = []
    for name, t in cols:
        if t == "B":
            sel.append(f"CAST({name} AS BIGINT) AS {name}")
        elif t == "D":
            sel.append(f"CAST({name} AS DOUBLE) AS {name}")
        elif t == "R":
            sel.append(f"round_even(CAST({name} AS DOUBLE), 4) AS {name}")
        elif t == "L":  # log label shown at 10 decimals
            sel.append(f"round_even(CAST({name} AS DOUBLE), 10) AS {name}")
        elif t == "S":
            sel.append(f"CAST({name} AS VARCHAR) AS {name}")
        else:
            sel.append(name)
    return _with() + f"SELECT {', '.join(sel)} FROM {source} {where}"


def _kind(name: str) -> str:
    """Output type of a feature column by naming rule."""
    if name.startswith(("cod_", "genero", "entidad")):
        return "S"
    if name.startswith(("mto_", "tot_mto_", "saldo", "potencial")) or name.endswith("_corr"):
        return "D"
    return "B"


def _feature_cols(names) -> list[tuple[str, str]]:
    return [(n, _kind(n)) for n in names]


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    fx_hist_cols = [("id_master", "B"), ("num_periodo_mes", "B"), ("ind_activo_div", "B"),
                    ("mto_div_cpa", "D"), ("num_div_cpa", "B"), ("mto_div_vta", "D"), ("num_div_vta", "B")]
    q["src_csv"] = _typed("(SELECT 'plain' AS reader, * FROM fx_hist UNION ALL SELECT 'options', * FROM fx_hist) t",
                          [("reader", "S"), *fx_hist_cols])
    q["src_table"] = _typed(
        f"(SELECT id_master, num_periodo_mes AS per_ref, saldo, potencial, recorrido FROM journey "
        f"WHERE num_periodo_mes = {MES}) t",
        [("id_master", "B"), ("per_ref", "B"), ("saldo", "D"), ("potencial", "D"), ("recorrido", "B")])
    q["dim_states"] = _typed("(SELECT entidad, COUNT(*) AS clientes FROM sdm GROUP BY entidad) t",
                             [("entidad", "S"), ("clientes", "B")])
    pop_cap_cols = [("id_master", "B"), ("per_ref", "B"), ("ind_activo_cap", "B"),
                    ("ind_activo_cre", "B"), ("ind_activo_afr", "B")]
    q["sink_csv"] = _typed("pop_cap", pop_cap_cols)
    q["pop_deposits"] = _typed("pop_cap", pop_cap_cols)
    q["pop_training"] = _typed("pop_train", [("id_master", "B"), ("per_ref", "B"), ("mto_ing_mes", "D")])
    q["pop_transfer"] = _typed("pop_env", [("id_master", "B"), ("per_ref", "B"),
                                           ("ind_activo_rem", "B"), ("ind_activo_dex", "B")])
    q["pop_fx"] = _typed("pop_fx", [("id_master", "B"), ("per_ref", "B")])
    q["sample_one_per_client"] = _typed(
        f"""(SELECT id_master, num_cuenta, num_periodo_mes, mto_dep_transferencia FROM (
              SELECT *, row_number() OVER (PARTITION BY id_master ORDER BY
                md5(concat_ws('|', '{SEED}', CAST(id_master AS VARCHAR), CAST(num_cuenta AS VARCHAR),
                              CAST(num_periodo_mes AS VARCHAR))), num_cuenta, num_periodo_mes) AS rn
              FROM account_hist WHERE num_periodo_mes BETWEEN {START} AND {MES}) s WHERE rn = 1) t""",
        [("id_master", "B"), ("num_cuenta", "B"), ("num_periodo_mes", "B"), ("mto_dep_transferencia", "D")])

    acct_cols = [("id_master", "B"), ("per_ref", "B"), ("num_periodo_mes", "B"), ("diff_mes", "B")]
    acct_cols += [(m, "D" if m.startswith("mto") else "B") for m in MEASURES]
    q["deposits_account_month"] = _typed(
        "(SELECT * FROM acct_rows WHERE id_master IN (SELECT id_master FROM pop_cap)) t", acct_cols)
    q["deposits_client_month"] = _typed("cap_cm", [("id_master", "B"), ("num_periodo_mes", "B"),
                                                  ("per_ref", "B"), ("diff_mes", "B")]
                                        + [(m, "D" if m.startswith("mto") else "B") for m in MEASURES])
    q["trimmed_total"] = _typed(
        """(SELECT id_master,
              CAST(SUM(CASE WHEN o1 BETWEEN 2 AND 5 THEN mto_dep_cap ELSE 0 END) AS DOUBLE) * 1.5 AS mto_dep_cap_corr,
              CAST(SUM(CASE WHEN o2 BETWEEN 2 AND 5 THEN mto_dep_cte_cap ELSE 0 END) AS DOUBLE) * 1.5 AS mto_dep_cte_cap_corr,
              CAST(SUM(CASE WHEN o3 BETWEEN 2 AND 5 THEN mto_ret_cap ELSE 0 END) AS DOUBLE) * 1.5 AS mto_ret_cap_corr
            FROM (SELECT *, row_number() OVER (PARTITION BY id_master ORDER BY mto_dep_cap) AS o1,
                            row_number() OVER (PARTITION BY id_master ORDER BY mto_dep_cte_cap) AS o2,
                            row_number() OVER (PARTITION BY id_master ORDER BY mto_ret_cap) AS o3
                  FROM cap_cm) r GROUP BY id_master) t""",
        [("id_master", "B"), ("mto_dep_cap_corr", "D"), ("mto_dep_cte_cap_corr", "D"), ("mto_ret_cap_corr", "D")])
    cap_feat_names = ["id_master", "per_ref", *FEATURE_COLS, "mto_tot_dep_cap_ult_mes", "mto_dep_cte_cap_ult_mes"]
    q["deposits_features"] = _typed("feat_cap", _feature_cols(cap_feat_names))
    q["sorted_output"] = q["deposits_features"]
    enr_names = ["id_master", "per_ref", *[c for c, _ in INCOME_COLS], *[c for c, _ in JOURNEY_COLS], *FEATURE_COLS]
    q["deposits_enriched"] = _typed("enr_cap", _feature_cols(enr_names))
    q["calendar_spine"] = _typed("env_spine", [("id_master", "B"), ("per_ref", "B"), ("ind_activo_rem", "B"),
                                               ("ind_activo_dex", "B"), ("num_periodo_mes", "B"), ("diff_mes", "B")])
    env_names = ["id_master", "per_ref", "ind_activo_dex", "ind_activo_rem",
                 *[f"ult_{f}" for f in _ENV_FAMS],
                 *[f"num_meses_distintos_{f}" for f in ("movs_rem", "pag_rem", "env_rem", "movs_dex", "pag_dex", "env_dex")],
                 *[f"tot_mto_{f}_corr" for f in _ENV_FAMS],
                 *[f"tot_{k}_{f}" for f in _ENV_FAMS for k in ("mto", "num")]]
    q["transfer_features"] = _typed("feat_env", _feature_cols(env_names))
    q["fx_features"] = _typed("feat_fx", _feature_cols(["id_master", "per_ref", *FX_COLS]))
    demo = [("id_master", "B"), ("genero", "S"), ("edad", "B"), ("cod_postal", "B"), ("entidad", "S")]
    q["feat_demographics"] = _typed("sdm", demo)
    uni_names = ["id_master", "per_ref", *[c for c, _ in INCOME_COLS], *[c for c, _ in JOURNEY_COLS],
                 *FEATURE_COLS, *FX_COLS, *TRANSFER_COLS]
    q["unify"] = _typed("uni", _feature_cols(uni_names))
    q["unify_demographics"] = _typed("unid", _feature_cols(uni_names) + [
        ("genero", "S"), ("edad", "B"), ("entidad", "S"), ("cod_postal", "B")])
    q["union_clients"] = _typed("(SELECT * FROM unid WHERE ind_activo_cap IN (0, 1)) t",
                                [("id_master", "B"), ("ind_activo_cap", "B"), ("saldo", "D"), ("edad", "B")])

    train_cols = [("id_master", "B"), ("per_ref", "B"), ("mto_ing_mes", "D"), ("genero", "S"), ("edad", "B"),
                  ("entidad", "S"), ("cod_postal", "B"), ("saldo", "D"), ("potencial", "D"), ("recorrido", "B")]
    q["train_features"] = _typed("train_feat", train_cols)
    prep_cols = [("saldo", "D"), ("potencial", "D"), ("recorrido", "B"), ("edad", "B"), ("log_mto_ing_mes", "L")]
    q["train_prep"] = _typed("tprep", prep_cols)
    q["train_split"] = _typed(f"(SELECT *, {_BUCKET} AS is_train FROM tprep) t",
                              prep_cols + [("is_train", "B")])
    q["train_model"] = _typed(
        "(SELECT 'success' AS status, COUNT(*) AS n, stddev_pop(log_mto_ing_mes) AS label_deviation, true AS rmse_below_deviation FROM test_rows) t",
        [("status", "S"), ("n", "B"), ("label_deviation", "R"), ("rmse_below_deviation", "B")])
    serr = "(prediction - log_mto_ing_mes)"
    q["stump_model"] = _typed(
        f"""(SELECT COUNT(*) AS n, sqrt(avg({serr} * {serr})) AS rmse, avg({serr} * {serr}) AS mse, avg(abs({serr})) AS mae,
              1 - avg({serr} * {serr}) / var_pop(log_mto_ing_mes) AS r2,
              avg(pow(prediction - (SELECT avg(log_mto_ing_mes) FROM test_rows), 2)) AS explained_variance
            FROM stump_test) t""",
        [("n", "B"), ("rmse", "R"), ("mse", "R"), ("mae", "R"), ("r2", "R"), ("explained_variance", "R")])
    q["feature_importance"] = _typed(
        f"""(SELECT f.feature, (SELECT count(*) FROM stumps s WHERE s.feature = f.feature) / {TREES}.0 AS importance
            FROM (SELECT unnest(['saldo', 'potencial', 'recorrido', 'edad']) AS feature) f) t""",
        [("feature", "S"), ("importance", "R")])
    q["model_income"] = _typed(
        """(SELECT id_master, ind_activo_cap, CASE WHEN ind_activo_cap = 1 THEN pow(10.0, prediction) - 1 WHEN ind_activo_cap = 0 THEN 0 END AS regr
            FROM stump_clients) t""",
        [("id_master", "B"), ("ind_activo_cap", "B"), ("regr", "R")])
    q["latest_model"] = _typed(
        f"(SELECT '{MES}' AS version, COUNT(*) AS n_train, 2 AS published FROM train_feat) t", [("version", "S"), ("n_train", "B"), ("published", "B")])
    q["target_log"] = _typed(
        "(SELECT id_master, mto_ing_mes, round_even(log10(CAST(mto_ing_mes AS DOUBLE) + 1), 10) AS log_mto_ing_mes, "
        "pow(10.0, log10(CAST(mto_ing_mes AS DOUBLE) + 1)) - 1 AS mto_ing_mes_back FROM train_feat) t",
        [("id_master", "B"), ("mto_ing_mes", "D"), ("log_mto_ing_mes", "D"), ("mto_ing_mes_back", "R")])
    err = ("(2.0 + 0.0001 * CAST(saldo AS DOUBLE) + 0.05 * CAST(recorrido AS DOUBLE)) - log_mto_ing_mes")
    q["regression_metrics"] = _typed(
        f"""(SELECT COUNT(*) AS n, sqrt(avg(({err}) * ({err}))) AS rmse, avg(({err}) * ({err})) AS mse,
              avg(abs({err})) AS mae,
              CASE WHEN var_pop(log_mto_ing_mes) > 0 THEN 1 - avg(({err}) * ({err})) / var_pop(log_mto_ing_mes) END AS r2,
              avg(pow(2.0 + 0.0001 * CAST(saldo AS DOUBLE) + 0.05 * CAST(recorrido AS DOUBLE)
                  - (SELECT avg(log_mto_ing_mes) FROM tprep), 2)) AS explained_variance
            FROM tprep) t""",
        [("n", "B"), ("rmse", "R"), ("mse", "R"), ("mae", "R"), ("r2", "R"), ("explained_variance", "R")])

    q["adjust_factor"] = _typed("factor", [("median_target", "R"), ("median_census", "R"), ("factor", "R")])
    q["census_income"] = _typed(
        "(SELECT u.id_master, u.cod_postal, coalesce(k.ingreso_prom_succ, 0) AS ingreso_prom_succ "
        "FROM unid u LEFT JOIN succ k ON u.cod_postal = k.cod_postal) t",
        [("id_master", "B"), ("cod_postal", "B"), ("ingreso_prom_succ", "D")])
    q["census_adjusted"] = _typed(
        "(SELECT id_master, ingreso_prom_succ, greatest(regr, ingreso_prom_succ) AS ing_sdm FROM clients) t",
        [("id_master", "B"), ("ingreso_prom_succ", "R"), ("ing_sdm", "R")])
    q["score_rfm"] = _typed("s1", [("id_master", "B")] + [(n, "D") for n in REC_NAMES + FREQ_NAMES])
    q["score_gate"] = _typed("s2", [("id_master", "B")] + [(n, "D") for n in _GATES])
    q["rfm_income"] = _typed("s4", [("id_master", "B")] + [(n, "R") for n in (
        "RFM_cap", "RFM_div", "RFM_dex", "RFM_rem", "RFM_servicios", "ing_extraordinarios_cap")])
    q["income_other"] = _typed("s6", [("id_master", "B"), ("ingresos_otros", "R"), ("etiqueta_otros", "S")])
    q["income_rules"] = _typed("s7", [("id_master", "B"), ("valor_renta", "R"), ("regla", "S"), ("etiqueta", "S")])
    q["income_indicators"] = _typed("s9", [("id_master", "B")] + [(n, "B") for n in (
        "ind_renta_directa", "ind_rfm_cap_dif", "ind_rfm_cap_tot", "ind_rfm_servicios", "ind_pot", "ind_inegi",
        "ind_rfm_div", "ind_rfm_dex", "ind_rfm_rem")] + [("mto_div", "R"), ("mto_dex", "R"), ("mto_rem", "R")])
    out_types = []
    for c in OUTPUT_COLUMNS:
        if c.startswith("cod_") and c != "cod_postal":
            out_types.append((c, "S"))
        elif c in ROUNDED:
            out_types.append((c, "D"))
        elif c.startswith(("ind_", "rec_", "frec_")) or c in ("id_master", "edad", "cod_postal", "num_periodo_mes"):
            out_types.append((c, "B"))
        else:
            out_types.append((c, "D"))
    q["score_clients"] = _typed("scored_out", out_types)
    pct = [0.01, 0.05, 0.1, 0.15, 0.25, 0.35, 0.5, 0.6, 0.75, 0.9, 0.95, 0.99]
    pnames = ["p1", "p5", "p10", "p15", "p25", "p35", "p50", "p60", "p75", "p90", "p95", "p99"]
    pq = ", ".join(f"quantile_cont(x, {p}) AS {n}" for p, n in zip(pct, pnames))
    q["report"] = _typed(
        f"""(SELECT cod_grupo_renta, cod_ingreso_renta, COUNT(x) AS count,
              100.0 * COUNT(x) / SUM(COUNT(x)) OVER () AS prop, avg(x) AS mean, stddev_samp(x) AS std,
              min(x) AS min, {pq}, max(x) AS max
            FROM (SELECT *, CAST(ing_renta_indirecta AS DOUBLE) AS x FROM scored_out) s
            GROUP BY cod_grupo_renta, cod_ingreso_renta) t""",
        [("cod_grupo_renta", "S"), ("cod_ingreso_renta", "S"), ("count", "B"), ("prop", "R"), ("mean", "R"),
         ("std", "R"), ("min", "R"), *[(n, "R") for n in pnames], ("max", "R")])
    q["report_overall"] = _typed(
        """(SELECT COUNT(x) AS count, avg(x) AS mean, stddev_samp(x) AS std, min(x) AS min,
              quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75,
              max(x) AS max
            FROM (SELECT CAST(ing_renta_indirecta AS DOUBLE) AS x FROM scored_out) s) t""",
        [("count", "B"), ("mean", "R"), ("std", "R"), ("min", "R"), ("p25", "R"), ("p50", "R"), ("p75", "R"),
         ("max", "R")])
    q["period_math"] = _typed(
        f"""(SELECT num_periodo_mes, {_period_date('num_periodo_mes')} AS fecha,
              CAST(strftime({_period_date('num_periodo_mes')}, '%Y%m') AS INT) AS per_formato,
              year({_period_date('num_periodo_mes')}) * 100 + month({_period_date('num_periodo_mes')}) AS per_portable,
              CAST(strftime({_period_date('num_periodo_mes')} - INTERVAL 5 MONTH, '%Y%m') AS INT) AS inicio_historia,
              {_diff('num_periodo_mes')} AS diff_mes,
              {_diff('num_periodo_mes')} AS diff_mes_fechas
            FROM (SELECT DISTINCT num_periodo_mes FROM account_hist) m) t""",
        [("num_periodo_mes", "B"), ("fecha", ""), ("per_formato", "B"), ("per_portable", "B"),
         ("inicio_historia", "B"), ("diff_mes", "B"), ("diff_mes_fechas", "B")])
    q["report_approx"] = _typed(
        "(SELECT cod_grupo_renta, cod_ingreso_renta, COUNT(ing_renta_indirecta) AS count, true AS within FROM scored_out GROUP BY 1, 2) t",
        [("cod_grupo_renta", "S"), ("cod_ingreso_renta", "S"), ("count", "B"), ("within", "B")])
    q["sink_scored"], q["sink_report"] = q["score_clients"], q["report"]
    q["src_quarantine"] = _typed(
        """(SELECT 'good' AS kind, NULL AS "column", NULL AS reason, NULL AS cell, id_master, num_periodo_mes, mto_div_cpa FROM fx_hist
              WHERE id_master % 7 <> 1 AND id_master % 5 <> 2
            UNION ALL SELECT 'bad', 'mto_div_cpa', 'is no decimal(28,2)', 'n/a', NULL, NULL, NULL FROM fx_hist WHERE id_master % 7 = 1
            UNION ALL SELECT 'bad', 'num_periodo_mes', 'is no int', 'unknown', NULL, NULL, NULL FROM fx_hist WHERE id_master % 5 = 2) t""",
        [("kind", "S"), ('"column"', "S"), ("reason", "S"), ("cell", "S"), ("id_master", "B"), ("num_periodo_mes", "B"), ("mto_div_cpa", "D")])
    # the same features from monthly states
    q |= {"state_deposits": q["deposits_features"], "state_transfers": q["transfer_features"], "state_fx": q["fx_features"]}
    return q
