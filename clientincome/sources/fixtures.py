"""Input views over the driver's test tables.

The engine's canonical inputs (contact, account history, ...) are expressed as
SQL views over the generic test tables.  The same SQL text is valid in Spark
SQL and DuckDB, so the oracle reuses it verbatim as CTEs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# Deposit channels in column order, and the line status that
# marks a deposit (dep) or a withdrawal (ret) in the account-history view.
CHANNELS = ("transferencia", "cheque", "efectivo", "nomina", "traspaso_terceros")
DIRECTIONS = (("dep", "O"), ("ret", "F"))


def _account_measures() -> str:
    parts = []
    for direction, status in DIRECTIONS:
        for i, channel in enumerate(CHANNELS):
            cond = f"l_linestatus='{status}' AND l_partkey % 5 = {i}"
            parts.append(
                f"SUM(CASE WHEN {cond} THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END)"
                f" AS mto_{direction}_{channel}"
            )
            parts.append(
                f"CAST(SUM(CASE WHEN {cond} THEN l_quantity ELSE 0 END) AS INT)"
                f" AS num_{direction}_{channel}"
            )
    return ",\n  ".join(parts)


VIEWS: dict[str, str] = {
    "contact": """
SELECT c_custkey AS id_master, CASE WHEN c_mktsegment='MACHINERY' THEN 'MO' ELSE 'FI' END AS tipo_persona,
 CASE c_nationkey % 4 WHEN 0 THEN ' VERACRUZ DE IGNACIO DE LA LLAVE ' WHEN 1 THEN 'JALISCO' WHEN 2 THEN 'MEXICO ' ELSE n_name END AS lentidad,
 CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN 'N' WHEN 1 THEN 'E ' WHEN 2 THEN 'M' WHEN 3 THEN 'F' END AS genero,
 DATE '1930-01-01' + CAST((c_custkey*37) % 30000 AS INT) AS fecha_nacimiento, 1000 + c_nationkey AS cposta
 FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "account_hist": f"""
SELECT l_suppkey AS id_master, l_linenumber % 3 AS num_cuenta,
  year(l_shipdate)*100+month(l_shipdate) AS num_periodo_mes,
  {_account_measures()}
FROM lineitem GROUP BY 1,2,3""",
    "deposit_hist": """
SELECT s_suppkey AS id_master, per AS num_periodo_mes, CASE WHEN (s_suppkey + k) % 10 < 8 THEN 1 ELSE 0 END AS ind_activo_cap,
 CAST(s_acctbal AS DECIMAL(18,2)) + k * (s_suppkey % 2) AS sld_tot_prod_cap, CASE WHEN s_suppkey % 7 = 3 THEN 'PM' ELSE 'PF' END AS cod_tipo_persona
 FROM supplier CROSS JOIN (VALUES (0),(1)) AS v(k) CROSS JOIN (VALUES (200011),(200012)) AS m(per)""",
    "transfer_hist": """
SELECT user_id AS id_master, num_periodo_mes, CASE WHEN user_id % 3 <> 0 THEN 1 ELSE 0 END AS ind_activo_rem, CAST(user_id % 2 AS INT) AS ind_activo_dex,
 SUM(CASE WHEN event_type='purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS mto_pag_rem, SUM(CASE WHEN event_type='purchase' THEN 1 END) AS num_pag_rem,
 SUM(CASE WHEN event_type='error' THEN CAST(value AS DECIMAL(18,2)) END) AS mto_env_rem, SUM(CASE WHEN event_type='error' THEN 1 END) AS num_env_rem,
 SUM(CASE WHEN event_type='signup' THEN CAST(value AS DECIMAL(18,2)) END) AS mto_pag_dex, SUM(CASE WHEN event_type='signup' THEN 1 END) AS num_pag_dex,
 SUM(CASE WHEN event_type='click' THEN CAST(value AS DECIMAL(18,2)) END) AS mto_env_dex, SUM(CASE WHEN event_type='click' THEN 1 END) AS num_env_dex
 FROM (SELECT user_id, event_type, value, 200007 + CASE WHEN day(ts) > 30 THEN 5 ELSE CAST(floor((day(ts)-1)/5) AS INT) END AS num_periodo_mes
  FROM events) AS e GROUP BY user_id, num_periodo_mes""",
    "fx_hist": """
SELECT 2*CAST(floor(o_custkey/15) AS BIGINT) AS id_master, year(o_orderdate)*100+month(o_orderdate) AS num_periodo_mes, MAX(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) AS ind_activo_div,
 SUM(CASE WHEN o_orderstatus='F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS mto_div_cpa, SUM(CASE WHEN o_orderstatus='F' THEN 1 END) AS num_div_cpa,
 SUM(CASE WHEN o_orderstatus='O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS mto_div_vta, SUM(CASE WHEN o_orderstatus='O' THEN 1 END) AS num_div_vta
 FROM orders GROUP BY 1,2""",
    "income": """
SELECT c_custkey AS id_master, per AS num_periodo_mes, CAST(c_acctbal AS DECIMAL(18,2))*10 AS mto_ing_mes, CASE c_mktsegment WHEN 'BUILDING' THEN 'NOMINA' WHEN 'AUTOMOBILE' THEN 'EFECTIVO' ELSE 'TRANSFERENCIA' END AS cod_flujo,
 CAST(c_custkey % 3 AS INT) AS num_flujos, CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN '01 OBSERVADA' WHEN 1 THEN '02 ESTIMADA' WHEN 2 THEN '03 NO ESTIMADA' WHEN 3 THEN 'VACIO' END AS cod_tipo_nomina,
 CAST(NULL AS VARCHAR(20)) AS cod_tipo_nomina_detalle, CAST(c_custkey % 2 AS INT) AS ind_cre_ov, 'ALTA' AS cod_estabilidad_mto, 'MEDIA' AS cod_estabilidad_periodidad,
 CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 2 AS INT) END AS ind_cre, CASE WHEN c_custkey % 6 <> 0 THEN CAST(c_custkey % 3 AS INT) END AS ind_afr
 FROM customer CROSS JOIN (VALUES (200011),(200012)) AS m(per)""",
    "journey": """
SELECT id_master, per AS num_periodo_mes, cod_perfil_trx, saldo, potencial, recorrido
 FROM (SELECT c_custkey AS id_master, CASE WHEN c_nationkey < 20 THEN 'P1' END AS cod_perfil_trx, CAST(c_acctbal AS DECIMAL(18,2)) AS saldo, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS potencial, COUNT(*) AS recorrido
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_nationkey, c_acctbal) AS j CROSS JOIN (VALUES (200011),(200012)) AS m(per)""",
    "calendar": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha, year(o_orderdate)*100+month(o_orderdate) AS num_periodo_mes FROM orders""",
    "census": """
SELECT CASE WHEN k = 1 THEN 'Estado' WHEN c_nationkey = 24 THEN 'Municipio' ELSE 'Código postal' END AS nivel, 1000 + c_nationkey AS cod_postal, COUNT(*) AS familias, SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS ingreso_familiar, 4*COUNT(*) AS poblacion, COUNT(*) AS pei
 FROM customer CROSS JOIN (VALUES (0),(1)) AS v(k) GROUP BY 1, 2""",
}


def cte_prefix() -> str:
    """All views as a ``WITH`` list body (no leading WITH), for the oracle."""
    return ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in VIEWS.items())


@dataclass
class Inputs:
    contact: DataFrame
    account_hist: DataFrame
    deposit_hist: DataFrame
    transfer_hist: DataFrame
    fx_hist: DataFrame
    income: DataFrame
    journey: DataFrame
    calendar: DataFrame
    census: DataFrame


def register_base_tables(spark: SparkSession, sf_dir: str) -> None:
    for name in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def load_inputs(spark: SparkSession, sf_dir: str, register_views: bool = False) -> Inputs:
    """Read the test tables and build every input view as a DataFrame.

    The views are lazy; Catalyst prunes columns and pushes filters from the
    operators through them into the parquet scans.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    register_base_tables(spark, sf_dir)
    frames = {name: spark.sql(sql) for name, sql in VIEWS.items()}
    if register_views:
        for name, df in frames.items():
            df.createOrReplaceTempView(name)
    return Inputs(**frames)
