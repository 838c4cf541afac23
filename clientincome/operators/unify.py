"""Unification of the deposit, currency and transfer feature tables (X13),
demographics (J14) and the training feature table (X2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientincome.operators.deposits import FEATURE_COLS, INCOME_COLS, JOURNEY_COLS, LAST_MONTH_COLS
from clientincome.operators import copies
from clientincome.operators.sampling import first_per_key
from clientincome.semantics import REFERENCE, RunParams, Semantics

RECENCY_DEFAULT = 99

FX_COLS = (
    "ind_activo_div", "ult_cpa_div", "ult_vta_div",
    "num_meses_distintos_movs_div", "num_meses_distintos_cpa_div", "num_meses_distintos_vta_div",
    "tot_mto_cpa_div_corr", "tot_mto_vta_div_corr",
    "tot_mto_cpa_div", "tot_num_cpa_div", "tot_mto_vta_div", "tot_num_vta_div",
)
TRANSFER_COLS = (
    "ind_activo_dex", "ind_activo_rem",
    "ult_pag_rem", "ult_env_rem", "ult_pag_dex", "ult_env_dex",
    "num_meses_distintos_movs_rem", "num_meses_distintos_pag_rem", "num_meses_distintos_env_rem",
    "num_meses_distintos_movs_dex", "num_meses_distintos_pag_dex", "num_meses_distintos_env_dex",
    "tot_mto_pag_dex_corr", "tot_mto_env_dex_corr", "tot_mto_pag_rem_corr",
    "tot_mto_pag_rem", "tot_num_pag_rem", "tot_mto_env_rem", "tot_num_env_rem",
    "tot_mto_pag_dex", "tot_num_pag_dex", "tot_mto_env_dex", "tot_num_env_dex",
)
DROPPED_TRANSFER_COLS = ("tot_mto_env_rem_corr",)


def _default(col: str):
    return RECENCY_DEFAULT if col.startswith("ult_") else 0


def unify(
    deposits: DataFrame,
    fx: DataFrame,
    transfers: DataFrame,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """One row per client of any population, 72 columns (REFERENCE).

    Two full outer joins on the client id, the second keyed by the coalesced
    id of the first, as in the original; each side is one row per client
    (grouped by client and the fixed reference month), so no key fans out.
    Missing features default to 0, recency to 99, text to 'NO DISPONIBLE'.
    """
    a, b, c = deposits.alias("a"), fx.alias("b"), transfers.alias("c")
    ab = a.join(b, F.col("a.id_master") == F.col("b.id_master"), "full")
    abc = ab.join(
        c, F.coalesce(F.col("a.id_master"), F.col("b.id_master")) == F.col("c.id_master"), "full"
    )
    dep_cols = FEATURE_COLS + (LAST_MONTH_COLS if sem.keep_dropped_columns else ())
    env_cols = TRANSFER_COLS + (DROPPED_TRANSFER_COLS if sem.keep_dropped_columns else ())
    sel = [
        F.coalesce("a.id_master", "b.id_master", "c.id_master").alias("id_master"),
        F.coalesce("a.per_ref", "b.per_ref", "c.per_ref").alias("per_ref"),
    ]
    sel += [F.coalesce(F.col(f"a.{n}"), F.lit(d)).alias(n) for n, d in INCOME_COLS + JOURNEY_COLS]
    sel += [F.coalesce(F.col(f"a.{n}"), F.lit(_default(n))).alias(n) for n in dep_cols]
    sel += [F.coalesce(F.col(f"b.{n}"), F.lit(_default(n))).alias(n) for n in FX_COLS]
    sel += [F.coalesce(F.col(f"c.{n}"), F.lit(_default(n))).alias(n) for n in env_cols]
    if copies.WEIGHT in deposits.columns:  # repeats from the deposit-side dimensions
        sel.append(copies.weight_of(deposits, "a").alias(copies.WEIGHT))
    return abc.select(*sel)


def add_demographics(unified: DataFrame, demographics: DataFrame) -> DataFrame:
    """Unified features + (genero, edad, entidad, cod_postal), left join.

    Only resolved ids (> 0) can match a client, so the contact side is cut to
    them at the scan: a large block of unresolved ids would otherwise shuffle
    into one task on the side of the outer join that AQE cannot split.
    Repeated contact rows travel as the weight ``_w`` (``copies.expand``).
    """
    u = unified.alias("u")
    d = copies.counted_rows(demographics.where(F.col("id_master") > 0), ["id_master"]).alias("d")
    return u.join(d, F.col("u.id_master") == F.col("d.id_master"), "left").select(
        *[F.col(f"u.{c}") for c in unified.columns if c != copies.WEIGHT],
        F.coalesce(F.col("d.genero"), F.lit("NO DISPONIBLE")).alias("genero"),
        F.coalesce(F.col("d.edad"), F.lit(0)).alias("edad"),
        F.coalesce(F.col("d.entidad"), F.lit("NO DISPONIBLE")).alias("entidad"),
        F.coalesce(F.col("d.cod_postal"), F.lit(0)).alias("cod_postal"),
        (copies.weight_of(unified, "u") * copies.times_count("d")).alias(copies.WEIGHT),
    )


def training_features(
    population: DataFrame,
    demographics: DataFrame,
    journey: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """Training table (X2): population + demographics + journey, 10 columns.

    The journey table is cut to the reference month and joined on the id
    only, as in the original; missing text is 'VACIO' here (Q13).
    """
    j = journey.where((F.col("num_periodo_mes") == params.mes) & (F.col("id_master") > 0)).select(
        "id_master", "saldo", "potencial", "recorrido"
    )
    if sem.dedupe_dimensions:
        j = first_per_key(j, ["id_master"])
    p = population.alias("p")
    d = copies.counted_rows(demographics.where(F.col("id_master") > 0), ["id_master"]).alias("d")
    r = copies.counted_rows(j, ["id_master"]).alias("r")
    out = (
        p.join(d, F.col("p.id_master") == F.col("d.id_master"), "left")
        .join(r, F.col("p.id_master") == F.col("r.id_master"), "left")
        .select(
            F.col("p.id_master").alias("id_master"),
            F.col("p.per_ref").alias("per_ref"),
            F.col("p.mto_ing_mes").alias("mto_ing_mes"),
            F.coalesce(F.col("d.genero"), F.lit("VACIO")).alias("genero"),
            F.coalesce(F.col("d.edad"), F.lit(0)).alias("edad"),
            F.coalesce(F.col("d.entidad"), F.lit("VACIO")).alias("entidad"),
            F.coalesce(F.col("d.cod_postal"), F.lit(0)).alias("cod_postal"),
            F.coalesce(F.col("r.saldo"), F.lit(0)).alias("saldo"),
            F.coalesce(F.col("r.potencial"), F.lit(0)).alias("potencial"),
            F.coalesce(F.col("r.recorrido"), F.lit(0)).alias("recorrido"),
            (copies.times_count("d") * copies.times_count("r")).alias(copies.WEIGHT),
        )
    )
    return copies.expand(out)
