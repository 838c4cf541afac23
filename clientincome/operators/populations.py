"""Client populations for the reference month.

- ``training_population``: payroll clients with positive income (one row each).
- ``deposit_population``: active natural-person deposit clients, full-joined
  with the clients that have a direct-income record.
- ``transfer_population``: clients active in remittances or express money.
- ``fx_population``: clients active in currency exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientincome.operators.sampling import first_per_key, one_per_key
from clientincome.semantics import REFERENCE, RunParams, Semantics


def natural_persons(contact: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """Contact rows of natural persons (``tipo_persona = 'FI'``)."""
    fi = contact.select("id_master", "tipo_persona").where(F.col("tipo_persona") == "FI")
    return first_per_key(fi, ["id_master"]) if sem.dedupe_dimensions else fi


def training_population(
    income: DataFrame,
    contact: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """Payroll clients of the month, one row per client (id, per_ref, income).

    The original left-joins natural persons and then samples one row per
    client.  A left join only repeats a client's rows, and the sample keeps one
    of identical copies, so under REFERENCE the join cannot change the result
    and is not run.  CORRECTED restricts to natural persons with a semi join.
    """
    ingresos = (
        income.select(
            "id_master",
            F.col("num_periodo_mes").alias("per_ref"),
            "mto_ing_mes",
            "cod_flujo",
        )
        .where(
            (F.col("per_ref") == params.mes)
            & (F.col("cod_flujo") == "NOMINA")
            & (F.col("id_master") > 0)
            & (F.col("mto_ing_mes") > 0)
        )
        .dropna(how="any")
        .drop("cod_flujo")
    )
    if sem.training_natural_persons_only:
        fi = natural_persons(contact, sem).dropna(how="any").select("id_master")
        ingresos = ingresos.join(fi, "id_master", "left_semi")
    return one_per_key(ingresos, ["id_master"], ["per_ref", "mto_ing_mes"], seed=params.seed)


def deposit_population(
    deposit_hist: DataFrame,
    income: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """(id_master, per_ref, ind_activo_cap, ind_activo_cre, ind_activo_afr).

    Each client-month's products are ranked by (active desc, balance desc);
    rank-1 rows survive if active and natural person (ties keep every tied
    row, Q10; the rank runs before the type filter, Q11).  The month and id
    predicates run below the rank and reach the scan; the rank-1 filter
    becomes a WindowGroupLimit that also trims rows map-side before the
    shuffle.
    """
    # The original ranks within (client, month) and then keeps the reference
    # month.  The month predicate is on a partition key, so it runs first; the
    # remaining rows all share that month and ranking by client alone is the
    # same ranking.  The rank's shuffle on the client then also serves the
    # full join below (one exchange fewer).
    w = Window.partitionBy("id_master").orderBy(
        F.col("ind_activo_cap").desc(), F.col("sld_tot_prod_cap").desc()
    )
    cap = (
        deposit_hist.where(
            (F.col("num_periodo_mes") == params.mes)
            & F.col("id_master").isNotNull()
            & (F.col("id_master") > 0)
        )
        .withColumn("prio", F.dense_rank().over(w))
        .where(
            (F.col("prio") == 1)
            & (F.col("ind_activo_cap") == 1)
            & (F.col("cod_tipo_persona") == "PF")
        )
        .select("id_master", "ind_activo_cap", "num_periodo_mes")
    )
    if sem.distinct_deposit_population:
        cap = cap.distinct()

    ren = income.where(
        (F.col("num_periodo_mes") == params.mes) & (F.col("id_master") > 0)
    ).select(
        "id_master",
        "num_periodo_mes",
        F.coalesce(F.col("ind_cre"), F.lit(0)).alias("ind_activo_cre"),
        F.coalesce(F.col("ind_afr"), F.lit(0)).cast("int").alias("ind_activo_afr"),
    )
    if sem.dedupe_dimensions:
        ren = ren.groupBy("id_master", "num_periodo_mes").agg(
            F.max("ind_activo_cre").alias("ind_activo_cre"),
            F.max("ind_activo_afr").alias("ind_activo_afr"),
        )

    a, b = cap.alias("a"), ren.alias("b")
    return a.join(b, F.col("a.id_master") == F.col("b.id_master"), "full").select(
        F.coalesce("a.id_master", "b.id_master").alias("id_master"),
        F.coalesce("a.num_periodo_mes", "b.num_periodo_mes").alias("per_ref"),
        F.coalesce("a.ind_activo_cap", F.lit(0)).alias("ind_activo_cap"),
        F.coalesce("b.ind_activo_cre", F.lit(0)).alias("ind_activo_cre"),
        F.coalesce("b.ind_activo_afr", F.lit(0)).alias("ind_activo_afr"),
    )


def _service_population(hist, contact, params, sem, active, keep):
    """History rows of the month joined to natural persons.

    The original writes a left join followed by a filter on the contact side,
    which is an inner join; duplicate contact keys repeat clients (Q12) unless
    the dimension is deduplicated.
    """
    h = hist.where(
        (F.col("num_periodo_mes") == params.mes)
        & F.col("id_master").isNotNull()
        & (F.col("id_master") > 0)
        & active
    )
    fi = natural_persons(contact, sem).select("id_master")
    return h.join(fi, "id_master", "inner").select(
        "id_master", F.col("num_periodo_mes").alias("per_ref"), *keep
    )


def transfer_population(hist, contact, params: RunParams, sem: Semantics = REFERENCE):
    """(id_master, per_ref, ind_activo_rem, ind_activo_dex) of active clients."""
    if sem.fill_null_measures:
        active = (
            F.coalesce(F.col("ind_activo_rem"), F.lit(0))
            + F.coalesce(F.col("ind_activo_dex"), F.lit(0))
        ) > 0
    else:
        active = (F.col("ind_activo_rem") + F.col("ind_activo_dex")) > 0
    return _service_population(
        hist, contact, params, sem, active, ["ind_activo_rem", "ind_activo_dex"]
    )


def fx_population(hist, contact, params: RunParams, sem: Semantics = REFERENCE):
    """(id_master, per_ref[, ind_activo_div]) of currency-active clients."""
    keep = ["ind_activo_div"] if sem.fx_flag_from_population else []
    return _service_population(
        hist, contact, params, sem, F.col("ind_activo_div") == 1, keep
    )


# ---------------------------------------------------------------------------
# Counted forms.  The row forms above repeat a client once per copy (rank
# ties, repeated contact or history keys), as the original does.  The feature
# pipeline needs the same multiplicities but must not carry the copies: a
# client whose copies are a third of a table would otherwise reach one task
# whole.  The counted forms hold one row per client with ``n`` = number of
# copies, built only from partial-combining aggregates.


def deposit_population_counted(
    deposit_hist: DataFrame,
    income: DataFrame,
    params: RunParams,
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """(id_master, per_ref, ind_activo_cap, ind_activo_cre, ind_activo_afr, n).

    Same clients, flags and copy counts as ``deposit_population``: the rank-1
    products are found with two aggregates instead of a window (products
    grouped by (client, active, balance) counting natural persons, then the
    client's largest (active, balance) and its count), so tied products are
    counted, not carried.
    """
    key = F.struct("ind_activo_cap", "sld_tot_prod_cap")
    products = (
        deposit_hist.where(
            (F.col("num_periodo_mes") == params.mes)
            & F.col("id_master").isNotNull()
            & (F.col("id_master") > 0)
        )
        .groupBy("id_master", "ind_activo_cap", "sld_tot_prod_cap")
        .agg(
            F.sum(F.when(F.col("cod_tipo_persona") == "PF", 1).otherwise(0)).alias("n_pf"),
            F.max("num_periodo_mes").alias("num_periodo_mes"),
        )
    )
    top = products.groupBy("id_master").agg(
        F.max(key).alias("top"),
        F.max_by("n_pf", key).alias("n_pf"),
        F.max("num_periodo_mes").alias("num_periodo_mes"),
    )
    cap = top.where((F.col("top.ind_activo_cap") == 1) & (F.col("n_pf") > 0)).select(
        "id_master",
        F.col("top.ind_activo_cap").alias("ind_activo_cap"),
        "num_periodo_mes",
        (F.lit(1) if sem.distinct_deposit_population else F.col("n_pf")).cast("bigint").alias("n_cap"),
    )
    ren = (
        income.where((F.col("num_periodo_mes") == params.mes) & (F.col("id_master") > 0))
        .groupBy("id_master")
        .agg(
            F.max("num_periodo_mes").alias("num_periodo_mes"),
            F.max(F.coalesce(F.col("ind_cre"), F.lit(0))).alias("ind_activo_cre"),
            F.max(F.coalesce(F.col("ind_afr"), F.lit(0)).cast("int")).alias("ind_activo_afr"),
            (F.lit(1) if sem.dedupe_dimensions else F.count(F.lit(1))).cast("bigint").alias("n_ren"),
        )
    )
    a, b = cap.alias("a"), ren.alias("b")
    return a.join(b, F.col("a.id_master") == F.col("b.id_master"), "full").select(
        F.coalesce("a.id_master", "b.id_master").alias("id_master"),
        F.coalesce("a.num_periodo_mes", "b.num_periodo_mes").alias("per_ref"),
        F.coalesce("a.ind_activo_cap", F.lit(0)).alias("ind_activo_cap"),
        F.coalesce("b.ind_activo_cre", F.lit(0)).alias("ind_activo_cre"),
        F.coalesce("b.ind_activo_afr", F.lit(0)).alias("ind_activo_afr"),
        (F.coalesce("a.n_cap", F.lit(1)) * F.coalesce("b.n_ren", F.lit(1))).alias("n"),
    )


def _service_population_counted(hist, contact, params, sem, active, flags):
    """(id_master, per_ref, n, <flag sums>): history rows of the month x
    natural-person contact rows, counted.  Both sides are reduced to one row
    per key (with its copy count) before the join, so nothing fans out."""
    h = hist.where(
        (F.col("num_periodo_mes") == params.mes)
        & F.col("id_master").isNotNull()
        & (F.col("id_master") > 0)
        & active
    )
    fcols = [
        (F.coalesce(F.col(f), F.lit(0)) if sem.fill_null_measures else F.col(f)).alias(f) for f in flags
    ]
    # per client: history rows of the month and their flag sums; every contact
    # copy repeats all of them, so the join multiplies by the contact count
    h = h.select("id_master", "num_periodo_mes", *fcols).groupBy("id_master").agg(
        F.count(F.lit(1)).alias("h_n"),
        F.max("num_periodo_mes").alias("per_ref"),
        *[F.sum(f).alias(f) for f in flags],
    )
    fi = natural_persons(contact, sem).groupBy("id_master").agg(F.count(F.lit(1)).alias("c_n"))
    return h.join(fi, "id_master", "inner").select(
        "id_master",
        "per_ref",
        (F.col("h_n") * F.col("c_n")).alias("n"),
        *[(F.col(f) * F.col("c_n")).alias(f) for f in flags],
    )


def transfer_population_counted(hist, contact, params: RunParams, sem: Semantics = REFERENCE):
    if sem.fill_null_measures:
        active = (
            F.coalesce(F.col("ind_activo_rem"), F.lit(0))
            + F.coalesce(F.col("ind_activo_dex"), F.lit(0))
        ) > 0
    else:
        active = (F.col("ind_activo_rem") + F.col("ind_activo_dex")) > 0
    return _service_population_counted(
        hist, contact, params, sem, active, ["ind_activo_rem", "ind_activo_dex"]
    )


def fx_population_counted(hist, contact, params: RunParams, sem: Semantics = REFERENCE):
    flags = ["ind_activo_div"] if sem.fx_flag_from_population else []
    return _service_population_counted(
        hist, contact, params, sem, F.col("ind_activo_div") == 1, flags
    )


def counted(population: DataFrame, flag_sums=(), flag_maxes=()) -> DataFrame:
    """A row-form population in counted form (one row per client)."""
    if "n" in population.columns:
        return population
    return population.groupBy("id_master").agg(
        F.max("per_ref").alias("per_ref"),
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f).alias(f) for f in flag_sums if f in population.columns],
        *[F.max(f).alias(f) for f in flag_maxes if f in population.columns],
    )
