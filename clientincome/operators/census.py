"""Census income by postal code, the adjustment factor and its use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientincome.functions.numeric import dbl, ieee_div
from clientincome.operators.quantiles import exact_quantiles
from clientincome.operators.sampling import first_per_key
from clientincome.semantics import REFERENCE, Semantics

# Census level holding postal-code rows, and the default postal
# codes that carry no location.
POSTAL_LEVEL = "Código postal"
DEFAULT_POSTAL = 99999


def census_income(census: DataFrame, sem: Semantics = REFERENCE) -> DataFrame:
    """(cod_postal, ingreso_prom_succ): family income per earning member,
    ``ingreso / ((poblacion - pei) / familias)`` with IEEE division."""
    c = census.where(F.col("nivel") == POSTAL_LEVEL).select(
        "cod_postal",
        ieee_div(dbl("ingreso_familiar"), ieee_div(dbl("poblacion") - dbl("pei"), dbl("familias")))
        .alias("ingreso_prom_succ"),
    )
    return first_per_key(c, ["cod_postal"]) if sem.dedupe_dimensions else c


def with_census_income(
    clients: DataFrame, census: DataFrame, sem: Semantics = REFERENCE
) -> DataFrame:
    """Clients + ``ingreso_prom_succ`` by postal code (0 when unknown).

    Spark picks the join from the census side's measured bytes.  Repeated
    postal codes repeat clients (Q12) unless deduplicated.
    """
    inc = census_income(census, sem).alias("k")
    c = clients.alias("c")
    return c.join(inc, F.col("c.cod_postal") == F.col("k.cod_postal"), "left").select(
        "c.*", F.coalesce(F.col("k.ingreso_prom_succ"), F.lit(0.0)).alias("ingreso_prom_succ")
    )


def adjustment_factor(
    train_features: DataFrame, census: DataFrame, target: str = "mto_ing_mes",
    sem: Semantics = REFERENCE,
) -> DataFrame:
    """One row ``factor = median(target) / median(census income)`` over
    clients with a located postal code and positive census income (X28).

    Medians are exact and distributed (no group is collected in one task).
    """
    t = with_census_income(train_features.select(target, "cod_postal"), census, sem)
    excluded = [DEFAULT_POSTAL, 0] if sem.exclude_default_postal else [DEFAULT_POSTAL]
    t = t.where(~F.col("cod_postal").isin(*excluded) & (F.col("ingreso_prom_succ") > 0))
    # both medians in one pass: the two variables stacked as two groups
    long = t.select(
        F.explode(
            F.array(
                F.struct(F.lit("target").alias("var"), dbl(target).alias("x")),
                F.struct(F.lit("census").alias("var"), dbl("ingreso_prom_succ").alias("x")),
            )
        ).alias("s")
    ).select("s.var", "s.x")
    m = exact_quantiles(long, "x", [0.5], ["var"], names=["median"], max_groups=2)
    wide = m.agg(
        F.max(F.when(F.col("var") == "target", F.col("median"))).alias("median_target"),
        F.max(F.when(F.col("var") == "census", F.col("median"))).alias("median_census"),
    )
    return wide.select(
        "median_target",
        "median_census",
        ieee_div("median_target", "median_census").alias("factor"),
    )


def adjusted_census(scored: DataFrame, factor: DataFrame) -> DataFrame:
    """``ingreso_prom_succ * factor`` and ``ing_sdm = max(regr, census)``.

    The factor table has exactly one row, so the cross join is a broadcast.
    """
    f = F.broadcast(factor.select(F.col("factor").alias("_factor")))
    out = scored.crossJoin(f).withColumn(
        "ingreso_prom_succ", F.col("ingreso_prom_succ") * F.col("_factor")
    ).drop("_factor")
    if "regr" in out.columns:
        out = out.withColumn("ing_sdm", F.greatest(dbl("regr"), F.col("ingreso_prom_succ")))
    return out
