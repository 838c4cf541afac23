"""Client demographics: gender recode, age, postal code and state.

Inference uses the state *code* from the catalog ('N/A' when unknown);
training keeps the folded state *name*.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientincome.functions.periods import age_years
from clientincome.operators.sampling import first_per_key
from clientincome.semantics import REFERENCE, RunParams, Semantics
from clientincome.sources.catalog import VERACRUZ_SPELLINGS, states

# Gender codes recoded to 'X'.
GENDER_TO_X = ("N", "E")


def folded_state(lentidad: str = "lentidad") -> Column:
    s = F.trim(F.col(lentidad))
    return F.when(s.isin(*VERACRUZ_SPELLINGS), F.lit("VERACRUZ")).otherwise(s)


def recoded_gender(genero: str = "genero") -> Column:
    """'N'/'E' (after trimming) -> 'X'; other values are kept untrimmed."""
    return F.when(F.trim(F.col(genero)).isin(*GENDER_TO_X), F.lit("X")).otherwise(F.col(genero))


def _contact(contact: DataFrame, sem: Semantics) -> DataFrame:
    c = contact.select("id_master", "lentidad", "genero", "fecha_nacimiento", "cposta")
    return first_per_key(c, ["id_master"]) if sem.dedupe_dimensions else c


def inference_demographics(
    contact: DataFrame, params: RunParams, sem: Semantics = REFERENCE
) -> DataFrame:
    """(id_master, genero, edad, cod_postal, entidad) with the state code.

    The 32-row catalog is broadcast (its size is fixed), so the contact table
    is not shuffled for the lookup.
    """
    c = _contact(contact, sem).withColumn("entidad_nombre", folded_state()).alias("a")
    s = F.broadcast(states(contact.sparkSession)).alias("s")
    return c.join(s, F.trim(F.col("a.entidad_nombre")) == F.col("s.descripcion"), "left").select(
        F.col("a.id_master").alias("id_master"),
        recoded_gender("a.genero").alias("genero"),
        age_years(params.mes, "a.fecha_nacimiento").alias("edad"),
        F.col("a.cposta").alias("cod_postal"),
        F.coalesce(F.col("s.clave"), F.lit("N/A")).alias("entidad"),
    )


def training_demographics(
    contact: DataFrame, params: RunParams, sem: Semantics = REFERENCE
) -> DataFrame:
    """(id_master, edad, genero, cod_postal, entidad) with the state name."""
    c = _contact(contact, sem)
    return c.select(
        "id_master",
        age_years(params.mes, "fecha_nacimiento").alias("edad"),
        recoded_gender().alias("genero"),
        F.col("cposta").alias("cod_postal"),
        folded_state().alias("entidad"),
    )


def state_counts(contact: DataFrame, params: RunParams, sem: Semantics = REFERENCE) -> DataFrame:
    """Clients per state code through the catalog lookup (catalog in use)."""
    d = inference_demographics(contact, params, sem)
    return d.groupBy("entidad").agg(F.count(F.lit(1)).alias("clientes"))
