"""Declared schemas of the engine's canonical inputs, and readers for them.

CSV inputs are read with these schemas instead of ``inferSchema``: inference
costs an extra scan per file and its types drift with the data (a postal code
column that holds one non-numeric value turns into a string).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientincome.sources import io
from clientincome.sources.fixtures import CHANNELS, Inputs

MONEY = T.DecimalType(28, 2)


def _fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


def _account_fields():
    out = [("id_master", T.LongType()), ("num_cuenta", T.IntegerType()), ("num_periodo_mes", T.IntegerType())]
    for direction in ("dep", "ret"):
        for channel in CHANNELS:
            out += [(f"mto_{direction}_{channel}", MONEY), (f"num_{direction}_{channel}", T.IntegerType())]
    return out


SCHEMAS: dict[str, T.StructType] = {
    "contact": _fields(
        ("id_master", T.LongType()), ("tipo_persona", T.StringType()), ("lentidad", T.StringType()),
        ("genero", T.StringType()), ("fecha_nacimiento", T.DateType()), ("cposta", T.IntegerType()),
    ),
    "account_hist": _fields(*_account_fields()),
    "deposit_hist": _fields(
        ("id_master", T.LongType()), ("num_periodo_mes", T.IntegerType()), ("ind_activo_cap", T.IntegerType()),
        ("sld_tot_prod_cap", MONEY), ("cod_tipo_persona", T.StringType()),
    ),
    "transfer_hist": _fields(
        ("id_master", T.LongType()), ("num_periodo_mes", T.IntegerType()),
        ("ind_activo_rem", T.IntegerType()), ("ind_activo_dex", T.IntegerType()),
        ("mto_pag_rem", MONEY), ("num_pag_rem", T.LongType()), ("mto_env_rem", MONEY), ("num_env_rem", T.LongType()),
        ("mto_pag_dex", MONEY), ("num_pag_dex", T.LongType()), ("mto_env_dex", MONEY), ("num_env_dex", T.LongType()),
    ),
    "fx_hist": _fields(
        ("id_master", T.LongType()), ("num_periodo_mes", T.IntegerType()), ("ind_activo_div", T.IntegerType()),
        ("mto_div_cpa", MONEY), ("num_div_cpa", T.LongType()), ("mto_div_vta", MONEY), ("num_div_vta", T.LongType()),
    ),
    "income": _fields(
        ("id_master", T.LongType()), ("num_periodo_mes", T.IntegerType()), ("mto_ing_mes", MONEY),
        ("cod_flujo", T.StringType()), ("num_flujos", T.IntegerType()), ("cod_tipo_nomina", T.StringType()),
        ("cod_tipo_nomina_detalle", T.StringType()), ("ind_cre_ov", T.IntegerType()),
        ("cod_estabilidad_mto", T.StringType()), ("cod_estabilidad_periodidad", T.StringType()),
        ("ind_cre", T.IntegerType()), ("ind_afr", T.IntegerType()),
    ),
    "journey": _fields(
        ("id_master", T.LongType()), ("num_periodo_mes", T.IntegerType()), ("cod_perfil_trx", T.StringType()),
        ("saldo", MONEY), ("potencial", MONEY), ("recorrido", T.LongType()),
    ),
    "calendar": _fields(("fecha", T.DateType()), ("num_periodo_mes", T.IntegerType())),
    "census": _fields(
        ("nivel", T.StringType()), ("cod_postal", T.IntegerType()), ("familias", T.LongType()),
        ("ingreso_familiar", MONEY), ("poblacion", T.LongType()), ("pei", T.LongType()),
    ),
}


def read_inputs_csv(spark: SparkSession, paths: Mapping[str, str]) -> Inputs:
    """All nine inputs from CSV files/folders (header row) with the declared
    schemas.  ``paths`` maps each input name to its location."""
    frames = {
        name: read_census_csv(spark, paths[name]) if name == "census" else io.read_csv(spark, paths[name], schema)
        for name, schema in SCHEMAS.items()
    }
    return Inputs(**frames)


# Headers of the published census file and the names used here.
CENSUS_HEADERS = {
    "Nivel": "nivel",
    "Código Postal": "cod_postal",
    "Familias": "familias",
    "Ingreso familiar promedio $": "ingreso_familiar",
    "Población 2019": "poblacion",
    "Población Económicamente Inactiva (PEI)": "pei",
}


def read_census_csv(spark: SparkSession, path: str) -> DataFrame:
    """The census from CSV, under its published headers or the names used here."""
    schema = SCHEMAS["census"]
    if "Código Postal" not in spark.read.option("header", True).csv(path).columns:
        return io.read_csv(spark, path, schema)
    published = {ours: theirs for theirs, ours in CENSUS_HEADERS.items()}
    named = T.StructType([T.StructField(published[f.name], f.dataType) for f in schema.fields])
    return io.read_csv(spark, path, named).withColumnsRenamed(CENSUS_HEADERS)


def read_inputs_parquet(spark: SparkSession, paths: Mapping[str, str]) -> Inputs:
    """All nine inputs from parquet (the columnar default at scale)."""
    return _declared({name: spark.read.parquet(paths[name]) for name in SCHEMAS})


def read_inputs_table(spark: SparkSession, names: Mapping[str, str]) -> Inputs:
    """All nine inputs from tables of the catalog."""
    return _declared({name: io.read_table(spark, names[name]) for name in SCHEMAS})


def _declared(frames: Mapping[str, DataFrame]) -> Inputs:
    """The declared columns, cast to the declared types so every source gives the same plan."""
    return Inputs(**{
        name: df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])
        for name, df in frames.items()
    })


# the inputs that grow month by month
HISTORIES = ("account_hist", "transfer_hist", "fx_hist")


def write_inputs(
    inputs: Inputs, root: str, fmt: str = "parquet", parallel: bool = True, window: tuple[int, int] | None = None
) -> dict[str, str]:
    """Materialise every input under ``root`` (e.g. to stage extracts).

    ``window``: first and last month; of the histories those months alone are
    copied.  Histories are partitioned by month, so a later read of some months
    opens their folders only.

    The nine writes are independent jobs; with ``parallel`` they are
    submitted together from threads and share the executors.
    """
    paths = {name: f"{root.rstrip('/')}/{name}" for name in SCHEMAS}

    def write(name: str) -> None:
        df = getattr(inputs, name)
        if window and name in HISTORIES:
            df = df.where(F.col("num_periodo_mes").between(*window))
        w = df.write.mode("overwrite")
        if fmt == "parquet" and name in HISTORIES:
            w = w.partitionBy("num_periodo_mes")
        if fmt == "csv":
            w.option("header", True).csv(paths[name])
        else:
            w.parquet(paths[name])

    if parallel:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=len(SCHEMAS)) as pool:
            list(pool.map(write, SCHEMAS))
    else:
        for name in SCHEMAS:
            write(name)
    return paths


def stage_inputs(inputs: Inputs, root: str, window: tuple[int, int] | None = None) -> Inputs:
    """Write every input once under ``root`` (a folder in the shared
    checkpoint location) and return the inputs read back with the declared
    types: the extract step the pipeline starts from."""
    spark = inputs.contact.sparkSession
    return read_inputs_parquet(spark, write_inputs(inputs, root, window=window))
