"""In-memory catalog of the 32 federal entities (states).

Built inside a function (no session work at import) and always small: it is
broadcast where it is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values: (id, code, name) of each state, in catalog order.  Names must
# equal the trimmed contact-table spelling for the lookup to match.
STATES = [
    (1, "AGU", "AGUASCALIENTES"),
    (2, "BCN", "BAJA CALIFORNIA"),
    (3, "BCS", "BAJA CALIFORNIA SUR"),
    (4, "CAM", "CAMPECHE"),
    (5, "CHP", "CHIAPAS"),
    (6, "CHH", "CHIHUAHUA"),
    (7, "CMX", "CIUDAD DE MEXICO"),
    (8, "COA", "COAHUILA DE ZARAGOZA"),
    (9, "COL", "COLIMA"),
    (10, "DUR", "DURANGO"),
    (11, "GUA", "GUANAJUATO"),
    (12, "GRO", "GUERRERO"),
    (13, "HID", "HIDALGO"),
    (14, "JAL", "JALISCO"),
    (15, "MEX", "MEXICO"),
    (16, "MIC", "MICHOACAN DE OCAMPO"),
    (17, "MOR", "MORELOS"),
    (18, "NAY", "NAYARIT"),
    (19, "NLE", "NUEVO LEON"),
    (20, "OAX", "OAXACA"),
    (21, "PUE", "PUEBLA"),
    (22, "QUE", "QUERETARO"),
    (23, "ROO", "QUINTANA ROO"),
    (24, "SLP", "SAN LUIS POTOSI"),
    (25, "SIN", "SINALOA"),
    (26, "SON", "SONORA"),
    (27, "TAB", "TABASCO"),
    (28, "TAM", "TAMAULIPAS"),
    (29, "TLA", "TLAXCALA"),
    (30, "VER", "VERACRUZ"),
    (31, "YUC", "YUCATAN"),
    (32, "ZAC", "ZACATECAS"),
]

# Contact-table spellings folded into the catalog name VERACRUZ.
VERACRUZ_SPELLINGS = ("VERACRUZ", "VERACRUZ DE IGNACIO DE LA LLAVE")

STATES_SCHEMA = "id INT, clave STRING, descripcion STRING"


def states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATES, STATES_SCHEMA)


def states_values_sql() -> str:
    """The catalog as a SQL VALUES list (used by the oracle)."""
    rows = ", ".join(f"({i}, '{c}', '{d}')" for i, c, d in STATES)
    return f"SELECT * FROM (VALUES {rows}) AS s(id, clave, descripcion)"
