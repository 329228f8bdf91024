"""Replacing rows by key, and the remote mirror."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType

from parcela.functions.strings import composite_key

#: How columns of extracted pages are called in their tables; patterns apply to the rest of the consumption page.
CODE = {"codigo_evaluacion": "codigo_evaluacion_energetica"}
PLACES = {"region": "region_nombre", "comuna": "comuna_nombre", "tipo_vivienda": "tipo_vivienda_nombre"}
RENAMED = {
    **CODE,
    "calefaccion_kwh_per": "calefaccion_porcentaje",
    "consumo_ep_calefaccion_kwh": "consumo_energia_primaria_calefaccion_kwh",
    "consumo_ep_agua_caliente_sanitaria_kwh": "consumo_energia_primaria_agua_caliente_sanitaria_kwh",
    "consumo_ep_iluminacion_kwh": "consumo_energia_primaria_iluminacion_kwh",
    "consumo_ep_ventiladores_kwh": "consumo_energia_primaria_ventiladores_kwh",
    "generacion_ep_fotovoltaicos_kwh": "generacion_energia_primaria_fotovoltaicos_kwh",
    "total_consumo_ep_antes_fotovoltaica_kwh": "total_consumo_energia_primaria_antes_fotovoltaica_kwh",
    "consumo_total_ep_obj_kwh": "consumo_total_energia_primaria_objeto_kwh",
    "consumo_total_ep_ref_kwh": "consumo_total_energia_primaria_referencia_kwh",
}
#: The maps of the other tables.
TABLE_NAMES = {
    "pagina1": {**CODE, "tipo_evaluacion": "tipo_evaluacion_nombre", **PLACES},
    "pagina2": {**CODE, **PLACES, "zona_termica": "zona_termica_nombre"},
    "pagina3_envolvente": {**CODE, "ua_phil": "ua_mas_phi_l", "orientacion": "orientacion_nombre"},
    "pagina4": {
        **CODE,
        "demanda_calef_viv_eval_kwh": "demanda_calefaccion_viv_eval_kwh",
        "demanda_calef_viv_ref_kwh": "demanda_calefaccion_viv_ref_kwh",
        "demanda_enfri_viv_eval_kwh": "demanda_enfriamiento_viv_eval_kwh",
        "demanda_enfri_viv_ref_kwh": "demanda_enfriamiento_viv_ref_kwh",
    },
    "pagina5": CODE,
    "pagina6": {**CODE, "temp_exterior": "temperatura_exterior", "temp_interior": "temperatura_interior"},
    "pagina7": CODE,
}
#: What names a row of each table in the mirror.
MIRROR_KEYS = {
    "pagina1": ("eval_id",),
    "pagina2": ("eval_id",),
    "pagina3_consumos": ("eval_id",),
    "pagina7": ("eval_id",),
    "pagina3_envolvente": ("eval_id", "orientacion_nombre"),
    "pagina4": ("eval_id", "mes_id"),
    "pagina5": ("eval_id", "mes_id"),
    "pagina6": ("eval_id", "mes_id", "hora"),
}
RENAMED_PARTS = (("_proy_", "_proyectado_"), ("_ref_", "_referencia_"))


def renamed(name: str, exact: Mapping[str, str] = RENAMED, parts: Sequence[tuple[str, str]] = RENAMED_PARTS) -> str:
    """A column's table name: the exact map first, else the patterns, also at a name's end.

    A last ``_per`` becomes ``_porcentaje``, so that all columns of the consumption page arrive.
    """
    if name in exact:
        return exact[name]
    out = name + "_"
    for a, b in parts:
        out = out.replace(a, b)
    out = out[:-1]
    return out[: -len("_per")] + "_porcentaje" if out.endswith("_per") else out


def table_column(table: str, name: str) -> str:
    """What a column of an extracted page is called in its table."""
    return renamed(name) if table == "pagina3_consumos" else TABLE_NAMES[table].get(name, name)


def to_schema(rows: DataFrame, columns: Sequence[str], names: Mapping[str, str] | None = None) -> DataFrame:
    """``rows`` renamed and cut down to the columns that the table has."""
    out = rows.withColumnsRenamed(names or {c: renamed(c) for c in rows.columns})
    return out.select(*[c for c in columns if c in out.columns])


def replace_by_key(table: DataFrame, rows: DataFrame, key: Sequence[str], keys: DataFrame | None = None) -> DataFrame:
    """``table`` without the rows of these keys, and with ``rows``.

    ``keys`` are those that were processed; a processed key without new rows just loses its old ones.
    By default only keys that ``rows`` has are replaced.
    """
    gone = (rows if keys is None else keys).select(*key).distinct()
    return table.join(gone, list(key), "left_anti").unionByName(rows)


def mirror_delta(rows: DataFrame, full: bool = False, limit: int | None = None, refreshed: bool = False) -> DataFrame:
    """Rows to be mirrored: never synchronised ones, all if ``full``, with ``refreshed`` also those processed since."""
    out = rows
    if not full:
        todo = F.col("synced_at").isNull()
        out = rows.where(todo | (F.col("processed_at") > F.col("synced_at")) if refreshed else todo)
    return out.orderBy("eval_id").limit(limit) if limit else out


def with_mirror_key(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
    return rows.withColumn("mirror_key", composite_key(*[F.col(p) for p in parts]))


def upsert_counts(rows: DataFrame, mirrored: DataFrame, key: str = "mirror_key") -> DataFrame:
    """How many rows a mirror upsert creates and updates; a repeated key is created once."""
    one = rows.groupBy(key).agg(F.count("*").alias("n"))
    joined = one.join(mirrored.select(F.col(key)).distinct().withColumn("__old", F.lit(True)), key, "left")
    created = F.count_if(F.col("__old").isNull())
    return joined.agg(created.alias("created"), (F.coalesce(F.sum("n"), F.lit(0)) - created).cast("bigint").alias("updated"))


def sql_type(kind: DataType) -> str:
    """The mirror's type for a column."""
    if isinstance(kind, BooleanType):
        return "TINYINT"
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return "BIGINT"
    return "DOUBLE" if isinstance(kind, (FloatType, DoubleType)) else "TEXT"


def ddl(table: str, schema: StructType, key: str = "mirror_key") -> str:
    """The statement that makes a mirror table; ``id`` is the mirror's own."""
    columns = ", ".join(f"`{f.name}` {sql_type(f.dataType)}" for f in schema if f.name not in ("id", key))
    return f"CREATE TABLE IF NOT EXISTS `{table}` (`id` BIGINT PRIMARY KEY, `{key}` TEXT" + (f", {columns}" if columns else "") + ")"


def inferred_types(values: DataFrame, column: str = "name", order: str = "row_no", kind: str = "value_type") -> DataFrame:
    """The type of each column from the types of its values, row by row.

    The first type that is not TEXT holds, whatever comes later; TEXT, and a column of nulls, stay
    TEXT. The column ``id`` is skipped. Takes one row a value; null values have a null type.
    """
    first = F.min(F.when(F.col(kind) != "TEXT", F.struct(order, kind)))
    return values.where(F.col(column) != "id").groupBy(column).agg(F.coalesce(first[kind], F.lit("TEXT")).alias("sql_type"))


def sample_row(schema: StructType) -> dict:
    """A row with a value of each column's type, for a table that has none."""
    made = {"TINYINT": True, "BIGINT": 1, "DOUBLE": 1.0, "TEXT": "text"}
    return {f.name: made[sql_type(f.dataType)] for f in schema}
