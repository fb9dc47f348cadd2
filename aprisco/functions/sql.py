"""The column expressions of the staging layer as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from aprisco.functions.columns import EXCLUDED_FARM_IDS, MOJIBAKE, MOJIBAKE_LEAD, TEST_NAME_PREFIX, VALID_STATUS


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def register_functions(spark: SparkSession) -> list[str]:
    """Define the functions in the session, so that SQL can use them by name; returns the names."""
    repaired = "texto"
    for wrong, right in MOJIBAKE:
        repaired = f"replace({repaired}, {_text(wrong)}, {_text(right)})"
    ids = ", ".join(map(_text, EXCLUDED_FARM_IDS))
    definitions = {
        "es_registro_valido(estado STRING) RETURNS BOOLEAN": f"estado = {_text(VALID_STATUS)}",
        "no_es_prueba(nombre STRING) RETURNS BOOLEAN": f"NOT startswith(nombre, {_text(TEST_NAME_PREFIX)})",
        "no_es_id_excluido(id STRING) RETURNS BOOLEAN": f"id NOT IN ({ids})",
        "repara_texto(texto STRING) RETURNS STRING": f"CASE WHEN contains(texto, {_text(MOJIBAKE_LEAD)}) THEN {repaired} ELSE texto END",
    }
    for head, body in definitions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in definitions]
