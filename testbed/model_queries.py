"""One query per warehouse model, over raw tables derived from the given ones."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aprisco.functions import register_functions
from aprisco.operators import check_snapshot
from aprisco.plans.models import MODELS, SNAPSHOTS, Warehouse, present
from aprisco.plans.suite import mart_checks, report_checks, staging_checks
from aprisco.quality import (
    Check,
    column_metrics,
    count_reconciliation,
    daily_loads,
    freshness,
    freshness_metrics,
    ledger_reconciliation,
    merged_profile,
    refresh_sketches,
    score_anomalies,
    stored_sketches,
    volume_metrics,
    watch,
)
from aprisco.quality.runner import ROW_KINDS, count_failures
from aprisco.quality.sketches import DISTINCT_ERROR
from aprisco.sources.raw import CAST_LATER, WRITES_AT_A_TIME
from aprisco.sources.schemas import RawTable, raw_table
from aprisco.sources.shared import cut_lineage, new_path
from testbed.farm_raw import raw_sql, raw_zone

# Two snapshot runs. The first sees what had been created by then; before the second, one farm
# was closed and two others changed a tracked column of all they own.
RUNS = (datetime(2022, 6, 1, 6, 30), datetime(2024, 1, 1))
CHANGED = {
    "snapshot_animal": "lote",
    "snapshot_lote": "nombre",
    "snapshot_insumo": "categoria",
}
CREATED_BEFORE = {
    "snapshot_animal": "2023-10-01",
    "snapshot_lote": "2023-12-01",
    "snapshot_insumo": "2023-02-10",
}
CLOSED_FARM = "Supplier#000000009"
CHANGING_FARMS = ("Supplier#000000003", "Supplier#000000006")


class TwoRunWarehouse(Warehouse):
    """Warehouse whose histories have been through two snapshot runs."""

    def __getitem__(self, name: str) -> DataFrame:
        if name in SNAPSHOTS and name not in self.stored:
            self.stored[name] = self._two_runs(name)
        return super().__getitem__(name)

    def _two_runs(self, name: str) -> DataFrame:
        spec, history = SNAPSHOTS[name], None
        for copy, run_ts in zip(self.copies(name), RUNS, strict=True):
            history = check_snapshot(history, copy, spec.unique_key, spec.check_cols, run_ts)
        return history

    def copies(self, name: str) -> tuple[DataFrame, DataFrame]:
        """The source of a snapshot as either run finds it."""
        column = CHANGED[name]
        source, farm = self[SNAPSHOTS[name].source], F.col("finca_asociada")
        first = source.where(F.col("fecha_creacion") < F.lit(CREATED_BEFORE[name]).cast("date"))
        second = source.where(farm != CLOSED_FARM).withColumn(
            column,
            F.when(farm.isin(*CHANGING_FARMS), F.concat(column, F.lit(" B"))).otherwise(
                F.col(column)
            ),
        )
        return first, second


def warehouse(spark: SparkSession, sf_dir: str) -> TwoRunWarehouse:
    return TwoRunWarehouse(spark, raw_zone(spark, sf_dir), RUNS[1])


# The calendar alone reads no table; the reports join it.
REGISTERED = [name for name in MODELS if name != "dim_fecha"]


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: warehouse(spark, sf_dir)[name]


# Reports in their reading order: newest day first, and by ear tag.
PRESENTED = {
    "presented_newest_first": "rpt_nacimientos_recientes",
    "presented_by_tag": "rpt_animales_activos",
}


def _presented(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: present(warehouse(spark, sf_dir)[name], name)


def _supply_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return ledger_reconciliation(
        w["stg_catalogo_insumos"], w["fct_movimiento_insumo"],
        key="id_insumo", balance="existencia_actual", amount="cantidad_base", keep=["nombre"],
    )


def _mart_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of the marts as a build makes them: row by row while each mart is written, the
    others on what is stored."""
    w, rules = warehouse(spark, sf_dir), mart_checks()
    for name in SNAPSHOTS:
        w.stored[name] = cut_lineage(w[name])
    names = list(dict.fromkeys(t for r in rules for t in (r.table, r.parent) if t))
    plans = {name: w[name] for name in names}

    def store(name: str) -> tuple[DataFrame, dict[str, int]]:
        rows, count = watch(plans[name], rules, name)
        return cut_lineage(rows), count()

    with ThreadPoolExecutor(WRITES_AT_A_TIME) as pool:
        stored = dict(zip(names, pool.map(inheritable_thread_target(spark)(store), names)))
    counts = [
        F.struct(F.lit(check).alias("check_id"), F.lit(n).cast("long").alias("failures"))
        for _, found in stored.values()
        for check, n in found.items()
    ]
    others = count_failures([r for r in rules if r.kind not in ROW_KINDS], lambda name: stored[name][0])
    return others.unionByName(spark.range(1).select(F.inline(F.array(*counts))))


def _by_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two staging models written in SQL."""
    register_functions(spark)
    zone = raw_zone(spark, sf_dir)
    return spark.sql(
        "SELECT id_registro, repara_texto(resultado) AS resultado FROM {palpations} "
        "WHERE es_registro_valido(estado_registro) AND no_es_prueba(finca_asociada) UNION ALL "
        "SELECT id_registro, tipo_transaccion FROM {transactions} "
        "WHERE es_registro_valido(estado_registro) AND no_es_id_excluido(id_finca)",
        palpations=zone.table("palpamientos"), transactions=zone.table("transacciones_financieras"),
    )


# What a refresh would have stored before the checks of marts and reports read it many times.
STORED_FIRST = (*SNAPSHOTS, "fct_movimiento_insumo")


def _suite(
    rules: Callable[[], list[Check]], stored: tuple[str, ...] = ()
) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        w = warehouse(spark, sf_dir)
        for name in stored:
            w.stored[name] = cut_lineage(w[name])
        relation = lambda name: w.source(name) if name.startswith("tb_") else w[name]
        return count_failures(rules(), relation, one_scan=True)

    return run


# --- checks of the raw tables ---------------------------------------------------------------

RAW_NOW = datetime(2024, 2, 5)
WATCHED = [raw_table(name) for name in raw_sql()]
#: Columns of the raw tables whose schema is not declared
UNDECLARED = {
    "tb_dim_roles": "id_rol string, fecha_creacion date",
    "tb_dim_usuarios": "id_usuario string, fecha_creacion date",
    "tb_dim_catalogo_categorias_insumos": "id_item string, fecha_creacion date",
    "tb_dim_catalogo_unidades_insumos": "id_item string, fecha_creacion date",
    "tb_fact_periodos_consumo_insumos": (
        "id_registro string, id_usuario string, canal_captura string, estado_registro string, "
        "id_registro_correccion string, timestamp_registro timestamp_ntz"
    ),
    "tb_fact_logs_actividad": "id_registro string, estado_registro string, timestamp_evento timestamp_ntz",
}


def _columns(table: RawTable) -> list[tuple[str, str]]:
    if table.schema is not None:
        # What staging casts arrives as text
        return [(f.name, "string" if f.name in CAST_LATER else f.dataType.simpleString()) for f in table.schema]
    return [tuple(c.split(" ")) for c in UNDECLARED[table.table].split(", ")]


def _loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = raw_zone(spark, sf_dir)
    return reduce(
        DataFrame.union,
        [daily_loads(zone.table(t.name), t.table, t.loaded_at) for t in WATCHED],
    )


def _raw_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = raw_zone(spark, sf_dir)
    return freshness(
        {t.table: (zone.table(t.name), t.loaded_at, t.freshness_days) for t in WATCHED}, RAW_NOW
    )


def _raw_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replica that lost the void rows of every fact."""
    live = raw_zone(spark, sf_dir)
    replica = {
        t.table: live.table(t.name).where("estado_registro <> 'Anulado'")
        if t.is_fact
        else live.table(t.name)
        for t in WATCHED
    }
    return count_reconciliation({t.table: (replica[t.table], live.table(t.name)) for t in WATCHED})


def _raw_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [t.table for t in WATCHED]
    return score_anomalies(volume_metrics(_loads(spark, sf_dir), RAW_NOW.date(), tables))


def _raw_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_anomalies(freshness_metrics(_loads(spark, sf_dir), RAW_NOW))


def _exact_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of all raw tables, stored, as each table is a plan of its own."""
    zone = raw_zone(spark, sf_dir)

    def profile(table: RawTable) -> DataFrame:
        return cut_lineage(column_metrics(zone.table(table.name), table.table, run_date=RAW_NOW.date(), exact=True))

    for table in WATCHED:
        zone.table(table.name)
    with ThreadPoolExecutor(WRITES_AT_A_TIME) as pool:
        return reduce(DataFrame.union, pool.map(inheritable_thread_target(spark)(profile), WATCHED))


def _sketched_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from stored sketches, of facts in two loads, the first without the void rows. The
    estimates of distinct values are held to the exact ones by their stated error."""
    zone = raw_zone(spark, sf_dir)

    def sketch(table: RawTable) -> DataFrame:
        rows, path = zone.table(table.name), new_path(spark)
        if table.is_fact:
            refresh_sketches(rows.where("estado_registro <> 'Anulado'"), table.table, table.loaded_at, path)
        refresh_sketches(rows, table.table, table.loaded_at, path)
        return stored_sketches(spark, path)

    for table in WATCHED:
        zone.table(table.name)
    with ThreadPoolExecutor(WRITES_AT_A_TIME) as pool:
        sketches = reduce(DataFrame.union, pool.map(inheritable_thread_target(spark)(sketch), WATCHED))
    exact = _exact_profile(spark, sf_dir).where("metrica = 'distinct_count'").select("tabla", "columna", F.col("valor").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.col("exact") * DISTINCT_ERROR + 1
    return merged_profile(sketches).join(exact, ["tabla", "columna"]).select(
        "tabla", "columna", "n", "null_count", "min_value", "max_value", near.alias("distinct_is_near")
    )


RAW_CHECKS = {
    "raw_freshness": _raw_freshness,
    "raw_reconciliation": _raw_reconciliation,
    "raw_volume_anomalies": _raw_volume,
    "raw_freshness_anomalies": _raw_gaps,
    "raw_column_profile": _exact_profile,
    "raw_profile_sketched": _sketched_profile,
}


SUITES = {
    "suite_staging": staging_checks,
    "suite_marts": mart_checks,
    "suite_reporting": report_checks,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **{name: _model(name) for name in REGISTERED},
        **{name: _presented(report) for name, report in PRESENTED.items()},
        "exactitud_existencia_insumo_vs_ledger": _supply_ledger,
        **RAW_CHECKS,
        "suite_staging": _suite(SUITES["suite_staging"]),
        "suite_marts": _mart_suite,
        "sql_functions": _by_sql_functions,
        "suite_reporting": _suite(SUITES["suite_reporting"], STORED_FIRST),
    }


# --- reference SQL -------------------------------------------------------------------------

def _stg(name: str) -> str:
    raw = raw_table(name)
    columns = ", ".join(raw.columns)
    broken = {"palpamientos": "resultado", "pesaje_leche": "ordeno"}.get(name)
    if broken:
        fixed = (
            f"replace(replace(replace(replace(replace({broken}, 'Ã±', 'ñ'), "
            "concat('Ã', chr(173)), 'í'), 'Ã³', 'ó'), 'Ã©', 'é'), 'Ã¡', 'á')"
        )
        columns = columns.replace(broken, f"{fixed} AS {broken}", 1)
    if name == "animales":
        columns = columns.replace(
            "fecha_nacimiento", "CAST(fecha_nacimiento AS DATE) AS fecha_nacimiento"
        )
    tests = []
    if raw.is_fact:
        tests.append("estado_registro = 'Activo'")
    if "finca_asociada" in raw.columns:
        tests.append("finca_asociada NOT LIKE 'TEST-%'")
    elif raw.is_fact:
        tests.append(
            "id_finca NOT IN ('finca_trebol', 'test-verificacion-venta-leche-finanzas')"
        )
    where = f" WHERE {' AND '.join(tests)}" if tests else ""
    return f"SELECT {columns} FROM {raw.table}{where}"


def _snapshot_sql(name: str) -> str:
    """Two runs written out: which keys each run saw and whether a tracked value moved."""
    spec, column = SNAPSHOTS[name], CHANGED[name]
    key = spec.unique_key
    rest = [c for c in raw_table(spec.source.removeprefix("stg_")).columns if c != column]
    first, second = (f"TIMESTAMP '{r}'" for r in RUNS)

    def row(value: str, start: str, end: str) -> str:
        stamp = f"strftime({start}, '%Y-%m-%d %H:%M:%S.%f')"
        return (
            f"SELECT {', '.join(rest)}, {value} AS {column}, "
            f"md5(concat({key}, '|', {stamp})) AS dbt_scd_id, "
            f"{start} AS dbt_valid_from, {end} AS dbt_valid_to FROM {spec.source} "
        )

    farms = ", ".join(f"'{f}'" for f in CHANGING_FARMS)
    value = f"CASE WHEN finca_asociada IN ({farms}) THEN concat({column}, ' B') ELSE {column} END"
    moved = f"finca_asociada IN ({farms}) AND {column} IS NOT NULL"
    seen_first = f"fecha_creacion < DATE '{CREATED_BEFORE[name]}'"
    still_open = "CAST(NULL AS TIMESTAMP)"
    # concat skips NULLs in DuckDB, so a NULL is kept apart.
    return (
        row(column, first, f"CASE WHEN {moved} THEN {second} END") + f"WHERE {seen_first} UNION ALL "
        + row(value, second, still_open) + f"WHERE {seen_first} AND {moved} UNION ALL "
        + row(f"CASE WHEN {column} IS NOT NULL THEN {value} END", second, still_open)
        + f"WHERE NOT ({seen_first}) AND finca_asociada <> '{CLOSED_FARM}'"
    )


def calendar_sql(start: str, end_exclusive: str) -> str:
    months = [
        "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
        "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
    ]
    days = ["Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado"]
    pick = lambda expr, names: (
        f"CASE {expr} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names, 1)) + " END"
    )
    weekday = "(CAST(dayofweek(d) AS INT) + 1)"
    return (
        "SELECT d AS fecha, CAST(NULL AS VARCHAR) AS ciclo_productivo, CAST(year(d) AS INT) AS anio, "
        "CAST(month(d) AS INT) AS mes, CAST(day(d) AS INT) AS dia, "
        f"CAST(quarter(d) AS INT) AS trimestre, {weekday} AS dia_semana_numero, "
        f"{weekday} IN (1, 7) AS es_fin_de_semana, {pick('month(d)', months)} AS mes_nombre, "
        f"{pick(weekday, days)} AS dia_semana_nombre, "
        "CASE WHEN month(d) BETWEEN 5 AND 11 THEN 'Lluviosa' ELSE 'Seca' END AS estacion "
        f"FROM (SELECT CAST(unnest(generate_series(DATE '{start}', DATE '{end_exclusive}' "
        "- INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d)"
    )


def _asof_sql() -> str:
    chosen = {
        "nombre": "insumo_nombre",
        "unidad_base": "insumo_unidad_base",
        "categoria": "insumo_categoria_al_momento",
        "presentacion": "insumo_presentacion_al_momento",
        "estado": "insumo_estado_al_momento",
    }
    # Whole candidate rows are ranked: a valid version first, then the oldest.
    shown = ", ".join(f"v.{c} AS {a}" for c, a in chosen.items())
    return (
        "SELECT * EXCLUDE (rn) FROM (SELECT m.*, " + shown + ", row_number() OVER ("
        "PARTITION BY m.id_registro ORDER BY CASE WHEN v.dbt_valid_from <= m.fecha_movimiento "
        "AND (v.dbt_valid_to IS NULL OR v.dbt_valid_to > m.fecha_movimiento) THEN 1 ELSE 2 END, "
        "v.dbt_valid_from NULLS FIRST, v.dbt_scd_id NULLS FIRST) AS rn "
        "FROM stg_movimientos_insumos m LEFT JOIN snapshot_insumo v ON v.id_insumo = m.id_insumo) "
        "WHERE rn = 1"
    )


def _star(fact: str, date: str, farm: str, columns: str) -> str:
    dim_key = "id_finca" if farm == "id_finca" else "nombre_finca"
    return (
        f"SELECT f.{date}, d.dia_semana_nombre, d.estacion, g.nombre_finca, {columns} "
        f"FROM {fact} f, dim_finca g, dim_fecha d WHERE f.{farm} = g.{dim_key} AND f.{date} = d.fecha"
    )


def relations_sql() -> dict[str, str]:
    """Every relation of the warehouse as SQL over the relations below it."""
    r = dict(raw_sql())
    staged = [n.removeprefix("stg_") for n, m in MODELS.items() if m.layer == "staging"]
    r.update({f"stg_{name}": _stg(name) for name in staged})
    r.update({name: _snapshot_sql(name) for name in SNAPSHOTS})
    r["int_movimientos_insumos_con_insumo_historico"] = _asof_sql()
    r["dim_fecha"] = calendar_sql("2020-01-01", "2036-01-01")
    r["dim_finca"] = "SELECT id_finca, nombre_finca, ubicacion, estado FROM stg_fincas"
    r["dim_catalogo_finanzas"] = (
        "SELECT id_item, tipo_transaccion, categoria, clase_gasto, estado, finca_asociada "
        "FROM stg_catalogo_finanzas"
    )
    for dim, source, key, shown in (
        ("dim_categoria_animal", "catalogo_categorias_animal", "id_item", "id_categoria_animal"),
        ("dim_motivo_salida", "catalogo_motivos_salida", "id_motivo", "id_motivo"),
        ("dim_medicina", "catalogo_medicinas", "id_medicina", "id_medicina"),
        ("dim_motivo_tratamiento", "catalogo_motivos_tratamiento", "id_motivo", "id_motivo"),
        ("dim_veterinario", "catalogo_veterinarios", "id_veterinario", "id_veterinario"),
    ):
        r[dim] = f"SELECT {key} AS {shown}, nombre, estado, finca_asociada FROM stg_{source}"
    validity = (
        "dbt_valid_from AS vigente_desde, dbt_valid_to AS vigente_hasta, "
        "dbt_valid_to IS NULL AS vigente"
    )
    r["dim_animal"] = (
        "SELECT dbt_scd_id AS sk_animal, id_animal, arete, chip, sexo, fecha_nacimiento, "
        "id_madre, id_padre, padre_tipo, foto_url, lote, categoria_animal, estado, "
        f"finca_asociada, {validity} FROM snapshot_animal"
    )
    r["dim_lote"] = (
        "SELECT dbt_scd_id AS sk_lote, id_item AS id_lote, nombre, estado, finca_asociada, "
        f"{validity} FROM snapshot_lote"
    )
    r["dim_insumo"] = (
        "SELECT dbt_scd_id AS sk_insumo, id_insumo, nombre, unidad_base, maneja_vencimiento, "
        f"categoria, presentacion, estado, finca_asociada, {validity} FROM snapshot_insumo"
    )
    for fact, source in (
        ("fct_transaccion_financiera", "stg_transacciones_financieras"),
        ("fct_venta_leche", "stg_venta_leche"),
        ("fct_microbiologia_leche", "stg_microbiologia_leche"),
        ("fct_composicion_leche", "stg_composicion_leche"),
        ("fct_parto", "stg_partos"),
        ("fct_salida", "stg_salidas"),
        ("fct_palpamiento", "stg_palpamientos"),
        ("fct_tratamiento", "stg_tratamientos"),
        ("fct_pesaje", "stg_pesaje_leche"),
        ("fct_movimiento_insumo", "int_movimientos_insumos_con_insumo_historico"),
    ):
        r[fact] = f"SELECT * EXCLUDE (estado_registro, id_registro_correccion) FROM {source}"

    r["rpt_transacciones_financieras_recientes"] = _star(
        "fct_transaccion_financiera", "fecha_transaccion", "id_finca",
        "tipo_transaccion, categoria, clase, monto_total, proveedor_tercero, detalle_movimiento",
    )
    r["rpt_entregas_leche_recientes"] = _star(
        "fct_venta_leche", "fecha_pago", "id_finca",
        "litros_entrega, valor_entrega_bruta, multa, valor_entrega_neta, valor_litro_total",
    )
    r["rpt_nacimientos_recientes"] = _star(
        "fct_parto", "fecha_parto", "finca_asociada",
        "arete_madre, sexo_cria, arete_cria, chip_cria, observaciones",
    )
    r["rpt_salidas_recientes"] = _star(
        "fct_salida", "fecha_salida", "finca_asociada", "arete_animal, motivo, observaciones"
    )
    r["rpt_palpamientos_recientes"] = _star(
        "fct_palpamiento", "fecha_palpamiento", "finca_asociada",
        "arete_animal, resultado, dias_gestacion, fecha_parto_esperada, estado_gestacion, "
        "meses_atraso, veterinario",
    )
    r["rpt_tratamientos_recientes"] = _star(
        "fct_tratamiento", "fecha_tratamiento", "finca_asociada",
        "arete_animal, motivo, medicina, cantidad, unidad, dias_retiro, veterinario",
    )
    r["rpt_movimientos_insumo_recientes"] = _star(
        "fct_movimiento_insumo", "fecha_movimiento", "finca_asociada",
        "insumo_nombre, insumo_categoria_al_momento AS categoria, insumo_unidad_base AS unidad, "
        "tipo_movimiento, cantidad_base, costo_total, proveedor, numero_lote, fecha_vencimiento, "
        "motivo",
    )
    r["rpt_animales_activos"] = (
        "SELECT a.id_animal, a.arete, a.chip, a.sexo, a.fecha_nacimiento, a.lote, "
        "a.categoria_animal, g.nombre_finca FROM dim_animal a, dim_finca g "
        "WHERE a.finca_asociada = g.nombre_finca AND a.vigente AND a.estado = 'Activo'"
    )
    measured = (
        "microbiologia_muestra, composicion_grasa, composicion_proteina, composicion_lactosa, "
        "composicion_st, composicion_sng, celulas_somaticas"
    )
    r["rpt_calidad_leche_reciente"] = (
        f"SELECT g.nombre_finca, {measured}, q.fecha_muestra, q.id_finca FROM "
        "(SELECT * FROM fct_microbiologia_leche FULL JOIN fct_composicion_leche "
        "USING (fecha_muestra, id_finca)) q, dim_finca g WHERE q.id_finca = g.id_finca"
    )
    r["rpt_pesaje_resumen_diario"] = (
        "SELECT g.nombre_finca, f.fecha_pesaje, f.arete_animal, "
        "sum(f.litros) AS litros_totales_dia, count(*) AS cantidad_ordenos "
        "FROM fct_pesaje f, dim_finca g WHERE f.finca_asociada = g.nombre_finca GROUP BY ALL"
    )
    r["exactitud_existencia_insumo_vs_ledger"] = (
        "SELECT id_insumo, nombre, existencia_actual, suma_ledger, "
        "CAST(round(existencia_actual - suma_ledger, 4) AS DECIMAL(38,4)) AS diferencia FROM "
        "(SELECT c.id_insumo, any_value(c.nombre) AS nombre, "
        "any_value(c.existencia_actual) AS existencia_actual, sum(m.cantidad_base) AS suma_ledger "
        "FROM stg_catalogo_insumos c JOIN fct_movimiento_insumo m ON m.id_insumo = c.id_insumo "
        "GROUP BY c.id_insumo) WHERE round(existencia_actual - suma_ledger, 4) <> 0"
    )
    return r


def scored_sql(series: str) -> str:
    """Scores over a relation ``series`` of (tabla, metrica, columna, bucket, valor)."""
    return f"""
WITH {series},
w AS (SELECT *, count(valor) OVER h AS n_puntos, avg(valor) OVER h AS m, stddev_samp(valor) OVER h
  AS s, min(valor) OVER h AS low, max(valor) OVER h AS top FROM series WINDOW h AS (PARTITION BY tabla, metrica, columna ORDER BY bucket
  ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
SELECT tabla, metrica, columna, bucket, valor, n_puntos, round(m, 6) AS media,
  round(s, 6) AS desviacion, round(CASE WHEN low < top AND s > 0 THEN (valor - m) / s END, 6) + 0.0 AS z,
  CASE WHEN n_puntos < 7 THEN 'insufficient_history'
       WHEN low = top AND valor <> top THEN 'anomaly'
       WHEN low < top AND s > 0 AND abs((valor - m) / s) > 3 THEN 'anomaly' ELSE 'ok' END AS veredicto FROM w"""


def volume_sql(table: str, stamp: str, until: str | None = None) -> str:
    """Rows per day of a table, with zeros for the days without any."""
    last = f"CAST(max({stamp}) AS DATE)"
    start, end = f"CAST(min({stamp}) AS DATE)", last
    if until:
        # Without any row there is one day, and nothing on it.
        start, end = f"coalesce({start}, DATE '{until}')", f"greatest({last}, DATE '{until}')"
    return f"""SELECT '{table}' AS tabla, 'row_count' AS metrica, CAST(NULL AS VARCHAR) AS columna,
  CAST(d AS DATE) AS bucket, CAST(coalesce(n, 0) AS DOUBLE) AS valor
  FROM (SELECT unnest(generate_series({start}, {end}, INTERVAL 1 DAY)) AS d FROM {table})
  LEFT JOIN (SELECT CAST({stamp} AS DATE) AS b, count(*) AS n FROM {table} GROUP BY 1) ON b = d"""


def gap_sql(table: str, stamp: str, now: str) -> str:
    """Seconds between the last loads of days that have any, and from the last one until now."""
    return f"""SELECT '{table}' AS tabla, 'seconds_since_previous_load' AS metrica,
  CAST(NULL AS VARCHAR) AS columna, bucket, CAST(greatest(us, silence) // 1000000 AS DOUBLE) AS valor
  FROM (SELECT bucket, epoch_us(t) - lag(epoch_us(t)) OVER (ORDER BY bucket) AS us,
    CASE WHEN bucket = DATE '{now[:10]}' THEN epoch_us(TIMESTAMP '{now}') - epoch_us(t) END AS silence
    FROM (SELECT CAST({stamp} AS DATE) AS bucket, max(CAST({stamp} AS TIMESTAMP)) AS t FROM {table}
      WHERE {stamp} IS NOT NULL GROUP BY 1
      UNION ALL SELECT DATE '{now[:10]}', TIMESTAMP '{now}' FROM {table}
      HAVING CAST(max({stamp}) AS DATE) < DATE '{now[:10]}'))
  WHERE greatest(us, silence) IS NOT NULL"""


def _raw_check_sql(relations: dict[str, str]) -> dict[str, str]:
    ages = " UNION ALL ".join(
        f"SELECT '{t.table}' AS tabla, CAST(max({t.loaded_at}) AS TIMESTAMP) AS max_loaded_at, "
        f"CASE WHEN count({t.loaded_at}) = 0 THEN 'not_computable' WHEN max({t.loaded_at}) + INTERVAL {t.freshness_days[1]} DAY < TIMESTAMP '{RAW_NOW}' "
        f"THEN 'error' WHEN max({t.loaded_at}) + INTERVAL {t.freshness_days[0]} DAY < "
        f"TIMESTAMP '{RAW_NOW}' THEN 'warn' ELSE 'pass' END AS status FROM {t.table}"
        for t in WATCHED
    )
    lost = " UNION ALL ".join(
        f"SELECT '{t.table}' AS tabla, a AS conteo_raw, b AS conteo_operacional, a - b AS diferencia "
        f"FROM (SELECT count(*) FILTER (estado_registro <> 'Anulado') AS a, count(*) AS b "
        f"FROM {t.table}) WHERE a <> b"
        for t in WATCHED
        if t.is_fact
    )
    volumes = " UNION ALL ".join(
        volume_sql(t.table, t.loaded_at, str(RAW_NOW.date())) for t in WATCHED
    )
    gaps = " UNION ALL ".join(gap_sql(t.table, t.loaded_at, str(RAW_NOW)) for t in WATCHED)
    profiled, ranges = [], []
    for t in WATCHED:
        for c, kind in _columns(t):
            suffix, measured = {
                "string": ("_length", f"length({c})"),
                "date": ("", f"({c} - DATE '1970-01-01')"),
                "timestamp_ntz": ("", f"epoch_us({c})"),
                "boolean": ("", f"CAST({c} AS INT)"),
            }.get(kind, ("", c))
            profiled += [
                f"SELECT '{t.table}' AS tabla, '{m}' AS metrica, '{c}' AS columna, "
                f"DATE '{RAW_NOW.date()}' AS bucket, CAST({value} AS DOUBLE) AS valor FROM {t.table}"
                for m, value in (
                    ("null_count", f"count(*) FILTER ({c} IS NULL)"),
                    ("distinct_count", f"count(DISTINCT {c})"),
                    (f"min{suffix}", f"min({measured})"),
                    (f"max{suffix}", f"max({measured})"),
                )
            ]
            ranges.append(
                f"SELECT '{t.table}' AS tabla, '{c}' AS columna, count(*) AS n, count(*) FILTER ({c} IS NULL) AS null_count, "
                f"CAST(min({measured}) AS DOUBLE) AS min_value, CAST(max({measured}) AS DOUBLE) AS max_value, "
                f"true AS distinct_is_near FROM {t.table} HAVING count(*) > 0"
            )
    profiled, ranges = " UNION ALL ".join(profiled), " UNION ALL ".join(ranges)
    raw = {t.table: relations[t.table] for t in WATCHED}
    scored = scored_sql(f"series AS ({volumes})").replace("WITH ", "", 1)
    ctes = ", ".join(f"{name} AS MATERIALIZED ({query})" for name, query in raw.items())
    return {
        "raw_freshness": with_relations(ages, raw),
        "raw_reconciliation": with_relations(lost, raw),
        "raw_volume_anomalies": f"WITH {ctes}, {scored}",
        "raw_freshness_anomalies": f"WITH {ctes}, "
        + scored_sql(f"series AS ({gaps})").replace("WITH ", "", 1),
        "raw_column_profile": f"SELECT * FROM ({with_relations(profiled, raw)}) WHERE valor IS NOT NULL",
        "raw_profile_sketched": with_relations(ranges, raw),
    }


def _rule_sql(rule: Check) -> str:
    column = rule.columns[0]
    if rule.kind == "unique":
        count = (
            f"(SELECT count(*) FROM (SELECT {column} FROM {rule.table} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1))"
        )
    elif rule.kind == "not_null":
        count = f"(SELECT count(*) FROM {rule.table} WHERE {column} IS NULL)"
    elif rule.kind == "accepted_values":
        known = ", ".join(f"'{v}'" for v in rule.values)
        count = f"(SELECT count(*) FROM {rule.table} WHERE {column} NOT IN ({known}))"
    else:
        count = (
            f"(SELECT count(*) FROM {rule.table} WHERE {column} IS NOT NULL AND {column} NOT IN "
            f"(SELECT {rule.field} FROM {rule.parent} WHERE {rule.field} IS NOT NULL))"
        )
    return f"SELECT '{rule.id}' AS check_id, {count} AS failures"


def with_relations(final: str, relations: dict[str, str]) -> str:
    """Prefix a query with the relations it needs, directly or through others."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name in dict.fromkeys(re.findall(r"[a-z_]+", sql)):
            if name in relations and name not in order:
                need(relations[name])
                order.append(name)

    need(final)
    # Raw and staged relations serve many readers of a query and are computed once.
    ctes = ", ".join(f"{n} AS MATERIALIZED ({relations[n]})" for n in order)
    return f"WITH {ctes} {final}" if ctes else final


def oracle_sql() -> dict[str, str]:
    relations = relations_sql()
    names = [*REGISTERED, "exactitud_existencia_insumo_vs_ledger"]
    sql = {n: with_relations(relations[n], {k: v for k, v in relations.items() if k != n}) for n in names}
    sql.update({name: sql[report] for name, report in PRESENTED.items()})
    sql.update(_raw_check_sql(relations))
    sql["sql_functions"] = with_relations(
        "SELECT id_registro, resultado FROM stg_palpamientos UNION ALL "
        "SELECT id_registro, tipo_transaccion FROM stg_transacciones_financieras",
        relations,
    )
    for name, rules in SUITES.items():
        union = " UNION ALL ".join(_rule_sql(r) for r in rules())
        sql[name] = with_relations(union, relations)
    return sql
