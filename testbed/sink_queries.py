"""Sinks: what is written to the shared folder must come back whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aprisco.plans.build import BuildFailed, build, refresh
from aprisco.plans.models import FACTS, MODELS, SNAPSHOTS, Warehouse
from aprisco.plans.suite import ENTITY, SUITE, staging_checks
from aprisco.quality import Check, run_checks, unique
from aprisco.quality.runner import ERROR, WARN
from aprisco.sources import (
    RawZone,
    append_failures,
    read_fact,
    register_view,
    replicate,
    run_snapshot,
    write_fact,
    write_table,
)
from aprisco.sources.buckets import run_bucketed_snapshot
from aprisco.sources.parts import manifest, read_refreshed_fact, refresh_fact
from aprisco.sources.schemas import RAW_TABLES, raw_table
from aprisco.sources.shared import cut_lineage, new_path
from testbed.farm_raw import raw_sql, raw_zone
from testbed.model_queries import RAW_NOW, RUNS, _rule_sql, relations_sql, warehouse, with_relations


def _fact(name: str, granularity: str) -> Callable[[SparkSession, str], DataFrame]:
    """A fact written by its business date, and read back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        model, path = MODELS[name], new_path(spark)
        rows = warehouse(spark, sf_dir)[name]
        write_fact(rows, path, model.partition_date, model.cluster_by, granularity)
        return read_fact(spark, path, model.partition_date, schema=rows.schema)

    return run


def _interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of a fact along a curve through farm and animal, with a bloom filter on its id."""
    model, path = MODELS["fct_tratamiento"], new_path(spark)
    rows = warehouse(spark, sf_dir)["fct_tratamiento"]
    write_fact(
        rows, path, model.partition_date, model.cluster_by, "month", interleave=True, bloom_filters=[rows.columns[0]]
    )
    return read_fact(spark, path, model.partition_date, schema=rows.schema)


def _dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_table(warehouse(spark, sf_dir)["dim_medicina"], new_path(spark))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs against a stored history, the second reading what the first wrote."""
    w, path, spec = warehouse(spark, sf_dir), new_path(spark), SNAPSHOTS["snapshot_animal"]
    for copy, run_ts in zip(w.copies("snapshot_animal"), RUNS, strict=True):
        history = run_snapshot(copy, path, spec.unique_key, spec.check_cols, run_ts)
    return history


def _replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark)
    replicate(raw_zone(spark, sf_dir), root, ["pesaje_leche"])
    return RawZone.from_path(spark, root).table("pesaje_leche")


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a failed check leaves behind: lines that share an order and a number."""
    path = new_path(spark)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    failing = unique(lines, "l_orderkey", "l_linenumber")
    append_failures(failing, path, "unique_lineitem", RUNS[0])
    return spark.read.parquet(f"{path}/unique_lineitem").drop("run_ts")


def _through_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging model and a dimension, registered as views and read back by SQL."""
    w = warehouse(spark, sf_dir)
    register_view(w["stg_pesaje_leche"], "vista_pesaje")
    register_view(w["dim_finca"], "vista_finca")
    return spark.sql(
        "SELECT g.nombre_finca, p.ordeno, count(*) AS n FROM vista_pesaje p "
        "JOIN vista_finca g ON g.id_finca = p.id_finca GROUP BY 1, 2"
    )


#: Rules on the raw columns of the given tables, of both severities; some are broken.
RULES = (
    Check("unique", "lineitem", ("l_orderkey",), WARN),
    Check("not_null", "orders", ("o_orderkey",), ERROR),
    Check("accepted_values", "orders", ("o_orderstatus",), ERROR, values=("F", "O")),
    Check("accepted_values", "lineitem", ("l_linestatus",), WARN, values=("F", "O")),
    Check("relationships", "orders", ("o_custkey",), ERROR, parent="customer", field="c_custkey"),
)


def _severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of checks of either severity, as a build stores them."""
    verdicts = run_checks(RULES, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
    rows = [
        F.struct(
            F.lit(v.check_id).alias("check_id"), F.lit(v.severity).alias("severity"),
            F.lit(v.failures).cast("long").alias("failures"), F.lit(v.status).alias("status"),
        )
        for v in verdicts
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _bucketed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two runs against a history in buckets of its key."""
    w, path, spec = warehouse(spark, sf_dir), new_path(spark), SNAPSHOTS["snapshot_animal"]
    for copy, run_ts in zip(w.copies("snapshot_animal"), RUNS, strict=True):
        history = run_bucketed_snapshot(copy, path, spec.unique_key, spec.check_cols, run_ts, buckets=16)
    return history


# Before the second refresh of a fact one day's measures were corrected, and another day went.
CORRECTED_DAY, LOST_DAY = 7, 9


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[str, str, DataFrame]:
    model, path = MODELS["fct_pesaje"], new_path(spark)
    rows, day = warehouse(spark, sf_dir)["fct_pesaje"], F.dayofmonth(MODELS["fct_pesaje"].partition_date)
    litres = F.when(day == CORRECTED_DAY, F.col("litros") + 1).otherwise(F.col("litros")).cast("decimal(38,9)")
    for version in (rows, rows.withColumn("litros", litres).where(day != LOST_DAY)):
        refresh_fact(version, path, model.partition_date, model.cluster_by)
    return path, model.partition_date, rows


def _refreshed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, day, rows = _refreshed(spark, sf_dir)
    return read_refreshed_fact(spark, path, day, rows.schema)


def _refreshed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which refresh wrote each day that the fact has now."""
    path, _, _ = _refreshed(spark, sf_dir)
    rows = [
        F.struct(F.lit(day).alias("day"), F.lit(n).cast("long").alias("n"), F.lit(part).cast("long").alias("refresh"))
        for day, (n, _, part) in manifest(spark, path).items()
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


# --- the layered refresh ---------------------------------------------------------------------

REPORT_SUMS = {
    "rpt_transacciones_financieras_recientes": "monto_total",
    "rpt_entregas_leche_recientes": "valor_entrega_neta",
    "rpt_movimientos_insumo_recientes": "cantidad_base",
    "rpt_pesaje_resumen_diario": "litros_totales_dia",
}
#: How a raw table names its farm, and the key that this is
FARM_KEYS = {"finca_asociada": "nombre_finca", "id_finca": "id_finca"}
REFRESHED = [name for name, m in MODELS.items() if m.layer in ("snapshots", "marts", "reporting")]
#: Checks of severity error in a build of all domains
CHECKS = {"raw": len(RAW_TABLES), **{layer: len(rules()) for layer, rules in SUITE.items()}}
CHECKS["marts"] += 1  # balances against the ledger


def _referring(rows: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """The rows whose reference is known. References are told apart before they meet the known keys, and
    the unknown ones are stored, so that only where these are many are whole rows shuffled to be told."""
    unknown = cut_lineage(rows.where(F.col(column).isNotNull()).select(column).distinct().join(known, column, "left_anti"))
    return rows.where(F.col(column).isNotNull()).join(unknown, column, "left_anti").select(rows.columns)


def _sound_zone(spark: SparkSession, sf_dir: str) -> RawZone:
    """The raw tables without what breaks a check: rows of unknown farms, facts outside the calendar,
    of unknown animals or supplies or without their measure, and balances other than the sum of the
    movements."""
    zone = raw_zone(spark, sf_dir)
    dates = {raw_table(source).table: (source, date) for _, source, date, _ in FACTS}

    def of_farms(table: str) -> DataFrame:
        rows = zone.table(table)
        for column, key in FARM_KEYS.items():
            if table != "tb_dim_fincas" and column in raw_table(table).columns:
                farms = zone.table("fincas").select(F.col(key).alias(column))
                return rows.join(farms, column, "left_semi").select(rows.columns)
        return rows

    def load(table: str) -> DataFrame:
        rows = of_farms(table)
        if table == "tb_dim_catalogo_insumos":
            moved = Warehouse(spark, sound, RUNS[1])["stg_movimientos_insumos"]
            sums = moved.groupBy("id_insumo").agg(F.sum("cantidad_base").alias("__sum"))
            balance = F.coalesce("__sum", "existencia_actual").cast("decimal(38,9)")
            return rows.join(sums, "id_insumo", "left").withColumn("existencia_actual", balance).select(rows.columns)
        if table not in dates:
            return rows
        source, date = dates[table]
        rows = rows.where(F.col(date).between("2020-01-01", "2035-12-31"))
        if source == "pesaje_leche":
            rows = rows.where("litros IS NOT NULL")
        if source in ENTITY:
            column, parent, _, key = ENTITY[source]
            known = of_farms(raw_table(parent).table).select(F.col(key).alias(column))
            rows = _referring(rows, column, known)
        return rows

    sound = RawZone(load)
    return sound


def _refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refresh of all domains from a live source, replica, checks, histories, as-of join and
    all: how many rows each relation has, what the reports sum up to, and the checks that passed."""
    root = new_path(spark)
    run = refresh(
        spark, _sound_zone(spark, sf_dir), f"{root}/raw", f"{root}/warehouse", RUNS[1], now=RAW_NOW,
        granularity="month", changed_only=True, history_buckets=8, limit_seconds=3600,
    )
    total = lambda name: F.sum(REPORT_SUMS[name]) if name in REPORT_SUMS else F.lit(None)
    relations = [
        run.warehouse[name].agg(F.count(F.lit(1)).alias("n"), total(name).cast("decimal(38,4)").alias("total")).select(
            F.lit(name).alias("name"), "n", "total"
        )
        for name in REFRESHED
    ]
    kept = [
        spark.read.parquet(f"{root}/warehouse/metadata/verdicts/{layer}")
        .where("severity = 'error' AND status = 'pass'")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(f"checks of {layer}").alias("name"), "n", F.lit(None).cast("decimal(38,4)").alias("total"))
        for layer in CHECKS
    ]
    return reduce(DataFrame.union, [*relations, *kept])


def _refresh_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the tables as they are: the build stops at the first layer that breaks a
    check, and its verdicts are kept."""
    root, zone = new_path(spark), raw_zone(spark, sf_dir)
    try:
        build(spark, zone, root, RUNS[1], live=zone)
    except BuildFailed:
        layers = [spark.read.parquet(f"{root}/metadata/verdicts/{x}").withColumn("layer", F.lit(x)) for x in ("raw", "staging")]
        return reduce(DataFrame.unionByName, layers).select("layer", "check_id", "severity", "failures", "status")
    raise AssertionError("an unsound source was built")


def _sound_sql() -> dict[str, str]:
    """Relations over the sound raw tables, their histories after one run."""
    relations, raw = relations_sql(), raw_sql()
    for t in RAW_TABLES:
        for column, key in FARM_KEYS.items():
            if t.name != "fincas" and column in t.columns:
                raw[t.table] = f"SELECT * FROM ({raw[t.table]}) WHERE {column} IN (SELECT {key} FROM tb_dim_fincas)"
                break
    relations.update(raw)
    entities = {
        "animales": "SELECT id_animal FROM tb_dim_animales",
        "catalogo_insumos": f"SELECT id_insumo FROM ({raw['tb_dim_catalogo_insumos']})",
    }
    for _, source, date, _ in FACTS:
        table = raw_table(source).table
        tests = [f"{date} BETWEEN DATE '2020-01-01' AND DATE '2035-12-31'"]
        if source == "pesaje_leche":
            tests.append("litros IS NOT NULL")
        if source in ENTITY:
            tests.append(f"{ENTITY[source][0]} IN ({entities[ENTITY[source][1]]})")
        relations[table] = f"SELECT * FROM ({raw[table]}) WHERE {' AND '.join(tests)}"
    relations["tb_dim_catalogo_insumos"] = (
        "SELECT * REPLACE (CAST(coalesce((SELECT sum(cantidad_base) FROM stg_movimientos_insumos m "
        "WHERE m.id_insumo = c.id_insumo), existencia_actual) AS DECIMAL(38,9)) AS existencia_actual) "
        f"FROM ({raw['tb_dim_catalogo_insumos']}) c"
    )
    for name, spec in SNAPSHOTS.items():
        relations[name] = (
            f"SELECT *, {spec.unique_key} AS dbt_scd_id, TIMESTAMP '{RUNS[1]}' AS dbt_valid_from, "
            f"CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM {spec.source}"
        )
    return relations


def _refresh_sql() -> str:
    total = lambda name: f"sum({REPORT_SUMS[name]})" if name in REPORT_SUMS else "NULL"
    parts = [
        f"SELECT '{name}' AS name, count(*) AS n, CAST({total(name)} AS DECIMAL(38,4)) AS total FROM {name}" for name in REFRESHED
    ]
    parts += [f"SELECT 'checks of {layer}', {n}, NULL" for layer, n in CHECKS.items()]
    return with_relations(" UNION ALL ".join(parts), _sound_sql())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "fact_by_day": _fact("fct_pesaje", "day"),
        "fact_by_month": _fact("fct_tratamiento", "month"),
        "fact_interleaved": _interleaved,
        "stored_dimension": _dimension,
        "stored_history": _history,
        "stored_failures": _failures,
        "replica_load": _replica,
        "registered_view": _through_view,
        "severity_verdicts": _severities,
        "bucketed_history": _bucketed_history,
        "refreshed_fact": _refreshed_fact,
        "refreshed_days": _refreshed_days,
        "layered_refresh": _refresh,
        "refresh_verdicts": _refresh_verdicts,
    }


def _verdict_sql(rule: Check) -> str:
    broken = "warn" if rule.severity == WARN else "fail"
    return (
        f"SELECT check_id, '{rule.severity}' AS severity, failures::BIGINT AS failures, "
        f"CASE WHEN failures = 0 THEN 'pass' ELSE '{broken}' END AS status FROM ({_rule_sql(rule)})"
    )


def oracle_sql() -> dict[str, str]:
    relations = relations_sql()
    return {
        "fact_by_day": with_relations("SELECT * FROM fct_pesaje", relations),
        "fact_by_month": with_relations("SELECT * FROM fct_tratamiento", relations),
        "fact_interleaved": with_relations("SELECT * FROM fct_tratamiento", relations),
        "stored_dimension": with_relations("SELECT * FROM dim_medicina", relations),
        "stored_history": with_relations("SELECT * FROM snapshot_animal", relations),
        "stored_failures": (
            "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem "
            "GROUP BY 1, 2 HAVING count(*) > 1"
        ),
        "replica_load": raw_sql()["tb_fact_pesaje_leche"],
        "registered_view": with_relations(
            "SELECT g.nombre_finca, p.ordeno, count(*) AS n FROM stg_pesaje_leche p "
            "JOIN dim_finca g ON g.id_finca = p.id_finca GROUP BY 1, 2",
            relations,
        ),
        "severity_verdicts": " UNION ALL ".join(_verdict_sql(r) for r in RULES),
        "bucketed_history": with_relations("SELECT * FROM snapshot_animal", relations),
        "refreshed_fact": with_relations(
            f"SELECT * REPLACE (CAST(CASE WHEN day(fecha_pesaje) = {CORRECTED_DAY} THEN litros + 1 ELSE litros END "
            f"AS DECIMAL(38,9)) AS litros) FROM fct_pesaje WHERE day(fecha_pesaje) <> {LOST_DAY}",
            relations,
        ),
        "refreshed_days": with_relations(
            "SELECT CAST(fecha_pesaje AS VARCHAR) AS day, count(*) AS n, "
            f"CASE WHEN day(fecha_pesaje) = {CORRECTED_DAY} THEN 2 ELSE 1 END::BIGINT AS refresh "
            f"FROM fct_pesaje WHERE day(fecha_pesaje) <> {LOST_DAY} GROUP BY fecha_pesaje",
            relations,
        ),
        "layered_refresh": _refresh_sql(),
        "refresh_verdicts": " UNION ALL ".join(
            f"SELECT 'raw' AS layer, 'conteo_raw_vs_operacional_{t.table}' AS check_id, 'error' AS severity, "
            "0::BIGINT AS failures, 'pass' AS status"
            for t in RAW_TABLES
        )
        + " UNION ALL SELECT 'staging' AS layer, * FROM ("
        + with_relations(" UNION ALL ".join(_verdict_sql(r) for r in staging_checks()), relations)
        + ")",
    }
