from __future__ import annotations

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aprisco.operators import check_snapshot
from aprisco.sources import (
    RawZone,
    append_failures,
    read_fact,
    read_history,
    register_view,
    replicate,
    run_snapshot,
    write_fact,
    write_table,
)
from aprisco.sources.raw import LoadFailed, SchemaDrift, check_schema
from aprisco.sources.shared import cut_lineage, shared_folder
from aprisco.sources.versions import complete_versions, expire_versions
from tests.farm import farm_rows, frame, raw_zone

FACT = "id int, farm string, day date"


def _fact(spark, *rows):
    return spark.createDataFrame(list(rows), FACT)


JAN, FEB = date(2026, 1, 5), date(2026, 2, 7)


def test_day_partitions_and_pruning(spark, tmp_path, rows):
    path = str(tmp_path / "f")
    data = [(1, "b", JAN), (2, "a", JAN), (3, "a", FEB), (4, "a", None)]
    write_fact(_fact(spark, *data), path, "day", ["farm"])
    fact = read_fact(spark, path, "day")
    assert dict(fact.dtypes)["day"] == "date"
    assert rows(fact, "id", "farm", "day") == sorted(data, key=repr)
    recent = read_fact(spark, path, "day", since=date(2026, 2, 1))
    assert rows(recent, "id") == [(3,)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert rows(read_fact(spark, path, "day", until=FEB), "id") == [(1,), (2,)]


def test_rebuild_replaces_all_and_days_only_some(spark, tmp_path, rows):
    path = str(tmp_path / "f")
    write_fact(_fact(spark, (1, "a", JAN), (2, "a", FEB)), path, "day")
    write_fact(_fact(spark, (3, "a", FEB)), path, "day", days_only=True)
    assert rows(read_fact(spark, path, "day"), "id") == [(1,), (3,)]
    write_fact(_fact(spark, (4, "a", FEB)), path, "day")
    assert rows(read_fact(spark, path, "day"), "id") == [(4,)]


def test_month_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "f")
    data = [(1, "b", JAN), (2, "a", date(2026, 1, 31)), (3, "a", FEB), (4, "a", None)]
    write_fact(_fact(spark, *data), path, "day", ["farm"], granularity="month")
    fact = read_fact(spark, path, "day")
    assert fact.columns == ["id", "farm", "day"]
    assert rows(fact) == sorted(data, key=repr)
    found = read_fact(spark, path, "day", since=date(2026, 1, 6), until=FEB)
    assert rows(found, "id") == [(2,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mes_particion" in plan
    with pytest.raises(ValueError):
        write_fact(_fact(spark), path, "day", granularity="year")


def test_days_are_written_by_few_tasks_and_a_hot_day_by_several(spark, tmp_path):
    """One file per quiet day although many tasks read the input, several for a hot day."""
    path = str(tmp_path / "f")
    df = spark.range(0, 60_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit(JAN)).otherwise(
            F.date_add(F.lit(FEB), (F.col("id") % 4).cast("int"))).alias("day"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300KB")
    try:
        write_fact(df, path, "day", ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {}
    for f in read_fact(spark, path, "day").inputFiles():
        files[f.split("day=")[1][:10]] = files.get(f.split("day=")[1][:10], 0) + 1
    assert files[str(JAN)] > 1
    assert sum(files.values()) < 8 * len(files)
    assert read_fact(spark, path, "day").count() == 60_000


def test_table_is_rebuilt_without_touching_the_old(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = write_table(spark.range(3), path)
    second = write_table(first.where("id > 0"), path)  # reads what it replaces
    assert (first.count(), second.count()) == (3, 2)
    assert len(complete_versions(spark, path)) == 2


def test_old_versions_expire_but_never_a_history(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        newest = write_table(spark.range(n), path)
    assert len(expire_versions(spark, path, keep=3)) == 1
    assert len(expire_versions(spark, path, keep=1)) == 2
    assert newest.count() == 3
    assert complete_versions(spark, path) == [f"{path}/table_version=00000004"]
    assert write_table(spark.range(9), path).count() == 9
    with pytest.raises(ValueError):
        expire_versions(spark, path, keep=0)
    history = str(tmp_path / "h")
    for run_ts in RUNS[:3]:
        run_snapshot(_copy(spark, ("a", "x", 1)), history, "id", ["state"], run_ts)
    with pytest.raises(ValueError, match="is a history"):
        expire_versions(spark, history, keep=1)


def test_view(spark):
    register_view(spark.range(4), "some_view")
    assert spark.sql("select count(*) from some_view").first()[0] == 4


def _copy(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, state string, other int")


RUNS = [datetime(2026, m, 1, 8) for m in (1, 2, 3, 4)]


def test_stored_history_equals_the_operator(spark, tmp_path, rows):
    path, history = str(tmp_path / "h"), None
    copies = [
        _copy(spark, ("a", "x", 1), ("b", "x", 1)),
        _copy(spark, ("a", "y", 2), ("c", None, 2)),
        _copy(spark, ("a", "y", 3), ("b", "x", 3), ("c", "z", 3)),
        _copy(spark, ("a", "x", 4)),
    ]
    assert read_history(spark, path) is None
    for copy, run_ts in zip(copies, RUNS, strict=True):
        history = check_snapshot(history, copy, "id", ["state"], run_ts)
        stored = run_snapshot(copy, path, "id", ["state"], run_ts)
        assert rows(stored.select(history.columns)) == rows(history)
    assert rows(read_history(spark, path)) == rows(stored)


def test_unfinished_run_is_invisible_and_is_replaced(spark, tmp_path, rows):
    path = str(tmp_path / "h")
    before = run_snapshot(_copy(spark, ("a", "x", 1)), path, "id", ["state"], RUNS[0])
    half = before.withColumn("scd_state", F.lit("open")).withColumn("state", F.lit("y"))
    half.write.partitionBy("scd_state").parquet(f"{path}/table_version=00000002")
    os.remove(f"{path}/table_version=00000002/_SUCCESS")  # as if the job had died
    assert rows(read_history(spark, path)) == rows(before)
    again = run_snapshot(_copy(spark, ("a", "z", 1)), path, "id", ["state"], RUNS[2])
    assert rows(again, "id", "state", "dbt_valid_to") == [("a", "x", RUNS[2]), ("a", "z", None)]


def test_history_of_an_empty_dimension(spark, tmp_path, rows):
    path = str(tmp_path / "h")
    assert run_snapshot(_copy(spark), path, "id", ["state"], RUNS[0]).count() == 0
    filled = run_snapshot(_copy(spark, ("a", "x", 1)), path, "id", ["state"], RUNS[1])
    assert rows(filled, "id", "dbt_valid_from") == [("a", RUNS[1])]


def test_history_gains_a_column(spark, tmp_path, rows):
    path = str(tmp_path / "h")
    run_snapshot(_copy(spark, ("a", "x", 1), ("b", "x", 1)), path, "id", ["state"], RUNS[0])
    run_snapshot(_copy(spark, ("a", "y", 1), ("b", "x", 1)), path, "id", ["state"], RUNS[1])
    wider = _copy(spark, ("b", "y", 1)).withColumn("extra", F.lit(7))
    found = run_snapshot(wider, path, "id", ["state"], RUNS[2])
    assert rows(found, "id", "state", "extra") == sorted(
        [("a", "x", None), ("a", "y", None), ("b", "x", None), ("b", "y", 7)], key=repr
    )


def test_failures_are_kept_by_run(spark, tmp_path, rows):
    path = str(tmp_path / "m")
    for run_ts, n in ((RUNS[0], 2), (RUNS[1], 3), (RUNS[1], 1)):  # the last repeats a run
        append_failures(spark.range(n), path, "some_check", run_ts)
    kept = spark.read.parquet(f"{path}/some_check").groupBy("run_ts").count()
    assert [n for _, n in sorted(map(tuple, kept.collect()))] == [2, 1]


def test_replica_is_replaced_table_by_table(spark, tmp_path):
    content = farm_rows()
    root = str(tmp_path / "raw")
    replicate(raw_zone(spark, content), root)
    replica = RawZone.from_path(spark, root)
    assert replica.table("animales").count() == 5
    content["animales"] = content["animales"][:2]
    replicate(raw_zone(spark, content), root, ["animales"])
    assert RawZone.from_path(spark, root).table("tb_dim_animales").count() == 2


def test_failed_load_raises_and_keeps_the_old_replica(spark, tmp_path):
    root = str(tmp_path / "raw")
    replicate(raw_zone(spark, farm_rows()), root, ["fincas", "partos"])
    good = raw_zone(spark, farm_rows())

    def load(table):
        if table == "tb_fact_partos":
            raise OSError("source is down")
        return good._load(table)

    with pytest.raises(LoadFailed, match="tb_fact_partos: OSError: source is down"):
        replicate(RawZone(load), root, ["partos", "fincas"])
    assert RawZone.from_path(spark, root).table("partos").count() == 2


def test_schema_drift(spark):
    sound = frame(spark, "fincas", farm_rows()["fincas"])
    assert check_schema(sound.withColumn("new", F.lit(1)), "fincas").columns[-1] == "new"
    with pytest.raises(SchemaDrift, match="ubicacion is missing"):
        check_schema(sound.drop("ubicacion"), "fincas")
    with pytest.raises(SchemaDrift, match="expected date, found string"):
        check_schema(sound.withColumn("fecha_registro", F.lit("x")), "fincas")
    with pytest.raises(SchemaDrift, match="timestamp_evento is missing"):
        check_schema(spark.range(1), "logs_actividad")
    money = frame(spark, "catalogo_insumos", []).withColumn(
        "existencia_actual", F.lit("1").cast("decimal(10,2)")
    )
    kinds = dict(check_schema(money, "catalogo_insumos").dtypes)
    assert kinds["existencia_actual"] == "decimal(38,9)"
    stamped = frame(spark, "partos", []).withColumn(
        "timestamp_registro", F.col("timestamp_registro").cast("timestamp")
    )
    assert dict(check_schema(stamped, "partos").dtypes)["timestamp_registro"] == "timestamp_ntz"


def test_history_holds_each_version_once(spark, tmp_path):
    path = str(tmp_path / "history")
    states = [("a", "b"), ("a", "b"), ("a", "c"), ("a", "c"), ("d", "c")]
    for n, (one, two) in enumerate(states):
        copy = _copy(spark, ("k", one, 1), ("l", two, 2), ("m", "same", 3))
        history = run_snapshot(copy, path, "id", ["state"], RUNS[0] + timedelta(days=n))
        on_disk = spark.read.option("recursiveFileLookup", "true").parquet(path).count()
        assert on_disk == history.count() == 3 + (n > 1) + (n > 3)


def test_lossless_widening(spark):
    palp = frame(spark, "palpamientos", [])
    for kind in ("tinyint", "smallint", "int"):
        given = palp.withColumn("dias_gestacion", F.col("dias_gestacion").cast(kind))
        assert dict(check_schema(given, "palpamientos").dtypes)["dias_gestacion"] == "bigint"
    with pytest.raises(SchemaDrift):
        check_schema(palp.withColumn("dias_gestacion", F.col("dias_gestacion").cast("double")), "palpamientos")
    insumos = frame(spark, "catalogo_insumos", [])
    for kind in ("int", "bigint", "decimal(10,2)"):
        given = insumos.withColumn("existencia_actual", F.col("existencia_actual").cast(kind))
        assert dict(check_schema(given, "catalogo_insumos").dtypes)["existencia_actual"] == "decimal(38,9)"


def test_lineage_is_cut_in_the_shared_folder(spark, rows):
    kept = cut_lineage(spark.range(3).withColumn("x", F.lit("a")))
    folder = shared_folder(spark)
    assert folder == shared_folder(spark)
    assert rows(kept) == [(0, "a"), (1, "a"), (2, "a")]
    assert all(f"{folder.removeprefix('file:')}/aprisco/" in f for f in kept.inputFiles())


def test_raw_from_a_database(spark):
    frame(spark, "roles", [{"fecha_creacion": JAN}]).createOrReplaceTempView("tb_dim_roles")
    zone = RawZone(lambda table: spark.table(table))
    assert zone.table("roles").count() == 1


@pytest.mark.parametrize(("found", "fits"), [("decimal(38,18)", False), ("decimal(38,9)", True), ("decimal(20,4)", True), ("decimal(38,4)", False)])
def test_decimals_are_taken_only_if_nothing_is_lost(spark, found, fits):
    rows = frame(spark, "catalogo_insumos", farm_rows()["catalogo_insumos"])
    rows = rows.withColumn("existencia_actual", F.lit(1).cast(found))
    if fits:
        assert dict(check_schema(rows, "catalogo_insumos").dtypes)["existencia_actual"] == "decimal(38,9)"
    else:
        with pytest.raises(SchemaDrift, match="existencia_actual"):
            check_schema(rows, "catalogo_insumos")


def test_moments_become_utc_whatever_the_sessions_zone(spark):
    rows = frame(spark, "salidas", farm_rows()["salidas"])
    rows = rows.withColumn("timestamp_registro", F.timestamp_micros(F.lit(1_750_000_000_123_456)))
    spark.conf.set("spark.sql.session.timeZone", "America/Panama")
    try:
        got = check_schema(rows, "salidas").select(F.col("timestamp_registro").cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == "2025-06-15 15:06:40.123456"


@pytest.mark.parametrize("lost", [1, 3000])
def test_known_references_are_told_without_shuffling_rows(spark, rows, lost):
    from testbed.sink_queries import _referring
    from tests.test_joins import _with

    fact = spark.range(20_000).selectExpr("cast(id as int) AS id", "if(id % 10 = 0, NULL, concat('k', id % 4000)) AS ref")
    keys = spark.range(4000 - lost).selectExpr("concat('k', id) AS ref").union(spark.createDataFrame([("k1",), (None,)], "ref string"))

    def run():
        found = _referring(fact, "ref", keys)
        return rows(found), found._jdf.queryExecution().executedPlan().toString()

    # Far too little for the keys
    found, plan = _with(spark, {"spark.sql.autoBroadcastJoinThreshold": "2000"}, run)
    assert found == sorted([(i, f"k{i % 4000}") for i in range(20_000) if i % 10 and i % 4000 < 4000 - lost], key=repr)
    if lost == 1:
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
