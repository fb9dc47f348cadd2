from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from aprisco.functions import (
    ceil_to_date,
    date_dimension,
    is_valid_row,
    not_excluded_id,
    not_test_name,
    repair_mojibake,
)
from aprisco.operators import join_calendar


def _values(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_filters_drop_null_and_mind_the_case(spark, rows):
    names = _values(spark, "TEST-1", "Test-1", "TEST", "aTEST-", None)
    assert rows(names.where(not_test_name("v"))) == [("TEST",), ("Test-1",), ("aTEST-",)]
    ids = _values(spark, "finca_trebol", "test-verificacion-venta-leche-finanzas", "f1", None)
    assert rows(ids.where(not_excluded_id("v"))) == [("f1",)]
    states = _values(spark, "Activo", "activo", "Anulado", None)
    assert rows(states.where(is_valid_row("v"))) == [("Activo",)]


def test_mojibake(spark, rows):
    broken = _values(
        spark, "PreÃ±ada", "VacÃ­a", "Ã³Ã©Ã¡",
        "sano ñíóéá", "Ãº", "Ã", None,
    )
    assert rows(broken.select(repair_mojibake("v"))) == sorted(
        [("Preñada",), ("Vacía",), ("óéá",), ("sano ñíóéá",), ("Ãº",), ("Ã",), (None,)],
        key=repr,
    )


def test_ceil_to_date(spark, rows):
    stamps = _values(spark, "2026-01-01 00:00:00", "2026-01-01 00:00:00.000001", None)
    assert rows(stamps.select(ceil_to_date(F.col("v").cast("timestamp_ntz")))) == sorted(
        [(date(2026, 1, 1),), (date(2026, 1, 2),), (None,)], key=repr
    )


def test_calendar(spark):
    calendar = date_dimension(spark)
    assert calendar.columns == [
        "fecha", "ciclo_productivo", "anio", "mes", "dia", "trimestre", "dia_semana_numero",
        "es_fin_de_semana", "mes_nombre", "dia_semana_nombre", "estacion",
    ]
    assert calendar.count() == 5844
    days = {r["fecha"]: r for r in calendar.collect()}
    assert (min(days), max(days)) == (date(2020, 1, 1), date(2035, 12, 31))
    sunday = days[date(2026, 3, 1)]
    assert tuple(sunday)[1:] == (None, 2026, 3, 1, 1, 1, True, "Marzo", "Domingo", "Seca")
    assert days[date(2026, 5, 6)]["dia_semana_nombre"] == "Miércoles"
    seasons = {m: days[date(2026, m, 1)]["estacion"] for m in range(1, 13)}
    assert [m for m, s in seasons.items() if s == "Seca"] == [1, 2, 3, 4, 12]


def test_calendar_has_any_length_and_its_true_size(spark):
    with pytest.raises(ValueError):
        date_dimension(spark, date(2020, 1, 1), date(2020, 1, 1))
    long = date_dimension(spark, date(1, 1, 1), date(2020, 1, 1))
    assert long.count() == (date(2020, 1, 1) - date(1, 1, 1)).days
    size = lambda df: int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size(long) > 100 * size(date_dimension(spark)) > 1_000_000


def test_long_calendar_is_not_broadcast(spark):
    for end, broadcast in ((date(2021, 1, 1), True), (date(9000, 1, 1), False)):
        calendar = date_dimension(spark, date(2020, 1, 1), end)
        # Nothing but the calendar is small: the other side is a large range of days
        days = spark.range(10**9).select(F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 9000).cast("int")).alias("day"))
        plan = join_calendar(days, calendar, "day", list(calendar.columns[1:]))._jdf.queryExecution().executedPlan()
        assert ("BroadcastExchange" in plan.toString()) is broadcast
