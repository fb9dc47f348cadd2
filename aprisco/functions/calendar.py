"""Generated calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Labels are part of the reported result.
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
WEEKDAY_NAMES = (
    "Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado",
)
DRY_MONTHS = (12, 1, 2, 3, 4)
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2036, 1, 1)


def _label(position: Column, names: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def date_dimension(
    spark: SparkSession,
    start: date = CALENDAR_START,
    end_exclusive: date = CALENDAR_END,
) -> DataFrame:
    """One row per day of ``[start, end_exclusive)``; weekday 1 is Sunday.

    The range of day numbers has true statistics, so a join sees how large a calendar is.
    """
    days = (end_exclusive - start).days
    if days <= 0:
        raise ValueError("a calendar holds at least one day")
    days = spark.range(days).select(F.date_add(F.lit(start.isoformat()).cast("date"), F.col("id").cast("int")).alias("fecha"))
    day = F.col("fecha")
    month, weekday = F.month(day), F.dayofweek(day)
    return days.select(
        day,
        F.lit(None).cast("string").alias("ciclo_productivo"),
        F.year(day).alias("anio"),
        month.alias("mes"),
        F.dayofmonth(day).alias("dia"),
        F.quarter(day).alias("trimestre"),
        weekday.alias("dia_semana_numero"),
        weekday.isin(1, 7).alias("es_fin_de_semana"),
        _label(month, MONTH_NAMES).alias("mes_nombre"),
        _label(weekday, WEEKDAY_NAMES).alias("dia_semana_nombre"),
        F.when(month.isin(*DRY_MONTHS), "Seca").otherwise("Lluviosa").alias("estacion"),
    )
