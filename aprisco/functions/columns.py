"""Column expressions shared by every layer. All of them stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on these exact strings.
VALID_STATUS = "Activo"
TEST_NAME_PREFIX = "TEST-"
EXCLUDED_FARM_IDS = ("finca_trebol", "test-verificacion-venta-leche-finanzas")

# UTF-8 text that was once read as Latin-1, and the letter it stood for. All
# wrong forms begin with the same character; the second one of the wrong form of "í" is the soft hyphen U+00AD.
MOJIBAKE_LEAD = "Ã"
MOJIBAKE = (
    ("Ã±", "ñ"),
    ("Ã­", "í"),
    ("Ã³", "ó"),
    ("Ã©", "é"),
    ("Ã¡", "á"),
)


def is_valid_row(status: str = "estado_registro", valid: str = VALID_STATUS) -> Column:
    """Row is the current one of its correction chain. A NULL status is not."""
    return F.col(status) == F.lit(valid)


def not_test_name(column: str = "finca_asociada", prefix: str = TEST_NAME_PREFIX) -> Column:
    """Name does not start with the prefix. Case matters, and a NULL name is dropped."""
    return ~F.col(column).startswith(prefix)


def not_excluded_id(
    column: str = "id_finca", excluded: Iterable[str] = EXCLUDED_FARM_IDS
) -> Column:
    """Id is none of the excluded ones. A NULL id is dropped."""
    return ~F.col(column).isin(*excluded)


def repair_mojibake(column: str | Column) -> Column:
    """Put back the five accented letters of ``MOJIBAKE``; any other text is left alone.

    Sound text, which is most of it, is searched once and not five times.
    """
    text = F.col(column) if isinstance(column, str) else column
    repaired = text
    for wrong, right in MOJIBAKE:
        repaired = F.replace(repaired, F.lit(wrong), F.lit(right))
    return F.when(text.contains(MOJIBAKE_LEAD), repaired).otherwise(text)


def ceil_to_date(ts: Column) -> Column:
    """First date whose midnight is not before the timestamp; NULL stays NULL."""
    day = ts.cast("date")
    return F.when(day.cast("timestamp_ntz") == ts.cast("timestamp_ntz"), day).otherwise(
        F.date_add(day, 1)
    )
