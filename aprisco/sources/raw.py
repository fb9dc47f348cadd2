"""Raw zone: readers for the replicated tables and the full-overwrite load."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from aprisco.sources.schemas import RAW_TABLES, raw_table
from aprisco.sources.versions import complete_versions, write_next

WRITES_AT_A_TIME = 4

# Columns that staging casts, and so may arrive as text.
CAST_LATER = ("fecha_nacimiento",)


class SchemaDrift(ValueError):
    """A raw table lacks a declared column or changed its type."""


# Whole numbers by the digits they can have.
WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def _compatible(declared: DataType, found: DataType) -> bool:
    """Equal, or widened without loss."""
    if isinstance(declared, DecimalType):
        if type(found) in WHOLE:
            return WHOLE[type(found)] <= declared.precision - declared.scale
        if not isinstance(found, DecimalType):
            return False
        room = declared.precision - declared.scale
        return found.scale <= declared.scale and found.precision - found.scale <= room
    if type(declared) in WHOLE and type(found) in WHOLE:
        return WHOLE[type(found)] <= WHOLE[type(declared)]
    if isinstance(declared, DoubleType):
        return isinstance(found, (DoubleType, FloatType, ByteType, ShortType, IntegerType))
    if isinstance(declared, TimestampNTZType):
        return isinstance(found, (TimestampNTZType, TimestampType))
    return declared == found


def _widened(name: str, found: DataType, declared: DataType) -> Column:
    if isinstance(declared, TimestampNTZType) and isinstance(found, TimestampType):
        # Its moment in UTC, whatever the session's zone is
        seconds = F.unix_micros(name).cast("decimal(38,0)") / 1_000_000
        since = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return since + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.col(name).cast(declared)


def check_schema(df: DataFrame, name: str) -> DataFrame:
    """Hold a raw table to its declared columns; columns that were added are let through."""
    table = raw_table(name)
    found = {f.name: f.dataType for f in df.schema}
    if table.schema is None:
        if table.loaded_at not in found:
            raise SchemaDrift(f"{table.table}: load stamp {table.loaded_at} is missing")
        return df
    widened = {}
    for field in table.schema:
        if field.name not in found:
            raise SchemaDrift(f"{table.table}: column {field.name} is missing")
        actual = found[field.name]
        if field.name in CAST_LATER:
            continue
        if not _compatible(field.dataType, actual):
            raise SchemaDrift(
                f"{table.table}.{field.name}: expected {field.dataType.simpleString()}, "
                f"found {actual.simpleString()}"
            )
        if actual != field.dataType:
            widened[field.name] = _widened(field.name, actual, field.dataType)
    return df.withColumns(widened) if widened else df


class RawZone:
    """The raw tables under a directory, in a catalog database, or given by a function.

    Models read the replica; a second zone over the live copy serves count reconciliation
    only. A table is resolved once, so all readers of a zone see the same version of it.
    """

    def __init__(self, load: Callable[[str], DataFrame]):
        self._load = load
        self._tables: dict[str, DataFrame] = {}

    @classmethod
    def from_path(cls, spark: SparkSession, root: str) -> RawZone:
        def load(table: str) -> DataFrame:
            versions = complete_versions(spark, f"{root}/{table}")
            return spark.read.parquet(versions[-1] if versions else f"{root}/{table}")

        return cls(load)

    @classmethod
    def from_files(cls, spark: SparkSession, root: str, suffix: str = ".parquet") -> RawZone:
        return cls(lambda table: spark.read.parquet(f"{root}/{table}{suffix}"))

    @classmethod
    def from_database(cls, spark: SparkSession, database: str) -> RawZone:
        return cls(lambda table: spark.table(f"{database}.{table}"))

    def table(self, name: str) -> DataFrame:
        """Raw table by short or full name, held to its declared schema."""
        table = raw_table(name).table
        if table not in self._tables:
            self._tables[table] = check_schema(self._load(table), name)
        return self._tables[table]


class LoadFailed(RuntimeError):
    """The replica is incomplete; nothing may be built from it."""


def replicate(
    live: RawZone, root: str, tables: Iterable[str] | None = None
) -> dict[str, str]:
    """Copy whole tables from the live source into the replica, each to a new version.

    A few tables are written at a time. All are tried; if any fails the load raises, and the
    caller must not transform. Tables that failed keep their previous version.
    """
    written, failed = {}, {}

    def load(name: str) -> None:
        table = raw_table(name).table
        try:
            written[table] = write_next(live.table(name), f"{root}/{table}")
        except Exception as error:  # noqa: BLE001 - reported together below
            failed[table] = f"{type(error).__name__}: {(str(error) or '?').splitlines()[0]}"

    with ThreadPoolExecutor(WRITES_AT_A_TIME) as pool:
        list(pool.map(load, tables or [t.name for t in RAW_TABLES]))
    if failed:
        raise LoadFailed("; ".join(f"{t}: {why}" for t, why in sorted(failed.items())))
    return written
