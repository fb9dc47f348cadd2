"""Type-2 history of mutable dimensions, built by comparing full copies of the source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCD_ID, VALID_FROM, VALID_TO = "dbt_scd_id", "dbt_valid_from", "dbt_valid_to"
SCD_COLUMNS = (SCD_ID, VALID_FROM, VALID_TO)


def version_id(key: Column, valid_from: Column) -> Column:
    """Surrogate key of a version: hash of the natural key and the start of validity."""
    stamp = F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", key.cast("string"), stamp))


def _stamp(run_ts: datetime) -> Column:
    return F.lit(run_ts.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


def _one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Fail the job on a repeated or NULL key. Uses the same shuffle and sort as a join on it."""
    position = F.row_number().over(Window.partitionBy(key).orderBy(key))
    fault = F.when(
        F.col(key).isNull() | (F.col("__nth") > 1),
        F.raise_error(
            F.concat(F.lit(f"snapshot key {key} is NULL or repeated: "),
                     F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
        ).cast("boolean"),
    ).otherwise(F.lit(True))
    return df.withColumn("__nth", position).where(fault).drop("__nth")


def snapshot_step(
    open_versions: DataFrame,
    current: DataFrame,
    unique_key: str,
    check_cols: Sequence[str],
    run_ts: datetime,
) -> DataFrame:
    """Compare the open versions with a full copy of the source taken at ``run_ts``.

    Returns the open versions after the run plus the versions the run closed; versions that
    were closed earlier are not touched and need not be read. Rules: a new key opens a
    version, a changed tracked column (NULL-safe) closes the open version and opens another,
    and a key that vanished keeps its open version. Untracked columns stay as they were when
    the version began. A run that is older than an open version, or as old as one that it would
    close, fails: it would end a version before its beginning.

    Both sides hold one row per key, so the outer join cannot meet a hot key.
    """
    payload = [c for c in open_versions.columns if c not in SCD_COLUMNS]
    added = [c for c in current.columns if c not in payload]
    types = dict(current.dtypes)
    now = _stamp(run_ts)

    old = open_versions.select(
        F.col(unique_key).alias("__k"),
        F.struct(
            *payload, *[F.lit(None).cast(types[c]).alias(c) for c in added], *SCD_COLUMNS
        ).alias("__old"),
    )
    known = set(current.columns)
    lost = dict(open_versions.dtypes)
    new = _one_row_per_key(current, unique_key).select(
        F.col(unique_key).alias("__k"),
        F.struct(
            *[F.col(c) if c in known else F.lit(None).cast(lost[c]).alias(c) for c in payload],
            *added,
            version_id(F.col(unique_key), now).alias(SCD_ID),
            now.alias(VALID_FROM),
            F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        ).alias("__new"),
    )
    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    changed = F.lit(False)
    for c in check_cols:
        changed = changed | ~F.col(f"__old.{c}").eqNullSafe(F.col(f"__new.{c}"))

    # One pass over the join: each key yields its old version, its new one, or both.
    closes = has_old & has_new & changed
    since = F.col(f"__old.{VALID_FROM}")
    too_old = has_old & ((since > now) | (closes & (since >= now)))
    fault = F.raise_error(F.lit(f"snapshot run {run_ts} is not later than an open version"))
    kept = F.when(too_old, fault.cast(new.schema["__new"].dataType))
    kept = kept.when(closes, F.col("__old").withField(VALID_TO, now)).when(has_old, F.col("__old"))
    opened = F.when(has_new & (~has_old | closes), F.col("__new"))
    rows = F.filter(F.array(kept, opened), lambda v: v.isNotNull())
    return old.join(new, "__k", "full").select(F.inline(rows))


def check_snapshot(
    history: DataFrame | None,
    current: DataFrame,
    unique_key: str,
    check_cols: Sequence[str],
    run_ts: datetime,
) -> DataFrame:
    """Whole history after one snapshot run; ``history=None`` on the first run.

    The first run stamps every row with the run time: there is no retroactive history.
    Running the same copy again adds nothing.
    """
    if history is None:
        now = _stamp(run_ts)
        return _one_row_per_key(current, unique_key).select(
            *current.columns,
            version_id(F.col(unique_key), now).alias(SCD_ID),
            now.alias(VALID_FROM),
            F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        )
    is_open = F.col(VALID_TO).isNull()
    step = snapshot_step(history.where(is_open), current, unique_key, check_cols, run_ts)
    return history.where(~is_open).unionByName(step, allowMissingColumns=True)


def replay_snapshots(
    batches: DataFrame, unique_key: str, check_cols: Sequence[str], batch_ts: str
) -> DataFrame:
    """History that folding ``check_snapshot`` over all dated batches would give, in one job.

    ``batches`` holds one row per (key, batch). One shuffle by key serves the three windows;
    a key has at most one row per batch, so no group grows with the number of rows.
    """
    by_key = Window.partitionBy(unique_key).orderBy(batch_ts)
    repeated = F.lag(batch_ts).over(by_key) == F.col(batch_ts)
    fault = F.when(
        F.col(unique_key).isNull() | F.col("__repeated"),
        F.raise_error(F.lit(f"snapshot key {unique_key} is NULL or repeated in a batch")).cast(
            "boolean"
        ),
    ).otherwise(F.lit(True))
    tracked = F.struct(*check_cols)
    before = F.lag(tracked).over(by_key)
    starts = batches.select(
        "*",
        F.coalesce(repeated, F.lit(False)).alias("__repeated"),
        (before.isNull() | ~before.eqNullSafe(tracked)).alias("__starts"),
    ).where(fault & F.col("__starts"))
    valid_from = F.col(batch_ts).cast("timestamp_ntz")
    return starts.select(
        *[c for c in batches.columns if c != batch_ts],
        version_id(F.col(unique_key), valid_from).alias(SCD_ID),
        valid_from.alias(VALID_FROM),
        F.lead(valid_from).over(by_key).alias(VALID_TO),
    )


def as_dimension(
    history: DataFrame, surrogate: str, columns: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Project a history to a dimension: surrogate key, attributes, validity and its flag.

    ``columns`` are the attributes to keep, or a mapping of source name to exposed name.
    """
    named = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    return history.select(
        F.col(SCD_ID).alias(surrogate),
        *[F.col(src).alias(name) for src, name in named.items()],
        F.col(VALID_FROM).alias("vigente_desde"),
        F.col(VALID_TO).alias("vigente_hasta"),
        F.col(VALID_TO).isNull().alias("vigente"),
    )


def current_versions(dimension: DataFrame, active: str | None = "Activo") -> DataFrame:
    """Open versions of a dimension, by default only those whose ``estado`` is active."""
    rows = dimension.where(F.col("vigente"))
    return rows if active is None else rows.where(F.col("estado") == active)
