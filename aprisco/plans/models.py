"""The models of the warehouse, layer by layer, as functions of the relations below them.

A model is a lazy DataFrame built from other models through ``Warehouse``. Columns follow
from the raw schemas wherever a layer only narrows the one below.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aprisco.functions import (
    date_dimension,
    is_valid_row,
    not_excluded_id,
    not_test_name,
    repair_mojibake,
)
from aprisco.operators import (
    as_dimension,
    asof_version_join,
    check_snapshot,
    current_versions,
    daily_rollup,
    full_outer_merge,
    join_calendar,
    star_join,
)
from aprisco.operators.history import SCD_ID
from aprisco.sources.raw import RawZone
from aprisco.sources.schemas import RAW_TABLES, RawTable, raw_table

STAGING, HISTORY, INTERMEDIATE, MARTS, REPORTING = (
    "staging", "snapshots", "intermediate", "marts", "reporting",
)
LAYERS = (STAGING, HISTORY, INTERMEDIATE, MARTS, REPORTING)

# Columns of a captured fact that matter only until invalid rows are gone.
CORRECTION_COLUMNS = ("estado_registro", "id_registro_correccion")
CALENDAR_LABELS = ("dia_semana_nombre", "estacion")


@dataclass(frozen=True)
class SnapshotSpec:
    source: str
    unique_key: str
    check_cols: tuple[str, ...]


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    domain: str
    make: Callable[[Warehouse], DataFrame]
    # Layout of a stored fact: business date and cluster columns.
    partition_date: str | None = None
    cluster_by: tuple[str, ...] = ()
    # Reading order of a report; the sort is added only when the report is presented.
    newest_first: str | None = None
    sorted_by: str | None = None


SNAPSHOTS: Mapping[str, SnapshotSpec] = {
    "snapshot_animal": SnapshotSpec(
        "stg_animales", "id_animal", ("lote", "categoria_animal", "estado")
    ),
    "snapshot_lote": SnapshotSpec("stg_catalogo_lotes", "id_item", ("nombre", "estado")),
    "snapshot_insumo": SnapshotSpec(
        "stg_catalogo_insumos", "id_insumo", ("categoria", "presentacion", "estado")
    ),
}


@dataclass
class Warehouse:
    """Resolves model names to DataFrames: stored relations first, else the model's plan.

    ``stored`` holds relations that a build has written (or that a caller supplies, such as
    histories of earlier runs); everything else is composed lazily, so a report over raw
    tables is a single plan.
    """

    spark: SparkSession
    raw: RawZone
    run_ts: datetime
    # Set once the checks have shown that no movement id repeats, which saves a shuffle.
    unique_movements: bool = False
    stored: dict[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.stored:
            self.stored[name] = MODELS[name].make(self)
        return self.stored[name]

    def source(self, name: str) -> DataFrame:
        return self.raw.table(name)


# --- staging: declared columns, repaired text, valid rows of real farms --------------------

# Categories that were captured with a broken encoding.
REPAIRED = {"palpamientos": "resultado", "pesaje_leche": "ordeno"}


def _staging(table: RawTable) -> Callable[[Warehouse], DataFrame]:
    def make(w: Warehouse) -> DataFrame:
        rows = w.source(table.name)
        if table.is_fact:
            rows = rows.where(is_valid_row())
        if "finca_asociada" in table.columns:
            rows = rows.where(not_test_name())
        elif table.is_fact:
            rows = rows.where(not_excluded_id())
        columns = {c: F.col(c) for c in table.columns}
        if table.name in REPAIRED:
            columns[REPAIRED[table.name]] = repair_mojibake(REPAIRED[table.name])
        if table.name == "animales":
            columns["fecha_nacimiento"] = F.col("fecha_nacimiento").cast("date")
        return rows.select(*[expr.alias(name) for name, expr in columns.items()])

    return make


def _staging_models() -> list[Model]:
    return [
        Model(f"stg_{t.name}", STAGING, t.domain, _staging(t))
        for t in RAW_TABLES
        if t.ddl is not None
    ]


# --- snapshots and the version join --------------------------------------------------------

def _snapshot(spec: SnapshotSpec) -> Callable[[Warehouse], DataFrame]:
    def make(w: Warehouse) -> DataFrame:
        return check_snapshot(None, w[spec.source], spec.unique_key, spec.check_cols, w.run_ts)

    return make


SUPPLY_AT_THE_TIME = {
    "nombre": "insumo_nombre",
    "unidad_base": "insumo_unidad_base",
    "categoria": "insumo_categoria_al_momento",
    "presentacion": "insumo_presentacion_al_momento",
    "estado": "insumo_estado_al_momento",
}


def _movements_with_supply(w: Warehouse) -> DataFrame:
    versions = w["snapshot_insumo"]
    return asof_version_join(
        w["stg_movimientos_insumos"],
        versions,
        key="id_insumo",
        fact_date="fecha_movimiento",
        fact_id="id_registro",
        attrs=SUPPLY_AT_THE_TIME,
        version_id=SCD_ID if SCD_ID in versions.columns else None,
        unique_facts=w.unique_movements,
    )


def _history_models() -> list[Model]:
    return [
        *[
            Model(name, HISTORY, raw_table(spec.source.removeprefix("stg_")).domain, _snapshot(spec))
            for name, spec in SNAPSHOTS.items()
        ],
        Model(
            "int_movimientos_insumos_con_insumo_historico",
            INTERMEDIATE, "insumos", _movements_with_supply,
        ),
    ]


# --- marts: dimensions and facts -----------------------------------------------------------

def _plain_dimension(source: str, drop: str, rename: Mapping[str, str] | None = None):
    def make(w: Warehouse) -> DataFrame:
        return w[source].drop(drop).withColumnsRenamed(dict(rename or {}))

    return make


def _versioned_dimension(snapshot: str, surrogate: str, columns):
    return lambda w: as_dimension(w[snapshot], surrogate, columns)


def _fact(source: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w[source].drop(*CORRECTION_COLUMNS)


def _supply_fact(w: Warehouse) -> DataFrame:
    rows = w["int_movimientos_insumos_con_insumo_historico"]
    first = ["id_registro", "id_insumo", *SUPPLY_AT_THE_TIME.values()]
    skip = {*first, *CORRECTION_COLUMNS}
    return rows.select(*first, *[c for c in rows.columns if c not in skip])


def _dimension_models() -> list[Model]:
    plain = [
        ("dim_finca", "comun", "fincas", "fecha_registro", {}),
        ("dim_catalogo_finanzas", "finanzas", "catalogo_finanzas", "fecha_creacion", {}),
        ("dim_categoria_animal", "hato", "catalogo_categorias_animal", "fecha_creacion",
         {"id_item": "id_categoria_animal"}),
        ("dim_motivo_salida", "hato", "catalogo_motivos_salida", "fecha_creacion", {}),
        ("dim_medicina", "veterinaria", "catalogo_medicinas", "fecha_creacion", {}),
        ("dim_motivo_tratamiento", "veterinaria", "catalogo_motivos_tratamiento",
         "fecha_creacion", {}),
        ("dim_veterinario", "veterinaria", "catalogo_veterinarios", "fecha_creacion", {}),
    ]
    versioned = [
        ("dim_animal", "hato", "snapshot_animal", "sk_animal",
         ("id_animal", "arete", "chip", "sexo", "fecha_nacimiento", "id_madre", "id_padre",
          "padre_tipo", "foto_url", "lote", "categoria_animal", "estado", "finca_asociada")),
        ("dim_lote", "hato", "snapshot_lote", "sk_lote",
         {"id_item": "id_lote", "nombre": "nombre", "estado": "estado",
          "finca_asociada": "finca_asociada"}),
        # The running balance is left out: it is not tracked, so a version would freeze it.
        ("dim_insumo", "insumos", "snapshot_insumo", "sk_insumo",
         ("id_insumo", "nombre", "unidad_base", "maneja_vencimiento", "categoria",
          "presentacion", "estado", "finca_asociada")),
    ]
    return [
        Model("dim_fecha", MARTS, "comun", lambda w: date_dimension(w.spark)),
        *[
            Model(name, MARTS, domain, _plain_dimension(f"stg_{src}", drop, rename))
            for name, domain, src, drop, rename in plain
        ],
        *[
            Model(name, MARTS, domain, _versioned_dimension(snapshot, sk, columns))
            for name, domain, snapshot, sk, columns in versioned
        ],
    ]


# Fact, its staging table, business date and cluster columns.
FACTS = (
    ("fct_transaccion_financiera", "transacciones_financieras", "fecha_transaccion", ("id_finca",)),
    ("fct_venta_leche", "venta_leche", "fecha_pago", ("id_finca",)),
    ("fct_microbiologia_leche", "microbiologia_leche", "fecha_muestra", ("id_finca",)),
    ("fct_composicion_leche", "composicion_leche", "fecha_muestra", ("id_finca",)),
    ("fct_parto", "partos", "fecha_parto", ("finca_asociada", "id_madre")),
    ("fct_salida", "salidas", "fecha_salida", ("finca_asociada", "id_animal")),
    ("fct_palpamiento", "palpamientos", "fecha_palpamiento", ("finca_asociada", "id_animal")),
    ("fct_tratamiento", "tratamientos", "fecha_tratamiento", ("finca_asociada", "id_animal")),
    ("fct_pesaje", "pesaje_leche", "fecha_pesaje", ("finca_asociada", "id_animal")),
    ("fct_movimiento_insumo", "movimientos_insumos", "fecha_movimiento",
     ("finca_asociada", "id_insumo")),
)


def _fact_models() -> list[Model]:
    return [
        Model(
            name, MARTS, raw_table(source).domain,
            _supply_fact if name == "fct_movimiento_insumo" else _fact(f"stg_{source}"),
            partition_date=date, cluster_by=cluster,
        )
        for name, source, date, cluster in FACTS
    ]


# --- reporting: one wide view per business question ----------------------------------------

def _with_farm(w: Warehouse, rows: DataFrame, farm: str) -> DataFrame:
    dim_key = "id_finca" if farm == "id_finca" else "nombre_finca"
    return star_join(rows, w["dim_finca"], farm, dim_key, ["nombre_finca"])


def _recent(fact: str, date: str, farm: str, columns: Mapping[str, str]):
    """Events of a fact with the labels of their day and the name of their farm."""
    def make(w: Warehouse) -> DataFrame:
        rows = join_calendar(_with_farm(w, w[fact], farm), w["dim_fecha"], date, CALENDAR_LABELS)
        return rows.select(
            date, *CALENDAR_LABELS, "nombre_finca",
            *[F.col(src).alias(name) for src, name in columns.items()],
        )

    return make


def _active_animals(w: Warehouse) -> DataFrame:
    rows = _with_farm(w, current_versions(w["dim_animal"]), "finca_asociada")
    return rows.select(
        "id_animal", "arete", "chip", "sexo", "fecha_nacimiento", "lote", "categoria_animal",
        "nombre_finca",
    )


def _milk_quality(w: Warehouse) -> DataFrame:
    keys = ["fecha_muestra", "id_finca"]
    microbes = w["fct_microbiologia_leche"].select(*keys, "microbiologia_muestra")
    measured = ["grasa", "proteina", "lactosa", "st", "sng"]
    makeup = w["fct_composicion_leche"].select(
        *keys, *[f"composicion_{m}" for m in measured], "celulas_somaticas"
    )
    rows = _with_farm(w, full_outer_merge(microbes, makeup, keys), "id_finca")
    return rows.select(
        "nombre_finca", "microbiologia_muestra", *[f"composicion_{m}" for m in measured],
        "celulas_somaticas", *keys,
    )


def _daily_milk(w: Warehouse) -> DataFrame:
    # Milk is summed per ear tag, not per animal: animals that share a tag, or have none,
    # are one line of the report.
    return daily_rollup(
        w["fct_pesaje"], w["dim_finca"],
        fact_key="finca_asociada", dim_key="nombre_finca", dim_name="nombre_finca",
        group_by=["fecha_pesaje", "arete_animal"],
        amount="litros", total="litros_totales_dia", count="cantidad_ordenos",
    )


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


RECENT_EVENTS = (
    ("rpt_transacciones_financieras_recientes", "fct_transaccion_financiera", "id_finca",
     _same("tipo_transaccion", "categoria", "clase", "monto_total", "proveedor_tercero",
           "detalle_movimiento")),
    ("rpt_entregas_leche_recientes", "fct_venta_leche", "id_finca",
     _same("litros_entrega", "valor_entrega_bruta", "multa", "valor_entrega_neta",
           "valor_litro_total")),
    ("rpt_nacimientos_recientes", "fct_parto", "finca_asociada",
     _same("arete_madre", "sexo_cria", "arete_cria", "chip_cria", "observaciones")),
    ("rpt_salidas_recientes", "fct_salida", "finca_asociada",
     _same("arete_animal", "motivo", "observaciones")),
    ("rpt_palpamientos_recientes", "fct_palpamiento", "finca_asociada",
     _same("arete_animal", "resultado", "dias_gestacion", "fecha_parto_esperada",
           "estado_gestacion", "meses_atraso", "veterinario")),
    ("rpt_tratamientos_recientes", "fct_tratamiento", "finca_asociada",
     _same("arete_animal", "motivo", "medicina", "cantidad", "unidad", "dias_retiro",
           "veterinario")),
    ("rpt_movimientos_insumo_recientes", "fct_movimiento_insumo", "finca_asociada",
     {"insumo_nombre": "insumo_nombre", "insumo_categoria_al_momento": "categoria",
      "insumo_unidad_base": "unidad",
      **_same("tipo_movimiento", "cantidad_base", "costo_total", "proveedor", "numero_lote",
              "fecha_vencimiento", "motivo")}),
)


def _report_models() -> list[Model]:
    facts = {name: (raw_table(source).domain, date) for name, source, date, _ in FACTS}
    return [
        *[
            Model(name, REPORTING, facts[fact][0], _recent(fact, facts[fact][1], farm, columns),
                  newest_first=facts[fact][1])
            for name, fact, farm, columns in RECENT_EVENTS
        ],
        Model("rpt_animales_activos", REPORTING, "hato", _active_animals, sorted_by="arete"),
        Model("rpt_calidad_leche_reciente", REPORTING, "leche", _milk_quality,
              newest_first="fecha_muestra"),
        Model("rpt_pesaje_resumen_diario", REPORTING, "veterinaria", _daily_milk,
              newest_first="fecha_pesaje"),
    ]


MODELS: Mapping[str, Model] = {
    m.name: m
    for m in (
        *_staging_models(),
        *_history_models(),
        *_dimension_models(),
        *_fact_models(),
        *_report_models(),
    )
}


def present(df: DataFrame, name: str) -> DataFrame:
    """A report in its reading order.

    The sort costs a range shuffle, so models leave it out. The remaining columns follow the
    leading one as tie-breakers, which fixes the order and lets a crowded date be sorted by
    several tasks.
    """
    model = MODELS[name]
    lead = model.newest_first or model.sorted_by
    if lead is None:
        return df
    first = F.col(lead).desc_nulls_last() if model.newest_first else F.col(lead).asc_nulls_first()
    return df.orderBy(first, *[c for c in df.columns if c != lead])
