"""The checks of the warehouse, derived from what each model is keyed and joined by.

Rules of the suite: a model's key is unique and never NULL; its farm, business date, animal
and supply references are never NULL and exist in their parent; named measures and labels are
never NULL; categories hold known values. Staging is held to the raw parents, marts to the
dimensions, and reports to the labels a reader needs.
"""

from __future__ import annotations

from aprisco.plans.models import FACTS, MARTS, MODELS, REPORTING, STAGING
from aprisco.quality.runner import Check
from aprisco.sources.schemas import raw_table

# The categories the business knows.
SEX = ("Hembra", "Macho")
ACTIVE_STATES = ("Activo", "Inactivo")
DIAGNOSES = ("Preñada", "Vacía Ciclando", "Vacía Anestro")
MILKINGS = ("Mañana", "Tarde")
MOVEMENTS = ("inicial", "compra", "conteo", "merma", "ajuste")
TRANSACTIONS = ("Entrada", "Inversion", "Salida")
SEASONS = ("Seca", "Lluviosa")

# Measures and texts, beyond keys and references, that a captured fact must carry.
REQUIRED = {
    "salidas": ("motivo",),
    "palpamientos": ("resultado",),
    "pesaje_leche": ("ordeno", "litros"),
    "movimientos_insumos": ("tipo_movimiento", "cantidad_base"),
    "transacciones_financieras": ("tipo_transaccion", "monto_total"),
    "venta_leche": ("litros_entrega", "valor_entrega_neta"),
}
CATEGORIES = {
    "palpamientos": {"resultado": DIAGNOSES},
    "pesaje_leche": {"ordeno": MILKINGS},
    "movimientos_insumos": {"tipo_movimiento": MOVEMENTS},
    "transacciones_financieras": {"tipo_transaccion": TRANSACTIONS},
}
# Which column of a fact names the entity it happened to, and where that entity lives.
ENTITY = {
    "partos": ("id_madre", "animales", "dim_animal", "id_animal"),
    "salidas": ("id_animal", "animales", "dim_animal", "id_animal"),
    "palpamientos": ("id_animal", "animales", "dim_animal", "id_animal"),
    "tratamientos": ("id_animal", "animales", "dim_animal", "id_animal"),
    "pesaje_leche": ("id_animal", "animales", "dim_animal", "id_animal"),
    "movimientos_insumos": ("id_insumo", "catalogo_insumos", "dim_insumo", "id_insumo"),
}


def _key(table: str, *columns: str) -> list[Check]:
    return [Check(kind, table, (c,)) for c in columns for kind in ("unique", "not_null")]


def _required(table: str, *columns: str) -> list[Check]:
    return [Check("not_null", table, (c,)) for c in columns]


def _one_of(table: str, column: str, values: tuple[str, ...]) -> Check:
    return Check("accepted_values", table, (column,), values=values)


def _reference(table: str, column: str, parent: str, field: str) -> list[Check]:
    return [
        Check("not_null", table, (column,)),
        Check("relationships", table, (column,), parent=parent, field=field),
    ]


def _farm(table: str, columns: list[str], parent: str) -> list[Check]:
    by_name = "finca_asociada" in columns
    return _reference(
        table,
        "finca_asociada" if by_name else "id_finca",
        parent,
        "nombre_finca" if by_name else "id_finca",
    )


def _common_fact(source: str, date: str, table: str, farms: str) -> list[Check]:
    """Checks a fact has in staging and keeps in its mart."""
    return [
        *_key(table, "id_registro"),
        *_farm(table, raw_table(source).columns, farms),
        *_required(table, *REQUIRED.get(source, ())),
        *[_one_of(table, c, v) for c, v in CATEGORIES.get(source, {}).items()],
    ]


def staging_checks() -> list[Check]:
    checks: list[Check] = []
    for name, model in MODELS.items():
        if model.layer != STAGING:
            continue
        raw = raw_table(name.removeprefix("stg_"))
        if raw.is_fact:
            continue
        checks += _key(name, raw.columns[0])
        if raw.name == "fincas":
            checks += _key(name, "nombre_finca")
        else:
            checks += _farm(name, raw.columns, "tb_dim_fincas")
        if raw.name in ("fincas", "catalogo_insumos", "catalogo_finanzas"):
            checks += [*_required(name, "estado"), _one_of(name, "estado", ACTIVE_STATES)]
    checks += [
        _one_of("stg_animales", "sexo", SEX),
        *_required("stg_animales", "estado"),
        *_required("stg_catalogo_insumos", "unidad_base"),
        *_required("stg_catalogo_finanzas", "tipo_transaccion"),
        _one_of("stg_catalogo_finanzas", "tipo_transaccion", TRANSACTIONS),
    ]
    for _, source, date, _ in FACTS:
        table = f"stg_{source}"
        checks += _common_fact(source, date, table, "tb_dim_fincas")
        checks += _required(table, date)
        if source in ENTITY:
            column, parent, _, field = ENTITY[source]
            checks += _reference(table, column, raw_table(parent).table, field)
    return checks


def mart_checks() -> list[Check]:
    checks = [
        *_key("dim_finca", "id_finca", "nombre_finca"),
        *_required("dim_finca", "estado"),
        _one_of("dim_finca", "estado", ACTIVE_STATES),
        *_key("dim_fecha", "fecha"),
        *_required("dim_fecha", "estacion"),
        _one_of("dim_fecha", "estacion", SEASONS),
        *_key("dim_catalogo_finanzas", "id_item"),
        *_reference("dim_catalogo_finanzas", "finca_asociada", "dim_finca", "nombre_finca"),
        *_key("dim_animal", "sk_animal"),
        *_required("dim_animal", "id_animal"),
        _one_of("dim_animal", "sexo", SEX),
        *_reference("dim_animal", "finca_asociada", "dim_finca", "nombre_finca"),
        *_key("dim_lote", "sk_lote"),
        *_required("dim_lote", "id_lote"),
        *_key("dim_categoria_animal", "id_categoria_animal"),
        *_key("dim_motivo_salida", "id_motivo"),
        *_key("dim_veterinario", "id_veterinario"),
        *_key("dim_medicina", "id_medicina"),
        *_key("dim_motivo_tratamiento", "id_motivo"),
        *_key("dim_insumo", "sk_insumo"),
        *_required("dim_insumo", "id_insumo", "estado"),
        _one_of("dim_insumo", "estado", ACTIVE_STATES),
        *_reference("dim_insumo", "finca_asociada", "dim_finca", "nombre_finca"),
    ]
    for fact, source, date, _ in FACTS:
        checks += _common_fact(source, date, fact, "dim_finca")
        checks += _reference(fact, date, "dim_fecha", "fecha")
        if source in ENTITY:
            column, _, parent, field = ENTITY[source]
            checks += _reference(fact, column, parent, field)
    return checks


def report_checks() -> list[Check]:
    checks: list[Check] = []
    for name, model in MODELS.items():
        if model.layer != REPORTING:
            continue
        if model.newest_first:
            checks += _required(name, model.newest_first)
        if model.domain in ("finanzas", "insumos", "leche"):
            checks += _required(name, "nombre_finca")
    checks += _required("rpt_animales_activos", "id_animal")
    checks += _required("rpt_pesaje_resumen_diario", "litros_totales_dia")
    return checks


SUITE = {STAGING: staging_checks, MARTS: mart_checks, REPORTING: report_checks}
