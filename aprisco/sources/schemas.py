"""The raw tables: names, columns, load stamps and freshness limits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TYPES = {
    "string": StringType(),
    "bigint": LongType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
    # Money and measures are exact, never floating point.
    "decimal(38,9)": DecimalType(38, 9),
}

# Every captured fact ends with who captured it, how, its state and when.
FACT_TAIL = (
    "canal_captura string, estado_registro string, id_registro_correccion string, "
    "timestamp_registro timestamp_ntz"
)
# Every simple catalogue is an id followed by these.
CATALOGUE_TAIL = "nombre string, estado string, finca_asociada string, fecha_creacion date"
BY_NAME = "finca_asociada string, id_finca string"


def _catalogue(key: str) -> str:
    return f"{key} string, {CATALOGUE_TAIL}"


def _fact(date: str, body: str, user: str = "id_usuario string") -> str:
    return f"id_registro string, {date} date, {body}, {user}, {FACT_TAIL}"


def _numbers(*names: str) -> str:
    return ", ".join(f"{n} decimal(38,9)" for n in names)


@dataclass(frozen=True)
class RawTable:
    """A raw table. ``ddl`` is None for tables that are only counted and watched."""

    name: str
    domain: str
    is_fact: bool
    ddl: str | None = None
    load_stamp: str | None = None

    @property
    def table(self) -> str:
        return f"tb_{'fact' if self.is_fact else 'dim'}_{self.name}"

    @property
    def loaded_at(self) -> str:
        return self.load_stamp or ("timestamp_registro" if self.is_fact else "fecha_creacion")

    @property
    def freshness_days(self) -> tuple[int, int]:
        """Age in days after which the table warns and fails; facts are captured daily."""
        return (5, 14) if self.is_fact else (14, 45)

    @property
    def schema(self) -> StructType | None:
        if self.ddl is None:
            return None
        columns = [column.split(" ") for column in self.ddl.split(", ")]
        return StructType([StructField(name, TYPES[kind]) for name, kind in columns])

    @property
    def columns(self) -> list[str]:
        return [] if self.schema is None else self.schema.names


def _dim(name: str, domain: str, ddl: str | None = None, stamp: str | None = None) -> RawTable:
    return RawTable(name, domain, False, ddl, stamp)


def _facts(name: str, domain: str, ddl: str | None = None, stamp: str | None = None) -> RawTable:
    return RawTable(name, domain, True, ddl, stamp)


RAW_TABLES: tuple[RawTable, ...] = (
    _dim(
        "fincas", "comun",
        "id_finca string, nombre_finca string, ubicacion string, estado string, "
        "fecha_registro date",
        "fecha_registro",
    ),
    _dim("roles", "comun"),
    _dim("usuarios", "comun"),
    _dim(
        "catalogo_finanzas", "finanzas",
        "id_item string, tipo_transaccion string, categoria string, clase_gasto string, "
        "estado string, finca_asociada string, fecha_creacion date",
    ),
    _facts(
        "transacciones_financieras", "finanzas",
        _fact(
            "fecha_transaccion",
            "id_finca string, tipo_transaccion string, categoria string, clase string, "
            "proveedor_tercero string, detalle_movimiento string, " + _numbers("monto_total"),
        ),
    ),
    _facts(
        "venta_leche", "leche",
        _fact(
            "fecha_pago",
            "id_finca string, "
            + _numbers(
                "litros_entrega", "litros_valor_base", "incentivo_valor",
                "valor_entrega_bruta", "multa", "valor_entrega_neta",
                "valor_litro_base", "valor_litro_incentivo", "valor_litro_total",
            ),
            "id_usuario string, nombre_usuario string",
        ),
    ),
    _facts(
        "microbiologia_leche", "leche",
        _fact("fecha_muestra", "id_finca string, " + _numbers("microbiologia_muestra")),
    ),
    _facts(
        "composicion_leche", "leche",
        _fact(
            "fecha_muestra",
            "id_finca string, "
            + _numbers(*[f"composicion_{x}" for x in ("grasa", "proteina", "lactosa", "st", "sng")])
            + ", celulas_somaticas bigint",
        ),
    ),
    _dim(
        "animales", "hato",
        "id_animal string, arete string, chip string, sexo string, estado string, "
        "finca_asociada string, fecha_nacimiento date, id_madre string, id_padre string, "
        "padre_tipo string, fecha_creacion date, foto_url string, lote string, "
        "categoria_animal string",
    ),
    _dim("catalogo_lotes", "hato", _catalogue("id_item")),
    _dim("catalogo_categorias_animal", "hato", _catalogue("id_item")),
    _dim("catalogo_motivos_salida", "hato", _catalogue("id_motivo")),
    _facts(
        "partos", "hato",
        _fact(
            "fecha_parto",
            "id_madre string, arete_madre string, sexo_cria string, arete_cria string, "
            "chip_cria string, observaciones string, " + BY_NAME,
        ),
    ),
    _facts(
        "salidas", "hato",
        _fact(
            "fecha_salida",
            "id_animal string, arete_animal string, motivo string, observaciones string, "
            + BY_NAME,
        ),
    ),
    _dim("catalogo_veterinarios", "veterinaria", _catalogue("id_veterinario")),
    _dim("catalogo_medicinas", "veterinaria", _catalogue("id_medicina")),
    _dim("catalogo_motivos_tratamiento", "veterinaria", _catalogue("id_motivo")),
    _facts(
        "palpamientos", "veterinaria",
        _fact(
            "fecha_palpamiento",
            "id_animal string, arete_animal string, resultado string, dias_gestacion bigint, "
            "fecha_parto_esperada date, estado_gestacion string, meses_atraso bigint, "
            "veterinario string, comentario string, " + BY_NAME,
        ),
    ),
    _facts(
        "tratamientos", "veterinaria",
        _fact(
            "fecha_tratamiento",
            "id_animal string, arete_animal string, motivo string, medicina string, "
            + _numbers("cantidad")
            + ", unidad string, dias_retiro bigint, veterinario string, " + BY_NAME,
        ),
    ),
    _facts(
        "pesaje_leche", "veterinaria",
        _fact(
            "fecha_pesaje",
            "ordeno string, id_animal string, arete_animal string, "
            + _numbers("litros") + ", " + BY_NAME,
        ),
    ),
    _dim(
        "catalogo_insumos", "insumos",
        "id_insumo string, nombre string, categoria string, unidad_base string, "
        "maneja_vencimiento boolean, existencia_actual decimal(38,9), estado string, "
        "presentacion string, finca_asociada string, fecha_creacion date",
    ),
    _dim("catalogo_categorias_insumos", "insumos"),
    _dim("catalogo_unidades_insumos", "insumos"),
    _facts(
        "movimientos_insumos", "insumos",
        "id_registro string, id_insumo string, tipo_movimiento string, fecha_movimiento date, "
        + _numbers("cantidad_base", "cantidad_capturada")
        + ", id_presentacion string, "
        + _numbers("factor_presentacion_copiado", "costo_total")
        + ", proveedor string, numero_lote string, fecha_vencimiento date, motivo string, "
        "id_movimiento_compensado string, id_periodo_generado string, "
        + BY_NAME + ", id_usuario string, " + FACT_TAIL,
    ),
    _facts("periodos_consumo_insumos", "insumos"),
    _facts("logs_actividad", "comun", stamp="timestamp_evento"),
)


def raw_table(name: str) -> RawTable:
    return next(t for t in RAW_TABLES if name in (t.name, t.table))
