"""A small, clean farm: raw tables in which every check passes, plus rows staging must drop."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql.types import DateType, StructField, StructType, TimestampNTZType

from aprisco.sources.raw import RawZone
from aprisco.sources.schemas import RAW_TABLES, raw_table

FARM = "Finca Piloto"
NOW = datetime(2026, 3, 20, 12)


def fact(key: str, **values) -> dict:
    return {
        "id_registro": key, "finca_asociada": FARM, "id_finca": "finca_1", "id_usuario": "u1",
        "canal_captura": "app", "estado_registro": "Activo",
        "timestamp_registro": datetime(2026, 3, 19, 8), **values,
    }


def item(key_name: str, key: str, **values) -> dict:
    return {
        key_name: key, "nombre": f"nombre {key}", "estado": "Activo", "finca_asociada": FARM,
        "fecha_creacion": date(2026, 3, 1), **values,
    }


def farm_rows() -> dict[str, list[dict]]:
    day = date(2026, 3, 15)
    return {
        "fincas": [
            {"id_finca": "finca_1", "nombre_finca": FARM, "ubicacion": "Chiriquí",
             "estado": "Activo", "fecha_registro": date(2026, 3, 10)},
            {"id_finca": "finca_t", "nombre_finca": "TEST-UNO", "ubicacion": None,
             "estado": "Inactivo", "fecha_registro": date(2026, 3, 10)},
        ],
        "animales": [
            item("id_animal", "a1", arete="1", sexo="Hembra", lote="L1", categoria_animal="Vaca",
                 fecha_nacimiento=date(2023, 5, 1)),
            item("id_animal", "a2", arete=None, sexo="Macho", lote="L1", categoria_animal=None),
            item("id_animal", "a3", arete=None, sexo="Hembra", lote="L2", estado="Vendido"),
            item("id_animal", "ax", sexo="Hembra", finca_asociada="TEST-UNO"),
            item("id_animal", "ay", sexo="Hembra", finca_asociada=None),
        ],
        "catalogo_lotes": [item("id_item", "l1"), item("id_item", "l2")],
        "catalogo_categorias_animal": [item("id_item", "c1")],
        "catalogo_motivos_salida": [item("id_motivo", "m1")],
        "catalogo_motivos_tratamiento": [item("id_motivo", "t1")],
        "catalogo_medicinas": [item("id_medicina", "d1")],
        "catalogo_veterinarios": [item("id_veterinario", "v1")],
        "catalogo_finanzas": [
            item("id_item", "f1", tipo_transaccion="Salida", categoria="Alimento", clase_gasto="x")
        ],
        "catalogo_insumos": [
            item("id_insumo", "i1", categoria="Concentrado", unidad_base="kg", presentacion="Saco",
                 existencia_actual=Decimal(7)),
            item("id_insumo", "i2", categoria="Sal", unidad_base="kg", presentacion="Saco",
                 existencia_actual=Decimal(5)),
        ],
        "movimientos_insumos": [
            fact("mv1", id_insumo="i1", tipo_movimiento="inicial", fecha_movimiento=day,
                 cantidad_base=Decimal(10), costo_total=Decimal("12.50")),
            fact("mv2", id_insumo="i1", tipo_movimiento="merma",
                 fecha_movimiento=date(2026, 3, 18), cantidad_base=Decimal(-3)),
            fact("mv3", id_insumo="i1", tipo_movimiento="compra", fecha_movimiento=day,
                 cantidad_base=Decimal(99), estado_registro="Anulado"),
        ],
        "partos": [
            fact("p1", fecha_parto=day, id_madre="a1", arete_madre="1", sexo_cria="Macho"),
            fact("p2", fecha_parto=day, id_madre="a1", finca_asociada="TEST-UNO"),
        ],
        "salidas": [fact("s1", fecha_salida=day, id_animal="a3", motivo="Venta")],
        "palpamientos": [
            fact("q1", fecha_palpamiento=day, id_animal="a1", resultado="PreÃ±ada"),
            fact("q2", fecha_palpamiento=day, id_animal="a1", resultado="VacÃ­a Anestro"),
        ],
        "tratamientos": [
            fact("r1", fecha_tratamiento=day, id_animal="a1", medicina="d1", dias_retiro=3)
        ],
        "pesaje_leche": [
            fact("w1", fecha_pesaje=day, ordeno="MaÃ±ana", id_animal="a1",
                 arete_animal="1", litros=Decimal("8.5")),
            fact("w2", fecha_pesaje=day, ordeno="Tarde", id_animal="a1", arete_animal="1",
                 litros=Decimal("4.5")),
            fact("w3", fecha_pesaje=day, ordeno="Tarde", id_animal="a2", arete_animal=None,
                 litros=Decimal(1)),
            fact("w4", fecha_pesaje=day, ordeno="Tarde", id_animal="a3", arete_animal=None,
                 litros=Decimal(2)),
        ],
        "transacciones_financieras": [
            fact("x1", fecha_transaccion=day, tipo_transaccion="Salida", monto_total=Decimal("3.10")),
            fact("x2", fecha_transaccion=day, id_finca="finca_trebol", tipo_transaccion="Salida",
                 monto_total=Decimal(1)),
            fact("x3", fecha_transaccion=day, id_finca=None, tipo_transaccion="Salida",
                 monto_total=Decimal(1)),
        ],
        "venta_leche": [
            fact("y1", fecha_pago=day, litros_entrega=Decimal(100), valor_entrega_neta=Decimal(60))
        ],
        "composicion_leche": [
            fact("z1", fecha_muestra=day, composicion_grasa=Decimal("3.9")),
            fact("z2", fecha_muestra=date(2026, 3, 16), composicion_grasa=Decimal("4.1")),
        ],
        "microbiologia_leche": [
            fact("n1", fecha_muestra=day, microbiologia_muestra=Decimal(10)),
            fact("n2", fecha_muestra=day, microbiologia_muestra=Decimal(20)),
            fact("n3", fecha_muestra=date(2026, 3, 17), microbiologia_muestra=Decimal(30)),
        ],
    }


def frame(spark, name: str, dicts: list[dict]):
    table = raw_table(name)
    schema = table.schema
    if schema is None:  # declared, never staged: only its load stamp is known
        kind = TimestampNTZType() if table.is_fact else DateType()
        schema = StructType([StructField(table.loaded_at, kind)])
    return spark.createDataFrame([tuple(d.get(c) for c in schema.names) for d in dicts], schema)


def raw_zone(spark, content: dict[str, list[dict]]) -> RawZone:
    frames = {t.table: frame(spark, t.name, content.get(t.name, [])) for t in RAW_TABLES}
    return RawZone(frames.__getitem__)
