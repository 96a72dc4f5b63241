"""Feeds as data: typed target columns, keys, reject rules, and the cleaner of each type.

A feed's landing table has the same column names, all text. To add a feed, declare one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.functions import dates, numbers, places, text

Cleaner = Callable[[Column, str], Column]

# --- fixed values: target schemas ---------------------------------------------------------
# Bills: 86 columns in store order; those not listed below the order are decimal(18,2).
BILL_ORDER = """
num_recibo cod_suministro tarifa pot_contr titularidad distribuidor
fec_emision fec_vencimiento fec_lect_actual fec_lect_anterior per_consumo
ea_lec_act_hp ea_lec_act_fp ea_lec_act_tot ea_lec_ant_hp ea_lec_ant_fp ea_lec_ant_tot
ea_consumo_hp ea_consumo_fp ea_consumo_tot ea_pu_hp ea_pu_fp ea_prec_unit_tot
ea_importe_hp ea_importe_fp ea_importe_tot
pot_lect_act_hp pot_lect_act_fp pot_lect_ant_hp pot_lect_ant_fp pot_reg_hp pot_reg_fp
pot_gen_fact pot_gen_pu pot_gen_importe pot_dist_fact pot_dist_pu pot_dist_importe
pot_bt6_pu pot_bt6_monto
er_lec_act er_lec_ant er_cons er_fact er_pu er_importe
calif_cliente dias_punta horas_punta factor_calif
cargo_fijo mantenimiento alumbrado recup_energia mora reconexion ajuste_tarifa
dist_factura ajuste_alumb otros_afectos base_imponible igv tot_periodo
electrif_rural comp_distribucion comp_generadora comp_interrup comp_calidad
comp_frec_ant comp_frec_des comp_serv comp_norma_tec comp_deuda_ant comp_deuda_meses
comp_dev_reclamo comp_nota_deb_cred comp_aporte_reemb comp_otros_inafectos
comp_redondeo_act_pos comp_redondeo_act_neg
costo_medio total_a_pagar valor_venta deuda_anterior devolucion fecha_liquidacion
""".split()
BILL_TEXTS = {
    "num_recibo": 250, "cod_suministro": 250, "tarifa": 10, "pot_contr": 255, "titularidad": 255,
    "distribuidor": 255, "per_consumo": 50, "calif_cliente": 100, "factor_calif": 50,
}
BILL_DATES = "fec_emision fec_vencimiento fec_lect_actual fec_lect_anterior fecha_liquidacion".split()
BILL_PRICES = "ea_pu_hp ea_pu_fp ea_prec_unit_tot pot_gen_pu pot_dist_pu pot_bt6_pu er_pu".split()
BILL_COUNTS = "dias_punta horas_punta comp_deuda_meses".split()

PAYMENT = {
    "nota_al_aprobador_char_40": "text(250)", "concesionario": "text(255)", "ruc_concesionario": "bigint",
    "numero_suministro": "text(255)", "recibo": "key(255)", "total_pagado": "decimal(18,2)",
    "fecha_emision": "date", "fecha_vencimiento": "date", "periodo_consumo": "text(255)", "archivo": "text(255)",
}

# Older payments: 86 columns in store order; those not listed below the order are text(255).
OLD_PAYMENT_ORDER = """
contador_pedido organizacion_compra grupo_compra sociedad nota_al_aprobador_char_40
nombre_pedido_char_40 material texto_breve_del_material cantidad fecha_de_entrega ruc_proveedor
condicion_de_pago centro tipo_posicion tipo_imputacion centro_costo orden elemento_pep area_funcional
linea_negocio segmento grupo_segmento sub_segmento indicador_de_impuestos moneda licitacion precio_neto
solicitante uno dos tres cuatro cinco seis siete ocho nueve diez once proveedor_flm numero_de_hoja
concesionario ruc_concesionario tercero tipo_recibo zonal cliente numero_documento numero_suministro
nombre_local direccion_local servicio recibo original tipo_recibo_2 tipo_voucher porcentaje_voucher
importe_voucher base_imponible pago_inafectos valor_venta_total igv total_pagado fecha_emision
fecha_vencimiento periodo_consumo mes_facturacion periodo_reporte observacion clase numero_sap neteo cesta
orden_de_compra certificacion soles_comparativo unnamed_76 codigo_unico_local cuenta fe_valor mon
importe_en_md texto asignacion deuda_mes_anterior total_pagado_recibo
""".split()
OLD_PAYMENT_COUNTS = """
contador_pedido grupo_compra sociedad material cantidad fecha_de_entrega ruc_proveedor orden
ruc_concesionario soles_comparativo codigo_unico_local cuenta total_pagado_recibo
""".split()
OLD_PAYMENT_AMOUNTS = """
precio_neto importe_voucher base_imponible pago_inafectos valor_venta_total igv total_pagado importe_en_md
deuda_mes_anterior
""".split()
OLD_PAYMENT_DATES = "fecha_emision fecha_vencimiento fe_valor".split()
OLD_PAYMENT_SHORT = """
organizacion_compra nota_al_aprobador_char_40 nombre_pedido_char_40 condicion_de_pago tipo_posicion
tipo_imputacion centro_costo elemento_pep moneda licitacion unnamed_76 mon asignacion
""".split()

SITE_TEXTS = {
    "nombre_local": 200, "direccion": 350, "ubigeo": 10, "departamento": 120, "provincia": 120,
    "distrito": 120, "tipo_local": 120, "proveedor_flm": 150, "atencion": 120, "zona": 120,
    "tipo_zona_flm": 120, "propietario_de_torre": 150, "propietario_de_piso": 150, "tipo_estacion": 120,
    "tipo_torre": 120, "clasificacion_instalacion": 150, "bucket": 80, "sla": 80, "tipo_vip": 80,
    "criticidad_local": 80, "observacion": 500, "priorizacion": 80,
}
SITE_CHANGE_TEXTS = {
    "accion": 15, "solicitado_por": 120, "campo_modificado": 150, "observaciones": 450, "estado": 20,
}

METER_HEADERS = {
    "site_name": "Site Name", "subnet": "SubNet", "manage_object": "ManageObject", "start_time": "Start Time",
    "energy_consumption_per_hour_kwh": "Energy Consumption per Hour/kWh",
    "supply_duration_per_hour_h": "Supply Duration per Hour/h",
    "total_energy_consumption_kwh": "Total Energy Consumption/kWh",
}

SUPPLY = """
cod_unico_ing id_sum suministro_actual servicios tarifa local direccion distribuidor proveedor
sistema_electrico alimentador tipo_conexion potencia_contratada estado_suministro departamento
provincia distrito tipo_distribuidor motivo_desactivacion grupo_serv region latitud longitud ceco
tipo_tercero flm_actual grupo_debito ipt
""".split()

FIELD_TEXTS = """
tecnico nro_toa subtipo_de_actividad numero_de_peticion localidad direccion nombre_cliente notas
codigo_de_cliente empresa bucket_inicial usuario_iniciado nombre_distrito sistema_origen id_del_ticket
quiebres motivo_pr1 motivo_pr2 motivo_pr3 motivo_pr4 nombre_local tipo_de_local zona_geografica zona
estado_toa duracion_pr1 duracion_pr2 duracion_pr3 duracion_pr4 estado
codigo_completado_reparacion_y_preventivo_cable cliente_acepta_solucion_anticipada_de_reclamo
averia_efectiva_marca_sar_t
""".split()
FIELD_TIMES = """
sla_inicio sla_fin hora_de_asignacion_de_actividad fecha_de_registro_de_actividad_toa
fecha_hora_de_cancelacion fecha_de_inicio_pint inicio_pr1 fin_pr1 inicio_pr2 fin_pr2 inicio_pr3 fin_pr3
inicio_pr4 fin_pr4
""".split()

ORDER_TIMES = """
createtime dispatch_time accept_time depart_time arrive_time complete_time first_complete_time
cancel_time fault_first_occur_time schedule_time
""".split()
ORDER_TEXTS = """
task_id require_finish_time cancel_operator cancel_reason task_status com_fault_speciality
com_fault_sub_speciality com_fault_cause leave_observations site_id site_priority title description
nro_toa company_supply zona departamento torrero task_type fm_office region site_id_name
site_location_type sla_status suspend_state create_operator schedule_operator assign_to_fme
assign_to_fme_full_name dispatch_operator depart_operator arrive_operator complete_operator reject_time
reject_operator reject_des com_level_1_aff_equip com_level_2_aff_equip com_level_3_aff_equip fault_type
task_category task_subcategory fme_contrator contratista_sitio complete_operator_name
reject_operator_name arrive_operator_name depart_operator_name dispatch_operator_name
cancel_operator_name schedule_operator_name create_operator_name situacion_encontrada
detalle_de_actuacion_realizada atencion_incidencias remedy_id reject_flag fuel_type
""".split()
# ------------------------------------------------------------------------------------------


def _bill_columns(receipt: str = "key(250)", code: str = "key(250)") -> dict[str, str]:
    def kind(name: str) -> str:
        if name in BILL_TEXTS:
            return f"text({BILL_TEXTS[name]})"
        if name in BILL_DATES:
            return "date"
        if name in BILL_COUNTS:
            return "int"
        return "decimal(18,6)" if name in BILL_PRICES else "decimal(18,2)"

    return {name: kind(name) for name in BILL_ORDER} | {"num_recibo": receipt, "cod_suministro": code}


def _old_payment_columns() -> dict[str, str]:
    kinds = dict.fromkeys(OLD_PAYMENT_ORDER, "text(255)")
    kinds |= dict.fromkeys(OLD_PAYMENT_COUNTS, "bigint") | dict.fromkeys(OLD_PAYMENT_AMOUNTS, "decimal(18,2)")
    kinds |= dict.fromkeys(OLD_PAYMENT_DATES, "date") | dict.fromkeys(OLD_PAYMENT_SHORT, "text(250)")
    return kinds | {"recibo": "key(255)", "texto": "blank"}


def _site_columns(code: str) -> dict[str, str]:
    columns = {"codigo_unico": code} | {c: f"text({n})" for c, n in SITE_TEXTS.items()}
    return columns | {"latitud": "degrees", "longitud": "degrees", "fecha_puesta_en_servicio": "date"}


def _pauses() -> dict[str, str]:
    columns = {}
    for n in ("first", "second", "third", "fourth", "fifth"):
        columns |= {f"{n}_pause_time": "timestamp", f"{n}_pause_reason": "text", f"{n}_pause_operator": "text"}
        columns |= {f"{n}_resume_time": "timestamp", f"{n}_resume_operator": "text"}
    return columns


def _length(kind: str) -> int | None:
    return int(kind[kind.index("(") + 1 : -1]) if "(" in kind else None


def _text(clean: Callable[[Column, int | None], Column]) -> Cleaner:
    return lambda c, kind: clean(c, _length(kind))


BILL_CLEANERS: dict[str, Cleaner] = {
    "key": _text(text.text_token),
    "text": _text(text.text_nan),
    "blank": _text(text.text_blank),
    "date": lambda c, _: dates.date_slash_or_iso(c),
    "decimal": lambda c, kind: numbers.try_numeric(c, kind),
    "int": lambda c, _: numbers.truncated_int(c, "int"),
    "bigint": lambda c, _: numbers.truncated_int(c, "bigint"),
}
WEB_CLEANERS = BILL_CLEANERS | {"date": lambda c, _: dates.date_any_separator(c)}
EXACT_CLEANERS: dict[str, Cleaner] = {
    "key": _text(text.text_token),
    "text": _text(text.text_blank),
    "date": lambda c, _: dates.date_exact(c),
    "decimal": lambda c, kind: numbers.decimal_comma(c, kind),
    "int": lambda c, _: numbers.signed_int(c, "int"),
    "bigint": lambda c, _: numbers.signed_int(c, "bigint"),
    "kept": _text(text.text_kept),
    "flag": lambda c, kind: text.text_flag(c, _length(kind)),
}
SITE_CLEANERS = EXACT_CLEANERS | {"degrees": lambda c, _: numbers.guarded_decimal(c, "decimal(11,8)")}
CHANGE_CLEANERS = EXACT_CLEANERS | {"degrees": lambda c, _: places.coordinate(c)}
FIELD_CLEANERS: dict[str, Cleaner] = {
    "text": _text(text.text_blank),
    "date": lambda c, _: dates.date_short_year(c),
    "timestamp": lambda c, _: dates.timestamp_field(c),
    "decimal": lambda c, kind: numbers.guarded_decimal(c, kind),
    "int": lambda c, _: numbers.digits_int(c),
}
ORDER_CLEANERS: dict[str, Cleaner] = {
    "text": _text(text.text_blank),
    "timestamp": lambda c, _: dates.timestamp_order(c),
    "bigint": lambda c, _: numbers.signed_int(c),
}

_STORED = {
    "key": "string", "text": "string", "blank": "string", "kept": "string", "flag": "string", "timestamp": "timestamp_ntz",
    "degrees": "decimal(11,8)",
}


def _stored(kind: str) -> str:
    """Spark type of a column kind."""
    return _STORED.get(kind.split("(")[0], kind)


#: Who first stored a row, and when; updates leave them.
AUDIT = {"creation_user": "string", "creation_date": "timestamp_ntz"}


@dataclass(frozen=True)
class Feed:
    """``key`` identifies a stored row; ``dup_key`` names the raw columns whose repeats are rejected."""

    source: str
    columns: Mapping[str, str]
    cleaners: Mapping[str, Cleaner]
    key: tuple[str, ...]
    strategy: str
    dup_key: tuple[str, ...] = ()
    dup_normalised: bool = False
    rules: tuple[str, ...] = ()
    latest_by: str | None = None

    def clean(self, landing: DataFrame, *carry: str) -> DataFrame:
        """Typed columns in store order; a column absent from the landing table is NULL."""
        have = set(landing.columns)
        typed = []
        for name, kind in self.columns.items():
            if name in have or kind.startswith("flag"):  # a flag is never NULL
                raw = F.col(name) if name in have else F.lit(None).cast("string")
                value = self.cleaners[kind.split("(")[0]](raw, kind)
            else:
                value = F.lit(None).cast(_stored(kind))
            typed.append(value.alias(name))
        return landing.select(*typed, *carry)

    def untyped(self) -> Column:
        """Whether a part of the key has a text, but none that its type can hold. A null token is such a
        text, unless the feed rejects it by a rule of its own."""
        spoilt, empty = F.lit(False), text.is_missing if "missing" in self.rules else text.is_blank
        for name in self.key:
            kind = self.columns[name]
            raw = F.col(name)
            spoilt |= ~empty(raw) & self.cleaners[kind.split("(")[0]](raw, kind).isNull()
        return spoilt

    def lost(self, landing: DataFrame) -> Column:
        """The columns, with their texts, that cleaning makes NULL though they say something."""
        told = []
        for name, kind in self.columns.items():
            if name in landing.columns and _stored(kind) != "string":
                raw = F.col(name)
                fails = ~text.is_missing(raw) & self.cleaners[kind.split("(")[0]](raw, kind).isNull()
                told.append(F.when(fails, F.struct(F.lit(name).alias("columna"), raw.cast("string").alias("valor"))))
        none = F.lit(None).cast("struct<columna:string,valor:string>")
        return F.array_compact(F.array(none, *told))

    def schema(self) -> StructType:
        """Schema of the typed store."""
        columns = {name: _stored(kind) for name, kind in self.columns.items()} | AUDIT
        return StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in columns.items()))


BILLS = Feed(
    "raw.bills", _bill_columns(), BILL_CLEANERS, ("num_recibo",), "insert_new",
    dup_key=("num_recibo", "per_consumo"), rules=("invalid", "missing"),
)
WEB_BILLS = Feed(
    "raw.web_bills", _bill_columns(code="text(250)"), WEB_CLEANERS, ("num_recibo",), "upsert",
    dup_key=("num_recibo", "per_consumo"),
)
WEB_BILLS_INSERT = replace(WEB_BILLS, strategy="insert_new")
FREE_CLIENTS = Feed(
    "raw.free_clients", _bill_columns(receipt="bigint"), EXACT_CLEANERS, ("num_recibo", "per_consumo"),
    "upsert_changed", dup_key=("num_recibo", "per_consumo"),
)
PAYMENTS = Feed(
    "raw.payments", PAYMENT, BILL_CLEANERS, ("recibo",), "upsert", dup_key=("recibo",), rules=("missing",)
)
PAYMENTS_INSERT = replace(PAYMENTS, columns=_old_payment_columns(), strategy="insert_new", dup_normalised=True)
PAYMENTS_INSERT_EXACT = replace(PAYMENTS_INSERT, source="raw.payments_exact", dup_normalised=False)
WORK_ORDERS = Feed(
    "raw.work_orders",
    dict.fromkeys(ORDER_TEXTS, "text") | dict.fromkeys(ORDER_TIMES, "timestamp") | _pauses()
    | {"sla": "bigint", "reject_counter": "bigint"},
    ORDER_CLEANERS, ("task_id",), "upsert",
)
WORK_ORDERS_INSERT = replace(WORK_ORDERS, strategy="insert_new")
FIELD_SERVICE = Feed(
    "raw.field_service",
    dict.fromkeys(FIELD_TEXTS, "text") | dict.fromkeys(FIELD_TIMES, "timestamp")
    | {"id_recurso": "int", "fecha_de_cita": "date"}
    | {"direccion_polar_x": numbers.WIDE, "direccion_polar_y": numbers.WIDE},
    FIELD_CLEANERS, ("nro_toa",), "refresh_latest", latest_by="fecha_de_registro_de_actividad_toa",
)
SITES = Feed(
    "raw.sites", _site_columns("kept(120)") | {"ubigeotoa": "text(120)"}, SITE_CLEANERS, (), "refresh"
)
SITE_CHANGES = Feed(
    "raw.site_changes",
    _site_columns("text") | {c: f"text({n})" for c, n in SITE_CHANGE_TEXTS.items()} | {"base": "flag(6)"},
    CHANGE_CLEANERS, (), "refresh",
)
