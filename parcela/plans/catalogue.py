"""What stands where on a report's pages, and how it is read."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from parcela.operators.layout import MONTHLY_METRICS, TWO_MONTH_PARAMETERS

#: The fields of the pages with single values, their boxes in millimetres (left, top,
#: right, bottom of a page of 215.9 x 330) and kinds. Kinds: ``text``, ``line`` (text with its line feeds as blanks),
#: ``number`` (the first line that is one), ``last`` (the number of the last line), ``unit`` (a number before its unit),
#: ``integer`` (the first line that is one), ``date`` (that of the last line), ``block`` (a number a line), ``label``.
FIELDS = """
page 1
tipo_evaluacion 8.3 9.0 165.6 18.8 text
codigo_evaluacion 73.1 20.0 97.1 25.1 text
region 28.0 26.6 165.3 31.8 text
comuna 29.2 33.0 165.3 38.2 text
direccion 31.3 39.1 165.3 44.3 text
rol_vivienda_proyecto 55.5 45.6 165.3 50.8 text
tipo_vivienda 43.7 51.7 165.3 56.9 text
superficie_interior_util_m2 53.0 58.3 75.0 63.5 number
porcentaje_ahorro 5.6 78.6 165.8 191.3 integer
demanda_calefaccion_kwh_m2_ano 15.6 220.0 73.0 230.0 last
demanda_enfriamiento_kwh_m2_ano 90.0 220.0 151.5 230.0 last
demanda_total_kwh_m2_ano 167.0 225.0 209.0 245.0 last
emitida_el 34.5 247.0 57.5 252.8 date
page 2
region 40.4 47.4 95.0 51.7 line
comuna 40.4 53.2 95.0 57.4 line
direccion 40.4 58.9 95.0 63.1 line
rol_vivienda 40.4 64.6 95.0 68.9 line
tipo_vivienda 40.4 70.2 95.0 74.4 line
zona_termica 143.1 47.5 154.0 51.7 line
superficie_interior_util_m2 143.1 53.3 154.0 57.5 number
solicitado_por 143.1 58.9 210.5 63.1 line
evaluado_por 143.1 64.7 210.5 68.9 line
codigo_evaluacion 143.1 70.2 163.0 74.5 line
demanda_calefaccion_kwh_m2_ano 98.7 98.7 109.5 105.2 last
demanda_enfriamiento_kwh_m2_ano 98.7 120.9 109.5 126.5 last
demanda_total_kwh_m2_ano 98.6 137.0 136.0 149.5 last
demanda_total_bis_kwh_m2_ano 39.2 159.8 122.8 166.0 last
demanda_total_referencia_kwh_m2_ano 16.9 168.3 146.2 173.2 last
porcentaje_ahorro 151.0 162.6 201.5 168.7 last
muro_principal_descripcion 46.2 202.5 184.5 209.2 line
muro_principal_exigencia_w_m2_k 185.5 202.5 209.5 209.2 unit
muro_secundario_descripcion 46.2 209.5 184.5 216.2 line
muro_secundario_exigencia_w_m2_k 185.5 209.5 209.5 216.2 unit
piso_principal_descripcion 46.2 216.5 184.5 223.2 line
piso_principal_exigencia_w_m2_k 185.5 216.5 209.5 223.2 unit
puerta_principal_descripcion 46.2 223.5 184.5 230.2 line
puerta_principal_exigencia_w_m2_k 185.5 223.5 209.5 230.2 line
techo_principal_descripcion 46.2 230.5 184.5 237.0 line
techo_principal_exigencia_w_m2_k 185.5 230.5 209.5 237.0 unit
techo_secundario_descripcion 46.2 237.6 184.5 244.1 line
techo_secundario_exigencia_w_m2_k 185.5 237.6 209.5 244.1 unit
superficie_vidriada_principal_descripcion 46.2 244.6 184.5 251.2 line
superficie_vidriada_principal_exigencia 185.5 244.6 209.5 251.2 line
superficie_vidriada_secundaria_descripcion 46.2 251.6 184.5 258.2 line
superficie_vidriada_secundaria_exigencia 185.5 251.6 209.5 258.2 line
ventilacion_rah_descripcion 46.2 258.6 184.5 265.2 line
ventilacion_rah_exigencia 185.5 258.6 209.5 265.2 line
infiltraciones_rah_descripcion 46.2 265.6 184.5 272.2 line
infiltraciones_rah_exigencia 185.5 265.6 209.5 272.2 line
page 3
codigo_evaluacion 62.3 30.7 88.1 36.0 line
agua_caliente_sanitaria_kwh_m2 79.2 73.4 98.3 77.0 number
agua_caliente_sanitaria_per 99.4 73.4 117.3 77.0 number
iluminacion_kwh_m2 79.2 77.7 98.3 81.9 number
iluminacion_per 98.7 77.7 117.3 81.9 number
calefaccion_kwh_m2 79.2 82.3 98.3 86.5 number
calefaccion_kwh_per 98.7 82.3 117.3 86.5 number
energia_renovable_no_convencional_kwh_m2 79.2 87.0 98.3 91.2 number
energia_renovable_no_convencional_per 98.7 87.0 117.3 91.2 number
consumo_total_kwh_m2 118.0 74.0 149.3 86.0 number
emisiones_kgco2_m2_ano 171.5 69.0 184.3 74.2 number
calefaccion_descripcion_proy 76.6 101.4 155.5 105.3 line
calefaccion_consumo_proy_kwh 157.0 101.4 196.0 105.3 last
calefaccion_consumo_proy_per 198.0 101.4 209.0 105.3 last
iluminacion_descripcion_proy 76.6 106.2 155.5 110.0 line
iluminacion_consumo_proy_kwh 157.0 106.2 196.0 110.0 last
iluminacion_consumo_proy_per 198.0 106.2 209.0 110.0 last
agua_caliente_sanitaria_descripcion_proy 76.6 111.2 155.5 115.0 line
agua_caliente_sanitaria_consumo_proy_kwh 157.0 111.2 196.0 115.0 last
agua_caliente_sanitaria_consumo_proy_per 198.0 111.2 209.0 115.0 last
energia_renovable_no_convencional_descripcion_proy 76.6 115.8 155.5 120.0 line
energia_renovable_no_convencional_consumo_proy_kwh 157.0 115.8 196.0 120.0 last
energia_renovable_no_convencional_consumo_proy_per 198.0 115.8 209.0 120.0 last
consumo_total_requerido_proy_kwh 157.0 121.0 196.0 125.0 last
calefaccion_descripcion_ref 76.6 136.1 155.5 140.1 line
calefaccion_consumo_ref_kwh 157.0 136.1 196.0 140.1 last
calefaccion_consumo_ref_per 198.0 136.1 209.0 140.1 last
iluminacion_descripcion_ref 76.6 140.7 155.5 144.7 line
iluminacion_consumo_ref_kwh 157.0 140.7 196.0 144.7 last
iluminacion_consumo_ref_per 198.0 140.7 209.0 144.7 last
agua_caliente_sanitaria_descripcion_ref 76.6 145.5 155.5 149.9 line
agua_caliente_sanitaria_consumo_ref_kwh 157.0 145.5 196.0 149.9 last
agua_caliente_sanitaria_consumo_ref_per 198.0 145.5 209.0 149.9 last
energia_renovable_no_convencional_descripcion_ref 76.6 150.3 155.5 155.1 line
energia_renovable_no_convencional_consumo_ref_kwh 157.0 150.3 196.0 155.1 last
energia_renovable_no_convencional_consumo_ref_per 198.0 150.3 209.0 155.1 last
consumo_total_requerido_ref_kwh 157.0 155.5 196.0 161.0 last
consumo_ep_calefaccion_kwh 87.0 176.0 104.0 179.5 number
consumo_ep_agua_caliente_sanitaria_kwh 87.0 180.0 104.0 183.5 number
consumo_ep_iluminacion_kwh 87.0 184.0 104.0 187.5 number
consumo_ep_ventiladores_kwh 87.0 188.0 104.0 191.5 number
generacion_ep_fotovoltaicos_kwh 87.0 199.0 104.0 202.3 number
aporte_fotovoltaicos_consumos_basicos_kwh 87.0 202.8 104.0 206.4 number
diferencia_fotovoltaica_para_consumo_kwh 87.0 206.9 104.0 210.2 number
aporte_solar_termica_calefaccion_kwh 87.0 218.5 104.0 222.0 number
aporte_solar_termica_agua_caliente_sanitaria_kwh 87.0 222.5 104.0 225.8 number
total_consumo_ep_antes_fotovoltaica_kwh 192.0 176.0 208.0 179.5 number
aporte_fotovoltaicos_consumos_basicos_kwh_bis 192.0 180.0 208.0 183.5 number
consumos_basicos_a_suplir_kwh 192.0 183.9 208.0 187.3 number
consumo_total_ep_obj_kwh 192.0 199.0 208.0 202.5 number
consumo_total_ep_ref_kwh 192.0 202.8 208.0 206.5 last
coeficiente_energetico_c 192.0 207.0 208.0 210.5 number
opacos_area 19.8 245.6 47.6 287.3 block
opacos_u 48.7 245.6 60.8 287.3 block
traslucidos_area 68.4 245.6 89.7 283.0 block
traslucidos_u 90.8 245.6 103.1 283.0 block
page 6
codigo_evaluacion 62.3 30.7 88.1 36.0 text
enero 64.5 97.7 173.2 103.1 label
abril 64.6 152.5 173.8 157.8 label
julio 66.4 211.8 174.0 217.5 label
octubre 65.8 271.0 174.5 276.4 label
page 7
codigo_evaluacion 62.3 30.7 88.1 36.0 text
mandante_nombre 27.5 90.6 96.0 94.5 text
mandante_rut 27.5 95.2 96.0 99.0 text
evaluador_nombre 131.1 90.6 209.3 94.5 text
evaluador_rut 131.1 95.2 209.3 99.0 text
evaluador_rol_minvu 150.0 99.9 171.0 103.7 text
"""

#: Top and bottom of each row of the monthly page, left of its first month, and the way from month
#: to month; then the heights of the rows of the two-month page and its two columns.
MONTHLY_ROWS = ((139.5, 143.5), (144.0, 148.0), (161.4, 165.5), (166.0, 170.2), (254.8, 258.8), (259.5, 263.4), (274.8, 278.8), (279.2, 283.3))
MONTHLY_LEFT, MONTHLY_STEP, MONTHLY_WIDTH = 42.0, 13.5, 12.0
TWO_MONTH_CENTRES = (189.3, 194.9, 200.3, 205.7, 211.0, 216.6, 222.0, 227.3, 232.6, 237.9)
TWO_MONTH_COLUMNS = {"enero": (47.0, 60.0), "julio": (78.0, 91.0)}
CODE_BOX = (62.3, 30.7, 88.1, 36.0)

#: Fixed values of the envelope table: left and right of the thermal bridges and of the totals, the first row's top, the way from row to
#: row, a row's height, and the rows.
BRIDGES = {"p01_w_k": (115.5, 124.5), "p02_w_k": (126.2, 136.9), "p03_w_k": (139.0, 148.2), "p04_w_k": (149.0, 160.0), "p05_w_k": (161.3, 171.2)}
BRIDGE_ROWS = (250.0, 4.2, 3.5, 8)
TOTALS, TOTAL_ROWS = (189.2, 201.9), (245.5, 3.5, 3.5, 12)


class Field(NamedTuple):
    page: int
    name: str
    box: tuple[float, float, float, float]
    kind: str


def _listed() -> list[Field]:
    out, page = [], 0
    for words in (line.split() for line in FIELDS.strip().splitlines()):
        if words[0] == "page":
            page = int(words[1])
        else:
            out.append(Field(page, words[0], tuple(float(w) for w in words[1:5]), words[5]))
    return out


def _monthly() -> list[Field]:
    left = [MONTHLY_LEFT + MONTHLY_STEP * i for i in range(12)]
    cells = [(f"{m}_mes_{i + 1}", (x, top, x + MONTHLY_WIDTH, bottom)) for m, (top, bottom) in zip(MONTHLY_METRICS, MONTHLY_ROWS, strict=True) for i, x in enumerate(left)]
    return [Field(4, "codigo_evaluacion", CODE_BOX, "text"), *[Field(4, n, box, "number") for n, box in cells]]


def _two_months() -> list[Field]:
    rows = list(zip(TWO_MONTH_PARAMETERS, TWO_MONTH_CENTRES, strict=True))
    cells = [(f"{p}_{month}_kwh", (x1, round(y - 1.6, 1), x2, round(y + 1.2, 1))) for p, y in rows for month, (x1, x2) in TWO_MONTH_COLUMNS.items()]
    return [Field(5, "codigo_evaluacion", CODE_BOX, "text"), *[Field(5, n, box, "number") for n, box in cells]]


def _column(name: str, x: tuple[float, float], rows: tuple[float, float, float, int]) -> list[Field]:
    top, step, height, n = rows
    return [Field(3, f"{name}_{i}", (x[0], top + step * i, x[1], top + step * i + height), "cell") for i in range(n)]


def fields(page: int) -> list[Field]:
    """The fields of a page, in their order; those of pages 4 and 5 and of the envelope's columns follow from rules."""
    if page == 4:
        return _monthly()
    if page == 5:
        return _two_months()
    found = [f for f in _listed() if f.page == page]
    if page == 3:
        for name, x in BRIDGES.items():
            found += _column(name, x, BRIDGE_ROWS)
        found += _column("ua_mas_phi_l", TOTALS, TOTAL_ROWS)
    return found


def single(page: int) -> dict[str, str]:
    """Name and kind of a page's single values."""
    return {f.name: f.kind for f in fields(page) if f.kind not in ("block", "cell", "label")}


def boxes(spark: SparkSession, *pages: int) -> DataFrame:
    """The field boxes of these pages, or of all seven: some 200 rows, whatever the number of reports."""
    rows = [(f.page, f.name, *f.box) for p in (pages or range(1, 8)) for f in fields(p)]
    return spark.createDataFrame(rows, "page_no int, field string, x1 double, y1 double, x2 double, y2 double")
