"""Schemas of the engine's own tables; they are never inferred."""

DIRECTORY = (
    "eval_id string, comuna_id int, tipo_evaluacion_id int, identificacion_vivienda string, tipologia string, proyecto string, "
    "calificacion_energetica_letra string, calificacion_equipos_letra string, codigo_informe string, codigo_etiqueta string, "
    "pdf_status string, report_version int, retry_count bigint, last_error string, last_processed_at timestamp, "
    "synced_at timestamp, last_seen_at timestamp"
)
PROGRESS = (
    "comuna_id int, tipo_evaluacion_id int, region_id int, status string, pages_done int, total_pages int, rows_new int, "
    "rows_seen int, early_stopped boolean, last_error string, updated_at timestamp"
)
LAYOUT_SPANS = "doc_id string, page_no int, page_w double, page_h double, x0 double, y0 double, x1 double, y1 double, font_size double, text string"
FIELD_BOXES = "page_no int, field string, x1 double, y1 double, x2 double, y2 double"
GLYPHS = "doc_id string, month int, series string, hour int, ord int, is_comma boolean, pixels array<float>"
TEMPLATES = "label string, exemplar_no int, exemplar array<double>"
OUTCOMES = "eval_id string, page_count int, extract_error string, valid boolean"
