"""DuckDB counterparts of the registered queries, over the same base tables.

Each statement is assembled from named building blocks; only the blocks a statement mentions,
directly or through others, become its WITH clause."""

from __future__ import annotations

import re

from tradewarden.params import BOND_TICKER, DOLLAR_TICKER, LEVEL_HIGH, LEVEL_LOW, LEVEL_MEDIUM, OPTION_TICKER, WEIGHTS
from tradewarden.plans.datasets import LINE_PARAMS

# The rules' own limits, patterns, weights and texts; how they are applied is stated again below.
OPTION, BOND, DOLLAR = (f"'{x}'" for x in (OPTION_TICKER, BOND_TICKER, DOLLAR_TICKER))
RULES = LINE_PARAMS
WHY = RULES.reasons()


def dec(expr: str, digits: int) -> str:
    """Round half away from zero with six or more digits to spare, then hand out a double."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(32,{max(8, digits + 6)})), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return dec(f"CAST({part} AS DOUBLE) * 100 / NULLIF(CAST({whole} AS DOUBLE), 0)", digits)


def div(part: str, whole: str, digits: int) -> str:
    return dec(f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0)", digits)


def mill(expr: str, digits: int = 1) -> str:
    return dec(f"CAST({expr} AS DOUBLE) / 1e6", digits)


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def cnt(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def prefix(k: str) -> str:
    return (f"CASE WHEN {k} < 10 THEN 'AL30' WHEN {k} < 15 THEN 'AL30D' WHEN {k} < 25 THEN 'GFGC' WHEN {k} < 40 THEN 'GD' "
            f"WHEN {k} < 70 THEN 'CD' WHEN {k} < 80 THEN 'YMC' WHEN {k} < 90 THEN 'TZX' ELSE 'ACC' END")


def title(k: str) -> str:
    return (f"CASE WHEN {k} < 10 THEN 'Bono Rep. Arg. Usd Step Up 2030' WHEN {k} < 15 THEN 'Bono Rep. Arg. 2030 En Dolares' "
            f"WHEN {k} < 25 THEN 'Opcion Compra Galicia' WHEN {k} < 40 THEN 'Global Rep. Arg. Ley NY' "
            f"WHEN {k} < 70 THEN 'Cedear Empresa Extranjera' WHEN {k} < 80 THEN 'Obligacion Negociable Ypf' "
            f"WHEN {k} < 90 THEN 'Letra Ajustable' ELSE 'Accion Ordinaria Escritural' END")


# Argentina was three hours behind UTC throughout the years of the tables.
LOCAL = """fecha_utc - INTERVAL 3 HOUR AS fecha_art, CAST(fecha_utc - INTERVAL 3 HOUR AS DATE) AS dia_art,
  CAST(hour(fecha_utc - INTERVAL 3 HOUR) AS INTEGER) AS hora_art, CAST(isodow(fecha_utc - INTERVAL 3 HOUR) AS INTEGER) AS dow_art"""
TRADE = """id_transaccion, id_cliente, fecha_utc, fecha_art, dia_art, hora_art, dow_art, tipo_tran, descripcion_titulo,
  simbolo_titulo, moneda, origen, cantidad, precio, monto, ms_flag"""
WEEKDAY = "CASE {0} WHEN 1 THEN 'Lun' WHEN 2 THEN 'Mar' WHEN 3 THEN 'Mié' WHEN 4 THEN 'Jue' WHEN 5 THEN 'Vie' WHEN 6 THEN 'Sáb' ELSE 'Dom' END"


def calendar(trades: str, holidays: str) -> str:
    return f"""SELECT d.fecha, CAST(isodow(d.fecha) AS INTEGER) AS dow, h.nombre AS feriado,
  isodow(d.fecha) <= 5 AND h.fecha IS NULL AS es_habil
FROM (SELECT CAST(unnest(generate_series(MIN(dia_art) - INTERVAL 15 DAY, MAX(dia_art) + INTERVAL 15 DAY, INTERVAL 1 DAY)) AS DATE) AS fecha
      FROM {trades}) d LEFT JOIN {holidays} h ON h.fecha = d.fecha"""


def implied(trades: str, least: int) -> str:
    return f"""SELECT dia_art AS fecha, CAST(ROUND(CAST(
    QUANTILE_CONT(CASE WHEN simbolo_titulo = 'AL30' AND moneda = 'ARS' THEN {dbl('precio')} END, 0.5)
    / QUANTILE_CONT(CASE WHEN simbolo_titulo = 'AL30D' AND moneda = 'USD' THEN {dbl('precio')} END, 0.5)
    AS DECIMAL(28,8)), 2) AS DECIMAL(10,2)) AS mep_implicito,
  {cnt("simbolo_titulo = 'AL30'")} AS n_ars, {cnt("simbolo_titulo = 'AL30D'")} AS n_usd
FROM {trades} WHERE simbolo_titulo = 'AL30' OR simbolo_titulo = 'AL30D' GROUP BY dia_art
HAVING {cnt("simbolo_titulo = 'AL30'")} >= {least} AND {cnt("simbolo_titulo = 'AL30D'")} >= {least}"""


def daily_fx(trades: str, cal: str, quotes: str, imp: str) -> str:
    return f"""SELECT y.fecha, COALESCE(venta, mep_implicito, (SELECT arg_min(mep_implicito, fecha) FROM {imp})) AS tc_ars_por_usd,
  CASE WHEN venta IS NULL THEN 'MEP implícito dataset (AL30/AL30D)' ELSE 'API MEP (' || fuente || ')' END AS fuente_tc,
  CASE WHEN venta IS NULL AND mep_implicito IS NULL THEN TRUE
       ELSE q_fecha <> y.fecha OR (q_fecha IS NULL AND m_fecha <> y.fecha) END AS arrastrado
FROM (SELECT x.fecha, x.venta, x.fuente, x.q_fecha, m.fecha AS m_fecha, m.mep_implicito
      FROM (SELECT c.fecha, q.venta, q.fuente, q.fecha AS q_fecha FROM {cal} c ASOF LEFT JOIN {quotes} q ON c.fecha >= q.fecha) x
      ASOF LEFT JOIN {imp} m ON x.fecha >= m.fecha) y
WHERE y.fecha >= (SELECT MIN(dia_art) FROM {trades})"""


def enriched(trades: str, cal: str, fx: str) -> str:
    return f"""SELECT t.*, f.tc_ars_por_usd,
  CASE t.moneda WHEN 'USD' THEN CAST(ROUND(CAST(t.monto AS DECIMAL(18,4)) * CAST(f.tc_ars_por_usd AS DECIMAL(10,2)), 2) AS DECIMAL(28,4))
    ELSE CAST(t.monto AS DECIMAL(28,4)) END AS monto_ars,
  c.es_habil, c.feriado,
  CASE WHEN c.feriado IS NOT NULL THEN 'Feriado' WHEN t.dow_art > 5 THEN 'Fin de semana' ELSE 'Día hábil' END AS tipo_dia,
  CASE WHEN t.hora_art < 6 THEN 'Madrugada (0-6)' WHEN t.hora_art < 11 THEN 'Pre-mercado (6-11)'
       WHEN t.hora_art < 17 THEN 'Mercado (11-17)' ELSE 'Post-mercado (17-24)' END AS franja_horaria,
  CAST(date_trunc('month', t.dia_art) AS DATE) AS mes
FROM {trades} t, {fx} f, {cal} c WHERE f.fecha = t.dia_art AND c.fecha = t.dia_art"""


def smallest_mode(col: str) -> str:
    return f"""SELECT id_cliente, {col} FROM (
  SELECT id_cliente, {col}, ROW_NUMBER() OVER (PARTITION BY id_cliente ORDER BY COUNT(*) DESC, {col}) AS pos
  FROM le GROUP BY id_cliente, {col}) WHERE pos = 1"""


NIGHT = "franja_horaria = 'Madrugada (0-6)'"
OFFDAY = "tipo_dia <> 'Día hábil'"
BASE = "dia_art BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'"
NEXT1 = "dia_art BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"
NEXT2 = "dia_art BETWEEN DATE '1999-01-01' AND DATE '2001-12-31'"

BLOCKS = {
    # trades from events
    "ev0": """SELECT *, CAST(regexp_extract(props, ': *([0-9]+)', 1) AS BIGINT) AS num FROM events""",
    "ev1": f"""SELECT event_id, user_id, event_type, CAST(ts AS TIMESTAMP) AS fecha_utc, {title('num % 100')} AS descripcion_titulo,
  CASE WHEN num % 100 < 15 THEN {prefix('num % 100')} ELSE {prefix('num % 100')} || CAST(num AS VARCHAR) END AS simbolo_titulo,
  CAST(value AS DECIMAL(14,2)) AS value, event_id % 50 + 1 AS units FROM ev0""",
    "et": f"""SELECT CAST(event_id AS VARCHAR) AS id_transaccion, 'CLI' || CAST(user_id AS VARCHAR) AS id_cliente, fecha_utc, {LOCAL},
  CASE WHEN event_id % 10 < 6 THEN 'Compra' ELSE 'Venta' END AS tipo_tran, descripcion_titulo, simbolo_titulo,
  CASE WHEN simbolo_titulo = 'AL30D' OR event_id % 7 = 0 THEN 'USD' ELSE 'ARS' END AS moneda, event_type AS origen,
  CAST(units AS BIGINT) AS cantidad,
  CAST(value * CASE WHEN simbolo_titulo = 'AL30' THEN 1000 ELSE 1 END AS DECIMAL(18,6)) AS precio,
  CAST(units * value * CASE WHEN simbolo_titulo = 'AL30' THEN 1000 ELSE 1 END AS DECIMAL(18,4)) AS monto,
  CASE WHEN event_id % 2 = 0 THEN '000' ELSE '010' END AS ms_flag FROM ev1""",
    "eh": """SELECT DISTINCT CAST(ts AS DATE) AS fecha, 'Feriado ' || strftime(CAST(ts AS DATE), '%d/%m') AS nombre
FROM events WHERE day(ts) = 1 OR day(ts) = 17""",
    "eq": """SELECT CAST(ts AS DATE) AS fecha, MIN(CAST(value AS DECIMAL(10,2))) + 900 AS compra,
  MAX(CAST(value AS DECIMAL(10,2))) + 900 AS venta, 'events_daily' AS fuente
FROM events WHERE event_type = 'purchase' AND isodow(ts) <= 5 AND day(ts) >= 5 GROUP BY 1""",
    "elog": """SELECT CAST(ts AS TIMESTAMP) AS ts_utc, 'api' || CAST(event_id % 3 AS VARCHAR) AS api,
  '/v1/' || CAST(user_id AS VARCHAR) AS url, CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'OK' END AS estado,
  CASE event_type WHEN 'error' THEN 0 ELSE CAST(floor(value) AS INTEGER) END AS filas,
  CASE event_type WHEN 'error' THEN repeat(props, 12) ELSE '' END AS detalle
FROM events WHERE event_type = 'error' OR event_type = 'signup'""",
    "ecal": calendar("et", "eh"),
    "eimp": implied("et", 5),
    "efx": daily_fx("et", "ecal", "eq", "eimp"),
    "ee": enriched("et", "ecal", "efx"),
    "eq0": "SELECT * FROM eq WHERE fecha IS NULL",
    "eofx": daily_fx("et", "ecal", "eq0", "eimp"),
    # trades from order lines
    "ln0": f"""SELECT l.*, o.o_custkey, o.o_orderpriority, l_partkey % 100 AS k,
  CASE WHEN l_partkey % 100 < 15 THEN {prefix('l_partkey % 100')}
       ELSE {prefix('l_partkey % 100')} || CAST(l_partkey AS VARCHAR) END AS ticker,
  CAST(l_quantity AS BIGINT) AS units,
  CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 100 AS BIGINT) * CASE WHEN l_partkey % 100 < 10 THEN 1000 ELSE 1 END AS cents,
  CAST(l_shipdate AS TIMESTAMP) + to_seconds((l_orderkey * 37 + l_partkey * 11 + l_linenumber * 3607) % 86400) AS fecha_utc
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "lt": f"""SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id_transaccion,
  'CLI' || CAST(o_custkey AS VARCHAR) AS id_cliente, fecha_utc, {LOCAL},
  CASE l_returnflag WHEN 'R' THEN 'Venta' ELSE 'Compra' END AS tipo_tran, {title('k')} AS descripcion_titulo,
  ticker AS simbolo_titulo,
  CASE WHEN ticker = 'AL30D' OR (l_linestatus = 'O' AND l_partkey % 5 = 0) THEN 'USD' ELSE 'ARS' END AS moneda,
  o_orderpriority AS origen, units AS cantidad,
  CAST(CAST((cents * 20000 + units) // (2 * units) AS DECIMAL(18,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(20,6)) AS precio,
  CAST(CAST(cents AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS monto,
  CASE WHEN l_orderkey % 2 = 0 THEN '000' ELSE '010' END AS ms_flag FROM ln0""",
    "lh": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha, 'inamovible' AS tipo,
  CASE strftime(o_orderdate, '%m%d') WHEN '0101' THEN 'Año nuevo' WHEN '0501' THEN 'Día del Trabajador'
    WHEN '0709' THEN 'Día de la Independencia' ELSE 'Navidad' END AS nombre
FROM orders WHERE strftime(o_orderdate, '%m%d') IN ('0101', '0501', '0709', '1225')""",
    "lq": """SELECT CAST(o_orderdate AS DATE) AS fecha,
  ROUND(MIN(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.003 AS DECIMAL(4,3))), 2) AS compra,
  ROUND(MAX(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.003 AS DECIMAL(4,3))), 2) AS venta, 'orders_daily' AS fuente
FROM orders WHERE isodow(o_orderdate) <= 5 AND o_orderdate >= DATE '1995-04-01' GROUP BY 1""",
    "lcal": calendar("lt", "lh"),
    "limp": implied("lt", 1),
    "lfx": daily_fx("lt", "lcal", "lq", "limp"),
    "le": enriched("lt", "lcal", "lfx"),
    "lmode1": smallest_mode("origen"),
    "lmode2": smallest_mode("simbolo_titulo"),
    "lp0": f"""SELECT id_cliente, COUNT(*) AS ops, SUM(monto_ars) AS monto_ars, MAX(monto_ars) AS max_monto_op_ars,
  COUNT(DISTINCT dia_art) AS dias_activos, COUNT(DISTINCT simbolo_titulo) AS simbolos, COUNT(DISTINCT origen) AS canales,
  {pct("SUM(CASE WHEN tipo_tran = 'Compra' THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS pct_compras,
  {cnt(NIGHT)} AS ops_madrugada, {cnt(OFFDAY)} AS ops_dia_inhabil,
  {cnt(BASE)} AS ops_ene, {cnt(NEXT1)} AS ops_feb, {cnt(NEXT2)} AS ops_mar,
  SUM(CASE WHEN {BASE} THEN monto_ars ELSE 0 END) AS monto_ene,
  SUM(CASE WHEN dia_art >= DATE '1996-01-01' THEN monto_ars ELSE 0 END) AS monto_feb_mar
FROM le GROUP BY id_cliente""",
    "lp": """SELECT a.*, b.origen AS canal_principal, c.simbolo_titulo AS simbolo_principal
FROM lp0 a JOIN lmode1 b USING (id_cliente) JOIN lmode2 c USING (id_cliente)""",
    "lu0": f"""SELECT QUANTILE_CONT({dbl('ops')}, 0.99) AS p999_ops, QUANTILE_CONT({dbl('monto_ars')}, 0.99) AS p999_monto_cliente,
  QUANTILE_CONT({dbl('ops')}, 0.5) AS p50_ops, QUANTILE_CONT({dbl('monto_ars')}, 0.5) AS p50_monto_cliente FROM lp""",
    "lu1": f"""SELECT QUANTILE_CONT({dbl('monto_ars')}, 0.99) AS p999_monto_op,
  {cnt(NIGHT)} / COUNT(*) AS base_madrugada, {cnt(OFFDAY)} / COUNT(*) AS base_inhabil FROM le""",
    "lu": "SELECT * FROM lu0, lu1",
    "ld": f"""SELECT {cnt(BASE)} AS dh_ene, {cnt(f"({NEXT1}) OR ({NEXT2})")} AS dh_feb_mar
FROM (SELECT DISTINCT dia_art FROM le WHERE es_habil)""",
    "l1": f"""SELECT lp.*, {div('monto_ars', 'CAST(p50_monto_cliente AS DECIMAL(28,4))', 0)} AS veces_mediana_monto,
  ops >= p999_ops AS por_frecuencia, CAST(monto_ars AS DOUBLE) >= p999_monto_cliente AS por_monto
FROM lp, lu WHERE ops >= p999_ops OR CAST(monto_ars AS DOUBLE) >= p999_monto_cliente""",
    "l2": f"""SELECT id_cliente, canal_principal, ops, ops_madrugada, ops_dia_inhabil,
  {dec('(ops_madrugada - ops * base_madrugada) / sqrt(ops * base_madrugada * (1 - base_madrugada))', 2)} AS z_madrugada,
  {dec('(ops_dia_inhabil - ops * base_inhabil) / sqrt(ops * base_inhabil * (1 - base_inhabil))', 2)} AS z_inhabil,
  {mill('monto_ars', 2)} AS monto_ars_mill FROM lp, lu WHERE ops >= {RULES.p2_min_ops}""",
    "l30": f"""SELECT lp.*, ops_feb + ops_mar AS ops_feb_mar, {div('ops_ene', 'dh_ene', 3)} AS tasa_ene,
  {div('ops_feb + ops_mar', 'dh_feb_mar', 3)} AS tasa_feb_mar,
  {div('(ops_feb + ops_mar) * dh_ene', 'dh_feb_mar * CASE WHEN ops_ene > 1 THEN ops_ene ELSE 1 END', 1)} AS multiplicador_frecuencia,
  CASE WHEN monto_ene > 0 THEN {div('monto_feb_mar', 'monto_ene', 1)} END AS multiplicador_monto FROM lp, ld""",
    "l31": f"""SELECT *, ops_ene <= {RULES.p3_few_ops} AND ops_feb_mar >= {RULES.p3_many_ops}
    AND multiplicador_frecuencia >= {RULES.p3_rate_ratio} AS por_frecuencia,
  ops_ene > 0 AND monto_feb_mar >= {RULES.p3_min_amount} AND monto_feb_mar >= monto_ene * {RULES.p3_amount_ratio} AS por_monto,
  ops_ene = 0 AS sin_actividad_en_enero FROM l30""",
    "l3": f"""SELECT *, CASE WHEN por_frecuencia OR por_monto THEN 'Cambio brusco' ELSE 'Sin historial en enero + monto alto' END AS tipo_cambio
FROM l31 WHERE por_frecuencia OR por_monto OR (sin_actividad_en_enero AND monto_feb_mar >= {RULES.p3_min_amount})""",
    "lref": f"""SELECT simbolo_titulo, dia_art, CAST(QUANTILE_CONT({dbl('precio')}, 0.5) AS DECIMAL(16,7)) AS mediana,
  COUNT(*) AS ops_referencia FROM le WHERE NOT regexp_matches(simbolo_titulo, {OPTION}) GROUP BY ALL HAVING COUNT(*) >= {RULES.p4_min_refs}""",
    "l40": f"""SELECT le.*, mediana, ops_referencia,
  {dec('CAST(precio AS DOUBLE) / CAST(mediana AS DOUBLE)', 4)} AS ratio_vs_mercado,
  NOT (descripcion_titulo ILIKE '%opci%' OR regexp_matches(simbolo_titulo, {OPTION}))
    AND (precio < mediana * {RULES.p4_low} OR precio > mediana * {RULES.p4_high}) AS fuera
FROM le LEFT JOIN lref USING (simbolo_titulo, dia_art)""",
    "l4": f"""SELECT *, CAST(ROUND(mediana, 4) AS DOUBLE) AS precio_mediana_dia,
  ROUND(CAST(CAST(cantidad AS DECIMAL(9,0)) * mediana AS DECIMAL(28,7))
    * CASE moneda WHEN 'USD' THEN CAST(tc_ars_por_usd AS DECIMAL(8,2)) ELSE CAST(1 AS DECIMAL(8,2)) END, 2)
    AS monto_ars_a_precio_mercado FROM l40 WHERE fuera""",
    "l4c": """SELECT id_cliente, COUNT(*) AS ops_precio_fuera, SUM(abs(monto_ars_a_precio_mercado - monto_ars)) AS diferencia_valor_ars
FROM l4 GROUP BY id_cliente""",
    "lk0": f"""SELECT lp.*, d.ops_precio_fuera, d.diferencia_valor_ars, d.id_cliente IS NOT NULL AS f_precio_fuera_mercado,
  COALESCE(c.tipo_cambio = 'Cambio brusco', FALSE) AS f_cambio_brusco,
  COALESCE(c.tipo_cambio <> 'Cambio brusco', FALSE) AS f_sin_historial_monto_alto,
  a.id_cliente IS NOT NULL AS f_actividad_alta, CAST(lp.max_monto_op_ars AS DOUBLE) >= lu.p999_monto_op AS f_operacion_extrema,
  COALESCE(b.z_madrugada >= {RULES.p2_z} OR b.z_inhabil >= {RULES.p2_z}, FALSE) AS f_horario_atipico
FROM lp LEFT JOIN l1 a ON a.id_cliente = lp.id_cliente LEFT JOIN l2 b ON b.id_cliente = lp.id_cliente
LEFT JOIN l3 c ON c.id_cliente = lp.id_cliente LEFT JOIN l4c d ON d.id_cliente = lp.id_cliente, lu""",
    "lk1": "SELECT *, " + " + ".join(f"{w} * CAST({flag} AS INTEGER)" for flag, w in WEIGHTS.items()) + " AS score FROM lk0",
    "lk": f"""SELECT id_cliente, canal_principal, canales, ops, dias_activos, simbolos, simbolo_principal,
  ROUND(monto_ars, 2) AS monto_ars, ROUND(max_monto_op_ars, 2) AS max_monto_op_ars, pct_compras, ops_ene, ops_feb, ops_mar,
  ROUND(monto_ene, 2) AS monto_ene, ROUND(monto_feb_mar, 2) AS monto_feb_mar, ops_madrugada, ops_dia_inhabil,
  f_precio_fuera_mercado, f_cambio_brusco, f_sin_historial_monto_alto, f_actividad_alta, f_operacion_extrema, f_horario_atipico,
  COALESCE(ops_precio_fuera, 0) AS ops_precio_fuera, COALESCE(diferencia_valor_ars, 0) AS diferencia_valor_ars, score,
  array_to_string(list_filter([
    {", ".join(f"CASE WHEN {flag} THEN '{text}' END" for flag, text in WHY.items())}], lambda x: x IS NOT NULL), ' | ') AS motivos,
  CASE WHEN score >= {RULES.high_score} THEN '{LEVEL_HIGH}' WHEN score >= {RULES.medium_score} THEN '{LEVEL_MEDIUM}' ELSE '{LEVEL_LOW}' END AS nivel_riesgo
FROM lk1 WHERE score > 0""",
    "lf": f"""SELECT id_transaccion, id_cliente, fecha_art, dia_art AS fecha, hora_art, franja_horaria, tipo_dia, tipo_tran,
  origen AS canal, moneda, simbolo_titulo, descripcion_titulo,
  CASE WHEN descripcion_titulo ILIKE 'cedear%' THEN 'CEDEAR'
       WHEN descripcion_titulo ILIKE '%opci%' OR regexp_matches(simbolo_titulo, {OPTION}) THEN 'Opción'
       WHEN descripcion_titulo ILIKE '%bono%' OR descripcion_titulo ILIKE '%rep. arg%' OR regexp_matches(simbolo_titulo, {BOND})
       THEN 'Bono / Letra' ELSE 'Acción / Otro' END AS familia_instrumento,
  cantidad, CAST(precio AS DOUBLE) AS precio, CAST(monto AS DOUBLE) AS monto_moneda_original, CAST(tc_ars_por_usd AS DOUBLE) AS tc_ars_por_usd,
  CAST(monto_ars AS DOUBLE) AS monto_ars, COALESCE(fuera, FALSE) AS flag_precio_fuera_mercado,
  CASE WHEN fuera THEN ratio_vs_mercado END AS ratio_vs_mercado,
  CAST(monto_ars AS DOUBLE) >= p999_monto_op AS flag_operacion_extrema, monto_ars AS m FROM l40, lu""",
    "lc": """SELECT p.id_cliente, p.canal_principal, p.canales, p.ops, p.dias_activos, p.simbolos, p.simbolo_principal,
  CAST(p.monto_ars AS DOUBLE) AS monto_ars, p.pct_compras, p.ops_ene, p.ops_feb, p.ops_mar, CAST(p.monto_ene AS DOUBLE) AS monto_ene,
  CAST(p.monto_feb_mar AS DOUBLE) AS monto_feb_mar, COALESCE(k.score, 0) AS score_riesgo,
  COALESCE(k.nivel_riesgo, 'Sin alerta') AS nivel_riesgo,
  CASE k.nivel_riesgo WHEN 'Alto' THEN 1 WHEN 'Medio' THEN 2 WHEN 'Bajo' THEN 3 ELSE 4 END AS orden_nivel,
  COALESCE(k.motivos, '') AS motivos, COALESCE(k.f_actividad_alta, FALSE) AS p1_actividad_alta,
  COALESCE(k.f_horario_atipico, FALSE) AS p2_horario_atipico, COALESCE(k.f_cambio_brusco, FALSE) AS p3_cambio_brusco,
  COALESCE(k.f_sin_historial_monto_alto, FALSE) AS p3_sin_historial_monto_alto,
  COALESCE(k.f_precio_fuera_mercado, FALSE) AS p4_precio_fuera_mercado,
  CAST(COALESCE(k.diferencia_valor_ars, 0) AS DOUBLE) AS diferencia_valor_ars
FROM lp p LEFT JOIN lk k ON k.id_cliente = p.id_cliente""",
    "lx": f"""SELECT id_cliente, canal_principal, ops, dias_activos, simbolos, {dec('monto_ars', 2)} AS monto_ars, ops_ene, ops_feb,
  ops_mar, score_riesgo, nivel_riesgo, orden_nivel, motivos, p1_actividad_alta, p2_horario_atipico, p3_cambio_brusco,
  p3_sin_historial_monto_alto, p4_precio_fuera_mercado, {dec('diferencia_valor_ars', 2)} AS diferencia_valor_ars,
  {dec('log10(CASE WHEN ops > 1 THEN ops ELSE 1 END)', 4)} AS log10_ops,
  {dec('log10(CASE WHEN monto_ars > 1 THEN monto_ars ELSE 1 END)', 4)} AS log10_monto_ars,
  ROW_NUMBER() OVER (ORDER BY monto_ars DESC, id_cliente) AS rank_monto,
  ROW_NUMBER() OVER (ORDER BY ops DESC, monto_ars DESC, id_cliente) AS rank_ops FROM lc""",
    "ldc": f"""SELECT c.fecha, c.dow, {WEEKDAY.format('c.dow')} AS dia_semana, strftime(c.fecha, '%Y-%m') AS anio_mes, c.es_habil,
  c.feriado, CAST(f.tc_ars_por_usd AS DOUBLE) AS tc_ars_por_usd, f.fuente_tc FROM lcal c JOIN lfx f ON f.fecha = c.fecha""",
    "lg": """SELECT e.* FROM le e WHERE e.id_cliente IN (SELECT id_cliente FROM lk)""",
    "ltop": """SELECT id_cliente FROM lk ORDER BY score DESC, monto_ars DESC, id_cliente DESC LIMIT 1""",
    "l3t": """SELECT id_cliente, ops_ene, ops_feb, ops_mar FROM l3 WHERE tipo_cambio = 'Cambio brusco'
ORDER BY multiplicador_frecuencia DESC, ops_feb_mar DESC, id_cliente LIMIT 12""",
    "lchan": """SELECT id_cliente, '{' || string_agg('"' || origen || '":' || n, ',' ORDER BY n DESC, origen) || '}' AS ops_por_canal
FROM (SELECT id_cliente, origen, COUNT(*) AS n FROM lg GROUP BY ALL) GROUP BY id_cliente""",
    "linst": """SELECT id_cliente, '[' || string_agg('{"simbolo":"' || simbolo_titulo || '","compras":' || nc || ',"ventas":' || nv
    || ',"monto_ars":' || CAST(CAST(ROUND(m, 0) AS DECIMAL(38,0)) AS VARCHAR) || '}', ',' ORDER BY pos) || ']' AS top_instrumentos
FROM (SELECT id_cliente, simbolo_titulo, SUM(monto_ars) AS m, COUNT(CASE tipo_tran WHEN 'Compra' THEN 1 END) AS nc,
    COUNT(CASE tipo_tran WHEN 'Venta' THEN 1 END) AS nv,
    ROW_NUMBER() OVER (PARTITION BY id_cliente ORDER BY COUNT(*) DESC, SUM(monto_ars) DESC, simbolo_titulo) AS pos
  FROM lg GROUP BY id_cliente, simbolo_titulo) WHERE pos <= 5 GROUP BY id_cliente""",
    "lsame": """SELECT id_cliente, COUNT(CASE WHEN sides = 2 THEN 1 END) || ' de ' || COUNT(*) AS dias_especie_compra_y_venta_mismo_dia
FROM (SELECT id_cliente, COUNT(DISTINCT tipo_tran) AS sides FROM lg GROUP BY id_cliente, dia_art, simbolo_titulo) GROUP BY id_cliente""",
    "ldates": f"""SELECT id_cliente, MIN(dia_art) AS primera, MAX(dia_art) AS ultima,
  CAST(round_even(CAST(QUANTILE_CONT({dbl('monto_ars')}, 0.5) AS DECIMAL(28,8)), 0) AS DOUBLE) AS monto_mediano_op_ars FROM lg GROUP BY id_cliente""",
    "lnest": """SELECT id_cliente, 0 AS parte, '[' || string_agg('{"fecha":"' || strftime(fecha_art, '%Y-%m-%d %H:%M:%S') || '","operacion":"'
    || tipo_tran || '","simbolo":"' || simbolo_titulo || '","cantidad":' || cantidad || ',"precio_operado":' || CAST(precio AS VARCHAR)
    || ',"precio_mercado_dia":' || CAST(CAST(ROUND(ROUND(mediana, 4), 2) AS DECIMAL(18,2)) AS VARCHAR) || ',"canal":"' || origen || '"}', ','
    ORDER BY fecha_art, id_transaccion) || ']' AS detalle FROM l4 GROUP BY id_cliente""",
    "lpop": f"""SELECT {div('SUM(ops)', 'COUNT(*)', 1)} AS prom_ops,
  CAST(round_even(CAST(QUANTILE_CONT({dbl('monto_ars')}, 0.5) AS DECIMAL(28,8)), 0) AS DOUBLE) AS mediana_monto FROM lp""",
}

PROFILE = f"""id_cliente, ops, {dbl('monto_ars')} AS monto_ars, {dbl('max_monto_op_ars')} AS max_monto_op_ars, dias_activos, simbolos,
  canales, canal_principal, simbolo_principal, pct_compras, ops_madrugada, ops_dia_inhabil, ops_ene, ops_feb, ops_mar,
  {dbl('monto_ene')} AS monto_ene, {dbl('monto_feb_mar')} AS monto_feb_mar"""
TYPED = TRADE.replace("precio, monto", "CAST(precio AS DOUBLE) AS precio, CAST(monto AS DOUBLE) AS monto")


def shares(table: str, key: str, extra: str = "", outer: str = "") -> str:
    """Count per key with its share of all rows."""
    return f"""SELECT {key}, ops, {pct('ops', 'SUM(ops) OVER ()')} AS pct_ops{outer} FROM (
  SELECT {key}, COUNT(*) AS ops{extra} FROM {table} GROUP BY {key})"""


def curve(source: str, value: str, cuts: str, scale: int) -> str:
    """Share of the total held by the largest rows, by plain ranks."""
    return f"""SELECT corte, {pct(f'SUM(CASE WHEN pos <= FLOOR(n * corte / {scale}) THEN v ELSE 0 END)', 'SUM(v)')} AS share
FROM (SELECT COALESCE({value}, 0) AS v, ROW_NUMBER() OVER (ORDER BY COALESCE({value}, 0) DESC) AS pos, COUNT(*) OVER () AS n FROM {source}),
  (VALUES {cuts}) c(corte) GROUP BY corte"""


def buckets(bounds: list[tuple[int, str]], last: str) -> str:
    return "CASE " + " ".join(f"WHEN ops <= {b} THEN {label}" for b, label in bounds) + f" ELSE {last} END"


FRACTIONS = "(CAST(0.001 AS DECIMAL(9,4))), (0.01), (0.05), (0.1), (0.2), (0.5)"
PERCENTS = "(CAST(0.1 AS DECIMAL(9,4))), (1), (5), (10), (20), (50)"
NATIVE = "(SELECT id_cliente, COUNT(*) AS ops, SUM(CASE WHEN moneda = 'ARS' THEN monto END) AS m FROM lt GROUP BY id_cliente)"
GAP = "monto_ars_a_precio_mercado - monto_ars"
GAP_ORDER = f"ORDER BY abs({GAP}) DESC, id_transaccion, id_cliente, fecha_art, precio"
MONTHS = [(1, "Enero", "ops_ene"), (2, "Febrero", "ops_feb"), (3, "Marzo (al 13)", "ops_mar")]
P3_LONG = " UNION ALL ".join(f"SELECT id_cliente, {i} AS mes_orden, '{m}' AS mes, {c} AS ops FROM l3t" for i, m, c in MONTHS)
CASE_JSON = """'{"id_cliente":"' || k.id_cliente || '","nivel_riesgo":"' || nivel_riesgo || '","score":' || score
  || ',"reglas_disparadas":"' || motivos || '","canal_principal":"' || canal_principal || '","operaciones_por_canal":' || ops_por_canal
  || ',"operaciones_total":' || ops || ',"operaciones_por_mes":{"enero":' || ops_ene || ',"febrero":' || ops_feb || ',"marzo_hasta_13":' || ops_mar
  || '},"monto_por_periodo_ars":{"enero":' || CAST(ROUND(monto_ene, 0) AS DECIMAL(38,0)) || ',"febrero_marzo":' || CAST(ROUND(monto_feb_mar, 0) AS DECIMAL(38,0))
  || '},"primera_operacion":"' || primera || '","ultima_operacion":"' || ultima || '","dias_activos":' || dias_activos
  || ',"operaciones_por_dia_activo":' || CAST(ROUND(CAST(ops / dias_activos AS DECIMAL(28,8)), 1) AS DECIMAL(20,1))
  || ',"monto_total_ars":' || CAST(ROUND(monto_ars, 0) AS DECIMAL(38,0)) || ',"monto_maximo_operacion_ars":' || CAST(ROUND(max_monto_op_ars, 0) AS DECIMAL(38,0))
  || ',"monto_mediano_operacion_ars":' || CAST(monto_mediano_op_ars AS DECIMAL(38,0)) || ',"especies_distintas":' || simbolos
  || ',"top_instrumentos":' || top_instrumentos || ',"pct_compras":' || CAST(pct_compras AS DECIMAL(5,1))
  || ',"dias_especie_compra_y_venta_mismo_dia":"' || dias_especie_compra_y_venta_mismo_dia || '","operaciones_madrugada":' || ops_madrugada
  || ',"operaciones_dia_inhabil":' || ops_dia_inhabil
  || CASE WHEN ops_precio_fuera > 0 THEN ',"operaciones_precio_fuera_de_mercado":' || ops_precio_fuera ELSE '' END
  || COALESCE(',"detalle_precio_fuera_de_mercado":' || detalle, '')
  || CASE WHEN diferencia_valor_ars > 0 THEN ',"diferencia_valor_vs_mercado_ars":' || CAST(ROUND(diferencia_valor_ars, 0) AS DECIMAL(38,0)) ELSE '' END
  || ',"referencia_poblacion":{"promedio_operaciones_por_cliente":' || CAST(prom_ops AS DECIMAL(20,1))
  || ',"mediana_monto_total_por_cliente_ars":' || CAST(mediana_monto AS DECIMAL(38,0)) || '}}'"""
LK_OUT = f"""id_cliente, canal_principal, canales, ops, dias_activos, simbolos, simbolo_principal, {dbl('monto_ars')} AS monto_ars,
  {dbl('max_monto_op_ars')} AS max_monto_op_ars, pct_compras, ops_ene, ops_feb, ops_mar, {dbl('monto_ene')} AS monto_ene,
  {dbl('monto_feb_mar')} AS monto_feb_mar, ops_madrugada, ops_dia_inhabil, f_precio_fuera_mercado, f_cambio_brusco,
  f_sin_historial_monto_alto, f_actividad_alta, f_operacion_extrema, f_horario_atipico, ops_precio_fuera,
  {dbl('diferencia_valor_ars')} AS diferencia_valor_ars, score, motivos, nivel_riesgo"""
TRADE_MEASURES = f"""COUNT(*) AS cant_operaciones, COUNT(DISTINCT id_cliente) AS clientes_unicos, {mill('SUM(m)', 4)} AS monto_ars_m,
  {div(cnt("franja_horaria <> 'Mercado (11-17)'"), 'COUNT(*)', 6)} AS pct_fuera_de_horario, {div(cnt(OFFDAY), 'COUNT(*)', 6)} AS pct_dia_inhabil,
  {cnt('flag_precio_fuera_mercado')} AS ops_precio_fuera_de_mercado, {div('COUNT(*)', 'COUNT(DISTINCT id_cliente)', 4)} AS ops_por_cliente"""
ALERT = "nivel_riesgo <> 'Sin alerta'"
CLIENT_MEASURES = f"""{cnt(ALERT)} AS clientes_en_alerta, {cnt("nivel_riesgo = 'Alto'")} AS clientes_riesgo_alto,
  {mill('SUM(CAST(monto_ars AS DECIMAL(28,4)))', 4)} AS monto_clientes_m,
  {mill(f'SUM(CASE WHEN {ALERT} THEN CAST(monto_ars AS DECIMAL(28,4)) ELSE 0 END)', 4)} AS monto_en_alerta_m,
  {div(f'SUM(CASE WHEN {ALERT} THEN CAST(monto_ars AS DECIMAL(28,4)) ELSE 0 END)', 'SUM(CAST(monto_ars AS DECIMAL(28,4)))', 6)} AS pct_monto_en_alerta,
  {mill('SUM(CAST(diferencia_valor_ars AS DECIMAL(28,4)))', 4)} AS diferencia_valor_ars_m"""


def grouped(expr: str) -> str:
    return f"format('{{:,}}', CAST(ROUND(CAST({expr} AS DECIMAL(28,4)), 0) AS BIGINT))"


# One document per client in alert.
CASES = f"""SELECT k.id_cliente, nivel_riesgo, score, {CASE_JSON} AS perfil
FROM lk k JOIN lchan USING (id_cliente) JOIN linst USING (id_cliente) JOIN lsame USING (id_cliente) JOIN ldates USING (id_cliente)
LEFT JOIN lnest USING (id_cliente), lpop"""

STATEMENTS = {
    "overview": f"""SELECT COUNT(*) AS operaciones, COUNT(DISTINCT id_cliente) AS clientes_unicos, COUNT(DISTINCT simbolo_titulo) AS simbolos,
  COUNT(DISTINCT descripcion_titulo) AS descripciones, MIN(fecha_utc) AS primera_op_utc, MAX(fecha_utc) AS ultima_op_utc,
  COUNT(DISTINCT CAST(fecha_utc AS DATE)) AS dias_con_actividad_utc, {div('COUNT(*)', 'COUNT(DISTINCT id_cliente)', 2)} AS ops_por_cliente_prom FROM et""",
    "dq_counts": f"""SELECT {cnt("COALESCE(id_cliente, '') = ''")} AS cliente_vacio, {cnt("COALESCE(simbolo_titulo, '') = ''")} AS simbolo_vacio,
  {cnt('cantidad <= 0')} AS cantidad_no_positiva, {cnt('precio <= 0')} AS precio_no_positivo,
  COUNT(*) - COUNT(DISTINCT id_transaccion) AS id_transaccion_duplicado FROM et""",
    "dq_logical_dupes": f"""SELECT COUNT(*) AS grupos_duplicados, {big('COALESCE(SUM(n), 0)')} AS operaciones_involucradas FROM (
  SELECT COUNT(*) AS n FROM et GROUP BY fecha_utc, id_cliente, tipo_tran, precio, cantidad, simbolo_titulo) WHERE n >= 2""",
    "ms_flag_by_channel": "SELECT origen, ms_flag, COUNT(*) AS ops FROM et GROUP BY ALL",
    "symbol_controls": f"""SELECT 'simbolos_con_>1_descripcion' AS control, COUNT(*) AS casos FROM (
  SELECT simbolo_titulo FROM et GROUP BY ALL HAVING MIN(descripcion_titulo) <> MAX(descripcion_titulo))
UNION ALL SELECT 'simbolos_operados_en_ARS_y_USD', COUNT(*) FROM (SELECT simbolo_titulo FROM et GROUP BY ALL HAVING MIN(moneda) <> MAX(moneda))
UNION ALL SELECT 'ticker_termina_en_D_pero_moneda_ARS', COUNT(*) FROM et
  WHERE regexp_matches(simbolo_titulo, {DOLLAR}) AND moneda = 'ARS'""",
    "by_weekday": shares("et", "dow_art", outer=f", {WEEKDAY.format('dow_art')} AS dia"),
    "by_hour": shares("et", "hora_art", outer=", CASE WHEN hora_art > 10 AND hora_art < 17 THEN 'mercado' ELSE 'fuera' END AS franja"),
    "atypical_bands": f"""SELECT {pct(cnt('hora_art < 11 OR hora_art > 16'), 'COUNT(*)')} AS pct_fuera_horario_mercado,
  {pct(cnt('hora_art < 6'), 'COUNT(*)')} AS pct_madrugada_0a6, {pct(cnt('dow_art > 5'), 'COUNT(*)')} AS pct_fin_de_semana,
  {cnt('dow_art > 5')} AS ops_fin_de_semana FROM et""",
    "off_hours_by_channel": f"""SELECT origen, {pct(cnt('hora_art < 11 OR hora_art > 16'), 'COUNT(*)', 1)} AS pct_fuera_horario,
  {pct(cnt('dow_art = 6'), 'COUNT(*)', 1)} AS pct_sabado FROM et GROUP BY origen""",
    "daily_window": f"""SELECT CAST(fecha_utc AS DATE) AS dia_utc, strftime(CAST(fecha_utc AS DATE), '%a') AS dow, COUNT(*) AS ops,
  strftime(MIN(fecha_utc), '%H:%M') AS primera_utc, strftime(MAX(fecha_utc), '%H:%M') AS ultima_utc, {cnt('hour(fecha_utc) < 10')} AS ops_antes_10utc
FROM et WHERE CAST(fecha_utc AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-20' GROUP BY ALL""",
    "days_without_activity": """SELECT d AS dia, strftime(d, '%a') AS dow FROM (
  SELECT CAST(unnest(generate_series(MIN(a) - INTERVAL 20 DAY, MAX(a) + INTERVAL 20 DAY, INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT CAST(fecha_utc AS DATE) AS a FROM et))
WHERE isodow(d) < 7 AND d NOT IN (SELECT CAST(fecha_utc AS DATE) FROM et)""",
    "api_log_report": "SELECT api, estado, filas, left(detalle, 70) AS detalle FROM elog",
    "business_calendar": "SELECT fecha, dow, feriado, es_habil FROM ecal",
    "holidays_with_activity": """SELECT c.fecha, c.feriado, COUNT(t.dia_art) AS ops_ese_dia FROM ecal c LEFT JOIN et t ON t.dia_art = c.fecha
WHERE c.feriado IS NOT NULL AND c.fecha BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY c.fecha, c.feriado""",
    "implied_fx": f"SELECT fecha, {dbl('mep_implicito')} AS mep_implicito, n_ars, n_usd FROM eimp",
    "daily_fx": f"SELECT fecha, {dbl('tc_ars_por_usd')} AS tc_ars_por_usd, fuente_tc, arrastrado FROM efx",
    "fx_summary": f"""SELECT fuente_tc, COUNT(*) AS dias, {dbl('MIN(tc_ars_por_usd)')} AS minimo, {dbl('MAX(tc_ars_por_usd)')} AS maximo,
  {div('SUM(tc_ars_por_usd)', 'COUNT(tc_ars_por_usd)', 2)} AS promedio FROM efx GROUP BY fuente_tc""",
    "fx_crosscheck": f"""SELECT fecha, {dbl('venta')} AS mep_api, {dbl('mep_implicito')} AS mep_implicito,
  {pct('mep_implicito - venta', 'venta')} AS desvio_pct FROM eq JOIN eimp USING (fecha)""",
    "enriched_trades": f"""SELECT {TYPED}, {dbl('tc_ars_por_usd')} AS tc_ars_por_usd, {dbl('monto_ars')} AS monto_ars, es_habil, feriado,
  tipo_dia, franja_horaria, mes FROM ee""",
    "dropped_trades": f"""SELECT COUNT(*) AS ops_sin_tipo_de_cambio, COUNT(DISTINCT dia_art) AS dias FROM et
WHERE id_transaccion NOT IN (SELECT id_transaccion FROM ee WHERE dia_art BETWEEN DATE '2024-01-05' AND DATE '2024-01-24')""",
    "implied_only_fx": f"SELECT fecha, {dbl('tc_ars_por_usd')} AS tc_ars_por_usd, fuente_tc, arrastrado FROM eofx",
    "pipeline_keys": " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, '{key}' AS clave, {big('SUM(n)')} AS filas, COUNT(CASE WHEN n > 1 AND {key} IS NOT NULL THEN 1 END) AS repetidas, "
        f"{big(f'COALESCE(SUM(CASE WHEN {key} IS NULL THEN n END), 0)')} AS nulas FROM (SELECT {key}, COUNT(*) AS n FROM {block} GROUP BY {key})"
        for name, key, block in (
            ("operaciones", "id_transaccion", "lt"), ("feriados", "fecha", "lh"), ("tipo_cambio_api", "fecha", "lq"),
            ("calendario", "fecha", "lcal"), ("tipo_cambio_diario", "fecha", "lfx"), ("operaciones_enriquecidas", "id_transaccion", "le"),
            ("perfil_cliente", "id_cliente", "lp"), ("clientes_riesgo", "id_cliente", "lk"))),
    "by_day_type": shares("ee", "tipo_dia", ", COUNT(DISTINCT id_cliente) AS clientes, SUM(monto_ars) AS m",
                          f", clientes, {mill('m')} AS monto_ars_millones"),
    "volume_by_currency_ars": f"""SELECT moneda, ops, {mill('m')} AS monto_ars_millones, {pct('m', 'SUM(m) OVER ()')} AS pct_monto
FROM (SELECT moneda, COUNT(*) AS ops, SUM(monto_ars) AS m FROM ee GROUP BY moneda)""",
    "monthly_volume": f"""SELECT mes, COUNT(*) AS ops, COUNT(DISTINCT CASE WHEN es_habil THEN dia_art END) AS dias_habiles_con_ops,
  {mill('SUM(monto_ars)')} AS monto_ars_millones, {div('COUNT(*)', 'COUNT(DISTINCT CASE WHEN es_habil THEN dia_art END)', 0)} AS ops_por_dia_habil
FROM ee GROUP BY mes""",
    "bands_by_channel": f"""SELECT origen, {pct(cnt(NIGHT), 'COUNT(*)', 1)} AS pct_madrugada,
  {pct(cnt("franja_horaria = 'Mercado (11-17)'"), 'COUNT(*)', 1)} AS pct_mercado, {pct(cnt(OFFDAY), 'COUNT(*)', 1)} AS pct_dia_inhabil FROM ee GROUP BY origen""",
    "weekday_time_span": """SELECT isodow(fecha_utc) || ' ' || strftime(fecha_utc, '%a') AS dia_semana_utc,
  MIN(strftime(fecha_utc, '%H:%M')) AS hora_min, MAX(strftime(fecha_utc, '%H:%M')) AS hora_max, COUNT(*) AS ops FROM ee GROUP BY 1""",
    "api_log_view": "SELECT ts_utc, api, url, estado, filas, detalle FROM elog",
    "api_log_export": "SELECT api, estado, filas, detalle, url FROM elog",
    "primary_key_check": "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1",

    "top_instruments": shares("lt", "simbolo_titulo, moneda", ", MIN(descripcion_titulo) AS descripcion, COUNT(DISTINCT id_cliente) AS clientes",
                              ", descripcion, clientes") + " ORDER BY ops DESC, simbolo_titulo, moneda LIMIT 15",
    "instrument_families": f"""SELECT familia, ops, {pct('ops', 'SUM(ops) OVER ()')} AS pct_ops FROM (SELECT CASE
  WHEN lower(descripcion_titulo) LIKE 'cedear%' THEN 'CEDEAR'
  WHEN lower(descripcion_titulo) LIKE '%opci%' OR regexp_matches(simbolo_titulo, {OPTION}) THEN 'Opción'
  WHEN lower(descripcion_titulo) LIKE '%bono%' OR lower(descripcion_titulo) LIKE '%rep. arg%' OR regexp_matches(simbolo_titulo, {BOND}) THEN 'Bono / Letra'
  WHEN lower(descripcion_titulo) LIKE '%obligaci%' OR lower(descripcion_titulo) LIKE '%o.n.%' THEN 'Obligación Negociable'
  ELSE 'Acción / Otro' END AS familia, COUNT(*) AS ops FROM lt GROUP BY 1)""",
    "by_channel": shares("lt", "origen", ", COUNT(DISTINCT id_cliente) AS clientes", f", clientes, {div('ops', 'clientes', 2)} AS ops_por_cliente"),
    "by_currency": shares("lt", "moneda", ", SUM(monto) AS m", f", {dec('m', 0)} AS monto_total_moneda_original"),
    "by_side": shares("lt", "tipo_tran"),
    "channel_mix": f"""SELECT origen, {pct(cnt("tipo_tran = 'Compra'"), 'COUNT(*)', 1)} AS pct_compra, {pct(cnt("moneda = 'USD'"), 'COUNT(*)', 1)} AS pct_usd
FROM lt GROUP BY origen""",
    "amount_percentiles": f"""SELECT moneda, {dec('MIN(monto)', 2)} AS minimo,
  {', '.join(f"{dec(f'QUANTILE_CONT({dbl("monto")}, {q})', 2)} AS {n}" for n, q in (('p50', 0.5), ('p90', 0.9), ('p99', 0.99), ('p999', 0.999)))},
  {dec('MAX(monto)', 2)} AS maximo, {div('MAX(monto)', f'QUANTILE_CONT({dbl("monto")}, 0.5)', 0)} AS max_sobre_mediana FROM lt GROUP BY moneda""",
    "largest_quantity": f"""SELECT fecha_utc, id_cliente, origen, simbolo_titulo, moneda, cantidad, {dbl('precio')} AS precio, {dec('monto', 2)} AS monto
FROM lt ORDER BY lt.cantidad DESC, id_transaccion LIMIT 10""",
    "activity_buckets": f"""SELECT tramo_ops, clientes, {pct('clientes', 'SUM(clientes) OVER ()')} AS pct_clientes, ops, {pct('ops', 'SUM(ops) OVER ()')} AS pct_ops
FROM (SELECT {buckets([(1, "'01) 1'"), (2, "'02) 2'"), (5, "'03) 3-5'"), (10, "'04) 6-10'"), (50, "'05) 11-50'"), (100, "'06) 51-100'")], "'07) >100'")} AS tramo_ops,
  COUNT(*) AS clientes, {big('SUM(ops)')} AS ops FROM (SELECT COUNT(*) AS ops FROM lt GROUP BY id_cliente) GROUP BY 1)""",
    "concentration_curve": f"""SELECT {dbl('a.corte')} AS corte, a.share AS pct_ops, b.share AS pct_monto_ars
FROM ({curve(NATIVE, 'ops', FRACTIONS, 1)}) a JOIN ({curve(NATIVE, 'm', FRACTIONS, 1)}) b ON a.corte = b.corte""",
    "top_clients": f"""SELECT id_cliente, COUNT(*) AS ops, COUNT(DISTINCT origen) AS canales, MIN(origen) AS canal, COUNT(DISTINCT simbolo_titulo) AS simbolos,
  COUNT(DISTINCT dia_art) AS dias_activos, {dec("SUM(CASE WHEN moneda = 'ARS' THEN monto END)", 0)} AS monto_ars
FROM lt GROUP BY id_cliente ORDER BY 2 DESC, id_cliente LIMIT 10""",
    "client_profile": f"SELECT {PROFILE} FROM lp",
    "thresholds": "SELECT * FROM lu",
    "thresholds_report": f"""SELECT {dec('p999_ops', 0)} AS p999_ops_cliente, {dec('p999_monto_cliente', 0)} AS p999_monto_cliente_ars,
  {dec('p50_monto_cliente', 0)} AS mediana_monto_cliente_ars, {dec('p999_monto_op', 0)} AS p999_monto_operacion_ars,
  {dec('base_madrugada * 100', 1)} AS pct_base_madrugada, {dec('base_inhabil * 100', 1)} AS pct_base_dia_inhabil FROM lu""",
    "working_days": "SELECT dh_ene, dh_feb_mar FROM ld",
    "p1_high_activity": f"SELECT {PROFILE}, veces_mediana_monto, por_frecuencia, por_monto FROM l1",
    "p1_summary": f"""SELECT COUNT(*) AS clientes, {cnt('por_frecuencia')} AS por_frecuencia, {cnt('por_monto')} AS por_monto,
  {cnt('por_frecuencia AND por_monto')} AS ambos, {pct('SUM(ops)', '(SELECT SUM(ops) FROM lp)')} AS pct_ops_total,
  {pct('SUM(monto_ars)', '(SELECT SUM(monto_ars) FROM lp)')} AS pct_monto_total FROM l1""",
    "p1_top_amount": f"""SELECT id_cliente, canal_principal, ops, dias_activos, simbolos, simbolo_principal, {mill('monto_ars')} AS monto_ars_mill,
  veces_mediana_monto, pct_compras FROM l1 ORDER BY l1.monto_ars DESC, id_cliente LIMIT 15""",
    "p1_top_frequency": f"""SELECT id_cliente, canal_principal, ops, dias_activos, {div('ops', 'dias_activos', 1)} AS ops_por_dia, simbolos,
  simbolo_principal, {mill('monto_ars')} AS monto_ars_mill FROM l1 ORDER BY ops DESC, id_cliente LIMIT 10""",
    "p1_channel_lift": f"""SELECT origen, {pct('n1', 'SUM(n1) OVER ()', 1)} AS pct_ops_top01, {pct('n', 'SUM(n) OVER ()', 1)} AS pct_ops_poblacion
FROM (SELECT origen, COUNT(*) AS n, {cnt('id_cliente IN (SELECT id_cliente FROM l1)')} AS n1 FROM le GROUP BY origen)""",
    "p1_instruments": f"""SELECT simbolo_titulo, MIN(descripcion_titulo) AS descripcion, COUNT(*) AS ops, COUNT(DISTINCT id_cliente) AS clientes_top01,
  {mill('SUM(monto_ars)')} AS monto_ars_mill FROM le WHERE id_cliente IN (SELECT id_cliente FROM l1) GROUP BY simbolo_titulo
ORDER BY SUM(monto_ars) DESC, simbolo_titulo LIMIT 10""",
    "extreme_trades_by_channel": f"""SELECT origen, COUNT(*) AS ops_extremas, COUNT(DISTINCT id_cliente) AS clientes, {mill('SUM(monto_ars)')} AS monto_ars_mill
FROM le WHERE CAST(monto_ars AS DOUBLE) >= (SELECT p999_monto_op FROM lu) GROUP BY origen""",
    "nonbusiness_concentration": f"""SELECT COUNT(*) AS clientes_con_ops_inhabil, {big('SUM(n)')} AS ops_inhabil,
  {pct('SUM(CASE WHEN pos <= 10 THEN n END)', 'SUM(n)')} AS pct_explicado_top10_clientes, {pct('SUM(CASE WHEN pos <= 100 THEN n END)', 'SUM(n)')} AS pct_explicado_top100_clientes
FROM (SELECT COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC) AS pos FROM le WHERE {OFFDAY} GROUP BY id_cliente)""",
    "p2_atypical_hours": "SELECT * FROM l2",
    "p2_summary": f"""SELECT COUNT(*) AS clientes_evaluados_10mas_ops, {cnt('z_madrugada >= 3')} AS z_madrugada_3, {cnt('z_inhabil >= 3')} AS z_inhabil_3,
  {dec('COUNT(*) * CAST(0.00135 AS DECIMAL(6,5))', 1)} AS esperados_por_azar_cada_uno FROM l2""",
    "p2_list": "SELECT * FROM l2 WHERE z_madrugada >= 3 OR z_inhabil >= 3",
    "p3_behaviour_change": f"""SELECT {PROFILE}, ops_feb_mar, tasa_ene, tasa_feb_mar, multiplicador_frecuencia, multiplicador_monto, por_frecuencia,
  por_monto, sin_actividad_en_enero, tipo_cambio FROM l3""",
    "p3_summary": f"""SELECT tipo_cambio, COUNT(*) AS clientes, {cnt('por_frecuencia')} AS por_frecuencia, {cnt('por_monto')} AS por_monto_con_historia,
  {cnt('sin_actividad_en_enero')} AS sin_actividad_enero, {mill('SUM(monto_feb_mar)')} AS monto_feb_mar_mill FROM l3 GROUP BY tipo_cambio""",
    "p3_top_frequency": f"""SELECT id_cliente, canal_principal, ops_ene, ops_feb, ops_mar, multiplicador_frecuencia, {mill('monto_ene', 2)} AS monto_ene_mill,
  {mill('monto_feb_mar', 2)} AS monto_feb_mar_mill, simbolo_principal FROM l3 WHERE por_frecuencia
ORDER BY multiplicador_frecuencia DESC, ops_feb_mar DESC, id_cliente LIMIT 15""",
    "p3_top_amount": f"""SELECT id_cliente, canal_principal, ops_ene, ops_feb_mar, {mill('monto_ene', 2)} AS monto_ene_mill,
  {mill('monto_feb_mar', 2)} AS monto_feb_mar_mill,
  CASE WHEN multiplicador_monto IS NULL THEN 'nuevo' ELSE CAST(CAST(multiplicador_monto AS DECIMAL(20,1)) AS VARCHAR) END AS multiplicador_monto,
  simbolo_principal FROM l3 WHERE por_monto OR (sin_actividad_en_enero AND NOT por_frecuencia) ORDER BY l3.monto_feb_mar DESC, id_cliente LIMIT 15""",
    "reference_prices": f"SELECT simbolo_titulo, dia_art, {dbl('mediana')} AS mediana, ops_referencia FROM lref",
    "p4_off_market_price": f"""SELECT id_transaccion, id_cliente, fecha_art, origen, tipo_tran, simbolo_titulo, descripcion_titulo, moneda, cantidad,
  {dbl('precio')} AS precio, precio_mediana_dia, ops_referencia, ratio_vs_mercado, {dbl('monto_ars')} AS monto_ars,
  {dbl('monto_ars_a_precio_mercado')} AS monto_ars_a_precio_mercado FROM l4""",
    "p4_summary": f"SELECT COUNT(*) AS operaciones, COUNT(DISTINCT id_cliente) AS clientes, {mill(f'SUM(abs({GAP}))')} AS diferencia_valor_ars_mill FROM l4",
    "p4_detail": f"""SELECT id_cliente, origen, CAST(fecha_art AS DATE) AS dia, tipo_tran, simbolo_titulo, cantidad, {dbl('precio')} AS precio,
  precio_mediana_dia, ratio_vs_mercado, {mill(GAP, 2)} AS diferencia_ars_mill FROM l4 {GAP_ORDER} LIMIT 20""",
    "p4_by_channel": f"""SELECT origen, COUNT(*) AS ops, COUNT(DISTINCT id_cliente) AS clientes,
  {cnt('ROUND(precio, 2) = 0.01 OR ROUND(precio, 2) = 1')} AS precio_placeholder_001_o_1 FROM l4 GROUP BY origen""",
    "p4_export": f"""SELECT id_cliente, CAST(fecha_art AS DATE) AS fecha, origen AS canal, tipo_tran, simbolo_titulo, cantidad, {dbl('precio')} AS precio,
  precio_mediana_dia, ratio_vs_mercado, {mill(GAP, 2)} AS diferencia_ars_mill FROM l4""",
    "risk_score": f"SELECT {LK_OUT} FROM lk",
    "risk_levels": f"""SELECT nivel_riesgo, COUNT(*) AS clientes, {big('SUM(ops)')} AS ops, {mill('SUM(monto_ars)')} AS monto_ars_mill,
  {pct('SUM(monto_ars)', '(SELECT SUM(monto_ars) FROM lp)', 1)} AS pct_monto_total FROM lk GROUP BY nivel_riesgo""",
    "review_queue": f"""SELECT id_cliente, nivel_riesgo, score, canal_principal, ops, {mill('monto_ars')} AS monto_ars_mill, motivos
FROM lk WHERE score >= 3 ORDER BY score DESC, lk.monto_ars DESC, id_cliente LIMIT 30""",
    "fact_trades": "SELECT * EXCLUDE (m) FROM lf",
    "dim_client": "SELECT * FROM lc",
    "dim_calendar": "SELECT * FROM ldc",
    "client_month": f"SELECT id_cliente, mes, COUNT(*) AS ops, {dbl('SUM(monto_ars)')} AS monto_ars FROM le GROUP BY ALL",
    "view_counts": """SELECT 'vw_fact_operaciones' AS vista, COUNT(*) AS "count" FROM lineitem UNION ALL SELECT 'vw_dim_cliente', COUNT(*) FROM lc
UNION ALL SELECT 'vw_dim_calendario', COUNT(*) FROM ldc UNION ALL SELECT 'vw_cliente_mes', COUNT(*) FROM (SELECT DISTINCT id_cliente, mes FROM le)
UNION ALL SELECT 'vw_api_log', COUNT(*) FROM elog""",
    "alert_export": f"SELECT * FROM lc WHERE {ALERT}",
    "trades_export": """SELECT id_transaccion, id_cliente, fecha, fecha_art, hora_art, franja_horaria, tipo_dia, tipo_tran, canal, moneda, simbolo_titulo,
  familia_instrumento, cantidad, precio, monto_ars, flag_precio_fuera_mercado, flag_operacion_extrema,
  CASE WHEN flag_precio_fuera_mercado THEN 'Sí' ELSE 'No' END AS precio_fuera_mercado FROM lf""",
    "clients_export": "SELECT * FROM lx",
    "calendar_export": "SELECT *, strftime(fecha, '%d/%m') AS dia_mes, CAST(strftime(fecha, '%Y%m%d') AS INTEGER) AS fecha_num FROM ldc",
    "top_instruments_export": f"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY ops DESC, simbolo_titulo, moneda) AS INTEGER) AS ranking,
  simbolo_titulo || ' (' || moneda || ')' AS instrumento, ops, clientes, {mill('m')} AS monto_ars_mill
FROM (SELECT simbolo_titulo, moneda, COUNT(*) AS ops, COUNT(DISTINCT id_cliente) AS clientes, SUM(monto_ars) AS m FROM le GROUP BY ALL)
ORDER BY 1 LIMIT 15""",
    "buckets_export": f"""SELECT {buckets([(1, '1'), (2, '2'), (5, '3'), (10, '4'), (50, '5')], '6')} AS orden,
  {buckets([(1, "'1 op'"), (2, "'2 ops'"), (5, "'3-5'"), (10, "'6-10'"), (50, "'11-50'")], "'>50'")} AS tramo,
  COUNT(*) AS clientes, {big('SUM(ops)')} AS ops FROM (SELECT COUNT(*) AS ops FROM lt GROUP BY id_cliente) GROUP BY ALL""",
    "pareto_export": f"""SELECT {dbl('corte')} AS pct_clientes,
  CASE WHEN corte < 1 THEN 'Top 0,1%' ELSE 'Top ' || CAST(corte AS INTEGER) || '%' END AS segmento, share AS pct_monto
FROM ({curve('lp', 'monto_ars', PERCENTS, 100)})""",
    "p3_top_long": P3_LONG,
    "flagged_trades": f"SELECT id_cliente, origen, simbolo_titulo, tipo_tran, dia_art, cantidad, {dbl('monto_ars')} AS monto_ars FROM lg",
    "ops_by_channel_map": "SELECT * FROM lchan",
    "top5_instruments": "SELECT * FROM linst",
    "same_day_round_trips": "SELECT * FROM lsame",
    "client_dates_median": "SELECT * FROM ldates",
    "p4_detail_nested": "SELECT * FROM lnest",
    "population_reference": "SELECT * FROM lpop",
    "client_profile_json": CASES,
    "profile_extras": f"""SELECT id_cliente, {div('SUM(monto_ars)', 'COUNT(*)', 0)} AS monto_promedio_por_operacion_ars,
  MIN(cantidad) AS nominales_min, MAX(cantidad) AS nominales_max FROM lg GROUP BY id_cliente""",
    "lookup_client": f"""SELECT * FROM ({CASES}) WHERE id_cliente = (SELECT id_cliente FROM ltop)""",
    "list_clients_by_level": "SELECT id_cliente, nivel_riesgo, score AS score_riesgo, motivos FROM lk WHERE nivel_riesgo = 'Alto'",
    "list_clients_by_rule": "SELECT id_cliente, nivel_riesgo, score AS score_riesgo, motivos FROM lk WHERE f_precio_fuera_mercado",
    "daily_job": f"SELECT * FROM ({CASES}) WHERE score >= 2",
    "trade_measures": f"SELECT {TRADE_MEASURES} FROM lf",
    "client_measures": f"SELECT {CLIENT_MEASURES} FROM lc",
    "kpi_cards": f"""SELECT *, {grouped('cant_operaciones')} AS operaciones_totales_txt, {grouped('clientes_unicos')} AS clientes_activos_txt,
  {grouped('monto_ars_m')} AS monto_ars_m_txt, CAST(CAST(ROUND(CAST(pct_fuera_de_horario AS DECIMAL(18,6)) * 100, 1) AS DECIMAL(20,1)) AS VARCHAR) || '%' AS fuera_de_horario_txt,
  {grouped('clientes_en_alerta')} AS clientes_con_alerta_txt, {grouped('clientes_riesgo_alto')} AS riesgo_alto_txt, {grouped('monto_en_alerta_m')} AS monto_en_alerta_m_txt
FROM (SELECT {TRADE_MEASURES} FROM lf), (SELECT {CLIENT_MEASURES} FROM lc)""",
    "volume_by_level": f"""SELECT nivel_riesgo, orden_nivel, {mill('SUM(CAST(monto_ars AS DECIMAL(28,4)))', 4)} AS monto_clientes_m,
  {div('SUM(CAST(monto_ars AS DECIMAL(28,4)))', '(SELECT SUM(CAST(monto_ars AS DECIMAL(28,4))) FROM lc)', 6)} AS pct_del_volumen FROM lc GROUP BY ALL""",
    "trades_by_day": "SELECT fecha, tipo_dia, COUNT(*) AS operaciones FROM lf GROUP BY ALL",
    "trades_by_channel": "SELECT canal, COUNT(*) AS operaciones FROM lf GROUP BY canal",
    "hour_weekday_heatmap": "SELECT hora_art, " + ", ".join(
        f"NULLIF({cnt(f'isodow(fecha) = {i}')}, 0) AS \"{d}\"" for i, d in enumerate(("Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom"), 1))
    + " FROM lf GROUP BY hora_art",
    "bands_within_channel": f"""SELECT canal, franja_horaria, operaciones, {pct('operaciones', 'SUM(operaciones) OVER (PARTITION BY canal)')} AS pct
FROM (SELECT canal, franja_horaria, COUNT(*) AS operaciones FROM lf GROUP BY ALL)""",
    "top10_by_amount": f"SELECT rank_monto, id_cliente, nivel_riesgo, {mill('monto_ars', 4)} AS monto_clientes_m FROM lx WHERE rank_monto <= 10",
    "top10_by_ops": "SELECT rank_ops, id_cliente, nivel_riesgo, ops FROM lx WHERE rank_ops <= 10",
    "p3_pivot": 'SELECT id_cliente, ops_ene AS "Enero", ops_feb AS "Febrero", ops_mar AS "Marzo (al 13)" FROM l3t',
    "review_table": f"""SELECT id_cliente, nivel_riesgo, score_riesgo, motivos, canal_principal, ops, {dec('monto_ars', 2)} AS monto_ars,
  ops_ene, ops_feb, ops_mar FROM lc WHERE nivel_riesgo IN ('Alto', 'Medio') AND canal_principal IN ('1-URGENT', '2-HIGH')""",
    "client_card": "SELECT * FROM lc WHERE id_cliente = (SELECT id_cliente FROM ltop)",
    "client_daily": """SELECT fecha, tipo_tran, COUNT(*) AS operaciones FROM lf WHERE id_cliente = (SELECT id_cliente FROM ltop) GROUP BY ALL""",
    "client_trades": """SELECT fecha_art, canal, tipo_tran, simbolo_titulo, cantidad, precio, monto_ars, flag_precio_fuera_mercado FROM lf
WHERE id_cliente = (SELECT id_cliente FROM ltop)""",
    "fx_line": "SELECT fecha, fuente_tc, tc_ars_por_usd FROM ldc WHERE fecha <= DATE '2001-06-30'",
    "holiday_list": "SELECT fecha, dia_semana, feriado FROM ldc WHERE fecha <= DATE '2001-06-30' AND COALESCE(feriado, '') <> ''",
    "cumulative_share": f"""SELECT id_cliente, DENSE_RANK() OVER (ORDER BY monto_ars DESC) AS rank_cliente_monto,
  {div('SUM(monto_ars) OVER (ORDER BY monto_ars DESC RANGE UNBOUNDED PRECEDING)', 'SUM(monto_ars) OVER ()', 6)} AS pct_acumulado_monto FROM lp""",

    "csv_load_typed": f"""SELECT id_transaccion, id_cliente, w AS fecha_utc, w - INTERVAL 3 HOUR AS fecha_art, CAST(w - INTERVAL 3 HOUR AS DATE) AS dia_art,
  CAST(hour(w - INTERVAL 3 HOUR) AS INTEGER) AS hora_art, CAST(isodow(w - INTERVAL 3 HOUR) AS INTEGER) AS dow_art, tipo_tran, '"' || descripcion_titulo || '", serie A' AS descripcion_titulo, simbolo_titulo, moneda, origen, cantidad,
  {dbl('precio')} AS precio, {dbl('ROUND(cantidad * precio, 4)')} AS monto,
  CASE WHEN cantidad % 2 = 0 THEN ms_flag END AS ms_flag
FROM (SELECT *, fecha_utc + CASE ms_flag WHEN '010' THEN INTERVAL 10 MILLISECOND ELSE INTERVAL 0 MILLISECOND END AS w FROM lt)""",
    "load_control": """SELECT 'raw' AS tabla, COUNT(*) AS "count" FROM lineitem UNION ALL SELECT 'tipada', COUNT(*) FROM lineitem""",
    "reject_rows": """SELECT columnas_invalidas, COUNT(*) AS filas FROM (
  SELECT CASE WHEN cantidad = 7 AND moneda = 'USD' THEN 'cantidad, precio' WHEN cantidad = 7 THEN 'cantidad'
    WHEN moneda = 'USD' THEN 'precio' END AS columnas_invalidas FROM lt) WHERE columnas_invalidas IS NOT NULL GROUP BY 1""",
    "holiday_payload": "SELECT fecha, nombre, tipo FROM lh",
    "quote_payload": f"SELECT fecha, {dbl('compra')} AS compra, {dbl('venta')} AS venta FROM lq WHERE fecha >= DATE '1995-06-01' AND fecha <= DATE '2001-06-30'",
    "external_csv_typed": f"SELECT fecha, {dbl('compra')} AS compra, {dbl('venta')} AS venta, fuente FROM lq",
    "source_fallback_log": """SELECT 'missing' AS api, 'feriados' AS url, 'ERROR' AS estado, 0 AS filas, 'AnalysisException' AS detalle
UNION ALL SELECT 'empty', 'orders', 'ERROR', 0, 'EmptyPayload'
UNION ALL SELECT 'snapshot', 'orders', 'FALLBACK', CAST(COUNT(*) AS INTEGER), 'local snapshot' FROM lh""",
    "source_fallback": "SELECT fecha, nombre, tipo, 'snapshot' AS fuente FROM lh",
    "csv_export_typed": f"SELECT * FROM lc WHERE {ALERT}",
    "json_lines_export": CASES,
}


# Output of a published version -> the statement whose rows it holds.
OUTPUTS = {
    "clientes_riesgo": "alert_export", "operaciones": "trades_export", "clientes": "clients_export", "calendario": "calendar_export",
    "top_instrumentos": "top_instruments_export", "tramos_clientes": "buckets_export", "pareto": "pareto_export", "p3_top": "p3_top_long",
    "p4_precio_fuera_mercado": "p4_export", "api_log": "api_log_export", "perfiles_clientes": "client_profile_json",
    "detalle_precio_fuera_de_mercado": "p4_detail_nested"}
STATEMENTS["daily_update"] = f"""SELECT dia_art, moneda, fuente_tc, COUNT(*) AS ops, {dbl('SUM(monto_ars)')} AS monto_ars
FROM ee JOIN efx ON fecha = dia_art GROUP BY ALL"""
STATEMENTS["published_outputs"] = " UNION ALL ".join(
    f"SELECT '{name}' AS salida, COUNT(*) AS \"count\" FROM ({STATEMENTS[query]})" for name, query in OUTPUTS.items())
STATEMENTS["views_in_sql"] = f"""SELECT nivel_riesgo, canal, COUNT(*) AS ops, {dbl('SUM(lf.monto_ars)')} AS monto_ars, COUNT(DISTINCT lf.fecha) AS dias
FROM lf JOIN lc ON lc.id_cliente = lf.id_cliente JOIN ldc ON ldc.fecha = lf.fecha WHERE nivel_riesgo <> 'Sin alerta' GROUP BY nivel_riesgo, canal"""


def _needed(sql: str) -> set[str]:
    return set(re.findall(r"[a-z][a-z0-9]*", sql)) & BLOCKS.keys()


def _closure(sql: str) -> list[str]:
    """The blocks a statement uses, in an order in which each follows the ones it reads."""
    seen: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(_needed(text)):
            if name not in seen:
                visit(BLOCKS[name])
                seen.append(name)

    visit(sql)
    return seen


def statements() -> dict[str, str]:
    found = {}
    for name, sql in STATEMENTS.items():
        parts = ", ".join(f"{b} AS ({BLOCKS[b]})" for b in _closure(sql))
        found[name] = f"WITH {parts} {sql}" if parts else sql
    return found
