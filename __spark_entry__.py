
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle_queries
from tradewarden.operators import controls
from tradewarden.plans import casefile, daily, explore, market, measures, patterns, profile, score, star
from tradewarden.plans.datasets import event_pipeline, line_pipeline
from tradewarden.plans.pipeline import Pipeline, load_control
from tradewarden.sources import adapters, external, raw, sinks, versions
from tradewarden.sources.storage import TableStore

try:
    import corpus_pipeline
    from tradewarden.llm import queries as llm_queries
except ModuleNotFoundError as missing:  # the subpackage is optional; what it needs itself is not
    if missing.name not in ("corpus_pipeline", "tradewarden.llm"):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and nested values as JSON text, so that both engines return the same types."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _on(pipeline: Callable[[SparkSession, str], Pipeline], build: Callable[[Pipeline], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(build(pipeline(spark, sf_dir)))


def _on_tables(build: Query) -> Query:
    return lambda spark, sf_dir: _plain(build(spark, sf_dir))


def _top_client(p: Pipeline) -> str | None:
    """The client of the drill-through page: the first of the review queue. A value, as a user would give it, so that buckets
    and row groups can be chosen by it."""
    return p.risk.agg(F.max_by("id_cliente", F.struct("score", "monto_ars", "id_cliente"))).collect()[0][0]


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.raw_text_trades(line_pipeline(spark, sf_dir).trades)


def _csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades written as a text CSV, read back through the staging schema and typed. Descriptions hold quotes and commas,
    and the times of odd quantities are written with the local offset."""
    p = line_pipeline(spark, sf_dir)
    path = TableStore(spark).path("operaciones_raw")
    quoted = F.concat(F.lit('"'), "descripcion_titulo", F.lit('", serie A'))
    text = adapters.raw_text_trades(p.trades.withColumn("descripcion_titulo", quoted), F.col("cantidad") % 2 == 1)
    sinks.write_csv(text, path)
    return raw.type_trades(raw.read_trade_file(spark, path), p.params.local_zone)


def _csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client export written as CSV and read back with types and t / f booleans."""
    path = TableStore(spark).path("clientes_csv")
    table = star.alert_export(line_pipeline(spark, sf_dir).clients)
    sinks.write_csv(table, path)
    return sinks.read_exported_csv(spark, path, {f.name: f.dataType.simpleString() for f in table.schema.fields})


def _json_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case files written as JSON lines and read back, every field of them."""
    path = TableStore(spark).path("perfiles_json")
    sinks.write_json_lines(casefile.client_profile_json(line_pipeline(spark, sf_dir).cases), path)
    field = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return spark.read.text(path).select(field("id_cliente"), field("nivel_riesgo"),
                                        F.get_json_object("value", "$.score").cast("int").alias("score"), F.col("value").alias("perfil"))


def _daily(p: Pipeline) -> DataFrame:
    """Volumes from tables that were built up to the day before the last and then brought up to date."""
    run = daily.DailyRun(p.spark, p.store.path("diaria"), p.params)
    run.update(p.trades.where(F.col("dia_art") < p.cells.agg(F.max("dia_art")).scalar()), p.holidays, p.quotes)
    run.update(p.trades, p.holidays, p.quotes)
    rows = run.cells.read().where("con_tc").join(run.rates.read().select(F.col("fecha").alias("dia_art"), "fuente_tc"), "dia_art")
    return rows.groupBy("dia_art", "moneda", "fuente_tc").agg(F.sum("ops").alias("ops"), F.sum("monto_ars").alias("monto_ars"))


def _published(p: Pipeline) -> DataFrame:
    """Rows of each output of the current version, read back from where its manifest leads."""
    out = p.store.path("publicacion")
    p.publish_version(out)
    version = versions.current(p.spark, out)
    readers = {"perfiles_clientes": p.spark.read.text, "detalle_precio_fuera_de_mercado": p.spark.read.parquet}
    tables = {n: readers.get(n, p.spark.read.option("header", True).csv)(version.path(n)) for n in version.outputs}
    return controls.row_counts(tables, "salida")


def _through_views(p: Pipeline) -> DataFrame:
    """Alerted clients per level and channel, in SQL over the registered views."""
    p.register_views()
    return p.spark.sql("""SELECT d.nivel_riesgo, f.canal, COUNT(*) AS ops, SUM(f.monto_ars) AS monto_ars,
        COUNT(DISTINCT f.fecha) AS dias FROM vw_fact_operaciones f JOIN vw_dim_cliente d ON d.id_cliente = f.id_cliente
        JOIN vw_dim_calendario c ON c.fecha = f.fecha WHERE d.nivel_riesgo <> 'Sin alerta' GROUP BY d.nivel_riesgo, f.canal""")


def _holiday_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holiday objects written as one JSON array, as the service sends them, read and parsed."""
    path = TableStore(spark).path("feriados_json")
    items = adapters.holiday_payload(spark, sf_dir)
    items.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).write.text(path)  # a few holidays per year
    return external.parse_holidays(external.read_json_items(spark, path, external.HOLIDAY_PAYLOAD), adapters.PAYLOAD_YEAR)


def _quote_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote objects written as JSON lines, read and parsed."""
    path = TableStore(spark).path("cotizaciones_json")
    adapters.quote_payload(spark, sf_dir).write.json(path)
    items = external.read_json_items(spark, path, external.QUOTE_PAYLOAD, lines=True)
    return external.parse_quotes(items, date(1995, 6, 1), date(2001, 6, 30))


def _dropped(p: Pipeline) -> DataFrame:
    """Trades without a rate, under rate bounds that leave days out."""
    bounds = replace(p.params, fx_start=date(2024, 1, 5), fx_end=date(2024, 1, 24))
    return market.dropped_trades(p.trades, market.daily_fx(p.calendar, p.trades, p.quotes, p.implied, bounds))


def _lookup(p: Pipeline) -> DataFrame:
    return casefile.client_profile_json(p.case_of(_top_client(p)))


def _external_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes written as a CSV file, read back with declared types."""
    path = TableStore(spark).path("tipo_cambio_csv")
    sinks.write_csv(adapters.line_quotes(spark, sf_dir), path)
    return external.read_csv(spark, path, external.QUOTE_SCHEMA)


def _first_source(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Holidays from the first of three sources that has any; the first two are missing and empty."""
    days = adapters.line_holidays(spark, sf_dir).drop("fuente")
    return external.first_available(spark, [
        external.Source("missing", "feriados", lambda: spark.read.parquet(f"{sf_dir}/feriados.parquet")),
        external.Source("empty", "orders", lambda: days.where(F.col("nombre") == "")),
        external.Source("snapshot", "orders", lambda: days, fallback=True, detail="local snapshot")])


def _source_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of the attempts; of an error's text its kind."""
    kind = F.substring_index("detalle", ":", 1)
    return _first_source(spark, sf_dir)[1].select("api", "url", "estado", "filas", kind.alias("detalle"))


# Queries over trades made from events: hours, days, calendar and rates.
EVENTS: dict[str, Callable[[Pipeline], DataFrame]] = {
    "overview": lambda p: explore.overview(p.trades, p.client_cells),
    "dq_counts": lambda p: explore.dq_counts(p.trades),
    "dq_logical_dupes": lambda p: explore.dq_logical_dupes(p.trades),
    "ms_flag_by_channel": lambda p: explore.ms_flag_by_channel(p.trades),
    "symbol_controls": lambda p: explore.symbol_controls(p.trades),
    "by_weekday": lambda p: explore.by_weekday(p.cells),
    "by_hour": lambda p: explore.by_hour(p.cells),
    "atypical_bands": lambda p: explore.atypical_bands(p.cells),
    "off_hours_by_channel": lambda p: explore.off_hours_by_channel(p.cells),
    "daily_window": lambda p: explore.daily_window(p.trades, date(2024, 1, 2), date(2024, 1, 20)),
    "days_without_activity": lambda p: explore.days_without_activity(
        p.trades, F.date_sub("primero", 20), F.date_add("ultimo", 20)),
    "api_log_report": lambda p: market.api_log_report(p.api_log),
    "business_calendar": lambda p: p.calendar,
    "holidays_with_activity": lambda p: market.holidays_with_activity(
        p.calendar, p.cells, F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 31))),
    "implied_fx": lambda p: p.implied,
    "daily_fx": lambda p: p.fx,
    "fx_summary": lambda p: market.fx_summary(p.fx),
    "fx_crosscheck": lambda p: market.fx_crosscheck(p.quotes, p.implied),
    "enriched_trades": lambda p: p.enriched,
    "dropped_trades": _dropped,
    "implied_only_fx": lambda p: market.daily_fx(p.calendar, p.trades, p.quotes.where(F.lit(False)), p.implied, p.params),
    "by_day_type": lambda p: market.by_day_type(p.rated_client_cells),
    "volume_by_currency_ars": lambda p: market.volume_by_currency_ars(p.rated_cells),
    "monthly_volume": lambda p: market.monthly_volume(p.rated_cells),
    "bands_by_channel": lambda p: patterns.bands_by_channel(p.rated_cells),
    "weekday_time_span": lambda p: patterns.weekday_time_span(p.rated_cells),
    "daily_update": _daily,
    "api_log_view": lambda p: star.api_log_view(p.api_log),
    "api_log_export": lambda p: star.api_log_export(p.api_log),
}

# Queries over trades made from order lines: clients, amounts, prices, scores and publication.
LINES: dict[str, Callable[[Pipeline], DataFrame]] = {
    "top_instruments": lambda p: explore.top_instruments(p.trades, p.cells),
    "instrument_families": lambda p: explore.instrument_families(p.trades, p.cells),
    "by_channel": lambda p: explore.by_channel(p.client_cells),
    "by_currency": lambda p: explore.by_currency(p.cells),
    "by_side": lambda p: explore.by_side(p.cells),
    "channel_mix": lambda p: explore.channel_mix(p.cells),
    "amount_percentiles": lambda p: explore.amount_percentiles(p.trades),
    "largest_quantity": lambda p: explore.largest_quantity(p.trades),
    "activity_buckets": lambda p: explore.activity_buckets(p.client_cells),
    "concentration_curve": lambda p: explore.concentration_curve(p.client_cells, p.params),
    "top_clients": lambda p: explore.top_clients(p.trades, p.client_cells),
    "client_profile": lambda p: p.profile,
    "thresholds": lambda p: p.limits,
    "thresholds_report": lambda p: profile.thresholds_report(p.limits),
    "working_days": lambda p: p.days,
    "p1_high_activity": lambda p: p.p1,
    "p1_summary": lambda p: patterns.p1_summary(p.p1, p.profile),
    "p1_top_amount": lambda p: patterns.p1_top_amount(p.p1),
    "p1_top_frequency": lambda p: patterns.p1_top_frequency(p.p1),
    "p1_channel_lift": lambda p: patterns.p1_channel_lift(p.rated_client_cells, p.p1),
    "p1_instruments": lambda p: patterns.p1_instruments(p.enriched, p.p1),
    "extreme_trades_by_channel": lambda p: patterns.extreme_trades_by_channel(p.enriched, p.limits),
    "nonbusiness_concentration": lambda p: patterns.nonbusiness_concentration(p.rated_client_cells),
    "p2_atypical_hours": lambda p: p.p2,
    "p2_summary": lambda p: patterns.p2_summary(p.p2, p.params),
    "p2_list": lambda p: patterns.p2_list(p.p2, p.params),
    "p3_behaviour_change": lambda p: p.p3,
    "p3_summary": lambda p: patterns.p3_summary(p.p3),
    "p3_top_frequency": lambda p: patterns.p3_top_frequency(p.p3),
    "p3_top_amount": lambda p: patterns.p3_top_amount(p.p3),
    "reference_prices": lambda p: p.references,
    "p4_off_market_price": lambda p: p.p4,
    "p4_summary": lambda p: patterns.p4_summary(p.p4),
    "p4_detail": lambda p: patterns.p4_detail(p.p4),
    "p4_by_channel": lambda p: patterns.p4_by_channel(p.p4),
    "risk_score": lambda p: p.risk,
    "risk_levels": lambda p: score.risk_levels(p.risk, p.profile),
    "review_queue": lambda p: score.review_queue(p.risk, p.params),
    "fact_trades": lambda p: p.facts,
    "dim_client": lambda p: p.clients,
    "dim_calendar": lambda p: p.dim_calendar,
    "client_month": lambda p: p.client_month,
    "view_counts": lambda p: p.view_counts(),
    "alert_export": lambda p: star.alert_export(p.clients),
    "trades_export": lambda p: star.trades_export(p.facts),
    "clients_export": lambda p: p.clients_export,
    "calendar_export": lambda p: star.calendar_export(p.dim_calendar),
    "top_instruments_export": lambda p: star.top_instruments_export(p.enriched),
    "buckets_export": lambda p: star.buckets_export(p.client_cells),
    "pareto_export": lambda p: star.pareto_export(p.profile, p.params),
    "p3_top_long": lambda p: star.p3_top_long(p.p3, p.params),
    "p4_export": lambda p: patterns.p4_export(p.p4),
    "flagged_trades": lambda p: p.flagged,
    "ops_by_channel_map": lambda p: casefile.ops_by_channel(p.flagged),
    "top5_instruments": lambda p: casefile.top5_instruments(p.flagged),
    "same_day_round_trips": lambda p: casefile.same_day_round_trips(p.flagged),
    "client_dates_median": lambda p: casefile.client_dates_median(p.flagged),
    "p4_detail_nested": lambda p: casefile.p4_detail_nested(p.p4, p.params),
    "population_reference": lambda p: p.population,
    "client_profile_json": lambda p: casefile.client_profile_json(p.cases),
    "profile_extras": lambda p: casefile.profile_extras(p.flagged),
    "lookup_client": _lookup,
    "pipeline_keys": lambda p: p.key_report(),
    "list_clients_by_level": lambda p: casefile.list_clients(p.clients, level="Alto"),
    "list_clients_by_rule": lambda p: casefile.list_clients(p.clients, rule="p4_precio_fuera_mercado"),
    "daily_job": lambda p: casefile.daily_job(casefile.client_profile_json(p.cases)),
    "trade_measures": lambda p: measures.trade_measures(p.facts),
    "client_measures": lambda p: measures.client_measures(p.clients),
    "kpi_cards": lambda p: measures.kpi_cards(p.facts, p.clients),
    "volume_by_level": lambda p: measures.volume_by_level(p.clients),
    "trades_by_day": lambda p: measures.trades_by_day(p.rated_cells),
    "trades_by_channel": lambda p: measures.trades_by_channel(p.rated_cells),
    "hour_weekday_heatmap": lambda p: measures.hour_weekday_heatmap(p.rated_cells, p.dim_calendar),
    "bands_within_channel": lambda p: measures.bands_within_channel(p.rated_cells),
    "top10_by_amount": lambda p: measures.top_clients_by_amount(p.clients_export),
    "top10_by_ops": lambda p: measures.top_clients_by_ops(p.clients_export),
    "p3_pivot": lambda p: measures.p3_pivot(star.p3_top_long(p.p3, p.params), p.params.period_names),
    "review_table": lambda p: measures.review_table(p.clients, ("Alto", "Medio"), ("1-URGENT", "2-HIGH")),
    "client_card": lambda p: measures.client_card(p.clients, _top_client(p)),
    "client_daily": lambda p: measures.client_daily(p.facts, _top_client(p)),
    "client_trades": lambda p: measures.client_trades(p.facts, _top_client(p)),
    "fx_line": lambda p: measures.fx_line(star.calendar_export(p.dim_calendar), 20010630),
    "holiday_list": lambda p: measures.holiday_list(star.calendar_export(p.dim_calendar), 20010630),
    "published_outputs": _published,
    "views_in_sql": _through_views,
    "cumulative_share": lambda p: measures.cumulative_share(p.clients),
}

# Queries on sources and sinks, straight from the tables.
TABLES: dict[str, Query] = {
    "csv_load_typed": _csv_load,
    "primary_key_check": lambda spark, sf_dir: controls.duplicate_keys(
        adapters.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "load_control": lambda spark, sf_dir: load_control(
        _raw_lines(spark, sf_dir), raw.type_trades(_raw_lines(spark, sf_dir), "America/Argentina/Buenos_Aires")),
    "reject_rows": lambda spark, sf_dir: raw.reject_rows(_raw_lines(spark, sf_dir).withColumns({
        "precio": F.when(F.col("moneda") == "USD", F.concat(F.lit("U$S "), "precio")).otherwise(F.col("precio")),
        "cantidad": F.when(F.col("cantidad") == "7", F.lit("siete")).otherwise(F.col("cantidad"))})
    ).groupBy("columnas_invalidas").agg(F.count("*").alias("filas")),
    "holiday_payload": _holiday_payload,
    "quote_payload": _quote_payload,
    "external_csv_typed": _external_csv,
    "source_fallback": lambda spark, sf_dir: _first_source(spark, sf_dir)[0],
    "source_fallback_log": _source_log,
    "csv_export_typed": _csv_export,
    "json_lines_export": _json_export,
}


def entry(spark: SparkSession) -> DataFrame:
    """Risk score of every flagged client, over the smallest tables."""
    return queries()["risk_score"](spark, "/root/testdata/sf0.001")


def library_queries() -> dict[str, Query]:
    """The queries that have nothing to do with the optional subpackage."""
    found: dict[str, Query] = {name: _on(event_pipeline, build) for name, build in EVENTS.items()}
    found |= {name: _on(line_pipeline, build) for name, build in LINES.items()}
    found |= {name: _on_tables(build) for name, build in TABLES.items()}
    return found


def queries() -> dict[str, Query]:
    found = library_queries()
    if llm_queries:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    return oracle_queries.statements() | (llm_queries.oracle_sql() if llm_queries else {})
