"""The whole chain: trades -> calendar, rate -> enriched -> profile, thresholds -> patterns -> score
-> star schema, exports and case files.

Every step is a named table. The ones that later steps read several times are stored as Parquet;
the enriched trades stay a view, because adding the rate and the calendar is a map-side join."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache, cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewarden.operators import joins
from tradewarden.operators.controls import key_report, require_key, row_counts, suspects
from tradewarden.params import Params
from tradewarden.plans import casefile, cube, market, patterns, profile, score, star
from tradewarden.sources import external, raw, sinks, versions
from tradewarden.sources.storage import BUCKET_ROWS, TableStore

# Buckets that Spark accepts.
MAX_BUCKETS = 100_000


class Pipeline:
    """Tables of one data set, built on first use."""

    def __init__(self, spark: SparkSession, trades: Callable[[], DataFrame], holidays: Callable[[], DataFrame],
                 quotes: Callable[[], DataFrame], log: Callable[[], DataFrame] | None = None,
                 params: Params = Params(), root: str | None = None, trades_by: tuple[str, ...] = (), refuse_keys: bool = True):
        """`refuse_keys`: stop at a repeated or missing key of a source table; else key_report tells."""
        self.spark, self.params, self._refuse = spark, params, refuse_keys
        self._sources = {"operaciones": trades, "feriados": holidays, "tipo_cambio_api": quotes}
        self._log, self._trades_by = log, trades_by
        self.store = TableStore(spark, root)
        self._checked: set[str] = set()
        self._doubtful: dict[str, DataFrame] = {}

    def _stored(self, name: str, build: Callable[[], DataFrame] | None = None, by: tuple[str, ...] = (),
                sort: tuple[str, ...] = ()) -> DataFrame:
        return self.store.get(name, build or self._sources[name], by, sort)

    def _keyed(self, name: str, key: str, by: tuple[str, ...] = (), sort: tuple[str, ...] = ()) -> DataFrame:
        """A stored source table, refused if its key repeats: a repeated day would multiply trades."""
        table = self._stored(name, by=by, sort=sort)
        if self._refuse and name not in self._checked:
            require_key(table, [key], name, self._suspects(name, table, key))
            self._checked.add(name)
        return table

    def _suspects(self, name: str, table: DataFrame, key: str) -> DataFrame:
        """Possible repetitions of a source table's key, looked for once."""
        if name not in self._doubtful:
            self._doubtful[name] = suspects(table, [key])
        return self._doubtful[name]

    @cached_property
    def trades(self) -> DataFrame:
        # Drill-through reads one client's trades.
        return self._keyed("operaciones", "id_transaccion", self._trades_by, ("id_cliente",))

    @cached_property
    def holidays(self) -> DataFrame:
        return self._keyed("feriados", "fecha")

    @cached_property
    def quotes(self) -> DataFrame:
        return self._keyed("tipo_cambio_api", "fecha")

    def forget(self) -> None:
        """Drop the frames built so far; stored tables stay and are read again."""
        for name in [n for n, v in vars(self).items() if isinstance(v, DataFrame)]:
            del self.__dict__[name]

    def key_report(self) -> DataFrame:
        """The enriched trades are trades, once each as long as no day repeats, so only suspects among the trades can repeat there."""
        keys = {"operaciones": (self.trades, "id_transaccion"), "feriados": (self.holidays, "fecha"),
                "tipo_cambio_api": (self.quotes, "fecha"), "calendario": (self.calendar, "fecha"), "tipo_cambio_diario": (self.fx, "fecha"),
                "dias": (self.rated_days, "fecha"), "perfil_cliente": (self.profile, "id_cliente"), "clientes_riesgo": (self.risk, "id_cliente")}
        found = {name: self._suspects(name, df, key) for name, (df, key) in keys.items()}
        tables = {name: (df, [key], found[name]) for name, (df, key) in keys.items() if name != "dias"}
        among = found["operaciones"] if found["dias"].isEmpty() else None
        return key_report(tables | {"operaciones_enriquecidas": (self.enriched, ["id_transaccion"], among)})

    @cached_property
    def api_log(self) -> DataFrame:
        return self._stored("api_log", self._log)

    @cached_property
    def calendar(self) -> DataFrame:
        return self._stored("calendario", lambda: market.business_calendar(self.trades, self.holidays, self.params))

    @cached_property
    def implied(self) -> DataFrame:
        return self._stored("mep_implicito", lambda: market.implied_fx(self.trades, self.params))

    @cached_property
    def fx(self) -> DataFrame:
        return self._stored("tipo_cambio_diario", lambda: market.daily_fx(
            self.calendar, self.trades, self.quotes, self.implied, self.params))

    @cached_property
    def rated_days(self) -> DataFrame:
        return self._stored("dias", lambda: market.rated_days(self.fx, self.calendar))

    @cached_property
    def enriched(self) -> DataFrame:
        return self._enriched(self.trades)

    def _enriched(self, trades: DataFrame) -> DataFrame:
        days = self.rated_days
        return market.enriched_trades(trades, days, self.store.rows("dias"))

    @cached_property
    def priced(self) -> DataFrame:
        """The enriched trades with their reference prices.

        As long as the prices can be broadcast, this is a view. Beyond that the trades are stored a second time, once, in buckets of
        symbol, day and the salt of hot cells: every reader then joins them where they lie."""
        references = self.references
        n = self.store.rows("precios_referencia")
        if n <= joins.BROADCAST_ROWS:
            return patterns.priced_trades(self.enriched, references, n)
        laid_out = self.store.bucketed("operaciones_por_especie", lambda: patterns.price_layout(self.trades, references),
                                       [*patterns.PRICE_KEYS, "_salt"], self._buckets())
        return joins.bucketed_join(self._enriched(laid_out), references, patterns.PRICE_KEYS, "ops_referencia")

    def _cube_part(self, name: str) -> DataFrame:
        """A grouping of the cube, stored by itself: a report needs one of them, and its rows are written where they were added up."""
        return self._stored(f"cubo_{name}", lambda: cube.activity_cube(self.trades, self.rated_days).where(F.col("conjunto") == name))

    @cached_property
    def cube(self) -> DataFrame:
        """What the counting reports read instead of the trades."""
        return self._cube_part(cube.CELLS).unionByName(self._cube_part(cube.CLIENTS))

    @cached_property
    def cells(self) -> DataFrame:
        return cube.cells(self._cube_part(cube.CELLS))

    @cached_property
    def client_cells(self) -> DataFrame:
        return cube.client_cells(self._cube_part(cube.CLIENTS))

    @cached_property
    def rated_cells(self) -> DataFrame:
        return cube.rated(self.cells)

    @cached_property
    def rated_client_cells(self) -> DataFrame:
        return cube.rated(self.client_cells)

    @cached_property
    def profile(self) -> DataFrame:
        def build() -> DataFrame:
            rows, hot = self._by_client()
            found = profile.client_profile(rows, self.params, together=True)
            return found if hot is None else found.unionByName(profile.client_profile(hot, self.params, self.n_trades))

        return self._stored("perfil_cliente", build)

    @cached_property
    def hot_clients(self) -> DataFrame:
        """Clients with more trades than the task of a bucket should hold: one for each BUCKET_ROWS trades at most."""
        return self._stored("clientes_muy_activos", lambda: self.enriched.groupBy("id_cliente").agg(F.count("*").alias("_ops")).where(
            F.col("id_cliente").isNotNull() & (F.col("_ops") > BUCKET_ROWS)))

    def _by_client(self) -> tuple[DataFrame, DataFrame | None]:
        """The enriched trades in buckets of the client, moved and stored once: profile and case files are made where they lie. Those of
        hot clients come apart, in even splits, if there are any."""
        few = F.broadcast(self.hot_clients)
        stored = self.store.bucketed("operaciones_por_cliente", lambda: profile.client_rows(self.enriched).join(few, "id_cliente", "left")
                                     .withColumn("_ops", F.coalesce("_ops", F.lit(1))), ["id_cliente"], self._buckets(), "_ops", "id_transaccion")
        if not self.store.rows("clientes_muy_activos"):
            return stored, None
        even = self.spark.read.parquet(self.store.path("operaciones_por_cliente"))
        return stored.join(few, "id_cliente", "left_anti"), even.join(few, "id_cliente", "left_semi")

    @cached_property
    def limits(self) -> DataFrame:
        return self._stored("umbrales", lambda: profile.thresholds(self.profile, self.enriched, self.params))

    @cached_property
    def days(self) -> DataFrame:
        return self._stored("dias_habiles", lambda: profile.working_days(self.enriched, self.params))

    @cached_property
    def references(self) -> DataFrame:
        return self._stored("precios_referencia", lambda: patterns.reference_prices(self.enriched, self.params))

    @cached_property
    def p1(self) -> DataFrame:
        return patterns.p1_high_activity(self.profile, self.limits)

    @cached_property
    def p2(self) -> DataFrame:
        return patterns.p2_atypical_hours(self.profile, self.limits, self.params)

    @cached_property
    def p3(self) -> DataFrame:
        return patterns.p3_behaviour_change(self.profile, self.days, self.params)

    @cached_property
    def p4(self) -> DataFrame:
        return self._stored("p4_precio_fuera_mercado", lambda: patterns.off_market_trades(self.priced, self.params))

    @cached_property
    def risk(self) -> DataFrame:
        return self._stored("clientes_riesgo", lambda: score.risk_score(
            self.profile, self.limits, self.days, self.p4, self.params))

    @cached_property
    def facts(self) -> DataFrame:
        return star.fact_trades(self.priced, self.limits, self.params)

    @cached_property
    def clients(self) -> DataFrame:
        return star.dim_client(self.profile, self.risk)

    @cached_property
    def dim_calendar(self) -> DataFrame:
        return star.dim_calendar(self.calendar, self.fx)

    @cached_property
    def client_month(self) -> DataFrame:
        return star.client_month(self.enriched)

    @cached_property
    def clients_export(self) -> DataFrame:
        return star.clients_export(self.clients)

    @cached_property
    def population(self) -> DataFrame:
        return casefile.population_reference(self.profile, self.limits)

    @cached_property
    def flagged(self) -> DataFrame:
        """The trades of flagged clients, read in even splits: a bucket as a whole would be one task, whatever its client."""
        self._flagged_buckets()
        return self.spark.read.parquet(self.store.path("operaciones_en_alerta"))

    def flagged_of(self, client: str) -> DataFrame:
        """One client's flagged trades, from the client's bucket."""
        return self._flagged_buckets().where(F.col("id_cliente") == client)

    def _flagged_buckets(self) -> DataFrame:
        return self.store.bucketed("operaciones_en_alerta", lambda: casefile.weighted_flagged_trades(self.enriched, self.risk).select(
            "id_cliente", "id_transaccion", "origen", "simbolo_titulo", "tipo_tran", "dia_art", "cantidad", "monto_ars", "_ops"),
            ["id_cliente"], self._buckets(), "_ops", "id_transaccion")

    def _buckets(self) -> int:
        """Buckets of some BUCKET_ROWS trades, and at least one per shuffle partition."""
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return min(MAX_BUCKETS, max(least, self.n_trades // BUCKET_ROWS))

    @property
    def n_trades(self) -> int:
        """Counted once, when the stored trades are first asked for."""
        self.trades  # noqa: B018
        return self.store.rows("operaciones")

    @cached_property
    def cases(self) -> DataFrame:
        def build() -> DataFrame:
            rows, hot = self._by_client()
            flagged = None if hot is None else hot.join(F.broadcast(self.risk.join(F.broadcast(self.hot_clients), "id_cliente", "left_semi")
                                                                    .select("id_cliente")), "id_cliente", "left_semi")
            return casefile.case_fields(self.risk, casefile.flagged_in_place(rows, self.risk), self.p4, self.population, self.params,
                                        together=True, hot=flagged)

        return self.store.bucketed("perfiles", build, ["id_cliente"], self._buckets())

    def case_of(self, client: str) -> DataFrame:
        """One client's case file: read from the stored ones if they are there, else built from the client's rows. Either way
        one bucket is read."""
        if self.store.has("perfiles"):
            return casefile.lookup_client(self.cases, client)
        return casefile.lookup_case(self.risk, self.flagged_of(client), self.p4, self.population, self.params, client)

    def views(self) -> dict[str, DataFrame]:
        found = {"vw_fact_operaciones": self.facts, "vw_dim_cliente": self.clients,
                 "vw_dim_calendario": self.dim_calendar, "vw_cliente_mes": self.client_month}
        if self._log:
            found["vw_api_log"] = star.api_log_view(self.api_log)
        return found

    def register_views(self) -> None:
        sinks.register_views(self.views())

    def view_counts(self) -> DataFrame:
        """Rows per view. The marks that the fact adds don't change its number of rows, so it is counted without them."""
        return row_counts(self.views() | {"vw_fact_operaciones": self.enriched}, "vista")

    def exports(self) -> dict[str, DataFrame]:
        tables = {
            "clientes_riesgo": star.alert_export(self.clients),
            "operaciones": star.trades_export(self.facts),
            "clientes": self.clients_export,
            "calendario": star.calendar_export(self.dim_calendar),
            "top_instrumentos": star.top_instruments_export(self.enriched),
            "tramos_clientes": star.buckets_export(self.client_cells),
            "pareto": star.pareto_export(self.profile, self.params),
            "p3_top": star.p3_top_long(self.p3, self.params),
            "p4_precio_fuera_mercado": patterns.p4_export(self.p4),
        }
        if self._log:
            tables["api_log"] = star.api_log_export(self.api_log)
        return tables

    def writers(self) -> dict[str, Callable[[str], None]]:
        """What writes each output to a path: exports as CSV, case files as JSON lines, nested details as a table."""
        found = {name: partial(sinks.write_csv, df) for name, df in self.exports().items()}
        found["perfiles_clientes"] = partial(sinks.write_json_lines, casefile.client_profile_json(self.cases))
        found["detalle_precio_fuera_de_mercado"] = partial(sinks.save_table, casefile.p4_detail_nested(self.p4, self.params))
        return found

    def publish(self, out: str) -> None:
        """Write every output straight below `out`, one after the other."""
        for name, write in self.writers().items():
            write(f"{out}/{name}")

    def publish_version(self, out: str, keep: int = 2) -> versions.Version:
        """Publish all outputs at once, as a version that readers find by `versions.current`."""
        return versions.publish(self.spark, out, self.writers(), keep)


def from_files(spark: SparkSession, trades_csv: str, holidays_csv: str, quotes_csv: str, log_csv: str,
               params: Params = Params(), root: str | None = None, trades_by: tuple[str, ...] = ("dia_art",)) -> Pipeline:
    """The pipeline over a trade file and the fetched external data. Trades are stored by day,
    so that day ranges read only their partitions."""
    return Pipeline(
        spark, lambda: raw.type_trades(raw.read_trade_file(spark, trades_csv), params.local_zone),
        lambda: external.read_csv(spark, holidays_csv, external.HOLIDAY_SCHEMA),
        lambda: external.read_csv(spark, quotes_csv, external.QUOTE_SCHEMA),
        lambda: external.read_csv(spark, log_csv, external.LOG_SCHEMA), params, root, trades_by)


def from_sources(spark: SparkSession, trades_csv: str, holidays: Sequence[external.Source], quotes: Sequence[external.Source],
                 params: Params = Params(), root: str | None = None, trades_by: tuple[str, ...] = ("dia_art",)) -> Pipeline:
    """The pipeline over a trade file and external data that may have landed in several places: of holidays and quotes the
    first source that loads is taken, and every attempt is in the call log. Without any quotes the implied rate is used;
    without any holidays the run stops."""
    @cache
    def found_holidays() -> tuple[DataFrame | None, DataFrame]:
        return external.first_available(spark, holidays, error_detail=params.error_detail)

    @cache
    def found_quotes() -> tuple[DataFrame | None, DataFrame]:
        nothing = (quotes[-1].api if quotes else "quotes", "-", "no quotes: the implied rate is used")
        return external.first_available(spark, quotes, none_left=nothing, error_detail=params.error_detail)

    def holiday_rows() -> DataFrame:
        rows, log = found_holidays()
        if rows is None:
            raise external.EmptyPayload(f"no source has holidays: {[r['detalle'] for r in log.collect()]}")
        return rows

    def quote_rows() -> DataFrame:
        rows, _ = found_quotes()
        return spark.createDataFrame([], external.QUOTE_SCHEMA) if rows is None else rows

    return Pipeline(
        spark, lambda: raw.type_trades(raw.read_trade_file(spark, trades_csv), params.local_zone), holiday_rows, quote_rows,
        lambda: found_holidays()[1].unionByName(found_quotes()[1]), params, root, trades_by)


def load_control(raw_rows: DataFrame, typed: DataFrame) -> DataFrame:
    return row_counts({"raw": raw_rows, "tipada": typed}, "tabla")
