"""Pipelines over the benchmark tables, one per session and folder.

The ids that the adapters make are not always unique in these tables, so repeated keys are reported, not refused."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession

from tradewarden.params import Params
from tradewarden.plans.pipeline import Pipeline
from tradewarden.sources import adapters

# events cover January 2024, so the follow-up periods are parts of that month
EVENT_PARAMS = Params(
    period_starts=(date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 21), date(2024, 2, 1)))
# order lines cover 1995 to 2001, with a few trades of the rate bond per day
LINE_PARAMS = Params(
    fx_min_trades=1, activity_quantile=0.99,
    period_starts=(date(1995, 1, 1), date(1996, 1, 1), date(1999, 1, 1), date(2002, 1, 1)))

_built: dict[tuple[str, str, str], Pipeline] = {}


def _once(kind: str, spark: SparkSession, sf_dir: str, build) -> Pipeline:
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def new_event_pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline(
        spark, lambda: adapters.event_trades(spark, sf_dir, EVENT_PARAMS.local_zone),
        lambda: adapters.event_holidays(spark, sf_dir), lambda: adapters.event_quotes(spark, sf_dir),
        lambda: adapters.event_log(spark, sf_dir), EVENT_PARAMS, refuse_keys=False)


def new_line_pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline(
        spark, lambda: adapters.line_trades(spark, sf_dir, LINE_PARAMS.local_zone),
        lambda: adapters.line_holidays(spark, sf_dir), lambda: adapters.line_quotes(spark, sf_dir),
        lambda: adapters.event_log(spark, sf_dir), LINE_PARAMS, refuse_keys=False)


def event_pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    return _once("events", spark, sf_dir, lambda: new_event_pipeline(spark, sf_dir))


def line_pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    return _once("lines", spark, sf_dir, lambda: new_line_pipeline(spark, sf_dir))
