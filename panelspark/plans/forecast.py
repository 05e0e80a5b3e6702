"""Future days for all entities at once, scored, summarised and compared."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import fixed_values as fv
from panelspark.functions import scalars as S
from panelspark.operators import asof, correlation, joins, summary
from panelspark.sources import dimensions


def tomorrow() -> dt.date:
    return dt.date.today() + dt.timedelta(days=1)


def scaffold(entities: DataFrame, days: int, start: dt.date | Column | None = None,
             environment: dict[str, float] | None = None) -> DataFrame:
    """One row per entity and day with calendar, season and constant environment columns.

    The dates are exploded inside the row, so entities are neither joined nor moved. ``start``
    may be a column of ``entities``. ``environment`` replaces the default constants;
    :func:`with_covariates` puts observed values in their place.
    """
    start = F.lit(start or tomorrow()) if not isinstance(start, Column) else start
    first = start.cast("date")
    env = {"temperature": fv.FORECAST_TEMPERATURE, "humidity": fv.FORECAST_HUMIDITY,
           "pollution_index": fv.FORECAST_AQI, **(environment or {})}
    d = entities.withColumn("_d", F.explode(F.sequence(first, F.date_add(first, days - 1))))
    d = d.withColumns({"date": S.format_date("_d"), **S.calendar_features("_d", day=False),
                       **{k: F.lit(v) for k, v in env.items()}, "weather_condition_enc": F.lit(0)})
    return d.withColumn("season_enc", S.season_code("month")).drop("_d")


def with_covariates(days: DataFrame, covariates: DataFrame, by: list[str], names: list[str], date: str = "date") -> DataFrame:
    """Replace environment columns by the last observed ones on or before the day (as-of join).

    ``covariates`` has ``by``, ``date`` and ``names``; a day before the first observation, or a null observation, keeps the constant.
    """
    day = F.col(date).cast("date").alias("_day")
    given = days.withColumnsRenamed({n: f"_default_{n}" for n in names}).select("*", day)
    joined = asof.asof_join(given, covariates.select(*by, *names, day), by, "_day", names)
    filled = {n: F.coalesce(F.col(n).cast(days.schema[n].dataType), F.col(f"_default_{n}")) for n in names}
    return joined.withColumns(filled).select(*days.columns)


def city_metadata(entities: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """population, area_km2 and population_density per location; defaults for unknown places."""
    if metadata is None:
        metadata = F.broadcast(dimensions.city(entities.sparkSession).select("location", "population", "area_km2"))
    known = joins.lookup(entities, metadata, "location",
                         {"population": fv.DEFAULT_POPULATION, "area_km2": fv.DEFAULT_AREA_KM2})
    return known.withColumn("population_density", S.safe_ratio("population", "area_km2", 2))


def future_features(entities: DataFrame, days: int = 7, start: dt.date | None = None,
                    on_unknown: str = "error", metadata: DataFrame | None = None,
                    environment: dict[str, float] | None = None) -> DataFrame:
    """Model input for (location, sector, zone) entities: the 14 features plus date and keys."""
    e = city_metadata(entities, metadata).withColumns({
        "location_enc": S.encode("location", dimensions.city_names(), on_unknown),
        "sector_enc": S.encode("sector", dimensions.sector_names(), on_unknown),
        "zone_enc": S.encode("zone", dimensions.zone_names(), on_unknown)})
    return scaffold(e, days, start, environment)


def finish(scored: DataFrame, prediction: Column | str, keep: list[str], bounds=fv.FORECAST_BOUNDS,
           columns: list[str] = fv.FORECAST_COLUMNS) -> DataFrame:
    """Bound and round the prediction, keep the result columns."""
    value = F.round(S.clip(prediction, *bounds), 2)
    return scored.withColumn("predicted_waste", value).select(*keep, *columns)


def predict_future(entities: DataFrame, model: PipelineModel, days: int = 7, start: dt.date | None = None,
                   on_unknown: str = "error", metadata: DataFrame | None = None,
                   environment: dict[str, float] | None = None, covariates: DataFrame | None = None) -> DataFrame:
    """Forecast every entity for ``days`` days (published horizon: 1 to 14) in one batch.

    ``metadata`` and ``environment`` replace the built-in places and constant weather; ``covariates`` (location, date as text
    and any of temperature, humidity, pollution_index) give the last observed values.
    """
    features = future_features(entities, days, start, on_unknown, metadata, environment)
    if covariates is not None:
        names = [c for c in ("temperature", "humidity", "pollution_index") if c in covariates.columns]
        features = with_covariates(features, covariates, ["location"], names)
    return finish(model.transform(features), "prediction", ["location", "sector", "zone"])


def forecast_kpis(forecast: DataFrame, series: list[str]) -> DataFrame:
    return summary.kpis(forecast, "predicted_waste", series)


def alerts(kpis: DataFrame) -> DataFrame:
    """Alert level of each series from its peak."""
    return kpis.withColumn("alert", S.alert_level("peak"))


def peak_and_low(forecast: DataFrame, series: list[str]) -> DataFrame:
    return summary.extreme_rows(forecast, "predicted_waste", "date", ["date", "predicted_waste"], series)


def compare(forecast: DataFrame, series: str, names: list[str]) -> DataFrame:
    """Predicted value of the named series side by side per date."""
    return joins.side_by_side(forecast, "date", series, "predicted_waste", names)


def feature_correlations(forecast: DataFrame, by: list[str] | None = None) -> DataFrame:
    wanted = ["temperature", "humidity", "pollution_index", "population_density"]
    return correlation.target_correlations(
        forecast, "predicted_waste", [c for c in wanted if c in forecast.columns], by)


def city_map(kpis: DataFrame, cities: DataFrame, on: str = "location") -> DataFrame:
    """Every place with coordinates; places with a forecast also get its mean and level.

    A forecast for a place without coordinates is kept at (0, 0).
    """
    side = kpis.select(on, "avg")
    out = cities.join(side, on, "full")
    return out.select(on, F.coalesce("lat", F.lit(0.0)).alias("lat"), F.coalesce("lon", F.lit(0.0)).alias("lon"),
                      "avg", S.alert_level("avg").alias("level"))
