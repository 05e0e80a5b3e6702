"""The waste panel from weather days to the ML-ready table, as one lazy plan per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import fixed_values as fv
from panelspark.functions import scalars as S
from panelspark.functions.hashing import normal, row_hash
from panelspark.operators import joins, project, quality, quantiles, ranking, sampling
from panelspark.sources import dimensions

PANEL_KEY = ["location", "date", "sector", "zone"]


def impute_weather(weather: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Fill temperature and humidity by city median, map the weather code to its label."""
    filled = quantiles.fill_group_median(weather, ["location"], ["temperature", "humidity"], accuracy)
    return (filled.withColumn("weather_condition", S.weather_label("weather_code"))
            .drop("weather_code"))


def cell_measures(readings: DataFrame) -> DataFrame:
    """Stored readings to one row per place, day, sector and zone.

    The amounts of a cell add up (as decimals, so in any order alike), its pollution index is the day's highest. Cells
    without an amount, or without an index, have null there.
    """
    amount = F.sum(F.col("waste_amount").try_cast("decimal(18,2)")).cast("double")
    return readings.groupBy(*PANEL_KEY).agg(amount.alias("measured_waste"), F.max(F.nanvl(
        F.col("pollution_index").cast("double"), F.lit(None).cast("double"))).alias("measured_pollution"))


def _measured_or_expected(df: DataFrame, name: str, measured: str, terms: list, bounds: tuple, digits: int) -> DataFrame:
    expected = project.with_bounded_sum(df, name, terms, *bounds, digits)
    if measured not in df.columns:
        return expected
    stored = F.round(S.clip(measured, *bounds), digits)
    return expected.withColumn(name, F.when(F.col(measured).isNotNull(), stored).otherwise(F.col(name)))


def with_air_quality(df: DataFrame) -> DataFrame:
    """pollution_index: ``measured_pollution`` where the cell has one, else base index plus humidity effect; bounded, 1 decimal."""
    terms = [F.col("aqi_base"), (F.col("humidity") - 60) * F.lit(0.3)]
    return _measured_or_expected(df, "pollution_index", "measured_pollution", terms, fv.AQI_BOUNDS, 1)


def with_waste_amount(df: DataFrame) -> DataFrame:
    """waste_amount: ``measured_waste`` where the cell has one, else what population, temperature, humidity and
    sector by zone let expect; bounded, 2 decimals."""
    terms = [
        F.col("population") * F.lit(fv.WASTE_PER_PERSON),
        F.col("temperature") * F.lit(fv.WASTE_PER_DEGREE),
        F.col("humidity") * F.lit(fv.WASTE_PER_HUMIDITY),
        F.col("weight") * F.col("modifier"),
    ]
    return _measured_or_expected(df, "waste_amount", "measured_waste", terms, fv.WASTE_BOUNDS, 2)


def build_raw(weather: DataFrame, readings: DataFrame | None = None) -> DataFrame:
    """Weather days (location, date, temperature, humidity, weather_code, population) to the raw panel: imputed,
    expanded by sector and zone, with both measures.

    ``readings`` (location, date, sector, zone, waste_amount, pollution_index; any number a cell, dates written as in
    ``weather``) are the stored measures. Cells without them, or all without ``readings``, get the expected values. Readings of days or cells that
    the panel does not hold are left out. The grouping of the readings and the join share one shuffle on the cell.
    """
    spark = weather.sparkSession
    base = dimensions.city(spark).select("location", "aqi_base")
    days = joins.lookup(impute_weather(weather), F.broadcast(base), "location")
    cells = joins.cross_expand(days, {"sector": list(fv.SECTOR_WEIGHTS)}, {"zone": list(fv.ZONE_MODIFIERS)})
    cells = joins.lookup(cells, dimensions.sector_weight(spark), "sector")
    cells = joins.lookup(cells, dimensions.zone_modifier(spark), "zone")
    if readings is not None:
        cells = cells.join(cell_measures(readings), PANEL_KEY, "left")
    typed = with_waste_amount(with_air_quality(cells)).withColumns({
        "date": S.format_date(S.parse_date("date")),
        "temperature": F.round("temperature", 1),
        "humidity": F.col("humidity").cast("bigint"),
        "population": F.col("population").cast("bigint")})
    return project.keep(typed, fv.RAW_COLUMNS)


def shuffled(raw: DataFrame, seed: int = fv.SEED) -> DataFrame:
    return sampling.shuffle_rows(raw, PANEL_KEY, seed)


def repair_cap(df: DataFrame, seed: int = 99, column: str = fv.TARGET, key: list[str] = PANEL_KEY,
               cap: float = fv.WASTE_CAP) -> DataFrame:
    """Replace saturated readings by bounded pseudo-normal values; flag them in ``was_capped``."""
    draw = normal(row_hash(key, seed), fv.CAP_REPAIR_MEAN, fv.CAP_REPAIR_STD)
    new = F.round(S.clip(draw, *fv.CAP_REPAIR_BOUNDS), 2)
    fixed = S.repair_capped(column, cap, new)
    return df.withColumns({"was_capped": fixed["was_capped"], column: fixed["value"]})


def engineer(raw: DataFrame, narrow: bool = True) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Raw panel to the cleaned feature table, and the label mapping of each category."""
    spark = raw.sparkSession
    d = raw.withColumn("date", S.parse_date("date"))
    d = d.withColumns(S.calendar_features("date"))
    d = d.withColumn("season", S.season("month"))
    labels = d
    d = repair_cap(d).drop("was_capped").dropDuplicates()
    if narrow:
        d = project.cast(d, fv.NARROW_TYPES)
    area = F.broadcast(dimensions.city(spark).select("location", F.col("area_km2").cast("float").alias("area_km2")))
    d = joins.lookup(d, area, "location")
    d = d.withColumns({
        "population_density": S.safe_ratio(F.col("population"), F.col("area_km2"), 2).cast("float" if narrow else "double"),
        "date": S.format_date("date")})
    d, maps = ranking.label_encode(d, ["sector", "weather_condition", "location", "season", "zone"], source=labels)
    return project.keep(d, fv.CLEAN_COLUMNS), maps


CLEAN_TYPES = {**{c: "double" for c in fv.DOUBLE_COLUMNS}, **{c: "int" for c in fv.INT_COLUMNS}}


def clean(df: DataFrame) -> DataFrame:
    """Typed, de-duplicated, complete rows of the cleaned table."""
    return quality.clean(df, CLEAN_TYPES, ["date"])


def clean_audit(df: DataFrame) -> DataFrame:
    return quality.clean_audit(df, CLEAN_TYPES, ["date"])


def ml_ready(df: DataFrame) -> DataFrame:
    """Model features and target, without identifiers and text columns."""
    return project.keep(df, fv.ML_COLUMNS)
