"""Row-wise column expressions. Every function takes and returns a Spark ``Column``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.functions import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, formats: tuple[str, ...] = ("yyyy-MM-dd", "dd-MM-yyyy")) -> Column:
    """First format that fits; null when none does."""
    # length guard: a pattern of letters also accepts fewer or more digits in some positions
    text = F.trim(_col(c))
    return F.coalesce(*[F.when(F.length(text) == len(f), F.try_to_date(text, f)) for f in formats])


def format_date(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def calendar_features(date: Column | str, day: bool = True) -> dict[str, Column]:
    """year, month, day, day_of_week (0 = Monday) and is_weekend of a date."""
    d = _col(date)
    out = {"year": F.year(d), "month": F.month(d)}
    if day:
        out["day"] = F.dayofmonth(d)
    out["day_of_week"] = F.weekday(d)
    out["is_weekend"] = is_weekend(F.weekday(d))
    return out


def is_weekend(day_of_week: Column | str) -> Column:
    return (_col(day_of_week) >= 5).cast("int")


def season(month: Column | str) -> Column:
    """Season label of a month number; null month gives null."""
    m = _col(month)
    chain = None
    for label, months in fv.SEASON_MONTHS.items():
        hit = m.isin(*months)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain


def season_code(month: Column | str) -> Column:
    """Season code of a month number (alphabetical position of the label)."""
    m = _col(month)
    chain = None
    for label, months in fv.SEASON_MONTHS.items():
        hit, code = m.isin(*months), F.lit(fv.SEASON_CODES[label])
        chain = F.when(hit, code) if chain is None else chain.when(hit, code)
    return chain


def month_name(month: Column | str) -> Column:
    """Jan..Dec; null outside 1..12."""
    m = _col(month).cast("int")
    valid = F.when(m.between(1, 12), m)
    return F.date_format(F.make_date(F.lit(2000), valid, F.lit(1)), "MMM")


def lookup(c: Column | str, mapping: dict, default=None) -> Column:
    """Value of a small literal dictionary, or the default (null) for unknown and null keys."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, _col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def weather_label(code: Column | str) -> Column:
    """WMO code to label; null counts as 0, unlisted codes as the default label."""
    return lookup(F.coalesce(_col(code).cast("int"), F.lit(0)), fv.WMO_LABELS, fv.WMO_DEFAULT)


def encode(c: Column | str, names: list[str], on_unknown: str = "error") -> Column:
    """Code of a name = its position in ``names``.

    on_unknown: "error" raises at run time, "null" gives null, "zero" gives code 0.
    """
    if on_unknown not in ("error", "null", "zero"):
        raise ValueError(f"on_unknown: {on_unknown!r}")
    code = lookup(c, {n: i for i, n in enumerate(names)})
    if on_unknown == "zero":
        return F.coalesce(code, F.lit(0))
    if on_unknown == "null":
        return code
    message = F.concat(F.lit("no code for value: "), F.coalesce(_col(c).cast("string"), F.lit("NULL")))
    return F.coalesce(code, F.raise_error(message).cast("int"))


def decode(code: Column | str, names: list[str]) -> Column:
    """Name of a code; null for codes outside the list."""
    return lookup(code, dict(enumerate(names)))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Bound to [lo, hi]; null stays null (greatest/least alone would skip it)."""
    x = _col(c)
    return F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def round_to(c: Column | str, digits: int, half_even: bool = False) -> Column:
    return (F.bround if half_even else F.round)(_col(c), digits)


def safe_ratio(a: Column | str, b: Column | str, digits: int | None = None) -> Column:
    """a / b, null when b is 0."""
    r = F.try_divide(_col(a), _col(b))
    return r if digits is None else F.round(r, digits)


def residual(actual: Column | str, predicted: Column | str) -> Column:
    return _col(actual) - _col(predicted)


def abs_error(actual: Column | str, predicted: Column | str) -> Column:
    return F.abs(residual(actual, predicted))


def alert_level(c: Column | str, high: float = fv.ALERT_HIGH, moderate: float = fv.ALERT_MODERATE) -> Column:
    """High / Moderate / Normal with strict bounds; null stays null."""
    x = _col(c)
    return F.when(x > high, "High").when(x > moderate, "Moderate").when(x.isNotNull(), "Normal")


def repair_capped(c: Column | str, cap: float, replacement: Column) -> dict[str, Column]:
    """Value with saturated readings replaced, and a flag that marks them."""
    x = _col(c)
    hit = F.coalesce(x == cap, F.lit(False))
    return {"value": F.when(hit, replacement).otherwise(x), "was_capped": hit}


def future_date(start: Column | str, days: Column | int) -> Column:
    return F.date_add(_col(start), days)
