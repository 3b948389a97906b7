"""Ratios, value cleaning and classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.times import as_col

MONEY = "decimal(27,9)"

# Accepted spellings of the sex field.
MALE = ("m", "M")
FEMALE = ("f", "F", "W")

# Points per currency unit, by currency; every other currency is 1.
POINT_RATES = {
    1000: ("AUD", "BRL", "CAD", "CNY", "EUR", "GBP", "HKD", "MYR", "SGD", "USD"),
    100: ("INR", "MXN", "THB", "TWD"),
    10: ("JPY",),
}


def money(c) -> Column:
    return as_col(c).cast(MONEY)


def safe_ratio(num, den, scale: int | None = None, pct: bool = False) -> Column:
    """num / den, 0 where the denominator is 0 or missing; percentages are scaled by 100."""
    num, den = as_col(num), as_col(den)
    ratio = num / F.nullif(den, F.lit(0).cast("int")) * (100 if pct else 1)
    ratio = F.round(ratio, scale) if scale is not None else ratio
    return F.when(F.coalesce(den, F.lit(0)) == 0, F.lit(0)).otherwise(ratio)


def int_div(num, den) -> Column:
    """Truncating division of whole numbers, 0 where the denominator is 0 or missing."""
    whole = F.call_function("div", as_col(num), F.nullif(as_col(den), F.lit(0)))
    return F.coalesce(whole, F.lit(0))


def clean_sex(c) -> Column:
    c = as_col(c)
    return F.when(c.isin(*MALE), "M").when(c.isin(*FEMALE), "F")


def clean_birth_year(c, current_year) -> Column:
    """Years before 1900 or after the current one are unknown."""
    c = as_col(c)
    return F.when(c.between(1900, current_year), c)


def clean_age(c) -> Column:
    """Ages outside (0, 100] are unknown."""
    c = as_col(c)
    return F.when((c > 0) & (c <= 100), c)


def clean_demographics(df: DataFrame, current_year, sex: str = "sex",
                       birth_year: str = "year_of_birth") -> DataFrame:
    return df.withColumns({
        sex: clean_sex(sex),
        birth_year: clean_birth_year(birth_year, current_year),
    })


def classify(rules: list[tuple[Column, object]], default=None) -> Column:
    """First matching rule wins."""
    (first, label), *rest = rules
    out = F.when(first, F.lit(label))
    for test, value in rest:
        out = out.when(test, F.lit(value))
    return out.otherwise(F.lit(default))


def point_rate(currency) -> Column:
    c = as_col(currency)
    return classify([(c.isin(*codes), rate) for rate, codes in POINT_RATES.items()], 1)
