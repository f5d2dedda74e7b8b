"""Business labels: price bands, temperature classes, calendar labels, RFM segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (exclusive upper bound, label), then the label above the last bound.
PRICE_BANDS = [(50, "0-50 BRL"), (150, "50-150 BRL"), (300, "150-300 BRL"), (500, "300-500 BRL")]
PRICE_BAND_ABOVE = "+500 BRL"
TEMPERATURE_CLASSES = [(10, "Cold"), (20, "Mild")]
TEMPERATURE_ABOVE = "Warm"
# Fixed values: (inclusive lower bound of the summed score, segment), then the rest.
RFM_SEGMENTS = [
    (13, "Champions"),
    (10, "Loyal Customers"),
    (7, "At Risk"),
    (4, "Needs Attention"),
]
RFM_REST = "Lost"
# Southern-hemisphere season by month number.
SEASON_BY_MONTH = {
    1: "Summer", 2: "Summer", 3: "Autumn", 4: "Autumn", 5: "Autumn", 6: "Winter",
    7: "Winter", 8: "Winter", 9: "Spring", 10: "Spring", 11: "Spring", 12: "Summer",
}


def _below(c: Column, bounds: list[tuple[int, str]], above: str, missing: str | None) -> Column:
    label = F.when(c.isNull(), F.lit(missing))
    for bound, name in bounds:
        label = label.when(c < bound, name)
    return label.otherwise(above)


def price_band(price: str | Column) -> Column:
    price = F.col(price) if isinstance(price, str) else price
    return _below(price, PRICE_BANDS, PRICE_BAND_ABOVE, None)


def temperature_class(celsius: str | Column) -> Column:
    """Cold, Mild or Warm; ``Unknown`` where there was no measurement."""
    celsius = F.col(celsius) if isinstance(celsius, str) else celsius
    return _below(celsius, TEMPERATURE_CLASSES, TEMPERATURE_ABOVE, "Unknown")


def quarter_label(month: str | Column) -> Column:
    month = F.col(month) if isinstance(month, str) else month
    return F.concat(F.lit("Q"), F.ceil(month / 3).cast("string"))


def southern_season(month: Column) -> Column:
    by_month = F.array(*[F.lit(SEASON_BY_MONTH[m]) for m in range(1, 13)])
    return F.try_element_at(by_month, month.cast("int"))


def rfm_segment(score: Column) -> Column:
    label = None
    for low, name in RFM_SEGMENTS:
        label = F.when(score >= low, name) if label is None else label.when(score >= low, name)
    return label.otherwise(RFM_REST)
