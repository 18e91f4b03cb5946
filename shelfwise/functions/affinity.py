"""Rating arithmetic on per-pair action counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of one view in each import, of a cart, a purchase and a
# favourite; percent factor; divisor; highest rating.
VIEW_WEIGHT = 0.05
RAW_VIEW_WEIGHT = 0.005
CART_WEIGHT = 0.35
BUY_WEIGHT = 0.45
FAVOURITE_WEIGHT = 0.15
PERCENT = 100
DIVISOR = 20.0
MAX_RATING = 5.0


def flag_positive(count: Column) -> Column:
    """1 when the count is above zero, else 0."""
    return (count > 0).cast("int")


def clamp(value: Column, upper: float = MAX_RATING) -> Column:
    return F.least(F.lit(upper), value)


def affinity(view_weight: float = VIEW_WEIGHT) -> Column:
    """Capped rating: views count each time, the other actions once."""
    parts = [F.col("viewed_count") * F.lit(view_weight)] + [
        flag_positive(F.col(name)) * F.lit(weight)
        for name, weight in (
            ("added_to_cart_count", CART_WEIGHT),
            ("bought_count", BUY_WEIGHT),
            ("added_to_favorite_count", FAVOURITE_WEIGHT),
        )
    ]
    total = parts[0] * PERCENT
    for part in parts[1:]:
        total = total + part * PERCENT
    return clamp(total / F.lit(DIVISOR))
