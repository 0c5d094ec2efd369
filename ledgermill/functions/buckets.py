"""Labels, percentages and averages derived from numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgermill.schemas import PRICE_LABELS, STATUS_LABELS, VOLUME_LABELS


def volume_category(quantity: Column) -> Column:
    high, medium, low = VOLUME_LABELS
    return F.when(quantity >= 5, high).when(quantity >= 3, medium).otherwise(low)


def price_category(price: Column) -> Column:
    premium, standard, budget = PRICE_LABELS
    return F.when(price >= 250, premium).when(price >= 100, standard).otherwise(budget)


def customer_status(idle_days: Column) -> Column:
    active, at_risk, inactive = STATUS_LABELS
    return F.when(idle_days <= 30, active).when(idle_days <= 90, at_risk).otherwise(inactive)


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, NULL when the whole is 0. Multiplying first spares the rounding of a quotient."""
    return part * 100 / F.nullif(whole, F.lit(0))


def precise_average(total: Column, count: Column) -> Column:
    """Decimal average with 12 decimals. The built-in average of cents keeps 6, and rounding those again can be
    off by a cent."""
    return total.cast("decimal(30,4)") / count.cast("decimal(20,0)")
