"""Column expressions for stock positions, weekly speed, cover and store profile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weeks of sales the KPIs look at: the window of a run and the divisor of the weekly speed.
WEEKS = 4
NO_SALES_COVER = 999
RECEIVER_MAX_COVER = 10

SENDER, RECEIVER, NEUTRAL = "EMISOR", "RECEPTOR", "NEUTRO"


def zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def floored(value: Column) -> Column:
    return F.greatest(value, F.lit(0))


def net_units() -> Column:
    """Units sold less units returned (returns are negative)."""
    return zero(F.col("VENTA_DIRECTA")) + zero(F.col("DEVOLUCION"))


def weekly_speed(sold: Column) -> Column:
    return sold / F.lit(float(WEEKS))


def working_speed(sold: Column) -> Column:
    speed = weekly_speed(sold)
    return F.when(sold == 0, 0).when(speed < 1, 1).otherwise(F.round(speed)).cast("int")


def weeks_of_stock(total: Column, sold: Column) -> Column:
    # the divisor is kept off zero so that ANSI mode never sees a division by zero
    divisor = F.greatest(working_speed(sold), F.lit(1))
    return F.when(total == 0, 0).when(sold == 0, NO_SALES_COVER).otherwise(F.round(total / divisor)).cast("int")


def has_replenishment(transit: Column, preparation: Column) -> Column:
    return transit + preparation > 0


def profile(sold: Column, available: Column, replenished: Column, weeks: Column) -> Column:
    return (
        F.when((sold == 0) & (available > 0) & ~replenished, SENDER)
        .when((sold > 0) & (weeks < RECEIVER_MAX_COVER), RECEIVER)
        .otherwise(NEUTRAL)
    )
