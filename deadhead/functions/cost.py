"""Duty hours and cost of one leg, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deadhead.config import DEFAULT, Params

# Fixed values of the duty-hour curve: (miles up to, hours at the start, start mile, miles per hour beyond it).
SHORT_MILES, MEDIUM_MILES = 50, 100
SHORT_MIN_HOURS, SHORT_SPEED = 0.33, 30
MEDIUM_HOURS, MEDIUM_SPEED = 1.667, 50
LONG_HOURS, LONG_SPEED = 2.667, 65


def leg_hours(miles: Column) -> Column:
    """Piecewise hours on duty; NULL miles give NULL."""
    short = F.greatest(F.lit(SHORT_MIN_HOURS), miles / SHORT_SPEED)
    medium = MEDIUM_HOURS + (miles - SHORT_MILES) / MEDIUM_SPEED
    long = LONG_HOURS + (miles - MEDIUM_MILES) / LONG_SPEED
    return F.when(miles > MEDIUM_MILES, long).when(miles > SHORT_MILES, medium).when(miles.isNotNull(), short)


def leg_cost(miles: Column, per_mile: Column, per_stop: Column, per_hour: Column, p: Params = DEFAULT) -> Column:
    """Mileage, fuel, stop and time cost; 0 for an absent leg or a home without rates."""
    total = miles * per_mile + miles * p.fuel_per_mile + per_stop + leg_hours(miles) * per_hour
    return F.coalesce(total, F.lit(0.0))
