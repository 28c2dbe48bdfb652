"""Traffic lights and the points they cost or earn."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siltworks.config import GREEN, RED, YELLOW, Thresholds


def light(value: Column, green: float, yellow: float, lower_is_better: bool = False) -> Column:
    """Green, yellow or red by two inclusive limits; null and NaN are red."""
    value = F.when(~F.isnan(value), value)
    if lower_is_better:
        first, second = value <= F.lit(green), value <= F.lit(yellow)
    else:
        first, second = value >= F.lit(green), value >= F.lit(yellow)
    return F.when(first, GREEN).when(second, YELLOW).otherwise(RED)


def penalty(colour: Column, points: tuple[int, int]) -> Column:
    """Points lost for a red or a yellow light."""
    red, yellow = points
    return F.when(colour == RED, F.lit(red)).when(colour == YELLOW, F.lit(yellow)).otherwise(F.lit(0))


def light_points(colour: Column, limits: Thresholds) -> Column:
    """The score that a light stands for."""
    by_light = limits.light_points
    return (
        F.when(colour == GREEN, F.lit(by_light[GREEN]))
        .when(colour == YELLOW, F.lit(by_light[YELLOW]))
        .otherwise(F.lit(by_light[RED]))
    )


def score_light(score: Column, limits: Thresholds) -> Column:
    return light(score.cast("double"), limits.green_score, limits.yellow_score)
