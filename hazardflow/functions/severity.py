"""Severity ladders and scores, by column name."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hazardflow import config
from hazardflow.functions.sql import case, literal


def ladder(value: str, steps: list[tuple[float, object]], floor) -> Column:
    """First step whose lower bound the value reaches; NULL falls to the floor."""
    return F.expr(case([(f"{value} >= {literal(bound)}", result) for bound, result in steps], floor))


def lookup(value: str, table: dict[str, object], default) -> Column:
    """Exact-match lookup; NULL and unknown keys give the default."""
    return F.expr(case([(f"{value} = {literal(k)}", result) for k, result in table.items()], default))


def magnitude_score(magnitude: str) -> Column:
    steps = [(bound, score) for bound, score, _ in config.MAGNITUDE_LADDER]
    return ladder(magnitude, steps, config.MAGNITUDE_FLOOR[0])


def magnitude_category(magnitude: str) -> Column:
    steps = [(bound, name) for bound, _, name in config.MAGNITUDE_LADDER]
    return ladder(magnitude, steps, config.MAGNITUDE_FLOOR[1])


def weather_score(severity: str) -> Column:
    return lookup(severity, config.WEATHER_SEVERITY_SCORES, config.WEATHER_SEVERITY_DEFAULT)


def urgency_score(urgency: str) -> Column:
    return lookup(urgency, config.URGENCY_SCORES, config.URGENCY_DEFAULT)


def combined_score(severity_score: str, urgency: str) -> Column:
    return F.expr(
        f"{severity_score} * {literal(config.SEVERITY_WEIGHT)}"
        f" + {urgency} * {literal(config.URGENCY_WEIGHT)}"
    )


def weather_category(event_type: str, whole_words: bool = False) -> Column:
    """Ordered case-insensitive patterns; ``whole_words`` stops 'Notice' matching 'ice'."""
    branches = []
    for pattern, name in config.WEATHER_CATEGORIES:
        body = rf"\b({pattern})\b" if whole_words else pattern
        branches.append((f"{event_type} RLIKE {literal('(?i)' + body)}", name))
    return F.expr(case(branches, config.CATEGORY_DEFAULT))


def alert_level_for_quake(magnitude: str) -> Column:
    return ladder(magnitude, config.QUAKE_ALERT_LADDER, config.ALERT_LEVEL_DEFAULT)


def alert_level_for_weather(severity: str) -> Column:
    return lookup(severity, config.WEATHER_ALERT_LEVELS, config.ALERT_LEVEL_DEFAULT)
