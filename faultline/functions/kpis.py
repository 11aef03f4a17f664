"""Guarded rates: null, never 0 or NaN, where the denominator is too small."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.config import DEFAULTS


def _guarded(numerator: Column, denominator: Column, allowed: Column) -> Column:
    return F.when(allowed, F.try_divide(numerator.cast("double"), denominator.cast("double")))


def events_per_100_clearances(events: Column, clearances: Column, minimum: int = DEFAULTS.min_clearances) -> Column:
    return _guarded(events, clearances, clearances >= minimum) * 100


def recalls_per_100_clearances(recalls: Column, clearances: Column, minimum: int = DEFAULTS.min_clearances) -> Column:
    return _guarded(recalls, clearances, clearances >= minimum) * 100


def recall_to_event_ratio(recalls: Column, events: Column) -> Column:
    return _guarded(recalls, events, events > 0)


def severe_recall_share(class_i: Column, recalls: Column, minimum: int = DEFAULTS.min_recalls) -> Column:
    return _guarded(class_i, recalls, recalls >= minimum)


def firm_share(firm: Column, total: Column) -> Column:
    return _guarded(firm, total, total > 0)
