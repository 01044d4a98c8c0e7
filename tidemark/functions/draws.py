"""Seeded draws: a small integer mix, equal on every run and in every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplier and increment of a common linear congruential generator.
MULTIPLIER = 1103515245
INCREMENT = 12345
RANGE = 2 ** 31


def draw_int(number: int, seed: int, size: int) -> int:
    """The same draw as ``draw`` for a number known in the program."""
    h = number % RANGE
    for salt in (seed, INCREMENT):
        h = (h * MULTIPLIER + INCREMENT + salt) % RANGE
        h ^= h >> 16
    return h * size >> 31


def _mixed(number: Column, seed: int) -> Column:
    h = F.pmod(number.cast("long"), F.lit(RANGE))
    for salt in (seed, INCREMENT):
        h = (h * MULTIPLIER + (INCREMENT + salt)) % RANGE
        h = h.bitwiseXOR(F.shiftright(h, 16))
    return h


def draw(number: Column, seed: int, size: int) -> Column:
    """Integer in ``[0, size)`` that depends on ``number`` and ``seed`` alone."""
    return F.shiftright(_mixed(number, seed) * F.lit(size).cast("long"), 31).cast("int")


def draw_unit(number: Column, seed: int) -> Column:
    """Double in ``[0, 1)``."""
    return _mixed(number, seed) / F.lit(float(RANGE))
