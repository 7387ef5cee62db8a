"""The fill-flag bit mask, as a short column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of the flag image.
OCEAN, FAILURE, EXTREME, SPECKLE, A1_FILLED, A1_FULL, A2_FILLED, CLIPPED = 1, 2, 4, 8, 16, 32, 64, 128
ANY_FILL = A1_FILLED | A1_FULL | A2_FILLED
NAMES = {"ocean": OCEAN, "failure": FAILURE, "extreme": EXTREME, "speckle": SPECKLE, "a1_filled": A1_FILLED, "a1_full": A1_FULL, "a2_filled": A2_FILLED, "clipped": CLIPPED}


def has(flags: Column, bits: int) -> Column:
    """All of the bits are set."""
    return flags.bitwiseAND(F.lit(bits)) == bits


def any_of(flags: Column, bits: int) -> Column:
    return flags.bitwiseAND(F.lit(bits)) != 0


def put(flags: Column, bits: int) -> Column:
    return flags.bitwiseOR(F.lit(bits)).cast("short")


def drop(flags: Column, bits: int) -> Column:
    return flags.bitwiseAND(F.lit(~bits & 0xFF)).cast("short")


def decode(flags: Column) -> dict[str, Column]:
    """A boolean column for each bit."""
    return {name: has(flags, bit) for name, bit in NAMES.items()}
