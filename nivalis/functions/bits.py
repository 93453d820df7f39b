"""Bit fields: named groups of flags, squeezing, single bits, packed masks. Bit positions count from 1, as in the data's documentation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (name, first bit from 0, number of bits).
STATE_1KM = (("cloud", 0, 2), ("cloudshadow", 2, 1), ("landwater", 3, 3), ("aerosol", 6, 2), ("cirrus", 8, 2), ("saltpan", 14, 1))
QC_500M = (("modland", 0, 2), ("atmos_corr", 2, 1), ("adj_corr", 3, 1))


def unpack_bits(flags: Column, groups=STATE_1KM) -> list[Column]:
    """One integer column per named group."""
    return [F.shiftright(flags, at).bitwiseAND(F.lit((1 << count) - 1)).cast("int").alias(name) for name, at, count in groups]


def get_bit(flags: Column, position: int) -> Column:
    return F.shiftright(flags, position - 1).bitwiseAND(F.lit(1)) == 1


def set_bit(flags: Column, position: int, on: Column) -> Column:
    """The flags with the bit at the position on or off; a null condition turns it off."""
    bit = 1 << (position - 1)
    return F.when(on, flags.bitwiseOR(F.lit(bit))).otherwise(flags.bitwiseAND(F.lit(~bit)))


def flags_of(conditions: dict[int, Column]) -> Column:
    """A bit field from positions and conditions."""
    return reduce(lambda a, b: a.bitwiseOR(b), (F.when(on, 1 << (at - 1)).otherwise(0) for at, on in conditions.items()))


def squeeze_state(state: Column) -> Column:
    """state_1km without bits that nothing reads (compresses better)."""
    kept = sum(((1 << count) - 1) << at for _, at, count in STATE_1KM) | 0b111111111111
    return state.bitwiseAND(F.lit(kept))


def squeeze_qc(qc: Column) -> Column:
    """QC_500m: the two modland bits, then bits 31 and 32 moved next to them."""
    moved = [F.shiftleft(F.shiftright(qc, at - 1).bitwiseAND(F.lit(1).cast("long")), to) for at, to in ((31, 2), (32, 3))]
    return qc.bitwiseAND(F.lit(3).cast("long")).bitwiseOR(moved[0]).bitwiseOR(moved[1]).cast("int")


def squeeze_viirs(qf1: Column, qf2: Column, qf7: Column) -> Column:
    """One field in the layout of STATE_1KM out of three VIIRS quality flags (no salt pan)."""
    part = lambda c, at, count, to: F.shiftleft(F.shiftright(c, at).bitwiseAND(F.lit((1 << count) - 1)), to)
    fields = (part(qf1, 2, 2, 0), part(qf2, 3, 1, 2), part(qf2, 0, 3, 3), part(qf7, 2, 3, 6))
    return reduce(lambda a, b: a.bitwiseOR(b), fields)


def pack_masks(masks: list[Column], width: int = 3) -> Column:
    """Conversion masks of the bands, `width` bits each, the first one lowest."""
    return reduce(lambda a, b: a.bitwiseOR(b), (F.shiftleft(m, i * width) for i, m in enumerate(masks)))
