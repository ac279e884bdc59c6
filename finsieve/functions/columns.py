"""Scalar features as column expressions; everything stays in code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from finsieve.constants import SEED, VELOCITY_BANDS


def hour_of(ts: str = "ts") -> Column:
    return F.hour(ts)


def business_hours(ts: str = "ts") -> Column:
    """1 from 08:00 through 18:59."""
    return F.hour(ts).between(8, 18).cast("int")


def flag_equal(left: str, right: str) -> Column:
    """1 where both values are known and equal."""
    return F.coalesce(F.col(left) == F.col(right), F.lit(False)).cast("int")


def flag_differs(left: str, right: str) -> Column:
    """1 unless both values are known and equal: an unknown differs from everything."""
    return 1 - flag_equal(left, right)


def is_multiple_of(amount: str, unit: int) -> Column:
    return (F.pmod(F.col(amount), F.lit(float(unit))) == 0).cast("int")


def velocity_band(count: str = "sender_previous_tx_count") -> Column:
    """Right-closed bands over the prior count."""
    c = F.col(count)
    zero, one, few, some, many, most = (F.lit(b) for b in VELOCITY_BANDS)
    return (
        F.when(c <= 0, zero).when(c <= 1, one).when(c <= 5, few)
        .when(c <= 20, some).when(c <= 100, many).otherwise(most)
    )


def log_amount(amount: str) -> Column:
    """log(1 + x) with negative amounts taken as zero."""
    return F.log1p(F.greatest(F.col(amount), F.lit(0.0)))


def row_hash(row_id: str = "row_id", seed: int | str = SEED) -> Column:
    """Hex digest that gives each row a fixed place in a random order."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(row_id).cast("string")))


def is_test(row_id: str = "row_id", share: float = 0.30, seed: int | str = SEED) -> Column:
    """Hash split: the first four hex digits fall below ``share`` of their range."""
    cut = f"{round(share * 65536):04x}"
    return F.substring(row_hash(row_id, seed), 1, 4) < F.lit(cut)
