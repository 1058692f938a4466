"""Column helpers for the weekly ring of 15-minute slots.

Event times are TIMESTAMP_NTZ, so none of these depend on the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

from slotcast.constants import MINUTES_PER_SLOT, SLOTS_PER_DAY, SLOTS_PER_HOUR, SLOTS_PER_WEEK

MICROS = 1_000_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_all(*columns: str) -> Column:
    """None of the columns is null."""
    return reduce(and_, (F.col(c).isNotNull() for c in columns))


def ntz(value: datetime | date | str) -> Column:
    """A TIMESTAMP_NTZ literal; a Python datetime passed to ``lit`` would shift with the zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def midnight(ts: str | Column) -> Column:
    return F.to_date(col(ts)).cast("timestamp_ntz")


def slot_of(ts: str | Column) -> Column:
    """Slot 0..671 of a timestamp."""
    ts = col(ts)
    return (
        F.weekday(ts) * SLOTS_PER_DAY
        + F.hour(ts) * SLOTS_PER_HOUR
        + F.floor(F.minute(ts) / MINUTES_PER_SLOT)
    ).cast("int")


def floor_to_slot(ts: str | Column) -> Column:
    """The start of the 15 minutes that hold a timestamp."""
    ts = col(ts)
    none = F.lit(0)
    into_slot = F.make_dt_interval(
        none, none, F.minute(ts) % MINUTES_PER_SLOT, F.extract(F.lit("SECOND"), ts)
    )
    return ts - into_slot


def day_of_slot(slot: str | Column) -> Column:
    return F.floor(col(slot) / SLOTS_PER_DAY).cast("int")


def hour_of_slot(slot: str | Column) -> Column:
    return F.floor((col(slot) % SLOTS_PER_DAY) / SLOTS_PER_HOUR).cast("int")


def minute_of_slot(slot: str | Column) -> Column:
    return ((col(slot) % SLOTS_PER_HOUR) * MINUTES_PER_SLOT).cast("int")


def slots_ahead(slot: str | Column, of: str | Column) -> Column:
    """How many slots after ``of`` the ring reaches ``slot``: 0..671."""
    return F.pmod(col(slot) - col(of), F.lit(SLOTS_PER_WEEK))


def running_slot(day: str | Column, slot: str | Column) -> Column:
    """A slot number that keeps growing over the weeks, from a date and its ring slot."""
    return F.unix_date(col(day)) * SLOTS_PER_DAY + col(slot) % SLOTS_PER_DAY


def date_of_running_slot(running: str | Column) -> Column:
    return F.date_from_unix_date(F.floor(col(running) / SLOTS_PER_DAY).cast("int"))


def ring_slot_of_running(running: str | Column) -> Column:
    day = date_of_running_slot(running)
    return (F.weekday(day) * SLOTS_PER_DAY + col(running) % SLOTS_PER_DAY).cast("int")


def to_event_time(ts: str | Column) -> Column:
    """TIMESTAMP_NTZ to TIMESTAMP with the wall clock read as UTC, for watermarks.

    Put together from the parts of the clock: a cast would go through the session time zone.
    """
    ts = col(ts)
    seconds = F.unix_date(F.to_date(ts)).cast("bigint") * 86_400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    micros = (F.extract(F.lit("SECOND"), ts) * MICROS).cast("bigint")
    return F.timestamp_micros(seconds * MICROS + micros)


def from_event_time(ts: str | Column) -> Column:
    """The inverse of :func:`to_event_time`."""
    micros = F.unix_micros(col(ts))
    day = F.lit(86_400 * MICROS)
    into_day = (F.pmod(micros, day) / F.lit(MICROS).cast("decimal(10,0)")).cast("decimal(18,6)")
    midnight_of = F.date_from_unix_date(F.floor(micros / day).cast("int")).cast("timestamp_ntz")
    zero = F.lit(0)
    return midnight_of + F.make_dt_interval(zero, zero, zero, into_day)
