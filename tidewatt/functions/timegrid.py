"""Instants, local wall clock, and the 15- and 60-minute grid, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL = "Europe/Prague"


def floor_to(ts: Column, minutes: int) -> Column:
    """Start of the bucket of so many minutes, a divisor of 60; keeps the type of ts."""
    step = F.lit(minutes) * F.floor(F.minute(ts) / minutes).cast("int")
    return F.date_trunc("hour", ts) + F.make_dt_interval(F.lit(0), F.lit(0), step)


def label(start: Column, minutes: int = 15) -> Column:
    """'HH:MM-HH:MM'; the last interval of a day ends at 00:00."""
    end = start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return F.concat(F.date_format(start, "HH:mm"), F.lit("-"), F.date_format(end, "HH:mm"))


def hour_label(interval: Column) -> Column:
    """The hour of a quarter's label: '23:45-00:00' is in '23:00-00:00'."""
    h = F.substring(interval, 1, 2)
    return F.concat(h, F.lit(":00-"), F.lpad(((h.cast("int") + 1) % 24).cast("string"), 2, "0"), F.lit(":00"))


def period(ts: Column) -> Column:
    """1 to 96 in the day of a local time."""
    return (F.hour(ts) * 4 + F.floor(F.minute(ts) / 15) + 1).cast("int")


def period_label(number: Column, midnight: str = "00:00") -> Column:
    """The label of a period from 1 to 96. midnight: how the end of the day is written."""
    at = lambda n: F.format_string("%02d:%02d", F.floor(n / 4).cast("int"), ((n % 4) * 15).cast("int"))
    return F.concat(at(number - 1), F.lit("-"), F.when(number == 96, F.lit(midnight)).otherwise(at(number)))


def canonical_label(text: Column) -> Column:
    """'00-01', '00:00 - 01:00' and '23:45-24:00' in the one spelling that joins use."""
    full = lambda x: F.when(F.instr(x, ":") > 0, F.lpad(x, 5, "0")).otherwise(F.concat(F.lpad(x, 2, "0"), F.lit(":00")))
    ends = F.transform(F.split(F.replace(text, F.lit(" "), F.lit("")), "-"), full)  # split once, not for each mention of an end
    return F.concat(ends[0], F.lit("-"), F.replace(ends[1], F.lit("24:00"), F.lit("00:00")))


def to_local(instant: Column, zone: str = LOCAL) -> Column:
    """Wall clock of an instant that is held in UTC without a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant)


def to_instant(local: Column, zone: str = LOCAL) -> Column:
    """The instant, in UTC without a zone, of a wall clock; of a repeated hour the first."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def fold(instant: Column, zone: str = LOCAL) -> Column:
    """Whether the wall clock of an instant has been shown before, as in the hour that autumn repeats."""
    return to_instant(to_local(instant, zone), zone) != instant


def duration_minutes(iso: Column) -> Column:
    """Minutes of 'PT15M', 'PT1H' or 'PT1H30M'; null for anything else."""
    part = lambda unit: F.coalesce(F.regexp_extract(iso, rf"(\d+){unit}", 1).try_cast("int"), F.lit(0))
    return F.when(iso.rlike(r"^PT(\d+H)?(\d+M)?$") & iso.rlike(r"\d"), part("H") * 60 + part("M"))


def clock_seconds(clock: Column) -> Column:
    """Seconds on the wall clock since 1970-01-01 00:00, whatever the session's zone."""
    days = F.datediff(clock, F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(clock) * 3600 + F.minute(clock) * 60 + F.second(clock)


def contract(text: Column) -> Column:
    """struct(start, end, minutes) of 'YYYYMMDD HH:MM-YYYYMMDD HH:MM'; null where it isn't one, or
    doesn't end after its start."""
    at = lambda k: F.try_to_timestamp(F.split(text, "-")[k], F.lit("yyyyMMdd HH:mm")).cast("timestamp_ntz")
    good = text.rlike(r"^\d{8} \d{2}:\d{2}-\d{8} \d{2}:\d{2}$")
    return F.when(good & (at(1) > at(0)), F.struct(at(0).alias("start"), at(1).alias("end"), ((clock_seconds(at(1)) - clock_seconds(at(0))) / 60).cast("int").alias("minutes")))


def number(text: Column) -> Column:
    """A number written with thousands separators or spaces; null where it is none."""
    return F.regexp_replace(text, "[, ]", "").try_cast("double")


def spine(first: Column, last: Column, step: str) -> Column:
    """Explodes to every instant or date from first to last, both included."""
    return F.explode(F.sequence(first, last, F.expr(f"interval {step}")))
