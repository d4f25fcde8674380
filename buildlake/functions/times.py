"""Time expressions. The session's zone is UTC; ``now`` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: formats of messages, of the console and of the crawled service
MESSAGE_FORMAT = "MM/dd/yyyy, HH:mm:ss"
CONSOLE_FORMAT = "dd/MM/yyyy--HH:mm:s"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
FALLBACK = "2000-01-01 01:01:01"


def iso_or_default(text: Column) -> Column:
    """A time of the crawled service; what can't be read is the first second of 2000-01-01 01:01."""
    return F.coalesce(F.try_to_timestamp(text, F.lit(ISO_FORMAT)), F.lit(FALLBACK).cast("timestamp")).cast("timestamp_ntz")


def message_time(text: Column) -> Column:
    """A time of a message; null if it can't be read."""
    return F.try_to_timestamp(text, F.lit(MESSAGE_FORMAT)).cast("timestamp_ntz")


def as_message_time(ts: Column) -> Column:
    return F.date_format(ts, MESSAGE_FORMAT)


def console_epoch(text: Column) -> Column:
    """Seconds of a time as typed on the console; null if it can't be read."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit(CONSOLE_FORMAT)))


def epoch(ts: Column) -> Column:
    """Seconds since 1970 of a time without zone."""
    return F.unix_timestamp(ts.cast("timestamp"))


def exact_epoch(ts: Column) -> Column:
    """Seconds since 1970 with their fraction: a bound on whole seconds cuts between microseconds."""
    return F.unix_micros(ts.cast("timestamp")) / 1_000_000


def iso_of_epoch(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss")


def floor_to(seconds: Column, step: int) -> Column:
    """Start of the ``step`` that a second is in."""
    return seconds - F.pmod(seconds, F.lit(step))


def next_boundary(seconds: Column, step: int) -> Column:
    return floor_to(seconds, step) + step


def remaining(reset: Column, now: Column, slack: int = 0) -> Column:
    """Seconds until a reset, never under zero; ``slack`` is added."""
    return F.greatest(F.lit(0), reset - now) + slack


def is_stale(seconds: Column, now: Column, ttl: int) -> Column:
    """Whether something is ``ttl`` seconds old or older."""
    return now - seconds >= ttl


def newer_than(seconds: Column, now: Column, interval: int) -> Column:
    """Strictly within the last ``interval`` seconds."""
    return seconds > now - interval


def strictly_between(seconds: Column, start: Column, end: Column) -> Column:
    """Both bounds excluded."""
    return (seconds > start) & (seconds < end)
