"""Column predicates and keys over text and time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats that data must have.
PATTERNS = {
    "event_type": r"\A[a-z][a-z0-9_.-]{2,127}\z",
    "port_code": r"\A[A-Z]{2}[A-Z0-9]{3}\z",
    "imo_number": r"\A[0-9]{7}\z",
    "mmsi": r"\A[0-9]{9}\z",
    "sha256": r"\A[0-9a-f]{64}\z",
    "uuid": r"\A(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z",
    "period": r"\A[0-9]{4}-(0[1-9]|1[0-2])\z",
    "instant": r"\A\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{1,9})?([Zz]|[+-]\d{2}:\d{2})\z",
}
#: Unicode white space at either end.
EDGES = r"(\A[\s\p{Z}\x1c-\x1f\x85])|([\s\p{Z}\x1c-\x1f\x85]\z)"


def matches(value: Column, name: str) -> Column:
    return F.coalesce(value.rlike(PATTERNS[name]), F.lit(False))


def is_canonical_text(value: Column, limit: int) -> Column:
    """Not null, not empty, no white space at the ends, no control or unassigned character, at most `limit` UTF-8 bytes."""
    return F.coalesce((F.length(value) > 0) & ~value.rlike(EDGES) & ~value.rlike(r"\p{C}") & (F.octet_length(value) <= limit), F.lit(False))


def instant(value: Column) -> Column:
    """RFC 3339 text with an offset as a timestamp, else null: a date alone or a time without an offset is none."""
    return F.when(value.rlike(PATTERNS["instant"]), F.try_to_timestamp(value))


def period_bounds(period: str) -> tuple[Column, Column]:
    """First instant of a month written YYYY-MM, and of the next."""
    import re

    if not re.fullmatch(PATTERNS["period"][2:-2], period):
        raise ValueError(f"not a month: {period!r}")
    start = F.lit(f"{period}-01 00:00:00").cast("timestamp")
    return start, F.add_months(start.cast("date"), 1).cast("timestamp")


def in_period(value: Column, period: str) -> Column:
    start, end = period_bounds(period)
    return (value >= start) & (value < end)


def digest_key(*parts: Column, separator: str = "/") -> Column:
    """SHA-256 of the parts as text; a null is written None, so keys with and without it differ."""
    return F.sha2(F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256)


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3_600_000_000.0)


def base64url_bytes(value: Column) -> Column:
    """Strict unpadded base64url, else null."""
    body = F.translate(value, "-_", "+/")
    padded = F.rpad(body, ((F.length(value) + 3) / 4).cast("int") * 4, "=")
    return F.when(value.rlike(r"\A[A-Za-z0-9_-]*\z") & (F.length(value) % 4 != 1), F.unbase64(padded))


def iso_instant(at: Column) -> Column:
    """A UTC time as text with its offset; microseconds only where there are any."""
    micros = F.pmod(F.unix_micros(at), F.lit(1_000_000))
    fraction = F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))
