"""Time rules: UTC change times, local wall times with explicit daylight-saving handling, strict parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^(\d{4}-\d{2}-\d{2})[ T](\d{2}:\d{2}:\d{2})(?:\.(\d{1,6})(0*))?(Z|[+-]\d{2}:?\d{2})?$"


def local_to_utc(local: Column, zone: str) -> Column:
    """UTC of a wall time, leniently: a gap is moved, an overlap takes its first instant."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def utc_to_local(utc: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_status(local: Column, zone: str) -> Column:
    """'gap' for a wall time that does not exist, 'overlap' for one that occurs twice, else 'ok'.

    A time in a gap does not survive the way to UTC and back; one in an overlap also is the wall time
    one hour before or after the instant it was mapped to.
    """
    utc = local_to_utc(local, zone)
    hour = F.expr("INTERVAL 1 HOUR")
    gap = utc_to_local(utc, zone) != local
    twice = (utc_to_local(utc + hour, zone) == local) | (utc_to_local(utc - hour, zone) == local)
    return F.when(local.isNull(), None).when(gap, "gap").when(twice, "overlap").otherwise("ok")


def local_to_utc_strict(local: Column, zone: str) -> Column:
    """UTC of a wall time; a gap or an overlap is an error."""
    status = local_status(local, zone)
    return F.when((status == "ok") | local.isNull(), local_to_utc(local, zone)).otherwise(F.raise_error(F.concat(F.lit("ambiguous or nonexistent local time "), local.cast("string"))).cast("timestamp_ntz"))


def local_day(utc: Column, zone: str) -> Column:
    """Calendar day of a UTC time in a zone, 'UNKNOWN' for NULL."""
    return F.coalesce(F.date_format(utc_to_local(utc, zone), "yyyy-MM-dd"), F.lit("UNKNOWN"))


def parse_change_time(text: Column) -> Column:
    """Change time as UTC: naive text is UTC, an offset is applied, digits beyond microseconds must be zero.

    NULL, empty and malformed text are errors.
    """
    fail = F.raise_error(F.concat(F.lit("bad change time "), F.coalesce(text, F.lit("NULL")))).cast("timestamp_ntz")
    naive = F.to_timestamp_ntz(F.concat_ws(" ", F.regexp_extract(text, _ISO, 1), F.concat(F.regexp_extract(text, _ISO, 2), F.lit("."), F.rpad(F.regexp_extract(text, _ISO, 3), 6, "0"))), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))
    zone = F.regexp_extract(text, _ISO, 5)
    sign = F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)
    minutes = sign * (F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, -2, 2).try_cast("int"))
    shifted = naive - F.make_dt_interval(F.lit(0), F.lit(0), F.coalesce(minutes, F.lit(0)), F.lit(0))
    return F.when(F.coalesce(text.rlike(_ISO), F.lit(False)), F.when(zone.isin("", "Z"), naive).otherwise(shifted)).otherwise(fail)


def parse_kept(text: Column) -> Column:
    """``struct(at, kept)``: a parsed change time, or the text itself where it is well formed but no time that a
    timestamp can hold (a year beyond 9999, a day that does not exist).  NULL stays NULL; other text is an error."""
    shape = r"^[+-]?\d{4,}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d+)?(Z|[+-]\d{2}:?\d{2})?$"
    inside = text.rlike(_ISO)
    day = F.try_to_timestamp(F.substring(F.regexp_replace(text, "T", " "), 1, 19), F.lit("yyyy-MM-dd HH:mm:ss"))
    good = inside & day.isNotNull()
    at = F.when(good, parse_change_time(F.when(good, text).otherwise(F.lit("2000-01-01 00:00:00"))))
    fail = F.raise_error(F.concat(F.lit("bad change time "), text)).cast("string")
    kept = F.when(text.isNull() | good, None).when(text.rlike(shape), text).otherwise(fail)
    return F.struct(at.alias("at"), kept.alias("kept"))


def wall_clock(text: Column) -> Column:
    """Other date-times keep their wall clock; an offset is dropped."""
    return F.to_timestamp_ntz(F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", ""))


def round_seconds(ts: Column) -> Column:
    """Half up to whole seconds."""
    return F.date_trunc("SECOND", ts + F.expr("INTERVAL 500000 MICROSECOND")).cast("timestamp_ntz")
