"""Timestamps from text, always as UTC without zone (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_ZONE = r"\s*([zZ]|[+-]\d{2}(?::?\d{2})?|[A-Za-z]{2,5})?"
# year, month, day, hour, minute, second, fraction, zone
ISO = rf"(\d{{4}})-(\d{{2}})-(\d{{2}})(?:[Tt ]{_TIME}{_ZONE})?"
# day, month name, year, hour, minute, second, fraction, zone
RFC822 = rf"(\d{{1,2}}) ([A-Za-z]{{3}}) (\d{{4}}|\d{{2}}) {_TIME}{_ZONE}"
# as ISO
ISO_BASIC = rf"(\d{{4}})(\d{{2}})(\d{{2}})(?:[Tt](\d{{2}})(\d{{2}})(?:(\d{{2}})(?:[.,](\d{{1,9}}))?)?{_ZONE})?"
# One pattern for all shapes, and the fields of whichever matched in one order: groups
# that took no part in the match are empty.
_SHAPE = rf"^(?:[A-Za-z]{{3,9}},\s*)?(?:{ISO}|{RFC822}|{ISO_BASIC})$"
_MARK = "\x01"
_GROUPS = [(1, 11, 17), (2, 10, 18), (3, 9, 19), *((i, i + 8, i + 16) for i in range(4, 9))]
_FIELDS = "".join(_MARK + "".join(f"${g}" for g in groups) for groups in _GROUPS)
# RFC 822's names of zones, in hours from UTC
ZONES = {
    "z": 0, "ut": 0, "utc": 0, "gmt": 0, "est": -5, "edt": -4, "cst": -6, "cdt": -5,
    "mst": -7, "mdt": -6, "pst": -8, "pdt": -7,
}
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
MAX_OFFSET_MINUTES = 18 * 60


def utc(instant: Column) -> Column:
    """UTC wall time of an instant, whatever the zone of the session."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def _offset_minutes(zone: Column) -> Column:
    """Minutes from UTC; 0 without a zone, null for a name that is not known."""
    named = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    sign = F.substring(zone, 1, 1)
    hours = F.substring(zone, 2, 2).try_cast("int") * 60
    minutes = hours + F.when(F.length(zone) > 3, F.substring(zone, -2, 2).try_cast("int")).otherwise(0)
    return (
        F.when(zone == "", 0)
        .when(sign == "+", F.when(minutes <= MAX_OFFSET_MINUTES, minutes))
        .when(sign == "-", F.when(minutes <= MAX_OFFSET_MINUTES, -minutes))
        .otherwise(F.try_element_at(named, F.lower(zone)) * 60)
    )


def _moment(fields: Column) -> Column:
    """The UTC time of the fields of a text; null if they are no time."""
    year, month, day, hour, minute, second, fraction, zone = (F.get(fields, i) for i in range(1, 9))
    century = F.when(year.try_cast("int") < 50, "20").otherwise("19")
    place = F.instr(F.lit(MONTHS), F.lower(month))
    # a name must begin where a month begins
    named = F.when(
        (place > 0) & (place % 3 == 1), F.lpad(((place + 2) / 3).cast("int").cast("string"), 2, "0")
    )
    wall = F.concat(
        F.when(F.length(year) == 2, F.concat(century, year)).otherwise(year), F.lit("-"),
        F.when(F.length(month) == 3, named).otherwise(month), F.lit("-"),
        F.lpad(day, 2, "0"), F.lit(" "),
        F.when(hour == "", "00:00").otherwise(F.concat(F.lpad(hour, 2, "0"), F.lit(":"), minute)),
        F.when(second == "", ":00").otherwise(F.concat(F.lit(":"), second)),
        F.when(fraction == "", "").otherwise(F.concat(F.lit("."), F.substring(fraction, 1, 6))),
    ).try_cast("timestamp_ntz")
    return wall - F.make_dt_interval(F.lit(0), F.lit(0), _offset_minutes(zone))


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 (extended or basic) or RFC-822 text as UTC; null if it is neither.

    Text without a zone is UTC; a zone that is not known makes the whole null.
    Seconds may be missing, RFC-822 years may have two digits. The text is matched
    once; its fields are then one array, bound once for all that is made of them.
    """
    plain = F.replace(F.trim(text), F.lit(_MARK), F.lit(" "))
    fields = F.split(F.regexp_replace(plain, _SHAPE, _FIELDS), _MARK)
    found = F.transform(F.array(fields), lambda f: F.when(F.size(f) == 9, _moment(f)))
    return F.get(found, F.lit(0))


def iso_utc(timestamp: Column) -> Column:
    """ISO-8601 text of a UTC timestamp without zone."""
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
