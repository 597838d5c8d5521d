"""Publication times as providers write them, as native expressions.

A time counts only with an offset of its own or a local format that its source is known to use;
anything else is null (a bare ISO date has no offset, so most sources lose it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^(\d{4})-(\d{2})-(\d{2})[^0-9](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,6})\d*)?)?(Z|z|[+-]\d{2}(?::?\d{2})?)$"
_MAIL = r"^(?:\p{L}{3,9},?\s+)?(\d{1,2})\s+(\p{L}{3})\p{L}*\s+(\d{4})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?\s+([+-]\d{4}|\p{L}{1,3})$"
_DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:(?:\s+\|)?\s+(\d{1,2}):(\d{1,2}):(\d{1,2}))?$"
_SLASHES = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
_DASHES = r"^(\d{4})-(\d{1,2})-(\d{1,2})$"

# Month names of mail dates, and the zones those dates may name (hours from UTC).
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
ZONES = {"UT": 0, "UTC": 0, "GMT": 0, "Z": 0, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}


@dataclass(frozen=True)
class Local:
    """How a source writes local dates: pattern, the groups of year, month and day, zone."""

    pattern: str
    order: tuple[int, int, int]
    zone: str


# Sources with a local format of their own, and the format of all others.
LOCAL = {
    "us_fhfa_regulatory": Local(_SLASHES, (3, 1, 2), "America/New_York"),
    "eu_esma_regulatory": Local(_SLASHES, (3, 2, 1), "Europe/Paris"),
    "cn_samr_market_regulation_bulletins": Local(_DASHES, (1, 2, 3), "Asia/Shanghai"),
    "cn_miit_policy_listing": Local(_DASHES, (1, 2, 3), "Asia/Shanghai"),
}
OTHERS = Local(_DAY_FIRST, (3, 2, 1), "+07:00")


def _group(text: Column, pattern: str, k: int) -> Column:
    return F.regexp_extract(text, pattern, k)


def _number(text: Column, pattern: str, k: int) -> Column:
    """A group as a number, 0 where it is empty."""
    return F.coalesce(_group(text, pattern, k).try_cast("int"), F.lit(0))


def _utc(*parts: Column) -> Column:
    return F.try_make_timestamp(*parts, F.lit("UTC"))


def _less(at: Column, minutes: Column) -> Column:
    """A time given by the clock of an offset, as UTC."""
    return F.timestamp_micros(F.unix_micros(at) - minutes.cast("long") * 60_000_000)


def iso(text: Column) -> Column:
    """ISO 8601 with an offset; null otherwise."""
    offset = _group(text, _ISO, 8)
    digits = F.rpad(F.regexp_replace(offset, "[^0-9]", ""), 4, "0")
    minutes = F.coalesce(F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    micros = F.coalesce(F.rpad(_group(text, _ISO, 7), 6, "0").try_cast("long"), F.lit(0))
    at = _utc(*[_number(text, _ISO, k) for k in range(1, 6)], _number(text, _ISO, 6).cast("decimal(8,6)"))
    at = F.timestamp_micros(F.unix_micros(at) + F.when(_group(text, _ISO, 7) == "", 0).otherwise(micros))
    return F.when(text.rlike(_ISO) & (minutes < 1440), _less(at, F.when(offset.startswith("-"), -minutes).otherwise(minutes)))


def mail(text: Column) -> Column:
    """RFC 2822 with an offset or a zone it defines; -0000 says that the offset is unknown, so it is null."""
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(_group(text, _MAIL, 2))).cast("int")
    zone = F.upper(_group(text, _MAIL, 7))
    named = F.coalesce(*[F.when(zone == name, hours * 60) for name, hours in ZONES.items()])
    digits = F.substring(zone, 2, 4)
    given = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    minutes = F.when(zone == "-0000", F.lit(None).cast("int")).when(zone.startswith("-"), -given).when(zone.startswith("+"), given).otherwise(named)
    at = _utc(_number(text, _MAIL, 3), month, *[_number(text, _MAIL, k) for k in (1, 4, 5)], _number(text, _MAIL, 6).cast("decimal(8,6)"))
    return F.when(text.rlike(_MAIL) & (month > 0), _less(at, minutes))


def local(text: Column, form: Local) -> Column:
    day = [_number(text, form.pattern, k) for k in form.order]
    clock = [_number(text, form.pattern, k) for k in (4, 5, 6)] if form.pattern == _DAY_FIRST else [F.lit(0)] * 3
    return F.when(text.rlike(form.pattern), F.try_make_timestamp(*day, *clock[:2], clock[2].cast("decimal(8,6)"), F.lit(form.zone)))


def published_at(raw: Column, source_id: Column) -> Column:
    """The time of raw as its source means it, or null."""
    text = F.regexp_replace(raw, r"^\s+|\s+$", "")
    own = F.lit(None).cast("timestamp")
    for name, form in LOCAL.items():
        own = F.when(source_id == name, local(text, form)).otherwise(own)
    here = F.when(source_id.isin(*LOCAL), own).otherwise(local(text, OTHERS))
    return F.coalesce(iso(text), mail(text), here)


def cjk_date(text: Column) -> Column:
    """The first date written with CJK units or dashes, with dashes."""
    found = F.regexp_extract(text, r"(\d{4}年\d{1,2}月\d{1,2}日|\d{4}-\d{2}-\d{2})", 1)
    return F.when(found != "", F.regexp_replace(F.regexp_replace(found, "[年月]", "-"), "日", ""))


def minute_of_day(at: Column) -> Column:
    """Minutes since midnight UTC of a time in seconds."""
    return F.pmod(F.floor(at / 60), F.lit(1440))
