"""ISO times in their many forms as one form that sorts as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})|(\d{4})-W(\d{2})(?:-(\d))?|(\d{4})W(\d{2})(\d)?)"
_CLOCK = r"(?:(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)?|(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)"
_OFFSET = r"([+-])(?:(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)?|(\d{2})(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)"
_FORM = rf"(?s)^{_DATE}(?:[^0-9W-]{_CLOCK}(?:{_OFFSET})?)?$"

GROUPS, _APART = 29, "\x01"


def normalized_time(c: Column) -> Column:
    """Times as ``YYYY-MM-DDTHH:MM:SS[.ffffff][+HH:MM[:SS[.ffffff]]]``; other texts as they are, trimmed; blank ones null.

    Read are calendar and week dates, with and without hyphens, alone or followed by any one character and a time of hours, minutes and
    seconds with or without colons and a fraction (cut to microseconds), an offset or ``Z``. What looks like a time but is none
    (a 30th of February, an hour 24, an offset of a day) is a text.
    """
    text = F.nullif(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))
    form = F.replace(F.replace(text, F.lit("Z"), F.lit("+00:00")), F.lit(_APART), F.lit(" "))
    # all groups from one match, and bound once, as a lambda's variable
    groups = F.split(F.regexp_replace(form, _FORM, _APART.join(f"${k}" for k in range(1, GROUPS + 1))), _APART)
    return F.coalesce(F.transform(F.array(groups), _normal)[0], text)


def _normal(groups: Column) -> Column:
    """The normal form from a match's groups; null if they are no time."""
    group = lambda k: F.nullif(groups[k - 1], F.lit(""))
    first = lambda *ks: F.coalesce(*[group(k) for k in ks])
    year, month, day = first(1, 4), first(2, 5), first(3, 6)
    calendar = F.to_date(F.when(year != "0000", F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("yyyy-MM-dd"))))
    week_year, week, weekday = first(7, 10).cast("int"), first(8, 11).cast("int"), F.coalesce(first(9, 12), F.lit("1")).cast("int")
    first_monday = lambda y: F.to_date(F.date_trunc("week", F.make_date(y, F.lit(1), F.lit(4))))
    in_weeks = F.date_add(first_monday(week_year), (week - 1) * 7 + weekday - 1)
    weeks = F.floor(F.datediff(first_monday(week_year + 1), first_monday(week_year)) / 7)
    by_week = F.when(week_year.between(1, 9998) & week.between(1, weeks) & weekday.between(1, 7), in_weeks)
    date = F.coalesce(F.when(year.isNotNull(), calendar), F.when(week_year.isNotNull(), by_week))
    hour, minute, second = (F.coalesce(first(*ks), F.lit("00")) for ks in ((13, 17), (14, 18), (15, 19)))
    micro = lambda *ks: F.rpad(F.substring(F.coalesce(first(*ks), F.lit("0")), 1, 6), 6, "0")
    fraction = micro(16, 20)
    hours, minutes, seconds = (F.coalesce(first(*ks), F.lit("00")) for ks in ((22, 26), (23, 27), (24, 28)))
    more = micro(25, 29)
    nothing = (hours == "00") & (minutes == "00") & (seconds == "00") & (more == "000000")
    sign = F.when(nothing, F.lit("+")).otherwise(group(21))
    point = lambda f: F.when(f != "000000", F.concat(F.lit("."), f)).otherwise("")
    tail = F.when((seconds != "00") | (more != "000000"), F.concat(F.lit(":"), seconds, point(more))).otherwise("")
    offset = F.when(group(21).isNotNull(), F.concat(sign, hours, F.lit(":"), minutes, tail)).otherwise("")
    clock = F.concat(F.lit("T"), hour, F.lit(":"), minute, F.lit(":"), second, point(fraction))
    sound = date.isNotNull() & (hour < "24") & (minute < "60") & (second < "60") & (hours < "24") & (minutes < "60") & (seconds < "60")
    return F.when((F.size(groups) == GROUPS) & F.coalesce(sound, F.lit(False)), F.concat(F.date_format(date, "yyyy-MM-dd"), clock, offset))
