"""Dates told against a day, such as "3 days ago" or "Posted last week", as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Words for quantities, days and lengths.
_QUANTITIES = {
    "a": 1, "an": 1, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "ten": 10, "eleven": 11, "twelve": 12, "couple": 2, "a couple of": 2, "last": 1, "past": 1,
}
_TODAY = ("today", "now", "just now", "just posted", "moments ago", "this morning")
_LENGTHS = {  # names of a length: how many days, or how many months
    "seconds second secs sec s": (0, 0), "minutes minute mins min": (0, 0), "hours hour hrs hr h": (None, 0), "days day d": (1, 0),
    "weeks week wks wk w": (7, 0), "fortnights fortnight": (14, 0), "months month mos mo": (0, 1), "years year yrs yr y": (0, 12),
}
_NAMES = "|".join(sorted((n for names in _LENGTHS for n in names.split()), key=len, reverse=True))
_WORDS = "|".join(sorted(_QUANTITIES, key=len, reverse=True))

_LEAD = r"^(?:(?:re)?posted|updated|active|listed)\b[\s:]*(?:on\b\s*)?"
#: 1: more than, 2: the quantity, 3: a plus sign, 4: the length, 5: ago.
PATTERN = rf"^(over |more than |at least )?([0-9]{{1,5}}|{_WORDS})( ?\+)? ?({_NAMES})( ago| back)?$"


def relative_date(text: Column, anchor: Column) -> Column:
    """Struct (date DATE, at_least BOOLEAN) of a text told against the date ``anchor``; NULL when it tells none.

    Upper and lower case, runs of white space, a leading "posted" and a closing full stop don't count. Quantities are numbers of up
    to five digits or words up to twelve; months and years keep the day of the month or take the last one there is; hours
    count as whole days of 24. "30+ days ago", "over a week ago" and the like give the latest possible day, with ``at_least``
    true. A bare length ("3 days") is taken as its "ago" form only with a digit or "last" or "past" before it. A NULL anchor,
    a plain date and a time yet to come ("in 3 days") give NULL.
    """
    plain = F.trim(F.regexp_replace(F.lower(text), r"[\s ]+", " "))
    plain = F.trim(F.regexp_replace(F.regexp_replace(plain, _LEAD, ""), r"\.$", ""))

    def part(i: int) -> Column:
        return F.regexp_extract(plain, PATTERN, i)

    number = part(2).try_cast("int")
    words = F.create_map(*[F.lit(x) for pair in _QUANTITIES.items() for x in pair])
    many = F.coalesce(number, F.try_element_at(words, part(2)))
    counts = number.isNotNull() | part(2).isin("last", "past") | (part(5) != "")

    days, months = F.lit(None).cast("int"), F.lit(None).cast("int")
    for names, (in_days, in_months) in _LENGTHS.items():
        named = part(4).isin(*names.split())
        whole = F.floor(many / 24).cast("int") if in_days is None else many * in_days
        days, months = F.when(named, whole).otherwise(days), F.when(named, many * in_months).otherwise(months)
    told = F.add_months(F.date_sub(anchor.cast("date"), days), -months)
    date = (
        F.when(plain.isin(*_TODAY), anchor.cast("date"))
        .when(plain == "yesterday", F.date_sub(anchor.cast("date"), 1))
        .when(plain == "the day before yesterday", F.date_sub(anchor.cast("date"), 2))
        .when(counts, told)
    )
    at_least = (part(1) != "") | (part(3) != "")
    return F.when(date.isNotNull(), F.struct(date.alias("date"), F.coalesce(at_least, F.lit(False)).alias("at_least")))
