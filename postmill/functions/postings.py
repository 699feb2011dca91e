"""Parsers for the free-text fields of a posting, as Column expressions."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, functions as F, types as T

from postmill.functions.numeric import round_even
from postmill.functions.text import SPACE, UNKNOWN, first_label, has_word, let, strip

# --- fixed values: words, tokens and limits ---------------------------------------------

SENIORITY_RULES = [
    ("Intern", ["intern", "internship", "trainee", "apprentice"]),
    ("Entry Level", ["entry", "entry-level", "fresher", "freshers", "graduate"]),
    ("Junior", ["junior", "jr", "associate", "assistant"]),
    ("Director", ["director", "head of", "vp", "vice president"]),
    ("Executive", ["executive", "c-level", "ceo", "cto", "cfo", "cio"]),
    ("Manager", ["manager", "lead manager", "engineering manager"]),
    ("Lead", ["lead", "team lead", "principal", "architect", "staff"]),
    ("Senior", ["senior", "sr", "sr."]),
    ("Mid Level", ["mid", "mid-level", "intermediate"]),
]

EMPLOYMENT_RULES = [
    ("Full-time", ["full-time", "fulltime", "full time", "permanent"]),
    ("Part-time", ["part-time", "parttime", "part time"]),
    ("Contract", ["contract", "contractor", "freelance"]),
    ("Internship", ["internship", "intern", "trainee"]),
    ("Temporary", ["temporary", "temp"]),
]

REMOTE_WORDS = ["work from home", "wfh", "remote", "telecommute", "anywhere", "virtual"]
PARTLY_REMOTE_WORDS = ["hybrid", "partial", "days in office"]
HYBRID_WORDS = ["hybrid", "flexible work"]
ONSITE_WORDS = ["onsite", "on-site", "in-office", "office based", "in office", "office"]

BEGINNER_WORDS = ["fresher", "freshers", "no experience", "0 years"]
# words, years from, years to, level
EXPERIENCE_FALLBACK = [
    (["entry", "entry-level", "fresher", "freshers", "graduate", "intern"], 0.0, 1.0, "Entry Level"),
    (["junior", "jr"], 1.0, 3.0, "Junior"),
    (["senior", "sr", "principal", "architect", "staff"], 5.0, 8.0, "Senior"),
    (["lead", "manager", "head", "director"], 8.0, 15.0, "Lead"),
    (["mid", "mid-level", "intermediate"], 3.0, 5.0, "Mid Level"),
]
# mean years up to and including, level
EXPERIENCE_LEVELS = [(1.0, "Entry Level"), (3.0, "Junior"), (6.0, "Mid Level"), (10.0, "Senior")]
ABOVE_ALL_LEVELS = "Lead"
OPEN_ENDED_YEARS = 3.0

NO_SALARY_TOKENS = ["not disclosed", "confidential", "na", "n/a", "none", "unknown"]
MONTH_WORDS = ["month", "monthly", "pm", "per month"]
HOUR_WORDS = ["hour", "hourly", "hr", "per hour"]
LAKH_WORDS = ["lpa", "lakh", "lakhs", "lac", "lacs"]
LAKH = 100_000.0
LAKH_BELOW = 500.0
SALARY_LIMIT = 500_000_000.0
DEFAULT_CURRENCY = "INR"
DEFAULT_PERIOD = "Annual"

NO_LOCATION_TOKENS = ["unknown", "n/a", "na", "remote", "none"]
DEFAULT_COUNTRY = "India"
CITY_ALIASES = {
    "bangalore": ("Bangalore", "Karnataka"),
    "bengaluru": ("Bangalore", "Karnataka"),
    "mumbai": ("Mumbai", "Maharashtra"),
    "pune": ("Pune", "Maharashtra"),
    "hyderabad": ("Hyderabad", "Telangana"),
    "delhi": ("Delhi", "Delhi"),
    "new delhi": ("New Delhi", "Delhi"),
    "noida": ("Noida", "Uttar Pradesh"),
    "gurgaon": ("Gurgaon", "Haryana"),
    "gurugram": ("Gurgaon", "Haryana"),
    "chennai": ("Chennai", "Tamil Nadu"),
    "kolkata": ("Kolkata", "West Bengal"),
    "ahmedabad": ("Ahmedabad", "Gujarat"),
    "kochi": ("Kochi", "Kerala"),
    "trivandrum": ("Trivandrum", "Kerala"),
    "thiruvananthapuram": ("Trivandrum", "Kerala"),
}

NO_DATE_TOKENS = ["", "unknown", "n/a", "none"]
# shape of the text, Spark date pattern
DATE_FORMATS = [
    (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"),
    (r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "d-M-yyyy"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "d/M/yyyy"),
    (r"^[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{3,9} [0-9]{1,2}, [0-9]{4}$", "MMMM d, yyyy"),
]

SKILL_SEPARATORS = r"[,|\n;]"
SKILL_MAX_LENGTH = 50

# ----------------------------------------------------------------------------------------


def _digits(text: Column, kind: str) -> Column:
    """Number for matched digits, NULL for no match; a failing cast would cost an exception."""
    return F.when(text != "", text.try_cast(kind))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def seniority(title: Column, description: Column) -> Column:
    """Seniority label from title and raw description; earlier rules win."""
    return first_label(F.lower(F.concat_ws(" ", _text(title), _text(description))), SENIORITY_RULES)


def employment_type(value: Column, description: Column) -> Column:
    """Contract type from the raw value and the clean description."""
    return first_label(F.lower(F.concat_ws(" ", _text(value), _text(description))), EMPLOYMENT_RULES)


def remote_type(value: Column, location: Column, title: Column, description: Column) -> Column:
    """Work modality from the raw value, location, title and clean description."""

    def choose(text: Column) -> Column:
        partly = F.when(has_word(text, PARTLY_REMOTE_WORDS), "Hybrid").otherwise("Remote")
        return (
            F.when(has_word(text, REMOTE_WORDS), partly)
            .when(has_word(text, HYBRID_WORDS), "Hybrid")
            .when(has_word(text, ONSITE_WORDS), "Onsite")
            .otherwise(UNKNOWN)
        )

    return let(F.lower(F.concat_ws(" ", *[_text(c) for c in (value, location, title, description)])), choose)


def salary(value: Column, default_currency: str = DEFAULT_CURRENCY) -> Column:
    """Parse salary text into a struct (min, max, currency, period, midpoint).

    Amounts with a k or m suffix take precedence over bare numbers; the first two amounts
    give the range. Amounts are never annualised. Text that discloses nothing gives a NULL
    currency and the period "Unknown".
    """
    return let(strip(value.cast("string")), lambda s: _salary(s, default_currency))


def _salary(s: Column, default_currency: str) -> Column:
    upper, lower = F.upper(s), F.lower(s)
    negative = s.startswith("-")
    undisclosed = (
        s.isNull()
        | (s == "")
        | lower.isin(*NO_SALARY_TOKENS)
        | lower.contains("negative")
        | (negative & ~s.rlike("[0-9]+.*[0-9]+"))
    )
    currency = (
        F.when(s.contains("$") | upper.contains("USD"), "USD")
        .when(s.contains("€") | upper.contains("EUR"), "EUR")
        .when(s.contains("£") | upper.contains("GBP"), "GBP")
        .when(s.contains("₹") | upper.contains("INR") | upper.contains("LPA") | upper.contains("LAKH"), "INR")
        .otherwise(default_currency)
    )
    period = (
        F.when(has_word(s, MONTH_WORDS, "i"), "Monthly")
        .when(has_word(s, HOUR_WORDS, "i"), "Hourly")
        .otherwise(DEFAULT_PERIOD)
    )

    def result(amounts: Column) -> Column:
        low, high = F.array_min(amounts), F.array_max(amounts)
        usable = ~negative & (low > 0) & (low <= SALARY_LIMIT)
        return F.struct(
            F.when(usable, low).alias("min"),
            F.when(usable, high).alias("max"),
            currency.alias("currency"),
            period.alias("period"),
            F.when(usable, round_even((low + high) / 2.0, 2)).alias("midpoint"),
        )

    number = F.lit(None).cast("double")
    nothing = F.struct(
        number.alias("min"),
        number.alias("max"),
        F.lit(None).cast("string").alias("currency"),
        F.lit(UNKNOWN).alias("period"),
        number.alias("midpoint"),
    )
    return F.when(undisclosed, nothing).otherwise(let(_first_two_amounts(s), result))


def _first_two_amounts(s: Column) -> Column:
    """Amounts with their k, m or lakh factor; suffixed ones only, if there are any."""
    digits = F.replace(s, F.lit(","), F.lit(""))
    suffixed = F.lit(rf"(?U)([0-9]+(?:\.[0-9]+)?){SPACE}*([kmKM])\b")
    with_suffix = F.zip_with(
        F.regexp_extract_all(digits, suffixed, F.lit(1)),
        F.regexp_extract_all(digits, suffixed, F.lit(2)),
        lambda number, unit: number.try_cast("double") * F.when(F.lower(unit) == "k", 1e3).otherwise(1e6),
    )
    bare = F.transform(
        F.regexp_extract_all(digits, F.lit(r"[0-9]+(?:\.[0-9]+)?"), F.lit(0)), lambda n: n.try_cast("double")
    )
    amounts = let(with_suffix, lambda found: F.when(F.size(found) > 0, found).otherwise(bare))
    in_lakh = has_word(s, LAKH_WORDS, "i")
    return F.transform(
        F.slice(amounts, 1, 2), lambda n: F.when((n < LAKH_BELOW) & in_lakh, n * LAKH).otherwise(n)
    )


def experience(value: Column, title: Column, description: Column) -> Column:
    """Parse required experience into a struct (min, max, level).

    Beginner words anywhere win, then a number of years in the value itself, then keywords.
    """
    own = strip(_text(value))
    text = F.concat_ws(" ", own, _text(title), _text(description))
    return let(F.struct(F.lower(own).alias("own"), F.lower(text).alias("all")), _experience)


def _experience(texts: Column) -> Column:
    own, text = texts["own"], texts["all"]
    gap = f"{SPACE}*"
    years = rf"(?U)([0-9]+){gap}\+?{gap}(?:-{gap}([0-9]+){gap}\+?|to{gap}([0-9]+))?{gap}(?:years?|yrs?)"

    def group(i: int) -> Column:
        return _digits(F.regexp_extract(own, years, i), "double")

    def result(low, high, level) -> Column:
        low, high = (x if isinstance(x, Column) else F.lit(x).cast("double") for x in (low, high))
        level = level if isinstance(level, Column) else F.lit(level)
        return F.struct(low.alias("min"), high.alias("max"), level.alias("level"))

    def stated(span: Column) -> Column:
        low, high = span["low"], span["high"]
        level = F.when(F.lit(False), "")
        for limit, name in EXPERIENCE_LEVELS:
            level = level.when((low + high) / 2.0 <= limit, name)
        return result(low, high, level.otherwise(ABOVE_ALL_LEVELS))

    low = group(1)
    open_ended = F.when(own.contains("+"), low + OPEN_ENDED_YEARS).otherwise(low)
    span = F.struct(low.alias("low"), F.coalesce(group(2), group(3), open_ended).alias("high"))
    out = F.when(has_word(text, BEGINNER_WORDS), result(0.0, 1.0, "Entry Level")).when(
        own.rlike(years), let(span, stated)
    )
    for words, first, last, name in EXPERIENCE_FALLBACK:
        out = out.when(has_word(text, words), result(first, last, name))
    return out.otherwise(result(None, None, UNKNOWN))


def location(value: Column, aliases: Mapping[str, tuple[str, str]] = CITY_ALIASES) -> Column:
    """Split a place into a struct (city, state, country), with known cities standardised."""
    table = {alias: {"city": city, "state": state} for alias, (city, state) in aliases.items()}
    table = F.from_json(F.lit(json.dumps(table)), "map<string,struct<city:string,state:string>>")

    def standard(place: Column) -> Column:
        known = F.try_element_at(table, F.lower(place["city"]))
        return F.struct(
            F.coalesce(known["city"], place["city"]).alias("city"),
            F.coalesce(known["state"], place["state"]).alias("state"),
            F.when(known.isNotNull(), DEFAULT_COUNTRY).otherwise(place["country"]).alias("country"),
        )

    def split(parts: Column) -> Column:
        return F.struct(
            F.coalesce(F.get(parts, F.lit(0)), F.lit(UNKNOWN)).alias("city"),
            F.coalesce(F.get(parts, F.lit(1)), F.lit(UNKNOWN)).alias("state"),
            F.coalesce(F.get(parts, F.lit(2)), F.lit(DEFAULT_COUNTRY)).alias("country"),
        )

    def parts_of(place: Column) -> Column:
        trimmed = F.transform(F.split(place, ","), lambda p: strip(p))
        return F.when(~F.lower(place).isin("", *NO_LOCATION_TOKENS), F.filter(trimmed, lambda p: p != ""))

    place = let(let(strip(_text(value)), parts_of), split)
    return let(place, standard) if aliases else place


def posted_date(value: Column) -> Column:
    """Parse a date into a struct (iso, year, month, day); all NULL when it is not a date.

    The text before "T" is tried against six formats; failing those, the first
    year-month-day group anywhere in the text is taken unchecked.
    """
    return let(strip(value.cast("string")), _posted_date)


def _posted_date(s: Column) -> Column:
    def dated(text: Column) -> Column:
        # Month names are matched without regard to case and to the amount of space.
        named = F.initcap(F.regexp_replace(text, f"(?U){SPACE}+", " "))
        return F.coalesce(
            *[
                F.when(spelled.rlike(shape), F.try_to_date(spelled, pattern))
                for shape, pattern in DATE_FORMATS
                for spelled in [named if "MMM" in pattern else text]
            ]
        )

    # A text without a digit is no date in any format.
    date = F.when(s.rlike("[0-9]"), let(F.substring_index(s, "T", 1), dated))
    loose = "([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})"

    def found(i: int) -> Column:
        return _digits(F.regexp_extract(s, loose, i), "int")

    def parts(d: Column) -> Column:
        of_date = F.struct(F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"))
        of_text = F.struct(found(1).alias("year"), found(2).alias("month"), found(3).alias("day"))
        return F.when(d.isNotNull(), of_date).when(~F.lower(s).isin(*NO_DATE_TOKENS), of_text)

    def result(p: Column) -> Column:
        iso = F.when(p["year"].isNotNull(), F.format_string("%04d-%02d-%02d", p["year"], p["month"], p["day"]))
        return F.struct(iso.alias("iso"), p["year"], p["month"], p["day"])

    return let(let(date, parts), result)


def skills(value: Column, data_type: T.DataType) -> Column:
    """Distinct skills in order of first mention; NULL gives an empty array."""
    if isinstance(data_type, T.ArrayType):
        raw = F.transform(value, lambda x: x.cast("string"))
    else:
        raw = F.split(value.cast("string"), SKILL_SEPARATORS)
    trimmed = F.transform(raw, lambda x: strip(x))
    kept = F.filter(trimmed, lambda x: (x != "") & (F.length(x) <= SKILL_MAX_LENGTH))
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))
