"""The cleaning plan: raw postings in, canonical postings and cleaning counts out.

Everything is one lazy plan. Text that forms the duplicate key is cleaned first, duplicates
are removed next, and the costly parsing of descriptions runs on the survivors only, so the
one wide shuffle carries raw columns and nothing is parsed twice for the clean table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from postmill.functions import postings as P
from postmill.functions.numeric import to_number
from postmill.functions.text import clean_text, computed_once, strip
from postmill.operators.duplicates import count_exact_duplicates, keep_first, row_digest
from postmill.operators.mapping import ColumnMapping, normalize_columns
from postmill.schema import CANONICAL_COLUMNS, ORDER_COLUMN

DUPLICATE_KEY = ["job_title", "company", "location"]

CLEANING_COUNTS = [
    "initial_rows", "dropped_missing_title", "exact_duplicates", "likely_duplicates", "processed_rows",
    "invalid_salaries", "invalid_experiences", "invalid_dates",
]


@dataclass(frozen=True)
class CleanedPostings:
    """Lazy results: the clean table, the one-row counts and the column mapping used."""

    postings: DataFrame
    counts: DataFrame
    mapping: ColumnMapping


# Parser expressions refer to columns by name only, so each is built once and used in every plan.


@cache
def _key_texts() -> Column:
    return F.transform(F.array(*[F.col(c).cast("string") for c in DUPLICATE_KEY]), clean_text)


@cache
def _description_text() -> Column:
    return clean_text(F.col("description").cast("string"))


@cache
def _salary() -> Column:
    return P.salary(F.col("raw_salary_string"))


@cache
def _experience(known: bool) -> Column:
    value = F.col("experience").cast("string") if known else F.lit(None).cast("string")
    return P.experience(value, F.col("job_title"), F.col("description_clean"))


@cache
def _posted_date() -> Column:
    return P.posted_date(F.col("posted_date").cast("string"))


@cache
def _place() -> Column:
    return P.location(F.col("location"))


@cache
def _labels() -> dict[str, Column]:
    title, description = F.col("job_title"), F.col("description_clean")
    return {
        "seniority_level": P.seniority(title, F.col("description")),
        "remote_type": P.remote_type(F.col("remote_type"), F.col("location"), title, description),
        "employment_type": P.employment_type(F.col("employment_type"), description),
    }


def with_order(raw: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Attach the row order that decides which duplicate comes first.

    File readers of this package attach it already. For other frames name columns that order the rows: their
    current position would differ from run to run.
    """
    if order_by:
        return raw.withColumn(ORDER_COLUMN, F.struct(*order_by))
    if ORDER_COLUMN in raw.columns:
        return raw
    raise ValueError("name the columns that order the rows (order_by), or read files with this package's readers")


def with_job_id(df: DataFrame, raw_columns: Sequence[str], id_source: str | None, hex_digits: int = 64) -> DataFrame:
    """Add ``_job_id``: the given id, or one derived from the values of the row.

    Derived ids depend on nothing but the values, so they are the same in every run, whatever the splits of the
    files. Rows that are equal throughout get equal ids, and only one of them survives the removal of duplicates.
    Fewer than all 64 digits may collide.
    """
    derived = F.concat(F.lit("job_"), F.substring(row_digest(df, raw_columns), 1, hex_digits))
    if id_source is None:
        return df.withColumn("_job_id", derived)
    given = strip(F.col(f"`{id_source}`").cast("string"))
    return df.withColumn("_job_id", F.when(F.coalesce(given, F.lit("")) != "", given).otherwise(derived))


def _keyed(raw: DataFrame, mapping: ColumnMapping, raw_columns: Sequence[str], custom, strict: bool,
           hex_digits: int) -> DataFrame:
    """Canonical columns with ids and with title, company and location cleaned."""
    id_source = next((r for r, t in mapping.targets.items() if t == "job_id"), None)
    named, _ = normalize_columns(with_job_id(raw, raw_columns, id_source, hex_digits), custom, strict=False)
    # One expression cleans the three texts of the key in turn.
    named = named.withColumn("_texts", _key_texts())
    title, company, place = (F.try_element_at(F.col("_texts"), F.lit(i)) for i in (1, 2, 3))
    named = named.withColumns(
        {
            "job_title": title,
            "company": F.when(company == "", P.UNKNOWN).otherwise(company),
            "location": F.when(place == "", P.UNKNOWN).otherwise(place),
            "job_id": F.col("_job_id"),
        }
    ).drop("_job_id", "_texts")
    if strict:
        named = named.select(*[c for c in named.columns if c in CANONICAL_COLUMNS or c in _INPUT_EXTRAS])
    return named


_INPUT_EXTRAS = {"experience", "raw_salary_string", ORDER_COLUMN}


def _salary_from_text(valid: DataFrame, mapping: ColumnMapping) -> Column | bool:
    """Whether salaries come from text: only if no row at all has a numeric bound.

    Usually known from the names. If one bound has a column of its own next to the text, a
    scalar subquery looks for any value in it.
    """
    if mapping.salary_text is None:
        return False
    bounds = [t for t in ("salary_min", "salary_max") if t in mapping.targets.values()]
    if not bounds:
        return True
    any_bound = F.coalesce(*[F.col(c).cast("string") for c in bounds]).isNotNull()
    return ~F.coalesce(valid.agg(F.max(any_bound)).scalar(), F.lit(False))


def add_salary(df: DataFrame, from_text: Column | bool) -> DataFrame:
    """Salary bounds, currency, period and midpoint from text or from numeric columns."""
    low = to_number(F.col("salary_min"), df.schema["salary_min"].dataType)
    high = to_number(F.col("salary_max"), df.schema["salary_max"].dataType)
    numeric = {
        "salary_min": low,
        "salary_max": high,
        "salary_currency": F.coalesce(F.col("salary_currency").cast("string"), F.lit(P.DEFAULT_CURRENCY)),
        "salary_period": F.coalesce(F.col("salary_period").cast("string"), F.lit(P.DEFAULT_PERIOD)),
        "salary_midpoint": (low + high) / 2.0,
    }
    if from_text is False:
        return df.withColumns(numeric)
    fields = {c: c.removeprefix("salary_") for c in numeric}
    df = computed_once(df, _salary(), {f"_{c}": field for c, field in fields.items()})
    parsed = {c: F.col(f"_{c}") for c in numeric}
    parsed["salary_currency"] = F.coalesce(parsed["salary_currency"], F.lit(P.DEFAULT_CURRENCY))
    if from_text is not True:
        df = df.withColumn("_from_text", from_text)
        parsed = {c: F.when(F.col("_from_text"), parsed[c]).otherwise(numeric[c]) for c in parsed}
    return df.withColumns(parsed).drop("_from_text", *[f"_{c}" for c in numeric])


def add_description(df: DataFrame) -> DataFrame:
    return df.withColumn("description_clean", _description_text())


def add_experience(df: DataFrame) -> DataFrame:
    """Years and level; needs the clean title and description."""
    return computed_once(
        df,
        _experience("experience" in df.columns),
        {"experience_min_years": "min", "experience_max_years": "max", "experience_level": "level"},
    )


def add_posted_date(df: DataFrame) -> DataFrame:
    """ISO date as text and as DATE with its parts, and ``_bad_date`` where a raw value could not be read."""
    df = df.withColumn("_given_date", F.col("posted_date").isNotNull())
    df = computed_once(
        df,
        _posted_date(),
        {"posted_date": "iso", "posted_year": "year", "posted_month": "month", "posted_day": "day"},
    )
    df = df.withColumn("posted_dt", F.try_to_date("posted_date", "yyyy-MM-dd"))
    return df.withColumn("_bad_date", F.col("posted_date").isNull() & F.col("_given_date")).drop("_given_date")


def _rules() -> dict[str, Column]:
    """Validation rules: flag and condition."""
    return {
        "INVALID_SALARY_RANGE": F.coalesce(F.col("salary_min") > F.col("salary_max"), F.lit(False)),
        "INVALID_EXPERIENCE_RANGE": F.coalesce(
            F.col("experience_min_years") > F.col("experience_max_years"), F.lit(False)
        ),
        "INVALID_DATE_FORMAT": F.col("_bad_date"),
    }


def add_flags(df: DataFrame) -> DataFrame:
    """Broken rules joined by ", ", or VALID."""
    flags = F.concat_ws(", ", *[F.when(broken, F.lit(flag)) for flag, broken in _rules().items()])
    return df.withColumn("validation_flags", F.when(flags == "", F.lit("VALID")).otherwise(flags)).drop("_bad_date")


def add_categories(df: DataFrame) -> DataFrame:
    """Seniority, place, work modality, contract type and skills."""
    df = computed_once(df, _place(), {c: c for c in ("city", "state", "country")})
    skills = P.skills(F.col("skills"), df.schema["skills"].dataType)
    df = df.withColumns({**_labels(), "skills": skills})
    return df.withColumn("skills_formatted", F.array_join("skills", ", "))


def clean_postings(raw: DataFrame, custom_mapping: Mapping[str, str] | None = None,
                   order_by: Sequence[str] | None = None, strict: bool = False,
                   id_hex_digits: int = 64) -> CleanedPostings:
    """Clean, parse, validate and deduplicate raw postings.

    ``order_by`` names the columns that order the raw rows; they are not part of a posting.
    ``strict`` drops raw columns without a canonical target.
    """
    order_columns = set(order_by or ()) | {ORDER_COLUMN}
    raw_columns = [c for c in raw.columns if c not in order_columns]
    ordered = with_order(raw, order_by).select(*[f"`{c}`" for c in raw_columns], ORDER_COLUMN)
    _, mapping = normalize_columns(ordered, custom_mapping)

    keyed = _keyed(ordered, mapping, raw_columns, custom_mapping, strict, id_hex_digits)
    valid = keyed.where(F.col("job_title") != "")
    from_text = _salary_from_text(valid, mapping)

    first = keep_first(valid, DUPLICATE_KEY, [ORDER_COLUMN])
    parsed = add_flags(add_posted_date(add_experience(add_salary(add_description(first), from_text))))
    parsed = add_categories(parsed)
    extras = [c for c in parsed.columns if c not in CANONICAL_COLUMNS and c != ORDER_COLUMN]
    postings = parsed.select(*CANONICAL_COLUMNS, *[f"`{c}`" for c in extras])

    counts = _cleaning_counts(ordered, raw_columns, keyed, from_text)
    return CleanedPostings(postings, counts, mapping)


def _cleaning_counts(raw: DataFrame, raw_columns, keyed: DataFrame, from_text) -> DataFrame:
    """Cleaning counts as one row; rules are counted before duplicates are removed.

    Two passes: one over digests of raw rows, one that parses each row and adds its flags up per duplicate key.
    """
    checked = add_posted_date(add_experience(add_salary(add_description(keyed), from_text)))
    flags = {"invalid_salaries": "INVALID_SALARY_RANGE", "invalid_experiences": "INVALID_EXPERIENCE_RANGE",
             "invalid_dates": "INVALID_DATE_FORMAT"}
    broken = _rules()
    groups = checked.groupBy(*DUPLICATE_KEY).agg(
        F.count("*").alias("n"), *[F.count_if(broken[flag]).alias(name) for name, flag in flags.items()])
    titled = F.col("job_title") != ""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    row = groups.agg(
        total(F.col("n")).alias("initial_rows"),
        total(F.when(~titled, F.col("n"))).alias("dropped_missing_title"),
        total(F.when(titled, F.col("n") - 1)).alias("likely_duplicates"),
        F.count_if(titled).alias("processed_rows"),
        *[total(F.when(titled, F.col(name))).alias(name) for name in flags],
    )
    exact = count_exact_duplicates(raw.select(*[f"`{c}`" for c in raw_columns])).scalar()
    return row.withColumn("exact_duplicates", exact).select(*CLEANING_COUNTS)
