"""The same results in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from catalog.bindings import TOLD_SQL, duckdb_postings_sql
from catalog.spark_queries import LANGUAGES, LINE_METRICS

LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LINE_METRICS]
MISSING = "('', 'nan', 'None', 'Unknown')"


def rnd(x: str, digits: int) -> str:
    return f"(round_even(({x}) * 1e{digits}::DOUBLE, 0) / 1e{digits}::DOUBLE + 0.0::DOUBLE)"


def pct(part: str, whole: str) -> str:
    share = f"CASE WHEN ({whole}) = 0 THEN 0.0::DOUBLE ELSE ({part})::DOUBLE / ({whole})::DOUBLE * 100.0::DOUBLE END"
    return rnd(share, 2)


def words(text: str, *alternatives: str) -> str:
    return f"regexp_matches({text}, '\\b(?:{'|'.join(alternatives)})\\b')"


def numeric(source: str, value: str, nine_digits: tuple[str, ...] = ()) -> str:
    parts = {
        "mean": "avg(v)", "median": "quantile_cont(v, 0.5)",
        "mode": "(SELECT v FROM x GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)", "min": "min(v)", "max": "max(v)",
        "std": "CASE WHEN count(v) > 1 THEN stddev_samp(v) WHEN count(v) = 1 THEN 0 END",
        "variance": "CASE WHEN count(v) > 1 THEN var_samp(v) WHEN count(v) = 1 THEN 0 END",
        "q1": "quantile_cont(v, 0.25)", "q2": "quantile_cont(v, 0.5)", "q3": "quantile_cont(v, 0.75)",
        "iqr": "quantile_cont(v, 0.75) - quantile_cont(v, 0.25)",
    }
    shown = {name: f"printf('%.8e', {sql})" if name in nine_digits else rnd(sql, 4) for name, sql in parts.items()}
    columns = ", ".join(f'{sql} AS "{name}"' for name, sql in shown.items())
    return (
        f"WITH x AS (SELECT {value}::DOUBLE AS v FROM {source} WHERE {value} IS NOT NULL) "
        f'SELECT count(v) AS "count", {columns} FROM x'
    )


def grouped(source: str, group: str, value: str, least: int = 1, extra: str = "") -> str:
    return f"""SELECT {extra}{group}, count(*) AS "count", {rnd(f'avg({value})', 2)} AS "mean",
      {rnd(f'quantile_cont({value}, 0.5)', 2)} AS "median", {rnd(f'coalesce(stddev_samp({value}), 0)', 2)} AS "std",
      {rnd(f'min({value})', 2)} AS "min", {rnd(f'max({value})', 2)} AS "max"
    FROM {source} WHERE {group} IS NOT NULL AND {value} IS NOT NULL GROUP BY {group} HAVING count(*) >= {least}"""


def iqr(source: str, value: str) -> str:
    return f"""WITH q AS (SELECT quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.75) AS q3 FROM {source}),
    f AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
    c AS (SELECT count({value}) AS n, count(*) FILTER ({value} < lo) AS low, count(*) FILTER ({value} > hi) AS high
          FROM {source}, f)
    SELECT 'IQR' AS method, 1.5::DOUBLE AS factor, n AS total_records, {rnd('q1', 4)} AS q1, {rnd('q3', 4)} AS q3,
      {rnd('q3 - q1', 4)} AS iqr, {rnd('lo', 4)} AS lower_bound, {rnd('hi', 4)} AS upper_bound,
      low + high AS outlier_count, {pct('low + high', 'n')} AS outlier_percentage, low AS low_outlier_count,
      high AS high_outlier_count FROM c, f"""


def corr_cells(columns: list[str], aggregate: dict[tuple[str, str], str]) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rnd(aggregate[a, b], 4)} AS corr FROM x"
        for a in columns for b in columns
    )
    return cells


def pearson(source: str, columns: list[str]) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"WITH x AS (SELECT {', '.join(columns)} FROM {source} WHERE {present}) " + corr_cells(
        columns, {(a, b): f"corr({a}, {b})" for a in columns for b in columns}
    )


def spearman(source: str, columns: list[str]) -> str:
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in columns
    )
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"WITH x AS (SELECT {ranks} FROM {source} WHERE {present}) " + corr_cells(
        columns, {(a, b): f"corr({a}, {b})" for a in columns for b in columns}
    )


def shares(source: str, columns: list[str], with_dimension: bool = True) -> str:
    parts = []
    for c in columns:
        dimension = f"'{c}' AS dimension, " if with_dimension else ""
        parts.append(
            f"SELECT {dimension}{c}::VARCHAR AS \"value\", count(*) AS \"count\", "
            f"{pct('count(*)', f'(SELECT count(*) FROM {source})')} AS percentage "
            f"FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}"
        )
    return " UNION ALL ".join(parts)


def top(source: str, column: str, limit: int, missing: str = MISSING) -> str:
    return f"""SELECT trim({column}) AS {column}, count(*) AS "count",
      {pct('count(*)', f'(SELECT count(*) FROM {source})')} AS percentage
    FROM {source} WHERE {column} IS NOT NULL AND trim({column}) NOT IN {missing}
    GROUP BY trim({column}) ORDER BY 2 DESC, 1 LIMIT {limit}"""


def top_per_column(source: str, columns: list[str], limit: int) -> str:
    parts = [
        f"""SELECT '{c}' AS dimension, trim({c}) AS "value", count(*) AS "count",
          {pct('count(*)', f'(SELECT count(*) FROM {source})')} AS percentage,
          row_number() OVER (ORDER BY count(*) DESC, trim({c})) AS place
        FROM {source} WHERE {c} IS NOT NULL AND trim({c}) NOT IN {MISSING} GROUP BY trim({c})
        QUALIFY place <= {limit}"""
        for c in columns
    ]
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


def cross(source: str, row: str, column: str, values: list[str], limit: int) -> str:
    counts = ", ".join(f"count(*) FILTER ({column} = '{v}') AS \"{v}\"" for v in values)
    counts += f", count(*) FILTER ({column} NOT IN ({', '.join(repr(v) for v in values)})) AS other"
    return f"""SELECT {row}, {counts} FROM {source} WHERE {column} IS NOT NULL AND {row} IN (
      SELECT trim({row}) FROM {source} WHERE trim({row}) NOT IN {MISSING}
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {limit}) GROUP BY {row}"""


def sizes(source: str, column: str) -> str:
    return f"""WITH s AS (SELECT count(*) AS n FROM {source} WHERE trim({column}::VARCHAR) NOT IN {MISSING}
      GROUP BY trim({column}::VARCHAR))
    SELECT count(*) AS total_unique_companies, {rnd('coalesce(avg(n), 0)', 2)} AS mean_postings_per_company,
      {rnd('coalesce(quantile_cont(n::DOUBLE, 0.5), 0)', 2)} AS median_postings_per_company FROM s"""


# --- field parsers ----------------------------------------------------------------------

ENTITIES = [("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&ndash;", "–"), ("&#8212;", "—"), ("&nbsp;", " "),
            ("&amp;", "&")]


def plain(c: str) -> str:
    for name, char in ENTITIES:
        c = f"replace({c}, '{name}', '{char}')"
    c = f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"
    return f"coalesce(trim(regexp_replace({c}, '[\\s\\x{{a0}}]+', ' ', 'g')), '')"


def label(rules: list[tuple[str, tuple[str, ...]]]) -> str:
    cases = " ".join(f"WHEN {words('t', *w)} THEN '{name}'" for name, w in rules)
    return f"CASE {cases} ELSE 'Unknown' END"


SENIORITY = label([
    ("Intern", ("intern", "internship", "trainee", "apprentice")),
    ("Entry Level", ("entry", "fresher", "freshers", "graduate")),
    ("Junior", ("junior", "jr", "associate", "assistant")),
    ("Director", ("director", "head of", "vp", "vice president")),
    ("Executive", ("executive", "c-level", "ceo", "cto", "cfo", "cio")),
    ("Manager", ("manager",)),
    ("Lead", ("lead", "principal", "architect", "staff")),
    ("Senior", ("senior", "sr")),
    ("Mid Level", ("mid", "intermediate")),
])
EMPLOYMENT = label([
    ("Full-time", ("full-time", "fulltime", "full time", "permanent")),
    ("Part-time", ("part-time", "parttime", "part time")),
    ("Contract", ("contract", "contractor", "freelance")),
    ("Internship", ("internship", "intern", "trainee")),
    ("Temporary", ("temporary", "temp")),
])
REMOTE = f"""CASE WHEN {words('t', 'work from home', 'wfh', 'remote', 'telecommute', 'anywhere', 'virtual')}
  THEN CASE WHEN {words('t', 'hybrid', 'partial', 'days in office')} THEN 'Hybrid' ELSE 'Remote' END
  WHEN {words('t', 'hybrid', 'flexible work')} THEN 'Hybrid'
  WHEN {words('t', 'onsite', 'on-site', 'in-office', 'office')} THEN 'Onsite' ELSE 'Unknown' END"""


def joined(*columns: str) -> str:
    return "lower(concat_ws(' ', " + ", ".join(f"coalesce({c}, '')" for c in columns) + "))"


def labelled(source: str, expression: str, name: str, *columns: str) -> str:
    return f"SELECT row_no, {expression} AS {name} FROM (SELECT row_no, {joined(*columns)} AS t FROM {source})"


def salary(source: str) -> str:
    """CTEs that end in parsed_salary(row_no, salary_*)."""
    number = "[0-9]+(?:\\.[0-9]+)?"
    factor = "CASE lower(units[{0}]) WHEN 'k' THEN 1e3::DOUBLE ELSE 1e6::DOUBLE END"
    amount = ", ".join(
        f"CASE WHEN len(suffixed) > 0 THEN suffixed[{i}]::DOUBLE * {factor.format(i)} ELSE bare[{i}]::DOUBLE END AS a{i}"
        for i in (1, 2)
    )
    lakh = ", ".join(
        f"CASE WHEN a{i} < 500 AND regexp_matches(s, '(?i)\\b(?:lpa|lakhs?|lacs?)\\b') THEN a{i} * 100000 ELSE a{i} END"
        f" AS b{i}" for i in (1, 2)
    )
    return f"""salary_texts AS (SELECT row_no, trim("salaryRange") AS s, replace(trim("salaryRange"), ',', '') AS n
      FROM {source}),
    salary_numbers AS (SELECT row_no, s,
      regexp_extract_all(n, '({number})\\s*([kmKM])\\b', 1) AS suffixed,
      regexp_extract_all(n, '({number})\\s*([kmKM])\\b', 2) AS units, regexp_extract_all(n, '{number}') AS bare
      FROM salary_texts),
    salary_amounts AS (SELECT *, {amount} FROM salary_numbers),
    salary_scaled AS (SELECT *, {lakh} FROM salary_amounts),
    salary_bounds AS (SELECT row_no, s, least(b1, coalesce(b2, b1)) AS lo, greatest(b1, coalesce(b2, b1)) AS hi,
      coalesce(s, '') = '' OR lower(s) IN ('not disclosed', 'confidential', 'na', 'n/a', 'none', 'unknown')
        OR contains(lower(s), 'negative') OR (starts_with(s, '-') AND NOT regexp_matches(s, '[0-9]+.*[0-9]+'))
        AS undisclosed FROM salary_scaled),
    salary_usable AS (SELECT *, NOT undisclosed AND NOT starts_with(s, '-') AND lo > 0 AND lo <= 5e8 AS ok
      FROM salary_bounds),
    parsed_salary AS (SELECT row_no,
      CASE WHEN ok THEN lo END AS salary_min, CASE WHEN ok THEN hi END AS salary_max,
      CASE WHEN undisclosed THEN NULL WHEN contains(s, '$') OR contains(upper(s), 'USD') THEN 'USD'
        WHEN contains(s, '€') OR contains(upper(s), 'EUR') THEN 'EUR'
        WHEN contains(s, '£') OR contains(upper(s), 'GBP') THEN 'GBP' ELSE 'INR' END AS salary_currency,
      CASE WHEN undisclosed THEN 'Unknown' WHEN regexp_matches(s, '(?i)\\b(?:month|monthly|pm)\\b') THEN 'Monthly'
        WHEN regexp_matches(s, '(?i)\\b(?:hour|hourly|hr)\\b') THEN 'Hourly' ELSE 'Annual' END AS salary_period,
      CASE WHEN ok THEN {rnd('(lo + hi) / 2', 2)} END AS salary_midpoint FROM salary_usable)"""


def experience(source: str, value: str, title: str, description: str) -> str:
    """CTEs that end in parsed_experience(row_no, experience_*)."""
    pattern = "([0-9]+)\\s*\\+?\\s*(?:-\\s*([0-9]+)\\s*\\+?|to\\s*([0-9]+))?\\s*(?:years?|yrs?)"
    group = "TRY_CAST(regexp_extract(e, '" + pattern + "', {0}) AS DOUBLE)"
    fallback = [
        (("entry", "fresher", "freshers", "graduate", "intern"), 0, 1, "Entry Level"), (("junior", "jr"), 1, 3, "Junior"),
        (("senior", "sr", "principal", "architect", "staff"), 5, 8, "Senior"),
        (("lead", "manager", "head", "director"), 8, 15, "Lead"), (("mid", "intermediate"), 3, 5, "Mid Level"),
    ]
    case = lambda i: " ".join(
        f"WHEN {words('t', *w)} THEN {[str(lo), str(hi), chr(39) + name + chr(39)][i]}" for w, lo, hi, name in fallback
    )
    beginner = words("t", "fresher", "freshers", "no experience", "0 years")
    return f"""experience_texts AS (SELECT row_no, lower(trim(coalesce({value}, ''))) AS e,
      {joined(f'trim({value})', title, description)} AS t FROM {source}),
    experience_years AS (SELECT *, {group.format(1)} AS lo, coalesce({group.format(2)}, {group.format(3)},
      CASE WHEN contains(e, '+') THEN {group.format(1)} + 3 ELSE {group.format(1)} END) AS hi FROM experience_texts),
    parsed_experience AS (SELECT row_no,
      CASE WHEN {beginner} THEN 0 WHEN lo IS NOT NULL THEN lo {case(0)} END::DOUBLE AS experience_min_years,
      CASE WHEN {beginner} THEN 1 WHEN lo IS NOT NULL THEN hi {case(1)} END::DOUBLE AS experience_max_years,
      CASE WHEN {beginner} THEN 'Entry Level' WHEN lo IS NOT NULL THEN CASE WHEN (lo + hi) / 2 <= 1 THEN 'Entry Level'
        WHEN (lo + hi) / 2 <= 3 THEN 'Junior' WHEN (lo + hi) / 2 <= 6 THEN 'Mid Level'
        WHEN (lo + hi) / 2 <= 10 THEN 'Senior' ELSE 'Lead' END {case(2)} ELSE 'Unknown' END AS experience_level
      FROM experience_years)"""


def location(source: str, value: str) -> str:
    """CTEs that end in parsed_location(row_no, city, state, country)."""
    part = lambda i, default: (
        f"coalesce(CASE WHEN lower(p) NOT IN ('', 'unknown', 'n/a', 'na', 'remote', 'none') THEN "
        f"trim(string_split(p, ',')[{i}]) END, '{default}')"
    )
    return f"""places AS (SELECT row_no, trim(coalesce({value}, '')) AS p FROM {source}),
    place_parts AS (SELECT row_no, {part(1, 'Unknown')} AS a, {part(2, 'Unknown')} AS b, {part(3, 'India')} AS c
      FROM places),
    parsed_location AS (SELECT row_no,
      CASE lower(a) WHEN 'bangalore' THEN 'Bangalore' WHEN 'bengaluru' THEN 'Bangalore' WHEN 'mumbai' THEN 'Mumbai'
        ELSE a END AS city,
      CASE lower(a) WHEN 'bangalore' THEN 'Karnataka' WHEN 'bengaluru' THEN 'Karnataka' WHEN 'mumbai' THEN 'Maharashtra'
        ELSE b END AS state,
      CASE WHEN lower(a) IN ('bangalore', 'bengaluru', 'mumbai') THEN 'India' ELSE c END AS country
      FROM place_parts)"""


def dates(source: str) -> str:
    """CTEs that end in parsed_date(row_no, posted_*, given)."""
    formats = ["%Y-%m-%d", "%d-%m-%Y", "%Y/%m/%d", "%d/%m/%Y"]
    tries = ", ".join(f"try_strptime(string_split(trim(\"postedDate\"), 'T')[1], '{f}')" for f in formats)
    return f"""date_values AS (SELECT row_no, coalesce({tries}) AS d, "postedDate" IS NOT NULL AS given FROM {source}),
    parsed_date AS (SELECT row_no, strftime(d, '%Y-%m-%d') AS posted_date, year(d)::INTEGER AS posted_year,
      month(d)::INTEGER AS posted_month, day(d)::INTEGER AS posted_day, given FROM date_values)"""


SKILLS = """array_to_string(list_filter(list_transform(regexp_split_to_array(coalesce("keySkills", ''), '[,|;\\n]'),
  lambda x: trim(x)), lambda x, i: x <> '' AND list_position(list_transform(
  regexp_split_to_array(coalesce("keySkills", ''), '[,|;\\n]'), lambda y: trim(y)), x) = i), ', ')"""

RAW_COLUMNS = ["jobId", "jobTitle", "companyName", "jobLocation", "workMode", "jobType", "salaryRange", "experienceLevel",
               "jobDescription", "postedDate", "keySkills"]
DIGEST = "sha256(" + " || ".join(f"coalesce(length(\"{c}\")::VARCHAR || ':' || \"{c}\", '-')" for c in RAW_COLUMNS) + ")"
RAW = f"WITH raw AS ({duckdb_postings_sql()})"
KEYED = f"""{RAW}, texts AS (SELECT *, {plain('"jobTitle"')} AS job_title, {plain('"companyName"')} AS company0,
    {plain('"jobLocation"')} AS location0, {plain('"jobDescription"')} AS description_clean FROM raw),
  keyed AS (SELECT *, CASE company0 WHEN '' THEN 'Unknown' ELSE company0 END AS company,
    CASE location0 WHEN '' THEN 'Unknown' ELSE location0 END AS location FROM texts)"""
CLEAN = f"""{KEYED}, {salary('keyed')}, {experience('keyed', '"experienceLevel"', 'job_title', 'description_clean')},
  {location('keyed', 'location')}, {dates('keyed')},
  parsed AS (SELECT keyed.*, s.* EXCLUDE (row_no, salary_currency), coalesce(salary_currency, 'INR') AS salary_currency,
      e.* EXCLUDE (row_no), l.* EXCLUDE (row_no), d.* EXCLUDE (row_no),
      coalesce(e.experience_min_years > e.experience_max_years, false) AS bad_experience,
      d.posted_date IS NULL AND d.given AS bad_date
    FROM keyed JOIN parsed_salary s USING (row_no) JOIN parsed_experience e USING (row_no)
      JOIN parsed_location l USING (row_no) JOIN parsed_date d USING (row_no)),
  valid AS (SELECT * FROM parsed WHERE job_title <> ''),
  firsts AS (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY job_title, company, location ORDER BY row_no) = 1),
  labels1 AS (SELECT *, {SENIORITY} AS seniority_level FROM (SELECT *, {joined('job_title', '"jobDescription"')} AS t
    FROM firsts)),
  labels2 AS (SELECT *, {REMOTE} AS remote_type FROM (SELECT * EXCLUDE (t),
    {joined('"workMode"', 'location', 'job_title', 'description_clean')} AS t FROM labels1)),
  labels3 AS (SELECT *, {EMPLOYMENT} AS employment_type FROM (SELECT * EXCLUDE (t),
    {joined('"jobType"', 'description_clean')} AS t FROM labels2)),
  clean AS (SELECT *, {SKILLS} AS skills_formatted, "salaryRange" AS raw_salary_string,
    coalesce(nullif(trim("jobId"), ''), 'job_' || {DIGEST}) AS job_id,
    CASE WHEN bad_experience AND bad_date THEN 'INVALID_EXPERIENCE_RANGE, INVALID_DATE_FORMAT'
      WHEN bad_experience THEN 'INVALID_EXPERIENCE_RANGE' WHEN bad_date THEN 'INVALID_DATE_FORMAT' ELSE 'VALID' END
      AS validation_flags FROM labels3),
  counts AS (SELECT (SELECT count(*) FROM raw) AS initial_rows,
    (SELECT count(*) FROM keyed WHERE job_title = '') AS dropped_missing_title,
    (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (row_no) FROM raw))
      AS exact_duplicates,
    (SELECT count(*) FROM valid) - (SELECT count(*) FROM firsts) AS likely_duplicates,
    (SELECT count(*) FROM firsts) AS processed_rows, 0::BIGINT AS invalid_salaries,
    (SELECT count(*) FROM valid WHERE bad_experience) AS invalid_experiences,
    (SELECT count(*) FROM valid WHERE bad_date) AS invalid_dates)"""

CLEAN_COLUMNS = """job_id, job_title, seniority_level, company, location, city, state, country, remote_type, salary_min,
  salary_max, salary_currency, salary_period, salary_midpoint, experience_min_years, experience_max_years,
  experience_level, employment_type, description_clean, posted_date, posted_year, posted_month, posted_day,
  validation_flags, skills_formatted, raw_salary_string"""

# Every column of the clean table; those that SQL spells differently with their expression.
TEXT_COLUMNS = {c: c for c in [
    "job_id", "job_title", "seniority_level", "company", "location", "city", "state", "country", "remote_type",
    "salary_currency", "salary_period", "experience_level", "employment_type", "description_clean", "posted_date",
    "validation_flags", "raw_salary_string", "skills_formatted"]}
TEXT_COLUMNS |= {"description": '"jobDescription"', "experience": '"experienceLevel"', "salaryRange": '"salaryRange"'}
OTHER_COLUMNS = {c: c for c in [
    "salary_min", "salary_max", "salary_midpoint", "experience_min_years", "experience_max_years", "posted_year",
    "posted_month", "posted_day"]} | {"posted_dt": "posted_date"}


def missing_table(any_case: bool, select: str) -> str:
    """Missing cells per column; an empty list counts as missing in the any-case form only."""
    parts = []
    for c, sql in TEXT_COLUMNS.items():
        test = f"lower(trim({sql})) IN ('', 'nan', 'none', 'unknown')" if any_case else f"trim({sql}) IN {MISSING}"
        parts.append((c, f"{sql} IS NULL OR {test}"))
    parts += [(c, f"{sql} IS NULL") for c, sql in OTHER_COLUMNS.items()]
    parts.append(("skills", "skills_formatted = ''" if any_case else "false"))
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS \"Column\", count(*) AS n, count(*) FILTER ({test}) AS missing FROM clean" for c, test in parts
    )
    return f"{CLEAN} SELECT {select} FROM ({union})"


def _score(fields: list[str], test: str) -> str:
    terms = " + ".join(
        f"(100.0::DOUBLE - count(*) FILTER ({test.format(f)})::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE)" for f in fields
    )
    return f"({terms}) / {len(fields)}"


_MISSING_TEXT = "({0} IS NULL OR trim({0}::VARCHAR) IN " + MISSING + ")"
SCORES = f"""{CLEAN}, parts AS (SELECT
    {rnd(_score(['job_title', 'company', 'location', 'salary_min', 'experience_level', 'description_clean',
                 'skills_formatted'], _MISSING_TEXT), 2)} AS completeness,
    {rnd("count(*) FILTER (validation_flags = 'VALID')::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE", 2)} AS validity,
    {rnd("greatest(0.0::DOUBLE, 100.0::DOUBLE - (SELECT (exact_duplicates + likely_duplicates)::DOUBLE "
         "/ initial_rows::DOUBLE * 100.0::DOUBLE FROM counts))", 2)} AS uniqueness,
    {rnd(' + '.join(f"count(*) FILTER ({c} <> 'Unknown')::DOUBLE / count(*)::DOUBLE * 100.0::DOUBLE" for c in
                    ['seniority_level', 'remote_type', 'employment_type', 'experience_level']).join(['(', ') / 4']), 2)}
      AS consistency FROM clean),
  scores AS (SELECT *, {rnd('0.35::DOUBLE * completeness + 0.25::DOUBLE * validity + 0.20::DOUBLE * uniqueness '
                            '+ 0.20::DOUBLE * consistency', 2)} AS overall_quality_score FROM parts)"""


def _two(x: str) -> str:
    return f"printf('%.2f', {rnd(x, 2)}) || '%'"


BEFORE_AFTER = f"""{CLEAN}, c AS (SELECT count(*) AS n, count(*) FILTER (salary_min IS NULL) AS s,
    count(*) FILTER (location = 'Unknown') AS l FROM clean)
  SELECT 'Rows' AS "Metric", initial_rows::VARCHAR AS "Before", n::VARCHAR AS "After" FROM counts, c UNION ALL
  SELECT 'Exact Duplicates', exact_duplicates::VARCHAR, '0' FROM counts UNION ALL
  SELECT 'Likely Duplicates', likely_duplicates::VARCHAR, '0' FROM counts UNION ALL
  SELECT 'Missing Salary %', 'N/A', {_two('s::DOUBLE / n::DOUBLE * 100')} FROM c UNION ALL
  SELECT 'Missing Location %', 'N/A', {_two('l::DOUBLE / n::DOUBLE * 100')} FROM c UNION ALL
  SELECT 'Invalid Salary', invalid_salaries::VARCHAR, '0' FROM counts UNION ALL
  SELECT 'Invalid Dates', invalid_dates::VARCHAR, '0' FROM counts"""

OVERVIEW = f"""SELECT count(*) AS total_job_postings, count(DISTINCT nullif(company, 'Unknown')) AS unique_companies,
    count(DISTINCT nullif(location, 'Unknown')) AS unique_locations,
    count(DISTINCT nullif(job_title, 'Unknown')) AS unique_job_titles,
    (SELECT count(DISTINCT s) FROM (SELECT unnest(string_split(skills_formatted, ', ')) AS s FROM clean) WHERE s <> '')
      AS unique_skills,
    min(posted_date) AS min_date, max(posted_date) AS max_date,
    {pct("count(*) FILTER (remote_type = 'Remote')", 'count(*)')} AS remote_job_percentage,
    {pct('count(salary_min)', 'count(*)')} AS salary_completeness_pct,
    {pct("count(*) FILTER (experience_level <> 'Unknown')", 'count(*)')} AS experience_completeness_pct FROM clean"""

GROUPS = " UNION ALL ".join(
    f"SELECT '{c}' AS dimension, {c} AS \"value\", * EXCLUDE ({c}) FROM ({grouped('clean', c, 'salary_midpoint', n)})"
    for c, n in [("experience_level", 1), ("remote_type", 1), ("seniority_level", 1), ("city", 2)]
)

INSIGHTS = f"""{CLEAN}, o AS ({OVERVIEW}), t AS ({top('clean', 'job_title', 1, "('Unknown')")}),
  m AS (SELECT count(salary_midpoint) AS n, {rnd('quantile_cont(salary_midpoint, 0.5)', 4)} AS med FROM clean)
  SELECT 'Most frequent title' AS topic, '''' || job_title || ''' is the title that occurs most often.' AS finding,
    t."count" || ' of ' || total_job_postings || ' postings carry it (' || percentage || '%).' AS evidence,
    'Demand in this table centres on that title.' AS interpretation,
    'Holds for the postings at hand, not for a whole market.' AS limitation FROM o, t UNION ALL
  SELECT 'Remote share', remote_job_percentage || '% of the postings are remote.',
    'Counted over ' || total_job_postings || ' postings.', 'Shows how common remote work is here.',
    'A posting that names no modality does not count as remote.' FROM o UNION ALL
  SELECT 'Stated pay', salary_completeness_pct || '% of the postings state a salary; the median is ' || med || '.',
    n || ' of ' || total_job_postings || ' postings have a usable amount.', 'Gives a first point of reference for pay.',
    'Employers choose whether to state pay, so the median may be biased.'
  FROM o, m"""

HISTOGRAM = f"""WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
  c AS (SELECT least(floor((o_totalprice - lo) / (hi - lo) * 20), 19)::INTEGER AS bin, count(*) AS n FROM orders, e GROUP BY 1)
  SELECT b.bin::INTEGER AS bin, {rnd('lo + b.bin * ((hi - lo) / 20)', 2)} AS low,
    {rnd('lo + (b.bin + 1) * ((hi - lo) / 20)', 2)} AS high, coalesce(n, 0) AS "count"
  FROM range(20) b(bin) CROSS JOIN e LEFT JOIN c ON b.bin = c.bin"""

DENSITY = f"""WITH e AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n, stddev_samp(value) AS sd FROM events),
  h AS (SELECT *, sd * pow(n, -0.2::DOUBLE) AS bw FROM e),
  f AS (SELECT avg(value) AS c, count(*) AS w FROM events, h
    GROUP BY least(floor((value - lo) / (hi - lo) * 2048), 2047)),
  g AS (SELECT lo + i * ((hi - lo) / 199) AS x FROM range(200) r(i), h)
  SELECT {rnd('x', 4)} AS x, {rnd('sum(w * exp(-0.5::DOUBLE * pow((x - c) / bw, 2))) / (sqrt(2 * pi()) * any_value(bw) * any_value(n))', 6)}
    AS density FROM g, f, h GROUP BY x"""

BOX = f"""WITH q AS (SELECT o_orderpriority AS p, quantile_cont(o_totalprice, 0.25) AS q1,
    quantile_cont(o_totalprice, 0.5) AS q2, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1),
  x AS (SELECT *, o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
    FROM orders JOIN q ON p = o_orderpriority)
  SELECT o_orderpriority, count(*) AS "count", {rnd('any_value(q1)', 4)} AS q1, {rnd('any_value(q2)', 4)} AS median,
    {rnd('any_value(q3)', 4)} AS q3, min(o_totalprice) FILTER (inside) AS whisker_low,
    max(o_totalprice) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
  FROM x GROUP BY o_orderpriority"""

WORD = r"\.?[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*[+#]*"


def mentions(source: str, key: str, text: str, terms: str, lengths: tuple[int, ...]) -> str:
    """CTEs up to ``found``: hits of (phrase, label) in ``terms``, leftmost and longest, one after the other."""
    return f"""toks AS (SELECT {key} AS k, regexp_extract_all(lower({text}), '{WORD}') AS t FROM {source} WHERE {text} IS NOT NULL),
  phrases AS ({terms}),
  terms AS (SELECT array_to_string(p, ' ') AS p, min(label) AS label
    FROM (SELECT regexp_extract_all(lower(phrase), '{WORD}') AS p, label FROM phrases) GROUP BY 1),
  places AS (SELECT k, t, unnest(range(1, len(t) + 1)) AS i FROM toks),
  runs AS (SELECT k, i - 1 AS pos, n, array_to_string(list_slice(t, i, i + n - 1), ' ') AS p
    FROM places CROSS JOIN (VALUES {', '.join(f'({n})' for n in lengths)}) v(n) WHERE i + n - 1 <= len(t)),
  hits AS (SELECT k, pos, n, label FROM runs JOIN terms USING (p)
    QUALIFY row_number() OVER (PARTITION BY k, pos ORDER BY n DESC) = 1),
  steps AS (SELECT a.k, a.pos, a.n, a.label, min(b.pos) AS nxt FROM hits a LEFT JOIN hits b ON a.k = b.k AND b.pos >= a.pos + a.n GROUP BY ALL),
  found AS (SELECT s.* FROM steps s JOIN (SELECT k, min(pos) AS pos FROM hits GROUP BY k) f ON s.k = f.k AND s.pos = f.pos
    UNION ALL SELECT s.* FROM found f JOIN steps s ON s.k = f.k AND s.pos = f.nxt)"""


def together(source: str, columns: str, least: int) -> str:
    """Associations over a table or CTE of (basket, item), null items for empty baskets."""
    return f"""once AS (SELECT DISTINCT basket, item FROM {source} WHERE item IS NOT NULL),
  single AS (SELECT item, count(*) AS n FROM once GROUP BY item),
  total AS (SELECT count(DISTINCT basket) AS n FROM {source}),
  pairs AS (SELECT x.item AS a, y.item AS b, count(*) AS n_both FROM once x JOIN once y ON x.basket = y.basket AND x.item < y.item
    GROUP BY 1, 2 HAVING count(*) >= {least}),
  rated AS (SELECT a, b, i.n AS n_a, j.n AS n_b, n_both, n_both::DOUBLE AS d, i.n::DOUBLE AS da, j.n::DOUBLE AS db, (SELECT n FROM total)::DOUBLE AS dn
    FROM pairs JOIN single i ON a = i.item JOIN single j ON b = j.item)
  SELECT {columns} FROM rated"""


def rank_sums(table: str, value: str, group: str, where: str = "TRUE") -> str:
    """CTEs: ranks of a column, rank sums per group, the sum of t^3 - t over ties."""
    return f"""WITH x AS (SELECT {group} AS g, {value}::DOUBLE AS v FROM {table} WHERE {group} IS NOT NULL AND {value} IS NOT NULL AND {where}),
      t AS (SELECT g, v, count(*) OVER (PARTITION BY v)::DOUBLE AS t, rank() OVER (ORDER BY v)::DOUBLE AS least FROM x),
      sums AS (SELECT g, count(*)::DOUBLE AS n, sum(least + (t - 1) / 2) AS r FROM t GROUP BY g),
      ties AS (SELECT count(*)::DOUBLE AS n, sum(t * t - 1) AS tied FROM t)"""


def even_tail(x: str, df: str) -> str:
    """Chi-square tail for even degrees of freedom."""
    return f"list_sum([exp(k * ln({x} / 2) - {x} / 2 - lgamma(k + 1)) for k in range(0, {df} // 2)])"


def kruskal(table: str, value: str, group: str) -> str:
    return f"""{rank_sums(table, value, group)},
      h AS (SELECT ties.n, (SELECT count(*) FROM sums) AS k, (12 / (ties.n * (ties.n + 1)) * (SELECT sum(pow(r - n * (ties.n + 1) / 2, 2) / n)
        FROM sums)) / (1 - tied / (pow(ties.n, 3) - ties.n)) AS h FROM ties), h2 AS (SELECT *, k - 1 AS df FROM h)
      SELECT n::BIGINT AS n, k AS n_groups, {rnd('h', 6)} AS h, df, {rnd(even_tail('h', 'df'), 9)} AS p_value,
        {rnd('h / (n - 1)', 9)} AS epsilon_squared FROM h2"""


def rank_test(table: str, value: str, group: str, first: str, second: str) -> str:
    """The two-sided tail is integrated by Simpson's rule from 0 to z."""
    density = "2 / sqrt(2 * pi()) * exp(-pow(abs(z) * i / 4000, 2) / 2)"
    return f"""{rank_sums(table, value, group, f"{group} IN ('{first}', '{second}')")},
      s AS (SELECT a.n AS a, b.n AS b, a.r - a.n * (a.n + 1) / 2 AS u, tied FROM sums a, sums b, ties WHERE a.g = '{first}' AND b.g = '{second}'),
      z AS (SELECT *, sign(u - a * b / 2) * greatest(abs(u - a * b / 2) - 0.5, 0)
        / sqrt(a * b / 12 * (a + b + 1 - tied / ((a + b) * (a + b - 1)))) AS z FROM s),
      p AS (SELECT 1 - abs(any_value(z)) / 4000 / 3 * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * {density}) AS p
        FROM z, range(0, 4001) r(i))
      SELECT a::BIGINT AS n_first, b::BIGINT AS n_second, u, {rnd('z', 9)} AS z, {rnd('p', 9)} AS p_value,
        {rnd('u / (a * b)', 9)} AS superiority FROM z, p"""


def dependence(table: str, a: str, b: str) -> str:
    return f"""WITH x AS (SELECT {a} AS a, {b} AS b FROM {table} WHERE {a} IS NOT NULL AND {b} IS NOT NULL),
      ra AS (SELECT a, count(*)::DOUBLE AS m FROM x GROUP BY a), rb AS (SELECT b, count(*)::DOUBLE AS m FROM x GROUP BY b),
      o AS (SELECT a, b, count(*)::DOUBLE AS o FROM x GROUP BY a, b), n AS (SELECT count(*)::DOUBLE AS n FROM x),
      cells AS (SELECT o, ra.m * rb.m / n AS e FROM ra CROSS JOIN rb CROSS JOIN n LEFT JOIN o ON o.a = ra.a AND o.b = rb.b),
      c AS (SELECT (SELECT n FROM n) AS n, (SELECT count(*) FROM ra) AS ka, (SELECT count(*) FROM rb) AS kb,
        sum(pow(coalesce(o, 0) - e, 2) / e) AS chi, min(e) AS least, count(o) FILTER (e < 5) AS low FROM cells),
      d AS (SELECT *, (ka - 1) * (kb - 1) AS df FROM c)
      SELECT n::BIGINT AS n, ka AS n_first, kb AS n_second, {rnd('chi', 6)} AS chi_square, df, {rnd(even_tail('chi', 'df'), 9)} AS p_value,
        {rnd('sqrt(chi / n / (least(ka, kb) - 1))', 9)} AS cramers_v, {rnd('least', 9)} AS least_expected, low AS low_cells, least < 5 AS low_expected
      FROM d""".replace("least(ka, kb)", "(CASE WHEN ka < kb THEN ka ELSE kb END)")


def pairs_in_order(table: str, x: str, y: str) -> str:
    """Kendall's tau-b from all pairs of distinct cells, its variance by the sums over ties."""
    def ties(name: str, by: str) -> str:
        return f"""{name} AS (SELECT coalesce(sum(n * (n - 1)), 0)::DOUBLE AS two, sum(n * (n - 1) * (2 * n + 5))::DOUBLE AS five,
          sum(n * (n - 1) * (n - 2))::DOUBLE AS three FROM (SELECT sum(n)::DOUBLE AS n FROM c GROUP BY {by}))"""

    return f"""WITH c AS (SELECT {x} AS x, {y} AS y, count(*)::BIGINT AS n FROM {table} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1, 2),
      p AS (SELECT (SELECT sum(n) FROM c)::DOUBLE AS n, sum(CASE WHEN a.y < b.y THEN a.n * b.n ELSE 0 END)::BIGINT AS con,
        sum(CASE WHEN a.y > b.y THEN a.n * b.n ELSE 0 END)::BIGINT AS dis FROM c a JOIN c b ON a.x < b.x),
      {ties('tx', 'x')}, {ties('ty', 'y')},
      s AS (SELECT p.*, (con - dis) / sqrt((n * (n - 1) - tx.two) / 2 * ((n * (n - 1) - ty.two) / 2)) AS tau,
        (con - dis) / sqrt((n * (n - 1) * (2 * n + 5) - tx.five - ty.five) / 18 + tx.two * ty.two / (2 * n * (n - 1))
        + tx.three * ty.three / (9 * n * (n - 1) * (n - 2))) AS z FROM p, tx, ty),
      q AS (SELECT 1 - abs(any_value(z)) / 4000 / 3 * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * 2 / sqrt(2 * pi()) * exp(-pow(abs(z) * i / 4000, 2) / 2)) AS p FROM s, range(0, 4001) r(i))
      SELECT n::BIGINT AS n, con AS concordant, dis AS discordant, {rnd('tau', 9)} AS tau_b, {rnd('z', 9)} AS z, {rnd('q.p', 9)} AS p_value FROM s, q"""


def intervals(table: str, group: str, value: str, means: bool) -> str:
    """Intervals at 0.95: binomial ranks up to 200 values; Student's t by its expansion, for large groups only."""
    z = 1.959963984540054
    far = (f"({z} + {(z**3 + z) / 4} / k + {(5 * z**5 + 16 * z**3 + 3 * z) / 96} / pow(k, 2) + {(3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384}"
           f" / pow(k, 3) + {(79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160} / pow(k, 4))")
    below = "list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2)) for i in range(0, l)])"
    ends = f"{rnd(f'mean - {far} * sd / sqrt(n)', 4)} AS mean_low, {rnd(f'mean + {far} * sd / sqrt(n)', 4)} AS mean_high, " if means else ""
    return f"""WITH x AS (SELECT {group} AS g, {value}::DOUBLE AS v, row_number() OVER (PARTITION BY {group} ORDER BY {value}) AS i
        FROM {table} WHERE {group} IS NOT NULL AND {value} IS NOT NULL),
      s AS (SELECT g, count(*) AS n, count(*) - 1.0::DOUBLE AS k, avg(v) AS mean, stddev_samp(v) AS sd, median(v) AS median FROM x GROUP BY g),
      r AS (SELECT n, max(l) AS l FROM (SELECT DISTINCT n FROM s WHERE n <= 200) d, range(1, 201) t(l) WHERE l <= n AND {below} <= 0.025 GROUP BY n),
      w AS (SELECT s.*, CASE WHEN s.n <= 200 THEN r.l ELSE floor(s.n / 2 + 0.5 - {z} / 2 * sqrt(s.n))::BIGINT END AS l FROM s LEFT JOIN r ON s.n = r.n)
      SELECT w.g AS {group}, n, {rnd('mean', 4)} AS mean, {ends}{rnd('median', 4)} AS median, {rnd('a.v', 4)} AS median_low, {rnd('b.v', 4)} AS median_high
      FROM w LEFT JOIN x a ON a.g = w.g AND a.i = l LEFT JOIN x b ON b.g = w.g AND b.i = n + 1 - l"""


ORACLES: dict[str, str] = {
    "numerical_stats": numeric("lineitem", "l_extendedprice", ("std", "variance")),
    "numerical_stats_events": numeric("events", "value"),
    "categorical_stats": f"""WITH c AS (SELECT trim(o_orderpriority) AS v, count(*) AS n FROM orders GROUP BY 1),
      p AS (SELECT * FROM c WHERE v IS NOT NULL AND v NOT IN {MISSING}),
      t AS (SELECT v, n FROM p ORDER BY n DESC, v LIMIT 1)
      SELECT (SELECT sum(n) FROM c)::BIGINT AS "count", (SELECT sum(n) FROM p)::BIGINT AS non_null_count,
        (SELECT count(*) FROM p) AS "unique", t.v AS top, t.n AS freq, {pct('t.n', '(SELECT sum(n) FROM c)')} AS percentage
      FROM t""",
    "grouped_stats": grouped("lineitem", "l_returnflag", "l_extendedprice"),
    "grouped_stats_min_size": grouped("customer", "c_nationkey", "c_acctbal", 60),
    "outliers_iqr": iqr("events", "value"),
    "outliers_iqr_prices": iqr("orders", "o_totalprice"),
    "outliers_zscore": f"""WITH m AS (SELECT count(value) AS n, avg(value) AS mean, stddev_samp(value) AS sd FROM events),
      c AS (SELECT count(*) FILTER (abs((value - mean) / sd) > 3) AS o FROM events, m)
      SELECT 'Z-Score' AS method, 3.0::DOUBLE AS threshold, n AS total_records, {rnd('mean', 4)} AS mean,
        {rnd('sd', 4)} AS std, o AS outlier_count, {pct('o', 'n')} AS outlier_percentage FROM m, c""",
    "outlier_rows": """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
      SELECT event_id, event_type, value FROM events, q
      WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
    "kruskal_wallis": kruskal("orders", "o_totalprice", "o_orderpriority"),
    "kruskal_wallis_ties": kruskal("lineitem", "l_quantity", "l_returnflag"),
    "mann_whitney": rank_test("lineitem", "l_quantity", "l_linestatus", "F", "O"),
    "chi_square": dependence("orders", "o_orderpriority", "o_orderstatus"),
    "chi_square_sparse": dependence("part", "p_brand", "p_size"),
    "kendall": pairs_in_order("orders", "o_totalprice", "o_custkey"),
    "kendall_ties": pairs_in_order("lineitem", "l_quantity", "l_discount"),
    "group_intervals": intervals("orders", "o_orderpriority", "o_totalprice", True),
    "group_intervals_small": intervals("part", "p_size", "p_retailprice", False),
    "merged_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS "rows", count(*) - count({c}) AS missing, {rnd(f'avg({c}::DOUBLE)', 6)} AS mean,
        {rnd(f'stddev_samp({c}::DOUBLE)', 6)} AS std, min({c})::DOUBLE AS least, max({c})::DOUBLE AS most, TRUE AS distinct_within,
        TRUE AS median_within FROM events""" for c in ("value", "user_id")
    ) + """ UNION ALL SELECT 'event_type', count(*), count(*) - count(event_type), NULL, NULL, NULL, NULL, TRUE, NULL FROM events""",
    "corr_pearson": pearson("lineitem", LINE_METRICS),
    "corr_spearman": spearman("lineitem", LINE_METRICS),
    "corr_matrix": "WITH m AS (" + pearson("part", ["p_size", "p_retailprice", "p_partkey"]) + """)
      SELECT col_a AS "column", max(corr) FILTER (col_b = 'p_size') AS p_size,
        max(corr) FILTER (col_b = 'p_retailprice') AS p_retailprice,
        max(corr) FILTER (col_b = 'p_partkey') AS p_partkey FROM m GROUP BY col_a""",
    "distributions": shares("orders", ["o_orderpriority", "o_orderstatus"]),
    "top_values": top("part", "p_brand", 10),
    "top_values_per_column": top_per_column("part", ["p_type", "p_brand", "p_name"], 5),
    "crosstab": cross("documents", "source", "lang", LANGUAGES, 10),
    "group_sizes": sizes("orders", "o_custkey"),
    "exact_duplicates": """SELECT (SELECT count(*) FROM documents)
      - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)) AS exact_duplicates""",
    "exact_duplicate_postings": f"""{RAW} SELECT (SELECT count(*) FROM raw)
      - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (row_no) FROM raw)) AS exact_duplicates""",
    "likely_duplicates": """SELECT doc_id, lang, source, n_chars FROM documents
      QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "normalize_columns": f"""{RAW} SELECT row_no, "jobId" AS job_id, "jobTitle" AS job_title, "companyName" AS company,
      "jobLocation" AS location, "workMode" AS remote_type, "jobType" AS employment_type, "experienceLevel" AS experience,
      "jobDescription" AS description, "postedDate" AS posted_date, "keySkills" AS skills,
      "salaryRange" AS raw_salary_string, NULL::DOUBLE AS salary_min, NULL::VARCHAR AS country FROM raw""",
    "normalize_columns_titlecase": f"""{RAW} SELECT row_no, "jobTitle" AS job_title, "jobLocation" AS location,
      "workMode" AS "State__raw", "jobType" AS "City__raw", "salaryRange" AS "Salary_Period__raw",
      NULL::VARCHAR AS city, NULL::VARCHAR AS state FROM raw""",
    "clean_text": f"""SELECT page_id, length(t) AS n_chars, md5(t) AS text_md5
      FROM (SELECT page_id, {plain('html')} AS t FROM pages)""",
    "clean_titles": f"""{RAW} SELECT row_no, {plain('"jobTitle"')} AS job_title FROM raw""",
    "seniority": f"{RAW} " + labelled("raw", SENIORITY, "seniority_level", '"jobTitle"', '"jobDescription"'),
    "salary": f"{RAW}, {salary('raw')} SELECT * FROM parsed_salary",
    "experience": f"""{RAW}, {experience('raw', '"experienceLevel"', '"jobTitle"', '"jobDescription"')}
      SELECT * FROM parsed_experience""",
    "location": f"""{RAW}, {location('raw', '"jobLocation"')} SELECT * FROM parsed_location""",
    "remote_type": f"{RAW} " + labelled(
        "raw", REMOTE, "remote_type", '"workMode"', '"jobLocation"', '"jobTitle"', '"jobDescription"'),
    "employment_type": f"{RAW} " + labelled("raw", EMPLOYMENT, "employment_type", '"jobType"', '"jobDescription"'),
    "posted_date": f"{RAW}, {dates('raw')} SELECT * EXCLUDE (given) FROM parsed_date",
    "skills": f"{RAW} SELECT row_no, {SKILLS} AS skills FROM raw",
    "validation_counts": f"{CLEAN} SELECT invalid_salaries, invalid_experiences, invalid_dates FROM counts",
    "clean_postings": f"{CLEAN} SELECT {CLEAN_COLUMNS} FROM clean",
    "cleaning_counts": f"{CLEAN} SELECT * FROM counts",
    "missing_values": missing_table(
        True, f'"Column", n - missing AS "Non_Null_Count", missing AS "Missing_Count", {pct("missing", "n")} '
        'AS "Missing_Percentage"'),
    "top_missing": missing_table(
        False, '"Column", missing::DOUBLE / n::DOUBLE * 100.0::DOUBLE AS "Missing_Pct"')
        + ' ORDER BY 2 DESC, 1 LIMIT 12',
    "quality_score": f"{SCORES} SELECT * FROM scores",
    "before_after": BEFORE_AFTER,
    "score_breakdown": f"""{SCORES} SELECT unnest(['Completeness', 'Validity', 'Uniqueness', 'Consistency', 'OVERALL'])
      AS "Dimension", unnest([completeness, validity, uniqueness, consistency, overall_quality_score]) AS "Score"
      FROM scores""",
    "overview": f"{CLEAN} {OVERVIEW}",
    "job_distributions": f"{CLEAN} " + shares("clean", ["employment_type", "remote_type", "seniority_level", "posted_year"]),
    "top_titles": f"{CLEAN} " + top("clean", "job_title", 20, "('Unknown')"),
    "top_companies": f"{CLEAN} " + top("clean", "company", 15),
    "company_summary": f"{CLEAN}, " + sizes("clean", "company").removeprefix("WITH "),
    "top_places": f"{CLEAN} " + top_per_column("clean", ["city", "state", "country"], 15),
    "remote_by_city": f"{CLEAN} " + cross("clean", "city", "remote_type", ["Remote", "Hybrid", "Onsite", "Unknown"], 10),
    "salary_overall": f"{CLEAN}, " + numeric("clean", "salary_midpoint", ("std", "variance")).removeprefix("WITH ").replace(
        " FROM x", ", 'salary_midpoint' AS target_column_used FROM x").replace(
        "(SELECT v, 'salary_midpoint' AS target_column_used FROM x", "(SELECT v FROM x"),
    "salary_by_group": f"{CLEAN} {GROUPS}",
    "salary_by_city": f"{CLEAN} " + grouped("clean", "city", "salary_midpoint", 2),
    "experience_levels": f"{CLEAN} " + shares("clean", ["experience_level"], with_dimension=False),
    "experience_years": f"{CLEAN} " + " UNION ALL ".join(
        f"SELECT '{c}' AS field, * FROM ({numeric('clean', c)})" for c in ("experience_min_years", "experience_max_years")),
    "insights": INSIGHTS,
    "skill_mentions": "WITH RECURSIVE " + mentions("documents", "doc_id", "text", """SELECT array_to_string(list_slice(t, 1, n), ' ') AS phrase,
      t[1] AS label FROM toks CROSS JOIN (VALUES (2), (3)) v(n) WHERE len(t) >= n""", (2, 3)) + """
      SELECT k AS doc_id, pos AS first_word, n AS n_words, label FROM found""",
    "skill_demand": RAW.replace("WITH", "WITH RECURSIVE", 1) + f""", listed AS (SELECT row_no, concat_ws(' / ', "jobTitle", "keySkills", "jobDescription") AS text,
      string_split({SKILLS}, ', ') AS skills FROM raw), """ + mentions("listed", "row_no", "text", """SELECT DISTINCT s AS phrase, s AS label
      FROM (SELECT unnest(skills) AS s FROM listed) WHERE s <> ''""", (1, 2)) + """
      SELECT label, count(DISTINCT k) AS n_rows, count(*) AS n_mentions FROM found GROUP BY label""",
    "relative_dates": f"""WITH told AS (SELECT o_orderkey, o_orderdate::DATE AS d, (o_orderkey % 40 + 1)::VARCHAR AS n, o_orderkey % 10 AS way FROM orders),
      texts AS (SELECT *, lower({TOLD_SQL}) AS t FROM told),
      days AS (SELECT *, try_cast(regexp_extract(t, '([0-9]+)', 1) AS INT) AS k FROM texts),
      found AS (SELECT *, CASE WHEN t LIKE 'in %' THEN NULL WHEN t = 'just posted' THEN d WHEN t = 'yesterday' THEN d - 1 WHEN t LIKE '%days%' THEN d - k
        WHEN t LIKE '%weeks%' THEN d - 7 * k WHEN t LIKE '%months%' THEN (d - to_months(k))::DATE WHEN t LIKE '%hours%' THEN d - k // 24
        WHEN t = 'last month' THEN (d - to_months(1))::DATE ELSE (d - to_months(12))::DATE END AS day FROM days)
      SELECT o_orderkey, strftime(day, '%Y-%m-%d') AS posted, CASE WHEN day IS NOT NULL THEN t LIKE '%+%' OR t LIKE 'over %' END AS at_least FROM found""",
    "skill_pairs": f"""{RAW}, listed AS (SELECT row_no AS basket, nullif(unnest(string_split({SKILLS}, ', ')), '') AS item FROM raw), """ + together(
        "listed", f"""a, b, n_a, n_b, n_both, {rnd('d / dn', 9)} AS support, {rnd('d / da', 9)} AS confidence_ab,
        {rnd('d / db', 9)} AS confidence_ba, {rnd('d * dn / (da * db)', 9)} AS lift""", 20),
    "suppliers_together": "WITH lines AS (SELECT l_orderkey AS basket, l_suppkey AS item FROM lineitem), " + together(
        "lines", f"a, b, n_both, {rnd('d * dn / (da * db)', 6)} AS lift", 2),
    "chart_shares": f"{CLEAN} " + shares("clean", ["remote_type"], with_dimension=False),
    "chart_histogram": HISTOGRAM,
    "chart_density": DENSITY,
    "chart_box": BOX,
    "chart_heatmap": pearson("lineitem", LINE_NUMBERS),
}
