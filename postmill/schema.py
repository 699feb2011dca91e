"""Canonical posting schema and the column-name vocabulary (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

CANONICAL_TYPES: dict[str, T.DataType] = {
    "job_id": T.StringType(),
    "job_title": T.StringType(),
    "seniority_level": T.StringType(),
    "company": T.StringType(),
    "location": T.StringType(),
    "city": T.StringType(),
    "state": T.StringType(),
    "country": T.StringType(),
    "remote_type": T.StringType(),
    "salary_min": T.DoubleType(),
    "salary_max": T.DoubleType(),
    "salary_currency": T.StringType(),
    "salary_period": T.StringType(),
    "salary_midpoint": T.DoubleType(),
    "experience_min_years": T.DoubleType(),
    "experience_max_years": T.DoubleType(),
    "experience_level": T.StringType(),
    "employment_type": T.StringType(),
    "description": T.StringType(),
    "description_clean": T.StringType(),
    "posted_date": T.StringType(),
    "posted_year": T.IntegerType(),
    "posted_month": T.IntegerType(),
    "posted_day": T.IntegerType(),
    "skills": T.ArrayType(T.StringType()),
    "validation_flags": T.StringType(),
}
CANONICAL_COLUMNS = list(CANONICAL_TYPES)

# Spellings of raw column names per target, after lower-casing and underscoring.
COLUMN_SYNONYMS: dict[str, list[str]] = {
    "job_id": ["job_id", "id", "posting_id", "jobid", "job_key", "job_code", "uniq_id", "position_id", "job_number"],
    "job_title": ["job_title", "title", "jobtitle", "job_role", "designation", "position", "role", "job_name",
                  "title_raw"],
    "company": ["company", "company_name", "companyname", "organization", "employer", "company_raw", "hirer",
                "recruiter"],
    "location": ["location", "job_location", "joblocation", "city", "place", "job_city", "work_location",
                 "location_raw"],
    "country": ["country", "country_name", "nation", "job_country"],
    "remote_type": ["remote_type", "remote", "work_mode", "workmode", "work_type", "job_mode", "is_remote",
                    "work_from_home", "wfh_status"],
    "salary_min": ["salary_min", "min_salary", "minsalary", "salary_from", "salary_low", "min_ctc",
                   "minimum_salary"],
    "salary_max": ["salary_max", "max_salary", "maxsalary", "salary_to", "salary_high", "max_ctc",
                   "maximum_salary"],
    "salary_currency": ["salary_currency", "currency", "salarycurrency", "pay_currency"],
    "experience": ["experience", "experience_level", "experiencelevel", "exp_required", "exp", "years_experience",
                   "seniority", "experience_raw"],
    "employment_type": ["employment_type", "job_type", "jobtype", "employmenttype", "contract_type", "type",
                        "job_contract"],
    "description": ["description", "job_description", "jobdescription", "summary", "details", "description_raw",
                    "job_details", "content"],
    "posted_date": ["posted_date", "date_posted", "posteddate", "post_date", "created_at", "posting_date", "date"],
    "skills": ["skills", "key_skills", "keyskills", "skills_required", "technologies", "tags", "required_skills",
               "skill_set"],
}

# Raw columns that hold a whole salary as text.
SALARY_TEXT_SYNONYMS = ["salary", "salary_range", "salaryrange", "compensation", "pay_range", "ctc", "remuneration",
                        "pay"]

SENIORITY_LEVELS = ["Intern", "Entry Level", "Junior", "Mid Level", "Senior", "Lead", "Manager", "Director",
                    "Executive", "Unknown"]
REMOTE_TYPES = ["Remote", "Hybrid", "Onsite", "Unknown"]
SALARY_PERIODS = ["Annual", "Monthly", "Hourly", "Unknown"]
EXPERIENCE_LEVELS = ["Entry Level", "Junior", "Mid Level", "Senior", "Lead", "Unknown"]
EMPLOYMENT_TYPES = ["Full-time", "Part-time", "Contract", "Internship", "Temporary", "Unknown"]

# Row order of the raw input, see sources.readers.
ORDER_COLUMN = "_ord"
