import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from postmill.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "postmill-tests", **{"spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def data_dir():
    return DATA


LEEDS, HULL, PORTO = ("Leeds", "Yorkshire", "UK"), ("Hull", "Yorkshire", "UK"), ("Porto", "Norte", "Portugal")
#: id, title, company, place, modality, contract, salary bounds and midpoint, years, level, date, skills
POSTINGS = [
    ("p1", "Nurse", "Care North", LEEDS, "Onsite", "Full-time", 28e3, 34e3, 31e3, 2, 4, "Mid Level", "2025-11-03", ["Triage", "Charting"]),
    ("p2", "Nurse", "Care North", LEEDS, "Onsite", "Part-time", 36e3, 40e3, 38e3, 6, 9, "Senior", "2025-11-05", ["Triage"]),
    ("p3", "Welder", "Hull Steel", HULL, "Onsite", "Full-time", 24e3, 26e3, 25e3, 1, 2, "Junior", "2025-12-01", ["MIG", "TIG"]),
    ("p4", "Translator", "Lingua", LEEDS, "Remote", "Contract", 30e3, 50e3, 40e3, 3, 5, "Mid Level", "2026-01-15", ["French", "CAT tools"]),
    ("p5", "Translator", "Lingua", PORTO, "Remote", "Contract", 42e3, 58e3, 50e3, 7, 10, "Senior", "2026-01-20", ["French", "German"]),
    ("p6", "Nurse", "Hull Clinic", HULL, "Onsite", "Full-time", 27e3, 33e3, 30e3, 2, 5, "Mid Level", "2026-02-01", ["Charting"]),
    ("p7", "Editor", "Lingua", PORTO, "Hybrid", "Full-time", 32e3, 36e3, 34e3, 4, 6, "Mid Level", "2026-02-10", ["Proofing"]),
    ("p8", "Welder", "Hull Steel", HULL, "Onsite", "Temporary", 29e3, 37e3, 33e3, 3, 4, "Mid Level", "2026-03-09", ["MIG"]),
]


@pytest.fixture(scope="session")
def eda(spark):
    """Eight clean postings."""
    rows = [
        (key, title, level, company, ", ".join(place), *place, modality, contract, low, high, mid, float(least), float(most),
         level, date, int(date[:4]), int(date[5:7]), skills)
        for key, title, company, place, modality, contract, low, high, mid, least, most, level, date, skills in POSTINGS
    ]
    schema = (
        "job_id string, job_title string, seniority_level string, company string, location string, city string, "
        "state string, country string, remote_type string, employment_type string, salary_min double, "
        "salary_max double, salary_midpoint double, experience_min_years double, experience_max_years double, "
        "experience_level string, posted_date string, posted_year int, posted_month int, skills array<string>"
    )
    return spark.createDataFrame(rows, schema)
