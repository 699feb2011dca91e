"""Field parsers against hand-written cases."""

import html

from pyspark.sql import functions as F, types as T

from postmill.functions import numeric as N, postings as P, text as X


def apply(spark, values, expression, n_args=1):
    """Evaluate an expression of columns a, b, c, d for a list of argument tuples."""
    names = list("abcd")[:n_args]
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    schema = "i int, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame(rows, schema)
    out = df.select("i", expression(*[F.col(n) for n in names]).alias("r")).orderBy("i").collect()
    return [tuple(r["r"]) if hasattr(r["r"], "__fields__") else r["r"] for r in out]


def test_clean_text(spark):
    cases = {
        "<li>Wood <i>&amp;</i> stone,&nbsp;both</li>": "Wood & stone, both",
        "": "",
        None: "",
        "  a\t\n b  c ": "a b c",
        "&lt;b&gt;bold&lt;/b&gt; text": "bold text",
        "a < b and c > d": "a d",
        "no closing <b": "no closing <b",
    }
    assert apply(spark, list(cases), X.clean_text) == list(cases.values())


ENTITIES = [
    "plain", "&", "&&", "a & b", "&amp;", "&amp;lt;", "&amp;amp;amp;", "&ampfoo", "&amp foo", "&copy2024", "&notit;",
    "&notin;", "&hellip;&mdash;&rsquo;", "&#8217;", "&#x2019;", "&#X2019", "&#39;s", "&#0;", "&#128;", "&#x80;",
    "&#129;", "&#13;x", "&#11;x", "&#xD800;", "&#1114112;", "&#99999999999;", "&#xffffffffff;", "&#xFDD0;", "&#x1F600;",
    "&unknown;", "&;", "&#;", "&#x;", "x&lt", "&ltgt;", "&Aacute;&aacute", "&fjlig;", "&NotEqualTilde;", "&amp",
    "&quot;a&quot;&apos;", "trailing &", "&CounterClockwiseContourIntegral;", "&#0065;", "&nbsp;&nbsp", "&amp;#39;",
]


def test_unescape_equals_html5_rules(spark):
    assert apply(spark, ENTITIES, X.unescape_html) == [html.unescape(s) for s in ENTITIES]


def test_seniority(spark):
    cases = {
        ("Senior Data Analyst", ""): "Senior",
        ("Junior Software Engineer", ""): "Junior",
        ("Data Science Intern", ""): "Intern",
        ("Lead Architect", ""): "Lead",
        ("Engineering Director", ""): "Director",
        ("Data Analyst", ""): "Unknown",
        ("Data Analyst", None): "Unknown",
        ("Analyst", "reports to the vice president"): "Director",
        ("Mid-level Developer", ""): "Mid Level",
        ("Chief CTO", ""): "Executive",
        ("Engineering Manager", ""): "Manager",
        ("Graduate Trainee", ""): "Intern",
        ("International Sales", ""): "Unknown",
        ("élead", ""): "Unknown",
    }
    assert apply(spark, list(cases), P.seniority, 2) == list(cases.values())


def test_salary(spark):
    cases = {
        "4-7 LPA": (400000.0, 700000.0, "INR", "Annual", 550000.0),
        "$50,000 - $70,000": (50000.0, 70000.0, "USD", "Annual", 60000.0),
        "$80,000 - $120,000": (80000.0, 120000.0, "USD", "Annual", 100000.0),
        "₹30,000 per month": (30000.0, 30000.0, "INR", "Monthly", 30000.0),
        "$40 / hr": (40.0, 40.0, "USD", "Hourly", 40.0),
        "$50/hr": (50.0, 50.0, "USD", "Hourly", 50.0),
        "10 LPA - 15 LPA": (1e6, 1.5e6, "INR", "Annual", 1.25e6),
        "5-8 Lakhs": (500000.0, 800000.0, "INR", "Annual", 650000.0),
        "₹4,00,000 - ₹7,00,000": (400000.0, 700000.0, "INR", "Annual", 550000.0),
        "Not Disclosed": (None, None, None, "Unknown", None),
        "Negative -100": (None, None, None, "Unknown", None),
        "": (None, None, None, "Unknown", None),
        None: (None, None, None, "Unknown", None),
        "-5": (None, None, None, "Unknown", None),
        "-5000": (None, None, "INR", "Annual", None),
        "-5 $": (None, None, None, "Unknown", None),
        "50k - 80k": (50000.0, 80000.0, "INR", "Annual", 65000.0),
        "50 - 80k": (80000.0, 80000.0, "INR", "Annual", 80000.0),
        "1.5m": (1.5e6, 1.5e6, "INR", "Annual", 1.5e6),
        "4LPA": (4.0, 4.0, "INR", "Annual", 4.0),
        "€70000": (70000.0, 70000.0, "EUR", "Annual", 70000.0),
        "GBP 10-20 hourly": (10.0, 20.0, "GBP", "Hourly", 15.0),
        "90 - 30": (30.0, 90.0, "INR", "Annual", 60.0),
        "0": (None, None, "INR", "Annual", None),
        "600000000": (None, None, "INR", "Annual", None),
        "competitive": (None, None, "INR", "Annual", None),
        "1 - 2 - 3": (1.0, 2.0, "INR", "Annual", 1.5),
    }
    assert apply(spark, list(cases), P.salary) == list(cases.values())


def test_experience(spark):
    cases = {
        ("0-1 years", "", ""): (0.0, 1.0, "Entry Level"),
        ("3 to 5 yrs", "", ""): (3.0, 5.0, "Mid Level"),
        ("3-5 yrs", "", ""): (3.0, 5.0, "Mid Level"),
        ("7+ years", "", ""): (7.0, 10.0, "Senior"),
        ("Freshers welcome", "", ""): (0.0, 1.0, "Entry Level"),
        ("", "", ""): (None, None, "Unknown"),
        (None, None, None): (None, None, "Unknown"),
        ("", "Senior Data Engineer", ""): (5.0, 8.0, "Senior"),
        ("", "Junior Analyst", ""): (1.0, 3.0, "Junior"),
        ("", "Head of Data", ""): (8.0, 15.0, "Lead"),
        ("", "", "intermediate"): (3.0, 5.0, "Mid Level"),
        ("12 years", "", ""): (12.0, 12.0, "Lead"),
        ("5-2 years", "", ""): (5.0, 2.0, "Mid Level"),
        ("5", "", ""): (None, None, "Unknown"),
        ("0 years", "", ""): (0.0, 1.0, "Entry Level"),
        ("10 years", "", "no experience"): (0.0, 1.0, "Entry Level"),
    }
    assert apply(spark, list(cases), P.experience, 3) == list(cases.values())


def test_location(spark):
    cases = {
        "Bangalore, Karnataka, India": ("Bangalore", "Karnataka", "India"),
        "Mumbai": ("Mumbai", "Maharashtra", "India"),
        "bengaluru": ("Bangalore", "Karnataka", "India"),
        "Unknown": ("Unknown", "Unknown", "India"),
        "remote": ("Unknown", "Unknown", "India"),
        "": ("Unknown", "Unknown", "India"),
        None: ("Unknown", "Unknown", "India"),
        "London, England, UK": ("London", "England", "UK"),
        "Paris, , France": ("Paris", "France", "India"),
        ",": ("Unknown", "Unknown", "India"),
        "Pune, X, Y": ("Pune", "Maharashtra", "India"),
    }
    assert apply(spark, list(cases), P.location) == list(cases.values())
    plain = apply(spark, ["Mumbai"], lambda c: P.location(c, aliases={}))
    assert plain == [("Mumbai", "Unknown", "India")]


def test_remote_and_employment(spark):
    remote = {
        ("Work From Home", "", "", ""): "Remote",
        ("Hybrid", "", "", ""): "Hybrid",
        ("In-Office", "", "", ""): "Onsite",
        ("", "", "", ""): "Unknown",
        (None, None, None, None): "Unknown",
        ("", "Remote, India", "", ""): "Remote",
        ("remote", "", "", "three days in office"): "Hybrid",
        ("", "", "", "flexible work"): "Hybrid",
    }
    assert apply(spark, list(remote), P.remote_type, 4) == list(remote.values())
    employment = {
        ("Full-Time", ""): "Full-time",
        ("Part Time", ""): "Part-time",
        ("Contractor", ""): "Contract",
        ("Internship", ""): "Internship",
        ("Temporary", ""): "Temporary",
        (None, "permanent position"): "Full-time",
        (None, None): "Unknown",
    }
    assert apply(spark, list(employment), P.employment_type, 2) == list(employment.values())


def test_posted_date(spark):
    none = (None, None, None, None)
    march = ("2026-03-15", 2026, 3, 15)
    cases = {
        "2026-03-15": march, "15-03-2026": march, "2026/03/15": march, "15/3/2026": march,
        "Mar 15, 2026": march, "march 15, 2026": march, "MARCH  15, 2026": march,
        "2026-03-15T09:30:00Z": march, "2026-03-15 09:30:00": march, " 2026-3-15 ": march,
        "Invalid Date": none, "": none, None: none, "unknown": none,
        "2026-13-40": ("2026-13-40", 2026, 13, 40),
        "31-02-2026": none, "30/02/2026": none, "3 days ago": none, "May 3, 2026": ("2026-05-03", 2026, 5, 3),
    }
    assert apply(spark, list(cases), P.posted_date) == list(cases.values())


def test_skills(spark):
    cases = {
        "Python, SQL, Python": ["Python", "SQL"],
        "Spark|AWS;SQL\nGo": ["Spark", "AWS", "SQL", "Go"],
        "python,Python": ["python", "Python"],
        "": [], None: [], " , ": [],
        "x" * 50 + "," + "y" * 51: ["x" * 50],
    }
    assert apply(spark, list(cases), lambda c: P.skills(c, T.StringType())) == list(cases.values())
    df = spark.createDataFrame([([" SQL ", "Go", "SQL", None],), (None,)], "s array<string>")
    got = [r[0] for r in df.select(P.skills(F.col("s"), df.schema["s"].dataType)).collect()]
    assert got == [["SQL", "Go"], []]


def test_to_number(spark):
    cases = {"1": 1.0, " 2.5 ": 2.5, "-3e2": -300.0, "1d": None, "2f": None, "nan": None, "": None, None: None,
             "1,000": None, ".5": 0.5, "x": None}
    assert apply(spark, list(cases), lambda c: N.to_number(c, T.StringType())) == list(cases.values())
    df = spark.createDataFrame([(float("nan"),), (2.0,), (None,)], "x double")
    assert [r[0] for r in df.select(N.to_number(F.col("x"), T.DoubleType())).collect()] == [None, 2.0, None]


def test_rounding_and_number_text(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (1.005,), (0.375,)], "x double")
    assert [r[0] for r in df.select(N.round_even(F.col("x"), 2)).collect()] == [0.12, 2.68, 1.0, 0.38]
    df = spark.createDataFrame([(40.0,), (6.67,), (12500000.0,), (0.0001,), (None,)], "x double")
    assert [r[0] for r in df.select(N.number_text(F.col("x"))).collect()] == [
        "40.0", "6.67", "12500000.0", "0.0001", "None"
    ]


def test_missing_predicates(spark):
    df = spark.createDataFrame([("",), (" NaN ",), ("None",), ("unknown",), ("x",), (None,)], "s string")
    any_case = [r[0] for r in df.select(X.is_missing(F.col("s"), T.StringType())).collect()]
    exact = [r[0] for r in df.select(X.is_missing_exact(F.col("s"))).collect()]
    assert any_case == [True, True, True, True, False, True]
    assert exact == [True, False, True, False, False, True]


def test_cheap_looks_come_before_searches(spark):
    """Clean texts and texts without a word are told by plain looks; the results are those of the whole search."""
    texts = [None, "", "plain text #1 (x)", " a", "a ", "a  b", "a\tb", "a\x1fb", "a b", "a  b", "über  été", "a &amp; b", "<b>x</b> y",
             "a&lt;b>c", "x\n", "a\x00b", "12 lac", "9 LAKH", "4 lacſ", "per  month", "MONTHLY", "6 pm.", "apm", "Internı", "mid-level", "midlevel", "head of"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = F.coalesce(F.trim(F.regexp_replace(F.regexp_replace(X.unescape_html(F.col("t")), "<[^>]+>", " "), f"(?U){X.SPACE}+", " ")), F.lit(""))
    cases = [(["month", "monthly", "pm", "per month"], "i"), (["lpa", "lakh", "lakhs", "lac", "lacs"], "i"), (["intern", "mid", "mid-level"], "i"),
             (["mid", "mid-level", "head of"], "")]
    for r in frame.select("t", whole.alias("whole"), X.clean_text(F.col("t")).alias("clean")).collect():
        assert r.clean == r.whole, r
    for words, flags in cases:
        search = F.col("t").rlike(f"(?U{flags})\\b(?:{'|'.join(words)})\\b")
        for r in frame.select("t", search.alias("whole"), X.has_word(F.col("t"), words, flags).alias("some")).collect():
            assert r.some == r.whole, (r, words)
    assert "contains" in str(X.has_word(F.col("t"), ["senior", "sr"])) and "contains" in str(X.clean_text(F.col("t")))
