"""How the test tables are read as postings.

The tables hold no postings, so one posting is derived per order. The rules use only
arithmetic, CASE and concatenation, so one SQL text gives the same rows on both engines.
Every fiftieth order appears twice, as an exact copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postmill.sources.readers import spread

#: How a day is told against the date of an order: one of ten ways, with a quantity of 1 to 40.
TOLD_SQL = """CASE o_orderkey % 10 WHEN 0 THEN 'Just posted' WHEN 1 THEN 'Yesterday' WHEN 2 THEN concat('Posted ', n, ' days ago')
  WHEN 3 THEN concat(n, '+ days ago') WHEN 4 THEN concat('over ', n, ' Weeks ago') WHEN 5 THEN concat(n, ' months  ago.')
  WHEN 6 THEN concat(n, ' hours ago') WHEN 7 THEN 'last month' WHEN 8 THEN concat('in ', n, ' days') ELSE 'a year ago' END"""

POSTINGS_SQL = """
WITH numbered AS (
  SELECT o_orderkey AS k, o_orderkey % 30 + 1 AS a, o_orderkey % 30 + 5 AS b, c_name, n_name,
         cast(year(o_orderdate) AS string) AS y,
         lpad(cast(month(o_orderdate) AS string), 2, '0') AS m,
         lpad(cast(day(o_orderdate) AS string), 2, '0') AS d
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
), copies AS (
  SELECT *, 0 AS copy_no FROM numbered
  UNION ALL
  SELECT *, 1 AS copy_no FROM numbered WHERE k % 50 = 0
)
SELECT
  k * 2 + copy_no AS row_no,
  CASE WHEN k % 9 = 0 THEN NULL ELSE cast(k AS string) END AS `jobId`,
  CASE k % 12 WHEN 0 THEN 'Senior Data Engineer' WHEN 1 THEN 'Junior Analyst' WHEN 2 THEN 'Data Science Intern'
    WHEN 3 THEN 'Lead Architect' WHEN 4 THEN 'Engineering Director'
    WHEN 5 THEN '<p>Data &amp; BI Analyst</p>' WHEN 6 THEN 'Graduate Trainee'
    WHEN 7 THEN 'Engineering Manager' WHEN 8 THEN 'Chief CTO' WHEN 9 THEN 'Mid-level Developer'
    WHEN 10 THEN 'Data  Analyst ' ELSE NULL END AS `jobTitle`,
  CASE WHEN k % 20 = 0 THEN '' ELSE c_name END AS `companyName`,
  CASE k % 8 WHEN 0 THEN 'Bangalore, Karnataka, India' WHEN 1 THEN 'bengaluru' WHEN 2 THEN 'Mumbai'
    WHEN 3 THEN 'Remote' WHEN 4 THEN '' WHEN 5 THEN 'London, England, UK' WHEN 6 THEN n_name
    ELSE NULL END AS `jobLocation`,
  CASE k % 5 WHEN 0 THEN 'Work From Home' WHEN 1 THEN 'Hybrid' WHEN 2 THEN 'In-Office' WHEN 3 THEN ''
    ELSE NULL END AS `workMode`,
  CASE k % 6 WHEN 0 THEN 'Full-Time' WHEN 1 THEN 'Part Time' WHEN 2 THEN 'Contractor' WHEN 3 THEN 'Internship'
    WHEN 4 THEN 'Temporary' ELSE NULL END AS `jobType`,
  CASE k % 10
    WHEN 0 THEN concat(cast(a AS string), '-', cast(b AS string), ' LPA')
    WHEN 1 THEN concat('$', cast(a AS string), ',000 - $', cast(b AS string), ',000')
    WHEN 2 THEN concat('₹', cast(a AS string), ',000 per month')
    WHEN 3 THEN concat('$', cast(a AS string), ' / hr')
    WHEN 4 THEN concat(cast(a AS string), 'k - ', cast(b AS string), 'K')
    WHEN 5 THEN concat('€', cast(a AS string), '000')
    WHEN 6 THEN 'Not Disclosed'
    WHEN 7 THEN concat('-', cast(a AS string))
    WHEN 8 THEN concat(cast(a AS string), 'LPA')
    ELSE NULL END AS `salaryRange`,
  CASE k % 7
    WHEN 0 THEN concat(cast(a AS string), '-', cast(b AS string), ' years')
    WHEN 1 THEN concat(cast(a AS string), ' to ', cast(b AS string), ' yrs')
    WHEN 2 THEN concat(cast(a AS string), '+ years')
    WHEN 3 THEN 'Freshers welcome'
    WHEN 4 THEN concat(cast(b AS string), '-', cast(a AS string), ' years')
    WHEN 5 THEN '' ELSE NULL END AS `experienceLevel`,
  CASE k % 13 WHEN 0 THEN 'A permanent role &ndash; three days in office' WHEN 1 THEN '<ul><li>SQL</li></ul> hybrid team'
    WHEN 2 THEN 'Reports to the vice president&nbsp;&nbsp;of sales' WHEN 3 THEN 'No experience needed &#8212; we train'
    WHEN 4 THEN 'Flexible work, contract possible' WHEN 5 THEN NULL
    ELSE concat('Join ', c_name, ' as part of a growing team') END AS `jobDescription`,
  CASE k % 6 WHEN 0 THEN concat(y, '-', m, '-', d) WHEN 1 THEN concat(d, '-', m, '-', y)
    WHEN 2 THEN concat(y, '/', m, '/', d) WHEN 3 THEN concat(y, '-', m, '-', d, 'T00:00:00')
    WHEN 4 THEN 'Invalid Date' ELSE NULL END AS `postedDate`,
  CASE k % 4 WHEN 0 THEN 'Python, SQL, Python' WHEN 1 THEN concat('Spark|AWS;SQL;', n_name) WHEN 2 THEN ''
    ELSE NULL END AS `keySkills`
FROM copies
"""

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw postings with text columns only, plus ``row_no``, which orders the rows."""
    tables = {name: table(spark, sf_dir, name) for name in ("customer", "nation")}
    tables["orders"] = spread(table(spark, sf_dir, "orders"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.sql(POSTINGS_SQL, **tables)


def duckdb_postings_sql() -> str:
    return POSTINGS_SQL.replace("`", '"').format(orders="orders", customer="customer", nation="nation")
