"""The batch flow with tagged rules, on customers dressed as market records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import expect_drop, where_sql
from ..plans import publish_rules, rules_from_csv
from ..scratch import scratch_dir
from ..sources import write_complete
from .inputs import table
from .registry import query

# Valid in Spark and in DuckDB.
MARKETS = [
    'c_name AS "MarketName"',
    "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE concat('www.', c_name) END AS \"Website\"",
    "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE concat('place ', c_nationkey) END AS \"Location\"",
    "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_mktsegment END AS \"State\"",
    "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'fb' END AS \"Facebook\"",
    "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'tw' END AS \"Twitter\"",
    "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'yt' END AS \"Youtube\"",
    "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'N' ELSE 'Y' END AS \"Organic\"",
    "CASE WHEN c_custkey % 37 = 0 THEN 'unknown' ELSE concat(1 + c_custkey % 12, '/',"
    " 1 + c_custkey % 28, '/', 2000 + c_custkey % 20, ' ', 1 + c_custkey % 12, ':',"
    " c_custkey % 60, ':', c_custkey % 59, CASE WHEN c_custkey % 2 = 0 THEN ' AM' ELSE ' PM' END)"
    ' END AS "updateTime"',
]

# Fixed rule texts, but for the lenient date function: the plain one stops the
# job at the first bad date.
MARKET_RULES = [
    ("website_not_null", "Website IS NOT NULL", "validity"),
    ("location_not_null", "Location IS NOT NULL", "validity"),
    ("state_not_null", "State IS NOT NULL", "validity"),
    ("fresh_data", "try_to_date(updateTime,'M/d/yyyy h:m:s a') > '2010-01-01'", "maintained"),
    (
        "social_media_access",
        "NOT(Facebook IS NULL AND Twitter IS NULL AND Youtube IS NULL)",
        "maintained",
    ),
]

# What the result shows: own choice among the columns of `MARKETS`.
ORGANIC_COLUMNS = ["MarketName", "State", "Website", "updateTime"]

PARSED_SQL = "CAST(try_strptime(\"updateTime\", '%m/%d/%Y %I:%M:%S %p') AS DATE)"


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*[m.replace('"', "`") for m in MARKETS])


MARKETS_SQL = f"markets AS (SELECT {', '.join(MARKETS)} FROM customer)"


@query(f"""WITH {MARKETS_SQL}
    SELECT {', '.join(f'"{c}"' for c in ORGANIC_COLUMNS)} FROM markets
    WHERE "Website" IS NOT NULL AND "Location" IS NOT NULL AND "State" IS NOT NULL
      AND "Organic" = 'Y' AND {PARSED_SQL} > DATE '2010-01-01'
      AND NOT ("Facebook" IS NULL AND "Twitter" IS NULL AND "Youtube" IS NULL)""", name="market_projection")
def organic_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "market")
    publish_rules(spark, MARKET_RULES, f"{path}/rules")
    raw = expect_drop(markets(spark, sf_dir), rules_from_csv(spark, f"{path}/rules", "validity"))
    raw = write_complete(raw, f"{path}/raw_markets")
    organic = where_sql(raw, "Organic = 'Y'")
    return expect_drop(
        organic.select(*ORGANIC_COLUMNS), rules_from_csv(spark, f"{path}/rules", "maintained")
    )


@query(f"""WITH {MARKETS_SQL}
    SELECT "MarketName", strftime({PARSED_SQL}, '%Y-%m-%d') AS updated,
      {PARSED_SQL} IS NULL AS unreadable FROM markets""")
def typed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    updated = F.expr("try_to_date(updateTime, 'M/d/yyyy h:m:s a')")
    return markets(spark, sf_dir).select(
        "MarketName",
        updated.cast("string").alias("updated"),
        updated.isNull().alias("unreadable"),
    )
