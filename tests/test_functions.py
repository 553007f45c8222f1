"""Column helpers and CASE boundaries (edge rows)."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from reelhouse.functions import field_position, money_label, mysql_div, mysql_week_monday
from reelhouse.plans.warehouse import age_group_of, churn_risk_of, day_period_of, region_of


def _week_mode1(d: dt.date) -> int:
    """Independent statement of the rule: Monday weeks, week 1 = first week
    with 4+ days in the year, earlier days are week 0."""
    jan1 = dt.date(d.year, 1, 1)
    first_monday = jan1 - dt.timedelta(days=jan1.weekday())
    if (jan1 - first_monday).days > 3:      # week holding 1 Jan has < 4 days
        first_monday += dt.timedelta(days=7)
        return (d - first_monday).days // 7 + 1 if d >= first_monday else 0
    return (d - first_monday).days // 7 + 1


def test_week_number_all_calendar_days(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(2922)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r["d"]: r["w"] for r in df.select("d", mysql_week_monday("d").alias("w")).collect()}
    assert all(got[d] == _week_mode1(d) for d in days)
    assert got[dt.date(2021, 1, 1)] == 0 and got[dt.date(2024, 12, 30)] == 53


def test_case_boundaries(spark):
    years = [None, 0, 1800, 1900, 1929, 1930, 1964, 1965, 1980, 1981, 1996, 1997, 2005, 2006, 2010, 2011, 2030]
    df = spark.createDataFrame([(y,) for y in years], "y int")
    got = [r[0] for r in df.select(age_group_of(F.col("y"))).collect()]
    assert got == ["Unknown"] * 5 + ["60+", "60+", "45-59", "45-59", "28-44", "28-44", "18-27", "18-27",
                                     "Under 18", "Under 18", "Unknown", "Unknown"]
    hours = spark.createDataFrame([(h,) for h in [5, 6, 11, 12, 17, 18, 22, 23, 0]], "h int")
    assert [r[0] for r in hours.select(day_period_of(F.col("h"))).collect()] == \
        ["night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night", "night"]
    days = spark.createDataFrame([(d,) for d in [None, 14, 15, 30, 31, 60, 61]], "d int")
    assert [r[0] for r in days.select(churn_risk_of(F.col("d"))).collect()] == \
        ["new", "low", "medium", "medium", "high", "high", "churned"]
    c = spark.createDataFrame([(x,) for x in ["USA", "GBR", "BRA", "JPN", "TUR", "AUS", None, "ZZZ"]], "c string")
    assert [r[0] for r in c.select(region_of(F.col("c"))).collect()] == \
        ["North America", "Europe", "South America", "Asia Pacific", "Middle East", "Oceania", "Other", "Other"]


def test_decimal_helpers(spark):
    df = spark.createDataFrame([(Decimal("2.50"), 0), (Decimal("1234567.50"), 3), (None, 1)],
                               "a decimal(12,2), b int")
    rows = df.select(money_label(F.col("a")).alias("m"), mysql_div(F.col("a"), F.col("b"), 2).alias("q"),
                     field_position(F.lit("x"), ["a", "x"]).alias("f"),
                     field_position(F.lit(None).cast("string"), ["a"]).alias("g")).collect()
    assert rows[0]["m"] == "$3" and rows[0]["q"] is None
    assert rows[1]["m"] == "$1,234,568" and rows[1]["q"] == Decimal("411522.500000")
    assert rows[2]["m"] is None and rows[0]["f"] == 2 and rows[0]["g"] == 0
