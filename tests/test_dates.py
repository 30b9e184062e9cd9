import datetime

from pyspark.sql import functions as F

from jobmart.functions.dates import date_key, posted_date
from jobmart.operators import star
from tests.test_text import check

MOMENT = "2026-05-21 02:00:00"


def moment():
    return F.lit(MOMENT).cast("timestamp")


def test_posted_date(spark):
    check(spark, {
        "2026-05-01": "01-05-2026", "2026-5-1": "01-05-2026", "1-5-2026": "01-05-2026", "01/05/2026": "01-05-2026",
        "2026/5/1": "01-05-2026", "2026 05 01": "01-05-2026", "2026-05-01T10:00:00Z": "01-05-2026",
        "2026-05-01 10:00:00": "01-05-2026", " 2026-05-01 ": "01-05-2026", "26-05-01": "01-05-0026",
        # not understood: the processing day
        "2026": "21-05-2026", "2026-05": "21-05-2026", "31-02-2026": "21-05-2026", "2 months ago": "21-05-2026",
        "2026-05-01 x": "21-05-2026", "": "21-05-2026", None: "21-05-2026", "soon": "21-05-2026",
        # relative
        "5 minutes ago": "21-05-2026", "130 mins ago": "20-05-2026", "3 hours ago": "20-05-2026",
        "1 giờ trước": "21-05-2026", "posted 2 days ago": "19-05-2026", "đăng 2 ngày trước": "19-05-2026",
        "30+ days ago": "21-04-2026", "1 week ago": "14-05-2026", "2 tuần trước": "07-05-2026",
        "yesterday": "20-05-2026", "hôm qua": "20-05-2026", "hôm nay": "21-05-2026", "today": "21-05-2026",
    }, lambda v: posted_date(v, moment()))


def test_amounts_beyond_int_give_null_as_the_subtraction_does(spark):
    check(spark, {"99999999999 days ago": None}, lambda v: posted_date(v, moment()))


def test_calendar(spark):
    rows = star.dim_date(star.date_bounds(spark, "2026-04-21", 365)).orderBy("id").collect()
    assert len(rows) == 365
    assert rows[0].asDict() == {
        "id": "20260421", "full_date": datetime.date(2026, 4, 21), "day_of_week": "Tuesday", "month": 4,
        "quarter": 2, "year": 2026,
    }
    assert rows[-1]["id"] == "20270420"


def test_calendar_starts_thirty_days_ago(spark):
    first = star.dim_date(star.date_bounds(spark, days=2)).agg(F.min("full_date"), F.count("id")).first()
    today = spark.range(1).select(F.current_date()).first()[0]
    assert (today - first[0]).days == 30 and first[1] == 2


def test_date_key(spark):
    assert spark.range(1).select(date_key(moment())).first()[0] == "20260521"
