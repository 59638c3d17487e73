import datetime as dt

from pyspark.sql import functions as F

from logloom import queries
from logloom.functions import formats as M

from .oracle import same

SF = "/root/testdata/sf0.001"
AT = 1136214245  # 2006-01-02 15:04:05 UTC


def detect(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", M.detect_timestamp(F.col("t")).alias("found"))
    return [r.found for r in rows.orderBy("k").collect()]


def test_the_nine_layouts_of_detected_times(spark):
    layouts = {
        "2006-01-02T15:04:05.999+08:00": AT - 8 * 3600, "2006-01-02 15:04:05": AT, "2006-01-02T15:04:05": AT, "02/Jan/2006:15:04:05": AT, "02/Jan/2006 15:04:05": AT,
        "02-Jan-2006:15:04:05": AT, "02-Jan-2006 15:04:05": AT, "2006/01/02 15:04:05": AT, "2006/01/02 - 15:04:05": AT,
    }
    assert detect(spark, list(layouts)) == list(layouts.values())


def test_what_detected_times_may_and_may_not_have(spark):
    good = {"2006-01-02T15:04:05-07:30": AT + 27000, "2006-01-02 15:04:05,25": AT, "02/jAN/2006  15:04:05.5": AT, "2006-01-02 5:04:05": AT - 36000, "31-Dec-1969 23:59:59": -1}
    bad = ["2006-01-02", "2006-01-02 15:04", "2006-01-02T15:04:05Z", "02/Jan/2006:15:04:05 +0000", "30/Feb/2006 15:04:05", "02/Anf/2006 15:04:05", "2006-01-02 24:00:00", "2006-01-02 15:04:05\n", "", None, "999999999", "1000000000", "1000000000000"]
    assert detect(spark, list(good)) == list(good.values()) and detect(spark, bad) == [0] * len(bad)


def test_detected_times_of_all_orders(spark):
    """Without the query's filter, which no order of the tables passes: seconds below the limit are no time, layouts are."""
    at = F.col("o_orderdate").cast("timestamp")
    orders = spark.read.parquet(f"{SF}/orders.parquet").select(F.unix_seconds(at).alias("s"), F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("t"))
    texts = [M.detect_timestamp(c).alias(n) for n, c in {"sec": F.col("s").cast("string"), "milli": F.concat("s", F.lit("000")), "text": F.col("t")}.items()]
    rows = orders.select("s", *texts).collect()
    assert rows and all((r.sec, r.milli, r.text) == ((r.s, r.s) if r.s > 1e9 else (0, 0)) + (r.s,) for r in rows)


def test_the_query_on_orders_that_pass_its_filter(spark, tmp_path):
    """The query and its SQL over later orders, so that rows of all four kinds are compared."""
    days = [(k, dt.datetime(2001, 9, 9, 2) + dt.timedelta(days=97 * k, seconds=k)) for k in range(40)]
    spark.createDataFrame(days, "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(str(tmp_path / "orders.parquet"))
    same(queries.QUERIES["detect_timestamps"], queries.ORACLE_SQL["detect_timestamps"], spark, str(tmp_path))
    assert queries.detect_timestamps(spark, str(tmp_path)).where("found > 0").count() == 30
