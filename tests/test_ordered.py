"""Block-wise ordered operators equal plain per-key windows, including a hot key spanning days."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from wxodds.operators.ordered import (
    lag_by_key, lead_by_key, range_frame_by_key, running_sums_by_key, scan_by_key,
)


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 20)}"
        ts = 1_704_067_200 + rnd.randint(0, 20 * 86400)
        rows.append((k, ts, i, rnd.randint(0, 1000)))
    return spark.createDataFrame(rows, "k string, s long, id long, v long") \
        .withColumn("ts", F.timestamp_seconds("s"))


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_lag_lead(spark):
    d = _data(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = d.withColumn("prev_v", F.lag("v").over(w)).withColumn("next_v", F.lead("v").over(w))
    got = lead_by_key(lag_by_key(d, ["k"], "ts", ["id"], ["v"]), ["k"], "ts", ["id"], ["v"])
    cols = ["k", "id", "prev_v", "next_v"]
    assert _rows(got, cols) == _rows(plain, cols)


def test_running_sums_and_scan(spark):
    d = _data(spark)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = (d.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("sv", F.sum("v").over(w))
             .withColumn("prev_v", F.lag("v").over(Window.partitionBy("k").orderBy("ts", "id"))))
    got = running_sums_by_key(d, ["k"], "ts", ["id"], {"n": F.lit(1).cast("long"), "sv": F.col("v")})
    assert _rows(got, ["k", "id", "n", "sv"]) == _rows(plain, ["k", "id", "n", "sv"])
    got2 = scan_by_key(d, ["k"], "ts", ["id"], {"n": F.lit(1).cast("long"), "sv": F.col("v")}, lags=["v"])
    assert _rows(got2, ["k", "id", "n", "sv", "prev_v"]) == _rows(plain, ["k", "id", "n", "sv", "prev_v"])


def test_range_frame(spark):
    d = _data(spark)
    for seconds in (3600, 7 * 86400):
        w = Window.partitionBy("k").orderBy(F.col("s")).rangeBetween(-seconds, 0)
        plain = d.withColumn("m", F.max("v").over(w)).withColumn("c", F.count(F.lit(1)).over(w))
        got = range_frame_by_key(d, ["k"], "ts", seconds, {"m": F.max("v"), "c": F.count(F.lit(1))})
        assert _rows(got, ["k", "id", "m", "c"]) == _rows(plain, ["k", "id", "m", "c"])
