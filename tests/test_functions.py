"""Scalar functions: P1-P5, P8-P11 edge rows (FIXTURES §3)."""

from pyspark.sql import functions as F

from marketpulse.functions import labels as P


def _one_col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_direction_and_trend_on_zero_and_null(spark):
    vals = [-1.0, 0.0, 1.0, None]
    assert _one_col(spark, vals, "double", P.direction) == ["drop", None, "rise", None]
    assert _one_col(spark, vals, "double", P.trend) == ["down", "up", "up", "down"]


def test_threshold_hit_inclusive_and_default(spark):
    rows = [(-2.5, 2.5, "drop"), (2.5, 2.5, "rise"), (-2.0, None, "drop"), (2.0, None, "rise"),
            (-1.9, None, "drop"), (1.0, 2.5, "rise")]
    df = spark.createDataFrame(rows, "c double, t double, d string")
    got = [r[0] for r in df.select(P.threshold_hit("c", P.effective_threshold("t"), "d")).collect()]
    assert got == [True, True, True, True, False, False]


def test_sentiment_label_bounds(spark):
    vals = [0.1, -0.1, 0.100001, -0.100001, 0.0]
    assert _one_col(spark, vals, "double", P.sentiment_label) == [
        "neutral", "neutral", "positive", "negative", "neutral"]


def test_number_labels_half_even_and_names(spark):
    assert _one_col(spark, [0.125], "double", P.change_label) == ["0.12%"]
    assert _one_col(spark, [1234.56789], "double", P.price_label) == ["$1,234.5679"]
    assert _one_col(spark, [12_345_678_901], "long", P.volume_label) == ["$12.35B"]
    assert _one_col(spark, ["shiba inu", "BITCOIN"], "string", P.display_name) == ["Shiba inu", "Bitcoin"]


def test_describe_subscription(spark):
    df = spark.createDataFrame([("drop", 2.5), ("rise", 10.0)], "d string, t double")
    got = [r[0] for r in df.select(P.describe_subscription("d", "t")).collect()]
    assert got == ["Drops by 2.5%", "Rises by 10.0%"]


def test_alert_text(spark):
    df = spark.createDataFrame([("bitcoin", "drop", -3.456, 1234.5, 2.0)], "c string, d string, x double, p double, t double")
    r = df.select(P.alert_subject("c", "d", "x").alias("s"), P.alert_body("c", "d", "x", "p", "t").alias("b")).first()
    assert r["s"] == "Price alert: Bitcoin dropped 3.46%"
    assert "Bitcoin has dropped 3.46%" in r["b"] and "$1,234.5000" in r["b"] and "threshold: 2.0%" in r["b"]


def test_cluster_settings_scale_with_input():
    from marketpulse.session import cluster_settings
    big = cluster_settings(100 * 10**12, 8, 1000)
    assert int(big["spark.sql.shuffle.partitions"]) >= 100 * 10**12 // (256 << 20)
    small = cluster_settings(10**9, 4, 2)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_label_and_render_frames(spark):
    from marketpulse.operators.alerts import render_alert
    from marketpulse.operators.snapshot import labels
    from marketpulse.operators.subscriptions import valid_command
    df = spark.createDataFrame([("bitcoin", 1234.5, -0.125, 2_500_000_000)],
                               "id string, current_price double, price_change_pct_24h double, total_volume long")
    r = labels(df).first()
    assert (r["name"], r["price_label"], r["change_label"], r["volume_label"]) == (
        "Bitcoin", "$1,234.5000", "-0.12%", "$2.50B")
    a = spark.createDataFrame([("e@x", "bitcoin", "rise", 5.0, 10.0, 2.0)],
                              "email string, coin string, direction string, change double, price double, threshold double")
    assert render_alert(a).first()["subject"] == "Price alert: Bitcoin surged 5.00%"
    ok, bad = valid_command(spark.createDataFrame([("e@x", 1.0), ("ex", 1.0)], "email string, threshold double"))
    assert ok.count() == 1 and bad.count() == 1
