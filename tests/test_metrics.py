from tideline.operators.metrics import alerts, histogram, outcome_class


def test_histogram(spark):
    df = spark.createDataFrame([("m", v) for v in (0.05, 0.051, 0.3, 31.0)], "method string, v double")
    rows = histogram(df, "v", ["method"], (0.05, 0.1, 0.5, 30)).collect()
    assert [(r.le, r.cumulative) for r in rows] == [("0.05", 1), ("0.1", 2), ("0.5", 3), ("30", 3), ("+Inf", 4)]
    assert {r["count"] for r in rows} == {4} and abs(rows[0]["sum"] - 31.401) < 1e-9


def test_histogram_without_labels_or_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert [(r.le, r.cumulative) for r in histogram(df, "v", [], (1,)).collect()] == [("1", 0), ("+Inf", 0)]


def test_outcome_classes(spark):
    codes = {200: "ok", 299: "ok", 401: "reauth", 429: "wait", 500: "retry", 503: "retry", 404: "fatal", 302: "fatal", 100: "fatal"}
    df = spark.createDataFrame([(c,) for c in codes], "code int")
    assert {r.code: r["class"] for r in df.select("code", outcome_class("code").alias("class")).collect()} == codes


def test_alerts(spark):
    lag = spark.createDataFrame([("slow", 301), ("fine", 300)], "table string, lag_seconds bigint")
    dead = spark.createDataFrame([("t",), ("t",)], "topic string")
    calls = spark.createDataFrame(
        [("bad", 200)] * 98 + [("bad", 500)] * 2 + [("good", 200)] * 99 + [("good", 500)], "endpoint string, status_code int"
    )
    assert sorted((r.alert, r.subject, r.value) for r in alerts(lag, dead, calls).collect()) == [
        ("dead_letters", "t", 2),
        ("error_rate", "bad", 2),
        ("lag", "slow", 301),
    ]
