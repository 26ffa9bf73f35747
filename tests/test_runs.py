import os

from tessera.plans import runs as RU

LOG = """Main started at 09:24:55
Spark session created
Number of rows in train split: 7151
Number of rows in test split: 3662
Pipeline created
Fit pipeline started at 09:25:10
Runtime of task Fit pipeline: 03:15:51
Runtime of task Test inference: 00:00:00
Evaluation done: Accuracy: 0.4056877732212153
Runtime of task Evaluation: 00:43:18
Runtime of task Main: 03:59:25"""


def test_hms():
    assert RU.hms(3 * 3600 + 15 * 60 + 51.9) == "03:15:51" and RU.hms(90000) == "25:00:00"


def test_parse_run_log(spark, tmp_path):
    d = tmp_path / "logs"
    d.mkdir()
    (d / "run_a.log").write_text(LOG)
    (d / "run_b.log").write_text(LOG.replace("03:15:51", "01:00:00"))
    out = {r["run"]: r for r in RU.parse_run_log(RU.read_run_logs(spark, str(d))).collect()}
    a = out["run_a"]
    assert (a["train_rows"], a["test_rows"]) == (7151, 3662)
    assert a["fit_seconds"] == 3 * 3600 + 15 * 60 + 51 and a["evaluation_seconds"] == 43 * 60 + 18
    assert a["main_seconds"] == 3 * 3600 + 59 * 60 + 25 and abs(a["accuracy"] - 0.4056877732) < 1e-9
    assert out["run_b"]["fit_seconds"] == 3600


def test_stage_timer(spark):
    t = RU.StageTimer("r1")
    with t.stage("fit"):
        pass
    df = t.frame(spark).collect()
    assert df[0]["task"] == "fit" and df[0]["seconds"] == 0


def test_run_summary(spark):
    h = spark.createDataFrame([("r", "2024-01-01 00:00:00", 1.0), ("r", "2024-01-01 01:02:03.9", 0.5)],
                              "run string, started string, loss double")
    r = RU.run_summary(h).collect()[0]
    assert (r["n_epochs"], r["seconds"], r["runtime"], r["min_loss"]) == (2, 3723, "01:02:03", 0.5)


def test_partition_report(spark):
    r = RU.partition_report(spark.range(100).repartition(4)).collect()
    assert len(r) == 4 and sum(x["rows"] for x in r) == 100


def test_run_summary_ntz_is_zone_independent(spark):
    h = spark.createDataFrame([("r", 1.0), ("r", 0.5)], "run string, loss double").withColumn(
        "started", __import__("pyspark.sql.functions", fromlist=["x"]).expr(
            "CASE WHEN loss = 1.0 THEN TIMESTAMP_NTZ'2024-01-01 00:00:00' ELSE TIMESTAMP_NTZ'2024-03-10 02:30:00' END"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = RU.run_summary(h).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["finished"] == "02:30:00" and r["seconds"] == 5974200


def test_speed_ups(spark):
    from tessera.plans.runs import speed_ups
    summary = spark.createDataFrame([("one", 90), ("three", 30), ("none", 0)], "run string, seconds long")
    assert {r["run"]: r["speed_up"] for r in speed_ups(summary, "one").collect()} == {"one": 1.0, "three": 3.0, "none": None}
    assert {r["speed_up"] for r in speed_ups(summary, "other").collect()} == {None}
