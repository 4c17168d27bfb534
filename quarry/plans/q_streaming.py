"""Registered queries: Structured Streaming.

Each query stages its input from a driver table into a landing folder (one
partitioned write), runs the stream with ``availableNow`` and a checkpoint under the
shared folder, then returns the sink read back as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.sampling import hash_split_sql
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.streaming import joins, model_store, online, timed
from quarry.streaming.sources import (
    file_stream,
    run_data_batches,
    run_foreach_batch,
    run_to_sink,
    stage_batches,
)
from quarry.tables import read_table

# Activity codes of the event types, the missing-reading marker rule,
# the scoring weights, the test share of the per-batch split and its seed.
ACTIVITY_CODES = {"click": "1", "view": "2", "purchase": "4", "signup": "5", "error": "0"}
MISSING_K_FROM = 95
SCORE_WEIGHTS = (0.01, 0.005, -0.02, 0.03)
TEST_FRACTION, SPLIT_SEED = 0.3, 3
#: a click is taken away by a purchase of the same user at most so far off
SUBTRACT_WITHIN = "2 hours"
END_OF_STREAM = "2100-01-01 00:00:00"
LATER_WEIGHTS = (0.02, -0.004, 0.01, 0.05)
UNCOMMITTED_WEIGHTS = (9.0, 9.0, 9.0, 9.0)
BATCH_INTERVAL = "2 seconds"


def _batch_of(ts):
    # four data batches by day of month (days 1-8, 9-16, 17-24, 25-31)
    return F.floor((F.dayofmonth(ts) - 1) / 8).cast("int")


def _activity_lines(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    code = F.lit("0")
    for et, c in ACTIVITY_CODES.items():
        code = F.when(F.col("event_type") == et, F.lit(c)).otherwise(code)
    k = F.get_json_object("props", "$.k")
    reading = F.when(k.cast("int") >= MISSING_K_FROM, F.lit("Nan")).otherwise(F.col("value").cast("string"))
    line = F.concat_ws(" ", F.col("event_id").cast("string"), code, F.col("user_id").cast("string"),
                       "event_type", reading, k, F.hour("ts").cast("string"))
    return ev.select(line.alias("value"), _batch_of(F.col("ts")).alias("batch"))


def _activity_stream(spark, sf_dir, name):
    landing = scratch_path(spark, f"{name}-landing")
    schema = stage_batches(_activity_lines(spark, sf_dir), landing, "batch", fmt="text")
    lines = file_stream(spark, landing, schema, fmt="text")
    return online.activity_cleanse(lines, keep=["batch"])


_ACTIVITY_SQL = f"""
with e as (select event_id,
                  case event_type when 'click' then 1 when 'view' then 2 when 'purchase' then 4
                                  when 'signup' then 5 else 0 end as code,
                  user_id, value, cast(json_extract_string(props, '$.k') as integer) as k, hour(ts) as h,
                  cast(floor((day(ts) - 1) / 8) as integer) as batch
           from events),
a as (select event_id, case when code = 4 then 0.0 else 1.0 end as label, cast(user_id as double) as x1,
             value as x2, cast(k as double) as x3, cast(h as double) as x4, batch
      from e where k < {MISSING_K_FROM} and code in (4, 5))"""


@query(
    "stream_etl",
    "R01 R02 R03 R12 R13 F08 B7 S15 S16",
    _ACTIVITY_SQL + " select event_id, label, x1, x2, x3, x4 from a",
)
def q_stream_etl(spark, sf_dir):
    stream = _activity_stream(spark, sf_dir, "etl").withColumnRenamed("key", "event_id").drop("batch")
    sink, ck = scratch_path(spark, "etl-sink"), scratch_path(spark, "etl-ck")
    run_to_sink(stream, sink, ck)
    return spark.read.parquet(sink)


@query(
    "stream_split",
    "R04 R05 U03 N01",
    _ACTIVITY_SQL
    + f" select event_id, case when {hash_split_sql('event_id', SPLIT_SEED, TEST_FRACTION)} then 'test' "
    "else 'train' end as part from a",
)
def q_stream_split(spark, sf_dir):
    stream = _activity_stream(spark, sf_dir, "split").withColumnRenamed("key", "event_id").drop("batch")
    sink, ck = scratch_path(spark, "split-sink"), scratch_path(spark, "split-ck")

    def per_batch(batch, batch_id):
        parts = online.split_test_train(batch, "event_id", SPLIT_SEED, TEST_FRACTION)
        parts.select("event_id", "part").write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    run_foreach_batch(stream, per_batch, ck)
    return spark.read.parquet(sink).select("event_id", "part")


def _score_sql_expr() -> str:
    m = "0.0" + "".join(f" + x{i} * {w}" for i, w in enumerate(SCORE_WEIGHTS, start=1))
    return f"1.0 / (1.0 + exp(-({m})))"


@query(
    "stream_score",
    "R08",
    _ACTIVITY_SQL + f" select event_id, label, round({_score_sql_expr()}, 6) as prediction from a",
    check="T",
)
def q_stream_score(spark, sf_dir):
    from quarry.operators.sgd import predict

    stream = _activity_stream(spark, sf_dir, "score")
    feats = ["x1", "x2", "x3", "x4"]
    scored = stream.select(
        F.col("key").alias("event_id"), "label", F.round(predict(feats, SCORE_WEIGHTS, "logistic"), 6).alias("prediction")
    )
    sink, ck = scratch_path(spark, "score-sink"), scratch_path(spark, "score-ck")
    run_to_sink(scored, sink, ck)
    return spark.read.parquet(sink)


@query(
    "stream_batch_mse",
    "R09 V10 A19",
    _ACTIVITY_SQL
    + f""" select batch, count(*) as n, round(avg(pow({_score_sql_expr()} - label, 2)), 6) as mse
           from a group by batch""",
    check="T",
)
def q_stream_batch_mse(spark, sf_dir):
    from quarry.operators.sgd import predict

    stream = _activity_stream(spark, sf_dir, "mse")
    err = predict(["x1", "x2", "x3", "x4"], SCORE_WEIGHTS, "logistic") - F.col("label")
    sink, ck = scratch_path(spark, "mse-sink"), scratch_path(spark, "mse-ck")

    def per_batch(batch, batch_id):
        # partial sums per data batch; a data batch may span micro-batches
        part = batch.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("sse"))
        part.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    run_foreach_batch(stream, per_batch, ck)
    parts = spark.read.parquet(sink)
    return parts.groupBy("batch").agg(
        F.sum("n").alias("n"), F.round(F.sum("sse") / F.sum("n"), 6).alias("mse")
    )


@query(
    "stream_enrich",
    "R10 J08",
    "select event_id, c_mktsegment, value from events join customer on user_id = c_custkey",
)
def q_stream_enrich(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "value", _batch_of(F.col("ts")).alias("batch"))
    landing = scratch_path(spark, "enrich-landing")
    schema = stage_batches(ev, landing, "batch")
    stream = file_stream(spark, landing, schema)
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    enriched = stream.join(cust, stream.user_id == cust.c_custkey).select("event_id", "c_mktsegment", "value")
    sink, ck = scratch_path(spark, "enrich-sink"), scratch_path(spark, "enrich-ck")
    run_to_sink(enriched, sink, ck)
    return spark.read.parquet(sink)


def _weights_table(spark, learner):
    w = spark.read.parquet(learner.weights_path)
    m = spark.read.parquet(learner.metrics_path).select("batch_id", "mse")
    return w.join(m, "batch_id").select(
        "batch_id", "n", F.round("mse", 6).alias("mse_before"),
        *[F.get("weights", i).alias(f"w_{f}") for i, f in enumerate(learner.features)],
    )


@query("stream_logistic", "R06 R08 R09")
def q_stream_logistic(spark, sf_dir):
    def build(lines):
        return online.activity_cleanse(lines).select(
            "key", "label", (F.col("x1") / 150).alias("s1"), (F.col("x2") / 500).alias("s2"),
            (F.col("x3") / 100).alias("s3"), (F.col("x4") / 24).alias("s4"),
        )

    learner = online.OnlineSGD(scratch_path(spark, "logistic-store"), ["s1", "s2", "s3", "s4"], "label", "key",
                               loss="logistic", step=0.5, iterations=15, fraction=0.25, seed=7)
    landing, ck = scratch_path(spark, "logistic-landing"), scratch_path(spark, "logistic-ck")
    run_data_batches(_activity_lines(spark, sf_dir), "batch", landing, build, learner, ck, fmt="text")
    return _weights_table(spark, learner)


@query("stream_linear", "R07 R08 R09 B6")
def q_stream_linear(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    df = li.select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("key"),
        (F.col("l_extendedprice") / 100000).alias("label"),
        (F.col("l_quantity") / 50).alias("q"), (F.col("l_discount") * 10).alias("d"), (F.col("l_tax") * 10).alias("t"),
        F.floor((F.month("l_shipdate") - 1) / 3).cast("int").alias("batch"),
    )
    learner = online.OnlineSGD(scratch_path(spark, "linear-store"), ["q", "d", "t"], "label", "key",
                               loss="linear", step=0.1, iterations=25, fraction=0.25, seed=11)
    landing, ck = scratch_path(spark, "linear-landing"), scratch_path(spark, "linear-ck")
    run_data_batches(df, "batch", landing, lambda s: s, learner, ck)
    return _weights_table(spark, learner)


@query(
    "stream_subtract",
    "R05 R01",
    """select l.event_id, l.user_id, l.ts from events l where l.event_type = 'click' and not exists (
         select 1 from events r where r.event_type = 'purchase' and r.user_id is not distinct from l.user_id
           and r.ts between l.ts - interval 2 hours and l.ts + interval 2 hours)""",
)
def q_stream_subtract(spark, sf_dir):
    """Clicks without a purchase nearby: one stream less another, over two runs on one
    checkpoint; the second run finds the later half of both streams and their end."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", _batch_of(F.col("ts")).alias("batch"))
    clicks, purchases = (ev.where(F.col("event_type") == t).drop("event_type") for t in ("click", "purchase"))
    folders = [scratch_path(spark, f"subtract-{side}") for side in ("left", "right")]
    sink, ck = scratch_path(spark, "subtract-sink"), scratch_path(spark, "subtract-ck")
    for later in (False, True):
        for df, folder in zip((clicks, purchases), folders, strict=True):
            part = df.where((F.col("batch") >= 2) == later)
            if later:
                part = part.unionByName(joins.closing_row(df, "ts", END_OF_STREAM).withColumn("batch", F.lit(9)))
            part.write.mode("append").partitionBy("batch").parquet(folder)
        left, right = (file_stream(spark, folder, clicks.schema) for folder in folders)
        rest = joins.subtract_streams(left, right, ["user_id"], "ts", SUBTRACT_WITHIN)
        run_to_sink(rest, sink, ck)
    return spark.read.parquet(sink).where("event_id is not null").select("event_id", "user_id", "ts")


def _latest_sql() -> str:
    later = "0.0" + "".join(f" + x{i} * {w}" for i, w in enumerate(LATER_WEIGHTS, start=1))
    return (
        _ACTIVITY_SQL
        + f""" select event_id, case when batch = 0 then 1 else 2 end as version,
  round(case when batch = 0 then {_score_sql_expr()} else 1.0 / (1.0 + exp(-({later}))) end, 6) as prediction from a"""
    )


@query("stream_latest_weights", "R08 K02", _latest_sql(), check="T")
def q_stream_latest_weights(spark, sf_dir):
    """A scoring stream beside a writer of weights: it takes up the version that is committed
    when a micro-batch begins, and never one that is only written."""
    store = model_store.ModelStore(spark, scratch_path(spark, "latest-model"))
    store.save(1, SCORE_WEIGHTS)
    sink = scratch_path(spark, "latest-sink")
    score = model_store.score_stream(store, ["x1", "x2", "x3", "x4"], ["key"], sink)

    def learn_then_score(batch, batch_id):
        if batch_id == 1:  # the learner has got on meanwhile
            store.save(2, LATER_WEIGHTS)
            store.write(3, UNCOMMITTED_WEIGHTS)
        score(batch, batch_id)

    landing, ck = scratch_path(spark, "latest-landing"), scratch_path(spark, "latest-ck")
    run_data_batches(_activity_lines(spark, sf_dir), "batch", landing, online.activity_cleanse, learn_then_score, ck, fmt="text")
    return spark.read.parquet(sink).select(F.col("key").alias("event_id"), "version", F.round("prediction", 6).alias("prediction"))


@query(
    "stream_timed",
    "R12 R13",
    _ACTIVITY_SQL + " select event_id, label, x1, x2, x3, x4 from a",
)
def q_stream_timed(spark, sf_dir):
    """The cleansed activity of a stream that is triggered every two seconds and stopped after
    two triggers that found nothing."""
    stream = _activity_stream(spark, sf_dir, "timed").withColumnRenamed("key", "event_id").drop("batch")
    sink, ck = scratch_path(spark, "timed-sink"), scratch_path(spark, "timed-ck")
    timed.run_timed(timed.sink_writer(stream, sink, ck), BATCH_INTERVAL, quiet=2)
    return spark.read.parquet(sink)
