"""Benchmark: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints one JSON line.

Each query runs once as a warm-up, then 3 timed runs into the ``noop`` sink; the
median is reported.  ``value`` is the sum of the medians of the Spark-first
whole group, one job per statistic) on the same data, for comparison only.
"""

from __future__ import annotations

import json
import math
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from quarry.operators import sgd  # noqa: E402
from quarry.plans import q_evaluate, q_topn  # noqa: E402
from quarry.plans.registry import all_queries  # noqa: E402
from quarry.session import clear_scratch, local_session  # noqa: E402
from quarry.tables import read_table  # noqa: E402

HEADLINE = [
    "top_n_within_group",
    "top_n_within_group_salted",
    "word_count",
    "word_count_filtered",
    "anomaly_scores",
    "dictionary_substitute",
    "join_inner",
    "tf_idf",
    "window_relative",
    "roc_curve",
    "drop_duplicates",
    "describe_typed",
    "stream_batch_mse",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(build, repeats: int = 3) -> float:
    _run(build())  # warm-up (also plans and caches file listings)
    times = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        _run(build())
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def _naive_forms(spark, sf):
    li = read_table(spark, sf, "lineitem")
    docs = read_table(spark, sf, "documents")

    dictionary = q_evaluate._dictionary(spark, sf)
    events = read_table(spark, sf, "events").select(
        (F.col("event_type") == "purchase").cast("double").alias("y"),
        (F.col("value") / 100).alias("x1"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("x2"),
    )

    def top_n_collect():
        # the same exact sums as the library's query, then whole groups as lists
        rev = q_topn.supplier_part_revenue(spark, sf)
        grouped = rev.groupBy("l_suppkey").agg(F.collect_list(F.struct(F.col("revenue"), F.col("l_partkey"))).alias("all"))
        return grouped.select("l_suppkey", F.slice(F.sort_array("all", asc=False), 1, 3).alias("top"))

    def word_count_collect():
        words = docs.select(F.explode(F.split(F.lower("text"), "[ \n]")).alias("w")).where(F.length("w") > 0)
        return words.groupBy("w").agg(F.size(F.collect_list("w")).alias("n"))

    def moments_one_job_each():
        # one job per statistic (the driver collects each), the threshold as another, then flags
        cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        stats = {c: (li.agg(F.avg(c)).first()[0], li.agg(F.stddev_pop(c)).first()[0]) for c in cols}
        z = li.select("*", *[((F.col(c) - stats[c][0]) / stats[c][1]).alias(f"z_{c}") for c in cols])
        scored = z.withColumn("distance", sum(F.pow(F.col(f"z_{c}"), 2) for c in cols))
        threshold = scored.orderBy(F.desc("distance")).limit(q_evaluate.ANOMALY_K).agg(F.min("distance")).first()[0]
        return scored.drop(*[f"z_{c}" for c in cols]).withColumn("is_anomaly", F.col("distance") >= threshold)

    def dictionary_python_function():
        # the dictionary as a driver map, looked up by a row-at-a-time Python function
        of = {}
        for r in dictionary.orderBy("entry_order").collect():
            of.setdefault(r.word, r.canonical)

        @F.udf("string")
        def substitute(tokens):
            kept = [of.get(w, w) for w in tokens or [] if w in of or not w.isdigit()]
            return "#" + "#".join(kept) if kept else ""

        toks = F.regexp_extract_all(F.lower("text"), F.lit(q_evaluate._TOKEN), 0)
        return docs.select("doc_id", substitute(toks).alias("substituted"))

    def sgd_rdd_step():
        # one gradient step over rows of an RDD
        def gradient(rows):
            n = g1 = g2 = 0.0
            for r in rows:
                err = 1 / (1 + math.exp(-(0.1 * r.x1 + 0.1 * r.x2))) - r.y
                n, g1, g2 = n + 1, g1 + err * r.x1, g2 + err * r.x2
            yield n, g1, g2

        total = events.rdd.mapPartitions(gradient).reduce(lambda a, b: tuple(x + y for x, y in zip(a, b)))
        return spark.createDataFrame([total], "n double, g1 double, g2 double")

    return {
        "top_n_within_group": top_n_collect,
        "word_count": word_count_collect,
        "anomaly_scores": moments_one_job_each,
        "dictionary_substitute": dictionary_python_function,
        "sgd_step": sgd_rdd_step,
    }


def _sgd_step(spark, sf):
    """One native gradient step, timed beside the RDD form."""
    events = read_table(spark, sf, "events").select(
        (F.col("event_type") == "purchase").cast("double").alias("y"),
        (F.col("value") / 100).alias("x1"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("x2"),
    )
    w = sgd.sgd_steps(events, ["x1", "x2"], "y", [0.1, 0.1], 1, 1.0)[-1]
    return spark.createDataFrame([tuple(w)], "w1 double, w2 double")


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    specs = all_queries()
    results = {name: _time(lambda n=name: specs[n].build(spark, sf)) for name in HEADLINE}
    results["sgd_step"] = _time(lambda: _sgd_step(spark, sf))
    naive = {f"{k}_naive": _time(v) for k, v in _naive_forms(spark, sf).items()}
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "naive": naive,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
    }
    print(json.dumps(out))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
