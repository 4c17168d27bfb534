"""Registered queries: evaluation metrics on fixed-formula scores, anomaly scoring,
dictionary substitution."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import anomaly, evaluate, text
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import sinks
from quarry.tables import read_table

# The score formula, decision threshold and anomaly depth.
SCORE_SQL = "round(l_discount * 10 + l_tax * 5, 6) + 0.0"
DECISION = 0.6
ANOMALY_K = 2000
ANOMALY_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _scored(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    score = F.round(F.col("l_discount") * 10 + F.col("l_tax") * 5, 6) + F.lit(0.0)
    label = (F.col("l_returnflag") == "R").cast("int")
    return li.select(score.alias("score"), label.alias("label"))


_CURVE_SQL = f"""
with s as (select {SCORE_SQL} as score, case when l_returnflag = 'R' then 1 else 0 end as label from lineitem),
g as (select score as threshold, sum(label)::bigint as pos, sum(1 - label)::bigint as neg from s group by score),
c as (select threshold, pos, neg,
             sum(pos) over (order by threshold desc rows between unbounded preceding and current row)::bigint as tp,
             sum(neg) over (order by threshold desc rows between unbounded preceding and current row)::bigint as fp
      from g),
t as (select sum(pos)::bigint as p_all, sum(neg)::bigint as n_all from g)"""


@query(
    "roc_curve",
    "V02",
    _CURVE_SQL + """
select threshold, tp, fp, round(tp / p_all, 6) as tpr, round(fp / n_all, 6) as fpr from c, t
union all select null, 0, 0, 0.0, 0.0
union all select null, p_all, n_all, 1.0, 1.0 from t""",
    check="T",
)
def q_roc_curve(spark, sf_dir):
    c = evaluate.roc_curve(_scored(spark, sf_dir), "score", "label")
    return c.select("threshold", "tp", "fp", F.round("tpr", 6).alias("tpr"), F.round("fpr", 6).alias("fpr"))


@query(
    "pr_curve",
    "V04",
    _CURVE_SQL + """
select threshold, round(tp / (tp + fp), 6) as precision, round(tp / p_all, 6) as recall from c, t""",
    check="T",
)
def q_pr_curve(spark, sf_dir):
    c = evaluate.binary_curve(_scored(spark, sf_dir), "score", "label")
    return c.select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query(
    "auc",
    "V03 V12",
    _CURVE_SQL + """
select round(sum(pos * ((n_all - fp) + neg * 0.5)) / (p_all * n_all), 6) as auc from c, t group by p_all, n_all""",
    check="T",
)
def q_auc(spark, sf_dir):
    a = evaluate.area_under_roc(_scored(spark, sf_dir), "score", "label")
    return a.select(F.round("auc", 6).alias("auc"))


@query(
    "best_threshold",
    "V11",
    _CURVE_SQL + """,
f as (select threshold, 2 * (tp / (tp + fp)) * (tp / p_all) / ((tp / (tp + fp)) + (tp / p_all)) as f1 from c, t)
select threshold, round(f1, 6) as f1 from f where f1 is not null order by f1 desc, threshold desc limit 1""",
    check="T",
)
def q_best_threshold(spark, sf_dir):
    b = evaluate.best_f1_threshold(_scored(spark, sf_dir), "score", "label")
    return b.select("threshold", F.round("f1", 6).alias("f1"))


def _predicted(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.withColumn("prediction", (F.col("score") >= DECISION).cast("int"))


_PRED_SQL = f"""with s as (select label, case when score >= {DECISION} then 1 else 0 end as prediction from (
  select {SCORE_SQL} as score, case when l_returnflag = 'R' then 1 else 0 end as label from lineitem))"""


@query(
    "confusion_counts",
    "V05 F09",
    _PRED_SQL + """
select count(*) filter (where label = 1 and prediction = 1) as tp,
       count(*) filter (where label = 0 and prediction = 1) as fp,
       count(*) filter (where label = 0 and prediction = 0) as tn,
       count(*) filter (where label = 1 and prediction = 0) as fn,
       count(*) as total,
       count(*) filter (where label = prediction) as correct,
       count(*) filter (where label <> prediction) as wrong,
       count(*) filter (where label is null or prediction is null) as missing,
       round(count(*) filter (where label <> prediction) / count(*), 6) as wrong_ratio
from s""",
    check="T",
)
def q_confusion_counts(spark, sf_dir):
    c = evaluate.confusion_counts(_predicted(spark, sf_dir), "label", "prediction")
    return c.withColumn("wrong_ratio", F.round("wrong_ratio", 6))


@query(
    "accuracy",
    "V06 V07",
    _PRED_SQL + " select round(avg(case when label = prediction then 1.0 else 0.0 end), 6) as accuracy from s",
    check="T",
)
def q_accuracy(spark, sf_dir):
    a = evaluate.accuracy(_predicted(spark, sf_dir), "label", "prediction")
    return a.select(F.round("accuracy", 6).alias("accuracy"))


@query(
    "evaluation_nulls",
    "V02 V03 V05 V07",
    f"""
with r as (select case when l_tax = 0.08 then null else {SCORE_SQL} end as score,
                  case when l_linenumber = 7 then null when l_returnflag = 'R' then 1 else 0 end as label from lineitem),
s as (select * from r where score is not null and label is not null),
g as (select score, sum(label)::bigint as pos, sum(1 - label)::bigint as neg from s group by score),
c as (select *, sum(neg) over (order by score desc)::bigint as fp from g),
t as (select sum(pos)::bigint as p_all, sum(neg)::bigint as n_all, count(*) as points from g)
select (select round(sum(pos * ((n_all - fp) + neg * 0.5)) / any_value(p_all * n_all), 6) from c, t) as auc,
       (select points + 2 from t) as roc_points,
       (select count(*) from s) as total,
       (select count(*) from s where label = (score >= {DECISION})::integer) as correct,
       (select count(*) from r where score is null or label is null) as missing,
       (select round(avg((label = (score >= {DECISION})::integer)::integer), 6) from s) as accuracy""",
    check="T",
)
def q_evaluation_nulls(spark, sf_dir):
    """Rows without a score or a label count in no metric."""
    li = read_table(spark, sf_dir, "lineitem")
    score = F.round(F.col("l_discount") * 10 + F.col("l_tax") * 5, 6) + F.lit(0.0)
    label = F.when(F.col("l_linenumber") != 7, (F.col("l_returnflag") == "R").cast("int"))
    s = li.select(F.when(F.col("l_tax") != 0.08, score).alias("score"), label.alias("label"))
    p = s.withColumn("prediction", (F.col("score") >= DECISION).cast("int"))
    counts = evaluate.confusion_counts(p, "label", "prediction")
    return counts.select(
        evaluate.area_under_roc(s, "score", "label").select(F.round("auc", 6)).scalar().alias("auc"),
        evaluate.roc_curve(s, "score", "label").select(F.count(F.lit(1))).scalar().alias("roc_points"),
        "total",
        "correct",
        "missing",
        evaluate.accuracy(p, "label", "prediction").select(F.round("accuracy", 6)).scalar().alias("accuracy"),
    )


_RULE_SQL = "case when l_discount >= 0.07 then 'R' when l_tax >= 0.04 then 'A' else 'N' end"


@query(
    "weighted_precision",
    "V08",
    f"""
with s as (select l_returnflag as label, {_RULE_SQL} as prediction from lineitem),
n as (select count(*) as n from s),
sup as (select label as cls, count(*) as support from s group by label),
pr as (select prediction as cls, count(*) as predicted from s group by prediction),
tp as (select label as cls, count(*) as tp from s where label = prediction group by label),
per as (select cls, support, coalesce(predicted, 0) as predicted, coalesce(tp, 0) as tp
        from sup left join pr using (cls) left join tp using (cls))
select round(sum(support / n * coalesce(tp / nullif(predicted, 0), 0.0)), 6) as weighted_precision,
       round(sum(support / n * (tp / support)), 6) as weighted_recall
from per, n""",
    check="T",
)
def q_weighted_precision(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    rule = (
        F.when(F.col("l_discount") >= 0.07, "R").when(F.col("l_tax") >= 0.04, "A").otherwise("N")
    )
    df = li.select(F.col("l_returnflag").alias("label"), rule.alias("prediction"))
    w = evaluate.weighted_precision_recall(df, "label", "prediction")
    return w.select(*[F.round(c, 6).alias(c) for c in w.columns])


@query(
    "regression_metrics",
    "V09 V14",
    """
with a as (select count(*) as n, sum((y - p) * (y - p)) as ss_res, sum(abs(y - p)) as sae, sum(y - p) as sr,
                  var_pop(y) as var
           from (select 1e9 + l_extendedprice / 1000 as y, 1e9 + l_quantity * 1.5 as p from lineitem))
select round(ss_res / n, 6) as mse, round(sqrt(ss_res / n), 6) as rmse, round(sae / n, 6) as mae,
       round(1 - ss_res / (var * n), 6) as r2, round(sr / n, 6) as mean_residual from a""",
    check="T",
)
def q_regression_metrics(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    df = li.select((1e9 + F.col("l_extendedprice") / 1000).alias("y"), (1e9 + F.col("l_quantity") * 1.5).alias("p"))
    m = evaluate.regression_metrics(df, "y", "p")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


def _anomaly_sql() -> str:
    cols = ANOMALY_COLS
    st = ", ".join(f"avg({c}) as m{i}, stddev_pop({c}) as s{i}" for i, c in enumerate(cols))
    z = ", ".join(
        f"({c} - m{i}) / (case when s{i} is null or s{i} = 0 then 1.0 else s{i} end) as z{i}"
        for i, c in enumerate(cols)
    )
    cen = ", ".join(f"avg(z{i}) as c{i}" for i in range(len(cols)))
    dist = " + ".join(f"pow(z{i} - c{i}, 2)" for i in range(len(cols)))
    return f"""
with st as (select {st} from lineitem),
z as (select l_orderkey, l_linenumber, {z} from lineitem, st),
c as (select {cen} from z),
d as (select l_orderkey, l_linenumber, 0.0 + {dist} as distance from z, c),
t as (select min(distance) as threshold from (select distance from d order by distance desc limit {ANOMALY_K}))"""


@query(
    "anomaly_scores",
    "M11 M07 X21 E14 T09",
    _anomaly_sql()
    + """
select l_orderkey, l_linenumber, round(distance, 6) as distance, round(threshold, 6) as threshold,
       distance >= threshold as is_anomaly from d, t""",
    check="T",
)
def q_anomaly_scores(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    s = anomaly.anomaly_scores(li, ANOMALY_COLS, ANOMALY_K)
    return s.select(
        "l_orderkey", "l_linenumber", F.round("distance", 6).alias("distance"),
        F.round("threshold", 6).alias("threshold"), "is_anomaly",
    )


_CENTER_SQL = ", ".join(f"round(avg({c}), 6) as center_{c}" for c in ANOMALY_COLS)


@query(
    "kmeans_single",
    "M07",
    f"select {_CENTER_SQL}, count(*) as n from lineitem",
    check="T",
)
def q_kmeans_single(spark, sf_dir):
    c = anomaly.single_center(read_table(spark, sf_dir, "lineitem"), ANOMALY_COLS)
    return c.select(*[F.round(f"center_{x}", 6).alias(f"center_{x}") for x in ANOMALY_COLS], "n")


@query(
    "anomaly_model",
    "K02",
    _anomaly_sql() + f" select {', '.join(f'round(avg({c}), 6) as center_{c}' for c in ANOMALY_COLS)}, "
    "round(min(threshold), 6) as threshold from lineitem, t",
    check="T",
)
def q_anomaly_model(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    model = anomaly.anomaly_model(li, ANOMALY_COLS, ANOMALY_K)
    path = sinks.write_parquet(model, scratch_path(spark, "anomaly-model"))
    back = spark.read.parquet(path)
    return back.select(*[F.round(c, 6).alias(c) for c in back.columns])


# Dictionary substitution: synonym lines are derived from the benchmark table (each
# line's first word is the canonical form of the words on that line; a word listed on
# several lines takes the canonical of the earliest line).
_WORD = r"\p{L}+"
_TOKEN = r"[\p{L}\p{N}]+"


def _dictionary(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark")
    words = F.regexp_extract_all(F.lower("text"), F.lit(_WORD), 0)
    t = b.select("item_id", F.get(words, 0).alias("canonical"), F.posexplode(words).alias("pos", "word"))
    return t.select("word", "canonical", F.struct("item_id", "pos").alias("entry_order"))


@query(
    "dictionary_substitute",
    "J07 X06 X08",
    rf"""
with bt as (select item_id, regexp_extract_all(lower(text), '{_WORD}') as toks from benchmark),
dict as (select unnest(toks) as word, toks[1] as canonical, unnest(range(1, len(toks) + 1)) as pos, item_id from bt),
first_entry as (select word, arg_min(canonical, (item_id, pos)) as canonical from dict group by word),
dt as (select doc_id, regexp_extract_all(lower(text), '{_TOKEN}') as toks from documents),
tok as (select doc_id, unnest(toks) as w, unnest(range(1, len(toks) + 1)) as pos from dt),
j as (select doc_id, pos, w, canonical from tok left join first_entry on w = word),
k as (select doc_id, '#' || string_agg(coalesce(canonical, w), '#' order by pos) as substituted
      from j where canonical is not null or not regexp_matches(w, '^\d+\z') group by doc_id)
select d.doc_id, coalesce(k.substituted, '') as substituted from documents d left join k using (doc_id)""",
)
def q_dictionary_substitute(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    toks = F.regexp_extract_all(F.lower("text"), F.lit(_TOKEN), 0)
    return text.dictionary_substitute(d, "doc_id", toks, _dictionary(spark, sf_dir), lookup_rows=text.LOOKUP_ROWS)
