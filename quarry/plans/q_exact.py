"""Registered queries: linear and logistic models whose numbers SQL can follow.

The oracle of a fit starts from ``covar_pop`` and ``avg`` (or from the rows, for the logistic
one) and takes the same descent steps in a recursive query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.sampling import hash_split_sql
from quarry.operators import linear, logistic, models
from quarry.plans.registry import query
from quarry.tables import read_table

# The penalty of the linear model, the tuning grids, splits and folds.
LINEAR_PENALTY = (0.3, 0.8)
TUNING_GRID = ((0.01, 0.0), (0.1, 0.0), (1.0, 0.0))
FOLD_GRID = tuple((reg, l1) for reg in (0.01, 0.1, 1.0) for l1 in (0.0, 0.5))
FOLDS, FOLD_SEED = 3, 42
LOGISTIC_PENALTY, LOGISTIC_STEPS = (0.002, 0.5), 5

FEATURES = ["l_quantity", "l_discount", "l_tax"]
LABEL = "l_extendedprice"
ROW_KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey)"
D, SWEEPS = len(FEATURES), 60


def _rows(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    return li.select("l_orderkey", "l_linenumber", key.alias("row_key"), *FEATURES, LABEL)


def _fold_sql(seed: int, folds: int) -> str:
    return f"(('0x' || substr(md5('{seed}|' || {ROW_KEY}), 1, 8))::bigint % {folds})"


def _moments_sql(name: str, rows: str, by: str) -> str:
    x = [*FEATURES, LABEL]
    cells = ", ".join(f"covar_pop({x[i]}, {x[j]}) as c{i}{j}" for i in range(D + 1) for j in range(i + 1))
    means = ", ".join(f"avg({c}) as m{i}" for i, c in enumerate(x))
    return f"{name} as (select {by} as part, {means}, {cells} from {rows} group by 1)"


def _cell(i: int, j: int) -> str:
    return f"c{max(i, j)}{min(i, j)}"


def _descent_sql(grid) -> str:
    """CTEs: ``fits`` (part, reg, l1, b0 ... intercept) from the moments in ``train``."""
    rows = ", ".join(f"({reg}::double, {l1}::double)" for reg, l1 in grid)
    scaled = ", ".join(f"{_cell(i, j)} / sqrt(c{i}{i} * c{j}{j}) as a{i}{j}" for i in range(D) for j in range(D + 1) if i != j)
    inner = "select c.*, s.* exclude (part), reg * l1 / sqrt(c33) as hard, reg * (1 - l1) / sqrt(c33) as soft from cd c join scaled s using (part)"
    for i in range(D):  # each coordinate with the ones before it already moved
        z = f"a{i}{D}" + "".join(f" - a{i}{j} * {'n' if j < i else 'w'}{j}" for j in range(D) if j != i)
        inner = f"select *, sign({z}) * greatest(abs({z}) - hard, 0) / (1 + soft) as n{i} from ({inner})"
    weights = ", ".join(f"w{i} * sqrt(c{D}{D} / c{i}{i}) as b{i}" for i in range(D))
    intercept = f"m{D}" + "".join(f" - w{i} * sqrt(c{D}{D} / c{i}{i}) * m{i}" for i in range(D))
    return f"""
grid(reg, l1) as (values {rows}),
scaled as (select *, {scaled} from train),
cd as (
  select part, reg, l1, 0 as k, {", ".join(f"0.0::double as w{i}" for i in range(D))} from scaled, grid
  union all
  select part, reg, l1, k + 1, {", ".join(f"n{i}" for i in range(D))} from ({inner}) where k < {SWEEPS}
),
fits as (select part, reg, l1, {weights}, {intercept} as intercept from cd join scaled using (part) where k = {SWEEPS})"""


def _error_sql() -> str:
    """The error of a fit (``f``) on the moments of ``held`` (``h``)."""
    square = f"h.c{D}{D}" + "".join(f" - 2 * b{i} * h.c{D}{i}" for i in range(D))
    square += "".join(f" + b{i} * b{j} * h.{_cell(i, j)}" for i in range(D) for j in range(D))
    mean = f"h.m{D} - intercept" + "".join(f" - b{i} * h.m{i}" for i in range(D))
    return f"sqrt({square} + pow({mean}, 2))"


def _train_sql(seed: int, fraction: float, grid) -> str:
    split = hash_split_sql(ROW_KEY, seed, fraction)
    return (
        "with recursive "
        + _moments_sql("train", f"(select * from lineitem where {split})", "0")
        + ", "
        + _moments_sql("held", f"(select * from lineitem where not {split})", "0")
        + ","
        + _descent_sql(grid)
    )


@query(
    "linear_elastic",
    "M04 M10",
    _train_sql(777, 0.7, [LINEAR_PENALTY])
    + f"""
select l_orderkey, l_linenumber, l_extendedprice as label,
       round(intercept + {" + ".join(f"b{i} * {c}" for i, c in enumerate(FEATURES))}, 1) as prediction
from lineitem, fits where not {hash_split_sql(ROW_KEY, 777, 0.7)}""",
    check="T",
)
def q_linear_elastic(spark, sf_dir):
    train, test = models.hash_split(_rows(spark, sf_dir), "row_key", 0.7, 777)
    fit = linear.elastic_net(linear.moments(train, FEATURES, LABEL)[None], *LINEAR_PENALTY)
    value = F.round(linear.predicted(FEATURES, fit), 1).alias("prediction")
    return test.select("l_orderkey", "l_linenumber", F.col(LABEL).alias("label"), value)


@query(
    "model_coefficients",
    "M12",
    _train_sql(777, 0.7, [LINEAR_PENALTY])
    + " "
    + " union all ".join(f"select '{c}' as feature, round(b{i}, 6) as weight from fits" for i, c in enumerate(FEATURES))
    + " union all select '(intercept)', round(intercept, 6) from fits",
    check="T",
)
def q_model_coefficients(spark, sf_dir):
    train, _ = models.hash_split(_rows(spark, sf_dir), "row_key", 0.7, 777)
    fit = linear.elastic_net(linear.moments(train, FEATURES, LABEL)[None], *LINEAR_PENALTY)
    rows = [*zip(FEATURES, fit.coefficients, strict=True), ("(intercept)", fit.intercept)]
    out = spark.createDataFrame(rows, "feature string, weight double")
    return out.select("feature", F.round("weight", 6).alias("weight"))


@query(
    "tvs",
    "M14 V14",
    _train_sql(42, 0.8, TUNING_GRID) + f" select reg as reg_param, round({_error_sql()}, 6) as rmse from fits f join held h using (part)",
    check="T",
)
def q_tvs(spark, sf_dir):
    """Root mean squared error on the held-out part for every penalty, from one scan."""
    flagged = _rows(spark, sf_dir).withColumn("train", models.hash_split_flag("row_key", 42, 0.8).cast("int"))
    parts = linear.moments(flagged, FEATURES, LABEL, "train")
    found = linear.validated_grid(parts[1], parts[0], TUNING_GRID)
    out = spark.createDataFrame([(reg, e) for reg, _, e in found], "reg_param double, rmse double")
    return out.select("reg_param", F.round("rmse", 6).alias("rmse"))


def _folds_sql() -> str:
    others = f"(select l.*, f.f from lineitem l, range({FOLDS}) f(f) where {_fold_sql(FOLD_SEED, FOLDS)} <> f.f)"
    return (
        "with recursive "
        + _moments_sql("train", others, "f")
        + ", "
        + _moments_sql("held", "lineitem", _fold_sql(FOLD_SEED, FOLDS))
        + ","
        + _descent_sql(FOLD_GRID)
        + f""" select reg as reg_param, l1 as elastic_net, part::integer as fold, round({_error_sql()}, 6) as rmse
from fits f join held h using (part)"""
    )


@query("kfold_linear", "M13 V14", _folds_sql(), check="T")
def q_kfold_linear(spark, sf_dir):
    """Errors of every penalty on every fold, from one scan for all of them."""
    rows = linear.fold_errors(_rows(spark, sf_dir), FEATURES, LABEL, "row_key", FOLDS, FOLD_SEED, FOLD_GRID)
    out = spark.createDataFrame(rows, "reg_param double, elastic_net double, fold int, rmse double")
    return out.withColumn("rmse", F.round("rmse", 6))


def _logistic_sql() -> str:
    """One CTE an iteration for the sums over the rows, one recursive one for the descent."""
    reg, l1 = LOGISTIC_PENALTY
    hard, soft = reg * l1, reg * (1 - l1)
    x = ["z1", "z2", "1.0"]
    parts = [
        """with recursive raw as (select case when event_type = 'purchase' then 1.0 else 0.0 end as y, value / 100 as x1,
                             cast(json_extract(props, '$.k') as double) / 100 as x2 from events),
st as (select avg(x1) as m1, avg(x2) as m2, stddev_samp(x1) as s1, stddev_samp(x2) as s2, avg(y) as p from raw),
e as (select y, (x1 - m1) / s1 as z1, (x2 - m2) / s2 as z2 from raw, st),
w0 as (select 0.0::double as a, 0.0::double as b, ln(p / (1 - p)) as c from st)"""
    ]
    for t in range(LOGISTIC_STEPS + 1):
        h = ", ".join(f"avg(p * (1 - p) * {x[i]} * {x[j]}) as h{i}{j}" for i in range(3) for j in range(i + 1))
        g = ", ".join(f"avg((p - y) * {v}) as g{i}" for i, v in enumerate(x))
        parts.append(
            f"""d{t} as materialized (select any_value(a) as a, any_value(b) as b, any_value(c) as c, {g}, {h},
  avg(greatest(m, 0) + ln(1 + exp(-abs(m))) - y * m) + {hard} * (abs(any_value(a)) + abs(any_value(b)))
    + {soft} / 2 * (pow(any_value(a), 2) + pow(any_value(b), 2)) as objective
  from (select *, 1 / (1 + exp(-m)) as p from (select e.*, a, b, c, a * z1 + b * z2 + c as m from e, w{t})))"""
        )
        if t == LOGISTIC_STEPS:
            break
        old = "abc"
        inner = f"select q.k, q.u0, q.u1, q.u2, d.* from q{t} q, d{t} d"
        for i in range(3):
            shift = " + ".join(f"h{max(i, j)}{min(i, j)} * ({'v' if j < i else 'u'}{j} - {old[j]})" for j in range(3))
            z = f"(h{i}{i} * u{i} - (g{i} + {shift}))"
            to = f"{z} / h{i}{i}" if i == 2 else f"sign({z}) * greatest(abs({z}) - {hard}, 0) / (h{i}{i} + {soft})"
            inner = f"select *, {to} as v{i} from ({inner})"
        parts.append(
            f"""q{t} as (select 0 as k, a as u0, b as u1, c as u2 from d{t}
  union all select k + 1, v0, v1, v2 from ({inner}) where k < {SWEEPS})"""
        )
        parts.append(f"w{t + 1} as (select u0 as a, u1 as b, u2 as c from q{t} where k = {SWEEPS})")
    rows = " union all ".join(
        f"select {t}::integer as iteration, round(objective, 9) as objective, round(a / s1, 6) as w_x1, round(b / s2, 6) as w_x2,"
        f" round(c - a / s1 * m1 - b / s2 * m2, 6) as intercept from d{t}, st"
        for t in range(LOGISTIC_STEPS + 1)
    )
    return ",\n".join(parts) + "\n" + rows


@query("logistic_trace", "M02 M12 V01", _logistic_sql(), check="T")
def q_logistic_trace(spark, sf_dir):
    """Objective and weights of an elastic-net logistic regression after each Newton step."""
    ev = read_table(spark, sf_dir, "events")
    df = ev.select(
        (F.col("event_type") == "purchase").cast("double").alias("y"),
        (F.col("value") / 100).alias("x1"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("x2"),
    ).persist()
    try:
        fit = logistic.fit(df, ["x1", "x2"], "y", *LOGISTIC_PENALTY, iterations=LOGISTIC_STEPS, tolerance=-1)
    finally:
        df.unpersist()
    rows = [(t, round(v, 9), round(w[0], 6), round(w[1], 6), round(b, 6)) for t, (v, w, b) in enumerate(fit.trace)]
    return spark.createDataFrame(rows, "iteration int, objective double, w_x1 double, w_x2 double, intercept double")
