"""Registered queries: aggregates, word counts and moving windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import aggregate as agg
from quarry.operators import text, window
from quarry.plans.registry import query
from quarry.tables import read_table

# Separators and stop words of the filtered word count.
ILLEGAL_CHARS = ",.;:!?\n"
STOP_WORDS = ("a", "an", "and", "the", "of", "to", "in", "is", "it", "le", "la", "de", "der", "die", "el")


@query(
    "describe_typed",
    "A01",
    """
with s as (select count(c_acctbal) as n1, avg(c_acctbal) as m1, stddev_samp(c_acctbal) as d1,
                  min(c_acctbal) as lo1, max(c_acctbal) as hi1,
                  count(c_nationkey) as n2, avg(c_nationkey) as m2, stddev_samp(c_nationkey) as d2,
                  min(c_nationkey) as lo2, max(c_nationkey) as hi2 from customer)
select 'count' as summary, round(n1::double, 6) as c_acctbal, round(n2::double, 6) as c_nationkey from s
union all select 'mean', round(m1, 6), round(m2, 6) from s
union all select 'stddev', round(d1, 6), round(d2, 6) from s
union all select 'min', round(lo1, 6), round(lo2::double, 6) from s
union all select 'max', round(hi1, 6), round(hi2::double, 6) from s""",
    check="T",
)
def q_describe_typed(spark, sf_dir):
    return agg.describe_typed(read_table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey"], digits=6)


@query("group_max", "A02", "select p_brand, max(p_size) as max_p_size from part group by p_brand")
def q_group_max(spark, sf_dir):
    return agg.agg_spec(read_table(spark, sf_dir, "part"), ["p_brand"], {"p_size": "max"})


@query(
    "group_min_max",
    "A03",
    "select p_brand, min(p_size) as min_p_size, max(p_size) as max_p_size from part group by p_brand",
)
def q_group_min_max(spark, sf_dir):
    return agg.agg_spec(read_table(spark, sf_dir, "part"), ["p_brand"], [("p_size", "min"), ("p_size", "max")])


@query(
    "group_agg_spec",
    "A04",
    """select c_mktsegment, min(c_acctbal) as min_c_acctbal, max(c_nationkey) as max_c_nationkey
       from customer group by c_mktsegment""",
)
def q_group_agg_spec(spark, sf_dir):
    return agg.agg_spec(
        read_table(spark, sf_dir, "customer"), ["c_mktsegment"], {"c_acctbal": "min", "c_nationkey": "max"}
    )


@query(
    "group_min_mean",
    "A05",
    "select user_id, min(value) as min_value, round(avg(value), 6) as mean_value from events group by user_id",
    check="T",
)
def q_group_min_mean(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(F.min("value").alias("min_value"), F.round(F.avg("value"), 6).alias("mean_value"))


@query("global_count", "A06", "select count(*) as n from lineitem")
def q_global_count(spark, sf_dir):
    return agg.global_count(read_table(spark, sf_dir, "lineitem"))


@query(
    "word_count",
    "A07 A08 X19 D04",
    """select word, count(*) as n from (
         select unnest(regexp_split_to_array(lower(text), '[ \n]')) as word from documents)
       where length(word) > 0 group by word""",
)
def q_word_count(spark, sf_dir):
    return text.word_count(read_table(spark, sf_dir, "documents"), "text")


def _stop_list_sql() -> str:
    return ", ".join(f"'{w}'" for w in STOP_WORDS)


@query(
    "word_count_filtered",
    "A09 F07 X02 X03 X04 X10",
    rf"""select word, count(*) as n from (
         select lower(regexp_replace(t, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')) as word from (
           select unnest(regexp_split_to_array(text, '[,.;:!?\n ]')) as t from documents))
       where length(word) > 0 and word not in ({_stop_list_sql()}) group by word""",
)
def q_word_count_filtered(spark, sf_dir):
    return text.word_count_filtered(read_table(spark, sf_dir, "documents"), "text", ILLEGAL_CHARS, STOP_WORDS)


@query(
    "ip_frequency",
    "A10 X05",
    r"""select ip, count(*) as n from (
          select unnest(regexp_extract_all(text, '\d+\.\d+\.\d+\.\d+')) as ip from documents) group by ip""",
)
def q_ip_frequency(spark, sf_dir):
    from quarry.functions.text import IPV4_LIKE

    return text.pattern_frequency(read_table(spark, sf_dir, "documents"), "text", IPV4_LIKE, alias="ip")


@query(
    "duplicate_keys",
    "A15",
    """select l_orderkey, l_linenumber, count(*) as n from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1""",
)
def q_duplicate_keys(spark, sf_dir):
    return agg.duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_MOMENT_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _moments_sql() -> str:
    parts = []
    for c in _MOMENT_COLS:
        d = f"cast({c} as decimal(18,2))"
        parts.append(
            f"""select '{c}' as "column", count({c}) as n, round(cast(sum({d}) as double), 6) as total,
                round(cast(sum({d} * {d}) as double), 6) as total_sq, round(avg({c}), 6) as mean,
                round(stddev_pop({c}), 6) as stddev_pop from lineitem"""
        )
    return "\nunion all ".join(parts)


@query("column_moments", "A16 A17 A18", _moments_sql(), check="T")
def q_column_moments(spark, sf_dir):
    return agg.column_moments(read_table(spark, sf_dir, "lineitem"), list(_MOMENT_COLS), exact_scale=2, digits=6)


@query(
    "window_relative",
    "W01",
    """select event_id, user_id, round(value - avg(value) over (
           partition by user_id order by ts, event_id rows between 10 preceding and 10 following), 6) as relative
       from events""",
    check="T",
)
def q_window_relative(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    out = window.relative_to_moving_avg(e, ["user_id"], [F.asc("ts"), F.asc("event_id")], "value")
    return out.select("event_id", "user_id", F.round("relative", 6).alias("relative"))


@query(
    "window_relative_range",
    "W02",
    """select event_id, user_id, round(value - avg(value) over (
           partition by user_id order by value range between 10 preceding and 10 following), 6) as relative
       from events""",
    check="T",
)
def q_window_relative_range(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    out = window.relative_to_range_avg(e, ["user_id"], "value", "value")
    return out.select("event_id", "user_id", F.round("relative", 6).alias("relative"))
