"""Registered queries: sorts, limits and the top-N family."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import IPV4_LIKE
from quarry.operators import text, topn
from quarry.plans.registry import query
from quarry.plans.strategies import global_position
from quarry.tables import read_table

TOP_N = 3  # grouped top-N depth of the minimum slice
SALT_BUCKETS = 10


def exact_revenue():
    """``price * (1 - discount)`` summed exactly: both inputs have two decimals, so the
    product is an integer in units of 1e-4.  A ``bigint`` sum stays on the fast
    long-backed path (a ``decimal(34,4)`` sum would use BigDecimal), and
    ``sum / 10000.0`` is the same double as the exact decimal result."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    pct = F.round(F.col("l_discount") * 100).cast("bigint")
    return F.sum(cents * (F.lit(100) - pct)) / F.lit(10000.0)


def supplier_part_revenue(spark, sf_dir):
    """Revenue per (supplier, part), summed exactly, shown as double."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_suppkey", "l_partkey").agg(exact_revenue().alias("revenue"))


_REVENUE_SQL = """
with rev as (
  select l_suppkey, l_partkey,
         cast(sum(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))) as double) as revenue
  from lineitem group by l_suppkey, l_partkey)
"""


@query(
    "top_n_within_group",
    "T06 T08 A14 D02 D03",
    _REVENUE_SQL
    + """
select l_suppkey, l_partkey, revenue, rank from (
  select *, cast(row_number() over (partition by l_suppkey order by revenue desc, l_partkey) as bigint) as rank
  from rev) where rank <= 3""",
)
def q_top_n_within_group(spark, sf_dir):
    return topn.top_n_within_group(
        supplier_part_revenue(spark, sf_dir),
        ["l_suppkey"],
        [F.desc("revenue"), F.asc("l_partkey")],
        TOP_N,
    )


@query(
    "top_n_within_group_salted",
    "T07 N02",
    _REVENUE_SQL
    + """
select l_suppkey, l_partkey, revenue, rank from (
  select *, cast(row_number() over (partition by l_suppkey order by revenue desc, l_partkey) as bigint) as rank
  from rev) where rank <= 3""",
)
def q_top_n_within_group_salted(spark, sf_dir):
    return topn.top_n_within_group(
        supplier_part_revenue(spark, sf_dir),
        ["l_suppkey"],
        [F.desc("revenue"), F.asc("l_partkey")],
        TOP_N,
        salt_buckets=SALT_BUCKETS,
        salt_cols=["l_partkey"],
    )


@query(
    "top_n_within_group_list",
    "T06 X18 X09",
    """
select l_suppkey, string_agg(cast(q as varchar), ',' order by q desc) as top_quantities from (
  select l_suppkey, cast(l_quantity as bigint) as q,
         row_number() over (partition by l_suppkey order by l_quantity desc) as r
  from lineitem) where r <= 5 group by l_suppkey""",
)
def q_top_n_within_group_list(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_quantity").cast("bigint").alias("q")
    )
    lists = topn.top_values_per_group_list(li, ["l_suppkey"], "q", 5, alias="top")
    return lists.select("l_suppkey", F.array_join(F.col("top").cast("array<string>"), ",").alias("top_quantities"))


@query(
    "top_ips",
    "T01 A10 O02 O03 X05 P12",
    r"""
select ip, count(*) as n from (
  select unnest(regexp_extract_all(text, '\d+\.\d+\.\d+\.\d+')) as ip from documents)
group by ip order by n desc, ip limit 50""",
)
def q_top_ips(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    counts = text.pattern_frequency(docs, "text", IPV4_LIKE, alias="ip")
    return topn.top_n(counts, [F.desc("n"), F.asc("ip")], 50)


def _event_values(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", F.floor("value").cast("bigint").alias("v"))


@query(
    "top_n_unique",
    "T02 O02",
    """
select v, user_id from (
  select v, max_by(user_id, event_id) as user_id from (
    select event_id, user_id, cast(floor(value) as bigint) as v from events) group by v)
order by v desc limit 10""",
)
def q_top_n_unique(spark, sf_dir):
    return topn.top_n_unique(_event_values(spark, sf_dir), "v", 10, ["user_id"], "event_id")


@query(
    "top_n_with_ties",
    "T03",
    """
with e as (select event_id, user_id, cast(floor(value) as bigint) as v from events),
k as (select v, cast(dense_rank() over (order by v desc) as bigint) as key_rank from (select distinct v from e))
select e.v, e.event_id, e.user_id, k.key_rank from e join k using (v) where k.key_rank <= 5""",
)
def q_top_n_with_ties(spark, sf_dir):
    return topn.top_n_keys_with_rows(_event_values(spark, sf_dir), "v", 5)


@query(
    "sum_by_key",
    "A11 A12",
    "select user_id, sum(cast(floor(value) as bigint))::bigint as total from events group by user_id",
)
def q_sum_by_key(spark, sf_dir):
    ev = _event_values(spark, sf_dir)
    return topn.sum_by_key(ev, "user_id", F.col("v"))


@query(
    "top_n_sums",
    "T04 A11",
    """
select user_id, total, cast(row_number() over (order by total desc, user_id) as bigint) as rank from (
  select user_id, sum(cast(floor(value) as bigint))::bigint as total from events group by user_id)
order by total desc, user_id limit 10""",
)
def q_top_n_sums(spark, sf_dir):
    sums = topn.sum_by_key(_event_values(spark, sf_dir), "user_id", F.col("v"))
    return topn.top_n_sums(sums, "user_id", "total", 10)


@query(
    "top_n_sums_ties",
    "T05 A12",
    """
with s as (select user_id, sum(cast(floor(value / 100) as bigint))::bigint as total from events group by user_id),
t as (select total, cast(row_number() over (order by total desc) as bigint) as sum_rank
      from (select distinct total from s) order by total desc limit 5)
select s.total, t.sum_rank, s.user_id from s join t using (total)""",
)
def q_top_n_sums_ties(spark, sf_dir):
    # coarse values (hundreds) so that several users share a sum: ties are the point
    ev = read_table(spark, sf_dir, "events")
    sums = topn.sum_by_key(ev, "user_id", F.floor(F.col("value") / 100).cast("bigint"))
    return topn.top_n_sums_with_ties(sums, "user_id", "total", 5)


@query(
    "collect_by_key",
    "A13 A07",
    "select user_id, cast(floor(value) as bigint) as v, count(*) as n from events group by user_id, v",
)
def q_collect_by_key(spark, sf_dir):
    return topn.value_multiset_by_key(_event_values(spark, sf_dir), "user_id", "v")


@query(
    "kth_largest",
    "T09",
    """
select min(l_extendedprice) as kth_value from (
  select l_extendedprice from lineitem where l_extendedprice is not null
  order by l_extendedprice desc limit 2000)""",
)
def q_kth_largest(spark, sf_dir):
    return topn.kth_largest(read_table(spark, sf_dir, "lineitem"), "l_extendedprice", 2000)


@query(
    "kth_largest_half",
    "T09",
    """
select l_extendedprice as kth_value from lineitem where l_extendedprice is not null
order by l_extendedprice desc limit 1 offset (select count(l_extendedprice) // 2 - 1 from lineitem)""",
)
def q_kth_largest_half(spark, sf_dir):
    """The largest value that half of the rows reach, by counting passes."""
    li = read_table(spark, sf_dir, "lineitem")
    return topn.kth_largest_selected(li, "l_extendedprice", li.where("l_extendedprice is not null").count() // 2)


@query(
    "sort_multi",
    "O01",
    """
select p_partkey, p_size, p_retailprice,
       row_number() over (order by p_size, p_retailprice desc, p_partkey) as pos
from part""",
)
def q_sort_multi(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    order = [F.asc("p_size"), F.desc("p_retailprice"), F.asc("p_partkey")]
    # the position column makes the order checkable; it is computed without a
    # single-partition window
    return global_position(part, order, pos_col="pos")
