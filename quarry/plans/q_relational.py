"""Registered queries: projections, filters, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import relational as rel
from quarry.plans.registry import query
from quarry.tables import read_table

# Order-priority codes used by the category encoder (unknown -> 2).
PRIORITY_CODES = {"1-URGENT": 0, "2-HIGH": 1}


@query(
    "ratio_projection",
    "P01 X12",
    """
select l_suppkey, n_returned, n_lines, round(n_returned / nullif(n_lines, 0), 6) as pct_returned from (
  select l_suppkey, count(*) filter (where l_returnflag = 'R') as n_returned, count(*) as n_lines
  from lineitem group by l_suppkey)""",
    check="T",
)
def q_ratio_projection(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    counts = li.groupBy("l_suppkey").agg(
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("n_returned"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    return counts.withColumn("pct_returned", F.round(rel.ratio("n_returned", "n_lines"), 6))


@query(
    "encode_case",
    "P02 X14",
    """
select o_orderkey, case when o_orderpriority = '1-URGENT' then 0 when o_orderpriority = '2-HIGH' then 1
                        else 2 end as encoded_priority from orders""",
)
def q_encode_case(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", rel.encode_categories("o_orderpriority", PRIORITY_CODES).alias("encoded_priority"))


@query(
    "recode_label",
    "P03 X11",
    """
select o_orderkey, case when try_cast(substr(o_orderpriority, 1, 1) as integer) = 2 then 0 else 1 end as label
from orders""",
)
def q_recode_label(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    code = F.substring("o_orderpriority", 1, 1).try_cast("int")
    return o.select("o_orderkey", rel.recode_binary(code, 2).alias("label"))


@query(
    "drop_rename_cast",
    "P05 P06 P07 X11",
    """
select c_custkey, c_nationkey as nation_key, c_mktsegment as segment,
       cast(floor(c_acctbal) as bigint) as balance_floor, cast(c_custkey as varchar) as custkey_text
from customer""",
)
def q_drop_rename_cast(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    c = c.withColumn("balance_floor", F.floor("c_acctbal").cast("bigint")).withColumn(
        "custkey_text", F.col("c_custkey")
    )
    return rel.drop_rename_cast(
        c,
        drop=["c_name", "c_acctbal"],
        rename={"c_nationkey": "nation_key", "c_mktsegment": "segment"},
        casts={"custkey_text": "string"},
    )


@query(
    "select_expr",
    "P09 X13",
    "select *, cast(p_size as double) as size_d, round(p_retailprice / 7, 1) as price_7 from part",
)
def q_select_expr(spark, sf_dir):
    return read_table(spark, sf_dir, "part").selectExpr(
        "*", "double(p_size) as size_d", "round(p_retailprice / 7, 1) as price_7"
    )


@query("columns_by_suffix", "P11 P04", "select l_orderkey, l_partkey, l_suppkey from lineitem")
def q_columns_by_suffix(spark, sf_dir):
    return rel.columns_by_suffix(read_table(spark, sf_dir, "lineitem"), "key")


@query("filter_min", "F01", "select * from part where p_size >= 25")
def q_filter_min(spark, sf_dir):
    return rel.filter_min(read_table(spark, sf_dir, "part"), "p_size", 25)


@query(
    "filter_not_true",
    "F02 X15",
    "select o_orderkey, o_orderstatus from orders where (o_orderstatus = 'F') <> true",
)
def q_filter_not_true(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", (F.col("o_orderstatus") == "F").alias("finished")
    )
    return rel.filter_not_true(o, "finished").drop("finished")


@query(
    "filter_array_elements",
    "F03 X16",
    """
select vec_id, label, cast(embedding[1] as double) as e0, cast(embedding[2] as double) as e1
from embeddings where label < 5 and embedding[1] > embedding[2]""",
)
def q_filter_array_elements(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings").withColumn("flag", F.col("label") < 5)
    return rel.filter_array_elements(e, "flag", "embedding").select(
        "vec_id",
        "label",
        F.get("embedding", 0).cast("double").alias("e0"),
        F.get("embedding", 1).cast("double").alias("e1"),
    )


@query(
    "filter_half",
    "F04",
    """
select o_custkey, n_finished, n_orders from (
  select o_custkey, count(*) filter (where o_orderstatus = 'F') as n_finished, count(*) as n_orders
  from orders group by o_custkey) where n_finished >= n_orders / 2""",
)
def q_filter_half(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    counts = o.groupBy("o_custkey").agg(
        F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("n_finished"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    return rel.filter_half(counts, "n_finished", "n_orders")


@query(
    "filter_contains",
    "F05 X07",
    "select doc_id, n_chars from documents where contains(text, 'tion') and not contains(text, 'ç')",
)
def q_filter_contains(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return rel.filter_contains(d, "text", include="tion", exclude="ç").select("doc_id", "n_chars")


@query(
    "filter_sentinel",
    "F06 F08",
    """
select event_id, k from (select event_id, json_extract_string(props, '$.k') as k from events)
where k not in ('?', '0') and length(trim(k)) > 0""",
)
def q_filter_sentinel(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k")
    )
    return rel.filter_sentinel(e, "k")


@query(
    "sql_filter",
    "F10 K05 P10",
    "select * from part where p_size < 12",
)
def q_sql_filter(spark, sf_dir):
    return rel.sql_where(spark, read_table(spark, sf_dir, "part"), "p_size < 12")


_ORDER_LINE = ["o_orderkey", "o_custkey", "l_linenumber", "l_quantity"]


def _orders_lines(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return o, li


@query(
    "join_inner",
    "J01 J02",
    """select o_orderkey, o_custkey, l_linenumber, l_quantity
       from orders join lineitem on o_orderkey = l_orderkey""",
)
def q_join_inner(spark, sf_dir):
    o, li = _orders_lines(spark, sf_dir)
    return rel.join(o, li, o.o_orderkey == li.l_orderkey, "inner").select(*_ORDER_LINE)


@query(
    "join_left_outer",
    "J03",
    """select o_orderkey, o_custkey, l_linenumber, l_quantity
       from orders left join lineitem on o_orderkey = l_orderkey""",
)
def q_join_left_outer(spark, sf_dir):
    o, li = _orders_lines(spark, sf_dir)
    return rel.join(o, li, o.o_orderkey == li.l_orderkey, "left_outer").select(*_ORDER_LINE)


@query(
    "join_right_outer",
    "J04",
    """select o_orderkey, o_custkey, l_linenumber, l_quantity
       from lineitem right join orders on o_orderkey = l_orderkey""",
)
def q_join_right_outer(spark, sf_dir):
    o, li = _orders_lines(spark, sf_dir)
    return rel.join(li, o, o.o_orderkey == li.l_orderkey, "right_outer").select(*_ORDER_LINE)


@query(
    "join_left_semi",
    "J05",
    """select o_orderkey, o_custkey from orders
       where exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
)
def q_join_left_semi(spark, sf_dir):
    o, li = _orders_lines(spark, sf_dir)
    return rel.join(o, li, o.o_orderkey == li.l_orderkey, "left_semi")


@query(
    "join_left_anti",
    "U03 J05",
    """select o_orderkey, o_custkey from orders
       where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""",
)
def q_join_left_anti(spark, sf_dir):
    o, li = _orders_lines(spark, sf_dir)
    return rel.join(o, li, o.o_orderkey == li.l_orderkey, "left_anti")


@query(
    "join_self",
    "J06",
    """select a.p_partkey as a_partkey, b.p_partkey as b_partkey, a.p_brand as brand
       from part a join part b on b.p_partkey = a.p_partkey + 1 and a.p_brand = b.p_brand""",
)
def q_join_self(spark, sf_dir):
    # self-join on the unique part key: output is at most one row per part
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    cond = (F.col("b.p_partkey") == F.col("a.p_partkey") + 1) & (F.col("a.p_brand") == F.col("b.p_brand"))
    return rel.self_join(p, cond).select(
        F.col("a.p_partkey").alias("a_partkey"),
        F.col("b.p_partkey").alias("b_partkey"),
        F.col("a.p_brand").alias("brand"),
    )


@query("distinct_values", "U01", "select distinct lang, source from documents")
def q_distinct_values(spark, sf_dir):
    return rel.distinct_values(read_table(spark, sf_dir, "documents"), ["lang", "source"])


@query(
    "drop_duplicates",
    "U02",
    """select doc_id, lang, n_chars from (
         select doc_id, lang, n_chars, row_number() over (partition by text order by doc_id) as rn
         from documents) where rn = 1""",
)
def q_drop_duplicates(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("text", "doc_id", "lang", "n_chars")
    return rel.drop_duplicates_by(d, ["text"], ["doc_id"]).drop("text")


@query(
    "subtract_rows",
    "U03",
    """
with l as (select l_orderkey, l_linenumber, l_returnflag from lineitem),
     r as (select l_orderkey, l_linenumber, l_returnflag from lineitem where l_returnflag = 'R')
select * from l where not exists (
  select 1 from r where r.l_orderkey is not distinct from l.l_orderkey
    and r.l_linenumber is not distinct from l.l_linenumber
    and r.l_returnflag is not distinct from l.l_returnflag)""",
)
def q_subtract_rows(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return rel.subtract_rows(li, li.where(F.col("l_returnflag") == "R"))
