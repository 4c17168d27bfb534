"""Registered queries: scalar string / math / array functions, hash split, UDF form,
row ids (SURVEY §2.9, §2.11, §2.15, J09)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from quarry.functions.sampling import hash_split_flag, hash_split_sql
from quarry.functions.text import ALL_DIGITS, IPV4_LIKE, jvm_split, jvm_trim
from quarry.operators import relational as rel
from quarry.plans.registry import query
from quarry.tables import read_table

_JVM_SPLIT_SPACE_SQL = """case when text = '' then ['']
     when regexp_replace(text, '( )+$', '') = '' then []::varchar[]
     else string_split(regexp_replace(text, '( )+$', ''), ' ') end"""


@query(
    "scalar_string",
    "X01 X03 X04 X05 X06 X08 X09 X10 X17 X19",
    rf"""
with t as (select doc_id, text, {_JVM_SPLIT_SPACE_SQL} as toks from documents)
select doc_id,
       length(text) as n_len,
       len(toks) as n_tokens,
       lower(toks[1]) as first_token,
       toks[-1] as last_token,
       length(regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')) as trimmed_len,
       len(list_filter(toks, lambda w: regexp_matches(w, '^\d+\z'))) as n_digit_tokens,
       len(regexp_extract_all(text, '\d+\.\d+\.\d+\.\d+')) as n_ips,
       '#' || array_to_string(toks[1:3], '#') as head3
from t""",
)
def q_scalar_string(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    toks = jvm_split("text", " ")
    return d.select(
        "doc_id",
        F.length("text").alias("n_len"),
        F.size(toks).alias("n_tokens"),
        F.lower(F.get(toks, 0)).alias("first_token"),
        F.element_at(toks, -1).alias("last_token"),
        F.length(jvm_trim("text")).alias("trimmed_len"),
        F.size(F.filter(toks, lambda w: w.rlike(ALL_DIGITS))).alias("n_digit_tokens"),
        F.size(F.regexp_extract_all("text", F.lit(IPV4_LIKE), 0)).alias("n_ips"),
        F.concat(F.lit("#"), F.array_join(F.slice(toks, 1, 3), "#")).alias("head3"),
    )


@query(
    "scalar_math",
    "X11 X12 X13 X14 X15",
    """
select l_orderkey, l_linenumber,
       round(sqrt(l_quantity), 6) as sqrt_qty,
       round(pow(l_discount, 2), 6) as discount_sq,
       round(l_quantity / 3, 1) as qty_third,
       round(l_tax / nullif(l_discount, 0), 6) as tax_per_discount,
       cast(floor(l_extendedprice) as bigint) as price_floor,
       round(ln(l_quantity), 6) as ln_qty,
       case when l_quantity >= 25 and not (l_returnflag = 'R') then 1 else 0 end as big_kept
from lineitem""",
    check="T",
)
def q_scalar_math(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.sqrt("l_quantity"), 6).alias("sqrt_qty"),
        F.round(F.pow("l_discount", 2), 6).alias("discount_sq"),
        F.round(F.col("l_quantity") / 3, 1).alias("qty_third"),
        F.round(rel.ratio("l_tax", "l_discount"), 6).alias("tax_per_discount"),
        F.floor("l_extendedprice").cast("bigint").alias("price_floor"),
        F.round(F.log("l_quantity"), 6).alias("ln_qty"),
        F.when((F.col("l_quantity") >= 25) & ~(F.col("l_returnflag") == "R"), 1).otherwise(0).alias("big_kept"),
    )


@query(
    "scalar_array",
    "X16 X17 X18 X20 X21 X22",
    """
with t as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings)
select vec_id,
       e[1] as first_value,
       e[-1] as last_value,
       len(e) as n,
       list_sort(e, 'DESC')[2] as second_largest,
       round(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b), 6) as sq_norm,
       round(list_reduce(list_transform(list_zip(e[1:32], e[33:64]), lambda p: (p[1] - p[2]) * (p[1] - p[2])),
                         lambda a, b: a + b), 6) as half_distance,
       len(list_filter(e, lambda x: x > 0)) as n_positive,
       len(e[2:len(e) - 1]) as n_inner
from t""",
    check="T",
)
def q_scalar_array(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e")
    )
    sq = F.aggregate(F.transform("e", lambda x: x * x), F.lit(0.0), lambda a, b: a + b)
    diff = F.zip_with(F.slice("e", 1, 32), F.slice("e", 33, 32), lambda a, b: (a - b) * (a - b))
    return e.select(
        "vec_id",
        F.get("e", 0).alias("first_value"),
        F.element_at("e", -1).alias("last_value"),
        F.size("e").alias("n"),
        F.get(F.sort_array("e", asc=False), 1).alias("second_largest"),
        F.round(sq, 6).alias("sq_norm"),
        F.round(F.aggregate(diff, F.lit(0.0), lambda a, b: a + b), 6).alias("half_distance"),
        F.size(F.filter("e", lambda x: x > 0)).alias("n_positive"),
        F.size(F.slice("e", 2, F.size("e") - 2)).alias("n_inner"),
    )


@query(
    "hash_split",
    "N01",
    f"select c_custkey, case when {hash_split_sql('c_custkey', 777, 0.7)} then 'train' else 'test' end as part "
    "from customer",
)
def q_hash_split(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    flag = hash_split_flag("c_custkey", 777, 0.7)
    return c.select("c_custkey", F.when(flag, "train").otherwise("test").alias("part"))


@F.pandas_udf(IntegerType())
def _recode_udf(codes: pd.Series) -> pd.Series:
    # Arrow-batched user function: the UDF form of the recode, kept to prove it
    # equals the native column expression (null -> 1, like the native form)
    return (codes != 2).astype("int32").where(codes.notna(), 1)


@query(
    "udf_recode",
    "D01 P03",
    """select o_orderkey, case when try_cast(substr(o_orderpriority, 1, 1) as integer) = 2 then 0 else 1 end as native,
              case when try_cast(substr(o_orderpriority, 1, 1) as integer) = 2 then 0 else 1 end as via_udf
       from orders""",
)
def q_udf_recode(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    code = F.substring("o_orderpriority", 1, 1).try_cast("int")
    return o.select(
        "o_orderkey", rel.recode_binary(code, 2).alias("native"), _recode_udf(code).alias("via_udf")
    )


@query(
    "row_id_unique",
    "J09",
    "select count(*) as n, count(*) as n_distinct_ids from lineitem",
)
def q_row_id_unique(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(F.monotonically_increasing_id().alias("row_id"))
    return li.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("n_distinct_ids"))
