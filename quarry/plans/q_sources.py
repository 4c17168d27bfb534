"""Registered queries: sources, parsers and sinks, as round trips through the shared
scratch folder.  Each call writes a fresh folder, so reruns never see old files."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.operators import relational as rel
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import files, parse, sinks
from quarry.tables import read_table

# Fixed value: the least number of partitions of the text scan.
TEXT_PARTITIONS = 10
_EVENT_COLS = ["event_id", "user_id", "event_type", "value", "props"]


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select(*_EVENT_COLS)


@query(
    "scan_json",
    "S01 S02",
    "select event_id, user_id, event_type, value, props from events",
)
def q_scan_json(spark, sf_dir):
    path = sinks.write_json(_events(spark, sf_dir), scratch_path(spark, "json"))
    return files.read_json(spark, path, sampling_ratio=1.0).select(*_EVENT_COLS)


@query(
    "json_from_lines",
    "S03",
    "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
)
def q_json_from_lines(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "props")
    return files.json_from_lines(ev, "props")


@query(
    "json_prefiltered",
    "S04 F05",
    """select event_id, cast(json_extract(props, '$.k') as bigint) as k from events
       where contains(props, '"k": 1')""",
)
def q_json_prefiltered(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "props")
    return files.json_prefiltered(ev, "props", '"k": 1', schema="k BIGINT")


def _line():
    return F.concat_ws(" ", F.col("user_id").cast("string"), F.floor("value").cast("string"))


@query(
    "scan_text",
    "S05 S07 S08 S06",
    "select concat_ws(' ', user_id, cast(floor(value) as bigint)) as value from events",
)
def q_scan_text(spark, sf_dir):
    lines = read_table(spark, sf_dir, "events").select(_line().alias("value"))
    path = sinks.write_text(lines, scratch_path(spark, "text"))
    return files.read_text(spark, path, min_partitions=TEXT_PARTITIONS)  # a directory of part files


@query(
    "scan_csv",
    "S09",
    "select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment, c_acctbal as acctbal from customer",
)
def q_scan_csv(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = sinks.write_csv(c, scratch_path(spark, "csv"))
    back = files.read_csv(spark, path, header=True)  # every column a string
    back = rel.positional_names(back, c.columns)
    return back.select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").try_cast("double").alias("acctbal")
    )


@query(
    "scan_csv_inferred",
    "S10",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
)
def q_scan_csv_inferred(spark, sf_dir):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    path = sinks.write_csv(read_table(spark, sf_dir, "orders").select(*cols), scratch_path(spark, "csvi"))
    back = files.read_csv(spark, path, header=True, infer_schema=True)
    # inference may pick int for small keys; normalise to the table's key type
    return back.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderpriority",
    )


@query(
    "scan_libsvm",
    "S11 X22 X23",
    """select cast(label as double) as label, cast(len(list_filter(embedding, lambda x: x != 0)) as integer) as nnz,
              64 as num_features from embeddings""",
)
def q_scan_libsvm(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    lines = e.select(files.libsvm_lines(F.col("label"), F.col("embedding")).alias("value"))
    path = sinks.write_text(lines, scratch_path(spark, "libsvm"))
    back = files.read_libsvm(spark, path, num_features=64)
    arr = vector_to_array("features")
    return back.select(
        "label",
        F.size(F.filter(arr, lambda x: x != 0)).alias("nnz"),
        F.size(arr).alias("num_features"),
    )


def _delimited_lines(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    v = F.when(F.col("event_type") == "error", F.lit("?")).otherwise(F.floor("value").cast("string"))
    k = F.get_json_object("props", "$.k")
    return ev.select("event_id", F.concat_ws(",", F.col("user_id").cast("string"), "event_type", v, k).alias("line"))


_FIELDS = [(0, "user_id", "bigint"), (1, "event_type", "string"), (2, "v", "bigint"), (3, "k", "int")]


@query(
    "parse_delimited",
    "S14 P08 X01 X11",
    """select event_id, user_id, event_type, cast(floor(value) as bigint) as v,
              cast(json_extract(props, '$.k') as integer) as k
       from events where event_type <> 'error'""",
)
def q_parse_delimited(spark, sf_dir):
    parsed, _ = parse.parse_delimited(_delimited_lines(spark, sf_dir), "line", ",", _FIELDS, n_fields=4, keep=["event_id"])
    return parsed


@query(
    "parse_delimited_rejects",
    "S14",
    """select event_id, concat_ws(',', user_id, event_type, '?', json_extract_string(props, '$.k')) as line
       from events where event_type = 'error'""",
)
def q_parse_delimited_rejects(spark, sf_dir):
    _, rejects = parse.parse_delimited(_delimited_lines(spark, sf_dir), "line", ",", _FIELDS, n_fields=4, keep=["event_id"])
    return rejects


_LI_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"]


@query(
    "sink_csv_roundtrip",
    "K01",
    "select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem",
)
def q_sink_csv_roundtrip(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(*_LI_COLS)
    path = sinks.write_csv(li, scratch_path(spark, "sink"))
    schema = "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_returnflag STRING"
    return files.read_csv(spark, path, header=True, schema=schema)


@query(
    "sink_csv_text",
    "K01 S09",
    "select doc_id, text, lang from documents",
)
def q_sink_csv_text(spark, sf_dir):
    """Free text with line breaks and quotes through CSV and back."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = sinks.write_csv(docs, scratch_path(spark, "sink"))
    return files.read_csv(spark, path, schema="doc_id BIGINT, text STRING, lang STRING", multi_line=True)


def _labelled_lines(sep, features_first, inner=None):
    nums = [F.col(c).cast("string") for c in ("l_quantity", "l_discount", "l_tax")]
    # every tenth supplier's rows have a field that is no number
    broken = F.when(F.col("l_suppkey") % 10 == 0, F.lit("?")).otherwise(F.col("l_linenumber").cast("string"))
    features = F.concat_ws(inner or sep, *nums)
    parts = (features, broken) if features_first else (broken, features)
    return F.concat_ws(sep, *parts).alias("line")


def _labelled_sql(label):
    return f"""select l_orderkey, l_suppkey, {label} as label, l_quantity as f0, l_discount as f1, l_tax as f2, false as rejected
               from lineitem where l_suppkey % 10 <> 0
               union all select l_orderkey, l_suppkey, null, null, null, null, true from lineitem where l_suppkey % 10 = 0"""


def _labelled_rows(spark, sf_dir, line, **shape):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", line)
    keep = ["l_orderkey", "l_suppkey"]
    parsed, rejects = parse.parse_labelled(li, "line", keep=keep, **shape)
    good = parsed.select(*keep, "label", *[F.get("features", i).alias(f"f{i}") for i in range(3)], F.lit(False).alias("rejected"))
    none = [F.lit(None).cast("double").alias(c) for c in ("label", "f0", "f1", "f2")]
    return good.unionByName(rejects.select(*keep, *none, F.lit(True).alias("rejected")))


@query("parse_label_features", "S14 P08", _labelled_sql("l_linenumber::double"))
def q_parse_label_features(spark, sf_dir):
    """``label|f1 f2 ...``"""
    return _labelled_rows(spark, sf_dir, _labelled_lines("|", False, " "), sep=r"\|", label=0, feature_sep=" ")


@query("parse_label_last", "S14 P08", _labelled_sql("l_linenumber::double"))
def q_parse_label_last(spark, sf_dir):
    """``f1,f2,...,label``: the label is the last field."""
    return _labelled_rows(spark, sf_dir, _labelled_lines(",", True), sep=",", label=-1)


@query(
    "parse_label_tokens",
    "S14 P08 X01",
    "select doc_id, lang as label, regexp_split_to_array(regexp_replace(text, '[\\t\\n\\r\\\\]', ' ', 'g'), '[ ,]') as tokens from documents",
)
def q_parse_label_tokens(spark, sf_dir):
    """``label<TAB>text`` with tokens cut at commas and blanks."""
    flat = F.regexp_replace("text", r"[\t\n\r\\\\]", " ")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("\t", "lang", flat).alias("line"))
    parsed, _ = parse.parse_labelled(
        docs, "line", sep="\t", label=0, feature_sep="[ ,]", label_type="string", feature_type="string", out="tokens", keep=["doc_id"]
    )
    return parsed


@query(
    "cut_lineage",
    "K07 K06 S13",
    "select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus = 'O'",
)
def q_cut_lineage(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
    return sinks.cut_lineage(o.select("o_orderkey", "o_custkey", "o_totalprice"))
