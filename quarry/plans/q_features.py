"""Registered queries: text features and categorical / numeric feature encoding."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.operators import cooccurrence, hashing, text
from quarry.operators import features as fe
from quarry.plans.registry import query
from quarry.session import stored
from quarry.tables import read_table

# Extra (non-English) stop words of the custom list.
EXTRA_STOP_WORDS = ("le", "la", "les", "de", "des", "et", "der", "die", "das", "und", "el", "los", "que")
HASH_FEATURES = 1000

_WS = r"[ \t\n\x0B\f\r]"  # Java's \s
# Tokenizer in SQL: lower-case, JVM split on single whitespace (trailing empties dropped)
_TOKENS_SQL = rf"""case when lower(text) = '' then ['']
     when regexp_replace(lower(text), '{_WS}+$', '') = '' then []::varchar[]
     else regexp_split_to_array(regexp_replace(lower(text), '{_WS}+$', ''), '{_WS}') end"""
_REGEX_TOKENS_SQL = r"list_filter(regexp_split_to_array(lower(text), '\W'), lambda t: length(t) >= 1)"


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def _corpus_counts(df, col):
    # one row per term of a document, so its documents are counted, not told apart
    terms = fe.document_terms(df, "doc_id", F.col(col))
    return terms.groupBy(F.col("term").alias("token")).agg(F.sum("tf").alias("n"), F.count("doc_id").alias("n_docs"))


@query(
    "tokenize",
    "E01",
    f"""select token, count(*) as n, count(distinct doc_id) as n_docs from (
          select doc_id, unnest({_TOKENS_SQL}) as token from documents) group by token""",
)
def q_tokenize(spark, sf_dir):
    return _corpus_counts(fe.tokenize(_docs(spark, sf_dir), "text"), "tokens")


@query(
    "tokenize_regex",
    "E02",
    f"""select token, count(*) as n, count(distinct doc_id) as n_docs from (
          select doc_id, unnest({_REGEX_TOKENS_SQL}) as token from documents) group by token""",
)
def q_tokenize_regex(spark, sf_dir):
    return _corpus_counts(fe.tokenize_regex(_docs(spark, sf_dir), "text"), "tokens")


def _stop_sql(extra=()):
    words = fe.default_stop_words() + [w for w in extra if w not in fe.default_stop_words()]
    return f"""select token, count(*) as n, count(distinct doc_id) as n_docs from (
          select doc_id, unnest({_TOKENS_SQL}) as token from documents)
        where token not in ({_sql_list(words)}) group by token"""


@query("remove_stop_words", "E03", _stop_sql())
def q_remove_stop_words(spark, sf_dir):
    toks = fe.tokenize(_docs(spark, sf_dir), "text")
    return _corpus_counts(fe.remove_stop_words(toks, "tokens"), "filtered")


@query("remove_stop_words_custom", "E04", _stop_sql(EXTRA_STOP_WORDS))
def q_remove_stop_words_custom(spark, sf_dir):
    toks = fe.tokenize(_docs(spark, sf_dir), "text")
    return _corpus_counts(fe.remove_stop_words(toks, "tokens", extra=EXTRA_STOP_WORDS), "filtered")


@query(
    "ngrams",
    "E05",
    f"""select token, count(*) as n, count(distinct doc_id) as n_docs from (
          select doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) as token
          from (select doc_id, {_TOKENS_SQL} as t from documents)) group by token""",
)
def q_ngrams(spark, sf_dir):
    toks = fe.tokenize(_docs(spark, sf_dir), "text")
    return _corpus_counts(fe.ngrams(toks, "tokens", 2), "ngrams")


@query(
    "hashing_tf",
    "E06",
    f"""select doc_id, cast(len({_TOKENS_SQL}) as double) as total_tf, {HASH_FEATURES} as num_features
        from documents""",
)
def q_hashing_tf(spark, sf_dir):
    toks = fe.tokenize(_docs(spark, sf_dir), "text")
    arr = vector_to_array(F.col("tf"))
    return fe.hashing_tf(toks, "tokens", HASH_FEATURES).select(
        "doc_id",
        F.aggregate(arr, F.lit(0.0), lambda a, b: a + b).alias("total_tf"),
        F.size(arr).alias("num_features"),
    )


def _filtered_tf(spark, sf_dir):
    # built-in tokens (same rule as Tokenizer) + broadcast anti join on the stop words
    return fe.document_terms(_docs(spark, sf_dir), "doc_id", fe.whitespace_tokens("text"), fe.default_stop_words())


_TF_SQL = f"""with tf as (
  select doc_id, term, count(*) as tf from (
    select doc_id, unnest({_TOKENS_SQL}) as term from documents)
  where term not in ({_sql_list(fe.default_stop_words())}) group by doc_id, term)"""


@query("term_frequency", "E06 E09", _TF_SQL + " select doc_id, term, tf from tf")
def q_term_frequency(spark, sf_dir):
    return _filtered_tf(spark, sf_dir)


@query(
    "tf_idf",
    "E07",
    _TF_SQL
    + """, m as (select count(*) as m from documents),
  d as (select term, count(*) as doc_freq from tf group by term)
select doc_id, term, tf, doc_freq, round(tf * ln((m + 1.0) / (doc_freq + 1.0)), 6) as tfidf
from tf join d using (term), m""",
    check="T",
)
def q_tf_idf(spark, sf_dir):
    n_docs = _docs(spark, sf_dir).select(F.count(F.lit(1))).scalar()
    tf = stored(_filtered_tf(spark, sf_dir), "tf")  # texts are tokenised once, for tf and for df
    out = fe.tf_idf(tf, "doc_id", n_docs=n_docs)
    return out.select("doc_id", "term", "tf", "doc_freq", F.round("tfidf", 6).alias("tfidf"))


@query(
    "count_vectorize",
    "E09",
    _TF_SQL
    + """
select term, row_number() over (order by corpus_count desc, term) - 1 as term_index, corpus_count, doc_freq
from (select term, sum(tf)::bigint as corpus_count, count(*) as doc_freq from tf group by term)""",
)
def q_count_vectorize(spark, sf_dir):
    return fe.vocabulary(_filtered_tf(spark, sf_dir))


@query("word2vec", "E08")
def q_word2vec(spark, sf_dir):
    toks = fe.tokenize(_docs(spark, sf_dir), "text")
    model = fe.word2vec_model(toks, "tokens", size=3, min_count=0)
    arr = vector_to_array(F.col("w2v"))
    return model.transform(toks).select("doc_id", *[F.get(arr, i).alias(f"v{i}") for i in range(3)])


_INDEX_SQL = """
with p as (select o_orderpriority, cast(row_number() over (order by count(*) desc, o_orderpriority) - 1 as double)
                  as priority_idx from orders group by o_orderpriority),
     s as (select o_orderstatus, cast(row_number() over (order by count(*) desc, o_orderstatus) - 1 as double)
                  as status_idx from orders group by o_orderstatus)"""


def _indexed_orders(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    model = fe.string_indexer(["o_orderpriority", "o_orderstatus"], ["priority_idx", "status_idx"]).fit(o)
    return model, model.transform(o)


@query(
    "string_index",
    "E10",
    _INDEX_SQL + " select o_orderkey, priority_idx, status_idx from orders join p using (o_orderpriority) "
    "join s using (o_orderstatus)",
)
def q_string_index(spark, sf_dir):
    _, out = _indexed_orders(spark, sf_dir)
    return out.select("o_orderkey", "priority_idx", "status_idx")


@query(
    "index_to_string",
    "E11",
    _INDEX_SQL + " select o_orderkey, priority_idx, o_orderpriority as priority_back from orders "
    "join p using (o_orderpriority)",
)
def q_index_to_string(spark, sf_dir):
    model, out = _indexed_orders(spark, sf_dir)
    back = fe.index_to_string("priority_idx", "priority_back", model.labelsArray[0]).transform(out)
    return back.select("o_orderkey", "priority_idx", "priority_back")


@query(
    "one_hot",
    "E12",
    _INDEX_SQL + """ select o_orderkey, case when priority_idx < 4 then cast(priority_idx as integer) end as hot_slot,
                     4 as vec_size from orders join p using (o_orderpriority)""",
)
def q_one_hot(spark, sf_dir):
    _, out = _indexed_orders(spark, sf_dir)
    enc = fe.one_hot(["priority_idx"], ["priority_vec"]).fit(out).transform(out)
    arr = vector_to_array(F.col("priority_vec"))
    pos = F.array_position(arr, F.lit(1.0)).cast("int")
    return enc.select("o_orderkey", F.when(pos > 0, pos - 1).alias("hot_slot"), F.size(arr).alias("vec_size"))


@query(
    "assemble",
    "E13",
    "select p_partkey, cast(p_size as double) as f0, p_retailprice as f1 from part "
    "where p_size is not null and p_retailprice is not null",
)
def q_assemble(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    out = fe.assemble(["p_size", "p_retailprice"], handle_invalid="skip").transform(p)
    arr = vector_to_array(F.col("features"))
    return out.select("p_partkey", F.get(arr, 0).alias("f0"), F.get(arr, 1).alias("f1"))


@query(
    "binarize",
    "E16",
    """select l_orderkey, l_linenumber, l_discount,
              case when l_discount > 0.05 then 1.0 else 0.0 end as high_discount from lineitem""",
)
def q_binarize(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return fe.binarize(li, "l_discount", 0.05, "high_discount")


_Z_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _z_sql() -> str:
    stats = ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in _Z_COLS)
    zs = ", ".join(
        f"round(({c} - m_{c}) / (case when s_{c} is null or s_{c} = 0 then 1.0 else s_{c} end), 6) as z_{c}"
        for c in _Z_COLS
    )
    return f"with st as (select {stats} from lineitem) select l_orderkey, l_linenumber, {zs} from lineitem, st"


@query("standardize", "E14 A18", _z_sql(), check="T")
def q_standardize(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    z = fe.standardize(li, _Z_COLS)
    return z.select("l_orderkey", "l_linenumber", *[F.round(f"z_{c}", 6).alias(f"z_{c}") for c in _Z_COLS])


def _ctr_sql() -> str:
    cats = ["l_returnflag", "l_linestatus", "p_brand", "p_type"]
    # one-hot drops the last category: the rarest, of equally rare ones the last by name
    last = ", ".join(
        f"(select {c} from (select {c}, count(*) as n from df group by {c} order by n, {c} desc limit 1)) as last_{c}" for c in cats
    )
    size = " + ".join(f"(select count(distinct {c}) - 1 from df)" for c in cats)
    ones = " + ".join(f"({c} <> last_{c})::integer" for c in cats)
    return f"""
with df as (select l.*, p_brand, p_type from lineitem l join part on l_partkey = p_partkey),
k as (select ({size} + 2)::integer as vec_size, {last})
select l_orderkey, l_linenumber, vec_size, ({ones} + (l_quantity <> 0)::integer + (l_discount <> 0)::integer)::integer as nnz
from df, k"""


@query("ctr_features", "E15 M09", _ctr_sql())
def q_ctr_features(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    df = li.join(p, li.l_partkey == p.p_partkey)
    cats = ["l_returnflag", "l_linestatus", "p_brand", "p_type", "l_returnflag"]  # repeat is de-duplicated
    model = fe.categorical_pipeline(cats, ["l_quantity", "l_discount"]).fit(df)
    arr = vector_to_array(F.col("features"))
    return model.transform(df).select(
        "l_orderkey", "l_linenumber", F.size(arr).alias("vec_size"),
        F.size(F.filter(arr, lambda x: x != 0)).alias("nnz"),
    )


def _place_sql(name: str, width: int) -> str:
    return f"(('0x' || substr(md5({name}), 1, 12))::bigint % {width})::integer"


def _sign_sql(name: str) -> str:
    return f"case when ('0x' || substr(md5({name}), 13, 1))::integer % 2 = 1 then -1.0 else 1.0 end"


@query(
    "hashing_tf_sparse",
    "E06",
    f"""select doc_id, {_place_sql('term', hashing.WIDTH)} as index, count(*)::double as value
        from (select doc_id, unnest({_TOKENS_SQL}) as term from documents) group by 1, 2""",
)
def q_hashing_tf_sparse(spark, sf_dir):
    """Hashed term counts 500,000 wide, as the entries that are not zero."""
    found = hashing.hashed_tokens(fe.whitespace_tokens("text"))
    return _docs(spark, sf_dir).select("doc_id", F.inline(found))


_HASHED_CATS, _HASHED_NUMS = ("o_custkey", "o_orderstatus", "o_orderpriority"), ("o_totalprice",)


def _hashed_sql() -> str:
    cats = [(f"'{c}=' || {c}", "1.0", c) for c in _HASHED_CATS]
    nums = [(f"'{c}'", f"{c}::double", c) for c in _HASHED_NUMS]
    rows = " union all ".join(
        f"select o_orderkey, {_place_sql(name, hashing.WIDTH)} as index, {_sign_sql(name)} * {value} as value from orders where {c} is not null"
        for name, value, c in cats + nums
    )
    return f"select o_orderkey, index, sum(value) as value from ({rows}) group by 1, 2 having sum(value) <> 0"


@query("ctr_hashed", "E15 M09", _hashed_sql(), check="T")
def q_ctr_hashed(spark, sf_dir):
    """Signed hashing of categories of any width (here one value for each customer)."""
    return hashing.entries(read_table(spark, sf_dir, "orders"), ["o_orderkey"], _HASHED_CATS, _HASHED_NUMS)


# Places apart, shift, and steps of the co-occurrence factor.
_WINDOW, _SHIFT, _STEPS = 2, 2.0, 4

_PAIRS_SQL = f"""with tk as (select doc_id, {_TOKENS_SQL} as t from documents),
pl as (select doc_id, unnest(t) as w, generate_subscripts(t, 1) as i from tk),
pc as (select least(a.w, b.w) as u, greatest(a.w, b.w) as v, count(*) as n from pl a
       join pl b on b.doc_id = a.doc_id and b.i between a.i + 1 and a.i + {_WINDOW} group by 1, 2)"""


@query("pair_counts", "E08", _PAIRS_SQL + " select u, v, n from pc")
def q_pair_counts(spark, sf_dir):
    return cooccurrence.pair_counts(_docs(spark, sf_dir), fe.whitespace_tokens("text"), _WINDOW)


def _factor_sql() -> str:
    """One CTE a step of the power iteration with one direction."""
    start = "(('0x' || substr(md5('0|' || u), 1, 8))::bigint % 2001) / 1000.0 - 1.0"
    parts = [
        _PAIRS_SQL,
        """cs as (select u, v, case when u = v then 2 * n else n end as n from pc union all select v, u, n from pc where u <> v),
ma as (select u, sum(n) as a from cs group by u), tot as (select sum(a) as total from ma)""",
        f"""mi as materialized (select cs.u, cs.v, ln(cs.n::double * total / x.a / y.a) - ln({_SHIFT}) as value
       from cs join ma x on x.u = cs.u join ma y on y.u = cs.v, tot where ln(cs.n::double * total / x.a / y.a) - ln({_SHIFT}) > 0)""",
        f"r0 as (select u, ({start})::double as x from (select distinct u from mi))",
    ]
    for t in range(_STEPS + 1):
        parts.append(f"q{t} as materialized (select u, x / sqrt((select sum(x * x) from r{t})) as x from r{t})")
        parts.append(f"r{t + 1} as materialized (select mi.u, sum(value * x) as x from mi join q{t} q on q.u = mi.v group by mi.u)")
    parts.append(f"la as (select sqrt(abs(sum(q.x * r.x))) as s from q{_STEPS} q join r{_STEPS + 1} r on r.u = q.u)")
    return ",\n".join(parts) + f"""
select doc_id, count(*) as n, round(avg(x * s), 6) as weight from pl join q{_STEPS} q on q.u = pl.w, la group by doc_id"""


@query("document_word_weights", "E08 M06", _factor_sql(), check="T")
def q_document_word_weights(spark, sf_dir):
    """The mean over a document's words of their weight in the leading factor."""
    docs, tokens = _docs(spark, sf_dir), fe.whitespace_tokens("text")
    matrix = cooccurrence.mutual_information(cooccurrence.pair_counts(docs, tokens, _WINDOW), _SHIFT)
    vectors = cooccurrence.word_vectors(matrix, 1, _STEPS)
    means = cooccurrence.document_means(docs, "doc_id", tokens, vectors, 1)
    return means.select("doc_id", "n", F.round(F.get("x", 0), 6).alias("weight"))
