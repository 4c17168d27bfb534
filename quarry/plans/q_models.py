"""Registered queries: models, tuning, inspection."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IndexToString, Tokenizer, VectorAssembler, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from quarry.functions.sampling import hash_split_sql
from quarry.operators import features as fe
from quarry.operators import lda, models, sgd, term_logistic
from quarry.plans.q_features import _TF_SQL
from quarry.plans.registry import query
from quarry.session import stored
from quarry.tables import read_table

# Model parameters as stated for each program.
SGD_ITERATIONS = 50
SGD_STEP = 1.0
LR_ELASTIC = dict(max_iter=50, reg=0.01, elastic=0.01)
MLP_LAYERS = [100, 6, 5, 2]
MLP_WORD2VEC_PARTITIONS = 8
LDA_CONCENTRATION = 3.0
SWEEP_SEEDS = (1, 2, 3)


def _embeddings(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id",
        (F.col("label") < 5).cast("double").alias("label"),
        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
    )


def _labelled_docs(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id")


def _sgd_sql() -> str:
    """One chained step per iteration: gradient sums over the rows at the weights so far."""
    steps = [
        """with e as (select case when event_type = 'purchase' then 1.0 else 0.0 end as y, value / 100 as x1,
                             cast(json_extract(props, '$.k') as double) / 100 as x2 from events),
w0 as (select 0.0::double as a, 0.0::double as b)"""
    ]
    for t in range(1, SGD_ITERATIONS + 1):
        steps.append(
            f"""w{t} as materialized (
  select any_value(a) - {SGD_STEP} / sqrt({t}) * sum(err * x1) / count(*) as a,
         any_value(b) - {SGD_STEP} / sqrt({t}) * sum(err * x2) / count(*) as b
  from (select e.*, a, b, 1 / (1 + exp(-(a * x1 + b * x2))) - y as err from e, w{t - 1}))"""
        )
    rows = " union all ".join(
        f"select {t}::integer as iteration, round(a, 8) as w_x1, round(b, 8) as w_x2 from w{t}" for t in range(1, SGD_ITERATIONS + 1)
    )
    return ",\n".join(steps) + "\n" + rows


@query("logistic_sgd", "M01 R06", _sgd_sql(), check="T")
def q_logistic_sgd(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    df = ev.select(
        (F.col("event_type") == "purchase").cast("double").alias("y"),
        (F.col("value") / 100).alias("x1"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("x2"),
    ).persist()
    try:
        hist = sgd.sgd_steps(df, ["x1", "x2"], "y", [0.0, 0.0], SGD_ITERATIONS, SGD_STEP, loss="logistic")
    finally:
        df.unpersist()
    rows = [(i + 1, round(w[0], 8), round(w[1], 8)) for i, w in enumerate(hist)]
    return spark.createDataFrame(rows, "iteration int, w_x1 double, w_x2 double")


@query("logistic_elastic", "M02 M10")
def q_logistic_elastic(spark, sf_dir):
    train, test = models.hash_split(_embeddings(spark, sf_dir), "vec_id", 0.7, 777)
    model = models.logistic(**LR_ELASTIC).fit(train)
    p1 = F.get(vector_to_array("probability"), 1)
    return model.transform(test).select("vec_id", "label", "prediction", F.round(p1, 6).alias("p1"))


@query("training_history", "V01")
def q_training_history(spark, sf_dir):
    train, _ = models.hash_split(_embeddings(spark, sf_dir), "vec_id", 0.7, 777)
    return models.objective_history(spark, models.logistic(**LR_ELASTIC).fit(train))


def _tokens(docs):
    toks = fe.tokenize(docs, "text")
    return fe.remove_stop_words(toks, "tokens")


@query("text_classify_lr", "M03 M09")
def q_text_classify_lr(spark, sf_dir):
    docs = _tokens(_labelled_docs(spark, sf_dir).withColumn("label", F.col("quality").cast("double")))
    train, test = models.hash_split(docs, "doc_id", 0.7, 777)
    model = term_logistic.fit(train, "filtered", "label")  # on the vocabulary of the training part, whole
    return model.scored(test, "filtered", ["doc_id", "label"]).select("doc_id", "label", "prediction")


@query(
    "linear_ols",
    "M04",
    """select l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) as slope,
              round(regr_intercept(l_extendedprice, l_quantity), 6) as intercept,
              round(regr_r2(l_extendedprice, l_quantity), 6) as r2, regr_count(l_extendedprice, l_quantity) as n
       from lineitem group by l_returnflag""",
    check="T",
)
def q_linear_ols(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    return li.groupBy("l_returnflag").agg(
        F.round(F.regr_slope(y, x), 6).alias("slope"),
        F.round(F.regr_intercept(y, x), 6).alias("intercept"),
        F.round(F.regr_r2(y, x), 6).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def _nb_sql() -> str:
    return _TF_SQL + f""",
lab as (select l.doc_id, l.quality, {hash_split_sql('l.doc_id', 777, 0.7)} as train
        from labels l join documents d using (doc_id)),
tr as (select doc_id, term, tf, quality from tf join lab using (doc_id) where train),
m as (select count(*) as m from lab where train),
idf as (select term, ln((m + 1.0) / (count(*) + 1.0)) as idf from tr, m group by term, m),
lt as (select doc_id, term, tf * idf as w, quality from tr join idf using (term)),
te as (select doc_id, term, tf * idf as w from tf join lab using (doc_id) join idf using (term) where not train),
v as (select count(distinct term) as v from lt),
cls as (select quality, count(*) as n_c from lab where train group by quality),
ct as (select quality, sum(w) as big_n from lt group by quality),
pt as (select term, coalesce(sum(w) filter (where quality = 0), 0) as a0,
              coalesce(sum(w) filter (where quality = 1), 0) as a1 from lt group by term),
ds as (select doc_id, sum(w * ln(a0 + 1.0)) as s0, sum(w * ln(a1 + 1.0)) as s1, sum(w) as tot
       from te join pt using (term) group by doc_id),
k as (select
        (select ln(n_c + 1.0) from cls where quality = 0) - (select ln(m + 2.0) from m) as pi0,
        (select ln(n_c + 1.0) from cls where quality = 1) - (select ln(m + 2.0) from m) as pi1,
        (select ln(coalesce(big_n, 0) + 1.0 * (select v from v)) from ct where quality = 0) as d0,
        (select ln(coalesce(big_n, 0) + 1.0 * (select v from v)) from ct where quality = 1) as d1),
sc as (select lab.doc_id, lab.quality,
              pi0 + coalesce(s0, 0.0) - coalesce(tot, 0) * d0 as score_0,
              pi1 + coalesce(s1, 0.0) - coalesce(tot, 0) * d1 as score_1
       from lab left join ds using (doc_id), k where not train)
select doc_id, quality, case when score_1 > score_0 then 1 else 0 end as prediction,
       round(score_1 - score_0, 4) as margin from sc"""


@query("naive_bayes", "M05", _nb_sql(), check="T")
def q_naive_bayes(spark, sf_dir):
    """TF-IDF weights and classes from the training split, scores of the other split."""
    docs = _labelled_docs(spark, sf_dir).select("doc_id", "text", "quality")
    terms = fe.document_terms(docs, "doc_id", fe.whitespace_tokens("text"), fe.default_stop_words())
    tf = stored(terms, "tf")  # tokenised once
    train_docs, test_docs = models.hash_split(docs.select("doc_id", "quality"), "doc_id", 0.7, 777)
    train = tf.join(train_docs.select("doc_id"), "doc_id", "left_semi")
    weighted = fe.tf_idf(train, "doc_id", train_docs.select(F.count(F.lit(1))).scalar())
    weighted = stored(weighted, "weighted")
    idf = weighted.groupBy("term").agg(F.max("idf").alias("idf"))
    test = tf.join(test_docs.select("doc_id"), "doc_id", "left_semi").join(idf, "term")
    test = test.select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("tfidf"))
    out = models.naive_bayes_fit_score(
        weighted, train_docs, test, test_docs, "doc_id", "quality", [0, 1], smoothing=1.0, value="tfidf"
    )
    return out.select("doc_id", "quality", "prediction", F.round(F.col("score_1") - F.col("score_0"), 4).alias("margin"))


@query("spam_mlp", "M06 M09 E08 E10 E11")
def q_spam_mlp(spark, sf_dir):
    docs = _labelled_docs(spark, sf_dir).withColumn("toxic_s", F.col("toxic").cast("string"))
    train, test = models.hash_split(docs, "doc_id", 0.7, 1234)
    indexer = fe.string_indexer(["toxic_s"], ["label"], handle_invalid="keep").fit(train)
    pipe = Pipeline(stages=[
        indexer,
        Tokenizer(inputCol="text", outputCol="tokens"),
        Word2Vec(inputCol="tokens", outputCol="features", vectorSize=MLP_LAYERS[0], minCount=1, maxIter=1,
                 seed=1234, numPartitions=MLP_WORD2VEC_PARTITIONS),
        MultilayerPerceptronClassifier(layers=MLP_LAYERS, blockSize=512, seed=1234, maxIter=128),
        IndexToString(inputCol="prediction", outputCol="predicted_toxic", labels=indexer.labelsArray[0]),
    ])
    return pipe.fit(train).transform(test).select("doc_id", "toxic_s", "predicted_toxic")


def _z_lineitem(spark, sf_dir):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    z = fe.standardize(read_table(spark, sf_dir, "lineitem"), cols)
    return VectorAssembler(inputCols=[f"z_{c}" for c in cols], outputCol="features").transform(z)


@query("kmeans", "M07")
def q_kmeans(spark, sf_dir):
    model = KMeans(k=3, seed=1, maxIter=20).fit(_z_lineitem(spark, sf_dir))
    pred = model.transform(_z_lineitem(spark, sf_dir))
    return pred.groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))


def _topics(spark, sf_dir):
    """Blocks of all documents and their three topics."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = lda.blocks(_tokens(docs), "doc_id", "filtered")
    return held, lda.fit(held, 5, [LDA_CONCENTRATION] * 3, LDA_CONCENTRATION)


@query("lda_topics", "M08")
def q_lda_topics(spark, sf_dir):
    """Topic terms; every iteration sees every document."""
    _, topics = _topics(spark, sf_dir)
    rows = spark.createDataFrame(topics.described(5), "topic int, rank int, term string, weight double")
    return rows.select("topic", "rank", "term", F.round("weight", 6).alias("weight"))


@query("lda_doc_topics", "M08")
def q_lda_doc_topics(spark, sf_dir):
    """The topic distribution of every document."""
    held, topics = _topics(spark, sf_dir)
    return topics.shares(held).select(F.col("id").alias("doc_id"), *[F.get("shares", i).alias(f"topic_{i}") for i in range(3)])


@query("lda_sweep", "M16 V13")
def q_lda_sweep(spark, sf_dir):
    """Fit quality on held-out documents by number of iterations."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    train, test = models.hash_split(_tokens(docs), "doc_id", 0.7, 777)
    vectoriser = fe.count_vectorizer_model(train, "filtered")
    fit_on = vectoriser.transform(train).select("counts").persist()
    held = vectoriser.transform(test).select("counts").persist()
    rows = models.lda_sweep(fit_on, held, doc_concentration=[LDA_CONCENTRATION] * 3, topic_concentration=LDA_CONCENTRATION)
    fit_on.unpersist()
    held.unpersist()
    return spark.createDataFrame(rows, "iterations int, log_likelihood double, log_perplexity double")


@query("cross_validate", "M13 V12")
def q_cross_validate(spark, sf_dir):
    lr = models.logistic(max_iter=20)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1, 1.0]).addGrid(lr.elasticNetParam, [0.0, 0.5]).build()
    folded = models.hash_folds(_embeddings(spark, sf_dir), "vec_id", folds=2, seed=42)
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(),
                        numFolds=2, foldCol="fold", parallelism=4)
    fitted = cv.fit(folded)
    rows = [(float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(m)) for p, m in zip(grid, fitted.avgMetrics)]
    return spark.createDataFrame(rows, "reg_param double, elastic_net double, avg_auc double")


def _sweep_sql() -> str:
    """Every smoothing value and split scored directly from the class sums of its terms."""
    splits = " union all ".join(
        f"select doc_id, quality, {seed} as seed, {hash_split_sql('doc_id', seed, 0.7)} as train from lab" for seed in SWEEP_SEEDS
    )
    return _TF_SQL + f""",
lab as (select l.doc_id, l.quality from labels l join documents d using (doc_id)),
sp as ({splits}),
pt as (select seed, term, coalesce(sum(tf) filter (where quality = 0), 0) as n0, coalesce(sum(tf) filter (where quality = 1), 0) as n1
       from tf join sp using (doc_id) where train group by seed, term),
sz as (select seed, count(*) as v, sum(n0) as t0, sum(n1) as t1 from pt group by seed),
dc as (select seed, count(*) filter (where quality = 0) as d0, count(*) filter (where quality = 1) as d1 from sp where train group by seed),
ls as (select round(i * 0.01, 2)::double as x from range(1, 101) r(i)),
te as (select seed, doc_id, quality, tf, n0, n1 from sp join tf using (doc_id) join pt using (seed, term) where not train),
sc as (select seed, doc_id, x, sum(tf * (ln(n1 + x) - ln(n0 + x))) as g, sum(tf) as len from te, ls group by seed, doc_id, x),
ac as (select x, seed, avg(case when (ln(d1 + x) - ln(d0 + x) + coalesce(g, 0) - coalesce(len, 0) * (ln(t1 + x * v) - ln(t0 + x * v)) > 0)
                                     = (quality = 1) then 1.0 else 0.0 end) as accuracy
       from (select * from sp, ls where not train) left join sc using (seed, doc_id, x) join sz using (seed) join dc using (seed) group by x, seed)
select x as smoothing, round(avg(accuracy), 9) as mean_accuracy from ac group by x"""


@query("nb_smoothing_sweep", "M15 A20 T10", _sweep_sql(), check="T")
def q_nb_smoothing_sweep(spark, sf_dir):
    """Mean accuracy of every smoothing value over three splits; vocabularies come from the
    training parts."""
    docs = _labelled_docs(spark, sf_dir).select("doc_id", "text", "quality")
    terms = fe.document_terms(docs, "doc_id", fe.whitespace_tokens("text"), fe.default_stop_words())
    tf = stored(terms, "tf")  # tokenised once
    trials = models.naive_bayes_sweep(tf, docs.select("doc_id", "quality"), "doc_id", "quality", models.SMOOTHING_GRID, SWEEP_SEEDS)
    mean = trials.groupBy("smoothing").agg(F.round(F.avg("accuracy"), 9).alias("mean_accuracy"))
    return mean.orderBy(F.desc("mean_accuracy"), "smoothing")


@query("ctr_gbt", "M17")
def q_ctr_gbt(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    df = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand", "p_type", "l_quantity", "l_discount", "l_tax",
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("row_key"),
    )
    train, test = models.hash_split(df, "row_key", 0.7, 777)
    pipe = fe.categorical_pipeline(["p_brand", "p_type"], ["l_quantity", "l_discount", "l_tax"])
    pipe.getStages()[0].setHandleInvalid("keep")
    full = Pipeline(stages=[*pipe.getStages(), GBTClassifier(maxIter=10, maxDepth=4, seed=42)])
    fitted = full.fit(models.in_bounded_parts(train, "row_key"))
    return fitted.transform(test).select("l_orderkey", "l_linenumber", "label", "prediction")
