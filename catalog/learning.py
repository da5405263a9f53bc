"""Models, neighbours and evaluation."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from catalog.base import query, table
from catalog.relational import uniform_sql
from rillstone.functions import text as tx
from rillstone.operators import evaluate as ev
from rillstone.operators import modelchoice as mc
from rillstone.operators import models as md
from rillstone.operators import neighbors as nn
from rillstone.operators import termindex as ti
from rillstone.operators import textvec as tv
from rillstone.operators.select import split, with_split
from rillstone.session import in_parts, shared_folder, spread

LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
TWO = {"train": 0.7, "test": 0.3}


# ---------------------------------------------------------------- evaluation

_SCORED = "s as (select l.doc_id, quality, case when n_chars > 500 then 1 else 0 end as predicted from labels l join documents d on l.doc_id = d.doc_id)"


def scored_labels(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") > 500, 1).otherwise(0).alias("predicted"))
    return table(spark, sf, "labels").join(docs, "doc_id")


@query("confusion", f"""with {_SCORED} select a.c as label, b.c as prediction, count(s.doc_id) as count
    from (values (0), (1)) a(c) cross join (values (0), (1)) b(c) left join s on quality = a.c and predicted = b.c group by all""")
def confusion(spark, sf):
    return ev.confusion(scored_labels(spark, sf), "quality", "predicted")


@query("class_report", f"""with {_SCORED}, c as (
      select k.c as class, count(*) filter (where quality = k.c) as support, count(*) filter (where predicted = k.c) as predicted,
        count(*) filter (where quality = k.c and predicted = k.c) as hits from s, (values (0), (1)) k(c) group by k.c
    ), p as (select cast(class as varchar) as class, coalesce(hits / nullif(predicted, 0), 0.0) as precision, coalesce(hits / nullif(support, 0), 0.0) as recall,
      coalesce(2.0 * hits / nullif(predicted + support, 0), 0.0) as f1, support, hits from c),
    r as (select class, precision, recall, f1, support from p
      union all select 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) from p
      union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from p
      union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) from p)
    select class, round(precision, 8) as precision, round(recall, 8) as recall, round(f1, 8) as f1, cast(support as bigint) as support from r""")
def class_report(spark, sf):
    report = ev.class_report(scored_labels(spark, sf), "quality", "predicted")
    return report.withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


@query("accuracy", f"""with {_SCORED} select round(avg((quality = predicted)::int), 8) as accuracy,
    round(1 - avg((quality = predicted)::int), 8) as error_rate, count(*) as n from s""")
def accuracy(spark, sf):
    return ev.accuracy(scored_labels(spark, sf), "quality", "predicted").withColumns(
        {c: F.round(c, 8) for c in ("accuracy", "error_rate")})


@query("regression_metrics", """with e as (select l_returnflag, case when l_linenumber = 1 then 0 else l_extendedprice end as y, l_quantity * 1500 as p from lineitem)
    select l_returnflag, count(*) as n, round(avg(abs(y - p)), 3) as mae, round(avg((y - p) ** 2) / 1e6, 4) as mse_millions, round(sqrt(avg((y - p) ** 2)), 3) as rmse,
      round(avg(abs(y - p) / abs(y)) filter (where y <> 0), 6) as mape, count(*) filter (where y = 0) as zero_labels,
      round(1 - var_pop(y - p) / var_pop(y), 6) as explained_variance, round(1 - avg((y - p) ** 2) / var_pop(y), 6) as r2 from e group by l_returnflag""")
def regression_metrics(spark, sf):
    y = F.when(F.col("l_linenumber") == 1, 0.0).otherwise(F.col("l_extendedprice"))
    rows = table(spark, sf, "lineitem").select("l_returnflag", y.alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    m = ev.regression_metrics(rows, "y", "p", ["l_returnflag"])
    return m.select("l_returnflag", "n", F.round("mae", 3).alias("mae"), F.round(F.col("mse") / 1e6, 4).alias("mse_millions"),
                    F.round("rmse", 3).alias("rmse"), F.round("mape", 6).alias("mape"), "zero_labels",
                    F.round("explained_variance", 6).alias("explained_variance"), F.round("r2", 6).alias("r2"))


# ---------------------------------------------------------------- neighbours

def vector_split(spark, sf):
    parts = split(table(spark, sf, "embeddings"), TWO, ["vec_id"], seed=101)
    return parts["train"], parts["test"]


def neighbour_table(spark, sf, k):
    train, test = vector_split(spark, sf)
    return nn.nearest(train, test, "vec_id", "embedding", "label", k), test


_NEAR = f"""e as (select vec_id, label, embedding::double[] as v, {uniform_sql(101, 'vec_id')} < 0.7 as is_train from embeddings),
    near as (select q.vec_id, q.label as truth, t.label, row_number() over (partition by q.vec_id
      order by list_distance(q.v, t.v), t.vec_id) as rn from e q join e t on t.is_train and not q.is_train)"""


@query("knn_classify", f"""with {_NEAR} select vec_id, label as prediction from (select vec_id, label, row_number() over (
      partition by vec_id order by count(*) desc, label) as r from near where rn <= 15 group by vec_id, label) where r = 1""")
def knn_classify(spark, sf):
    neighbours, _ = neighbour_table(spark, sf, 15)
    return nn.vote(neighbours, "vec_id", "label", 15)


@query("knn_elbow", f"""with {_NEAR}, v as (select vec_id, truth, k, label, row_number() over (
      partition by vec_id, k order by count(*) desc, label) as r from near join range(1, 40) t(k) on rn <= k group by vec_id, truth, k, label)
    select cast(k as integer) as k, round(avg((label <> truth)::int), 8) as error_rate from v where r = 1 group by k""")
def knn_elbow(spark, sf):
    neighbours, test = neighbour_table(spark, sf, 39)
    return nn.error_by_k(neighbours, test, "vec_id", "label", 39).withColumn("error_rate", F.round("error_rate", 8))


# ---------------------------------------------------------------- linear models

_COV = """c as (select covar_pop(l_quantity, l_quantity) as s11, covar_pop(l_discount, l_discount) as s22, covar_pop(l_quantity, l_discount) as s12,
      covar_pop(l_quantity, l_extendedprice) as s1y, covar_pop(l_discount, l_extendedprice) as s2y, avg(l_quantity) as m1, avg(l_discount) as m2, avg(l_extendedprice) as my from lineitem),
    b as (select (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) as b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) as b2, m1, m2, my from c)"""


@query("linreg_coef", f"""with {_COV} select '(intercept)' as feature, round(my - b1 * m1 - b2 * m2, 2) as coefficient from b
    union all select 'l_quantity', round(b1, 2) from b union all select 'l_discount', round(b2, 2) from b""")
def linreg_coef(spark, sf):
    model = md.fit(table(spark, sf, "lineitem"), "linear_regression", ["l_quantity", "l_discount"], "l_extendedprice", solver="normal")
    return md.coefficients(spark, model, ["l_quantity", "l_discount"]).withColumn("coefficient", F.round("coefficient", 2))


@query("score_numeric", f"""with {_COV} select l_orderkey, l_linenumber, l_partkey, l_suppkey,
    round(my + b1 * (l_quantity - m1) + b2 * (l_discount - m2), 2) as predicted from lineitem, b""")
def score_numeric(spark, sf):
    """A fitted line applied as a vectorised function that each task loads once."""
    lines = table(spark, sf, "lineitem")
    fitted = md.fit(lines, "linear_regression", ["l_quantity", "l_discount"], "l_extendedprice", solver="normal").stages[-1]
    weights = np.append(fitted.coefficients.toArray(), fitted.intercept)
    score = md.scoring_udf(lambda: weights, lambda w, frame: frame.to_numpy(dtype=float) @ w[:-1] + w[-1])
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                        F.round(score("l_quantity", "l_discount"), 2).alias("predicted"))


# ---------------------------------------------------------------- classifiers and regressors
#
# The labels are rules over columns that any correct fit must find again, so SQL can state the predictions.

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
CODES = ["l_linenumber", "l_discount", "l_tax"]
STEPS = "case when l_linenumber >= 5 then 2 when l_discount >= 0.055 then 1 else 0 end"
CORNER = "case when l_linenumber >= 5 and l_discount >= 0.055 then 1 else 0 end"


def _held_out_lines(rule):
    return f"""select {', '.join(LINE_KEYS)}, {rule} as label, {rule} as prediction from lineitem
    where {uniform_sql(101, 'l_orderkey')} >= 0.7"""


def _line_predictions(spark, sf, name, rule, **params):
    """Predictions for held-out lines of a tree model that has to learn ``rule``."""
    lines = table(spark, sf, "lineitem").select(*LINE_KEYS, "l_discount", "l_tax", F.expr(rule).alias("label"))
    parts = split(lines, TWO, ["l_orderkey"], seed=101)
    model = md.fit_trees(parts["train"], name, CODES, "label", **params)
    return md.predict(model, parts["test"]).select(*LINE_KEYS, "label", F.col("prediction").cast("int").alias("prediction"))


@query("dtree_predict", _held_out_lines(STEPS))
def dtree_predict(spark, sf):
    return _line_predictions(spark, sf, "decision_tree", STEPS)


@query("rf_predict", _held_out_lines(STEPS))
def rf_predict(spark, sf):
    return _line_predictions(spark, sf, "random_forest", STEPS, numTrees=100)


@query("gbt_predict", _held_out_lines(CORNER))
def gbt_predict(spark, sf):
    return _line_predictions(spark, sf, "gradient_boosting", CORNER, maxIter=100)


BAND = "case when l_linenumber between 3 and 5 then 'inner' else 'outer' end"


@query("classify_auto", f"""select {', '.join(LINE_KEYS)}, {BAND} as label, {BAND} as predicted_class, 'decision_tree' as chosen
    from lineitem where {uniform_sql(101, 'l_orderkey')} >= 0.7""")
def classify_auto(spark, sf):
    """A band that no line can part: of three candidates the folds choose the tree."""
    lines = table(spark, sf, "lineitem").select(*LINE_KEYS, "l_discount", "l_tax", F.expr(BAND).alias("label"))
    parts = split(lines, TWO, ["l_orderkey"], seed=101)
    candidates = [mc.Candidate("logistic_regression"), mc.Candidate("linear_svm", {"maxIter": 10}), mc.Candidate("decision_tree")]
    choice = mc.choose(parts["train"], CODES, "label", LINE_KEYS, candidates)
    return choice.predict(parts["test"]).select(*LINE_KEYS, "label", "predicted_class", F.lit(choice.candidate.estimator).alias("chosen"))


_SIZES = "case when p_size <= 15 then 'small' when p_size <= 35 then 'middle' else 'large' end"


@query("gbt_classes", f"""select p_partkey, {_SIZES} as label, {_SIZES} as predicted_class, true as sure, 1.0::double as total from part
    where {uniform_sql(3, 'p_partkey')} >= 0.7""")
def gbt_classes(spark, sf):
    """Boosted trees for three classes, one against the rest, with a share for each class."""
    rows = table(spark, sf, "part").select("p_partkey", F.expr("p_size div 2").alias("half"), "p_retailprice", F.expr(_SIZES).alias("label"))
    parts = split(rows, TWO, ["p_partkey"], seed=3)
    boosted = [mc.Candidate("gradient_boosting", {"maxIter": 5, "maxDepth": 3})]
    choice = mc.choose(parts["train"], ["half", "p_retailprice"], "label", ["p_partkey"], boosted, folds=2)
    p = F.map_values("probability")
    total = F.round(F.aggregate(p, F.lit(0.0), lambda a, b: a + b), 6)
    return choice.probabilities(parts["test"]).select(
        "p_partkey", "label", "predicted_class", (F.array_max(p) > 0.5).alias("sure"), total.alias("total"))


GROUPS = 5
AXES = [f"x{i}" for i in range(GROUPS)]


def corner_points(spark, sf):
    """Customers near one of five corners, by nation; the balance moves them a little along every axis."""
    label = F.col("c_nationkey") % GROUPS
    return table(spark, sf, "customer").select("c_custkey", label.alias("label"), *[
        (F.when(label == i, 10.0).otherwise(0.0) + F.col("c_acctbal") / 10000.0 * (i + 1) / GROUPS).alias(AXES[i])
        for i in range(GROUPS)])


_HELD_OUT_CUSTOMERS = f"""select c_custkey, c_nationkey % {GROUPS} as label, c_nationkey % {GROUPS} as prediction from customer
    where {uniform_sql(101, 'c_custkey')} >= 0.7"""


def _corner_predictions(spark, sf, name, **params):
    parts = split(corner_points(spark, sf), TWO, ["c_custkey"], seed=101)
    model = md.fit(in_parts(parts["train"], 250_000), name, AXES, "label", **params)
    return md.predict(model, parts["test"]).select("c_custkey", "label", F.col("prediction").cast("int").alias("prediction"))


@query("logreg_predict", _HELD_OUT_CUSTOMERS)
def logreg_predict(spark, sf):
    return _corner_predictions(spark, sf, "logistic_regression", regParam=0.01)


@query("svm_classes", _HELD_OUT_CUSTOMERS)
def svm_classes(spark, sf):
    """A linear machine per class against the rest."""
    return _corner_predictions(spark, sf, "linear_svm_classes", maxIter=100, regParam=0.01, tol=0.0001)


def corner_clusters(spark, sf):
    rows = corner_points(spark, sf)
    return md.predict(md.fit(rows, "k_means", AXES, k=GROUPS), rows).select("c_custkey", "label", "prediction")


@query("kmeans_assign", f"""select c_custkey, c_nationkey % {GROUPS} as label,
    min(c_custkey) over (partition by c_nationkey % {GROUPS}) as cluster from customer""")
def kmeans_assign(spark, sf):
    """Clusters are named by their smallest key, as their numbers mean nothing."""
    rows = corner_clusters(spark, sf)
    names = rows.groupBy("prediction").agg(F.min("c_custkey").alias("cluster"))
    return rows.join(names, "prediction").select("c_custkey", "label", "cluster")


@query("cluster_agreement", f"""select a.c::integer as label, b.c::integer as prediction, count(c_custkey) as count
    from range({GROUPS}) a(c) cross join range({GROUPS}) b(c)
    left join customer on c_nationkey % {GROUPS} = a.c and a.c = b.c group by all""")
def cluster_agreement(spark, sf):
    return ev.cluster_agreement(corner_clusters(spark, sf), "prediction", "label")


@query("svm_rff", f"""select p_partkey, (p_size <= 25)::integer as inner_ring, (p_size <= 25)::integer as prediction from part
    where {uniform_sql(101, 'p_partkey')} >= 0.7""")
def svm_rff(spark, sf):
    """RBF-kernel classifier: random Fourier features under a linear machine, on two rings no line can part."""
    radius = F.when(F.col("p_size") <= 25, 1.0).otherwise(3.0)
    rows = table(spark, sf, "part").select(
        "p_partkey", (F.col("p_size") <= 25).cast("int").alias("inner_ring"),
        F.array(radius * F.cos("p_partkey"), radius * F.sin("p_partkey")).alias("point"))
    mapped = md.random_fourier_features(in_parts(rows, 25_000), "point", 2, gamma=0.5)
    parts = split(mapped, TWO, ["p_partkey"], seed=101)
    model = md.fit_vectors(parts["train"], "linear_svm", "inner_ring", regParam=0.001, maxIter=100)
    return model.transform(parts["test"]).select("p_partkey", "inner_ring", F.col("prediction").cast("int").alias("prediction"))


@query("rf_regress", f"""select p_partkey, (p_size - 1) // 10 as band, (p_size - 1) // 10 as prediction from part
    where {uniform_sql(0, 'p_partkey')} >= 0.9""")
def rf_regress(spark, sf):
    """A price that depends on the size band alone, next to the one-hot type and brand; every tree sees all features."""
    band = F.expr("cast((p_size - 1) div 10 as int)")
    rows = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand", band.alias("band"), (band * 1000.0).alias("price"))
    parts = split(rows, {"train": 0.9, "test": 0.1}, ["p_partkey"], seed=0)
    model = md.fit_mixed(in_parts(parts["train"], 25_000), "forest_regression", ["band"], ["p_type", "p_brand"], "price",
                         numTrees=100, featureSubsetStrategy="all")
    return model.transform(parts["test"]).select("p_partkey", "band", F.round(F.col("prediction") / 1000).cast("int").alias("prediction"))


_GAPS = ["case when p_size > 40 then null else p_retailprice end as price", "case when p_size < 5 then null else p_brand end as brand"]


@query("stored_pipeline", f"""with p as (select p_partkey, p_size, {', '.join(_GAPS)}, {uniform_sql(0, 'p_partkey')} < 0.9 as is_train from part),
    m as (select median(price) as price, median(p_size) as size from p where is_train),
    f as (select p.*, coalesce(p.price, m.price) as filled from p, m),
    s as (select avg(filled) as pm, stddev_pop(filled) as pd, avg(p_size) as sm, stddev_pop(p_size) as sd from f where is_train),
    b as (select brand from p where is_train and brand is not null group by brand order by count(*) desc, brand limit 1)
    select p_partkey, round((filled - pm) / pd, 6) as price_scaled, round((p_size - sm) / sd, 6) as size_scaled,
      coalesce(f.brand, b.brand) as brand_filled from f, s, b where not is_train""")
def stored_pipeline(spark, sf):
    """Exact median, population deviation and most frequent text, fitted on one part, stored, loaded, applied to the other."""
    rows = table(spark, sf, "part").selectExpr("p_partkey", "p_size", *_GAPS)
    parts = split(rows, {"train": 0.9, "test": 0.1}, ["p_partkey"], seed=0)
    numbers = ["price", "p_size"]
    path = f"{shared_folder(spark)}/models/{uuid.uuid4().hex}"
    Pipeline(stages=md.preprocessing(numbers, ["brand"])).fit(parts["train"]).write().save(path)
    return PipelineModel.load(path).transform(parts["test"]).select(
        "p_partkey", F.round("price__s", 6).alias("price_scaled"), F.round("p_size__s", 6).alias("size_scaled"),
        F.col("brand__t").alias("brand_filled"))


_MAIN = " union all ".join(
    f"select '{c}' as feature, abs(corr({c}, (l_discount >= 0.055)::integer)) > 0.5 as main from lineitem" for c in LINE_FEATURES)


@query("feature_importance", _MAIN)
def feature_importance(spark, sf):
    """Which feature carries over half of the importance, for a label that depends on one of them."""
    rows = table(spark, sf, "lineitem").select(*LINE_FEATURES, (F.col("l_discount") >= 0.055).cast("int").alias("reduced"))
    model = md.fit_trees(rows, "random_forest", LINE_FEATURES, "reduced", numTrees=100)
    return md.feature_importance(spark, model, LINE_FEATURES).select("feature", (F.col("importance") > 0.5).alias("main"))


ERA = "case when year(o_orderdate) <= 1996 then 'early' when year(o_orderdate) <= 1999 then 'middle' else 'late' end"


@query("classify_proba", f"""select o_orderkey, {ERA} as predicted_class, true as sure, 1.0::double as total from orders
    where {uniform_sql(1, 'o_orderkey')} >= 0.95""")
def classify_proba(spark, sf):
    """Class and probabilities for orders left out of the fit."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", (F.year("o_orderdate") - 1998).alias("year"), F.expr(ERA).alias("era"))
    parts = split(orders, {"train": 0.95, "infer": 0.05}, ["o_orderkey"], seed=1)
    scored = md.class_probabilities(parts["train"], parts["infer"], ["o_totalprice", "year"], "era")
    p = F.map_values("probability")
    total = F.round(F.aggregate(p, F.lit(0.0), lambda a, b: a + b), 6)
    return scored.select("o_orderkey", "predicted_class", (F.array_max(p) > 0.5).alias("sure"), total.alias("total"))


# ---------------------------------------------------------------- text models

def labelled_documents(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text")).join(table(spark, sf, "labels"), "doc_id")
    return with_split(docs, TWO, ["doc_id"], seed=5)


_NB = rf"""d as (select d.doc_id, quality, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') as t, {uniform_sql(5, 'd.doc_id')} < 0.7 as is_train
      from documents d join labels l on d.doc_id = l.doc_id),
    bag as (select doc_id, quality, is_train, term, count(*) as n from (select doc_id, quality, is_train, unnest(t) as term from d) group by all),
    vocab as (select distinct term from bag where is_train),
    prior as (select quality, ln(count(*) / (select count(*) from d where is_train)) as lp from d where is_train group by quality),
    total as (select p.quality, coalesce(sum(n), 0) as c from prior p left join bag b on b.quality = p.quality and is_train group by p.quality),
    cond as (select v.term, t.quality, ln((coalesce(sum(n), 0) + 1.0) / (c + (select count(*) from vocab))) as lp
      from vocab v cross join total t left join bag b on b.term = v.term and b.quality = t.quality and b.is_train group by v.term, t.quality, c),
    s as (select b.doc_id, c.quality, sum(n * lp) as score from bag b join cond c on c.term = b.term where not is_train group by all),
    f as (select d.doc_id, p.quality, coalesce(score, 0) + lp as score from d cross join prior p left join s on s.doc_id = d.doc_id and s.quality = p.quality where not is_train)"""


@query("nb_text", f"with {_NB} select doc_id, arg_max(quality, (score, -quality)) as prediction from f group by doc_id")
def nb_text(spark, sf):
    docs = labelled_documents(spark, sf)
    train, test = docs.filter("grp = 'train'"), docs.filter("grp = 'test'")
    model = tv.NaiveBayes.fit(tv.bag_of_words(train, "doc_id", tx.tokens("text")), train, "doc_id", "quality")
    return model.predict(test, tv.bag_of_words(test, "doc_id", tx.tokens("text")), "doc_id")


WORDS, HALF = 400, 200  # parts are named by words, each in a few texts of a thousand; the first half of the words is one class
_WORD = f"l_partkey % {WORDS}"


def part_texts(spark, sf):
    """A text for each order and half of the words, with a word for each of its lines; split by order."""
    lines = table(spark, sf, "lineitem").withColumn("word", F.expr(_WORD))
    words = F.transform(F.sort_array(F.collect_list("word")), lambda w: F.concat(F.lit("part"), w.cast("string")))
    texts = lines.groupBy("l_orderkey", (F.col("word") < HALF).cast("int").alias("label")).agg(F.array_join(words, " ").alias("text"))
    return split(texts, TWO, ["l_orderkey"], seed=7)


def _text_svm(spark, sf):
    """Held-out texts, scored by a linear machine that left out no term but the common ones."""
    parts = part_texts(spark, sf)
    model = ti.TextClassifier.fit(parts["train"], "text", "label", regParam=0.001, maxIter=60, tol=0.0001)
    return model.transform(parts["test"]).select("l_orderkey", "label", F.col("prediction").cast("int").alias("prediction"))


_TEXTS = f"(select distinct l_orderkey, ({_WORD} < {HALF})::integer as label from lineitem where {uniform_sql(7, 'l_orderkey')} >= 0.7)"


@query("svm_linear", f"select l_orderkey, label, label as prediction from {_TEXTS}")
def svm_linear(spark, sf):
    return _text_svm(spark, sf)


@query("score_text", f"select l_orderkey, 1 - label as recorded, label as prediction from {_TEXTS} where l_orderkey % 10 = 3")
def score_text(spark, sf):
    """Texts whose score disagrees with a recorded label that is wrong for some orders."""
    scored = _text_svm(spark, sf)
    recorded = F.when(F.col("l_orderkey") % 10 == 3, 1 - F.col("label")).otherwise(F.col("label"))
    return ev.mismatches(scored.withColumn("recorded", recorded), "recorded", "prediction").select("l_orderkey", "recorded", "prediction")


@query("svm_documents", f"""select coalesce((lang = 'de')::integer, 0) as german, count(*) as texts, true as mostly_right from documents
    where {uniform_sql(5, 'doc_id')} >= 0.7 group by all""")
def svm_documents(spark, sf):
    """Held-out documents: rare words and word pairs alone tell most German texts from the others."""
    docs = table(spark, sf, "documents").select("doc_id", "text", F.coalesce((F.col("lang") == "de").cast("int"), F.lit(0)).alias("german"))
    parts = split(spread(docs), TWO, ["doc_id"], seed=5)
    model = ti.TextClassifier.fit(parts["train"], "text", "german", min_docs=2, regParam=0.01, maxIter=60, tol=0.001)
    right = F.avg((F.col("prediction") == F.col("german")).cast("int"))
    return model.transform(parts["test"]).groupBy("german").agg(F.count(F.lit(1)).alias("texts"), (right > 0.5).alias("mostly_right"))


_TERMS = r"list_distinct(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])))"


@query("term_index", rf"""with d as (select doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_'']+[\p{{L}}\p{{N}}_]') as w from documents where text is not null),
    t as (select doc_id, unnest({_TERMS}) as term from d),
    c as (select term, count(*) as docs from t group by term having count(*) >= 2 and count(*) <= (select count(*) from documents) * 0.02),
    i as (select term, docs, row_number() over (order by term) - 1 as code from c)
    select t.doc_id, count(*) as terms, min(code) as first_code, max(code) as last_code, cast(sum(docs) as bigint) as docs from t join i using (term) group by t.doc_id""")
def term_index(spark, sf):
    """Each document's terms by their numbers in the index, the common ones left out."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    terms, held = ti.text_terms("text"), ti.text_postings(docs, "text", "doc_id")
    index = ti.term_index(docs, terms, min_docs=2, held=held)
    codes = ti.coded(docs, terms, index, "doc_id", "docs", held=held)
    return codes.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("terms"), F.min("code").alias("first_code"), F.max("code").alias("last_code"), F.sum("docs").alias("docs"))
