"""Registry of runnable queries (one per operator id of the blueprint) and the
DuckDB SQL each is checked against.  Every query scans the given tables in
full; float outputs are rounded to 6 digits on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sqltext as Q
from .functions.clip import clip_both, clip_upper
from .functions.text import contains_text, fill_text, nan_text, normalise, pack, unpack, words
from .functions.vecmath import cosine, to_double_array
from .models import ensemble as EN
from .models import gradient as GR
from .models import linear as LN
from .models import trees as TR
from .models.assemble import assemble
from .models.cv import DEPTHS, Folds, ScoreTable, Spec, run_folds
from .models.linear import ols
from .models.packed import BootstrapForest, ForestDepths
from .operators.attributes import aggregate_attributes
from .operators.columns import drop_columns, keep_columns
from .operators.joins import left_join, union_all
from .operators.knn import K_NEIGHBOURS, KNNRegressor, knn_join, knn_lsh, knn_regress
from .operators.metrics import r2, rmse, scoreboard
from .operators.order import assign_folds, best_of, peek, row_index
from .operators.tfidf import (bag_of_words, corpus_text, idf_table, product_weights_of_pairs, tfidf_cosines,
                              tfidf_weights)
from .operators.vectors import (VECTOR_SIZE, mean_vectors, sentence_tokens, text_vectors,
                                train_word2vec, vector_table)
from .plans.features import (ATTR8, ATTR15, DESC6, DESC7, LR3, attr8_features, attr15_features,
                             attr_base, attr_edit_ratios, attr_overlap, desc7_features,
                             lr3_features, stemmed_inputs)
from .plans.runner import read_predictions, run_models, specs
from .plans.scoring import CLIPS, fit_and_score
from .session import scratch_path
from .sources.csvio import (csv_roundtrip, read_csv, read_csv_inferred, read_side_table, stage,
                            staged_by_key, write_csv, write_predictions)
from .sources.relevance import (attr_side_tables, attributes, pairs, product_descriptions,
                                source_brands, test_pairs, train_pairs)
from .sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def r6(c) -> "F.Column":
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """E3 end to end: pairs -> F2 -> J1 -> overlap features -> M1 -> OLS -> P12."""
    feats = lr3_features(pairs(spark, sf), product_descriptions(spark, sf), stem=True)
    _, pred = fit_and_score(ols(), feats, LR3, clip="both")
    return pred


register("E3_ols_predictions")(flagship)


@register("J1_pairs_with_description", f"""WITH {Q.PAIRS_CTE}
SELECT p.*, d.product_description FROM pairs p LEFT JOIN descs d USING (product_uid)""")
def q_j1(spark, sf):
    return left_join(pairs(spark, sf), product_descriptions(spark, sf))


@register("A1_attribute_text", f"""WITH {Q.PAIRS_CTE} SELECT * FROM attr_text""")
def q_a1(spark, sf):
    return aggregate_attributes(attributes(spark, sf))


@register("F4b_lr3_features", f"""WITH {Q.PAIRS_CTE}
SELECT p.id, p.product_uid, p.relevance,
       {Q.word_count('p.search_term')} AS query_len,
       {Q.overlap('p.search_term', 'p.product_title')} AS common_title,
       {Q.overlap('p.search_term', 'd.product_description')} AS common_descriptoin,
       {Q.overlap('p.search_term', "coalesce(a.product_attributes, '')")} AS common_attributes
FROM pairs p LEFT JOIN descs d USING (product_uid) LEFT JOIN attr_text a USING (product_uid)""")
def q_lr3(spark, sf):
    return lr3_features(pairs(spark, sf), product_descriptions(spark, sf), attributes(spark, sf))


# ---- TF-IDF (A2-A5, J4) ---------------------------------------------------


def _tfidf_inputs(spark, sf):
    # the pair table feeds the dictionary, both weight sides and the output:
    # materialise it once instead of re-deriving it in every branch
    p = stage(pairs(spark, sf), "pairs")
    return p, product_descriptions(spark, sf)


@register("A2_dictionary", f"""WITH {Q.PAIRS_CTE}, {Q.TFIDF_CTE}
SELECT token, df, round(idf, 6) AS idf FROM vocab""")
def q_a2(spark, sf):
    p, d = _tfidf_inputs(spark, sf)
    return idf_table(p, d).select("token", "df", r6("idf").alias("idf"))


@register("A3_bag_of_words", f"""WITH {Q.PAIRS_CTE}, {Q.TFIDF_CTE}
SELECT key AS id, field, token, tf FROM bow WHERE field <> 'q'""")
def q_a3(spark, sf):
    p, d = _tfidf_inputs(spark, sf)
    j = left_join(p, d)
    return (bag_of_words(j, "id", "product_title", "title")
            .unionByName(bag_of_words(j, "id", "product_description", "desc"))
            .withColumnRenamed("key", "id"))


@register("J4_A4_tfidf_weights", f"""WITH {Q.PAIRS_CTE}, {Q.TFIDF_CTE}
SELECT key AS id, field, token, round(w, 6) AS w, round(nw, 6) AS nw FROM nw""")
def q_a4(spark, sf):
    p, d = _tfidf_inputs(spark, sf)
    idf = stage(idf_table(p, d), "idf")
    j = left_join(p, d)
    descs, others = product_weights_of_pairs(p, d, "product_description", "desc", idf)
    bows = (bag_of_words(j, "id", "search_term", "q")
            .unionByName(bag_of_words(j, "id", "product_title", "title"))
            .unionByName(bag_of_words(left_join(others, d), "id", "product_description", "desc")))
    return tfidf_weights(bows, idf).unionByName(descs).select(
        F.col("key").alias("id"), "field", "token", r6("w").alias("w"), r6("nw").alias("nw"))


@register("A5_tfidf_cosine", f"""WITH {Q.PAIRS_CTE}, {Q.TFIDF_CTE}
SELECT p.id,
  round(coalesce((SELECT c FROM cos WHERE cos.id = p.id AND field = 'title'), 0.0), 6) AS tfidf_cos_sim_in_title,
  round(coalesce((SELECT c FROM cos WHERE cos.id = p.id AND field = 'desc'), 0.0), 6) AS tfidf_cos_sim_in_desc
FROM pairs p""")
def q_a5(spark, sf):
    p, d = _tfidf_inputs(spark, sf)
    out = tfidf_cosines(p, d, ("title", "desc"))
    return out.select("id", *[r6(c).alias(c) for c in out.columns if c != "id"])


# ---- attribute flow: F4a overlaps, F5 edit ratios, J2 ---------------------


def _attr_base(spark, sf):
    return attr_base(pairs(spark, sf), product_descriptions(spark, sf), attr_side_tables(spark, sf))


@register("J2_product_dimension", f"""WITH {Q.PAIRS_CTE}, {Q.ATTR_BASE_CTE}
SELECT id, product_uid, product_title, search_term, relevance, product_description, brand, material
FROM base""")
def q_j2(spark, sf):
    return _attr_base(spark, sf).select("id", "product_uid", "product_title", "search_term",
                                        "relevance", "product_description", "brand", "material")


@register("F4a_attr_overlap", f"""WITH {Q.PAIRS_CTE}, {Q.ATTR_BASE_CTE}
SELECT id,
  {Q.overlap('product_title', 'search_term')} AS common_title,
  {Q.overlap('product_description', 'search_term')} AS common_desc,
  {Q.overlap('brand', 'search_term')} AS common_brand,
  {Q.overlap('material', 'search_term')} AS common_material
FROM base""")
def q_f4a(spark, sf):
    return attr_overlap(_attr_base(spark, sf)).select(
        "id", "common_title", "common_desc", "common_brand", "common_material")


@register("F5_edit_ratio", f"""WITH RECURSIVE {Q.PAIRS_CTE}, {Q.attr_base_cte('doc.source')},
{Q.lcs_diagonal_cte('rt', 'base', 'search_term', 'product_title')},
{Q.lcs_ratio_cte('rb', 'base', 'search_term', 'brand')},
{Q.lcs_ratio_cte('rm', 'base', 'search_term', 'material')}
SELECT b.id, round(rt.ratio, 6) AS dist_in_title, round(rb.ratio, 6) AS dist_in_brand,
       round(rm.ratio, 6) AS dist_in_material
FROM base b JOIN rt USING (id) JOIN rb USING (id) JOIN rm USING (id)""")
def q_f5(spark, sf):
    side = {**attr_side_tables(spark, sf), "brand": source_brands(spark, sf)}
    base = attr_base(pairs(spark, sf), product_descriptions(spark, sf), side)
    out = attr_edit_ratios(base, ("title", "brand", "material"))
    return out.select("id", *[r6(f"dist_in_{f}").alias(f"dist_in_{f}") for f in ("title", "brand", "material")])


@register("F5_edit_ratio_desc")
def q_f5_desc(spark, sf):
    """Edit ratio against whole titles and descriptions (these too long for the SQL
    table method; checked against a DP on a fixture)."""
    out = attr_edit_ratios(_attr_base(spark, sf), ("title", "desc"))
    return out.select("id", r6("dist_in_title").alias("dist_in_title"), r6("dist_in_desc").alias("dist_in_desc"))


@register("E2_attr8_features")
def q_attr8(spark, sf):
    out = attr8_features(pairs(spark, sf), product_descriptions(spark, sf),
                         attr_side_tables(spark, sf))
    return out.select("id", "product_uid", "relevance", *[r6(c).alias(c) for c in ATTR8])


# ---- order, folds, evaluation (W1, W2, S8, L2, A8-A10, M5, M17) -----------


def _lr3_train(spark, sf):
    f = lr3_features(pairs(spark, sf), product_descriptions(spark, sf))
    return f.where(F.col("relevance").isNotNull())


def _ols_one(spark, sf, x="common_descriptoin"):
    tr = assemble(_lr3_train(spark, sf), [x], keep=("id",))
    return tr, ols().fit(tr)


@register("W2_row_index", f"""WITH {Q.PAIRS_CTE}
SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS BIGINT) AS row_idx FROM pairs""")
def q_w2(spark, sf):
    return row_index(pairs(spark, sf).select("id"), ["id"])


@register("W1_kfold_assignment", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE}
SELECT id, fold FROM folds""")
def q_w1(spark, sf):
    return assign_folds(_lr3_train(spark, sf).select("id"), ["id"], 10)


@register("S8_peek", f"""WITH {Q.PAIRS_CTE}
SELECT * FROM pairs ORDER BY id LIMIT 5""")
def q_s8(spark, sf):
    return peek(pairs(spark, sf), ["id"], 5)


@register("M5_ols_coefficients", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE}
SELECT round(regr_intercept(relevance, common_descriptoin), 6) AS intercept,
       round(regr_slope(relevance, common_descriptoin), 6) AS slope FROM train""")
def q_m5(spark, sf):
    _, m = _ols_one(spark, sf)
    return spark.createDataFrame([(float(m.intercept), float(m.coefficients[0]))],
                                 "intercept double, slope double").select(
        r6("intercept").alias("intercept"), r6("slope").alias("slope"))


@register("E3_raw_ols_predictions", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE}, {Q.linear3_cte()}
SELECT id, round(b0 + b1 * query_len + b2 * common_title + b3 * common_descriptoin, 6) AS relevance
FROM lr3, fit WHERE lr3.relevance IS NULL""")
def q_e3_raw(spark, sf):
    """E3 on raw texts: least squares on all three overlap features."""
    f = lr3_features(pairs(spark, sf), product_descriptions(spark, sf))
    _, pred = fit_and_score(ols(), f, LR3, clip="none")
    return pred.select("id", r6("relevance").alias("relevance"))


_SUMMARY_SQL = """SELECT round(b0, 6) AS intercept, [round(b1, 6), round(b2, 6), round(b3, 6)] AS coefficients,
  (SELECT round(sqrt(avg(power(relevance - (b0 + b1 * query_len + b2 * common_title + b3 * common_descriptoin), 2))), 6)
   FROM train) AS rmse FROM fit"""


def _linear_summary(spark, sf, make):
    f = _lr3_train(spark, sf)
    tr = staged_by_key(assemble(assign_folds(f, ["id"], 10), LR3, keep=("id", "fold")), "id")
    m = make().fit(tr)
    return rmse(m.transform(tr)).select(
        F.round(F.lit(float(m.intercept)), 6).alias("intercept"),
        F.array(*[F.round(F.lit(float(c)), 6) for c in m.coefficients]).alias("coefficients"), r6("rmse").alias("rmse"))


@register("M4_M22_linear_summary", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE}, {Q.linear3_cte()} {_SUMMARY_SQL}""")
def q_m4_linear(spark, sf):
    """Coefficients and training RMSE of least squares on three features."""
    return _linear_summary(spark, sf, ols)


@register("M6_ridge_fixed_alpha", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE}, {Q.linear3_cte(10.0)} {_SUMMARY_SQL}""")
def q_m6_fixed(spark, sf):
    """Ridge with penalty 10, the intercept free."""
    return _linear_summary(spark, sf, lambda: LN.RidgeCV(alphas=(10.0,)))


@register("A8_training_rmse", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE},
fit AS (SELECT regr_intercept(relevance, common_descriptoin) AS a,
               regr_slope(relevance, common_descriptoin) AS b FROM train)
SELECT round(sqrt(avg(power(relevance - (a + b * common_descriptoin), 2))), 6) AS rmse
FROM train, fit""")
def q_a8(spark, sf):
    tr, m = _ols_one(spark, sf)
    return rmse(m.transform(tr)).select(r6("rmse").alias("rmse"))


@register("A9_r2", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE},
fit AS (SELECT regr_intercept(relevance, common_descriptoin) AS a,
               regr_slope(relevance, common_descriptoin) AS b FROM train)
SELECT round(1 - sum(power(relevance - (a + b * common_descriptoin), 2))
             / sum(power(relevance - (SELECT avg(relevance) FROM train), 2)), 6) AS r2
FROM train, fit""")
def q_a9(spark, sf):
    tr, m = _ols_one(spark, sf)
    return r2(m.transform(tr)).select(r6("r2").alias("r2"))


def _cv_ols(spark, sf, x):
    """10-fold CV RMSE of least squares on one feature: one aggregation pass
    (per-fold sufficient statistics) instead of ten fits."""
    f = assign_folds(_lr3_train(spark, sf), ["id"], 10)
    return LN.ols_cv_rmse(f, [x])[0]


@register("M17_A10_cv_mean_rmse", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE}, {Q.cv_ols_cte(['common_descriptoin'])}
SELECT round(mean_rmse, 6) AS mean_rmse FROM cvm""")
def q_m17(spark, sf):
    return spark.createDataFrame([(_cv_ols(spark, sf, "common_descriptoin"),)],
                                 "mean_rmse double").select(r6("mean_rmse").alias("mean_rmse"))


@register("L2_best_feature_by_cv", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE},
{Q.cv_ols_cte(['common_title', 'common_descriptoin'])}
SELECT feature, round(mean_rmse, 6) AS mean_rmse FROM cvm ORDER BY mean_rmse, feature LIMIT 1""")
def q_l2(spark, sf):
    rows = [(x, _cv_ols(spark, sf, x)) for x in ("common_title", "common_descriptoin")]
    scores = spark.createDataFrame(rows, "feature string, mean_rmse double")
    return best_of(scores, "mean_rmse", ["feature"]).select(
        "feature", r6("mean_rmse").alias("mean_rmse"))


# ---- sources and sinks (S1-S7) -------------------------------------------

_J1_SQL = f"""WITH {Q.PAIRS_CTE}
SELECT p.*, d.product_description FROM pairs p LEFT JOIN descs d USING (product_uid)"""


@register("S1_S5_csv_latin1_roundtrip", _J1_SQL)
def q_s1(spark, sf):
    return csv_roundtrip(q_j1(spark, sf), "s1", encoding="ISO-8859-1")


@register("S2_csv_utf8_roundtrip", _J1_SQL)
def q_s2(spark, sf):
    return csv_roundtrip(q_j1(spark, sf), "s2", encoding="UTF-8")


@register("S3_side_table_dropna", """
SELECT doc_id AS product_uid, source AS brand FROM documents
WHERE doc_id IS NOT NULL AND source IS NOT NULL""")
def q_s3(spark, sf):
    brand = source_brands(spark, sf)
    path = write_csv(brand, scratch_path(spark, "s3"), encoding="ISO-8859-1")
    return read_side_table(spark, path, brand.schema)


@register("S4_csv_inferred", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE}
SELECT CAST(id AS INTEGER) AS id, relevance, CAST(query_len AS INTEGER) AS query_len,
       CAST(common_title AS INTEGER) AS common_title,
       CAST(common_descriptoin AS INTEGER) AS common_descriptoin FROM train""")
def q_s4(spark, sf):
    path = write_csv(_lr3_train(spark, sf).drop("product_uid"), scratch_path(spark, "s4"))
    return read_csv_inferred(spark, path)


@register("S6_csv_with_row_number", f"""WITH {Q.PAIRS_CTE}
SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS BIGINT) AS _c0, * FROM pairs""")
def q_s6(spark, sf):
    return csv_roundtrip(pairs(spark, sf), "s6", indexed_by=["id"])


@register("S7_stage_parquet", _J1_SQL)
def q_s7(spark, sf):
    return stage(q_j1(spark, sf), "s7")


# ---- dense vectors and k-NN (A6, A7, J6, L1, M20) ------------------------

def _embeddings(spark, sf):
    return read_table(spark, sf, "embeddings").select(
        "vec_id", "label", to_double_array("embedding").alias("vec"))


def _centroids(spark, sf):
    e = _embeddings(spark, sf)
    dim = len(e.select("vec").first()["vec"])
    return e, mean_vectors(e, ["label"], "vec", dim)


@register("A6_class_mean_vector", """
WITH u AS (SELECT label, i, CAST(embedding[i] AS DOUBLE) AS x
           FROM embeddings, range(1, len(embedding) + 1) r(i)),
m AS (SELECT label, i, avg(x) AS x FROM u GROUP BY label, i),
c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
SELECT m.label, c.n, list(round(m.x, 6) ORDER BY m.i) AS mean
FROM m JOIN c USING (label) GROUP BY m.label, c.n""")
def q_a6(spark, sf):
    _, m = _centroids(spark, sf)
    return m.select("label", "n", F.transform("mean", lambda x: F.round(x, 6)).alias("mean"))


@register("A7_cosine_to_class_mean", """
WITH u AS (SELECT label, i, CAST(embedding[i] AS DOUBLE) AS x
           FROM embeddings, range(1, len(embedding) + 1) r(i)),
m AS (SELECT label, i, avg(x) AS c FROM u GROUP BY label, i),
e AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS x
      FROM embeddings, range(1, len(embedding) + 1) r(i)),
s AS (SELECT e.vec_id, sum(e.x * m.c) AS dot, sqrt(sum(e.x * e.x)) AS nx, sqrt(sum(m.c * m.c)) AS nc
      FROM e JOIN m ON e.label = m.label AND e.i = m.i GROUP BY e.vec_id)
SELECT vec_id, round(CASE WHEN nx * nc = 0 THEN 'NaN'::DOUBLE ELSE dot / (nx * nc) END, 6) AS cos_to_mean
FROM s""")
def q_a7(spark, sf):
    e, m = _centroids(spark, sf)
    j = e.join(m.select("label", "mean"), "label", "inner")
    return j.select("vec_id", F.round(cosine("vec", "mean"), 6).alias("cos_to_mean"))


@register("J6_L1_knn_join_embeddings", f"""
WITH d AS (
  SELECT a.vec_id AS vec_id, b.vec_id AS nb_id,
         sqrt(list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i:
              (CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE))
            * (CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE))))) AS dist
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nb_id) AS rank FROM d)
SELECT vec_id, nb_id, CAST(rank AS INTEGER) AS rank, round(dist, 6) AS dist
FROM r WHERE rank <= {K_NEIGHBOURS}""")
def q_j6(spark, sf):
    e = _embeddings(spark, sf)
    nn = knn_join(e.select(F.col("vec_id").alias("qid"), "vec"),
                  e.select(F.col("vec_id").alias("pid"), "vec"), k=K_NEIGHBOURS,
                  exclude_self=True)
    return nn.select(F.col("qid").alias("vec_id"), F.col("pid").alias("nb_id"), "rank",
                     F.round("dist", 6).alias("dist"))


@register("J6_lsh_recall")
def q_j6_lsh(spark, sf):
    """Of each vector's exact neighbours, how many the hash buckets find."""
    e = _embeddings(spark, sf)
    q, p = (e.select(F.col("vec_id").alias(c), "vec") for c in ("qid", "pid"))
    exact = knn_join(q, p, k=K_NEIGHBOURS, exclude_self=True).select("qid", "pid")
    found = knn_lsh(q, p, k=K_NEIGHBOURS, exclude_self=True).select("qid", "pid", F.lit(1).alias("hit"))
    return exact.join(found, ["qid", "pid"], "left").groupBy(F.col("qid").alias("vec_id")).agg(
        F.count(F.lit(1)).alias("neighbours"), F.count("hit").alias("found"),
        F.round(F.count("hit") / F.count(F.lit(1)), 6).alias("recall"))


@register("M20_knn_regression", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE},
test AS (SELECT * FROM lr3 WHERE relevance IS NULL),
d AS (SELECT q.id AS qid, t.id AS pid, t.relevance AS y,
        sqrt(CAST((q.query_len - t.query_len) * (q.query_len - t.query_len)
           + (q.common_title - t.common_title) * (q.common_title - t.common_title)
           + (q.common_descriptoin - t.common_descriptoin) * (q.common_descriptoin - t.common_descriptoin)
           AS DOUBLE)) AS dist
      FROM test q JOIN train t ON TRUE),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, pid) AS rk FROM d),
p AS (SELECT qid AS id, avg(y) AS pr FROM r WHERE rk <= {K_NEIGHBOURS} GROUP BY qid)
SELECT id, round({Q.clip_both('pr')}, 6) AS relevance FROM p""")
def q_m20(spark, sf):
    f = lr3_features(pairs(spark, sf), product_descriptions(spark, sf))
    f = f.withColumn("vec", F.array(*[F.col(c).cast("double") for c in LR3]))
    train = f.where(F.col("relevance").isNotNull())
    test = f.where(F.col("relevance").isNull())
    pred = knn_regress(train, test, k=K_NEIGHBOURS)
    return pred.select("id", F.round(clip_both("prediction"), 6).alias("relevance"))


# ---- stemming and the description / notebook flows (F2, E1, E2) ----------


@register("F2_stemmed_pairs")
def q_f2(spark, sf):
    p, d = stemmed_inputs(pairs(spark, sf), product_descriptions(spark, sf))
    return left_join(p, d).select("id", "search_term", "product_title", "product_description")


@register("E1_desc7_features")
def q_e1(spark, sf):
    f = desc7_features(pairs(spark, sf), product_descriptions(spark, sf))
    return f.select("id", "relevance", *[r6(c).alias(c) if c != "product_uid" else F.col(c)
                                         for c in DESC7])


def _flow_predictions(feats, cols, clip):
    """Least squares on one pass's features: ``(id, relevance)`` of its test
    side.  A cosine that isn't defined (a text without tokens) counts as 0."""
    _, pred = fit_and_score(ols(), feats.fillna(0.0, subset=list(cols)), cols, clip=clip)
    return pred.select("id", r6("relevance").alias("relevance"))


@register("E1_M5_description_model")
def q_e1_model(spark, sf):
    """Pass A end to end: description features, model, clip, prediction file."""
    f = desc7_features(pairs(spark, sf), product_descriptions(spark, sf))
    pred = _flow_predictions(f, DESC6, "both")
    return read_csv(spark, write_predictions(pred, scratch_path(spark, "e1")), pred.schema, encoding="UTF-8")


@register("E2_M5_attr15_model")
def q_attr15_model(spark, sf):
    """The notebook's pass end to end on its 15 features."""
    f = attr15_features(pairs(spark, sf), product_descriptions(spark, sf),
                        attributes(spark, sf), attr_side_tables(spark, sf))
    pred = _flow_predictions(f, ATTR15, "both")
    return read_csv(spark, write_predictions(pred, scratch_path(spark, "e2")), pred.schema, encoding="UTF-8")


@register("E1_model_files")
def q_e1_models(spark, sf):
    """Pass A: all its twelve models, each one's clipped prediction file, read back."""
    f = desc7_features(pairs(spark, sf), product_descriptions(spark, sf))
    files = run_models(f, DESC6, specs("description"))
    return read_predictions(spark, files).select("model", "id", r6("relevance").alias("relevance"))


@register("E2_notebook_model_files")
def q_e2_models(spark, sf):
    """The notebook's pass: all its four models on the 15 features, read back from files."""
    f = attr15_features(pairs(spark, sf), product_descriptions(spark, sf),
                        attributes(spark, sf), attr_side_tables(spark, sf))
    files = run_models(f, ATTR15, specs("notebook"))
    return read_predictions(spark, files).select("model", "id", r6("relevance").alias("relevance"))


@register("E2_attr15_features")
def q_e2_nb(spark, sf):
    f = attr15_features(pairs(spark, sf), product_descriptions(spark, sf),
                        attributes(spark, sf), attr_side_tables(spark, sf))
    return f.select("id", "product_uid", "relevance", *[r6(c).alias(c) for c in ATTR15])


# ---- models on the attribute features (M3, M4, M6-M16, M21, S9, P12, P13) -


def _attr8_staged(spark, sf):
    f = attr8_features(pairs(spark, sf), product_descriptions(spark, sf),
                       attr_side_tables(spark, sf))
    return stage(f)


def _model_query(name: str, make_estimator, clip: str, folds: bool = False):
    def run(spark, sf):
        feats = _attr8_staged(spark, sf)
        if folds:
            tr = feats.where(F.col("relevance").isNotNull())
            feats = assign_folds(tr, ["id"], 10).unionByName(
                feats.where(F.col("relevance").isNull()), allowMissingColumns=True)
        keep = ("id", "fold") if folds else ("id",)
        train = assemble(feats.where(F.col("relevance").isNotNull()), ATTR8, keep=keep)
        test = assemble(feats.where(F.col("relevance").isNull()), ATTR8, label=None,
                        keep=("id",))
        model = make_estimator().fit(staged_by_key(train, "id"))
        return model.transform(test).select("id", r6(CLIPS[clip]("prediction")).alias("relevance"))
    run.__name__ = f"q_{name}"
    return register(name)(run)


# Clipping of each model's predictions follows the reference's attribute pass.
_model_query("M8_random_forest", lambda: TR.random_forest(**{"seed": 2014}), "up")
_model_query("M13_adaboost_r2", lambda: EN.AdaBoostR2(), "up")
_model_query("M14_bagging_boosted", lambda: EN.Bagging(
    lambda i: TR.boosted_trees(seed=2016 + i), n=10, seed=2016), "up")
_model_query("M9_extra_trees", lambda: TR.extra_trees(), "up")
_model_query("M10_gradient_boosting", lambda: TR.gradient_boosting(), "both")
_model_query("M5_S9_linear_predictions", lambda: LN.ols(), "up")
_model_query("M15_linear_svr", lambda: GR.LinearSVR(), "up")
_model_query("M6_ridge_cv", lambda: LN.RidgeCV(), "up", folds=True)
_model_query("M16_mlp", lambda: GR.MLPRegressor(), "both")
_model_query("M11_boosting_preset", lambda: TR.xgb_like(preset=1), "both")
_model_query("M7_decision_tree", lambda: TR.random_split_tree(), "both")
_model_query("M12_grade_classifier", lambda: TR.GradeClassifier(), "up")
_model_query("M15_rbf_svr", lambda: GR.RbfSVR(), "up")


# ---- scalar text operators and null handling (F1, F3, F8, F9, U1, U2, P*) ---


@register("F1_normalise", f"""WITH {Q.PAIRS_CTE}
SELECT id, {Q.normalise('search_term')} AS search_term, {Q.normalise('product_title')} AS product_title
FROM pairs""")
def q_f1(spark, sf):
    return pairs(spark, sf).select("id", normalise("search_term").alias("search_term"),
                                   normalise("product_title").alias("product_title"))


@register("F3_contains", f"""WITH {Q.PAIRS_CTE}, {Q.ATTR_BASE_CTE}
SELECT id, instr(product_title, search_term) > 0 AS term_in_title,
       instr(product_description, product_title) > 0 AS title_in_desc,
       instr(product_title, material) > 0 AS material_in_title,
       len(list_filter({Q.words('search_term')}, lambda w: instr(product_title, w) > 0)) > 0 AS a_word_in_title
FROM base""")
def q_f3(spark, sf):
    j = _attr_base(spark, sf)
    return j.select("id", contains_text("product_title", "search_term").alias("term_in_title"),
                    contains_text("product_description", "product_title").alias("title_in_desc"),
                    contains_text("product_title", "material").alias("material_in_title"),
                    F.exists(words("search_term"), lambda w: contains_text("product_title", w)).alias("a_word_in_title"))


@register("F8_F9_U2_sentence_tokens", f"""WITH {Q.PAIRS_CTE},
docs AS (SELECT p.id, p.product_title || ' . ' || d.product_description || ' . ' AS all_texts
         FROM pairs p LEFT JOIN descs d USING (product_uid)),
s AS (SELECT id, {Q.sentences('all_texts')} AS sents FROM docs)
SELECT id, CAST(i - 1 AS INTEGER) AS s_idx,
       regexp_extract_all(sents[i], '{Q.WORD_OR_PUNCT}') AS tokens
FROM s, range(1, len(sents) + 1) r(i)""")
def q_f8(spark, sf):
    j = left_join(pairs(spark, sf), product_descriptions(spark, sf))
    docs = j.select("id", corpus_text(F.col("product_title"),
                                      F.col("product_description")).alias("all_texts"))
    return sentence_tokens(docs, "id", "all_texts")


@register("U1_union_train_test", f"""WITH {Q.PAIRS_CTE} SELECT * FROM pairs""")
def q_u1(spark, sf):
    return union_all(train_pairs(spark, sf), test_pairs(spark, sf))


@register("P4_P5_fill_and_nan_text", f"""WITH {Q.PAIRS_CTE}
SELECT id, coalesce(CAST(relevance AS VARCHAR), ' ') AS grade_or_blank,
       coalesce(CAST(relevance AS VARCHAR), 'nan') AS grade_text FROM pairs""")
def q_p45(spark, sf):
    p = pairs(spark, sf)
    return p.select("id", fill_text(F.col("relevance").cast("string"), " ").alias("grade_or_blank"),
                    nan_text("relevance").alias("grade_text"))


@register("P6_dropna_any", f"""WITH {Q.PAIRS_CTE}
SELECT id, relevance FROM pairs WHERE id IS NOT NULL AND relevance IS NOT NULL""")
def q_p6(spark, sf):
    return pairs(spark, sf).select("id", "relevance").na.drop("any")


@register("P7_dropna_all", f"""WITH {Q.PAIRS_CTE}
SELECT relevance, CASE WHEN id % 5 <> 0 THEN CAST(id AS DOUBLE) END AS other FROM pairs
WHERE relevance IS NOT NULL OR id % 5 <> 0""")
def q_p7(spark, sf):
    p = pairs(spark, sf)
    # the two columns are null independently of each other
    return p.select("relevance", F.when(F.col("id") % 5 != 0, F.col("id").cast("double")).alias("other")).na.drop("all")


@register("P10_pack_unpack", f"""WITH {Q.PAIRS_CTE}
SELECT id, string_split(replace(search_term, ', ', chr(9)) || chr(9) || product_title, chr(9))[1] AS search_term,
       string_split(replace(search_term, ', ', chr(9)) || chr(9) || product_title, chr(9))[2] AS product_title FROM pairs""")
def q_p10(spark, sf):
    # a TAB inside a field shifts the fields behind it, as in the reference
    p = pairs(spark, sf).withColumn("search_term", F.replace("search_term", F.lit(", "), F.lit("\t")))
    p = p.withColumn("info", pack("search_term", "product_title"))
    return p.select("id", unpack("info", 0).alias("search_term"),
                    unpack("info", 1).alias("product_title"))


_OLS_TEST_SQL = f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE},
fit AS (SELECT regr_intercept(relevance, common_descriptoin) AS a,
               regr_slope(relevance, common_descriptoin) AS b FROM train),
pr AS (SELECT id, a + b * common_descriptoin AS p FROM lr3, fit WHERE relevance IS NULL)"""


def _ols_test_predictions(spark, sf):
    f = lr3_features(pairs(spark, sf), product_descriptions(spark, sf))
    model, pred = fit_and_score(ols(), f, ["common_descriptoin"], clip="none")
    return pred


@register("P12_clip_both", f"""{_OLS_TEST_SQL}
SELECT id, round({Q.clip_both('p')}, 6) AS relevance FROM pr""")
def q_p12(spark, sf):
    return _ols_test_predictions(spark, sf).select("id", r6(clip_both("relevance")).alias("relevance"))


@register("S9_prediction_file", f"""{_OLS_TEST_SQL}
SELECT id, round({Q.clip_both('p')}, 6) AS relevance FROM pr""")
def q_s9(spark, sf):
    """Predictions written as ``(id, relevance)`` CSV and read back."""
    pred = _ols_test_predictions(spark, sf).select("id", r6(clip_both("relevance")).alias("relevance"))
    path = write_predictions(pred, scratch_path(spark, "s9"))
    return read_csv(spark, path, pred.schema, encoding="UTF-8")


@register("P13_clip_upper", f"""{_OLS_TEST_SQL}
SELECT id, round({Q.clip_upper('p')}, 6) AS relevance FROM pr""")
def q_p13(spark, sf):
    return _ols_test_predictions(spark, sf).select("id", r6(clip_upper("relevance")).alias("relevance"))


# ---- model flows with rows-only checks (A11, M2-M4, M18, M22, M23, J5) -----


def _board_specs(feature_set: str) -> list[Spec]:
    """The scoreboard's models of few jobs a fold (forests and boosted ones go
    through ``run_folds`` into a kept ``ScoreTable`` the same way)."""
    make = {"linear": ols, "ridge": lambda: LN.RidgeCV(inner_folds=True), "knn": lambda: KNNRegressor(),
            "decision_tree": lambda: TR.random_split_tree()}
    return [Spec(name, m, feature_set) for name, m in make.items()]


@register("A11_scoreboard")
def q_a11(spark, sf):
    """10-fold CV RMSE of the models, without / with attribute features: all
    scores go to one table, which is pivoted."""
    scores = ScoreTable(spark)
    without = assign_folds(_lr3_train(spark, sf), ["id"], 10)
    attr = assign_folds(_attr8_staged(spark, sf).where(F.col("relevance").isNotNull()), ["id"], 10)
    for name, data, cols in (("without_attributes", without, LR3), ("with_attributes", attr, ATTR8)):
        run_folds(_board_specs(name), Folds(stage(assemble(data, cols, keep=("id", "fold")), "folds")), scores)
    board = scoreboard([scores.means()])
    return board.select("model", *[r6(c).alias(c) for c in ("without_attributes", "with_attributes")])


def _attr8_folds(spark, sf) -> Folds:
    attr = assign_folds(_attr8_staged(spark, sf).where(F.col("relevance").isNotNull()), ["id"], 10)
    return Folds(stage(assemble(attr, ATTR8, keep=("id", "fold")), "folds"))


def _sweep(spark, sf, specs):
    """Mean RMSE of every (model, depth) and a flag on each model's best."""
    scores = run_folds(specs, _attr8_folds(spark, sf), ScoreTable(spark)).means()
    best = scores.groupBy("model").agg(F.min(F.struct("rmse", "value")).alias("x")).select(
        "model", F.col("x.value").alias("_best"))
    return scores.join(best, "model").select("model", "param", "value", r6("rmse").alias("rmse"), "folds",
                                             (F.col("value") == F.col("_best")).alias("best"))


def _depths(model, make, shared=None):
    return [Spec(model, lambda d=d: make(d), "attr8", "maxDepth", d, shared) for d in sorted(DEPTHS, reverse=True)]


@register("M18_depth_sweep")
def q_m18(spark, sf):
    """M18 + M17 + L2: the random forest's depth sweep over the reference's grid,
    10-fold CV, as one resumable pool of jobs; a fold's depths share a fit."""
    return _sweep(spark, sf, _depths("random_forest", lambda d: BootstrapForest(max_depth=d), ForestDepths))


def other_sweeps() -> list[Spec]:
    """The sweeps of extra trees (80 fits) and gradient boosting (80 x 500
    rounds): for ``run_folds`` with a kept ``ScoreTable``, as they take long."""
    return (_depths("extra_trees", lambda d: TR.extra_trees(max_depth=d))
            + _depths("gradient_boosting", lambda d: TR.gradient_boosting(maxDepth=d)))


def _cv_learners(spark, sf, specs):
    # a k-NN fold is many small jobs, whose plans the driver holds
    means = run_folds(specs, _attr8_folds(spark, sf), ScoreTable(spark), parallelism=3).means()
    return means.select("model", r6("rmse").alias("rmse"), "folds")


@register("M17_cv_learners")
def q_m17_learners(spark, sf):
    """10-fold mean RMSE of the package's own learners that Spark's
    CrossValidator doesn't take."""
    return _cv_learners(spark, sf, [Spec("extra_trees", lambda: TR.extra_trees()), Spec("knn", lambda: KNNRegressor()),
                                    Spec("random_split_tree", lambda: TR.random_split_tree())])


@register("M17_cv_gradient_learners")
def q_m17_gradient(spark, sf):
    """The same of the support-vector and neural-network regressions."""
    return _cv_learners(spark, sf, [Spec("mlp", lambda: GR.MLPRegressor()), Spec("linear_svr", lambda: GR.LinearSVR())])


@register("E3_M2_M3_M4_elastic_net")
def q_e3_spark(spark, sf):
    """The Spark linear flow: random 70/30 split, elastic net (reg 0.3, mix
    0.8, 1000 iterations), training summary and held-out RMSE."""
    # a row's side follows from its id alone, whatever the layout
    f = stage(assemble(_lr3_train(spark, sf), LR3, keep=("id",)), "split-input")
    low = F.pmod(F.xxhash64("id"), F.lit(10)) < 7
    train, test = f.where(low), f.where(~low)
    model = LN.elastic_net().fit(staged_by_key(train, "id"))
    summ = LN.summary_frame(spark, model)
    held = rmse(model.transform(test)).first()["rmse"]
    return summ.withColumn("test_rmse", F.lit(held).cast("double"))


@register("M22_training_rmse")
def q_m22(spark, sf):
    """Training-set RMSE of the notebook's forest (120 trees, depth 12)."""
    tr = assemble(_attr8_staged(spark, sf).where(F.col("relevance").isNotNull()), ATTR8,
                  keep=("id",))
    tr = staged_by_key(tr, "id")
    m = TR.random_forest(numTrees=120, maxDepth=12, minInstancesPerNode=1,
                         featureSubsetStrategy="auto", seed=0).fit(tr)
    return rmse(m.transform(tr)).select(r6("rmse").alias("rmse"))


def _w2v_inputs(spark, sf):
    j = left_join(pairs(spark, sf), product_descriptions(spark, sf))
    docs = j.select("id", corpus_text(F.col("product_title"),
                                      F.col("product_description")).alias("all_texts"))
    model = train_word2vec(sentence_tokens(docs, "id", "all_texts"), order=("id", "s_idx"))
    return j, vector_table(model)


@register("M23_word_vectors")
def q_m23(spark, sf):
    _, vecs = _w2v_inputs(spark, sf)
    return vecs.select("word", F.transform("vec", r6).alias("vec"))


@register("J5_A6_text_mean_vectors")
def q_j5(spark, sf):
    j, vecs = _w2v_inputs(spark, sf)
    tv = text_vectors(j, "id", {"q": "search_term", "title": "product_title"}, vecs, VECTOR_SIZE)
    return tv.select("id", "field", "n", "n_unknown", F.transform("mean", r6).alias("mean"))


# ---- column roles (P1, P2, M1) ---------------------------------------------


@register("P1_P2_keep_and_drop", f"""WITH {Q.PAIRS_CTE}
SELECT id, product_uid, relevance FROM pairs""")
def q_p12_cols(spark, sf):
    p = keep_columns(pairs(spark, sf), ["id", "product_uid", "product_title", "search_term",
                                        "relevance"])
    return drop_columns(p, ["product_title", "search_term"])


@register("M1_feature_vectors", f"""WITH {Q.PAIRS_CTE}, {Q.LR3_CTE}
SELECT id, relevance, [CAST(query_len AS DOUBLE), CAST(common_title AS DOUBLE),
                       CAST(common_descriptoin AS DOUBLE)] AS features FROM lr3""")
def q_m1(spark, sf):
    f = assemble(lr3_features(pairs(spark, sf), product_descriptions(spark, sf)), LR3,
                 keep=("id",))
    return f.select("id", "relevance", vector_to_array("features").alias("features"))
