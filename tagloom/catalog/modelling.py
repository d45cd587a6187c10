"""Text features, similarity, clusters, topics, learning, evaluation and inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as cfg
from ..functions import vectors as vx
from ..operators import aggregates as ag
from ..operators import blocks as bl
from ..operators import clustering as cl
from ..operators import evaluation as ev
from ..operators import features as ft
from ..operators import filters as fl
from ..operators import inference as inf
from ..operators import learning as ln
from ..operators import similarity as sm
from ..operators import tokens as tk
from ..operators import topics as tp
from ..operators.articles import encode_labels
from ..operators.ranking import stratified_split, topn_per_class
from ..plans import explore as ex
from ..scratch import settled
from ..sources import stores as st
from ..streaming.incremental import scratch_output
from . import sql as q
from . import standin as s
from .registry import query
from .relational import ASSIGNED, CENTROIDS, SOFTMAX, TOP_TAGS, assigned, logits, rounded, topics

N_DOCS = "SELECT count(*) FROM documents"


# Text features

@query(f"""WITH {q.ARTICLES}, {q.tokens("articles", {0: "text"})}
SELECT doc_id, tok AS token, count(*) AS n, min(pos - 1)::INTEGER AS first_pos FROM toks GROUP BY doc_id, tok""")
def tokens(spark, d):
    rows = tk.token_rows(s.table(spark, d, "documents"), "doc_id", ["text"])
    return rows.groupBy("doc_id", "token").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


@query(f"""WITH both_texts AS (SELECT doc_id, text FROM documents), {q.tokens("both_texts", {0: "text"})} SELECT tok AS token, lemma FROM lem""")
def lemma_map(spark, d):
    return tk.lemma_map(tk.token_rows(s.table(spark, d, "documents"), "doc_id", ["text"]))


@query(f"""WITH {q.ARTICLES}, {q.counts()} SELECT doc_id, term, tf FROM counts""")
def ngrams(spark, d):
    return ex.corpus_terms(s.articles(spark, d), "doc_id").select("doc_id", "term", "tf")


@query(f"""WITH {q.ARTICLES}, {q.counts()}, {q.vocab(N_DOCS)} SELECT term, df, tf, round(idf, 6) AS idf FROM vocab""")
def vocabulary(spark, d):
    a = s.articles(spark, d)
    v = ft.vocabulary(ex.corpus_terms(a, "doc_id"), ft.row_count(a))
    return rounded(v, "idf", digits=6)


@query(f"WITH {q.corpus_tfidf()} SELECT doc_id, term, round(weight, 5) AS weight FROM tfidf")
def tfidf(spark, d):
    w = ex.corpus_tfidf(s.articles(spark, d), "doc_id")
    return rounded(w.select("doc_id", "term", "weight"), "weight", digits=5)


LABEL_SPLIT = """sp AS (SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5('42|' || doc_id), doc_id)
  <= round(0.2 * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split FROM labeled)"""


@query(f"""WITH {q.ARTICLES}, {q.LABELED}, {LABEL_SPLIT}, {q.counts("labeled")},
train AS (SELECT c.* FROM counts c JOIN sp USING (doc_id) WHERE split = 'train'),
test AS (SELECT c.* FROM counts c JOIN sp USING (doc_id) WHERE split = 'test'),
{q.vocab("SELECT count(*) FROM sp WHERE split = 'train'", 2, 1.0, 15000, "train")}, {q.tfidf("test")}
SELECT doc_id, term, round(weight, 5) AS weight FROM tfidf""")
def tfidf_transform(spark, d):
    labeled, _ = fl.split_labeled_unlabeled(s.articles(spark, d))
    split = stratified_split(labeled.select("doc_id", "User_Needs"), "User_Needs", "doc_id")
    counts = ex.corpus_terms(labeled, "doc_id").drop("User_Needs").join(split, "doc_id")
    train, test = counts.where("split = 'train'"), counts.where("split = 'test'")
    vocab = ft.vocabulary(train, ft.row_count(split.where("split = 'train'")), cfg.CLASSIFIER_MIN_DF, 1.0, cfg.CLASSIFIER_VOCAB_SIZE)
    return rounded(ft.tfidf(test, vocab, "doc_id").select("doc_id", "term", "weight"), "weight", digits=5)


def sql_class_top(lo: int, hi: int) -> str:
    return f"""WITH {q.ARTICLES}, {q.LABELED}, {q.counts("labeled", lo, hi)}, nc AS (SELECT label, count(*) AS n FROM labeled GROUP BY label),
v AS (SELECT label, term, count(*) AS df, ln((1 + any_value(nc.n)) / (1.0 + count(*))) + 1 AS idf FROM counts JOIN nc USING (label) GROUP BY label, term
  HAVING count(*) >= 2 QUALIFY row_number() OVER (PARTITION BY label ORDER BY sum(tf) DESC, term) <= 5000),
w AS (SELECT label, doc_id, term, (1 + ln(tf)) * idf AS w FROM counts JOIN v USING (label, term)),
u AS (SELECT label, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS u FROM w),
m AS (SELECT label, term, sum(u) AS total, sum(u) / any_value(n) AS m FROM u JOIN nc USING (label) GROUP BY label, term)
SELECT label, row_number() OVER (PARTITION BY label ORDER BY round(total, 9) DESC, term)::INTEGER AS rank, term, round(m, 4) AS mean_tfidf FROM m
QUALIFY row_number() OVER (PARTITION BY label ORDER BY round(total, 9) DESC, term) <= 15"""


@query(sql_class_top(1, 1))
def class_top_terms(spark, d):
    return ex.top_terms_per_class(s.articles(spark, d), "doc_id").withColumnRenamed("User_Needs", "label")


@query(sql_class_top(2, 2))
def class_top_bigrams(spark, d):
    return ex.top_terms_per_class(s.articles(spark, d), "doc_id", lo=2, hi=2).withColumnRenamed("User_Needs", "label")


DISTRIBUTION = f"""{q.ARTICLES}, {q.LABELED}, {q.counts("labeled")}, {q.vocab("SELECT count(*) FROM labeled", 3, 1.0, 5000)},
cls AS (SELECT DISTINCT label FROM labeled),
pc AS (SELECT label, term, sum(tf) AS n FROM counts GROUP BY label, term),
dist AS (SELECT cls.label, vocab.term, (coalesce(n, 0) + 1e-10) / sum(coalesce(n, 0) + 1e-10) OVER (PARTITION BY cls.label) AS p
  FROM vocab CROSS JOIN cls LEFT JOIN pc ON pc.label = cls.label AND pc.term = vocab.term)"""


@query(f"WITH {DISTRIBUTION} SELECT label, term, round(p, 9) AS p FROM dist")
def class_term_distribution(spark, d):
    out = ex.class_distributions(s.articles(spark, d), "doc_id", s.LABELS)
    return rounded(out, "p", digits=9).withColumnRenamed("User_Needs", "label")


@query(f"""WITH {DISTRIBUTION}, m AS (SELECT a.label AS class_a, b.label AS class_b,
  sum(a.p * ln(a.p / ((a.p + b.p) / 2)) + b.p * ln(b.p / ((a.p + b.p) / 2))) / 2 AS v FROM dist a JOIN dist b USING (term) GROUP BY 1, 2)
SELECT class_a, class_b, round(sqrt(greatest(v, 0)), 6) AS jsd FROM m""")
def jsd_matrix(spark, d):
    return rounded(sm.jsd_matrix(ex.class_distributions(s.articles(spark, d), "doc_id", s.LABELS)), "jsd", digits=6)


CTFIDF = f"""{q.ARTICLES}, {q.counts()}, top AS (SELECT doc_id, substr(section, 4)::INTEGER AS topic FROM articles),
tc AS (SELECT topic, term, sum(tf) AS n FROM counts JOIN top USING (doc_id) GROUP BY topic, term),
ok AS (SELECT term, sum(n) AS f FROM tc GROUP BY term HAVING count(*) >= 5),
kc AS (SELECT topic, term, n, f, sum(n) OVER (PARTITION BY topic) AS size FROM tc JOIN ok USING (term)),
aa AS (SELECT floor(avg(size)) AS a FROM (SELECT DISTINCT topic, size FROM kc)),
cw AS (SELECT topic, term, n, sqrt(n / size) * ln(1 + a / f) AS w FROM kc, aa)"""


def corpus_ctfidf(spark, d):
    docs = ft.document_tokens(topics(spark, d), "doc_id", keep=["topic"])
    return ft.ctfidf(ft.class_counts(docs, "topic", summed=False))


@query(f"WITH {CTFIDF} SELECT topic, term, n::BIGINT AS n, round(w, 7) AS weight FROM cw")
def ctfidf(spark, d):
    return rounded(corpus_ctfidf(spark, d), "weight", digits=7)


@query(f"""WITH {CTFIDF}, r AS (SELECT topic, term, row_number() OVER (PARTITION BY topic ORDER BY round(w, 9) DESC, term) AS r FROM cw)
SELECT topic, count(*) AS n, (SELECT string_agg(term, ' ' ORDER BY r) FROM r WHERE r.topic = top.topic AND r.r <= 6) AS words FROM top GROUP BY topic""")
def cluster_topics(spark, d):
    return tp.cluster_topics(ex.corpus_documents(s.articles(spark, d), "doc_id"), topics(spark, d).select("doc_id", "topic"), "doc_id")


@query(f"""WITH {q.ARTICLES}, t AS (SELECT substr(section, 4)::INTEGER AS topic, label FROM articles WHERE label <> 'none'),
big AS (SELECT topic FROM t GROUP BY topic ORDER BY count(*) DESC, topic LIMIT 12)
SELECT label, topic, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY label), 4) AS share FROM t
WHERE topic IN (SELECT topic FROM big) GROUP BY label, topic""")
def cluster_topic_crosstab(spark, d):
    return rounded(tp.cluster_topic_crosstab(topics(spark, d)), "share").withColumnRenamed("User_Needs", "label")


@query(f"""WITH {CTFIDF}, big AS (SELECT topic FROM top GROUP BY topic ORDER BY count(*) DESC, topic LIMIT 15),
u AS (SELECT topic, term, w / sqrt(sum(w * w) OVER (PARTITION BY topic)) AS u FROM cw WHERE topic IN (SELECT topic FROM big))
SELECT a.topic AS topic_a, b.topic AS topic_b, round(sum(a.u * b.u), 5) AS similarity FROM u a JOIN u b USING (term) GROUP BY 1, 2""")
def topic_similarity(spark, d):
    sizes = topics(spark, d).groupBy("topic").agg(F.count("*").alias("n"))
    return rounded(tp.topic_similarity(corpus_ctfidf(spark, d), sizes), "similarity", digits=5)


@query(f"""WITH {q.corpus_tfidf()}, b AS (SELECT doc_id, ('0x' || left(md5(term), 8))::BIGINT % 64 AS b,
  sum(CASE WHEN md5(term)[32] <= '7' THEN weight ELSE -weight END) AS x FROM tfidf GROUP BY 1, 2),
ids AS (SELECT DISTINCT doc_id FROM b)
SELECT ids.doc_id, r.i::INTEGER AS pos, round(coalesce(b.x, 0), 5) AS x FROM ids CROSS JOIN range(64) r(i) LEFT JOIN b ON b.doc_id = ids.doc_id AND b.b = r.i""")
def hashed_embedding(spark, d):
    e = ft.hashed_embedding(ex.corpus_tfidf(s.articles(spark, d), "doc_id"), "doc_id")
    return rounded(e.select("doc_id", F.posexplode("embedding").alias("pos", "x")), "x", digits=5)


# Similarity, duplicates, centroids

@query(f"""WITH {q.VECTORS}, {CENTROIDS} SELECT vec_id, round(sum(x * m) / sqrt(sum(x * x) * sum(m * m)), 5) AS cosine
FROM parts JOIN cent USING (need, i) GROUP BY vec_id""")
def cosine(spark, d):
    v = s.vectors(spark, d)
    c = ag.class_centroids(v, "User_Needs", "embedding").select("User_Needs", "centroid")
    return v.join(c, "User_Needs").select("vec_id", F.round(vx.cosine(F.col("embedding"), F.col("centroid")), 5).alias("cosine"))


def sql_pairs(threshold: float) -> str:
    return f"""{q.corpus_tfidf(2)}, sig AS (SELECT doc_id, md5(string_agg(term || ':' || tf, ',' ORDER BY term)) AS g FROM tfidf GROUP BY doc_id),
grp AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY g) AS rep FROM sig),
allp AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(x.weight * y.weight) AS s FROM tfidf x JOIN tfidf y ON x.term = y.term AND x.doc_id < y.doc_id
  GROUP BY 1, 2 HAVING round(sum(x.weight * y.weight), 10) >= {threshold}),
pairs AS (SELECT a, b, s, 'near' AS kind FROM allp JOIN grp ga ON ga.doc_id = a JOIN grp gb ON gb.doc_id = b WHERE ga.rep = a AND gb.rep = b
  UNION ALL SELECT rep, doc_id, 1.0, 'copy' FROM grp WHERE rep <> doc_id)"""


def duplicate_weights(spark, d):
    return ex.corpus_tfidf(s.articles(spark, d), "doc_id", min_df=2)


@query(f"""WITH {sql_pairs(0.95)} SELECT a AS id_a, b AS id_b, round(s, 4) AS similarity, kind, l.label AS label_a, r.label AS label_b,
left(l.title, 80) AS title_a, left(r.title, 80) AS title_b FROM pairs JOIN articles l ON l.doc_id = a JOIN articles r ON r.doc_id = b""")
def near_duplicates(spark, d):
    return sm.near_duplicates(duplicate_weights(spark, d), s.articles(spark, d), "doc_id")


@query(f"""WITH {sql_pairs(0.95)} SELECT count(*) AS pairs, count(*) FILTER (l.label <> r.label) AS cross_label,
count(*) FILTER ((l.label = 'none') <> (r.label = 'none')) AS labeled_unlabeled FROM allp JOIN articles l ON l.doc_id = a JOIN articles r ON r.doc_id = b""")
def duplicate_label_conflicts(spark, d):
    return sm.duplicate_label_conflicts(duplicate_weights(spark, d), s.articles(spark, d), "doc_id")


@query(f"WITH {sql_pairs(0.8)} SELECT a, b, round(s, 4) AS similarity FROM pairs WHERE kind = 'near'")
def pair_theta(spark, d):
    out = sm.near_duplicates(duplicate_weights(spark, d), s.articles(spark, d), "doc_id", threshold=0.8)
    return out.where("kind = 'near'").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "similarity")


@query(f"""WITH {q.VECTORS}, {CENTROIDS} SELECT a.need AS class_a, b.need AS class_b,
round(sum(a.m * b.m) / sqrt(sum(a.m * a.m) * sum(b.m * b.m)), 6) AS cosine FROM cent a JOIN cent b USING (i) GROUP BY 1, 2""")
def centroid_similarity(spark, d):
    c = ag.class_centroids(s.vectors(spark, d), "User_Needs", "embedding")
    return rounded(sm.centroid_similarity(c, "User_Needs"), "cosine", digits=6)


CROSS = f"""{q.VECTORS}, {CENTROIDS}, crossed AS (SELECT p.vec_id, c.need AS class, sum(x * m) / sqrt(sum(x * x) * sum(m * m)) AS cosine
  FROM parts p JOIN cent c USING (i) WHERE p.need = 'none' GROUP BY 1, 2),
best AS (SELECT vec_id, class, cosine FROM crossed QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, class) = 1)"""


@query(f"WITH {CROSS} SELECT vec_id, class, round(cosine, 5) AS cosine FROM crossed")
def centroid_cross(spark, d):
    v = s.vectors(spark, d)
    c = ag.class_centroids(v, "User_Needs", "embedding")
    _, unlabeled = fl.split_labeled_unlabeled(v)
    return rounded(sm.centroid_cross(unlabeled, c, "vec_id", "User_Needs", "embedding"), "cosine", digits=5)


def pseudo(spark, d):
    v = s.vectors(spark, d)
    return sm.pseudo_labels(v, "vec_id", "User_Needs", "embedding", F.col("User_Needs") != cfg.UNLABELED)


@query(f"""WITH {CROSS} SELECT vec_id, class AS pseudo_label, round(cosine, 5) AS pseudo_confidence,
row_number() OVER (PARTITION BY class ORDER BY cosine DESC, vec_id)::INTEGER AS rank FROM best
QUALIFY row_number() OVER (PARTITION BY class ORDER BY cosine DESC, vec_id) <= 50""")
def pseudo_labels(spark, d):
    out = topn_per_class(pseudo(spark, d)).select("vec_id", "pseudo_label", "pseudo_confidence", "rank")
    return rounded(out, "pseudo_confidence", digits=5).orderBy(F.desc("pseudo_confidence"), "vec_id")


@query(f"WITH {CROSS} SELECT class AS pseudo_label, count(*) AS n FROM best WHERE cosine >= 0.15 GROUP BY class")
def conf_threshold(spark, d):
    return fl.conf_threshold(pseudo(spark, d), at_least=0.15)


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
c AS (SELECT vec_id, e, list_transform(e, lambda x: x - list_avg(e)) AS m FROM v),
p AS (SELECT a.vec_id, b.vec_id AS neighbour, list_distance(a.e, b.e) AS euclidean, 1 - list_cosine_similarity(a.e, b.e) AS cosine,
  1 - list_cosine_similarity(a.m, b.m) AS correlation FROM c a JOIN c b ON a.vec_id <> b.vec_id),
l AS (UNPIVOT p ON euclidean, cosine, correlation INTO NAME metric VALUE dist),
r AS (SELECT *, row_number() OVER (PARTITION BY metric, vec_id ORDER BY dist, neighbour)::INTEGER AS rank FROM l)
SELECT k::INTEGER AS k, metric, vec_id, rank, neighbour, round(dist, 5) AS distance FROM r JOIN (VALUES (5),(10),(15)) g(k) ON rank <= k""")
def knn_graph(spark, d):
    return rounded(bl.knn_sweep(s.table(spark, d, "embeddings"), "vec_id", "embedding"), "distance", digits=5)


# Projection, clustering, topics

@query()
def project_5d(spark, d):
    return cl.project(s.vectors(spark, d), "embedding", cfg.CLUSTER_DIMS).select("vec_id", "projected")


@query()
def project_2d(spark, d):
    return cl.project(s.vectors(spark, d), "embedding", cfg.DISPLAY_DIMS).select("vec_id", "projected")


def projected(spark, d):
    return cl.project(s.vectors(spark, d), "embedding").select("vec_id", "User_Needs", "projected")


@query()
def kmeans(spark, d):
    return cl.kmeans(projected(spark, d), "projected", 6).select("vec_id", "cluster")


@query()
def kmeans_sweep(spark, d):
    return cl.kmeans_sweep(projected(spark, d), "vec_id", "projected")


EPS = 1.25


@query(f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_distance(a.e, b.e) AS dist FROM v a JOIN v b ON a.vec_id <> b.vec_id),
core AS (SELECT a FROM p WHERE dist <= {EPS} GROUP BY a HAVING count(*) >= 10),
edge AS (SELECT a, b FROM p WHERE dist <= {EPS} AND a IN (FROM core) AND b IN (FROM core)),
reach AS (SELECT a AS node, a AS root FROM core UNION SELECT edge.b, reach.root FROM reach JOIN edge ON reach.node = edge.a),
comp AS (SELECT node, min(root) AS c FROM reach GROUP BY node),
big AS (SELECT c FROM comp GROUP BY c HAVING count(*) >= 50)
SELECT v.vec_id, coalesce(CASE WHEN c IN (FROM big) THEN c END, -1)::BIGINT AS cluster FROM v LEFT JOIN comp ON v.vec_id = comp.node""")
def density_clusters(spark, d):
    return cl.density_clusters(s.table(spark, d, "embeddings"), "vec_id", "embedding", EPS)


@query()
def nmf_topics(spark, d):
    model = tp.nmf_topics(ex.corpus_tfidf(s.articles(spark, d), "doc_id"), "doc_id")
    return model.top_words(12)


@query()
def topic_alignment(spark, d):
    articles = s.articles(spark, d)
    weights = ex.corpus_tfidf(articles, "doc_id")
    return tp.topic_alignment(tp.nmf_topics(weights, "doc_id"), weights, articles, "doc_id")


# Supervised learning

def vector_split(spark, d):
    """Labeled vectors with features, codes, balanced weights and split, written once for all fits."""
    labeled, _ = fl.split_labeled_unlabeled(s.vectors(spark, d))
    split = stratified_split(labeled, "User_Needs", "vec_id")
    rows = settled(ln.training_frame(ln.vector_features(split, "embedding"), "User_Needs"))
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def scored(spark, d, fit):
    train, test = vector_split(spark, d)
    out = fit(train).transform(test)
    return out.select("vec_id", "label_idx", "prediction", F.array_max("proba").alias("confidence"))


@query()
def lr(spark, d):
    return scored(spark, d, ln.fit_lr)


@query()
def svc_calibrated(spark, d):
    return scored(spark, d, lambda t: ln.fit_svc_calibrated(t, "vec_id"))


@query()
def gbm(spark, d):
    return scored(spark, d, ln.fit_gbm)


@query()
def rf(spark, d):
    return scored(spark, d, ln.fit_rf)


@query()
def gaussian_nb(spark, d):
    return scored(spark, d, ln.fit_gaussian_nb)


SPLIT = """sp AS (SELECT vec_id, need, CASE WHEN row_number() OVER (PARTITION BY need ORDER BY md5('42|' || vec_id), vec_id)
  <= round(0.2 * count(*) OVER (PARTITION BY need)) THEN 'test' ELSE 'train' END AS split FROM vecs WHERE need <> 'none')"""


@query(f"""WITH {q.VECTORS}, {SPLIT}, top AS (SELECT need FROM sp WHERE split = 'train' GROUP BY need ORDER BY count(*) DESC, need LIMIT 1)
SELECT vec_id, need AS truth, (FROM top) AS prediction FROM sp WHERE split = 'test'""")
def majority_baseline(spark, d):
    labeled, _ = fl.split_labeled_unlabeled(s.vectors(spark, d).select("vec_id", "User_Needs"))
    rows = stratified_split(labeled, "User_Needs", "vec_id")
    out = ln.majority_baseline(rows.where("split = 'train'"), rows.where("split = 'test'"), "User_Needs")
    return out.select("vec_id", F.col("User_Needs").alias("truth"), "prediction")


@query()
def ffnn(spark, d):
    return scored(spark, d, lambda t: ln.fit_ffnn(t, "vec_id"))


@query()
def model_registry_factory(spark, d):
    """Predictions per model and class from freshly fitted registry entries."""
    train, test = vector_split(spark, d)
    out = None
    for name, model in ln.fit_all(ln.model_registry("vec_id"), train).items():
        counts = model.transform(test).groupBy("prediction").agg(F.count("*").alias("n"))
        part = counts.select(F.lit(name).alias("model"), "prediction", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query()
def train_and_evaluate(spark, d):
    train, test = vector_split(spark, d)
    return ln.train_and_evaluate(ln.model_registry("vec_id")["LR"], train, test)[1]


@query()
def compare_models(spark, d):
    registry = ln.model_registry("vec_id")
    train, test = vector_split(spark, d)
    return ln.compare_models(registry, train, test)[0]


_MODELS = ", ".join(f"('{m}')" for m in ("LR", "SVC", "GBM", "RF", "NB", "FFNN", "Dummy"))


@query(f"""WITH {q.VECTORS}, {SPLIT}, t AS (SELECT count(*) AS n FROM sp WHERE split = 'test')
SELECT model, n AS scored, n AS sums_to_one, n AS highest_wins, n AS known_label FROM t, (VALUES {_MODELS}) m(model)""")
def fitted_model_invariants(spark, d):
    """What must hold for every fitted model: a probability per class, their sum, and the winner's."""
    train, test = vector_split(spark, d)
    classes, out = len(s.VECTOR_LABELS), None
    for name, model in ln.fit_all(ln.model_registry("vec_id"), train).items():
        rows = model.transform(test)
        total = F.aggregate("proba", F.lit(0.0), lambda a, x: a + x)
        mine = F.get("proba", F.col("prediction").cast("int"))
        part = rows.agg(
            F.count("*").alias("scored"),
            F.count_if((F.abs(total - 1) < 1e-6) & (F.size("proba") == classes)).alias("sums_to_one"),
            F.count_if(mine >= F.array_max("proba") - 1e-9).alias("highest_wins"),
            F.count_if(F.col("prediction").isin(*map(float, range(classes)))).alias("known_label"),
        ).select(F.lit(name).alias("model"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def text_rows(spark, d):
    labeled, _ = fl.split_labeled_unlabeled(s.articles(spark, d))
    docs = ft.document_tokens(labeled, "doc_id", keep=["User_Needs"])
    return ln.training_frame(docs, "User_Needs")


def text_split(spark, d):
    split = settled(stratified_split(text_rows(spark, d), "User_Needs", "doc_id"))
    return split.where("split = 'train'"), split.where("split = 'test'")


@query()
def tfidf_classifier(spark, d):
    train, test = text_split(spark, d)
    model = ln.fit_tfidf_classifier(ln.fit_lr, "doc_id")(train)
    return model.transform(test).select("doc_id", "label_idx", "prediction")


@query()
def tfidf_svc_classifier(spark, d):
    """TF-IDF to calibrated SVC, stored as one unit and scored after loading it."""
    train, test = text_split(spark, d)
    model = ln.fit_tfidf_classifier(lambda t: ln.fit_svc_calibrated(t, "doc_id"), "doc_id")(train)
    out = scratch_output(spark, "text-classifier")
    model.save(out)
    return ln.TextClassifier.load(spark, out).transform(test).select("doc_id", "label_idx", "prediction")


@query()
def cross_validate(spark, d):
    return ln.cross_validate(ln.fit_tfidf_classifier(ln.fit_lr, "doc_id"), text_rows(spark, d), "doc_id")


@query()
def cross_validate_svc(spark, d):
    """Macro-F1 per fold of TF-IDF to calibrated SVC."""
    fit = ln.fit_tfidf_classifier(lambda t: ln.fit_svc_calibrated(t, "doc_id"), "doc_id")
    return ln.cross_validate(fit, settled(text_rows(spark, d)), "doc_id")


@query()
def save_model(spark, d):
    from pyspark.ml.classification import LogisticRegressionModel

    train, test = vector_split(spark, d)
    model, out = ln.fit_lr(train), scratch_output(spark, "models")
    st.save_model(model, out, "lr", {"rows": train.count()})
    st.save_label_encoder(encode_labels(train, "User_Needs"), out)
    back, _ = st.load_model(spark, out, "lr", LogisticRegressionModel)
    names = st.load_label_encoder(spark, out).withColumnRenamed("User_Needs", "predicted")
    return back.transform(test).select("vec_id", "prediction").join(
        names.select("predicted", F.col("label_idx").cast("double").alias("prediction")), "prediction"
    ).select("vec_id", "predicted")


VOTES = """votes AS (SELECT vec_id, need, label, (label % 3)::INTEGER AS m1, (vec_id % 3)::INTEGER AS m2, ((vec_id // 2) % 3)::INTEGER AS m3 FROM vecs)"""


def votes(spark, d):
    v = s.vectors(spark, d)
    third = F.floor(F.col("vec_id") / 2) % 3
    return v.withColumns({"m1": (F.col("label") % 3).cast("int"), "m2": (F.col("vec_id") % 3).cast("int"), "m3": third.cast("int")})


@query(f"""WITH {q.VECTORS}, {VOTES} SELECT vec_id, vote AS prediction FROM (SELECT vec_id, vote, count(*) AS n FROM
(UNPIVOT (SELECT vec_id, m1, m2, m3 FROM votes) ON m1, m2, m3 INTO NAME m VALUE vote) GROUP BY vec_id, vote)
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, vote) = 1""")
def majority_vote(spark, d):
    return ln.majority_vote(votes(spark, d), "vec_id", ["m1", "m2", "m3"])


@query(f"""WITH {q.VECTORS} SELECT vec_id, i::INTEGER AS class, round((a + b) / 2, 5) AS p FROM (SELECT vec_id, unnest(v[1:10]) AS a,
unnest(v[11:20]) AS b, generate_subscripts(v[1:10], 1) - 1 AS i FROM vecs)""")
def mean_proba(spark, d):
    v = s.vectors(spark, d).select(
        "vec_id", F.slice("embedding", 1, 10).alias("a"), F.slice("embedding", 11, 10).alias("b")
    )
    out = ln.mean_proba(v, "vec_id", ["a", "b"]).select("vec_id", F.posexplode("proba").alias("class", "p"))
    return rounded(out, "p", digits=5)


# Evaluation

EVAL = f"""{q.VECTORS}, ev AS (SELECT label AS t, CASE WHEN vec_id % 4 = 0 THEN (label + 1) % 7 ELSE label % 7 END AS p FROM vecs),
cl AS (SELECT t AS c FROM ev UNION SELECT p FROM ev),
per AS (SELECT c, (SELECT count(*) FROM ev WHERE t = c AND p = c) AS hit, (SELECT count(*) FROM ev WHERE p = c) AS called,
  (SELECT count(*) FROM ev WHERE t = c) AS support FROM cl),
f AS (SELECT c, coalesce(hit / nullif(called, 0), 0) AS prec, coalesce(hit / nullif(support, 0), 0) AS rec,
  coalesce(2.0 * hit / nullif(called + support, 0), 0) AS f1, support, hit FROM per)"""


def predicted(spark, d):
    wrong = (F.col("label") + 1) % 7
    guess = F.when(F.col("vec_id") % 4 == 0, wrong).otherwise(F.col("label") % 7)
    return s.vectors(spark, d).withColumn("guess", guess)


@query(f"WITH {EVAL} SELECT round(sum(hit) / sum(support), 6) AS acc, round(avg(f1), 6) AS f1_macro, round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM f")
def classification_scores(spark, d):
    return rounded(ev.classification_scores(predicted(spark, d), "label", "guess"), "acc", "f1_macro", "f1_weighted", digits=6)


@query(f"""WITH {EVAL} SELECT c::VARCHAR AS class, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1, support::BIGINT AS support FROM f
UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), sum(support)::BIGINT FROM f
UNION ALL SELECT 'macro avg', round(avg(prec), 6), round(avg(rec), 6), round(avg(f1), 6), sum(support)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', round(sum(prec * support) / sum(support), 6), round(sum(rec * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM f""")
def classification_report(spark, d):
    return rounded(ev.classification_report(predicted(spark, d), "label", "guess"), "precision", "recall", "f1", digits=6)


@query(f"""WITH {EVAL} SELECT a.c::VARCHAR AS truth, b.c::VARCHAR AS predicted, (SELECT count(*) FROM ev WHERE t = a.c AND p = b.c) AS n FROM cl a CROSS JOIN cl b""")
def confusion_matrix(spark, d):
    return ev.confusion_matrix(predicted(spark, d), "label", "guess")


@query(f"WITH {EVAL} SELECT round(avg((t = p)::INT), 6) AS accuracy FROM ev")
def val_accuracy(spark, d):
    return rounded(ev.val_accuracy(predicted(spark, d), "label", "guess"), "accuracy", digits=6)


def sql_ari(cluster: str, name: str) -> str:
    return f"""{name}_n AS (SELECT need AS t, {cluster} AS p, count(*) AS n FROM given WHERE need <> 'none' GROUP BY 1, 2),
{name}_t AS (SELECT t, sum(n) AS n FROM {name}_n GROUP BY t), {name}_p AS (SELECT p, sum(n) AS n FROM {name}_n GROUP BY p),
{name}_s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM {name}_n) AS s, (SELECT sum(n * (n - 1) / 2) FROM {name}_t) AS a,
  (SELECT sum(n * (n - 1) / 2) FROM {name}_p) AS b, (SELECT sum(n) FROM {name}_n) AS c),
{name} AS (SELECT (s - a * b / (c * (c - 1) / 2)) / ((a + b) / 2 - a * b / (c * (c - 1) / 2)) AS ari,
  (SELECT sum(x.n / c * ln(x.n * c / (y.n * z.n))) FROM {name}_n x JOIN {name}_t y USING (t) JOIN {name}_p z USING (p))
  / ((SELECT sum(-n / c * ln(n / c)) FROM {name}_t) + (SELECT sum(-n / c * ln(n / c)) FROM {name}_p)) * 2 AS nmi FROM {name}_s)"""


def sql_silhouette(cluster: str, name: str, where: str = "true") -> str:
    return f"""{name}_m AS (SELECT x.vec_id, x.{cluster} AS own, y.{cluster} AS other, sum(list_distance(x.v, y.v)) AS d, count(*) AS n
  FROM given x JOIN given y ON true WHERE x.{cluster} <> -1 AND y.{cluster} <> -1 AND x.{where} AND y.{where} GROUP BY 1, 2, 3),
{name} AS (SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM (
  SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN d / (n - 1) END) AS a, min(CASE WHEN own <> other THEN d / n END) AS b FROM {name}_m GROUP BY vec_id))"""


@query(f"WITH {q.VECTORS}, {ASSIGNED}, {sql_ari('cluster', 'r')} SELECT round(ari, 6) AS ari, round(nmi, 6) AS nmi FROM r")
def ari_nmi(spark, d):
    labeled, _ = fl.split_labeled_unlabeled(assigned(spark, d))
    return rounded(ev.ari_nmi(labeled, "User_Needs", "cluster"), "ari", "nmi", digits=6)


@query(f"WITH {q.VECTORS}, {ASSIGNED}, {sql_silhouette('cluster', 'sil', 'vec_id >= 0')} SELECT round(silhouette, 6) AS silhouette FROM sil")
def silhouette(spark, d):
    return rounded(bl.silhouette(assigned(spark, d), "vec_id", "embedding", "cluster"), "silhouette", digits=6)


@query(f"""WITH {q.VECTORS}, {ASSIGNED}, m AS (SELECT x.vec_id, x.cluster AS own, y.cluster AS other, sum(pow(list_distance(x.v, y.v), 2)) AS d, count(*) AS n
  FROM given x JOIN given y ON true WHERE x.cluster <> -1 AND y.cluster <> -1 GROUP BY 1, 2, 3)
SELECT round(avg((b - a) / greatest(a, b)), 5) AS silhouette_squared FROM (SELECT vec_id, max(CASE WHEN own = other THEN d / (n - 1) END) AS a,
  min(CASE WHEN own <> other THEN d / n END) AS b FROM m GROUP BY vec_id)""")
def silhouette_squared(spark, d):
    return rounded(bl.silhouette_squared(assigned(spark, d), "vec_id", "embedding", "cluster"), "silhouette_squared", digits=5)


@query(f"""WITH {q.VECTORS}, {ASSIGNED}, {sql_ari('cluster', 'r')}, {sql_ari('other', 'o')}, {sql_silhouette('cluster', 's1', "need <> 'none'")},
{sql_silhouette('other', 's2', "need <> 'none'")}
SELECT 'density' AS algorithm, round(ari, 6) AS ari, round(nmi, 6) AS nmi, (SELECT round(silhouette, 6) FROM s1) AS silhouette, 4::BIGINT AS n_clusters,
  (SELECT count(*) FROM given WHERE cluster = -1) AS n_noise FROM r
UNION ALL SELECT 'kmeans', round(ari, 6), round(nmi, 6), (SELECT round(silhouette, 6) FROM s2), 6::BIGINT, 0::BIGINT FROM o""")
def evaluate_clusterings(spark, d):
    out = ev.evaluate_clusterings(assigned(spark, d), {"density": "cluster", "kmeans": "other"}, "vec_id", "embedding")
    return rounded(out, "ari", "nmi", "silhouette", digits=6)


# Inference

@query()
def predict_top_k(spark, d):
    train, test = vector_split(spark, d)
    return inf.predict_top_k(ln.fit_lr(train), test, "vec_id", s.VECTOR_LABELS)


@query(f"WITH {q.VECTORS}, {SOFTMAX}, {TOP_TAGS} SELECT * FROM wide")
def predict_top_k_logits(spark, d):
    return inf.predict_top_k_logits(logits(spark, d), "vec_id", "logits", s.VECTOR_LABELS)


@query()
def score_unlabeled(spark, d):
    v = ln.vector_features(s.vectors(spark, d), "embedding").withColumn("Title", F.concat(F.lit("vector "), "vec_id"))
    train, _ = vector_split(spark, d)
    return inf.score_unlabeled(ln.fit_lr(train), v, "vec_id", s.VECTOR_LABELS)
