import math
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.functions import text as tx
from tagloom.operators import blocks as bl
from tagloom.operators import clustering as cl
from tagloom.operators import evaluation as ev
from tagloom.operators import features as ft
from tagloom.operators import inference as inf
from tagloom.operators import learning as ln
from tagloom.operators import similarity as sm
from tagloom.operators import topics as tp
from tagloom.operators.aggregates import class_centroids
from tagloom.sources import stores as st
from tagloom.sources import tables as tb
from tagloom.streaming.incremental import IncrementalExtract


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    centers = np.array([[0, 0, 0], [8, 0, 0], [0, 8, 0]])
    data = [(int(i), int(i % 3), (centers[i % 3] + rng.normal(0, 0.5, 3)).tolist()) for i in range(180)]
    return spark.createDataFrame(data, "id long, label int, v array<double>").persist()


def matrix(blobs):
    got = blobs.orderBy("id").collect()
    return np.array([r["v"] for r in got]), np.array([r["label"] for r in got])


def test_blocks_equal_one_block_and_brute_force(blobs):
    x, y = matrix(blobs)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    small = {(r["id"], r["rank"]): r["neighbour"] for r in bl.knn_graph(blobs, "id", "v", 3, ("euclidean",), 50).collect()}
    np.fill_diagonal(d, np.inf)
    assert all(small[(i, 1)] == d[i].argmin() for i in range(len(x)))
    np.fill_diagonal(d, 0)
    scores = []
    for i in range(len(x)):
        a = d[i][y == y[i]].sum() / ((y == y[i]).sum() - 1)
        b = min(d[i][y == c].mean() for c in set(y) - {y[i]})
        scores.append((b - a) / max(a, b))
    for block_rows in (50, 1000):
        assert abs(bl.silhouette(blobs, "id", "v", "label", block_rows).first()[0] - np.mean(scores)) < 1e-9


def far_blobs(spark, n=600, d=5, groups=12):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 40, (groups, d))
    rows = [(f"row{i}", (centres[i % groups] + rng.normal(0, 1, d)).tolist()) for i in range(n)]
    rows += [(f"copy{i}", rows[0][1]) for i in range(60)] + [("zero", [0.0] * d)]
    return spark.createDataFrame(rows, "id string, v array<double>")


def test_cells_give_the_same_neighbours_and_skip_far_cells(spark):
    from tagloom.operators.pivots import Cells

    df = far_blobs(spark).persist()
    n = df.count()
    whole = bl.knn_graph(df, "id", "v", 4, block_rows=n)
    cells = bl.knn_graph(df, "id", "v", 4, block_rows=25)
    a, b = ({(r["metric"], r["id"], r["rank"]): (r["neighbour"], r["distance"]) for r in g.collect()} for g in (cells, whole))
    assert a.keys() == b.keys() and all(a[x][0] == b[x][0] and a[x][1] == pytest.approx(b[x][1], abs=1e-9) for x in a)

    def groups(edges):
        parts = cl.connected_components(df.select(F.col("id").alias("node")), edges)
        return {(r["node"], r["component"]) for r in parts.collect()}

    by_blocks = bl.density_edges(df, "id", "v", 3.0, block_rows=n)
    assert groups(bl.density_edges(df, "id", "v", 3.0, block_rows=25)) == groups(by_blocks)
    c = Cells(df, "id", "v", n, 25)
    sent = c.asked(k=4).agg(F.sum(F.size("cells"))).first()[0]
    assert len(c.pivots) > 20 and sent < 0.3 * n * len(c.pivots)


def test_silhouette_edges(spark, blobs):
    one = blobs.withColumn("label", F.lit(1))
    assert bl.silhouette(one, "id", "v", "label").first()[0] is None
    lone = spark.createDataFrame([(1, 0, [0.0]), (2, 1, [1.0])], "id long, label int, v array<double>")
    assert bl.silhouette(lone, "id", "v", "label").first()[0] == 0.0


def test_density_clusters_find_blobs_and_survive_copies(spark, blobs):
    copies = spark.range(1000, 1100).select("id", F.lit(0).alias("label"), F.array(F.lit(0.1), F.lit(0.1), F.lit(0.1)).alias("v"))
    far = spark.createDataFrame([(5000, 9, [90.0, 90.0, 90.0])], "id long, label int, v array<double>")
    df = blobs.unionByName(copies).unionByName(far)
    out = cl.density_clusters(df, "id", "v", 2.0, 50, 5, block_rows=64).join(df, "id")
    groups = {r["label"]: r["c"] for r in out.groupBy("label").agg(F.collect_set("cluster").alias("c")).collect()}
    assert groups[9] == [-1] and sorted(groups[i][0] for i in range(3)) == [0, 1, 2] and all(len(groups[i]) == 1 for i in range(3))


def test_components_of_a_chain(spark):
    nodes = spark.range(60).withColumnRenamed("id", "node")
    edges = spark.range(59).where("id != 29").select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = {r["component"] for r in cl.connected_components(nodes, edges).collect()}
    assert got == {0, 30}


def test_kmeans_and_pca(blobs):
    sweep = cl.kmeans_sweep(blobs, "id", "v", [2, 3, 4], restarts=2).orderBy("k").collect()
    assert [r["k"] for r in sweep if r["is_best"]] == [3] and sweep[0]["inertia"] > sweep[1]["inertia"]
    out = cl.kmeans(blobs, "v", 3, restarts=2)
    assert ev.ari_nmi(out, "label", "cluster").first()["ari"] == pytest.approx(1.0)
    p = cl.project(blobs, "v", 2).select(F.variance(F.col("projected")[0]), F.variance(F.col("projected")[1])).first()
    assert p[0] >= p[1]


def test_ari_nmi_edges(spark):
    same = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1)], "t string, c int")
    assert tuple(ev.ari_nmi(same, "t", "c").first()) == (pytest.approx(1.0), pytest.approx(1.0))
    one = spark.createDataFrame([("a", 0), ("b", 0), ("b", 0)], "t string, c int")
    assert tuple(ev.ari_nmi(one, "t", "c").first()) == (pytest.approx(0.0), pytest.approx(0.0))


def test_scores_with_absent_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "a")], "t string, p string")
    s = ev.classification_scores(df, "t", "p").first()
    assert s["acc"] == pytest.approx(1 / 3) and s["f1_macro"] == pytest.approx(0.5 / 3) and s["f1_weighted"] == pytest.approx(1 / 3)
    assert ev.confusion_matrix(df, "t", "p").count() == 9
    assert ev.val_accuracy(df.limit(0), "t", "p").first()[0] == 0.0


def test_jsd(spark):
    data = [("x", "a", 0.5), ("y", "a", 0.5), ("x", "b", 0.5), ("y", "b", 0.5), ("x", "c", 1e-300), ("z", "c", 1.0)]
    same = spark.createDataFrame(data[:4], "term string, User_Needs string, p double")
    assert all(r["jsd"] < 1e-9 for r in sm.jsd_matrix(same).collect())
    apart = spark.createDataFrame([("x", "a", 1.0), ("z", "a", 1e-300), ("x", "c", 1e-300), ("z", "c", 1.0)], same.schema)
    got = {(r["class_a"], r["class_b"]): r["jsd"] for r in sm.jsd_matrix(apart).collect()}
    assert got[("a", "c")] == pytest.approx(math.sqrt(math.log(2))) and got[("c", "a")] == got[("a", "c")]


def test_nearest_class_chunks_agree(spark, blobs):
    c = class_centroids(blobs, "label", "v")
    more = spark.createDataFrame([(999, 0, [0.0, 0.0, 0.0])], blobs.schema)
    df = blobs.unionByName(more)
    one = sm.nearest_class(df, c, "id", "label", "v").select("id", "pseudo_label", F.round("pseudo_confidence", 9))
    two = sm.nearest_class(df, c, "id", "label", "v", chunks=2).select("id", "pseudo_label", F.round("pseudo_confidence", 9))
    assert one.exceptAll(two).isEmpty() and one.where("id = 999").first()["pseudo_label"] is None


def pair_frame(spark):
    texts = {1: "apple pear plum fig", 2: "apple pear plum fig", 3: "apple pear plum fig date", 4: "stone iron coal", 5: "stone iron coal tin", 6: ""}
    docs = spark.createDataFrame([(k, v.split()) for k, v in texts.items()], "id long, tokens array<string>")
    counts = ft.term_counts(docs, "id", hi=1)
    return ft.tfidf(counts, ft.vocabulary(counts, ft.row_count(docs), 1, 1.0), "id").persist()


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95])
def test_similar_pairs_match_brute_force(spark, threshold, monkeypatch):
    monkeypatch.setattr(sm, "_POSTINGS_PER_TASK", 2)
    w = pair_frame(spark)
    v = {}
    for r in w.collect():
        v.setdefault(r["id"], {})[r["term"]] = r["weight"]
    brute = {(a, b) for a in v for b in v if a < b and sum(x * v[b].get(t, 0) for t, x in v[a].items()) >= threshold - 1e-12}
    for prefix in (True, False):
        assert {(r["a"], r["b"]) for r in sm.similar_pairs(w, "id", threshold, prefix).collect()} == brute


@pytest.mark.parametrize("per_task", [16, 4096])
def test_candidates_of_long_texts_are_hardly_more_than_the_pairs(spark, per_task, monkeypatch):
    """Long documents that share half of their terms: a coarse sketch would let their pairs pass."""
    monkeypatch.setattr(sm, "_POSTINGS_PER_TASK", per_task)
    rows = [(f"d{i:02}", f"t{t}", 2, 200**-0.5) for i in range(24) for t in range(100)]
    rows += [(f"d{i:02}", f"own{i // 2}-{t}", 50, 200**-0.5) for i in range(24) for t in range(100)]
    w = spark.createDataFrame(rows, "id string, term string, df long, weight double")
    got = {(r["a"], r["b"]) for r in sm.candidate_pairs(w, "id", 0.8).collect()}
    assert got == {(f"d{i:02}", f"d{i + 1:02}") for i in range(0, 24, 2)}


def test_candidates_hold_all_similar_pairs_and_few_others(spark):
    """Bounds at the posting join: nothing similar is lost, most meetings are ruled out there."""
    rng = np.random.default_rng(11)
    base = [rng.choice(400, 40, replace=False) for _ in range(60)]
    docs = [(i, [f"t{x}" for x in (b if i % 3 else np.r_[b[:38], rng.integers(0, 400, 2)])]) for i, b in enumerate(base + base)]
    counts = ft.term_counts(spark.createDataFrame(docs, "id long, tokens array<string>"), "id", hi=1)
    df = spark.createDataFrame(docs, "id long, tokens array<string>")
    w = ft.tfidf(counts, ft.vocabulary(counts, ft.row_count(df), 1, 1.0, None), "id").persist()
    v = {}
    for r in w.collect():
        v.setdefault(r["id"], {})[r["term"]] = r["weight"]
    brute = {(a, b) for a in v for b in v if a < b and sum(x * v[b].get(t, 0) for t, x in v[a].items()) >= 0.9}
    got = {(r["a"], r["b"]) for r in sm.candidate_pairs(w.select("id", "term", "df", "weight"), "id", 0.9).collect()}
    prefixes = sm._prefixes(w, "id", 0.9).select("id", "term").toDF("a", "term")
    meetings = prefixes.join(prefixes.withColumnRenamed("a", "b"), "term").where("a < b").select("a", "b").distinct().count()
    assert len(brute) >= 40 and brute <= got and len(got) - len(brute) < 0.05 * (meetings - len(brute))


def test_copies_stay_linear_and_counts_exact(spark):
    docs = spark.range(60).select("id", F.when(F.col("id") < 40, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"), F.lit("c"))).alias("tokens"))
    counts = ft.term_counts(docs, "id", hi=1)
    w = ft.tfidf(counts, ft.vocabulary(counts, ft.row_count(docs), 1, 1.0), "id")
    articles = docs.select("id", F.lit("t").alias("Title"), F.when(F.col("id") % 2 == 0, "none").otherwise("x").alias("User_Needs"))
    out = sm.near_duplicates(w, articles, "id")
    assert out.count() == 58 and {r["kind"] for r in out.collect()} == {"copy"}
    got = sm.duplicate_label_conflicts(w, articles, "id").first()
    assert tuple(got) == (40 * 39 // 2 + 20 * 19 // 2, 20 * 20 + 10 * 10, 20 * 20 + 10 * 10)


def test_nmf_loss_never_rises(spark):
    docs = spark.range(40).select("id", F.when(F.col("id") % 2 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("x"), F.lit("y"), F.lit("c"))).alias("tokens"))
    counts = ft.term_counts(docs, "id", hi=1)
    w = ft.tfidf(counts, ft.vocabulary(counts, ft.row_count(docs), 1, 1.0), "id")
    model = tp.nmf_topics(w, "id", 2)
    assert all(b <= a + 1e-9 for a, b in zip(model.losses, model.losses[1:])) and model.losses[-1] < 0.1
    assert model.topics.where("weight < 0").isEmpty()
    assert {tuple(np.array(r["topics"]).argsort()) for r in model.document_topics(w).where("id % 2 = 0").collect()}.__len__() == 1


def training(spark, blobs):
    return ln.training_frame(ln.vector_features(blobs, "v"), "label")


def test_classifiers_on_blobs(spark, blobs, tmp_path):
    train = training(spark, blobs).persist()
    fits = {"lr": ln.fit_lr, "nb": ln.fit_gaussian_nb, "rf": lambda t: ln.fit_rf(t, 5, 4), "gbm": lambda t: ln.fit_gbm(t, 2, 2),
            "svc": lambda t: ln.fit_svc_calibrated(t, "id", 2, 10), "ffnn": lambda t: ln.fit_ffnn(t, "id", (16,), 60)}
    for name, fit in fits.items():
        model = fit(train)
        out = model.transform(train)
        total = out.select(F.aggregate("proba", F.lit(0.0), lambda a, x: a + x).alias("s")).agg(F.min("s"), F.max("s")).first()
        assert total[0] == pytest.approx(1.0) and total[1] == pytest.approx(1.0), name
        floor = 0.6 if name == "ffnn" else 0.95
        assert ev.val_accuracy(out, "label_idx", "prediction").first()[0] >= floor, name
    results, models = ln.compare_models({"lr": ln.fit_lr, "dummy": ln.fit_majority}, train, train)
    assert [r["model"] for r in results.collect()] == ["lr", "dummy"]
    assert inf.predict_top_k(models["lr"], train, "id", ["0", "1", "2"], 2).columns[-1] == "confidence_2"
    svc = fits["svc"](train)
    st.save_model(svc, str(tmp_path), "svc", {"acc": 1.0})
    back, meta = st.load_model(spark, str(tmp_path), "svc", ln.CalibratedSvc)
    a, b = (m.transform(train).select("id", F.round(F.col("proba")[0], 9).alias("p")) for m in (svc, back))
    assert a.exceptAll(b).isEmpty() and meta.first()["metrics"] == {"acc": 1.0}


def test_text_classifier_fits_idf_inside_folds(spark, tmp_path):
    words = {"a": "bridge road traffic", "b": "garden flower seed", "c": "music stage guitar"}
    data = [(i * 3 + j, c, (words[c] + f" x{i}").split()) for i in range(8) for j, c in enumerate(words)]
    docs = spark.createDataFrame(data, "id long, User_Needs string, tokens array<string>")
    train = ln.training_frame(docs, "User_Needs")
    fit = ln.fit_tfidf_classifier(lambda t: ln.fit_lr(t, 20), "id", ln.TfidfVectorizer("id", min_df=2))
    out = ln.cross_validate(fit, train, "id", 2)
    assert out.count() == 2 and out.first()["mean"] == pytest.approx(1.0)
    model = ln.TfidfVectorizer("id", min_df=2).fit(docs)
    st.save_vectorizer(model, str(tmp_path))
    a = model.transform(docs).select("id", "features").orderBy("id").collect()
    b = st.load_vectorizer(spark, str(tmp_path), "id").transform(docs).select("id", "features").orderBy("id").collect()
    assert a == b and abs(float(np.linalg.norm(a[0]["features"].toArray())) - 1.0) < 1e-9


def test_sources(spark, tmp_path):
    rows = spark.createDataFrame([("1", 'a "q"\n b ,', None)], "Apikey string, Title string, Views double")
    tb.write_articles(rows, str(tmp_path / "csv"), "csv")
    assert [tuple(r) for r in tb.read_export(spark, str(tmp_path / "csv"), rows.columns, multi_line=True).collect()] == [tuple(rows.first())]
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        tb.write_articles(rows, str(tmp_path / "csv"), "csv")
    tb.append_rows(rows.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    store = st.EmbeddingStore(spark, str(tmp_path / "store"))
    docs, calls = spark.createDataFrame([(1,), (2,)], "id long"), []

    def encode(df):
        calls.append(df.count())
        return df.select("id", F.array(F.lit(1.0)).alias("embedding"))

    assert store.ensure(docs.where("id = 1"), "id", "m", "t", encode).count() == 1
    assert store.ensure(docs, "id", "m", "t", encode).count() == 2 and store.ensure(docs, "id", "m", "t", encode).count() == 2
    assert calls == [1, 1]
    assert st.load_model_registry(spark, str(tmp_path / "missing")).isEmpty()
    with pytest.raises(ValueError):
        st.read_embedding_store(docs, "x")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cross_join_or_python(spark, blobs):
    w = pair_frame(spark)
    c = class_centroids(blobs, "label", "v")
    for df in (sm.similar_pairs(w, "id", 0.9), sm.nearest_class(blobs, c, "id", "label", "v"), w):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text and "Pandas" not in text


def test_plans_trim_and_push_down(spark, tmp_path):
    from tagloom.operators import filters as fl
    from tagloom.operators import ranking as rk

    schema = "`Post id` string, `Publish date` string, Tags string, body string"
    path = str(tmp_path / "export")
    spark.createDataFrame([("1", "2025-01-01 00:00", None, "x")], schema).write.parquet(path)
    text = plan(fl.filter_articles(spark.read.parquet(path), "2025-01-01", "2025-02-01").select("Publish_date", "User_Needs"))
    text = text.replace("`", "")
    assert "GreaterThanOrEqual(Publish date,2025-01-01" in text and "IsNotNull(Post id)" in text and "body" not in text
    picked = rk.few_shot_sample(spark.range(1000).withColumn("label", F.col("id") % 2), "label", "id")
    assert "WindowGroupLimit" in plan(picked)


def test_comparison_covers_every_model(monkeypatch):
    from tagloom.catalog import modelling

    monkeypatch.setattr(modelling, "vector_split", lambda spark, d: (None, None))
    monkeypatch.setattr(modelling.ln, "compare_models", lambda models, train, test: (set(models), None))
    assert modelling.compare_models(None, None) == set(modelling.ln.model_registry("vec_id")) >= {"SVC", "GBM"}


def test_terms_are_counted_in_place_and_repeated_keys_are_added_up(spark, rows):
    docs = spark.createDataFrame(
        [(1, "a", ["x", "y", "x", "y"]), (2, "a", []), (3, "b", ["x"]), (3, "b", ["x", "z"]), (None, "b", ["z"]), (None, "a", ["z"])],
        "id long, c string, tokens array<string>",
    )
    packed = ft.packed_terms(docs, "id", ["c"])
    assert packed.count() == 6 and packed.columns == ["id", "c", "terms", "tfs"]
    first = packed.where("id = 1").first()
    assert dict(zip(first.terms, first.tfs)) == {"x": 2, "y": 2, "x y": 2, "y x": 1}
    counts = ft.unpacked(packed, "id", ["c"])
    exploded = docs.select("id", "c", F.explode(tx.ngrams(F.col("tokens"))).alias("term")).groupBy("id", "c", "term").count()
    assert rows(counts) == rows(exploded)
    vocab = ft.vocabulary(counts, ft.row_count(docs), 1, 1.0, 3)
    order = ["id", "c", "term", "df", "tf", F.round("weight", 9)]
    assert rows(ft.packed_tfidf(packed, vocab, "id", ["c"]), *order) == rows(ft.tfidf(counts, vocab, "id", ["c"]), *order)


def test_terms_of_single_documents_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, ["x", "y", f"w{i}"]) for i in range(20)], "id long, tokens array<string>")
    packed = ft.packed_terms(docs, "id")
    counts = ft.unpacked(packed, "id")
    weights = ft.packed_tfidf(packed, ft.vocabulary(counts, ft.row_count(docs), 1, 1.0), "id")
    for out in (counts, weights):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    by_document = tp.cluster_topics(packed, docs.select("id", (F.col("id") % 2).alias("topic")), "id", 1)
    by_term = tp.cluster_topics(counts, docs.select("id", (F.col("id") % 2).alias("topic")), "id", 1)
    assert sorted(by_document.collect()) == sorted(by_term.collect())


def test_class_counts_and_ctfidf_of_packed_terms(spark, rows):
    docs = spark.createDataFrame([(i, i % 3, ["x", "y", f"w{i % 4}", "x"]) for i in range(30)], "id long, topic int, tokens array<string>")
    long = docs.select("topic", F.explode(tx.ngrams(F.col("tokens"))).alias("term")).groupBy("topic", "term").agg(F.count("*").alias("tf"))
    packed = ft.packed_class_counts(ft.packed_terms(docs, "id", ["topic"]), "topic")
    order = ["topic", "term", "n", F.round("weight", 9)]
    assert rows(ft.class_counts(docs, "topic")) == rows(packed) == rows(long)
    assert rows(ft.ctfidf(ft.class_counts(docs, "topic"), min_df=3), *order) == rows(ft.ctfidf(long, min_df=3), *order)


def test_smallest_settles_ties_by_column_and_leaves_out_nan():
    rng = np.random.default_rng(3)
    d = rng.integers(0, 6, (40, 30)).astype(float)
    d[rng.random(d.shape) < 0.4] = np.nan
    d[0] = np.nan
    for k in (1, 4, 29, 30, 50):
        row, at = bl._smallest(d, k)
        for i in range(len(d)):
            full = np.argsort(d[i], kind="stable")[:k]
            assert at[row == i].tolist() == full[~np.isnan(d[i, full])].tolist()


def test_blocks_of_neighbours_grow_with_the_rows(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(bl, "BLOCK_ROWS", 4)
    monkeypatch.setattr(bl, "_by_cells", lambda df, key, vector, k, metric, n, nearest, schema, rows: (sizes.append(rows), spark.createDataFrame([], schema))[1])
    for n in (40, 640):
        bl.knn_graph(spark.range(n).select("id", F.array(F.col("id").cast("double")).alias("v")), "id", "v", 2, ("euclidean",))
    assert sizes == [4, 40]


def test_unit_vectors_of_many_numbers_take_one_step_each(spark):
    wide = F.transform(F.sequence(F.lit(0), F.lit(1999)), lambda i: (F.col("id") + i * i % 7).cast("double"))
    flat = F.array_repeat(F.lit(3.0), 2000)
    df = spark.range(3).select("id", F.when(F.col("id") == 1, flat).when(F.col("id") == 2, F.array(F.lit(None).cast("double"))).otherwise(wide).alias("v"))
    for centred in (False, True):
        got = {r.id: r.u for r in df.select("id", bl._unit(F.col("v"), centred).alias("u")).collect()}
        x = np.array(df.where("id = 0").first().v)
        x = x - x.mean() if centred else x
        assert np.allclose(got[0], x / np.linalg.norm(x)) and got[2] is None
        assert (got[1] is None) == centred


def test_kmeans_runs_end_where_sparks_do(blobs, monkeypatch):
    from pyspark.ml.clustering import KMeans

    noisy = blobs.withColumn("v", F.transform("v", lambda x: x + F.rand(3) * 12)).persist()
    rows = cl.with_features(noisy, "v").select("features").persist()
    theirs = {k: min(KMeans(k=k, seed=s, maxIter=40).fit(rows).summary.trainingCost for s in (7, 8)) for k in (2, 5)}
    for cells in (cl.ONE_TASK, 10):
        monkeypatch.setattr(cl, "ONE_TASK", cells)
        ours = cl._best_models(rows, (2, 5), 2, 7, 40)
        assert {k: m.cost for k, m in ours.items()} == pytest.approx(theirs)


def test_models_are_fitted_side_by_side(spark):
    """Each fit waits for the other: one after the other, they would never meet."""
    both = threading.Barrier(2, timeout=30)

    def fit(train):
        both.wait()
        return ln.fit_majority(train)

    rows = [(i, float(i % 3 == 0)) for i in range(30)]
    train = spark.createDataFrame(rows, "id long, label_idx double")
    models = ln.fit_all({"b": fit, "a": fit}, train)
    assert [(k, m.label, m.classes) for k, m in models.items()] == [("b", 0.0, 2), ("a", 0.0, 2)]
    results, models = ln.compare_models({"b": fit, "a": fit}, train, train)
    assert [r.model for r in results.collect()] == ["a", "b"] and list(models) == ["b", "a"]


def test_counts_of_many_tasks_are_added_up_by_ctfidf(spark, rows, monkeypatch):
    """Terms that go on from batch to batch, too."""
    given = [("ab"[i % 2], [f"w{i % 5}", "x", f"w{i % 3}", "x"]) for i in range(24)] + [(None, ["x", "y"])] * 5
    docs = spark.createDataFrame([(i, *g) for i, g in enumerate(given)], "id long, c string, tokens array<string>").repartition(5)
    order = ["c", "term", "n", F.round("weight", 9)]
    wanted = rows(ft.ctfidf(ft.class_counts(docs, "c"), "c", 2), *order)
    for batch in ("10000", "2"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        monkeypatch.setattr(ft, "_HELD", int(batch))
        try:
            for parts in (ft.class_counts(docs, "c", summed=False), ft.packed_class_counts(ft.packed_terms(docs, "id", ["c"]), "c", summed=False)):
                assert rows(ft.ctfidf(parts, "c", 2), *order) == wanted and len(wanted) > 6
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_frequent_terms_meet_without_a_join_or_window(spark):
    docs = spark.createDataFrame([(i % 3, ["x", "y", f"w{i % 4}"]) for i in range(30)], "topic int, tokens array<string>")
    plan = ft._frequent_terms(ft.class_counts(docs, "topic", summed=False), "topic", 2)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "HashAggregate" not in plan and "Join" not in plan


def test_class_distribution_counts_the_vocabulary_only(spark):
    """The counts are shuffled by term for the vocabulary, and not again by class."""
    docs = spark.createDataFrame([(i, "ab"[i % 2], ["x", "y", f"w{i}"]) for i in range(20)], "id long, User_Needs string, tokens array<string>")
    counts = ft.term_counts(docs, "id", ["User_Needs"])
    out = ft.class_term_distribution(counts, ft.row_count(docs), ["a", "b"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [term" in plan and "LeftSemi" in plan
    assert {(r.User_Needs, r.term): round(r.p, 6) for r in out.collect()} == {(c, t): round(1 / 3, 6) for c in "ab" for t in ("x", "y", "x y")}


def test_questions_to_cells_are_not_broadcast(spark):
    """A row for each cell that is asked came back by a join with what the optimizer took for a small table."""
    from tagloom.operators.pivots import Cells

    df = far_blobs(spark)
    n = df.count()
    cells = Cells(df, "id", "v", n, 25)
    asked = cells.asked(k=4)
    met = cells.meet(asked, lambda a, b: a[["id"]], "id long")
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert asked.columns == ["id", "v", "cells"] and plan.count("Join Inner") == 2  # both with the counts of the cells


def test_a_document_goes_to_a_group_once(spark, monkeypatch):
    """Its bucket norms were sent with each of its postings."""
    monkeypatch.setattr(sm, "_POSTINGS_PER_TASK", 64)
    rows = [(i, f"t{(i * 7 + j * j) % 40}", 1, 0.2, 0.1) for i in range(30) for j in range(12)]
    prefixes = spark.createDataFrame(rows, "id long, term string, df int, weight double, rest double").dropDuplicates(["id", "term"])
    sent = sm._sent(prefixes, sm._bucket_norms(prefixes, "id", 16), "id").persist()
    assert sent.count() == sent.select("id", "__group", "__lo", "__hi").distinct().count()
    postings = sent.agg(F.sum(F.size("term"))).first()[0]
    assert postings == prefixes.count() and sent.count() < 0.8 * postings


def test_silhouette_blocks_grow_with_the_rows(spark, monkeypatch):
    """A row was sent to each block of 2,048 rows, however many there are."""
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, int(i % 3), rng.normal(i % 3, 1.0, 2).tolist()) for i in range(200)], "id long, c int, v array<double>").persist()
    whole = {r["id"]: r["silhouette"] for r in bl.silhouette_samples(df, "id", "v", "c", block_rows=200).collect()}
    used, pairs = [], bl.block_pairs
    monkeypatch.setattr(bl, "block_pairs", lambda *a: used.append(a[4]) or pairs(*a))
    monkeypatch.setattr(bl, "BLOCK_ROWS", 4)
    monkeypatch.setattr(bl, "_BLOCKS", 4)
    monkeypatch.setattr(bl, "_TILE", 300)
    got = {r["id"]: r["silhouette"] for r in bl.silhouette_samples(df, "id", "v", "c").collect()}
    assert used == [50] and got.keys() == whole.keys() and all(got[k] == pytest.approx(whole[k], abs=1e-9) for k in got)
