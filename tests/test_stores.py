"""The embedding store's commits, stored datasets, and text classifiers as one unit."""

import pytest
from pyspark.sql import functions as F

from tagloom.operators import filters as fl
from tagloom.operators import learning as ln
from tagloom.sources import stores as st


def docs(spark, ids):
    return spark.createDataFrame([(i, f"text {i}") for i in ids], "id long, text string")


def encode(rows):
    return rows.select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("embedding"))


def keys(df):
    return sorted(int(r["key"]) for r in df.collect())


def test_only_missing_keys_are_computed(spark, tmp_path):
    store, asked = st.EmbeddingStore(spark, str(tmp_path)), []

    def noting(rows):
        asked.append(sorted(r["id"] for r in rows.collect()))
        return encode(rows)

    assert keys(store.ensure(docs(spark, [1, 2, 2, None]), "id", "m", "t", noting)) == [1, 2]
    assert keys(store.ensure(docs(spark, [2, 3]), "id", "m", "t", noting)) == [1, 2, 3]
    assert keys(store.ensure(docs(spark, [1, 3]), "id", "m", "t", noting)) == [1, 2, 3]
    assert asked == [[1, 2], [3]]
    assert keys(store.ensure(docs(spark, [1]), "id", "m", "other", noting)) == [1]
    assert keys(store.ensure(docs(spark, [1, 9]), "id", "m", "t", encode, force_recompute=True)) == [1, 9]
    assert len(store.commits()) == 4 and keys(store.vectors("m", "other")) == [1] and keys(store.vectors("no", "t")) == []


def test_a_write_that_breaks_off_leaves_nothing_and_can_be_repeated(spark, tmp_path, monkeypatch):
    store = st.EmbeddingStore(spark, str(tmp_path))
    store.ensure(docs(spark, [1]), "id", "m", "t", encode)

    def lost(self, number, **entry):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(st.EmbeddingStore, "_commit", lost)
        with pytest.raises(RuntimeError):
            store.ensure(docs(spark, [1, 2]), "id", "m", "t", encode)
    assert keys(store.vectors("m", "t")) == [1]

    def failing(rows):
        broken = F.when(F.col("id") == 3, F.raise_error(F.lit("encoder"))).otherwise(F.lit(1.0))
        return rows.select("id", F.array(broken.cast("double")).alias("embedding"))

    with pytest.raises(Exception, match="encoder"):
        store.ensure(docs(spark, [2, 3]), "id", "m", "t", failing)
    for _ in range(2):
        assert keys(store.ensure(docs(spark, [1, 2, 3]), "id", "m", "t", encode)) == [1, 2, 3]


def test_of_two_writers_one_looks_again(spark, tmp_path):
    first, second = st.EmbeddingStore(spark, str(tmp_path)), st.EmbeddingStore(spark, str(tmp_path))

    def meanwhile(rows):
        second.ensure(docs(spark, [2, 3]), "id", "m", "t", encode)  # commits while the first one encodes
        return encode(rows)

    assert keys(first.ensure(docs(spark, [1, 2]), "id", "m", "t", meanwhile)) == [1, 2, 3]
    assert [c["number"] for c in first.commits()] == [1, 2]


def test_tagged_and_untagged_rows_are_stored(spark, tmp_path):
    articles = spark.createDataFrame([("u1", "T", "help"), ("u2", "T", "none"), ("u3", None, "help")], "URL string, Title string, User_Needs string")
    texts = spark.createDataFrame([("u1", "a"), ("u2", "b"), ("u3", "c")], "url string, text string")
    tagged, untagged = fl.save_ml_datasets(articles, texts, str(tmp_path / "ml"))
    assert [r["URL"] for r in tagged.collect()] == ["u1"] and [r["URL"] for r in untagged.collect()] == ["u2"]
    assert "is_labeled" not in tagged.columns
    assert {p.name for p in (tmp_path / "ml").iterdir() if p.is_dir()} == {"is_labeled=true", "is_labeled=false"}


@pytest.mark.parametrize("fit", [lambda t: ln.fit_lr(t, 20), lambda t: ln.fit_svc_calibrated(t, "id", 3)])
def test_text_classifier_is_stored_as_one_unit(spark, tmp_path, fit):
    words = {"a": "bridge road traffic", "b": "garden flower seed", "c": "music stage guitar"}
    data = [(i * 3 + j, c, (words[c] + f" x{i}").split()) for i in range(9) for j, c in enumerate(words)]
    rows = ln.training_frame(spark.createDataFrame(data, "id long, User_Needs string, tokens array<string>"), "User_Needs")
    model = ln.fit_tfidf_classifier(fit, "id", ln.TfidfVectorizer("id", min_df=2))(rows)
    model.save(str(tmp_path / "unit"))
    back = ln.TextClassifier.load(spark, str(tmp_path / "unit"))
    asked = rows.unionByName(rows.limit(1).withColumn("id", F.lit(999).cast("long")).withColumn("tokens", F.array(F.lit("unseen"))))
    a, b = (sorted(m.transform(asked).select("id", "prediction", "proba").collect()) for m in (model, back))
    for x, y in zip(a, b, strict=True):
        assert x[:2] == y[:2] and x["proba"] == pytest.approx(y["proba"], abs=1e-9)
    assert [r["prediction"] for r in a[:-1]] == [float(r["id"] % 3) for r in a[:-1]]
