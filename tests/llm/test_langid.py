import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketry.llm import langid, words


def test_features_do_not_cross_texts_and_ignore_case_and_marks():
    texts = pa.array(["Ab, -CD", "ab cd", "", None, "123 !?", "日本"])
    found = langid.count_features(*words.text_bytes(texts))
    lists = [
        list(zip(found.feature[a:b], found.count[a:b], strict=True))
        for a, b in zip(found.places, found.places[1:], strict=False)
    ]
    assert lists[0] == lists[1]
    assert found.lettered.tolist() == [True, True, False, False, False, True]
    alone = langid.count_features(*words.text_bytes(pa.array(["日本"])))
    assert lists[-1] == list(zip(alone.feature, alone.count, strict=True))


def test_training_separates_two_kinds_and_calibrates():
    random = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(60):
        k = i % 2
        rows.append((np.array([k, 2 + int(random.integers(5)), langid.FEATURES]), np.ones(3)))
        labels.append(k)
    labels = np.array(labels)
    weights = langid.train_ftrl(rows, labels, 2)
    logits = np.stack([v @ weights[f] for f, v in rows])
    assert (logits.argmax(axis=1) == labels).all()
    assert (weights[100:200] == 0).all()
    t = langid.fit_temperature(logits, labels)
    wrong = labels.copy()
    wrong[:15] = 1 - wrong[:15]
    assert langid.fit_temperature(logits, wrong) > t


def test_held_out_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    learned = F.col("doc_id") % 3 != 1
    model = langid.train(langid.labelled_rows(docs, learned), per_language=40)
    result = langid.predict(docs, model, "doc_id", "lang").where(~learned).collect()
    assert np.mean([r.lang == r.lang_pred for r in result]) > 0.9
    assert all(0 <= r.score <= 1 for r in result)


def test_odd_rows(docs):
    model = langid.train(langid.labelled_rows(docs(), F.lit(True)), per_language=10)
    assert model.languages == ["de", "en", "fr"]
    rows = langid.predict(docs(), model, "doc_id").collect()
    assert len(rows) == docs().count()
    found = {(r.doc_id, r.lang_pred, r.score) for r in rows}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (7, "und", 0.0)} <= found
    assert langid.predict(docs([]), model, "doc_id").collect() == []
    unlabelled = docs([(1, "some text", None, "a", 9)])
    assert langid.train(langid.labelled_rows(unlabelled, F.lit(True))) is None
    assert langid.predict(unlabelled, None, "doc_id").first().lang_pred == "und"
    kept = langid.recognised(docs(), 0.0)
    assert kept.columns == docs().columns and kept.count() < docs().count()


def test_the_sample_is_bounded_by_documents_and_not_by_rows(docs):
    rows = [(1, f"text number {i}", "en", "a", 0) for i in range(50)]
    rows += [(i, f"noch ein text {i}", "de", "a", 0) for i in range(2, 9)]
    sample = langid._sample(langid.labelled_rows(docs(rows), F.lit(True)), 5)
    assert sample["lang"].value_counts().to_dict() == {"de": 5, "en": 1}
    assert sample["turn"].max() == 5
