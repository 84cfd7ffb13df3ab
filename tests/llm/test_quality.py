import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daymark.llm import quality
from daymark.llm.queries import QUERIES
from tests.llm.odd import documents, odd_rows

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op5_pairwise_quality"](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality")
    judged = rows.join(labels, "doc_id").filter("held_out").collect()
    assert len(judged) > 50
    assert sum(r.predicted == r.quality for r in judged) >= 0.95 * len(judged)
    assert rows.count() == 1000 and rows.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert rows.filter("predicted != CAST(score >= 0.3 AS INT)").count() == 0


def test_odd_documents_get_a_score(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    labels = spark.createDataFrame(
        [(10, 1), (11, 1), (40, 0), (41, 0), (41, 0), (42, None), (None, 1), (999, 0), (43, 5)], "doc_id long, quality int"
    )
    model = quality.train(docs, labels)
    scored = quality.with_quality(docs, model)
    assert scored.columns == [*[c for c in docs.columns if c != "score"], "score"]
    got = scored.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.text is None or r.text == ""}
    assert len(blank) == 1
    again = quality.train(docs.repartition(5), labels)
    assert (again.weights == model.weights).all() and again.threshold == model.threshold


def test_without_both_labels_all_pass(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for usable in (None, F.lit(False)):
        model = quality.train(docs, labels, usable)
        assert quality.with_quality(docs, model).filter(F.col("score") < quality.CUT).count() == 0
    assert quality.with_quality(documents(spark, []), model).collect() == []


def test_the_sample_is_bounded(spark):
    docs = documents(spark, [(i, f"text {'x ' * (i % 7)}") for i in range(50)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    seen = []
    original = quality.fit
    try:
        quality.fit = lambda rows, marks: seen.append(marks.tolist()) or original(rows, marks)
        quality.train(docs, labels, max_rows_per_label=4)
    finally:
        quality.fit = original
    assert sorted(seen[0]) == [0] * 4 + [1] * 4


def test_scores_follow_the_threshold():
    import numpy as np

    rows = np.array([[0.0], [0.2], [0.9], [1.0]])
    model = quality.fit(rows, np.array([0, 0, 1, 1]))
    assert (model.scores(rows) >= quality.CUT).tolist() == [False, False, True, True]
    assert model.scores(rows)[0] < model.scores(rows)[3] == pytest.approx(model.scores(rows).max())


def test_every_labelled_document_is_learned_from(spark, monkeypatch):
    """Only the documents beyond the 6000 first hashes tell good from bad."""
    n = 14_000
    ids = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    place = F.row_number().over(Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id"))
    told = F.when(place <= 6_000, "mm").when(F.col("quality") == 1, "good zeal").otherwise("bad & # worse")
    docs = ids.select("doc_id", "quality", told.alias("text"))
    model = quality.train(docs.drop("quality"), ids)
    texts = spark.createDataFrame([(1, "good zeal"), (2, "bad & # worse")], "doc_id long, text string")
    good, bad = (r.score for r in quality.with_quality(texts, model).orderBy("doc_id").collect())
    assert good > quality.CUT + 0.1 and bad < good - 0.1
    seen = quality.train(docs.drop("quality"), ids, max_rows_per_label=6_000)
    good, bad = (r.score for r in quality.with_quality(texts, seen).orderBy("doc_id").collect())
    assert good == pytest.approx(bad)


@pytest.mark.parametrize("n_bad", [1, 3, 40])
def test_blocks_have_rows_of_both_labels(spark, monkeypatch, n_bad):
    """A few rows of one label meet all rows of the other; with one block the fit is that of all pairs."""
    monkeypatch.setattr(quality, "BLOCK_ROWS", 8)
    monkeypatch.setattr(quality, "LEAST_ROWS", 4)
    rows = [(i, f"word {'x ' * (i % 7)}" + ("#&" if i < n_bad else "."), int(i >= n_bad)) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    model = quality.train(docs, labels)
    scores = {r.doc_id: r.score for r in quality.with_quality(docs, model).collect()}
    assert all((scores[i] >= quality.CUT) == (q == 1) for i, _, q in rows)
    monkeypatch.setattr(quality, "BLOCK_ROWS", 120)
    monkeypatch.setattr(quality, "LEAST_ROWS", 120)
    whole, local = quality.train(docs, labels), quality.train(docs, labels, max_rows_per_label=120)
    assert whole.weights == pytest.approx(local.weights, abs=1e-4)
    assert whole.threshold == pytest.approx(local.threshold, abs=2 / quality.STEPS_PER_UNIT)


def test_the_smallest_text_of_an_id_is_learned_from(spark):
    docs = [(1, "b b b"), (1, "a"), (1, "a"), (1, None), (2, "z # &"), (3, "c"), (None, "n")]
    schema = "doc_id long, text string"
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1)], "doc_id long, quality int")
    model = quality.train(spark.createDataFrame(docs, schema), labels)
    plain = quality.train(spark.createDataFrame([(1, "a"), (2, "z # &"), (3, "c")], schema), labels)
    assert (model.weights == plain.weights).all() and model.threshold == plain.threshold


def test_the_cut_with_the_fewest_errors():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(50):
        steps = np.unique(rng.integers(-20, 20, 9))
        good, bad = rng.integers(0, 4, len(steps)), rng.integers(0, 4, len(steps))
        shuffled = rng.permutation(len(steps))
        cut = quality._best_cut(steps[shuffled], good[shuffled], bad[shuffled]) * quality.STEPS_PER_UNIT
        errors = {c: good[steps < c].sum() + bad[steps >= c].sum() for c in range(steps[0], steps[-1] + 2)}
        assert cut == int(cut) and errors[int(cut)] == min(errors.values())
