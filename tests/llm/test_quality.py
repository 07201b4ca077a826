import numpy as np
from pyspark.sql import functions as F

from loanscope.llm import quality

SF = "/root/testdata/sf0.1"


def test_label_model_finds_labellers_that_err():
    draw = np.random.Generator(np.random.PCG64(2))
    truth = draw.random(20_000) < 0.3
    sees = [0.5, 0.4, 0.6, 0.3, 0.2]  # chance that a heuristic says bad of a bad document
    errs = [0.01, 0.02, 0.0, 0.01, 0.02]
    votes = np.zeros((len(truth), 6), int)
    for i, (s, e) in enumerate(zip(sees, errs, strict=True)):
        votes[draw.random(len(truth)) < np.where(truth, s, e), i] = quality.BAD
    human = np.where(truth ^ (draw.random(len(truth)) < 0.03), quality.BAD, quality.GOOD)
    votes[:, 5] = np.where(draw.random(len(truth)) < 0.4, human, quality.SILENT)
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    chance, rates = quality.posteriors(patterns, counts.astype(float))
    spoke = (votes != quality.SILENT).any(axis=1)
    right = ((chance[which.ravel()] > 0.5) == truth)[spoke].mean()
    # With the true rates nobody could do better than this.
    odds = np.full(len(truth), np.log(0.3 / 0.7))
    for i, (s, e) in enumerate(zip(sees, errs, strict=True)):
        said = votes[:, i] == quality.BAD
        odds += np.where(said, np.log(s / max(e, 1e-9)), np.log((1 - s) / (1 - e)))
    odds += np.where(votes[:, 5] == quality.BAD, np.log(0.97 / 0.03), 0) + np.where(votes[:, 5] == quality.GOOD, np.log(0.03 / 0.97), 0)
    assert right > ((odds > 0) == truth)[spoke].mean() - 0.01
    assert (rates[:5, 1, quality.BAD] > 5 * rates[:5, 0, quality.BAD]).all()
    assert rates[5, 1, quality.BAD] > rates[5, 1, quality.GOOD] and rates[5, 0, quality.GOOD] > rates[5, 0, quality.BAD]


def test_a_labeller_at_chance_is_found_out():
    draw = np.random.Generator(np.random.PCG64(6))
    for human, n in ((0.4, 200_000), (0.0, 200_000), (0.4, 20_000)):
        truth = draw.random(n) < 0.08
        votes = np.zeros((n, 6), int)
        for i, (sees, errs) in enumerate([(0.5, 0.002), (0.4, 0.005), (0.6, 0.001), (0.3, 0.002)]):
            votes[draw.random(n) < np.where(truth, sees, errs), i] = quality.BAD
        votes[draw.random(n) < 0.1, 4] = quality.BAD
        votes[:, 5] = np.where(draw.random(n) < human, np.where(truth, quality.BAD, quality.GOOD), quality.SILENT)
        patterns, counts = np.unique(votes, axis=0, return_counts=True)
        chance, rates = quality.posteriors(patterns, counts.astype(float), trusted=5 if human else None)
        assert abs(rates[4, 0, quality.BAD] - rates[4, 1, quality.BAD]) < (0.02 if n == 200_000 else 0.05)
        assert chance[(patterns == [0, 0, 0, 0, quality.BAD, 0]).all(axis=1)] < 0.02


def test_heuristics():
    plain = "It is a plain text of some words, with nothing odd in it at all. " * 2
    assert not quality.votes(quality.measures(plain)[0]).any()
    bad = [
        "Wor%%% ds&&& with$$$ marks### on*** most%%% of&&& them$$$",
        "ALL OF THIS IS SHOUTED AT YOU!",
        "spam spam spam spam spam spam eggs eggs eggs eggs",
        " ".join(f"w{i % 5}x w{i % 3}y" for i in range(300)),
        "some | words | in | a | row | of | cells",
    ]
    for i, text in enumerate(bad):
        assert quality.votes(quality.measures(text)[0])[i] == quality.BAD, text


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    rated = quality.classify(docs, labels.filter(~held))
    seen = rated.join(labels.filter(held), "doc_id").select("kept", "quality", "toxic").collect()
    share = lambda rows: sum(r.kept for r in rows) / len(rows)
    assert share([r for r in seen if r.quality == 1 and r.toxic == 0]) > 0.99
    assert share([r for r in seen if r.quality == 0]) < 0.01
    assert share([r for r in seen if r.toxic == 1]) < 0.25  # of 2,900 labels; more labels catch more


def test_edge_cases(spark, edge_docs, no_docs):
    schema = "doc_id long, quality int, toxic int, votes string"
    labels = spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 0, "x"), (2, None, None, "x"), (None, 0, 1, "x"), (5, 1, None, "x")], schema)
    rated = quality.classify(edge_docs, labels)
    assert rated.columns == [*edge_docs.columns, "bad_chance", "kept"] and rated.count() == edge_docs.count()
    assert rated.filter("bad_chance IS NULL OR kept IS NULL").count() == 0
    assert quality.classify(no_docs, labels).collect() == []
    silent = quality.classify(spark.createDataFrame([(1, "plain words")], "doc_id long, text string"), labels.limit(0))
    assert silent.first().kept and silent.first().bad_chance < 1e-9


def test_sample_is_bounded_and_repeatable(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    first, _ = quality.fitted(docs, labels, train_docs=200)
    second, _ = quality.fitted(docs.repartition(7), labels.repartition(3), train_docs=200)
    assert (first == second).all() and first.any()
