import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_neardup import brute as brute_groups
from tests.llm.test_packing import verify

from loanscope.llm import decontamination, linededup, quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, by name; the documents themselves under ''."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = {"": docs}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(base / name))
        docs = made[name] = spark.read.parquet(str(base / name))
    return made


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_columns_stay(stages):
    for name in list(stages)[:-1]:
        assert stages[name].columns == stages[""].columns


def test_quality(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    weights, _ = quality.fitted(stages[""], labels)
    expected = {d for d, t in texts(stages[""]) if quality.scored(weights, t or "") <= quality.REJECT_ABOVE}
    assert {d for d, _ in texts(stages["quality_classifier"])} == expected
    assert 0.6 * stages[""].count() < len(expected) < stages[""].count()


def test_line_dedup(stages):
    expected = brute_lines(texts(stages["quality_classifier"]), linededup.RUN_WORDS)
    left = sorted((d, t) for d, t, lines, gone in expected if not gone or gone < lines)
    assert sorted(texts(stages["line_dedup"])) == left
    assert stages["line_dedup"].filter(F.col("n_chars") != F.char_length("text")).count() == 0


def test_near_duplicates(stages):
    expected = {d for d, _, _, kept in brute_groups(texts(stages["line_dedup"]), 5, 80) if kept}
    assert {d for d, _ in texts(stages["minhash_neardup"])} == expected


def test_decontamination(spark, stages):
    before, after = (texts(stages[n]) for n in ("minhash_neardup", "benchmark_decontamination"))
    plain = lambda t: decontamination.benchmark_words(t).tobytes()
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, t in before if any(i in plain(t) for i in items)}
    left = {d for d, _ in after}
    assert leaked and not leaked & left and len(left) > 0.9 * (len(before) - len(leaked))


def test_packing(stages):
    verify(stages["packing"].collect(), texts(stages["benchmark_decontamination"]), 1024)


def test_edge_cases(spark, edge_docs, no_docs):
    for name, stage in pipeline.STAGES:
        made = stage(spark, edge_docs, SF)
        if name != "packing":
            assert made.columns == edge_docs.columns
        assert made.count() > 0
        assert stage(spark, no_docs, SF).count() == 0
    left = pipeline.one_of_each_group(spark, edge_docs, SF)
    assert left.filter("doc_id = 1").count() == 0  # a copy of -5 with fewer lines
    assert left.filter("doc_id = 9").count() == 2 and left.filter("doc_id IS NULL").count() == 2


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert entry.queries()["pipeline"](spark, "/root/testdata/sf0.001").count() > 0
