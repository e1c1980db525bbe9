import corpus_pipeline
import pytest

from corpusflow.llm import decontaminate, queries, quality, simhash
from corpusflow.sources.scratch import scratch_path

NAMES = "quality_rules line_dedup simhash_near_dedup benchmark_decontamination byte_bpe_encoding"


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows before the first stage and after each."""
    docs = queries.table(spark, sf_dir, "documents")
    found, root = [docs], scratch_path(spark, "stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, found[-1], sf_dir).write.parquet(f"{root}/{name}")
        found.append(spark.read.parquet(f"{root}/{name}"))
    return found


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_order_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES.split()
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_quality(stages):
    ledger = quality.ledger(stages[0])
    assert ids(stages[1]) == ids(ledger.filter(quality.passes("failed_rules")))


def test_lines_go_and_documents_stay(stages):
    assert ids(stages[2]) == ids(stages[1])
    before = sum(r["n_chars"] for r in stages[1].collect())
    after = sum(r["n_chars"] for r in stages[2].collect())
    assert after < before
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_one_of_each_group_stays(stages):
    groups = simhash.near_duplicates(stages[2]).collect()
    assert ids(stages[3]) == sorted({r["component_id"] for r in groups})


def test_leaks_go(spark, sf_dir, stages):
    items = queries.table(spark, sf_dir, "benchmark")
    found = decontaminate.with_matches(stages[3], items).collect()
    assert ids(stages[4]) == sorted(r["doc_id"] for r in found if not r["matches"])


def test_tokens_of_what_is_left(stages):
    assert ids(stages[5]) == ids(stages[4])
    assert stages[5].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_run(spark, sf_dir, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(
        map(tuple, stages[5].collect())
    )


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (1, None, None, None, None)]])
def test_odd_tables(spark, sf_dir, rows):
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, sf_dir)
        assert found.count() <= len(rows)
        if found.columns == docs.columns:
            docs = found


def test_odd_documents(odd, spark, sf_dir):
    docs = odd.withColumn("n_chars", odd["id"])
    for name, stage in corpus_pipeline.STAGES[1:]:
        found = stage(spark, docs, sf_dir)
        assert 0 < found.count() <= docs.count()
        if name == "simhash_near_dedup":
            assert ids(found.filter("doc_id is not null")).count(5) == 2
