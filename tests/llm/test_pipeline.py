"""The pipeline's stages against the operators' plain rules."""

import pytest
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_scans import decontaminate
from tests.llm.test_simhash import plain_classes, plain_print
from tests.llm.test_texts import plain_counts

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A few hundred documents of the given table, with nulls and repeated rows besides."""
    root = tmp_path_factory.mktemp("small")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(None, "a text without an id " * 9, "en", "s", 1), (9001, None, None, None, None), (9002, "", "en", "s", 0)], docs.schema)
    docs.union(odd).union(docs.limit(3)).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]

    good = stages["quality_rules"](spark, docs, folder).cache()
    assert good.columns == COLUMNS
    kept = {(r["doc_id"], r["text"]) for r in good.collect()}
    for r in docs.collect():
        n, _, _, _, repeated = plain_counts(r["text"])
        if n < 20 or 100 * repeated > 30 * n:
            assert (r["doc_id"], r["text"]) not in kept
    assert len(kept) > 150

    lines = stages["line_dedup"](spark, good, folder).cache()
    assert lines.columns == COLUMNS and lines.count() == good.count()
    gone = plain_lines([(r["doc_id"], r["text"]) for r in good.collect()])
    want = sorted((r["doc_id"] or -1, "\n".join(x for k, x in enumerate(r["text"].split("\n")) if k not in gone.get((r["doc_id"], r["text"]), []))) for r in good.collect())
    assert sorted((r["doc_id"] or -1, r["text"]) for r in lines.collect()) == want

    single = stages["simhash_near_dedup"](spark, lines, folder).cache()
    rows = sorted({(r["doc_id"], r["text"]) for r in lines.collect() if r["doc_id"] is not None})
    roots = plain_classes([plain_print(t) for _, t in rows])
    assert {r["doc_id"] for r in single.collect() if r["doc_id"] is not None} == {rows[r][0] for r in roots}

    clean = stages["benchmark_decontamination"](spark, single, folder).cache()
    judged = decontaminate.contamination(single, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert clean.count() == judged.where("NOT contaminated").count() and clean.columns == COLUMNS

    pieces = stages["packing"](spark, clean, folder)
    total = pieces.agg({"length": "sum"}).first()[0]
    assert total == pieces.where("start = 0").agg({"doc_tokens": "sum"}).first()[0]
    assert pieces.where("start = 0").count() == clean.count()
    # where tasks begin decides what is packed together, not what is packed
    assert corpus_pipeline.run(spark, folder).agg({"length": "sum"}).first()[0] == total


def test_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
