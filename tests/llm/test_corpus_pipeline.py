"""The pipeline's stages on the small tables, and the registry."""

import fixtures

import corpus_pipeline
from tidewell.llm import quality, registry


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = fixtures.documents(spark)
    names, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "/root/testdata/sf0.001")
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.count()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
    book = quality.apply_policy(quality.ledger(fixtures.documents(spark)))
    assert seen["quality_rules"] == book.where("kept").count() == seen["line_dedup"]
    assert seen["near_dedup"] < seen["line_dedup"] <= seen["mix_sources"] + seen["line_dedup"] - seen["near_dedup"]
    given = before.select("doc_id").distinct().count()
    assert docs.select("doc_id").distinct().count() == given


def test_stages_take_odd_and_empty_tables(spark, tmp_path):
    for which in ("odd", "empty"):
        docs = getattr(fixtures, which)(spark)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            out.write.parquet(str(tmp_path / which / name))
            docs = spark.read.parquet(str(tmp_path / which / name))
        assert (docs.count() > 0) == (which == "odd")


def test_registry_names():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(registry.oracle_sql()) <= set(names)
