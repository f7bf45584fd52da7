"""The pipeline's stages against what each may do with its input."""

import corpus_pipeline
from tests.llm.test_operators import DOCS, SMALL, awkward, linked, words
from tidemark.llm import quality_rules


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = stage(spark, kept, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == docs.columns
        rows = kept.collect()
        ids = {r.doc_id for r in rows}
        assert ids <= before.keys() and ids
        if name == "quality_rules":
            assert ids == {r.doc_id for r in quality_rules.judged(docs).filter("kept").collect()}
        if name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(" ".join(words(f"x{before[i]}x")), i)
            assert ids == set(first.values())
        if name == "ngram_jaccard_join":
            assert ids == {i for i, (_, root) in linked(before).items() if i == root}
        if name == "best_fit_packing":
            assert ids == before.keys()
        spark.catalog.clearCache()


def test_awkward_tables(spark, tmp_path):
    for table in (awkward(spark), spark.createDataFrame([], DOCS)):
        folder = str(tmp_path / str(table.count()))
        table.write.parquet(f"{folder}/documents.parquet")
        labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
        labels.write.parquet(f"{folder}/labels.parquet")
        assert corpus_pipeline.run(spark, folder).count() >= 0
