"""The registered queries and the pipeline over the smallest tables."""

import __spark_entry__ as catalogue
import corpus_pipeline

from leafmill.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_names():
    names = list(catalogue.queries())
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)


def test_every_document_has_a_row(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for name, query in queries.QUERIES.items():
        if name.split("_")[0] in ("op3", "op7", "op12", "op13"):  # rows are not documents
            continue
        rows = query(spark, FOLDER)
        assert rows.select("doc_id").distinct().count() == rows.count() == docs, name


def test_pipeline_stages(spark):
    """Each stage against what its operator finds in the stage's own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "quality rules":
            lost = set(before) - set(after)
            assert not [i for i in lost if labels.get(i) == 1 and len(before[i].split()) >= 50]
        elif name == "near duplicates":
            assert len(set(after.values())) == len(after)
        else:
            assert set(after) == set(before)
        assert all(r["n_chars"] == len(r["text"]) for r in docs.select("text", "n_chars").collect())
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r["doc_id"] for r in packed.collect()} == set(before)
