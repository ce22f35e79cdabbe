"""Plan shapes: no needless exchange, no Python in default queries, filters and columns pushed."""

import re

import __spark_entry__ as catalogue
import pytest
from pyspark.sql import functions as F

from leafmill.operators import extraction, filters, summaries, upsert
from leafmill.plans import flow
from leafmill.sources import tables

FOLDER = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "PythonUDF")


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def many_splits(spark, monkeypatch):
    """As on a large input: the scan has more splits than cores, so nothing is spread."""
    monkeypatch.setattr(catalogue.parallel, "spread", lambda scan, *key: scan)


ROW_QUERIES = """list_files_by_suffix list_files_by_substring stamp_year_month
    filter_path_eq path_fields path_tail clean_text chunk_id token_count chunk_separator
    chunk_recursive chunk_wrap summary_map_reduce summary_map_join summary_wrap_join
    vector_records summarized_documents""".split()


@pytest.mark.parametrize("name", ROW_QUERIES)
def test_row_queries_move_nothing(spark, many_splits, name):
    assert "Exchange" not in _plan(catalogue.queries()[name](spark, FOLDER))


#: Contents of files are read in Python tasks.
READS_FILES = {"scan_binary_files"}


@pytest.mark.parametrize(
    "name", [query.__name__ for query in catalogue._QUERIES if query.__name__ not in READS_FILES]
)
def test_no_python_in_default_queries(spark, name):
    plan = _plan(catalogue.queries()[name](spark, FOLDER))
    assert not [node for node in PYTHON_NODES if node in plan]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_only_needed_columns_are_read(spark, many_splits):
    plan = _plan(catalogue.clean_text(spark, FOLDER))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    ids = _plan(catalogue.store_project_paths(spark, FOLDER))
    assert "ReadSchema: struct<Filepath:string>" in ids


def test_path_filter_reaches_the_scan(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    assert "EqualTo(url,x)" in _plan(filters.filter_path(pages, "x", "url"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_large_batch_is_exchanged_once(spark, no_broadcast):
    store = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    batch = spark.read.parquet(f"{FOLDER}/labels.parquet").withColumn("seq", F.col("quality"))
    plan = _plan(upsert.upsert(store, batch, ["doc_id"], "seq"))
    # The store with its text, its keys, the batch, and the batch's keys.
    assert plan.count("- Exchange hashpartitioning(_key") == 4
    assert plan.count("ReusedExchange") == 1
    assert plan.count("coalesce(") == 0


def test_small_batch_leaves_the_store_in_place(spark):
    store = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    batch = spark.read.parquet(f"{FOLDER}/labels.parquet").withColumn("seq", F.col("quality"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(upsert.upsert(store, batch, ["doc_id"], "seq"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    updated = plan.split("\n- ")[0].split("\n:- ")[1]
    store_side = updated.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin [_key" in store_side and "hashpartitioning" not in store_side


def test_pages_are_exchanged_once(spark, no_broadcast):
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    plan = _plan(extraction.join_pages(turns, "conv_id", "turn", "text"))
    assert plan.count("Exchange hashpartitioning") == 1


def test_pages_are_read_once_for_both_extractors(spark, no_broadcast):
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    second = spark.read.parquet(f"{FOLDER}/pages.parquet").withColumnRenamed("page_id", "conv_id")
    plan = _plan(extraction.assemble_pages(turns, "conv_id", "turn", "text", second, "html"))
    moved = [x for x in plan.split("\n") if "- Exchange hashpartitioning(_key" in x]
    assert len(moved) == 2 and plan.count("ReusedExchange") == 1
    assert "REPARTITION" not in plan


def test_requests_are_tested_below_the_exchange_of_contents(spark, no_broadcast):
    store = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn(
        "name", F.col("doc_id").cast("string")
    )
    asked = spark.read.parquet(f"{FOLDER}/labels.parquet").select(F.col("doc_id").cast("string").alias("w"))
    plan = _plan(tables.lookup(asked, store, "w", "name", "text"))
    above = plan.split("ReadSchema: struct<doc_id:bigint,text:string>")[0].split("\n")
    nodes = [line for line in above if re.search(r"- (\*\(\d+\) )?(Exchange|Filter) ", line)]
    assert "Filter" in nodes[-1] and "Subquery" in nodes[-1] and "Exchange" in nodes[-2]


def test_new_documents_alone_move(spark, no_broadcast):
    plan = _plan(catalogue.extract_unprocessed(spark, FOLDER))
    above = plan.split("ReadSchema: struct<doc_id:bigint,text:string>")
    # One scan of texts; they are moved by the document's number, for the join with the new ones,
    # and stay there.
    assert len(above) == 2
    side = [x for x in above[0].split("\n") if "Join" in x or "Exchange" in x]
    assert "hashpartitioning(doc_id" in side[-1] and "Inner" in side[-2]


def test_model_runs_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")

    def factory():
        return lambda items: items

    modelled = summaries.summarize_with_model(docs, "doc_id", F.array("text"), factory)
    assert _plan(modelled).count("MapInArrow") == 1


def test_flow_reads_text_once(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = _plan(flow.summarized_documents(docs, "text", ["doc_id"]))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
