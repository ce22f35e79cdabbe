"""Filters, duplicates, extraction rules, quarantine, models."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leafmill import models
from leafmill.operators import bloom, extraction, filters, quarantine
from leafmill.plans.settings import settings
from leafmill.sources import tables

NAMES = "name string"


def _names(frame):
    return sorted((r["name"] for r in frame.collect()), key=str)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_unprocessed(spark, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        listing = spark.createDataFrame(
            [("a.pdf",), ("b.pdf",), ("b.pdf",), (None,)] + [("hot.pdf",)] * 400, NAMES
        ).repartition(6)
        done = spark.createDataFrame([("a.pdf",), ("a.pdf",), ("z",), (None,)] * 50, "f string")
        left = filters.unprocessed(listing, done, "name", "f")
        assert left.columns == ["name"]
        assert _names(left) == ["b.pdf"] * 2 + ["hot.pdf"] * 400
        hot = spark.createDataFrame([("hot.pdf",)], "f string")
        assert _names(filters.unprocessed(listing, hot, "name", "f")) == [
            None, "a.pdf", "b.pdf", "b.pdf",
        ]
        both = listing.join(done.toDF("name"), "name", "left_semi")
        assert both.count() + left.count() == listing.count() - 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_suffix_is_case_sensitive(spark):
    frame = spark.createDataFrame([("a.pdf",), ("a.PDF",), ("a.pdf.bak",)], "path string")
    assert filters.keep_suffix(frame).count() == 1
    assert filters.keep_substring(frame).count() == 2
    assert filters.filter_path(frame, "a.PDF").count() == 1


def test_dedup_keeps_the_first(spark):
    day = [datetime(2024, 1, d) for d in range(1, 6)]
    rows = [
        (1, "p", day[2], b"x"),
        (2, "p", day[1], b"x"),
        (3, "p", day[1], b"x"),
        (4, "p", day[0], b"y"),
        (5, None, day[4], b"x"),
        (6, None, day[3], b"x"),
        (7, "q", day[0], None),
        (8, "q", day[0], None),
    ] + [(n, "hot", day[n % 5], b"h") for n in range(100, 400)]
    frame = spark.createDataFrame(rows, "n int, path string, at timestamp, content binary")
    kept = filters.dedup_exact(frame.repartition(7), ["path"], ["n"], "content", ["at"])
    assert kept.columns == frame.columns
    assert sorted(r["n"] for r in kept.collect()) == [2, 4, 6, 7, 100]


def test_dedup_with_row_locator(spark, tmp_path):
    rows = [("p", 1, b"x")] * 5 + [("p", 1, b"y")] + [("q", 1, b"x")] * 2
    frame = spark.createDataFrame(rows, "path string, length int, content binary")
    frame.repartition(4).write.parquet(str(tmp_path / "t"))
    located, row_id = filters.with_row_locator(spark.read.parquet(str(tmp_path / "t")))
    kept = filters.dedup_exact(located, ["path", "length"], row_id, "content").drop(*row_id)
    assert sorted((r["path"], bytes(r["content"])) for r in kept.collect()) == [
        ("p", b"x"), ("p", b"y"), ("q", b"x"),
    ]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(d, p, f"<{d}.{p}>") for d, n in ((1, 3), (2, 60), (3, 9), (None, 2)) for p in range(n)]
    rows += [(4, 0, None), (4, 1, "x")]
    return spark.createDataFrame(rows, "doc int, page int, text string").repartition(5)


def _joined(doc, n):
    return "".join(f"<{doc}.{p}>" for p in range(n))


@pytest.mark.parametrize("tasks", [1, 7])
def test_pages_join_in_order(spark, pages, tasks):
    got = extraction.join_pages(pages.repartition(tasks), "doc", "page", "text")
    assert {r["doc"]: r["text"] for r in got.collect()} == {
        1: _joined(1, 3), 2: _joined(2, 60), 3: _joined(3, 9), None: _joined(None, 2), 4: "x",
    }


def test_short_document_takes_the_second_text(spark):
    rows = [(n, 0, "a" * n) for n in (49, 50, 51)] + [(1, 0, None), (2, 0, "b")]
    pages = spark.createDataFrame(rows, "doc int, page int, text string")
    second = spark.createDataFrame([(n, f"second {n}") for n in (1, 49, 50, 51)], "doc int, s string")
    got = extraction.assemble_pages(pages, "doc", "page", "text", second, "s").collect()
    assert {r["doc"]: r["text"] for r in got} == {
        49: "second 49", 50: "a" * 50, 51: "a" * 51, 1: "second 1", 2: None,
    }


def test_pages_of_the_second_extractor(spark, pages):
    got = extraction.join_pages(pages, "doc", "page", "text", "\n", strict=True)
    texts = {r["doc"]: r["text"] for r in got.collect()}
    assert texts[2] == "\n".join(f"<2.{p}>" for p in range(60))
    assert texts[1] == "<1.0>\n<1.1>\n<1.2>" and texts[4] is None


def test_first_text(spark):
    rows = [
        (1, "first", ["p", "q"], False),
        (2, "", ["p"], False),
        (3, None, ["p", "q"], False),
        (4, None, ["p", None], False),
        (5, None, None, False),
        (6, "first", ["p"], True),
        (7, None, [], False),
    ]
    frame = spark.createDataFrame(rows, "n int, first string, pages array<string>, bad boolean")
    value = extraction.first_text(
        F.col("first"), extraction.pages_text(F.col("pages")), F.col("bad")
    )
    got = {r["n"]: r["t"] for r in frame.select("n", value.alias("t")).collect()}
    assert got == {1: "first", 2: "", 3: "p\nq", 4: None, 5: None, 6: "", 7: ""}


def test_extract_unprocessed(spark):
    files = spark.createDataFrame(
        [("a.pdf", "1"), ("b.pdf", "2"), ("c.txt", "3"), (None, "4")], "name string, t string"
    )
    done = spark.createDataFrame([("a.pdf",)], "f string")
    got = extraction.extract_unprocessed(files, done, "name", "f", F.col("t"))
    assert [tuple(r) for r in got.collect()] == [("b.pdf", "2")]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_lookup(spark, broadcast):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": broadcast}):
        check_lookup(spark)


def check_lookup(spark):
    wanted = spark.createDataFrame([("a",), ("x",), (None,), ("a",)], "w string")
    store = spark.createDataFrame([("a", b"1"), ("b", b"2"), ("e", None)], "n string, c binary")
    got = tables.lookup(wanted, store, "w", "n", "c").collect()
    assert sorted(((r["name"], r["content"], r["found"], r["error"]) for r in got), key=str) == sorted(
        [
            ("a", bytearray(b"1"), True, None),
            ("x", None, False, None),
            (None, None, False, "missing name"),
        ],
        key=str,
    )


def test_bloom_filter_loses_no_member(spark):
    members = spark.range(3000).select(F.concat(F.lit("name "), "id").alias("n"))
    members = members.unionByName(spark.createDataFrame([(None,)], "n string"))
    words = bloom.words_for(members.count())
    held = bloom.bloom_filter(members, F.col("n"), words)
    rows = spark.range(30_000).select(F.concat(F.lit("name "), "id").alias("n"))
    passed = {r[0] for r in rows.where(bloom.may_hold(held, F.col("n"), words)).collect()}
    assert passed >= {f"name {k}" for k in range(3000)} and len(passed) < 3000 + 27_000 * 0.05
    assert members.where(bloom.may_hold(held, F.col("n"), words)).count() == 3001
    none = bloom.bloom_filter(members.limit(0), F.col("n"), 16)
    assert rows.where(bloom.may_hold(none, F.col("n"), 16)).count() == 0
    assert bloom.words_for(0) == 16 and bloom.words_for(10**12) == bloom.MOST_WORDS


def test_frequent_names(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(
            F.col("id").cast("string")
        ).alias("n")
    )
    got = {r[0] for r in filters.frequent(rows, "n").collect()}
    want = spark.createDataFrame([("hot",), (None,)], "n string").select(F.xxhash64("n"))
    assert got == {r[0] for r in want.collect()}
    assert filters.frequent(rows.limit(0), "n").count() == 0


def test_hot_name_is_spread(spark):
    """With neither side small enough to broadcast, no task of the join gets the hot name."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    rows = spark.range(0, 9000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("n")
    )
    done = spark.range(5, 9000, 2).select(F.col("id").cast("string").alias("f"))
    with settings(spark, keys):
        left = filters.unprocessed(rows, done, "n", "f")
        plan = left._jdf.queryExecution().executedPlan().toString()
        sizes = left.groupBy(F.spark_partition_id()).count().collect()
        want = 3000 + sum(1 for k in range(9000) if k % 3 and (k < 5 or k % 2 == 0))
        assert left.count() == want
    assert "Generate explode" not in plan  # the list of what is done is not multiplied
    assert max(r["count"] for r in sizes) < want / 2


def test_quarantine(spark):
    frame = spark.createDataFrame(
        [(1, "a", "b"), (2, None, "b"), (3, "a", None)], "n int, a string, b string"
    )
    ok, failed = quarantine.split_ok_failed(quarantine.require_fields(frame, ["a", "b"]))
    assert ok.columns == frame.columns and [r["n"] for r in ok.collect()] == [1]
    assert {r["n"]: r["error"] for r in failed.collect()} == {2: "missing a", 3: "missing b"}
    items = spark.createDataFrame(
        [(1, {"summary": "s"}), (2, {"summary": None}), (3, {"x": "y"}), (4, None)],
        "n int, f map<string,string>",
    )
    marked = quarantine.require_map_keys(items, "f", ["summary"])
    assert {r["n"]: r["error"] for r in marked.collect()} == {
        1: None, 2: None, 3: "missing summary", 4: "missing summary",
    }


def test_model_retries(spark):
    def _flaky():
        calls = {"n": 0}

        def call(items):
            calls["n"] += 1
            if calls["n"] < 3:
                raise OSError("busy")
            return [len(x) for x in items]

        return call

    frame = spark.createDataFrame([("abc", 1), (None, 2)], "t string, n int").coalesce(1)
    done = models.apply_model(frame, "t", "int", _flaky, tries=3, pause=0.0)
    assert [(r["n"], r["value"], r["error"]) for r in done.orderBy("n").collect()] == [
        (1, 3, None), (2, None, None),
    ]
    gave_up = models.apply_model(frame, "t", "int", _flaky, tries=1, pause=0.0).orderBy("n")
    assert [r["error"] for r in gave_up.collect()] == ["OSError: busy", None]


def test_token_slot(spark):
    def factory():
        def call(items):
            return [len(x.split()) for x in items]

        return call

    frame = spark.createDataFrame([("a b", 1), (None, 2)], "t string, n int")
    rows = models.count_tokens(frame, "t", factory).collect()
    assert {r["n"]: r["tokens"] for r in rows} == {1: 2, 2: 0}


def test_extractor_slot(spark):
    def factory():
        def call(items):
            return [{"text": None, "pages": [bytes(x).decode(), "end"]} for x in items]

        return call

    frame = spark.createDataFrame([(b"start", "p")], "content binary, path string")
    done = models.extract(frame, "content", factory)
    text = extraction.first_text(
        F.col("value.text"), extraction.pages_text(F.col("value.pages")), F.col("error").isNotNull()
    )
    assert done.select("path", text).first()[1] == "start\nend"


def test_model_leaves_other_columns_and_types(spark):
    """A large key beside NULL, and one output of the wrong type."""

    def factory():
        return lambda items: ["bad" if x == "b" else len(x) for x in items]

    key = 2**53 + 1
    frame = spark.createDataFrame(
        [(key, "abc"), (None, "de"), (3, "b"), (4, None)], "k bigint, t string"
    ).coalesce(1)
    rows = {r["k"]: r for r in models.apply_model(frame, "t", "int", factory).collect()}
    assert {k: r["value"] for k, r in rows.items()} == {key: 3, None: 2, 3: None, 4: None}
    assert rows[3]["error"] and [rows[k]["error"] for k in (key, None, 4)] == [None] * 3


def test_model_that_is_down_ends_soon(spark):
    def factory():
        def call(items):
            time.sleep(0.001)
            raise OSError("down")

        return call

    frame = spark.range(3000).select("id", F.col("id").cast("string").alias("t")).coalesce(1)
    start = time.time()
    done = models.apply_model(frame, "t", "int", factory, tries=2, pause=0.05, give_up=4)
    errors = [r["error"] for r in done.collect()]
    assert len(errors) == 3000 and all(errors) and time.time() - start < 20
    assert sum("gave up" in e for e in errors) >= 2900


def test_model_calls_are_bounded_in_bytes(spark):
    def factory():
        return lambda items: [sum(map(len, items))] * len(items)

    frame = spark.createDataFrame([("x" * 10,)] * 9 + [("y" * 50,)], "t string").coalesce(1)
    done = models.apply_model(frame, "t", "int", factory, call_bytes=30).collect()
    assert sorted(r["value"] for r in done) == [30] * 9 + [50]
