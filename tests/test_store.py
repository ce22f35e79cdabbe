"""Upserts, the keyed table, files and the streams."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from leafmill.operators import filters, quarantine, upsert, vectors
from leafmill.plans import flow, ingest, parallel, workdir
from leafmill.plans.settings import settings
from leafmill.sources import files, keyed, tables
from leafmill.sources.keyed import KeyedTable
from leafmill.streaming import flows

SCHEMA = "id string, a string, f map<string,string>"


def _state(frame):
    return {r["id"]: (r["a"], r["f"]) for r in frame.collect()}


def _apply(state, batch):
    """Items applied one by one in order."""
    out = dict(state)
    for key, _, a, fields in sorted(batch, key=lambda item: item[1]):
        old = out.get(key, (None, None))[1]
        merged = old if fields is None else {**(old or {}), **fields}
        out[key] = (a, merged)
    return out


def _batch(rng, size, seq):
    keys = [None, *"abcdefgh"]
    return [
        (
            "hot" if rng.random() < 0.4 else rng.choice(keys),
            seq + n,
            rng.choice([None, "x", "y"]),
            rng.choice([None, {}, {"k": "1"}, {"k": None, "m": "2"}, {"z": str(n)}]),
        )
        for n in range(size)
    ]


def _frames(spark, batch):
    return spark.createDataFrame(batch, "id string, seq int, a string, f map<string,string>")


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_upsert_equals_one_by_one(spark, seed, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rng = random.Random(seed)
        start = {None: ("n", None), "a": ("1", {"k": "0"}), "zz": ("2", {"q": "1"}), "b": (None, None)}
        store = spark.createDataFrame([(k, *v) for k, v in start.items()], SCHEMA)
        batch = _batch(rng, 60, 0)
        new = upsert.upsert(store, _frames(spark, batch), ["id"], "seq", ["f"])
        assert new.columns == store.columns
        expected = _apply(start, batch)
        assert _state(new) == expected
        again = upsert.upsert(new, _frames(spark, batch), ["id"], "seq", ["f"])
        assert _state(again) == expected and again.count() == len(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_absent_columns_keep_and_new_columns_come(spark):
    store = spark.createDataFrame([(1, "a", "b")], "id int, x string, y string")
    batch = spark.createDataFrame([(1, 1, "new"), (2, 1, "two")], "id int, seq int, z string")
    got = upsert.upsert(store, batch, ["id"], "seq").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a", "b", "new"), (2, None, None, "two")]
    nulled = spark.createDataFrame([(1, 1, None)], "id int, seq int, x string")
    assert [tuple(r) for r in upsert.upsert(store, nulled, ["id"], "seq").collect()] == [(1, None, "b")]


def test_vector_upsert_by_namespace_and_id(spark):
    schema = "namespace string, id string, values array<float>, metadata map<string,string>"
    store = spark.createDataFrame([("n", "1", [1.0], {"a": "b"}), ("m", "1", [2.0], None)], schema)
    batch = spark.createDataFrame(
        [("n", "1", [3.0], {"c": "d"}, 1), ("m", "2", [4.0], None, 1)], schema + ", seq int"
    )
    got = vectors.vector_upsert(store, batch, "seq").collect()
    assert {(r["namespace"], r["id"]): (r["values"], r["metadata"]) for r in got} == {
        ("n", "1"): ([3.0], {"c": "d"}), ("m", "1"): ([2.0], None), ("m", "2"): ([4.0], None),
    }


def test_merge_statement_parses(spark):
    statement = upsert.merge_sql("t", "v", ["id"], ["id", "a"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    assert "MergeIntoTable" in plan.toString()


@pytest.fixture
def store(spark, tmp_path):
    return KeyedTable(spark, f"file://{tmp_path}/store", SCHEMA, maps=["f"], parts=5)


def test_table_life(spark, store):
    assert store.state().count() == 0
    rng, expected = random.Random(7), {}
    for n in range(4):
        batch = _batch(rng, 20, n * 100)
        for _ in range(2):  # again: nothing changes
            store.upsert(_frames(spark, batch), "seq")
            expected = _apply(expected, batch)
            assert _state(store.state()) == expected and store.state().count() == len(expected)
    store.upsert(_frames(spark, []), "seq")
    assert _state(store.state()) == expected
    assert store.delete_all() == len(expected)
    assert store.state().count() == 0
    store.upsert(_frames(spark, [("new", 1, "x", None)]), "seq")
    assert _state(store.state()) == {"new": ("x", None)}


def test_table_load_replaces(spark, store):
    store.upsert(_frames(spark, [("a", 1, "x", None)]), "seq")
    store.load(spark.createDataFrame([("b", "y", {"k": "v"})], SCHEMA))
    assert _state(store.state()) == {"b": ("y", {"k": "v"})}
    store.upsert(_frames(spark, [("b", 1, "z", {"m": None})]), "seq")
    assert _state(store.state()) == {"b": ("z", {"k": "v", "m": None})}


def test_partial_items_and_unknown_columns(spark, store):
    store.upsert(_frames(spark, [("a", 1, "x", {"k": "1"})]), "seq")
    only_fields = spark.createDataFrame([("a", 1, {"m": "2"})], "id string, seq int, f map<string,string>")
    store.upsert(only_fields, "seq")
    assert _state(store.state()) == {"a": ("x", {"k": "1", "m": "2"})}
    with pytest.raises(ValueError):
        store.upsert(spark.createDataFrame([("a", 1, "?")], "id string, seq int, other string"), "seq")


def _files(tmp_path):
    return {p.parent.name: p for p in (tmp_path / "store" / "parts-5").glob("*/*.parquet")}


def test_upsert_reads_and_writes_touched_partitions_only(spark, store, tmp_path):
    store.load(spark.createDataFrame([(str(k), "x", None) for k in range(200)], SCHEMA))
    before = _files(tmp_path)
    assert set(before) == {f"_part={k}" for k in range(5)}
    store.upsert(_frames(spark, [("7", 1, "y", None), ("7", 2, "z", None)]), "seq")
    after = _files(tmp_path)
    changed = {k for k in before if before[k] != after[k]}
    assert len(changed) == 1
    assert _state(store.state())["7"] == ("z", None) and store.state().count() == 200
    latest = upsert.collapse_keyed(
        _frames(spark, [("7", 3, "w", None)]), store._key(), ["id"], "seq", ["f"]
    )
    touched = [int(changed.pop().split("=")[1])]
    with settings(spark, {**keyed._BY_PART, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = store.merged(latest, "seq", touched)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(_part" in plan and f"(_part#" in plan
    # What is stored moves once, and so does the collapsed batch.
    assert plan.count("REPARTITION_BY_NUM") == 2
    assert "ENSURE_REQUIREMENTS" not in plan.split("FullOuter")[1].split("REPARTITION_BY_NUM")[0]


def test_number_of_parts_stays(spark, store, tmp_path):
    store.load(spark.createDataFrame([("a", "x", None)], SCHEMA))
    with pytest.raises(ValueError, match="parts"):
        KeyedTable(spark, f"file://{tmp_path}/store", SCHEMA, parts=6)


def test_hot_partition_and_types(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/store", "id int, n string", parts=1)
    table.upsert(spark.createDataFrame([(1, 5, 1)], "id int, n int, seq int"), "seq")
    table.upsert(spark.createDataFrame([("2", "x", 2)], "id string, n string, seq bigint"), "seq")
    table.upsert(spark.createDataFrame([(1, "y", "3")], "id bigint, n string, seq string"), "seq")
    assert {tuple(r) for r in table.state().collect()} == {(1, "y"), (2, "x")}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        table.upsert(spark.createDataFrame([("one", "y", 1)], "id string, n string, seq int"), "seq")
    assert table.state().count() == 2


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with settings(spark, {"spark.sql.shuffle.partitions": "77", "leafmill.own": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("leafmill.own", None) is None


def test_items_without_summary_are_set_aside(spark, store):
    items = _frames(spark, [("a", 1, "x", {"summary": "s"}), ("b", 2, "y", {"t": "u"})])
    ok, failed = quarantine.split_ok_failed(quarantine.require_map_keys(items, "f", ["summary"]))
    store.upsert(ok, "seq")
    assert set(_state(store.state())) == {"a"}
    assert [r["id"] for r in failed.collect()] == ["b"]


def test_store_summaries(spark, tmp_path):
    summaries = KeyedTable(spark, f"file://{tmp_path}/s", "id string, summary string")
    docs = spark.createDataFrame([(1, "A b. A c."), (2, None)], "n int, t string")
    flow.store_summaries(docs, summaries, "t", ["n"], "n")
    assert sorted(r["summary"] for r in summaries.state().collect()) == ["", "A b"]


def _write(folder, **contents):
    for name, data in contents.items():
        target = folder / name.replace("__", ".")
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)


def _names(frame):
    return sorted(r["path"].rsplit("/", 1)[1] for r in frame.collect())


def test_files(spark, tmp_path):
    _write(tmp_path / "in", a__pdf=b"one", b__txt=b"two", c__PDF=b"three")
    _write(tmp_path / "in" / "deep" / "er", d__pdf=b"four", e__pdf__bak=b"five")
    _write(tmp_path / "in" / "_arch", w__pdf=b"six")
    (tmp_path / "in" / "deep" / "none").mkdir()
    (tmp_path / "in" / ".z a%20é.pdf").write_bytes(b"seven")
    root = f"file://{tmp_path}/in"
    assert _names(files.list_files(spark, root)) == [".z a%20é.pdf", "a.pdf", "d.pdf", "w.pdf"]
    assert _names(files.list_files_containing(spark, root, "/deep/")) == ["d.pdf", "e.pdf.bak"]
    read = files.read_files(spark, root)
    assert read.schema.fields[:4] == files.BINARY_SCHEMA.fields
    contents = {r["path"].rsplit("/", 1)[1]: bytes(r["content"]) for r in read.collect()}
    assert contents == {".z a%20é.pdf": b"seven", "a.pdf": b"one", "d.pdf": b"four", "w.pdf": b"six"}
    assert _names(files.list_files(spark, root, modified_after="2199-01-01T00:00:00")) == []
    assert len(_names(files.list_files(spark, root, modified_after="2020-01-01T00:00:00"))) == 4
    # The same rows as Spark's own source gives for names that it shows.
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    listed = {tuple(r) for r in files.list_tree(spark, root).collect()}
    assert {tuple(r) for r in own.drop("content").collect()} < listed
    with pytest.raises(Exception, match="[Nn]o such file|does not exist"):
        files.list_tree(spark, root + "/nothing")


def test_tree_is_listed_in_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ENTRIES", 3)  # bound into the task with its module's values
    for k in range(6):
        for j in range(4):
            _write(tmp_path / "in" / f"a{k}" / f"b{j}" / "c", x__pdf=b"1")
    assert files.list_files(spark, f"file://{tmp_path}/in").count() == 24


def test_contents_are_read_above_every_exchange(spark, tmp_path):
    _write(tmp_path / "in", a__pdf=b"one")
    root = f"file://{tmp_path}/in"
    known = files.list_tree(spark, root).where("false")
    fresh = files.new_files(files.list_tree(spark, root), known)
    plan = files.with_contents(spark, fresh, root)._jdf.queryExecution().executedPlan().toString()
    top, below = plan.split("MapInArrow", 1)
    assert "Exchange" not in top and "Exchange" in below
    assert "content" not in below.split("Exchange", 1)[1]


def test_ingest_replaces_table_and_schema(spark, tmp_path):
    _write(tmp_path / "in", a__pdf=b"one")
    name = workdir.fresh_table("raw")
    tables.write_overwrite(spark.range(3), name, f"file://{tmp_path}/raw")
    table = ingest.ingest_files(
        spark, f"file://{tmp_path}/in", name, f"file://{tmp_path}/raw", replace=True
    )
    assert table.columns == [*files.BINARY_SCHEMA.names, "error", "timestamp", "year_month"]
    assert bytes(table.first()["content"]) == b"one"
    row = table.first()
    assert row["year_month"] == row["timestamp"].strftime("%Y-%m")
    assert tables.query(spark, "select * from {t}", t=name).count() == 1


def test_missing_table_or_field_is_empty(spark):
    assert tables.project_or_empty(spark, "no_such_table", "Metadata", "text").count() == 0
    name = workdir.fresh_table("items")
    tables.write_overwrite(spark.createDataFrame([("t",)], "text string"), name)
    missing = tables.project_or_empty(spark, name, "Metadata", "text")
    assert missing.columns == ["Metadata", "text"] and missing.count() == 0
    assert tables.project_or_empty(spark, name, "text").count() == 1


def test_stream_of_new_files(spark, tmp_path):
    source, table = tmp_path / "in", workdir.fresh_table("files")
    _write(source, a__pdf=b"one", _b__pdf=b"two", c__txt=b"no", big__pdf=b"12345678")

    def run():
        stream = flows.stream_new_files(
            spark, f"file://{source}", f"file://{tmp_path}/arrivals", limit=7
        )
        rows = flows.run_to_table(
            stream, table, f"file://{tmp_path}/cp", path=f"file://{tmp_path}/out"
        ).collect()
        return {r["path"].rsplit("/", 1)[1]: r["content"] and bytes(r["content"]) or r["error"] for r in rows}

    want = {"a.pdf": b"one", "_b.pdf": b"two", "big.pdf": "file too large"}
    assert run() == want
    _write(source / "_deep", d__pdf=b"three")
    assert run() == want | {"d.pdf": b"three"}
    assert run() == want | {"d.pdf": b"three"}
    assert spark.table(table).count() == 4


def test_stream_over_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = flows.stream_new_files(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/arrivals")
    name = workdir.fresh_table("files")
    assert flows.run_to_table(stream, name, f"file://{tmp_path}/cp").count() == 0


def test_overwritten_table_is_not_doubled(spark, tmp_path):
    raw, bronze = workdir.fresh_table("raw"), workdir.fresh_table("bronze")
    rows = spark.createDataFrame([(k, "2024-01") for k in range(5)], "n int, year_month string")

    def run(**options):
        return flows.process_table(
            spark, raw, bronze, f"file://{tmp_path}/cp", path=f"file://{tmp_path}/bronze", **options
        ).count()

    tables.write_overwrite(rows, raw, f"file://{tmp_path}/raw")
    assert run() == 5 and run() == 5
    tables.append(rows.where("n = 0"), raw)
    assert run() == 6
    tables.write_overwrite(rows, raw, f"file://{tmp_path}/raw")
    with pytest.raises(ValueError, match="double"):
        run()
    assert run(identity=["n"]) == 6
    more = rows.unionByName(spark.createDataFrame([(9, "2024-02")], rows.schema))
    tables.write_overwrite(more, raw, f"file://{tmp_path}/raw")
    assert run(identity=["n"]) == 7 and run(identity=["n"]) == 7


def test_tables_and_copies_gain_columns(spark, tmp_path):
    raw, bronze = workdir.fresh_table("raw"), workdir.fresh_table("bronze")

    def run():
        table = flows.process_table(
            spark, raw, bronze, f"file://{tmp_path}/cp", path=f"file://{tmp_path}/bronze"
        )
        return {tuple(r[c] for c in ("n", "x", "year_month")[: 1 + len(table.columns) - 1]) for r in table.collect()} if "x" in table.columns else table.count()

    tables.append(spark.createDataFrame([(1, "2024-01")], "n int, year_month string"), raw, f"file://{tmp_path}/raw")
    assert run() == 1
    tables.append(spark.createDataFrame([(2, "2024-02", 0.5)], "n int, year_month string, x double"), raw)
    assert run() == {(1, None, "2024-01"), (2, 0.5, "2024-02")}


def test_folder_stream_takes_new_columns(spark, tmp_path):
    source, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"

    def run(checkpoint="cp"):
        table = flows.process_folder(spark, source, target, f"file://{tmp_path}/{checkpoint}")
        return sorted((r.asDict() for r in table.collect()), key=lambda r: r["n"])

    def add(rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    add([(1, "2024-01")], "n int, year_month string")
    assert run() == [{"n": 1, "year_month": "2024-01"}]
    add([(2, "2024-01", "two")], "n int, year_month string, x string")
    add([(3, "2024-02", 3.0)], "n int, year_month string, y double")
    empty = {"x": None, "y": None}
    want = [
        empty | {"n": 1, "year_month": "2024-01"},
        empty | {"n": 2, "year_month": "2024-01", "x": "two"},
        empty | {"n": 3, "year_month": "2024-02", "y": 3.0},
    ]
    assert run() == want and run() == want
    # A batch that runs again takes the place of what it wrote.
    shutil.rmtree(tmp_path / "cp" / "commits")
    assert run() == want
    add([("4", "2024-02")], "n string, year_month string")
    with pytest.raises(Exception, match="column n is int and string"):
        run()
    assert flows.merge_schemas([]).fields == []


def test_stream_table_to_partitioned_table(spark, tmp_path):
    raw, bronze = workdir.fresh_table("raw"), workdir.fresh_table("bronze")
    rows = spark.createDataFrame([(1, "2024-01"), (2, "2024-02"), (3, "2024-01")], "n int, year_month string")
    tables.write_overwrite(rows, raw, f"file://{tmp_path}/raw")

    def run():
        return flows.process_table(
            spark, raw, bronze, f"file://{tmp_path}/cp", path=f"file://{tmp_path}/bronze"
        )

    assert run().count() == 3
    rows.filter("n = 1").write.mode("append").insertInto(raw)
    table = run()
    assert table.count() == 4
    month = table.filter("year_month = '2024-01'")
    assert month.count() == 3
    assert "PartitionFilters: [isnotnull(year_month" in month._jdf.queryExecution().executedPlan().toString()
    view = flows.stream_view(spark, raw, "rows_view")
    assert view.isStreaming


def test_stream_upsert_survives_a_repeated_batch(spark, tmp_path):
    source = tmp_path / "in"
    store = KeyedTable(spark, f"file://{tmp_path}/store", "id int, a string", parts=4)

    def add(rows):
        frame = spark.createDataFrame(rows, "id int, a string, seq int").coalesce(1)
        frame.write.mode("append").parquet(str(source))

    def run(checkpoint="cp"):
        stream = flows.stream_parquet(spark, f"file://{source}", "id int, a string, seq int")
        flows.upsert_stream(stream, store, "seq", f"file://{tmp_path}/{checkpoint}")
        return {r["id"]: r["a"] for r in store.state().collect()}

    add([(n, "x", 1) for n in range(10)])
    assert run() == {n: "x" for n in range(10)}
    add([(n, "y", 2) for n in range(5, 15)])
    expected = {n: "x" if n < 5 else "y" for n in range(15)}
    assert run() == expected
    assert run() == expected
    shutil.rmtree(tmp_path / "cp" / "commits")
    assert run() == expected
    assert store.delete_all() == 15
    assert run("cp2") == expected


def test_new_files_become_items(spark, tmp_path):
    def extractor():
        def call(items):
            out = []
            for content in items:
                data = bytes(content)
                if data == b"broken":
                    raise ValueError("not a document")
                out.append({"text": None, "pages": [data.decode(), "Last page."]})
            return out

        return call

    source = tmp_path / "in"
    store = KeyedTable(
        spark, f"file://{tmp_path}/store", flow.ITEM_SCHEMA, maps=["Metadata"], parts=4
    )

    def run():
        flows.summarize_new_files(
            spark, f"file://{source}", extractor, store, f"file://{tmp_path}/cp",
            limit=50, tries=1, pause=0.0,
        )
        return {r["Metadata"]["title"]: r for r in store.state().collect()}

    folder = source / "journal" / "law" / "doe"
    _write(folder, one__pdf="Été one".encode(), two__pdf=b"broken", three__txt=b"no", huge__pdf=b"x" * 51)
    items = run()
    assert set(items) == {"one", "two", "huge"}
    assert items["huge"]["error"] == "file too large" and items["huge"]["summary"] == ""
    assert items["one"]["text"] == "t  one\nLast page."
    assert items["one"]["summary"] == "t  one"
    assert items["one"]["Metadata"] == {
        "item": "journal", "category": "law", "author": "doe", "title": "one", "filetype": "pdf",
    }
    assert items["two"]["summary"] == "" and items["two"]["error"] == "ValueError: not a document"
    _write(folder, four__pdf=b"Four.")
    assert set(run()) == {"one", "two", "huge", "four"}
    done = filters.unprocessed(
        files.list_files(spark, f"file://{source}"), store.state(), "path", "Filepath"
    )
    assert done.count() == 0


def test_spread_only_when_too_few_splits(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = parallel.spread(spark.read.parquet(str(tmp_path / "one")), "id")
    assert one.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 16)
    assert parallel.spread(many, "id") is many


def test_work_folder_is_the_shared_one(spark):
    named = spark.conf.get(workdir.CHECKPOINT_DIR)
    assert workdir.fresh_dir(spark, "x").startswith(named)


def test_second_ingest_adds_nothing(spark, tmp_path):
    _write(tmp_path / "in", a__pdf=b"one", b__pdf=b"two")
    raw, bronze = workdir.fresh_table("raw"), workdir.fresh_table("bronze")

    def run():
        ingest.ingest_files(spark, f"file://{tmp_path}/in", raw, f"file://{tmp_path}/raw")
        table = flows.process_table(
            spark, raw, bronze, f"file://{tmp_path}/cp", path=f"file://{tmp_path}/bronze"
        )
        return spark.table(raw).count(), table.count()

    assert run() == (2, 2)
    assert run() == (2, 2)
    _write(tmp_path / "in", c__pdf=b"three")
    assert run() == (3, 3)


def test_no_file_is_lost(spark, tmp_path):
    _write(tmp_path / "in", x__pdf=b"one", _y__pdf=b"two", big__pdf=b"12345678")
    root = f"file://{tmp_path}/in"
    listed = files.list_tree(spark, root, ".pdf")
    (tmp_path / "in" / "x.pdf").unlink()
    rows = {r["path"].rsplit("/", 1)[1]: r for r in files.with_contents(spark, listed, root, 7).collect()}
    assert set(rows) == {"x.pdf", "_y.pdf", "big.pdf"}
    assert rows["x.pdf"]["error"].startswith("FileNotFoundError") and rows["x.pdf"]["content"] is None
    assert rows["big.pdf"]["error"] == "file too large" and rows["big.pdf"]["length"] == 8
    assert bytes(rows["_y.pdf"]["content"]) == b"two" and rows["_y.pdf"]["error"] is None


def test_vector_flow_cuts_each_text_once(spark):
    schema = "namespace string, doc_id bigint, id string, values array<float>, metadata map<string,string>, note string"
    cut = F.split("text", "\n")
    first = spark.createDataFrame([(1, "a b\nc\na b", "x"), (None, "n", "x"), (2, "q", "x")], "doc_id bigint, text string, lang string")
    second = spark.createDataFrame(
        [(1, "c\nd", "y"), (None, "n", "y"), (3, None, "y"), (4, "q", None), (4, "q", None)],
        "doc_id bigint, text string, lang string",
    )

    def after(store, docs):
        return vectors.vector_flow(store, docs, "main", "doc_id", "text", ["lang"], cut)

    def plain(store, docs):
        records = vectors.vector_records(docs, "doc_id", "text", ["lang"], cut)
        batch = records.select(F.lit("main").alias("namespace"), "doc_id", "id", "values", "metadata", "pos")
        return upsert.upsert(store, batch, ("namespace", "doc_id", "id"), "pos")

    empty = spark.createDataFrame([], schema)
    noted = [("main", 2, "gone", [1.0], {"lang": "old"}, "kept"), ("other", 1, "z", None, None, "too")]
    for store in (empty, spark.createDataFrame(noted, schema)):
        got, want = (f(f(store, first), second) for f in (after, plain))
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() >= 6
        steps = got._jdf.queryExecution().optimizedPlan().toString()
        assert steps.count("Generate posexplode") == 2
