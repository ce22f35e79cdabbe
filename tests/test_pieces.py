"""Files that are kept in pieces: no row or task holds a whole file."""

import hashlib
import random

import __spark_entry__
from leafmill.plans import ingest, workdir
from leafmill.sources import files, tables
from leafmill.streaming import flows


def _digest(data):
    return hashlib.sha256(data).hexdigest()


def _got(frame):
    return sorted((r["path"].rsplit("/", 1)[1], r["length"], r["digest"]) for r in frame.collect())


def test_files_are_ingested_in_pieces(spark, tmp_path):
    rng = random.Random(5)
    made = {f"{n}.pdf": rng.randbytes(n) for n in (0, 1, 999, 1000, 1001, 2000, 54321)}
    (tmp_path / "in").mkdir()
    for name, data in made.items():
        (tmp_path / "in" / name).write_bytes(data)
    raw, bronze = workdir.fresh_table("raw"), workdir.fresh_table("bronze")

    def run(**options):
        ingest.ingest_files(spark, f"file://{tmp_path}/in", raw, f"file://{tmp_path}/raw", piece=1000, **options)
        return flows.process_table(spark, raw, bronze, f"file://{tmp_path}/cp", path=f"file://{tmp_path}/bronze")

    for _ in range(2):
        table = run()
        rows = table.select("path", "length", "part", "last", "content").collect()
        assert len(rows) == sum(max(1, -(-len(data) // 1000)) for data in made.values())
        assert max(len(r["content"]) for r in rows) == 1000
        assert _got(files.digests(table)) == sorted((n, len(d), _digest(d)) for n, d in made.items())
    (tmp_path / "in" / "new.pdf").write_bytes(b"new" * 700)
    assert files.digests(run()).count() == len(made) + 1
    twice = table.unionAll(table)
    assert _got(files.digests(twice)) == sorted(2 * _got(files.digests(table)))


def test_pieces_of_changed_and_missing_files(spark, tmp_path):
    for name in ("gone", "grown", "shrunk", "big"):
        (tmp_path / name).write_bytes(b"0123456789" * (3 if name == "big" else 2))
    root = f"file://{tmp_path}"
    listed = files.list_tree(spark, root)
    (tmp_path / "gone").unlink()
    (tmp_path / "grown").write_bytes(b"abc" * 8)
    (tmp_path / "shrunk").write_bytes(b"abc")
    pieces = files.with_pieces(spark, listed, root, limit=25, piece=7)
    got = {name: (n, digest) for name, n, digest in _got(files.digests(pieces))}
    assert got == {
        "gone": (20, None),
        "grown": (20, _digest(b"abc" * 8)),
        "shrunk": (20, _digest(b"abc")),
        "big": (30, None),
    }
    said = {r["error"] for r in pieces.where("path like '%big'").collect()}
    assert said == {"file too large"}
    tables.write_overwrite(pieces, name := workdir.fresh_table("pieces"), f"file://{tmp_path}/out")
    assert spark.table(name).where("last").count() == 4


def test_query_holds_no_whole_file(spark, tmp_path, monkeypatch):
    data = random.Random(6).randbytes(5000)
    (tmp_path / "a.parquet").write_bytes(data)
    monkeypatch.setattr(files, "PIECE_BYTES", 1000)
    held, real = [], flows.process_table

    def noted(*args, **named):
        table = real(*args, **named)
        held.extend(len(r["content"]) for r in table.collect())
        return table

    monkeypatch.setattr(flows, "process_table", noted)
    (row,) = __spark_entry__.ingest_twice(spark, f"file://{tmp_path}").collect()
    assert tuple(row) == ("a.parquet", 5000, _digest(data)) and held == [1000] * 10
