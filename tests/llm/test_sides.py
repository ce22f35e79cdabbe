"""Anchors, contexts and what of them enters a suffix array, against plain loops."""

import random

import numpy as np
import pyarrow as pa

from leafmill.llm import suffixes


def test_arrays_take_in_only_what_may_be_shared(monkeypatch):
    draw = random.Random(6)
    anchor = bytes(draw.choice(b"abc") for _ in range(30))
    left, right = b"l" * 12, b"r" * 9
    rows = []
    for k in range(100):  # each agrees with the others on 12 bytes before and 9 after the anchor
        own = f"{k:03d}".encode()
        rows.append((7, k, 200 - k, 20, b"x" * 5 + own[::-1] + left + anchor + right + own + b"y" * 8))
    rows += [(8, 100 + k, k, 20, f"{k:020d}".encode()[::-1] + anchor + f"{k:020d}".encode()[::-1]) for k in range(10)]
    seen, made = [], {}
    real = suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda text: seen.append(len(text)) or real(text))
    monkeypatch.setattr(suffixes, "map_rows", lambda df, run, schema: made.setdefault("run", run))
    suffixes._judged(None, "bigint")
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    key, number, owner, lead, context = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    names = ["key", "class", "least", "last", "lead", "context"]
    batch = pa.RecordBatch.from_arrays([key, number, owner, owner, lead, context], names)
    got = {r["class"]: r["removed"] for b in made["run"](iter([batch])) for r in b.to_pylist()}
    want = {}
    for key, number, owner, _, context in rows:
        others = [r[4] for r in rows if r[0] == key and r[2] < owner]
        want[number] = [k for k in range(21) if any(o[k : k + 50] == context[k : k + 50] for o in others)]
    assert got == want and want[0] and not want[105]
    assert sum(seen) <= 100 * 16  # not the 41 bytes around each anchor


def test_joined_texts_have_the_anchors_of_each_text():
    draw = random.Random(7)
    raws = [bytes(draw.choice(b"ab ") for _ in range(n)) for n in (0, 49, 50, 51, 400, 0, 70, 1000, 3)]

    def found(part):
        data, starts, ends = suffixes.joined_texts(part)
        parts = suffixes.hashes(data)
        key, at = suffixes.anchors(parts, starts, ends)
        row = np.searchsorted(starts, at, "right") - 1
        return [*zip(row.tolist(), (at - starts[row]).tolist(), key.tolist(), suffixes.class_numbers(parts, at).tolist())]

    got = found(raws)
    assert got == [(k, *rest) for k, raw in enumerate(raws) for _, *rest in found([raw])]
    for k, raw in enumerate(raws):
        places = [at for row, at, *_ in got if row == k]
        assert all(any(p <= at <= p + 20 for at in places) for p in range(len(raw) - 49))
        assert all(0 <= at <= len(raw) - 30 for at in places)


def test_bits_of_shared_anchors_equal_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HELD_KEYS", 40)
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 150)
    draw = random.Random(8)
    common = "".join(draw.choice("abc") for _ in range(90))
    texts = ["".join(draw.choice("abcdef") for _ in range(draw.randrange(120))) for _ in range(40)]
    rows = [(k, t + common * (k % 3 == 0)) for k, t in enumerate(texts)]
    rows += [(1, rows[1][1]), (None, texts[2]), (50, None), (51, texts[3])]
    holders = {}
    for ident, text in rows:
        data, starts, ends = suffixes.joined_texts([(text or "").encode()])
        key, _ = suffixes.anchors(suffixes.hashes(data), starts, ends)
        for k in key.tolist():
            holders.setdefault(k, set()).update({ident} if ident is not None else {"one", "other"})
    want = {k & (suffixes.SHARED_BITS - 1) for k, ids in holders.items() if len(ids) > 1}
    frame = spark.createDataFrame(rows, "id long, text string").repartition(3)
    blocks = suffixes._key_blocks(frame, 37).cache()
    assert blocks.count() > 37
    made = [r for r in suffixes._shared_bits(blocks).collect()]
    assert {64 * r["word"] + b for r in made for b in range(64) if r["bits"] >> b & 1} == want and len(want) >= 10
    assert len({r["word"] for r in made}) == len(made)
