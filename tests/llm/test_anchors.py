"""Classes of shared anchors: compared over their anchor, which takes one byte of the suffix array."""

import random

import pyarrow as pa

from leafmill.llm import suffixes


def _classes(draw):
    rows = []
    for key in range(40):
        anchor = bytes(draw.choice(b"abc") for _ in range(30))
        for _ in range(draw.choice([1, 2, 30])):
            left = bytes(draw.choice(b"xy") if draw.random() < 0.1 else 97 for _ in range(draw.choice([20, 20, 3])))
            right = bytes(draw.choice(b"xy") if draw.random() < 0.1 else 97 for _ in range(draw.choice([20, 20, 7])))
            rows.append((key, len(rows), draw.randrange(25), len(left), left + anchor + right))
    return rows


def test_judged_classes_equal_plain_loops_and_arrays_leave_anchors_out(monkeypatch):
    rows = _classes(random.Random(4))
    least, want = {}, {}
    for key, _, owner, lead, context in rows:
        for k in range(len(context) - 49):
            place = key, lead - k, context[k : k + 50]
            least[place] = min(least.get(place, owner), owner)
    for key, number, owner, lead, context in rows:
        want[number] = [k for k in range(len(context) - 49) if least[key, lead - k, context[k : k + 50]] < owner]
    seen, made = [], {}
    real = suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda text: seen.append(len(text)) or real(text))
    monkeypatch.setattr(suffixes, "ARRAY_BYTES", 4000)
    monkeypatch.setattr(suffixes, "map_rows", lambda df, run, schema: made.setdefault("run", run))
    suffixes._judged(None, "bigint")
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    key, number, owner, lead, context = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    names = ["key", "class", "least", "last", "lead", "context"]
    whole = pa.RecordBatch.from_arrays([key, number, owner, owner, lead, context], names)
    parts = [whole.slice(k, 7) for k in range(0, whole.num_rows, 7)]
    got = [r for b in made["run"](iter(parts)) for r in b.to_pylist()]
    assert {r["class"]: r["removed"] for r in got} == want and len(got) == len(rows)
    assert any(want.values()) and sum(seen) <= sum(len(r[4]) - 28 for r in rows)
    assert list(made["run"](iter([whole.slice(0, 0)]))) == []
