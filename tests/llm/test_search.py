"""License scans, spelling variants and hard negatives against plain loops."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from leafmill.llm import licenses, negatives, queries, spelling

# Names that the operators use inside, with odd types.
CLASHING = (
    "word string, n string, key int, base string, id date, label string, tile string, spans int"
)
BLANK = (None,) * 8


# --- licenses -------------------------------------------------------------------------------


def distances(wording, line):
    """Least number of edits from the wording to a stretch of the line that ends at each place."""
    row = [0] * (len(line) + 1)
    for i, a in enumerate(wording, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(line, 1):
            before, row[j] = row[j], min(before + (a != b), row[j] + 1, row[j - 1] + 1)
    return row


def edit(text, times, rng):
    chars = list(text)
    for _ in range(times):
        at, what = rng.randrange(len(chars)), rng.randrange(3)
        letter = rng.choice("abcdelnrst ")
        chars[at : at + (what != 1)] = [letter] if what != 2 else []
    return "".join(chars)


def test_every_notice_within_its_edits_is_found():
    rng = random.Random(2)
    scanner = licenses.Scanner(licenses.PHRASES, licenses.NOTICES)
    seen = Counter()
    for _ in range(150):
        words = ["".join(rng.choices("aelnrst", k=rng.randint(1, 8))) for _ in range(12)]
        notice = rng.choice(scanner.notices)
        words.insert(rng.randrange(12), edit(notice.wording.strip(), rng.randint(0, notice.edits + 2), rng))
        line = f" {' '.join(' '.join(words).split())} "
        found = scanner.notices_in(line)
        for number, known in enumerate(scanner.notices):
            spans = [(a, b, n) for a, b, k, n in found if k == number]
            ends = [j for j, d in enumerate(distances(known.wording, line)) if d <= known.edits]
            assert bool(spans) == bool(ends), (line, known.wording)
            for a, b, n in spans:
                assert distances(known.wording, line[a:b])[-1] <= n <= known.edits
            assert all(any(a < j <= b + 2 * known.edits for a, b, _ in spans) for j in ends)
            seen[bool(ends)] += 1
    assert seen[True] > 80


def test_license_query(spark, tmp_path):
    texts = {
        1: "Été! Released under the\nMIT License. MIT license;cc-by. And CC\tBY",
        2: "Licenced under the Apach License, Versoin 2.0.",
        3: "Lizenz: Released under teh MIT-Licence (ça va)",
        4: None,
        5: "",
        6: " .,\n",
        7: "gnu general public license " * 3000 + "x" * 100_000,
        8: "nothing of the kind stands here",
        9: "Licensed under the Apache License, Version 2.0. " * 40,
    }
    rows = [(k, t, *BLANK) for k, t in [*texts.items(), (1, texts[1]), (None, texts[2])]]
    frame = spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for row in queries.op11_licenses(spark, str(tmp_path)).collect():
        assert got.setdefault(row["doc_id"], row) == row
    assert len(got) == 10
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for key, text in texts.items():
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = pattern.findall(low)
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            parts = phrase.split()
            hits = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            places += hits
            labels |= {label} if hits else set()
        row = got[key]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert row["first_word"] == min(places, default=None)
        assert row["last_word"] == max(places, default=None)
        assert row["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(row["labels"].split(","))
    assert {k: got[k]["labels"] for k in (1, 2, 3, 8)} == {1: "cc-by,mit", 2: "apache", 3: "mit", 8: ""}
    assert got[1]["score"] == 1 and got[8]["score"] == 0 and 0.85 < got[2]["score"] < 1
    spans = licenses.find(frame).where("id = 3").first()["spans"]
    assert [texts[3][s["start"] : s["end"]] for s in spans] == ["Released under teh MIT-Licence"]
    many = licenses.find(frame).where("id = 9").first()["spans"]
    whole = [texts[9][s["start"] : s["end"]] for s in many if s["likeness"] == 1]
    assert whole.count("Licensed under the Apache License, Version 2.0") == 40


def test_license_scan_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.find(frame).count() == 0


# --- spelling -------------------------------------------------------------------------------


def apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(
        long[:i] + long[i + 1 :] == short for i in range(len(long))
    )


def variants_by_force(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            number = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if number % 31 == 0:
                at = number % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    out = {}
    for word, n in counts.items():
        near = [w for w in counts if apart(word, w)]
        form = min(near, key=lambda w: (-counts[w], w), default=None)
        if form is not None and counts[form] < 10 * n:
            form = None
        out[word] = [form, word, n, len(near), counts.get(form)]
    for row in out.values():
        while out[row[1]][0] is not None:
            row[1] = out[row[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def spelled(seed):
    rng = random.Random(seed)
    rows = []
    words = ["".join(rng.choices("abÉé", k=rng.randint(6, 11))) for _ in range(60)]
    words += ["konstantinopel", "Konstantinopels", "x" * 3000, "x" * 3001]
    for key in range(120):
        picked = [words[int(rng.random() ** 3 * len(words))] for _ in range(60)]
        picked = [edit(w, rng.randint(0, 1) if rng.random() < 0.1 else 0, rng) for w in picked]
        rows.append((key, rng.choice([" ", ", ", "\n"]).join(picked)))
    chain = [("aaaaaaaa", 2500), ("aaaaaaab", 230), ("aaaaaacb", 21), ("aaaaadcb", 2)]
    rows += [(1000, " ".join([w] * n)) for w, n in chain]
    return [*rows, (None, "abababab " * 5), (2000, None), (2001, ""), rows[0], rows[0]]


@pytest.mark.parametrize("group", [4096, 3])
def test_variants_equal_brute_force(spark, group):
    rows = spelled(7)
    frame = spark.createDataFrame([(*r, *BLANK) for r in rows], f"doc_id long, text string, {CLASHING}")
    got = spelling.variants(frame.repartition(5), group=group).collect()
    assert {r["word"]: tuple(r)[1:] for r in got} == variants_by_force(rows)
    assert len(got) == len({r["word"] for r in got})
    roots = {r["word"]: r["root"] for r in got}
    assert max(len({roots[w]}) for w in roots) == 1


def test_roots_follow_long_ways(spark):
    words = ["a" * 8 + "b" * k for k in range(6)]
    rows = [(k, " ".join([w] * 10 ** (5 - k) * 2)) for k, w in enumerate(words)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["word"]: r["root"] for r in spelling.variants(frame, one_in=10**9).collect()}
    assert got == dict.fromkeys(words, words[0])


def test_variants_of_an_empty_table(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_slices_over_random_pieces():
    rng = random.Random(4)
    for _ in range(200):
        base = rng.randint(1, 5)
        made = {"".join(rng.choices("abc", k=base + rng.randint(0, 1))) for _ in range(20)}
        pieces = sorted(made, key=lambda p: rng.random())
        index = spelling.Slices(pieces)
        for last in (False, True):
            for piece in pieces:
                bits = index.near(piece, base, last)
                for number, other in enumerate(pieces):
                    want = apart(piece, other) and min(len(piece), len(other)) == base
                    if want and len(piece) != len(other) and not last:
                        short, long = sorted((piece, other), key=len)
                        want = not long.startswith(short)
                    assert want == bool(bits >> number & 1)


# --- hard negatives -------------------------------------------------------------------------


def negatives_by_force(rows, positives=5, most=10):
    known = {}
    for key, vector, label in rows:
        if key is None or label is None or vector is None:
            continue
        if all(x is not None and math.isfinite(x) for x in vector):
            row = label, [math.floor(256 * float(np.float32(x))) for x in vector]
            known[key] = min(row, known.get(key, row))
    out = []
    for anchor, (label, vector) in known.items():
        if anchor % 100:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, other)), key, name)
            for key, (name, other) in known.items()
            if key != anchor
        )
        for score, key, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and -30 * score <= -100 * s[0] <= -90 * score]
            out += [(anchor, key, n, s[1], -score, -s[0]) for n, s in enumerate(fit[:most], 1)]
    return sorted(out)


def vectors(count, seed, spread):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, 8)) * 0.4
    rows = []
    for key in range(count):
        vector = middles[key % 6] + rng.normal(size=8) * spread
        rows.append((key * 5, [float(np.float32(x)) for x in vector], int(rng.integers(0, 3))))
    same = rows[0][1]
    rows += [(90_001 + k, same, k % 3) for k in range(200)]
    odd = [(None, same, 1), (7_000_000, None, 1), (7_000_100, same, None), (7_000_200, [1.0, None], 1)]
    odd += [(7_000_300, [float("nan")] * 8, 1), (7_000_400, [float("inf")] * 8, 0)]
    return [*rows, *odd, rows[20], rows[20], (rows[20][0], rows[3][1], 0), (7_000_500, [0.0] * 8, 1)]


@pytest.mark.parametrize("spread", [0.02, 0.5])
def test_negatives_equal_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 200)
    monkeypatch.setattr(negatives, "BLOCK", 7)
    rows = vectors(900, 3, spread)
    schema = "vec_id long, embedding array<float>, label int, " + CLASHING.replace("label string, ", "")
    frame = spark.createDataFrame([(*r, *BLANK[1:]) for r in rows], schema).repartition(4)
    got = negatives.hard_negatives(frame, negatives.F.col("id") % 100 == 0)
    want = negatives_by_force(rows)
    assert len(want) > 300 and sorted(map(tuple, got.collect())) == want


def test_vectors_of_different_lengths_and_no_rows(spark):
    rows = [(0, [1.0], 1), (1, [1.0, 9.0], 1), (2, [0.5, 4.0], 2), (3, [], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = negatives.hard_negatives(frame, negatives.F.col("id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 65536, 32768)]
    assert negatives.hard_negatives(frame, negatives.F.lit(False)).count() == 0
    assert negatives.hard_negatives(frame.limit(0), negatives.F.lit(True)).count() == 0


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(5)
    middles = np.floor(rng.normal(size=(8, 16)) * 200)
    points = np.floor(middles[rng.integers(0, 8, 3000)] + rng.normal(size=(3000, 16)) * 3)
    # Anchors of one middle: their edges are short, so their parent's scores bound their own closely.
    anchors = np.floor(middles[0] + rng.normal(size=(30, 16)) * 3)
    order, parents, edges = negatives.spanning_tree(anchors)
    assert sorted(order) == list(range(30)) and edges[order[0]] == 0
    place = np.argsort(order)
    none = np.empty(0, np.int64)
    scores = np.full(30, int((middles[0] @ middles[0])))
    block = negatives.Block(
        np.arange(30), np.zeros(30, int), anchors[order], place[parents[order]], edges[order],
        np.arange(30), np.arange(30), scores,
    )
    tile = negatives.Tile.of([(np.arange(100, 3100), np.ones(3000, int), points)])
    exact = (tile.vectors @ block.vectors.T).astype(np.int64)

    def wanted(number, part, low, high, score, known):
        assert (low <= exact[part, number]).all() and (exact[part, number] <= high).all()
        return none, none

    negatives.bounded(block, tile, wanted)
    found, (done, every) = negatives.find_negatives(block, tile, 10, 30, 90)
    assert done < every / 2
    least, greatest = negatives.windows_of(scores, 30, 90)
    for number, (got, ids) in enumerate(found):
        inside = (exact[:, number] >= least[number]) & (exact[:, number] <= greatest[number])
        want = negatives.best(exact[inside, number], tile.ids[inside], 10)
        assert got.tolist() == want[0].tolist() and ids.tolist() == want[1].tolist()


def test_scores_stay_exact_or_fail():
    assert negatives._kind(4000) is np.float32 and negatives._kind(5000) is np.float64
    assert negatives._kind(1e9) is np.int64
    with pytest.raises(OverflowError):
        negatives._kind(2.0**31)
