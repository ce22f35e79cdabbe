"""The training-data operators against plain loops, on small tables with every odd kind of row."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from leafmill.llm import (
    bpe,
    chaining,
    fingerprints,
    jaccard,
    langid,
    packing,
    quality,
    secrets,
    suffixes,
    toxicity,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
# Names that the operators use inside, and the types are odd on purpose.
SCHEMA = (
    "id string, doc_id bigint, text string, key string, node int, row string, start double, "
    "size string, context string, value int, lang string"
)
BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
RNG = random.Random(5)
VOCAB = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 9))) for _ in range(400)]


def words(n, rng):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def edited(text, every, rng):
    return " ".join(
        rng.choice(VOCAB) if i % every == every - 1 else w for i, w in enumerate(text.split())
    )


def rows():
    rng = random.Random(11)
    base = words(300, rng)
    passage = words(80, rng)
    made = [
        (1, base), (2, edited(base, 60, rng)), (3, base), (4, edited(base, 3, rng)),
        (5, words(120, rng) + "\n" + passage + " " + words(90, rng)),
        (6, words(70, rng) + " " + passage + "\n" + words(60, rng)),
        (7, edited(passage, 25, rng) + " " + words(100, rng)),
        (8, None), (9, ""), (10, " \t\n"), (11, "one two"), (12, "One TWO"), (13, "x"),
        (14, "word " * 400), (15, "a" * 5000), (16, "àé ß 漢字 🙂 " * 40), (16, "àé ß 漢字 🙂 " * 40),
        (17, "<|endoftext|> it's  two   spaces   \x1c end "), (None, base), (None, None),
        (18, words(20_000, rng)),
    ]
    return [
        ("x", i, t, "k", 3, "r", 0.5, "s", "c", 9, None if k % 5 == 0 else "en")
        for k, (i, t) in enumerate(made)
    ]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


TEXTS = [(r[1], r[2]) for r in rows()]


def test_bpe_equals_the_library(frame, empty):
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for i, t in TEXTS:
        packed = np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
        digest = hashlib.sha256(packed).hexdigest()
        want[i, len(packed) // 4, digest, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.round_trip(frame, PATH).collect())) == want
    texts = bpe.decode(bpe.encode(frame, PATH), PATH).collect()
    assert Counter(map(tuple, texts)) == Counter((i, t or "") for i, t in TEXTS)
    assert bpe.round_trip(empty, PATH).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_bpe_any_text(text):
    model = bpe.vocabulary(PATH)
    packed = model.pack(text)
    want = Tokenizer.from_file(PATH) if not hasattr(test_bpe_any_text, "lib") else test_bpe_any_text.lib
    test_bpe_any_text.lib = want
    assert np.frombuffer(packed, "<u4").tolist() == want.encode(text, add_special_tokens=False).ids
    assert model.decode(packed).decode() == text
    assert packing.tokens(PATH).pack(text) == packed


@pytest.mark.parametrize("fan_in", [2, 64])
def test_packing_places_each_token_once(frame, empty, fan_in):
    library = Tokenizer.from_file(PATH)
    ids = defaultdict(list)
    for i, t in TEXTS:
        ids[i].append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    got = packing.pack_documents(frame, PATH, size=64, fan_in=fan_in, keep_open=4).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    for parts in sequences.values():
        ends = [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 64
    assert sum(sum(n for _, n in p) < 64 for p in sequences.values()) <= 1
    for i, lists in ids.items():
        want = Counter()
        for full in lists:
            for s, n, crc in set(pieces[i, len(full)]):
                if zlib.crc32(np.array(full[s : s + n], "<u4").tobytes()) == crc:
                    want.update(range(s, s + n))
        for full in lists:
            assert set(range(len(full))) <= set(want)
    total = sum(len(full) for lists in ids.values() for full in lists)
    assert sum(r["length"] for r in got) == total
    assert packing.pack_documents(empty, PATH).count() == 0
    assert packing.pack_documents(empty, PATH, end_id=None).count() == 0


def test_prefix_hashes():
    one, other = fingerprints.PrefixHash("abcabcabd🙂z"), fingerprints.PrefixHash("xxabcabd🙂y")
    assert one.span(0, 3) == one.span(3, 6) != one.span(6, 9)
    assert one.common_extension(3, other, 2) == len("abcabd🙂")
    assert one.same(0, other, 2, 5) and not one.same(0, other, 2, 6)
    starts = np.arange(5)
    assert one.spans(starts, starts + 4).tolist() == [one.span(i, i + 4) for i in range(5)]


def test_fingerprints_of_neighbours(frame, empty):
    order = sorted(
        [(i, t or "") for i, t in TEXTS if i is not None], key=lambda p: p[0], reverse=True
    )
    got = fingerprints.neighbours(frame).collect()
    assert Counter(r["id"] for r in got) == Counter(i for i, _ in TEXTS)
    by_id = defaultdict(list)
    for r in got:
        by_id[r["id"]].append(r)
    for (i, text), (_, following) in zip(order, order[1:]):
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        row = next(r for r in by_id[i] if r["edited_sha256"] == digest)
        by_id[i].remove(row)
        assert row["n_chars"] == len(text)
        assert row["common_edited"] == len(os.path.commonprefix([text, changed]))
        assert 0 <= row["near_next"] <= 1 and 0 <= row["near_edited"] <= 1
    prints = defaultdict(set)
    for r in fingerprints.fingerprint(frame).collect():
        prints[r["id"]].add(r["fingerprint"])
    assert prints[1] == prints[3] != prints[2]
    assert fingerprints.neighbours(empty).count() == 0
    single = frame.where("doc_id = 11")
    assert fingerprints.neighbours(single).first()["near_next"] == 1.0


def shingles(text):
    w = BLANKS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
    return frozenset(runs)


def linked(texts):
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    groups = defaultdict(list)
    for k in range(len(texts)):
        groups[root(k)].append(k)
    return sets, groups


def test_jaccard_components(frame, empty):
    sets, groups = linked(TEXTS)
    want = Counter()
    for members in groups.values():
        known = [TEXTS[k][0] for k in members if TEXTS[k][0] is not None]
        for k in members:
            want[TEXTS[k][0], len(sets[k]), min(known) if known else None] += 1
    got = jaccard.join_components(frame).select("id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == want
    assert jaccard.join_components(empty).count() == 0
    kept = jaccard.one_of_each(frame)
    assert kept.columns == frame.columns
    stay = Counter(r["doc_id"] for r in kept.collect())
    for members in groups.values():
        if sets[members[0]]:
            known = [TEXTS[k][0] for k in members if TEXTS[k][0] is not None]
            assert stay[min(known)] >= 1
    assert sum(stay.values()) == len(groups)


def test_jaccard_chains_and_tiles(spark, monkeypatch):
    """Chains of near copies whose ends are far apart; tiles so small that groups are cut."""
    rng = random.Random(3)
    texts, number = [], 0
    for _ in range(12):
        line = words(40, rng)
        for _ in range(6):
            texts.append((number, line))
            number += 1
            parts = line.split()
            parts[rng.randrange(len(parts))] = rng.choice(VOCAB)
            line = " ".join(parts)
    common = words(30, rng)
    for _ in range(30):
        texts.append((number, common + " " + words(rng.randint(2, 9), rng)))
        number += 1
    monkeypatch.setattr(jaccard, "TILE", 4)
    _, groups = linked(texts)
    want = {texts[k][0]: min(texts[m][0] for m in members) for members in groups.values() for k in members}
    frame = spark.createDataFrame(texts, "doc_id int, text string")
    got = {r["id"]: r["component_id"] for r in jaccard.join_components(frame).collect()}
    assert got == want


def test_bitmap_bounds_the_difference():
    rng = np.random.default_rng(1)
    for n in (5, 70, 3000):
        a = np.unique(rng.integers(-(2**62), 2**62, n))
        b = np.unique(np.concatenate([a[: n - n // 5], rng.integers(-(2**62), 2**62, n // 4)]))
        for bits in (64, 128):
            apart = np.bitwise_count(
                jaccard.folded(jaccard.bitmap(a), bits)[: bits // 64]
                ^ jaccard.folded(jaccard.bitmap(b), bits)[: bits // 64]
            ).sum() if n > 64 or bits == 64 else 0
            assert apart <= len(np.setxor1d(a, b))


def test_passages(frame, empty):
    got = chaining.passages(frame).collect()
    found = {(r["id"], r["other"]) for r in got}
    assert {(2, 1), (3, 1), (6, 5), (7, 5)} <= found
    for r in got:
        assert r["passage_end"] - r["passage_start"] >= 50 and r["id"] > r["other"]
        assert r["similarity"] >= 0.8
    row = next(r for r in got if (r["id"], r["other"]) == (6, 5))
    assert (row["passage_start"], row["passage_end"]) == (70, 150)
    assert not {i for i, _ in found} & {4, 8, 9, 10, 11, 12, 13, 15, 18}
    assert chaining.passages(empty).count() == 0
    cut = chaining.without_passages(frame)
    assert cut.columns == frame.columns
    texts = {r["doc_id"]: r["text"] for r in cut.collect() if r["doc_id"] is not None}
    assert texts[3] == "" and texts[1] == TEXTS[0][1] and texts[8] is None
    assert len(texts[6].split()) == 130


def test_chains_are_collinear_and_best_first():
    here = [0, 5, 10, 15, 20, 25]
    there = [100, 105, 3, 115, 120, 8]
    best, second = chaining.chains(here, there)[:2]
    assert best == [0, 1, 3, 4] and second == [2, 5]
    assert chaining.chains([], []) == []
    assert chaining.chains([1, 1, 1], [5, 6, 7]) in ([[0], [1], [2]],)


def test_suffix_array_equals_sorting():
    rng = random.Random(2)
    for _ in range(400):
        text = bytes(rng.choice(rng.choice([b"ab", b"a", b"abcdefgh\0"])) for _ in range(rng.randint(0, 70)))
        assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_dedup(frame, empty):
    texts = [(i, (t or "").encode()) for i, t in TEXTS]
    first = {}
    for i, raw in texts:
        if i is not None:
            for k in range(len(raw) - 49):
                w = raw[k : k + 50]
                first[w] = min(first.get(w, i), i)
    want = Counter()
    for i, raw in texts:
        flags = bytearray(len(raw))
        for k in range(len(raw) - 49):
            holder = first.get(raw[k : k + 50])
            if holder is not None and (i is None or holder < i):
                flags[k : k + 50] = b"\1" * 50
        kept = bytes(b for b, f in zip(raw, flags) if not f)
        runs = len(re.findall(b"\1+", bytes(flags)))
        want[i, len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest()] += 1
    got = suffixes.deduplicate(frame).drop("kept").collect()
    assert Counter(map(tuple, got)) == want
    assert suffixes.deduplicate(empty).count() == 0


def test_quality_counts(frame, empty, spark):
    for i, text in [*TEXTS, (0, "a b c a b c\nx\n \na b c\n\nx")]:
        t = text or ""
        w = BLANKS.findall(t)
        windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = set()
        for k in range(len(w) - 2):
            if windows[tuple(w[k : k + 3])] > 1:
                covered.update((k, k + 1, k + 2))
        seen, doubled = set(), 0
        for line in t.split("\n"):
            if BLANKS.search(line):
                doubled += line in seen
                seen.add(line)
        counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), doubled, len(covered))
        assert quality.statistics(text)[0] == counts
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id bigint, quality int")
    assert quality.fit(frame, labels) is None
    judged = quality.judge(frame, None).collect()
    assert len(judged) == len(TEXTS)
    assert {r["id"] for r in judged if r["kept"]} >= {1, 2, 5, 18} and not any(
        r["kept"] for r in judged if r["n_words"] < 50
    )
    kept = quality.accepted(frame, None)
    assert kept.columns == frame.columns and kept.count() == sum(r["kept"] for r in judged)
    assert quality.judge(empty, None).count() == 0


def test_isolation_forest_finds_odd_rows():
    rng = np.random.default_rng(4)
    usual = rng.normal(size=(2000, 4))
    odd = rng.normal(size=(100, 4)) + np.array([0, 0, 9, 0])
    both = np.vstack([usual, odd])
    forest = quality.grow(usual, both.min(axis=0), both.max(axis=0))
    good = np.repeat([1, 0], [2000, 100])
    quality.calibrate(forest, forest.scores(both), good, 0.01)
    rejected = forest.scores(both) > forest.threshold
    assert rejected[2000:].mean() > 0.9 and rejected[:2000].mean() <= 0.01


def test_secrets(spark, empty):
    rng = random.Random(8)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(40)]
    texts = [(k, f"{words(30, rng)} token = \"{h}\" {words(5, rng)}") for k, h in enumerate(hexes)]
    bare = "".join(rng.choice("0123456789abcdef") for _ in range(26))
    texts += [
        (100, f"see {bare} now"), (101, "PASSWORD:abc password: abcdefgh1 AKIA123 AKIA" + "Z9" * 8),
        (102, None), (103, ""), (104, "ünï api-key api_key='12345678' apikey=short"),
        (105, "antidisestablishment thonoroushestation"), (100, f"see {bare} now"),
    ]
    frame = spark.createDataFrame(texts, "doc_id int, text string").repartition(2)
    model = secrets.fit(frame)
    got = {r["id"]: r for r in secrets.find(frame, model).collect()}
    for i, text in texts:
        base = []
        for m in secrets.ASSIGN.finditer(text or ""):
            base += [("assign", *m.span())] if len(m[2]) >= 8 else []
        base += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
        base += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 32]
        base.sort(key=lambda s: (s[1], secrets.KINDS.index(s[0])))
        assert [(s["kind"], s["start"], s["end"]) for s in got[i]["base"]] == base
        assert [s for s in got[i]["spans"] if s["kind"] != "model"] == got[i]["base"]
    assert [s["kind"] for s in got[100]["spans"]] == ["model"]
    assert got[100]["redacted"] == "see [secret] now" and got[102]["redacted"] is None
    assert got[105]["spans"] == []
    assert secrets.fit(empty) is None and secrets.find(empty, None).count() == 0
    assert secrets.redacted(frame, model).count() == len(texts)


def test_language_mixtures(spark, empty, frame):
    rng = random.Random(6)
    letters = {"aa": "abcde", "bb": "klmno", "cc": "vwxyz"}

    def speak(lang, n):
        return " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(n))

    known = [(k, speak(lang, 60), lang) for k, lang in enumerate(list(letters) * 5)]
    train = spark.createDataFrame([*known, (99, None, "aa"), (98, "x", None)], "doc_id int, text string, lang string")
    model = langid.fit(train)
    assert model[0] == ["aa", "bb", "cc"]
    asked = [(1, speak("aa", 50)), (2, speak("bb", 30) + " " + speak("cc", 70)), (3, "12 34 !"), (4, None), (5, "")]
    got = {
        r["id"]: r
        for r in langid.predict(spark.createDataFrame(asked, "doc_id int, text string"), model).collect()
    }
    assert got[1]["lang_pred"] == "aa" and [s["lang"] for s in got[1]["languages"]] == ["aa"]
    assert got[2]["lang_pred"] == "cc" and [s["lang"] for s in got[2]["languages"]] == ["bb", "cc"]
    assert abs(got[2]["score"] - 0.7) < 0.05
    assert [(got[k]["lang_pred"], got[k]["score"]) for k in (3, 4, 5)] == [("und", 0.0)] * 3
    none = langid.fit(empty)
    assert none[0] == [] and {r["lang_pred"] for r in langid.predict(frame, none).collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


def test_toxicity(spark, empty, frame):
    rng = random.Random(9)
    insults = ["zorblat", "quvvix", "wyzzok"]
    docs, labels = [], []
    for k in range(240):
        parts = words(60, rng).split()
        toxic = k % 3 == 0
        if toxic:
            parts.insert(rng.randrange(60), insults[k % 9 // 3])
        docs.append((k, " ".join(parts)))
        labels.append((k, int(toxic)))
    docs += [(900, None), (901, ""), (902, words(40, rng) + " zor-blat " + words(9, rng)), (903, "z o r b l a t")]
    frame2 = spark.createDataFrame(docs, "doc_id int, text string")
    train = spark.createDataFrame(labels, "doc_id int, toxic int")
    machine = toxicity.fit(frame2, train.where("doc_id < 180"))
    got = {r["id"]: r for r in toxicity.score(frame2, machine).collect()}
    held = [(got[k]["score"] >= 0.3) == bool(t) for k, t in labels if k >= 180]
    assert np.mean(held) > 0.95
    assert got[902]["score"] >= 0.3 and got[902]["word"] == "zor-blat" and got[903]["score"] >= 0.3
    assert got[900]["score"] < 0.3 and got[901]["score"] < 0.3
    assert toxicity.fit(frame2, train.where("toxic = 1")) is None
    assert {r["score"] for r in toxicity.score(frame, None).collect()} == {0.0}
    assert toxicity.score(frame, machine).count() == len(TEXTS)
    assert toxicity.score(empty, machine).count() == 0
