"""What an operator once cut short: small tables on which the cut shows."""

import random

import numpy as np
from pyspark.sql import functions as F

from leafmill.llm import chaining, fingerprints, quality, suffixes


def text_of(n, rng):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def test_fingerprints_hold_64_whole_hashes(spark):
    rng = random.Random(3)
    made = [(i, text_of(rng.choice([0, 1, 3, 40, 300]), rng)) for i in range(40)]
    frame = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in fingerprints.neighbours(frame).withColumnRenamed("id", "doc_id").collect()}
    texts = dict(made)
    for doc, text in made:
        following = texts[(doc - 1) % len(made)]
        changed = fingerprints.edited_text(text, following)
        one, other, after = (fingerprints.PrefixHash(t) for t in (text, changed, following))
        spans = {text[i : i + fingerprints.SPAN] for i in range(max(1, len(text) - 9))} - {""}
        sketch = got[doc]["fingerprint"].split(":")[2]
        assert len(sketch) == 16 * min(64, len(spans))
        assert got[doc]["fingerprint"] == one.fingerprint()[0]
        assert got[doc]["edited_fingerprint"] == other.fingerprint()[0]
        assert got[doc]["near_edited"] == fingerprints.likeness(one.sketch(), other.sketch())
        assert got[doc]["near_next"] == fingerprints.likeness(one.sketch(), after.sketch())
    high = np.concatenate([fingerprints.PrefixHash(t).sketch() for t in texts.values()])
    assert (high > np.uint64(0xFFFFFFFF)).any()


def test_passages_of_50_words_are_all_found(spark):
    rng = random.Random(8)
    made, want = [], {}
    for k in range(400):
        size, changes = rng.randint(50, 60), (0, 2, 5)[k % 3]
        passage = text_of(size, rng).split()
        copy = list(passage)
        for at in rng.sample(range(1, size - 1), changes):
            copy[at] = "changed" + str(at)
        equal = [a == b for a, b in zip(passage, copy)]
        runs = [i for i in range(size - 4) if all(equal[i : i + 5])]
        ends = runs[0], runs[-1] + 5
        made.append((2 * k, text_of(30, rng) + " " + " ".join(passage) + " " + text_of(30, rng)))
        made.append((2 * k + 1, text_of(20, rng) + " " + " ".join(copy) + " " + text_of(40, rng)))
        if ends[1] - ends[0] >= 50:  # by brute force: words from the first common seed to the last
            want[2 * k + 1] = 20 + ends[0], 20 + ends[1]
    frame = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    got = {r["id"]: r for r in chaining.passages(frame).collect()}
    assert len(want) > 250
    for doc, (start, end) in want.items():
        assert got[doc]["other"] == doc - 1
        assert got[doc]["passage_start"] <= start and got[doc]["passage_end"] >= end


def first_places(rows):
    """``id, other, pos, at`` of all seeds by plain loops."""
    first, out = {}, set()
    for doc, text in sorted(rows, key=lambda r: r[0]):
        keys, places = chaining.seeds(text)
        for key, pos in zip(keys.tolist(), places.tolist()):
            other, at = first.setdefault(key, (doc, pos))
            if other < doc:
                out.add((doc, other, pos, at))
    return out


def test_runs_equal_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(chaining, "HELD_SEEDS", 700)
    monkeypatch.setattr(chaining, "LEAST_BUCKETS", 5)
    rng = random.Random(12)
    common, texts = text_of(30, rng), []
    for _ in range(120):
        parts = [text_of(rng.randint(0, 25), rng), common if rng.random() < 0.7 else "", "in " * rng.randint(0, 20)]
        texts.append(" ".join([*parts, rng.choice(texts or [""])]))
    ids = [f"d{k:03d}" for k in range(120)]
    rng.shuffle(ids)
    rows = [*zip(ids, texts), *list(zip(ids, texts))[:5]]
    frame = spark.createDataFrame(rows, "id string, text string").repartition(3)
    got = set()
    for r in chaining._seed_runs(frame, "string").collect():
        for of, pos, at, size in zip(r["of"], r["pos"], r["at"], r["size"]):
            got |= {(r["id"], r["others"][of], pos + k, at + k) for k in range(size)}
    assert got == first_places(rows) and len(got) > 2000


def test_one_row_for_a_passage_and_its_partners(spark):
    rng = random.Random(13)
    one, other = text_of(45, rng), text_of(45, rng)
    rows = [(1, f"{one} {text_of(20, rng)}"), (2, f"{other} {text_of(20, rng)}"), (3, f"{one} {other}")]
    rows += [(k, f"{text_of(5, rng)} {one} {other}") for k in range(4, 9)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["id"]: r for r in chaining.whole_passages(frame).collect()}
    assert sorted(got) == [3, 4, 5, 6, 7, 8]
    assert (got[5]["passage_start"], got[5]["passage_end"]) == (5, 95)
    assert {p["other"] for p in got[5]["partners"]} >= {1, 2}
    assert chaining.passages(frame).where("id = 5").count() == len(got[5]["partners"])


def test_partners_beyond_the_first_are_found_on_request(spark):
    rng = random.Random(14)
    passage = text_of(60, rng).split()
    rows = []
    for k in range(56):  # each seed is first met in a document of its own
        rows.append((k, f"{text_of(20, rng)} {' '.join(passage[k : k + 5])} {text_of(20, rng)}"))
    rows += [(k, f"{text_of(10, rng)} {' '.join(passage)} {text_of(10, rng)}") for k in (1000, 1001)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    assert chaining.passages(frame).isEmpty()
    (row,) = chaining.passages(frame, further=True).collect()
    assert (row["id"], row["other"], row["passage_start"], row["passage_end"]) == (1001, 1000, 10, 70)
    cut = {r["doc_id"]: r["text"] for r in chaining.without_passages(frame, further=True).collect()}
    assert cut[1000] == rows[-2][1] and len(cut[1001].split()) == 20


def test_thinned_seeds_cover_the_same_words():
    rng = random.Random(4)
    for _ in range(200):
        spots = sorted({(p, p + rng.choice([0, 0, 0, 0, 7])) for p in rng.sample(range(60), 40)})
        kept = chaining.thinned(spots)
        assert set(kept) <= set(spots) and kept == sorted(set(kept))

        def covered(places):
            return {(p + i, q + i) for p, q in places for i in range(chaining.WORDS)}

        assert covered(kept) == covered(spots)


def test_quality_learns_from_every_label(spark):
    rng = random.Random(11)
    texts = [text_of(60, rng) for _ in range(40)]
    odd = " ".join("#" * 30 + str(k) for k in range(60))
    docs = spark.range(7000).selectExpr("id AS doc_id").join(
        spark.createDataFrame(list(enumerate(texts)), "k int, text string"), F.expr("doc_id % 40 = k")
    )
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([(9999, odd)], "doc_id long, text string"))
    # The one rejected row is the last in the order that a bounded sample was taken in.
    labels = docs.select("doc_id", (F.col("doc_id") != 9999).cast("int").alias("quality"))
    last = labels.orderBy(F.xxhash64("doc_id").desc()).first()["doc_id"]
    swap = F.when(F.col("doc_id") == 9999, last).when(F.col("doc_id") == last, 9999).otherwise(F.col("doc_id"))
    docs, labels = docs.withColumn("doc_id", swap), labels.withColumn("doc_id", swap)
    forest = quality.fit(docs, labels)
    assert forest is not None
    assert [r["id"] for r in quality.judge(docs, forest).where("NOT kept").collect()] == [last]


def test_threshold_equals_sorting_all_scores(spark, monkeypatch):
    monkeypatch.setattr(quality, "ORDERED", 50)
    rng = np.random.default_rng(5)
    for lost in (0.0, 0.002, 0.1, 1.0):
        good = rng.random(900) < 0.8
        scores = np.round(rng.normal(np.where(good, 0.4, 0.55), 0.08), 3)
        want = quality.grow(scores[:, None], scores[:1], scores[:1], trees=1)
        quality.calibrate(want, scores, good, lost)
        rows = [(float(s), int(g)) for s, g in zip(scores, good)]
        got = quality.threshold(spark.createDataFrame(rows, "score double, good int"), lost)
        assert (2.0 if got is None else got) == want.threshold


def test_joined_spans_equal_plain_union():
    rng = random.Random(15)
    for _ in range(200):
        spans = [(a, a + rng.randint(1, 12)) for a in (rng.randint(0, 150) for _ in range(rng.randint(0, 20)))]
        starts, ends = (np.array([s[k] for s in spans], np.int64) for k in (0, 1))
        assert suffixes.joined_spans(starts, ends) == chaining.united(spans, 0)
