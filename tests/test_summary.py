import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leafmill.functions import chunking, embedding, summary
from leafmill.operators import chunks, summaries, vectors

WORDS = ["the", "The", "cat", "dog", "é", "a1", "x-y", "run", "sun"]


def _texts(count, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        parts = [rng.choice([*WORDS, ".", "!", "?", "\n", "\t"]) for _ in range(rng.randint(0, 60))]
        out.append(" ".join(parts))
    return out


def _summary(text, k):
    found = [s.strip() for s in re.split(r"[.!?\n]+", text or "")]
    found = [s for s in found if s]
    words = [[w for w in re.split(r"[\t-\r ]+", s.lower()) if w] for s in found]
    counts = Counter(w for own in words for w in own)
    order = sorted(range(len(found)), key=lambda i: (-sum(counts[w] for w in set(words[i])), i))
    return " \n".join(found[i] for i in sorted(order[:k]))


@pytest.mark.parametrize("k", [1, 3])
def test_extractive_summary(spark, k):
    texts = [None, "", " . ", *_texts(200, k)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(summary.extractive_summary(F.col("t"), k)).collect()]
    assert got == [_summary(t, k) for t in texts]


def test_many_words_share_slots(spark):
    text = ". ".join(" ".join(f"w{(n * 7 + j) % 3000}" for j in range(20)) for n in range(400))
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(summary.extractive_summary(F.col("t"), 5)).first()[0] == _summary(text, 5)


def _counts(text):
    counts = [0] * embedding.BUCKETS
    for word in re.split(r"[\t-\r ]+", text.lower()):
        if word:
            counts[int(hashlib.md5(word.encode()).hexdigest()[:2], 16)] += 1
    return counts


def test_embedding(spark):
    texts = ["", "one", *_texts(50, 5)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select(
        embedding.bucket_counts(F.col("t")), embedding.hashed_embedding(F.col("t"))
    ).collect()
    for text, (counts, vector) in zip(texts, rows):
        assert counts == _counts(text)
        norm = math.sqrt(sum(n * n for n in counts))
        assert vector == pytest.approx([n / norm if norm else 0.0 for n in counts], abs=1e-6)


@pytest.fixture(scope="module")
def docs(spark):
    texts = [None, "", *_texts(30, 8)]
    return spark.createDataFrame(list(enumerate(texts)), "doc int, t string").cache()


def _by_doc(frame):
    return {r["doc"]: r["summary"] for r in frame.collect()}


def test_map_join(spark, docs):
    listed = docs.select("doc", chunking.chunk_separator(F.col("t"), "\n", 40, 10).alias("c"))
    expected = {r["doc"]: " \n".join(_summary(x, 1) for x in r["c"] or []) for r in listed.collect()}
    got = _by_doc(
        summaries.summary_map_join(docs, ["doc"], "t", sep="\n", size=40, overlap=10)
    )
    assert got == expected
    assert got[0] == "" and got[1] == ""


def test_map_reduce(spark, docs):
    listed = docs.select("doc", chunking.chunk_recursive(F.col("t"), 40, 10).alias("c"))
    expected = {
        r["doc"]: _summary(" \n".join(_summary(x, 1) for x in r["c"] or []), 3)
        for r in listed.collect()
    }
    got = _by_doc(summaries.summary_map_reduce(docs, ["doc"], "t", size=40, overlap=10))
    assert got == expected


def test_wrap_join_reads_null_as_none(spark, docs):
    listed = docs.select("doc", chunking.chunk_wrap(F.col("t"), 30).alias("c"))
    expected = {r["doc"]: "\n ".join(_summary(x, 1) for x in r["c"] or []) for r in listed.collect()}
    expected[0] = "None"
    assert _by_doc(summaries.summary_wrap_join(docs, ["doc"], "t", width=30)) == expected


def _chunks():
    return chunking.chunk_separator(F.col("t"), "\n", 40, 0)


def test_model_summary_equals_native_shape(spark, docs):
    def _first_word():
        return lambda items: [item.split()[0].upper() for item in items]

    got = summaries.summarize_with_model(docs, "doc", _chunks(), _first_word, partitions=3)
    rows = {r["doc"]: r for r in got.collect()}
    listed = docs.select("doc", _chunks().alias("c")).collect()
    assert {d: r["summary"] for d, r in rows.items()} == {
        r["doc"]: " \n".join(x.split()[0].upper() for x in r["c"] or []) for r in listed
    }
    assert all(r["error"] is None for r in rows.values())


def test_failing_chunk_keeps_the_others(spark):
    def _fails_on_cat():
        def call(items):
            if any("cat" in item for item in items):
                raise RuntimeError("no cats")
            return [item.upper() for item in items]

        return call

    frame = spark.createDataFrame([(1, "dog\ncat\nsun"), (2, "run"), (3, None)], "doc int, t string")
    pieces = chunking.chunk_separator(F.col("t"), "\n", 3, 0)
    got = summaries.summarize_with_model(frame, "doc", pieces, _fails_on_cat, tries=2, pause=0.0)
    rows = {r["doc"]: (r["summary"], r["error"]) for r in got.collect()}
    assert rows[1] == ("DOG \n \nSUN", "RuntimeError: no cats")
    assert rows[2] == ("RUN", None)
    assert rows[3] == ("", None)


def test_vector_records(spark):
    frame = spark.createDataFrame([(1, "a b\nc", "en"), (2, "c", "fr")], "doc int, t string, lang string")
    pieces = chunking.chunk_separator(F.col("t"), "\n", 3, 0)
    rows = vectors.vector_records(frame, "doc", "t", ["lang"], pieces).orderBy("doc", "pos").collect()
    assert [(r["doc"], r["pos"]) for r in rows] == [(1, 0), (1, 1), (2, 0)]
    assert rows[1]["id"] == rows[2]["id"] == hashlib.sha256(b"c").hexdigest()
    assert rows[0]["metadata"] == {"lang": "en"} and len(rows[0]["values"]) == embedding.BUCKETS

    def factory():
        return lambda items: [[float(len(x)), 1.0] for x in items]

    modelled = vectors.vector_records(frame, "doc", "t", ["lang"], pieces, factory)
    got = {(r["doc"], r["pos"]): (r["values"], r["error"]) for r in modelled.collect()}
    assert got == {(1, 0): ([3.0, 1.0], None), (1, 1): ([1.0, 1.0], None), (2, 0): ([1.0, 1.0], None)}


def test_chunks_join_back_in_order(spark):
    frame = spark.createDataFrame([(1, "a\nb\nc"), (2, "d")], "doc int, t string")
    rows = chunks.chunk_rows(frame, ["doc"], chunking.chunk_separator(F.col("t"), "\n", 1, 0))
    assert _by_doc(chunks.join_chunks(rows, ["doc"], "chunk", "|")) == {1: "a|b|c", 2: "d"}


def test_map_reduce_with_model(spark):
    """Against a plain loop: chunks, joined outputs, rounds while too long, one reduce."""

    def short():
        return lambda items: [" ".join(x.split()[::2]) for x in items]

    def last():
        return lambda items: [x.upper()[:200] for x in items]

    texts = [(1, " ".join(f"w{n}" for n in range(300))), (None, "a b c d"), (3, None), (4, "")]
    frame = spark.createDataFrame(texts, "doc int, t string")
    pieces = chunking.chunk_separator(F.col("t"), " ", 60, 0)
    got = summaries.map_reduce_with_model(frame, "doc", pieces, short, last, longest=300)
    assert _plan(got).count("MapInArrow") == 1 and "Exchange" not in _plan(got)
    rows = {r["doc"]: (r["summary"], r["error"]) for r in got.collect()}
    assert set(rows) == {1, None, 3, 4}
    assert rows[None] == ("A C", None) and rows[3] == ("", None) and rows[4] == ("", None)
    listed = frame.select("doc", pieces.alias("c")).where("doc = 1").first()["c"]
    joined = " \n".join(" ".join(x.split()[::2]) for x in listed)
    rounds = 0
    while len(joined) > 300:
        one = spark.createDataFrame([(joined,)], "t string")
        cut = one.select(chunking.chunk_recursive(F.col("t"), size=300, overlap=0)).first()[0]
        joined, rounds = " \n".join(x.upper()[:200] for x in cut), rounds + 1
    assert rounds > 1
    assert rows[1] == (joined.upper()[:200], None)


def test_rounds_end_where_texts_do_not_get_shorter(spark):
    def same():
        return lambda items: items

    def once():
        return lambda items: [x[:50] if len(x) < 100 else x for x in items]

    frame = spark.createDataFrame([(1, "ab " * 300), (2, "ab"), (3, "xy " * 90)], "doc int, t string")
    got = summaries.map_reduce_with_model(frame, "doc", F.array("t"), same, once, longest=100)
    rows = {r["doc"]: (r["summary"], r["error"]) for r in got.collect()}
    assert rows[2] == ("ab", None)
    assert rows[1][1] is None or rows[1][1] == "too long, and not shortened"
    stays = summaries.map_reduce_with_model(frame, "doc", F.array("t"), same, same, longest=100)
    rows = {r["doc"]: (r["summary"], r["error"]) for r in stays.collect()}
    assert rows[1][1] == rows[3][1] == "too long, and not shortened" and rows[2] == ("ab", None)
    assert rows[1][0].split() == ["ab"] * 300
    none = summaries.map_reduce_with_model(frame.limit(0), "doc", F.array("t"), same)
    assert none.count() == 0


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_null_key_keeps_its_summary(spark):
    def upper():
        return lambda items: [x.upper() for x in items]

    frame = spark.createDataFrame([(None, "dog"), (1, "cat")], "doc int, t string")
    got = summaries.summarize_with_model(frame, "doc", F.array("t"), upper)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert {r["doc"]: r["summary"] for r in got.collect()} == {None: "DOG", 1: "CAT"}
    assert plan.count("MapInArrow") == 1
