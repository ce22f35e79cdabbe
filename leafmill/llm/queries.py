"""Queries of the training-data operators over the given tables, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import (
    bpe,
    chaining,
    fingerprints,
    jaccard,
    langid,
    licenses,
    negatives,
    packing,
    quality,
    secrets,
    spelling,
    suffixes,
    toxicity,
)

VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _remainder(divisor: int):
    """crc32 of the id as text, modulo the divisor: the contracts' folds."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op1_toxicity(spark, sf):
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    machine = toxicity.fit(docs, labels.where(_remainder(4) != 2))
    scored = toxicity.score(docs, machine).withColumnRenamed("id", "doc_id")
    return scored.select(
        "doc_id",
        (_remainder(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "word",
        "sentence",
    )


def op2_fingerprints(spark, sf):
    compared = fingerprints.neighbours(_table(spark, sf, "documents"))
    return compared.withColumnRenamed("id", "doc_id")


def op3_packing(spark, sf):
    packed = packing.pack_documents(
        _table(spark, sf, "documents"), public_tokenizers.path(VOCABULARY), size=1024
    )
    return packed.withColumnRenamed("id", "doc_id")


def op4_language(spark, sf):
    docs = _table(spark, sf, "documents")
    known = docs.where((_remainder(5) != 0) & F.col("lang").isNotNull())
    found = langid.predict(docs, langid.fit(known)).withColumnRenamed("id", "doc_id")
    held_out = (_remainder(5) == 0).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "languages")


def op5_jaccard(spark, sf):
    joined = jaccard.join_components(_table(spark, sf, "documents"))
    return joined.withColumnRenamed("id", "doc_id")


def op6_bpe(spark, sf):
    done = bpe.round_trip(_table(spark, sf, "documents"), public_tokenizers.path(VOCABULARY))
    return done.withColumnRenamed("id", "doc_id")


def op7_substrings(spark, sf):
    found = chaining.whole_passages(_table(spark, sf, "documents"), further=True)
    return found.withColumnRenamed("id", "doc_id")


def op8_suffixes(spark, sf):
    done = suffixes.deduplicate(_table(spark, sf, "documents")).drop("kept")
    return done.withColumnRenamed("id", "doc_id")


def op9_quality(spark, sf):
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    judged = quality.judge(docs, quality.fit(docs, labels))
    return judged.withColumnRenamed("id", "doc_id")


def _span_list(name: str):
    """Spans as ``kind:start:end``, joined by commas."""
    shown = F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.concat_ws(",", shown)


def op10_secrets(spark, sf):
    docs = _table(spark, sf, "documents")
    found = secrets.find(docs, secrets.fit(docs)).withColumnRenamed("id", "doc_id")
    kinds = F.col("base.kind")
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in ("assign", "access", "hex")
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_span_list("base"), 256).alias("base_sha256"),
        _span_list("spans").alias("spans"),
    )


def op11_licenses(spark, sf):
    found = licenses.find(_table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")
    own, every = F.col("base.label"), F.concat("base.label", "spans.label")

    def listed(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    likeness = F.coalesce(F.array_max("spans.likeness"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        listed(own).alias("base_labels"),
        listed(every).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(likeness).alias("score"),
    )


def op12_spelling(spark, sf):
    return spelling.variants(_table(spark, sf, "documents"))


def op13_negatives(spark, sf):
    rows = _table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("id") % 100 == 0)


_ALL = [
    op1_toxicity,
    op2_fingerprints,
    op3_packing,
    op4_language,
    op5_jaccard,
    op6_bpe,
    op7_substrings,
    op8_suffixes,
    op9_quality,
    op10_secrets,
    op11_licenses,
    op12_spelling,
    op13_negatives,
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in _ALL}

# crc32 over the bytes of a text, as unsigned number; letters beyond ASCII are two bytes.
_CRC_TABLE = """(SELECT list(x ORDER BY i) FROM (SELECT i, list_reduce(list_prepend(i::BIGINT,
    range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END) AS x
    FROM range(256) t(i)) q)"""
_BYTES = """flatten(list_transform(string_split({x}, ''), lambda c: CASE WHEN unicode(c) < 128
    THEN [unicode(c)::BIGINT] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64]::BIGINT[] END))"""
_CRC = f"""xor(4294967295, list_reduce(list_prepend(4294967295, {_BYTES}),
    lambda a, b: xor(a // 256, crc[(xor(a, b) % 256) + 1])))"""
_LOW = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SPELLING = f"""WITH RECURSIVE
    found AS (SELECT doc_id, {_LOW.format(x="unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))")} AS run
        FROM documents),
    runs AS (SELECT doc_id, run, count(*) AS k FROM found WHERE length(run) >= 7 GROUP BY ALL),
    hashed AS (SELECT run, k, {_CRC.format(x="doc_id || ':' || run")} AS h
        FROM runs, (SELECT {_CRC_TABLE} AS crc) t),
    altered AS (SELECT k, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT)
        || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
    words AS (SELECT word, sum(k)::BIGINT AS n FROM altered WHERE length(word) >= 7
        GROUP BY word HAVING sum(k) >= 2),
    places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
    less AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM places),
    pairs AS (
        SELECT a.word, b.word AS other, b.n FROM less a JOIN less b
            ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
        UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
    near AS (SELECT word, count(*) AS n_near, max(n) AS best FROM pairs GROUP BY word),
    forms AS (SELECT w.word, w.n, coalesce(a.n_near, 0) AS n_near, min(p.other) AS form, a.best
        FROM words w LEFT JOIN near a ON w.word = a.word
        LEFT JOIN pairs p ON p.word = w.word AND p.n = a.best AND a.best >= 10 * w.n GROUP BY ALL),
    ways(word, root) AS (SELECT word, word FROM forms WHERE form IS NULL
        UNION ALL SELECT f.word, w.root FROM ways w JOIN forms f ON f.form = w.word)
    SELECT f.word, form, root, n, n_near, CASE WHEN form IS NOT NULL THEN best END AS form_n
    FROM forms f JOIN ways w ON f.word = w.word"""

_NEGATIVES = """WITH
    rows AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND
            len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    scores AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
        list_dot_product(a.v, b.v)::BIGINT AS score
        FROM rows a JOIN rows b ON a.id <> b.id WHERE a.id % 100 = 0),
    positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id
            ORDER BY score DESC, id))::INT AS rank, id AS negative_id, positive_score,
        score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10"""

_JACCARD = f"""WITH RECURSIVE
    texts AS (SELECT doc_id, regexp_extract_all({_LOW.format(x="coalesce(text, '')")},
        '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3),
            lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM texts),
    sized AS (SELECT doc_id, len(s)::BIGINT AS n, s FROM sets),
    flat AS (SELECT doc_id, n, hash(x) AS x FROM (SELECT doc_id, n, unnest(s) AS x FROM sized) q),
    links AS (SELECT a.doc_id AS a, b.doc_id AS b
        FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
        HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
    reached(doc_id, other) AS (SELECT doc_id, doc_id FROM sized
        UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
    SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id
    FROM sized s JOIN reached r ON s.doc_id = r.doc_id GROUP BY s.doc_id, s.n"""

_SUFFIXES = """WITH
    bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    sized AS (SELECT doc_id, h, length(h) // 2 AS n FROM bytes),
    strings AS (SELECT doc_id, i, hash(substr(h, 2 * i - 1, 100)) AS x
        FROM (SELECT doc_id, h, unnest(range(1, n - 48)) AS i FROM sized) q),
    firsts AS (SELECT x, min(doc_id) AS first FROM strings GROUP BY x HAVING count(*) > 1),
    hits AS (SELECT s.doc_id, s.i FROM strings s JOIN firsts f ON s.x = f.x WHERE f.first < s.doc_id),
    marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER by_doc + 50, true)::INT AS fresh FROM hits
        WINDOW by_doc AS (PARTITION BY doc_id ORDER BY i)),
    numbered AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
    spans AS (SELECT doc_id, min(i) AS s, max(i) + 49 AS e FROM numbered GROUP BY doc_id, run),
    listed AS (SELECT doc_id, sum(e - s + 1)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans,
        list(s ORDER BY s) AS ss, list(e ORDER BY s) AS es FROM spans GROUP BY doc_id)
    SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
        coalesce(n_spans, 0) AS n_spans, sha256(unhex(CASE WHEN ss IS NULL THEN h ELSE
            array_to_string(list_transform(range(1, len(ss) + 2), lambda k:
                substr(h, (2 * coalesce(es[k - 1], 0) + 1)::BIGINT,
                    (2 * (coalesce(ss[k], n + 1) - coalesce(es[k - 1], 0) - 1))::BIGINT)), '')
            END)) AS kept_sha256
    FROM sized d LEFT JOIN listed l ON d.doc_id = l.doc_id"""

ORACLE_SQL: dict[str, str] = {
    "op5_jaccard": _JACCARD,
    "op8_suffixes": _SUFFIXES,
    "op12_spelling": _SPELLING,
    "op13_negatives": _NEGATIVES,
}
