"""Language identification by a mixture of languages per document.

Counting: letters with their two neighbours (trigrams, case folded, everything but letters a blank)
are counted per language over all training rows into a fixed number of hash buckets.

Inference: each word of a text has a likelihood under each language, the product of its trigrams'
probabilities. Expectation-maximisation estimates in what proportions the languages make up the
text. Languages are added in the order of their proportions; a set of them is kept if its
log-likelihood, less half the log of the number of words for each language, is the largest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import id_type, map_rows, small_batches

BUCKETS = 1 << 16
UNKNOWN = "und"
FULL_TURNS, SET_TURNS = 12, 6
#: Sizes of language sets that are tried in any case; larger ones while they still gain.
FIRST_SIZES = 4
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter; made once per worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each letter's trigram, the starts of words among them, and the word counts of texts."""
    joined = "\n".join(texts).lower() if len(texts) > 1 else texts[0].lower()
    codes = np.frombuffer(f" {joined} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[codes]
    folded = np.where(is_letter, codes, np.uint32(32))
    # Lower-casing may change a text's length, so the ends of texts are found among line marks.
    mixed = folded[:-2] * np.uint32(0x9E3779B1)
    mixed += folded[1:-1] * np.uint32(0x85EBCA77)
    mixed += folded[2:] * np.uint32(0xC2B2AE3D)
    buckets = (mixed >> np.uint32(16)).astype(np.int64)
    middle = is_letter[1:-1]
    first = middle & ~is_letter[:-2]  # the first letter of a word
    place = np.cumsum(middle) - 1  # of each letter among the letters
    starts = place[first]
    return buckets[middle], starts, np.flatnonzero(first)


def words_per_text(texts: list[str], first: np.ndarray) -> np.ndarray:
    """How many of the word starts lie in each text."""
    ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    upto = np.searchsorted(first, ends, side="left")
    return np.diff(np.concatenate([[0], upto]))


def count(
    df: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``lang, bucket, n`` over all rows with a text and a language."""
    rows = df.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")
    ).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in small_batches(batches):
            groups: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                groups.setdefault(lang, []).append(text)
            for lang, texts in groups.items():
                found = np.bincount(trigrams(texts)[0], minlength=BUCKETS)
                totals[lang] = totals[lang] + found if lang in totals else found
        for lang, total in totals.items():
            bucket = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(bucket), pa.string()), pa.array(bucket), pa.array(total[bucket])],
                ["lang", "bucket", "n"],
            )

    made = map_rows(rows, run, "lang string, bucket long, n long")
    return made.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, **columns: str) -> tuple[list[str], np.ndarray]:
    """Language names in order, and log probabilities (buckets x languages) from all rows of ``df``.

    Any number of languages; the model takes 256 KB for each.
    """
    table = count(df, **columns).toArrow()  # at most buckets x languages rows
    langs = sorted(set(table.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(langs)))
    place = {lang: i for i, lang in enumerate(langs)}
    column = np.array([place[x] for x in table.column("lang").to_pylist()], dtype=np.int64)
    counts[table.column("bucket").to_numpy(), column] = table.column("n").to_numpy()
    total = counts.sum(axis=0, keepdims=True)
    return langs, np.log((counts + 0.5) / (total + 0.5 * BUCKETS)).astype(np.float32)


def _expect(likely: np.ndarray, start: np.ndarray, heads: np.ndarray, sizes: np.ndarray, turns: int):
    """Proportions of each text after some turns, and the log-likelihood of its words."""
    share = start
    for _ in range(turns):
        joint = likely * np.repeat(share, sizes, axis=0)
        joint /= joint.sum(axis=1, keepdims=True)
        share = np.add.reduceat(joint, heads, axis=0) / sizes[:, None]
        share = np.maximum(share, 1e-9) * (start > 0)
        share /= share.sum(axis=1, keepdims=True)
    joint = (likely * np.repeat(share, sizes, axis=0)).sum(axis=1)
    return share, np.add.reduceat(np.log(joint), heads)


def mixtures(texts: list[str], model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions per text (texts x languages), zero outside its language set; rows with no word NaN.

    Languages join a set in the order of their first proportions; sets grow until no text's penalised
    likelihood rises any more. The second array says how many words there are.
    """
    count_langs = model.shape[1]
    shares = np.full((len(texts), count_langs), np.nan)
    if not texts or not count_langs:
        return shares, np.zeros(len(texts), dtype=np.int64)
    buckets, starts, first = trigrams(texts)
    sizes = words_per_text(texts, first)
    if not len(starts):
        return shares, sizes
    held = np.flatnonzero(sizes)
    counts = sizes[held]
    heads = np.concatenate([[0], np.cumsum(counts)[:-1]])
    likely = np.add.reduceat(model[buckets], starts, axis=0).astype(np.float64)
    likely = np.exp(np.maximum(likely - likely.max(axis=1, keepdims=True), -60.0))
    even = np.full((len(held), count_langs), 1.0 / count_langs)
    share, _ = _expect(likely, even, heads, counts, FULL_TURNS)
    ranked = np.argsort(-share, axis=1, kind="stable")
    best_value = np.full(len(held), -np.inf)
    best_share = np.zeros_like(share)
    penalty = 0.5 * np.log(np.maximum(counts, 2))
    # A second language must explain more than one stray word.
    for size in range(1, count_langs + 1):
        allowed = np.zeros_like(share)
        np.put_along_axis(allowed, ranked[:, :size], 1.0, axis=1)
        start = share * allowed + 1e-12 * allowed
        start /= start.sum(axis=1, keepdims=True)
        turns = SET_TURNS if 1 < size < count_langs else 0
        tried, value = _expect(likely, start, heads, counts, turns)
        value = value - (size - 1) * (penalty + 2.0)
        better = value > best_value
        best_value = np.where(better, value, best_value)
        best_share[better] = tried[better]
        if size >= FIRST_SIZES and not better.any():
            break
    shares[held] = best_share
    return shares, sizes


def predict(
    df: DataFrame,
    model: tuple[list[str], np.ndarray],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, lang_pred, score, languages`` per row.

    ``lang_pred`` is the language with the largest proportion (the first by name among equals),
    ``score`` that proportion, ``languages`` the selected set with its proportions. A NULL text, a
    text without letters, or a model without languages gives ``und`` with score 0 and an empty
    set. Rows are independent; repeated rows are kept. No shuffle.
    """
    kind = id_type(df, id_col)
    shared = df.sparkSession.sparkContext.broadcast(model)
    part = pa.struct([("lang", pa.string()), ("share", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = shared.value
        for batch in small_batches(batches, most=2 << 20):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            shares, sizes = mixtures(texts, table)
            names, scores, sets = [], [], []
            for share, size in zip(shares, sizes):
                if not size or not langs:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    sets.append([])
                    continue
                top = int(np.argmax(share))
                names.append(langs[top])
                scores.append(min(1.0, float(share[top])))
                sets.append(
                    [{"lang": langs[k], "share": float(share[k])} for k in np.flatnonzero(share)]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names), pa.array(scores), pa.array(sets, pa.list_(part))],
                ["id", "lang_pred", "score", "languages"],
            )

    schema = (
        f"id {kind}, lang_pred string, score double, "
        "languages array<struct<lang:string,share:double>>"
    )
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, run, schema)
