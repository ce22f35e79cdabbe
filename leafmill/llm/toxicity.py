"""Toxicity: a support vector machine with a gap-weighted subsequence kernel.

The kernel of two words sums, over the four-character subsequences they share, a decay to the power
of the stretch that each occurrence covers (a stretch of at most ``SPAN`` characters); the ends of a
word count as characters, and the length of a word is normalised away. An insult with characters put
in or left out still shares most of its subsequences. Letters set apart by blanks are read as one
word, and marks inside a word are left out.

The Nyström method maps a word to its kernels with a fixed number of landmarks, whitened by the
landmarks' own kernel matrix, and a linear machine is trained in that space. As subsequences can
be listed, the sum over landmarks folds into one table with a weight for each subsequence.

Training takes sentences of a bounded sample of labelled documents. A sentence has the value of its
strongest word and a document that of its strongest sentence, so the machine is given strongest
words: at first those that toxic documents use far more often than clean ones; in each further
round the strongest word of each toxic document (a toxic sentence) and of each clean one (the
hardest clean sentence). The document's value is turned into a probability on the same sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.bpe import Recent
from leafmill.llm.common import id_text, id_type, map_rows, small_batches
from leafmill.plans.workdir import written

CLASSES = 40
DECAY = 0.75
LENGTH, SPAN = 4, 7
#: A longer word is judged by stretches of this size, half of each shared with the next.
LONGEST = 24
SPACED = re.compile(r"(?<!\S)\S(?:\s\S(?!\S)){2,}")
SENTENCE = re.compile(r"[^.!?\n]+")
MARKS = re.compile(r"[\W_]+")


def words_of(text: str) -> list[str]:
    """Lower-case words of a text as they stand, and runs of single characters as one word."""
    low = text.lower()
    words = low.split()
    words += ["".join(m[0].split()) for m in SPACED.finditer(low)]
    return words


def clean(word: str) -> str:
    """Letters and digits of a word."""
    return word if word.isalnum() else MARKS.sub("", word)


def stretches(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def codes(words: list[str]) -> np.ndarray:
    """Character classes of words of one length, with the two ends (words x length + 2)."""
    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = np.where((raw >= 97) & (raw <= 122), raw - 97, 26)
    other = 27 + raw * np.uint32(0x9E3779B1) % np.uint32(CLASSES - 29)
    inner = np.where(raw < 128, letter, other).astype(np.int64).reshape(len(words), -1)
    out = np.empty((inner.shape[0], inner.shape[1] + 2), dtype=np.int64)
    out[:, 0], out[:, 1:-1], out[:, -1] = CLASSES - 2, inner, CLASSES - 1
    return out


@lru_cache(maxsize=64)
def positions(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Position tuples of the subsequences of a word with ``size`` classes, and their weights.

    The weights are divided by their length, so that a word without repetition has norm 1.
    """
    found = np.array(
        [
            (first, *rest)
            for first in range(size - LENGTH + 1)
            for rest in combinations(range(first + 1, min(size, first + SPAN)), LENGTH - 1)
        ]
    )
    weight = DECAY ** (found[:, -1] - found[:, 0] + 1.0)
    return found, weight / np.sqrt((weight**2).sum())


def subsequences(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table places (words x occurrences) of all subsequences, and their weights."""
    found, weight = positions(word.shape[1])
    place = word[:, found[:, 0]]
    for k in range(1, LENGTH):
        place = place * CLASSES + word[:, found[:, k]]
    return place, weight


def by_length(words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Places of the words of each length, and their classes; too short a word has none."""
    groups: dict[int, list[int]] = {}
    for place, word in enumerate(words):
        groups.setdefault(len(word), []).append(place)
    for size, places in groups.items():
        if size + 2 >= LENGTH:
            for at in range(0, len(places), 500):
                part = places[at : at + 500]
                yield part, codes([words[p] for p in part])


def landmark_kernels(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernels (words x landmarks)."""
    listed = [subsequences(codes([m])) for m in landmarks]
    used, row = np.unique(np.concatenate([p[0] for p, _ in listed]), return_inverse=True)
    matrix = np.zeros((len(used) + 1, len(landmarks)), dtype=np.float32)
    at = 0
    for column, (place, weight) in enumerate(listed):
        np.add.at(matrix[:, column], row[at : at + place.size], weight)
        at += place.size
    lookup = np.full(CLASSES**LENGTH, len(used), dtype=np.int32)
    lookup[used] = np.arange(len(used))
    out = np.zeros((len(words), len(landmarks)))
    for places, word in by_length(words):
        place, weight = subsequences(word)
        rows = lookup[place]
        owner, occurrence = np.nonzero(rows < len(used))
        shared = matrix[rows[owner, occurrence]] * weight[occurrence, None]
        part = np.zeros((len(places), len(landmarks)))
        np.add.at(part, owner, shared)
        out[places] = part
    return out


@dataclass
class Machine:
    """A weight per subsequence, and what turns a word's value into a probability."""

    table: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def values(self, words: list[str]) -> np.ndarray:
        """Distance of each cleaned word from the border, positive on the toxic side."""
        out = np.full(len(words), self.bias)
        for places, word in by_length(words):
            place, weight = subsequences(word)
            out[places] += self.table[place] @ weight
        return out

    def probability(self, value: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * value + self.shift, -60, 60)))


class Judge:
    """Values of texts under one machine, with the worker's table of words met before."""

    def __init__(self, machine: Machine) -> None:
        self.machine, self.known = machine, Recent()

    def learn(self, words: set[str]) -> None:
        fresh = [w for w in words if self.known.recall(w) is None]
        cleaned = [stretches(clean(w)) for w in fresh]
        values = self.machine.values([s for parts in cleaned for s in parts])
        at = 0
        for word, parts in zip(fresh, cleaned):
            self.known.keep(word, float(values[at : at + len(parts)].max()))
            at += len(parts)

    def strongest(self, texts: list[str]) -> list[tuple[float, str]]:
        """Value of the strongest word of each text, and the word."""
        held = [words_of(t) for t in texts]
        known = self.known.new
        fresh = {w for words in held for w in words if w not in known}
        if len(fresh) > self.known.entries // 2:  # more than the table surely holds
            if len(texts) == 1:
                return [self._in_parts(held[0])]
            half = len(texts) // 2
            return self.strongest(texts[:half]) + self.strongest(texts[half:])
        if fresh:
            self.learn(fresh)
        old, out = self.known.old, []
        for words in held:
            values = [known[w] if w in known else old[w] for w in words]
            best = max(values, default=self.machine.bias)
            out.append((best, words[values.index(best)] if values else ""))
        return out

    def _in_parts(self, words: list[str]) -> tuple[float, str]:
        best = (self.machine.bias, "")
        for at in range(0, len(words), 10_000):
            part = words[at : at + 10_000]
            cleaned = [stretches(clean(w)) for w in part]
            values = self.machine.values([s for parts in cleaned for s in parts])
            owner = [w for w, parts in zip(part, cleaned) for _ in parts]
            top = int(np.argmax(values))
            best = max(best, (float(values[top]), owner[top]), key=lambda b: b[0])
        return best


def table_of(words: list[tuple[str, float]]) -> np.ndarray:
    """Weighted mean of the words' subsequence weights: one number per subsequence."""
    table = np.zeros(CLASSES**LENGTH)
    cost = np.array([c for _, c in words]) / max(sum(c for _, c in words), 1e-12)
    for places, word in by_length([w for w, _ in words]):
        place, weight = subsequences(word)
        table += np.bincount(
            place.ravel(), (cost[places][:, None] * weight).ravel(), minlength=len(table)
        )
    return table


def likeness(words: list[str], table: np.ndarray) -> np.ndarray:
    """Mean kernel of each word with the words of the table."""
    out = np.zeros(len(words))
    for places, word in by_length(words):
        place, weight = subsequences(word)
        out[places] = table[place] @ weight
    return out


def spread(words: list[tuple[str, float]], wanted: int, pool: int = 400) -> list[str]:
    """Landmarks among the ``pool`` weightiest words: each next one is the word whose kernels the
    landmarks so far explain worst, counted by weight (pivoted Cholesky)."""
    words = sorted(words, key=lambda p: (-p[1], p[0]))[:pool]
    near = landmark_kernels([w for w, _ in words], [w for w, _ in words])
    cost = np.sqrt([c for _, c in words])
    rest, basis, chosen = np.diag(near).copy(), np.zeros((len(words), 0)), []
    while len(chosen) < min(wanted, len(words)):
        pivot = int(np.argmax(rest * cost))
        if rest[pivot] < 0.05:
            break
        column = (near[:, pivot] - basis @ basis[pivot]) / np.sqrt(rest[pivot])
        basis = np.column_stack([basis, column])
        rest = np.maximum(rest - column**2, 0.0)
        rest[pivot] = 0.0
        chosen.append(pivot)
    return [words[i][0] for i in chosen]


def gapped(words: list[tuple[str, float]], most: int = 600) -> list[tuple[str, float]]:
    """The weightiest words with a letter put in, at a place that the word's own letters choose."""
    out = []
    for word, cost in sorted(words, key=lambda p: (-p[1], p[0]))[:most]:
        for turn in range(2):
            at = 1 + (len(word) + 7 * turn) % max(len(word) - 1, 1)
            letter = chr(97 + (sum(map(ord, word)) + 11 * turn) % 26)
            out.append((word[:at] + letter + word[at:], 0.25 * cost))
    return out


def train(
    toxic: list[tuple[str, float]], plain: list[tuple[str, float]], landmarks: int = 192
) -> Machine:
    """A machine from the strongest words of toxic and of clean sentences, with weights.

    Half of the landmarks come from either side.
    """
    marks = spread(toxic, landmarks // 2) + spread(plain, landmarks // 2)
    toxic = toxic + gapped(toxic)
    words = [w for w, _ in toxic], [w for w, _ in plain]
    power, axes = np.linalg.eigh(landmark_kernels(marks, marks))
    keep = power > 1e-6 * power[-1]
    whiten = axes[:, keep] / np.sqrt(power[keep])
    x = landmark_kernels([*words[0], *words[1]], marks) @ whiten
    y = np.repeat([1.0, -1.0], [len(toxic), len(plain)])
    cost = [np.array([c for _, c in side]) for side in (toxic, plain)]
    cost = np.concatenate([c / c.sum() for c in cost])
    normal, bias = _machine(x, y, cost * 4000.0)
    table = np.zeros(CLASSES**LENGTH, dtype=np.float32)
    for mark, share in zip(marks, whiten @ normal):
        place, weight = subsequences(codes([mark]))
        np.add.at(table, place[0], weight * share)
    return Machine(table, float(bias))


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    rows = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(rows.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(rows.shape[1])
    for _ in range(30):
        inside = y * (rows @ w) < 1
        held = rows[inside] * cost[inside, None]
        fresh = np.linalg.solve(ridge + held.T @ rows[inside], held.T @ y[inside])
        if np.allclose(fresh, w, atol=1e-6):
            break
        w = fresh
    return w[:-1], w[-1]


def _sample(labels: DataFrame, id_col: str, label_col: str, sample: int) -> DataFrame:
    """At most ``sample`` labelled ids of either kind: those with the smallest hash."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .dropna()
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    parts = [
        known.where(F.col("label") == kind).orderBy(F.xxhash64("id"), "id").limit(sample)
        for kind in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 2500,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rounds: int = 2,
) -> Machine | None:
    """A machine from at most ``sample`` labelled documents of either kind.

    Rows with a NULL id, label or text are not used. None if one kind of label is missing or no
    word sets toxic documents apart.
    """
    chosen = F.broadcast(_sample(labels, id_col, label_col, sample))
    rows = id_text(docs, id_col, text_col).dropna().join(chosen, "id")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                # The strongest word of a sentence is sought among all of them, so each counts once.
                found = {clean(w) for w in words_of(text)}
                found = [w for w in found if 2 <= len(w) <= LONGEST]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([label] * len(found), pa.int32())],
                    ["word", "label"],
                )

    sizes = dict(rows.groupBy("label").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        return None
    used = written(
        docs.sparkSession,
        map_rows(rows, words, "word string, label int")
        .groupBy("word")
        .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("all"))
        .withColumn("plain", F.col("all") - F.col("toxic")),
        "toxicity",
    )
    odds = ((F.col("toxic") + 0.5) / (sizes[1] + 1)) / ((F.col("plain") + 0.5) / (sizes[0] + 1))
    only = (  # words that no clean document uses
        used.where((odds >= 2) & (F.col("plain") == 0))
        .orderBy(F.desc("toxic"), F.xxhash64("word"), "word")
        .limit(4000)
        .collect()
    )
    plain = (
        used.where((odds < 3) & (F.col("plain") > 0))
        .orderBy(F.xxhash64("word"), "word")
        .limit(8000)
        .collect()
    )
    if not only or not plain:
        return None
    weak = {r["word"]: 1.0 for r in plain}
    telling = _telling([(r["word"], float(r["toxic"])) for r in only], list(weak.items()))
    strong = dict(telling)
    machine = train(telling, list(weak.items()))
    chosen_rows = rows.drop("label")
    for turn in range(rounds + 1):
        held = (
            score(chosen_rows, machine, "id", "text", all_words=True)
            .select("id", "value", "word")
            .join(chosen, "id")
            .orderBy("id")
            .toArrow()
        )
        value = held.column("value").to_numpy()
        label = held.column("label").to_numpy()
        if turn == rounds:
            break
        strong = dict(telling)
        # A toxic document's strongest word is believed if few clean documents have one as strong.
        border = np.quantile(value[label == 0], 0.99)
        for word, at, kind in zip(map(clean, held.column("word").to_pylist()), value, label):
            if not 2 <= len(word) <= LONGEST or (kind == 1 and at <= border):
                continue
            if kind == 0:
                weak[word] = weak.get(word, 0.0) + 10.0
            else:
                strong[word] = strong.get(word, 0.0) + 1.0
        strong = {w: c for w, c in strong.items() if w not in weak}
        machine = train(
            sorted(strong.items(), key=lambda p: (-p[1], p[0])),
            sorted(weak.items(), key=lambda p: (-p[1], p[0])),
        )
    machine.slope, machine.shift = _calibrate(value, label)
    return machine


def _telling(
    only: list[tuple[str, float]], plain: list[tuple[str, float]], enough: int = 50
) -> list[tuple[str, float]]:
    """Words that several toxic documents use. If these are few, also words more like the other
    words of toxic documents than nearly all plain words are."""
    often = [(w, c) for w, c in only if c >= 3]
    if len(often) >= enough:
        return often
    apart = table_of(only) - table_of(plain)
    border = np.quantile(likeness([w for w, _ in plain], apart), 0.99)
    own = likeness([w for w, _ in only], apart)
    return [(w, c) for (w, c), value in zip(only, own) if c >= 3 or value > border] or only[:1]


def _calibrate(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of labels over values (softened targets)."""
    ones, zeros = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.column_stack([value, np.ones(len(value))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * w
        )
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


#: The judge of the last machine that this worker has met.
_judges: dict[int, Judge] = {}


def score(
    df: DataFrame,
    machine: Machine | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    all_words: bool = False,
) -> DataFrame:
    """``id, score, value, word, sentence`` per row.

    ``score`` is the probability of label 1; ``word`` is the strongest word as it stands in the
    lower-cased text and ``sentence`` the first sentence with it, if the score is 0.3 or more (the
    word always with ``all_words``). A
    NULL or empty text has no word and the value of the bias. Without a machine scores are 0.
    Rows are independent; repeated rows are kept. No shuffle.
    """
    kind = id_type(df, id_col)
    shared = df.sparkSession.sparkContext.broadcast(machine)
    key = shared._jbroadcast.id()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        if model is not None and key not in _judges:
            _judges.clear()
            _judges[key] = Judge(model)
        for batch in small_batches(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            if model is None:
                found, values = [(0.0, "")] * len(texts), np.zeros(len(texts))
                scores = values
            else:
                found = _judges[key].strongest(texts)
                values = np.array([v for v, _ in found], dtype=float)
                scores = model.probability(values)
            toxic = scores >= 0.3
            words = [w if hit or all_words else None for (_, w), hit in zip(found, toxic)]
            sentences = [
                next((m[0].strip() for m in SENTENCE.finditer(t) if w in m[0].lower()), None)
                if w and hit
                else None
                for t, w, hit in zip(texts, words, toxic)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores),
                    pa.array(values),
                    pa.array(words, pa.string()),
                    pa.array(sentences, pa.string()),
                ],
                ["id", "score", "value", "word", "sentence"],
            )

    schema = f"id {kind}, score double, value double, word string, sentence string"
    return map_rows(id_text(df, id_col, text_col), run, schema)
