"""Quality rules on word statistics, and an isolation forest over them.

Every text gives counts (words, symbols, repeated lines and words) and, from them, rates. Two plain
rules reject a text at once. For the others an isolation forest judges the rates: trees of random
splits, in which a cell is cut again while it holds more than a 256th of all accepted labelled rows. A
split is drawn from the whole range that the cell may hold, not only from the range of the rows in
it, so a text unlike the accepted ones soon lies in a cell by itself: its paths are short, its score
is near 1. The threshold is the score that best tells rejected from accepted labelled rows while
losing at most ``most_lost`` of the accepted ones.

Ranges, cells and threshold come from all labelled rows. Their rates are computed once and counted
in the tasks; what the driver sees is a count for each cell, and cells are bounded by their share.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.llm.common import id_text, id_type, map_rows, rewrite, small_batches, tidy
from leafmill.plans.workdir import written

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Multipliers that turn three word hashes into one window hash; odd, so no bits are lost.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
#: Rates of a row, and different scores that are put in order together.
RATES, ORDERED = 9, 100_000


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that the text holds twice or more."""
    if len(words) < 4:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = codes[:-2] * MIX[0] + codes[1:-1] * MIX[1] + codes[2:] * MIX[2]
    order = np.argsort(windows, kind="stable")
    sorted_windows = windows[order]
    same = sorted_windows[1:] == sorted_windows[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= twice
    return int(covered.sum())


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The counts named in ``COUNTS``, and the rates that the forest sees. NULL counts as empty."""
    text = text or ""
    raw = text.encode("utf-8")
    words = raw.split()  # of bytes, so exactly the six ASCII white-space characters separate
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(raw.count, map(str.encode, SYMBOLS)))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    doubled = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    upper = len(raw) - len(raw.translate(None, UPPER))
    letters = upper + len(raw) - len(raw.translate(None, LOWER))
    digits = len(raw) - len(raw.translate(None, DIGITS))
    distinct = set(words)
    marks = sum(words.count(w) for w in distinct if len(w) == 1 and not w.isalnum())
    per_word, per_char = max(n, 1), max(chars, 1)
    rates = (
        chars / per_word,
        symbols / per_char,
        repeated / per_word,
        doubled / max(len(lines), 1),
        upper / max(letters, 1),
        digits / per_char,
        sum(map(raw.count, (b"!", b"?"))) / per_char,
        marks / per_word,
        len(distinct) / math.sqrt(per_word),
    )
    return (n, chars, symbols, doubled, repeated), rates


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


@dataclass
class Forest:
    """Trees as arrays: per node the feature (-1: leaf), the split, the children, the leaf's path."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    path: np.ndarray
    usual: float
    threshold: float = 2.0  # no score is above 1, so nothing is rejected until calibrated

    def leaves(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """The leaf that each row lies in, tree by tree."""
        which = np.arange(len(rows))
        for feature, split, child in zip(self.feature, self.split, self.child):
            node = np.zeros(len(rows), dtype=np.int64)
            while True:
                wanted = feature[node]
                inner = wanted >= 0
                if not inner.any():
                    break
                right = rows[which, np.maximum(wanted, 0)] >= split[node]
                node = np.where(inner, child[node] + right, node)
            yield node

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / usual path) per row: near 1 for a row that is quickly set apart."""
        total = np.zeros(len(rows))
        for path, node in zip(self.path, self.leaves(rows)):
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / self.usual)

    def held(self, rows: np.ndarray) -> np.ndarray:
        """How many of the rows lie in each leaf (trees x nodes)."""
        nodes = self.feature.shape[1]
        return np.array([np.bincount(node, minlength=nodes) for node in self.leaves(rows)])


def usual_path(n: float) -> float:
    """Mean path to a row in a random search tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649 if n > 2 else 0.5) - 2.0 * (n - 1) / n


class Cell:
    """A cell of a tree: its bounds and level, and its split and halves once it is cut."""

    def __init__(self, low: np.ndarray, high: np.ndarray, level: int) -> None:
        self.low, self.high, self.level = low, high, level
        self.feature, self.at = -1, 0.0
        self.halves: list[Cell] = []
        self.rows = 0

    def cut(self, levels: int, rng: np.random.Generator) -> None:
        """Cut so many levels deep, wherever a range is left."""
        wide = np.flatnonzero(self.high > self.low)
        if not levels or not len(wide):
            return
        self.feature = k = int(rng.choice(wide))
        self.at = rng.uniform(self.low[k], self.high[k])
        below, above = self.high.copy(), self.low.copy()
        below[k] = above[k] = self.at
        self.halves = [Cell(self.low, below, self.level + 1), Cell(above, self.high, self.level + 1)]
        for half in self.halves:
            half.cut(levels - 1, rng)

    def listed(self) -> list[Cell]:
        """All cells, the halves of a cell side by side."""
        out = [self]
        for cell in out:
            out.extend(cell.halves)
        return out


def _forest(roots: list[Cell], total: int, part: float) -> Forest:
    """The trees as arrays; ``part`` rows stand for all when the rest of a path is reckoned."""
    made = [root.listed() for root in roots]
    shape = len(made), max(map(len, made))
    forest = Forest(
        np.full(shape, -1, dtype=np.int64),
        np.zeros(shape),
        np.zeros(shape, dtype=np.int64),
        np.zeros(shape),
        max(usual_path(part), 1.0),
    )
    for i, cells in enumerate(made):
        following = 1
        for k, cell in enumerate(cells):
            if cell.halves:
                forest.feature[i, k], forest.split[i, k] = cell.feature, cell.at
                forest.child[i, k] = following
                following += 2
            else:
                share = part * cell.rows / max(total, 1)
                forest.path[i, k] = cell.level + (usual_path(share) if share > 2 else 0.0)
    return forest


def grow_counted(
    total: int,
    count: Callable[[Forest], np.ndarray],
    low: np.ndarray,
    high: np.ndarray,
    trees: int = 100,
    part: int = 256,
    depth: int = 16,
    step: int = 4,
    seed: int = 7,
) -> Forest:
    """A forest over ``total`` rows that only ``count`` sees: how many lie in each leaf of a forest.

    Splits are drawn between ``low`` and ``high``, ``step`` levels at a time; cuts of cells that turn
    out to hold at most a ``part``-th of all rows are taken back. So rows are counted ``depth /
    step`` times and a level has at most ``part`` cells that are cut.
    """
    rngs = [np.random.default_rng([seed, i]) for i in range(trees)]
    roots = [Cell(low.astype(float), high.astype(float), 0) for _ in range(trees)]
    fit_part = min(part, total)
    for cell in roots:
        cell.rows = total
    for start in range(0, depth, step):
        for root, rng in zip(roots, rngs):
            for cell in root.listed():
                if cell.level == start and cell.rows * fit_part > total:
                    cell.cut(min(step, depth - start), rng)
        held = count(_forest(roots, total, fit_part))
        for root, rows in zip(roots, held):
            cells = root.listed()
            for k, cell in reversed(list(enumerate(cells))):
                cell.rows = sum(half.rows for half in cell.halves) if cell.halves else int(rows[k])
            for cell in cells:
                if cell.rows * fit_part <= total:
                    cell.feature, cell.at, cell.halves = -1, 0.0, []
    return _forest(roots, total, fit_part)


def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray, **shape: int) -> Forest:
    """A forest over the rows (n x features), with splits drawn between ``low`` and ``high``."""
    return grow_counted(len(rows), lambda forest: forest.held(rows), low, high, **shape)


def calibrate(forest: Forest, scores: np.ndarray, good: np.ndarray, most_lost: float) -> None:
    """Set the threshold: most rejected rows caught less accepted ones lost, within the limit."""
    order = np.argsort(-scores, kind="stable")
    ranked = good[order].astype(bool)
    lost = np.cumsum(ranked) / max(ranked.sum(), 1)
    caught = np.cumsum(~ranked) / max((~ranked).sum(), 1)
    # A threshold lies between two different scores.
    cut = np.append(scores[order][1:] < scores[order][:-1], True)
    gain = np.where(cut & (lost <= most_lost), caught - lost, -1.0)
    best = int(np.argmax(gain))
    if gain[best] > 0:
        following = scores[order][best + 1] if best + 1 < len(order) else 0.0
        forest.threshold = float((scores[order][best] + following) / 2)


def _counted(table: DataFrame, forest: Forest) -> np.ndarray:
    """``Forest.held`` of the rows of a table; a task sends one row for each leaf that it met."""
    shared = table.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(shared.value.feature.shape, dtype=np.int64)
        for batch in batches:
            held += shared.value.held(_matrix(batch.column(0)))
        cells = np.flatnonzero(held)
        columns = [pa.array(cells), pa.array(held.reshape(-1)[cells])]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "rows"])

    found = map_rows(table.select("rates"), run, "cell long, rows long")
    found = found.groupBy("cell").agg(F.sum("rows").alias("rows")).toArrow()
    out = np.zeros(forest.feature.size, dtype=np.int64)
    out[found.column("cell").to_numpy()] = found.column("rows").to_numpy()
    return out.reshape(forest.feature.shape)


def _matrix(rates: pa.Array) -> np.ndarray:
    """A column of rates as rows x features."""
    return rates.flatten().to_numpy(zero_copy_only=False).reshape(-1, RATES)


def threshold(scored: DataFrame, most_lost: float) -> float | None:
    """As :func:`calibrate`, for ``score, good`` of any number of rows; None if no score helps.

    Rows are summed by score and the scores put in order range by range; only the sums of the ranges
    come to the driver.
    """
    flag = F.col("good").cast("boolean").cast("long")
    sums = scored.groupBy("score").agg(F.sum(flag).alias("good"), F.sum(1 - flag).alias("bad"))
    sums = written(scored.sparkSession, sums, "quality")
    total = sums.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.count("*").alias("n")).first()
    pieces = 1 + (total["n"] or 0) // ORDERED
    parts = [k / pieces for k in range(1, pieces)]
    borders = sums.approxQuantile("score", parts, 0.2 / pieces) if parts else []
    above = F.array(*[F.lit(x) for x in sorted(set(borders))]).cast("array<double>")
    ranged = sums.withColumn("piece", F.size(F.filter(above, lambda x: F.col("score") < x)))
    before, offsets = [0, 0], []
    for row in sorted(ranged.groupBy("piece").agg(F.sum("good"), F.sum("bad")).collect()):
        offsets.append((row[0], *before))
        before = [before[0] + row[1], before[1] + row[2]]
    if not offsets:
        return None
    offset = scored.sparkSession.createDataFrame(offsets, "piece int, good_0 long, bad_0 long")
    upto = Window.partitionBy("piece").orderBy(F.desc("score"))
    lost = (F.col("good_0") + F.sum("good").over(upto)) / F.lit(max(total["good"], 1))
    caught = (F.col("bad_0") + F.sum("bad").over(upto)) / F.lit(max(total["bad"], 1))
    ranked = ranged.join(F.broadcast(offset), "piece").select(
        "score", lost.alias("lost"), (caught - lost).alias("gain")
    )
    allowed = ranked.where((F.col("lost") <= most_lost) & (F.col("gain") > 0))
    best = allowed.orderBy(F.desc("gain"), F.desc("score")).select("score").first()
    if best is None:
        return None
    following = sums.where(F.col("score") < best["score"]).agg(F.max("score")).first()[0]
    return (best["score"] + (following or 0.0)) / 2


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_lost: float = 0.002,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Forest | None:
    """A calibrated forest from all labelled rows; None without labels of both kinds.

    Rows with a NULL id or label are not labelled; of a repeated id one label and one text count.
    """
    spark, kind = docs.sparkSession, id_type(docs, id_col)
    tidy(spark)
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good"))
        .dropna()
        .groupBy("id")
        .agg(F.max("good").alias("good"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [statistics(t) for t in batch.column(1).to_pylist()]
            made = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([list(r) for _, r in found], pa.list_(pa.float64()))],
                ["id", "rates"],
            )
            yield made.filter(pa.array([not base_failed(c[0], c[4]) for c, _ in found], pa.bool_()))

    # Rates, not texts, meet the labels.
    rated = map_rows(id_text(docs, id_col, text_col).dropna(subset=["id"]), run, f"id {kind}, rates array<double>")
    table = rated.join(known, "id").groupBy("id").agg(F.min("rates").alias("rates"), F.max("good").alias("good"))
    table = written(spark, table.select("rates", "good"), "quality")
    ends = [end(F.col("rates")[k]) for end in (F.min, F.max) for k in range(RATES)]
    seen = table.agg(
        F.count(F.when(F.col("good") == 1, 1)), F.min("good"), F.max("good"), *ends
    ).first()
    if seen[1] is None or seen[1] == seen[2]:
        return None
    low, high = np.array(seen[3 : 3 + RATES]), np.array(seen[3 + RATES :])
    usual = table.where("good = 1")
    forest = grow_counted(seen[0], lambda grown: _counted(usual, grown), low, high)
    shared = spark.sparkContext.broadcast(forest)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(shared.value.scores(_matrix(batch.column(0))))
            yield pa.RecordBatch.from_arrays([scores, batch.column(1)], ["score", "good"])

    best = threshold(map_rows(table, score, "score double, good int"), most_lost)
    if best is not None:
        forest.threshold = best
    return forest


def judge(
    docs: DataFrame, forest: Forest | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, the counts, ``base_failed``, ``anomaly`` (0 to 1) and ``kept`` per row.

    NULL and empty texts count as no words and fail the base rules. Without a forest the base rules
    alone decide and ``anomaly`` is 0. Rows are independent; repeated rows are kept. No shuffle.
    """
    kind = id_type(docs, id_col)
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in small_batches(batches):
            found = [statistics(t) for t in batch.column(1).to_pylist()]
            counts = [pa.array(c, pa.int64()) for c in zip(*[c for c, _ in found])]
            failed = np.array([base_failed(c[0], c[4]) for c, _ in found])
            scores = np.zeros(len(found))
            if model is not None:
                scores = model.scores(np.array([r for _, r in found], dtype=float))
            kept = ~failed & (scores <= (model.threshold if model is not None else 2.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(failed), pa.array(scores), pa.array(kept)],
                ["id", *COUNTS, "base_failed", "anomaly", "kept"],
            )

    longs = ", ".join(f"{name} long" for name in COUNTS)
    schema = f"id {kind}, {longs}, base_failed boolean, anomaly double, kept boolean"
    return map_rows(id_text(docs, id_col, text_col), run, schema)


def accepted(docs: DataFrame, forest: Forest | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``judge`` keeps."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def verdicts():
        model = shared.value

        def act(texts: list[str | None]) -> tuple[None, list[bool]]:
            found = [statistics(t) for t in texts]
            stay = np.array([not base_failed(c[0], c[4]) for c, _ in found])
            if model is not None:
                rates = np.array([r for _, r in found], dtype=float)
                stay &= model.scores(rates) <= model.threshold
            return None, stay.tolist()

        return act

    return rewrite(docs, verdicts, text_col)
