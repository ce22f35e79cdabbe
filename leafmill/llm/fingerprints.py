"""Document fingerprints from prefix polynomial hashes.

For a text of code points c the prefix array holds, at i, the sum of c[j] * B**j for j < i modulo the
prime 2**31 - 1, for two bases. The hash of any span is the difference of two entries times an
inverse power, so any two spans are compared in constant time and the longest common extension of
two positions is found by binary search.

The fingerprint of a text is its length, the hash of the whole text and the smallest ``SKETCH``
different hashes of its spans of ``SPAN`` code points. Likeness is the estimated share of spans that
two texts have in common (exact when both have ``SKETCH`` spans or fewer). Equal texts have equal
fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import id_type, map_rows, small_batches, tidy
from leafmill.plans.workdir import written

PRIME = np.uint64((1 << 31) - 1)
BASES = (1_000_003, 998_244_353)
SPAN = 10
SKETCH = 64


def reduced(values: np.ndarray) -> np.ndarray:
    """Values below 2**62 modulo the prime, without division."""
    for _ in range(2):
        high = values >> np.uint64(31)
        values = values & PRIME
        values += high
    # Below the prime the difference wraps around and is the larger one.
    return np.minimum(values, values - PRIME)


class Powers:
    """Powers of a base and of its inverse, as far as the longest text so far needs them."""

    def __init__(self, base: int) -> None:
        self.pair = base % int(PRIME), pow(base, -1, int(PRIME))
        self.tables = [np.ones(1, dtype=np.uint64) for _ in self.pair]

    def upto(self, size: int) -> list[np.ndarray]:
        while len(self.tables[0]) < size:
            have = len(self.tables[0])
            for k, base in enumerate(self.pair):
                step = np.uint64(pow(base, have, int(PRIME)))
                self.tables[k] = np.concatenate([self.tables[k], reduced(self.tables[k] * step)])
        return self.tables


_powers = [Powers(base) for base in BASES]


class PrefixHash:
    """The prefix arrays of one text; spans are half-open in code points."""

    def __init__(self, text: str) -> None:
        self.points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.size = len(self.points)
        values = self.points.astype(np.uint64) + np.uint64(1)
        self.prefix, self.inverse = [], []
        for powers in _powers:
            forward, backward = powers.upto(self.size + 1)
            terms = reduced(values * forward[: self.size])
            # Sums of up to 2**32 terms below 2**31 fit 64 bits.
            whole = np.zeros(self.size + 1, dtype=np.uint64)
            np.cumsum(terms, out=whole[1:])
            self.prefix.append(reduced(whole))
            self.inverse.append(backward)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of spans: two residues in one 64-bit number."""
        out = np.zeros(len(starts), dtype=np.uint64)
        for prefix, inverse in zip(self.prefix, self.inverse):
            gap = reduced(prefix[ends] + PRIME - prefix[starts])
            out = (out << np.uint64(31)) | reduced(gap * inverse[starts])
        return out

    def span(self, start: int, end: int) -> int:
        """The hash of one span, the same number as from ``spans``."""
        prime, out = int(PRIME), 0
        for prefix, inverse in zip(self.prefix, self.inverse):
            gap = int(prefix[end]) - int(prefix[start])
            out = out << 31 | gap * int(inverse[start]) % prime
        return out

    def same(self, start: int, other: PrefixHash, other_start: int, size: int) -> bool:
        """Whether two spans of one size are equal, up to hash collisions."""
        return self.span(start, start + size) == other.span(other_start, other_start + size)

    def common_extension(self, start: int, other: PrefixHash, other_start: int) -> int:
        """Length of the longest common stretch that begins at two positions."""
        low, high = 0, min(self.size - start, other.size - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(start, other, other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def sketch(self) -> np.ndarray:
        """The smallest different span hashes, scrambled, ascending; a short text is one span."""
        if not self.size:
            return np.zeros(0, dtype=np.uint64)
        wide = min(SPAN, self.size)
        starts = np.arange(self.size - wide + 1)
        hashes = self.spans(starts, starts + wide)
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(32)
        wanted = 2 * SKETCH
        while len(hashes) > wanted:
            least = np.unique(np.partition(hashes, wanted)[:wanted])
            if len(least) >= SKETCH:
                return least[:SKETCH]
            wanted *= 4
        return np.unique(hashes)[:SKETCH]

    def fingerprint(self) -> tuple[str, np.ndarray]:
        """Length, whole hash and sketch as one string, and the sketch."""
        least = self.sketch()
        return shown(self.size, self.span(0, self.size), least), least


def shown(size: int, whole: int, sketch: np.ndarray) -> str:
    return f"{size:x}:{whole:016x}:{sketch.astype('>u8').tobytes().hex()}"


def rest_of(sketch: np.ndarray, base: np.ndarray) -> tuple[bytes, bytes]:
    """A sketch as what it takes from another one (a bit for each place) and the hashes besides."""
    taken = np.isin(base, sketch, assume_unique=True)
    own = sketch[~np.isin(sketch, base, assume_unique=True)]
    return np.packbits(taken).tobytes(), own.tobytes()


def from_rest(taken: bytes, own: bytes, base: np.ndarray) -> np.ndarray:
    """The sketch that ``rest_of`` has taken apart."""
    flags = np.unpackbits(np.frombuffer(taken, np.uint8), count=len(base)).astype(bool)
    return np.sort(np.concatenate([base[flags], np.frombuffer(own, np.uint64)]))


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Estimated share of common spans, from two sketches; two empty texts are alike."""
    if not len(left) and not len(right):
        return 1.0
    one, other = set(left.tolist()), set(right.tolist())
    union = sorted(one | other)[:SKETCH]
    return sum(h in one and h in other for h in union) / len(union)


def edited_text(text: str, following: str) -> str:
    """The text whose last third is replaced by as much of the beginning of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


FIELDS = [
    ("n_chars", pa.int64(), "long"),
    ("edited_sha256", pa.string(), "string"),
    ("fingerprint", pa.string(), "string"),
    ("edited_fingerprint", pa.string(), "string"),
    ("near_edited", pa.float64(), "double"),
    ("near_next", pa.float64(), "double"),
    ("common_edited", pa.int64(), "long"),
    ("common_next", pa.int64(), "long"),
]


#: What a row holds between the two steps: hashes as bytes, those of the edited text only where
#: they differ from the text's own. A fingerprint as text is twice as long.
PACKED = [
    ("n_chars", pa.int64(), "long"),
    ("edited_sha256", pa.binary(), "binary"),
    ("whole", pa.int64(), "long"),
    ("sketch", pa.binary(), "binary"),
    ("edited_chars", pa.int64(), "long"),
    ("edited_whole", pa.int64(), "long"),
    ("edited_taken", pa.binary(), "binary"),
    ("edited_rest", pa.binary(), "binary"),
    *FIELDS[4:],
]


class Marked:
    """A text with its prefix arrays, hash and sketch."""

    def __init__(self, text: str) -> None:
        self.text, self.hashes = text, PrefixHash(text)
        self.whole, self.sketch = self.hashes.span(0, self.hashes.size), self.hashes.sketch()


def compare(one: Marked, following: Marked) -> tuple:
    """The values of ``PACKED`` for a text and the one after it."""
    changed = Marked(edited_text(one.text, following.text))
    return (
        one.hashes.size,
        hashlib.sha256(changed.text.encode("utf-8")).digest(),
        one.whole,
        one.sketch.tobytes(),
        changed.hashes.size,
        changed.whole,
        *rest_of(changed.sketch, one.sketch),
        likeness(one.sketch, changed.sketch),
        likeness(one.sketch, following.sketch),
        one.hashes.common_extension(0, changed.hashes, 0),
        one.hashes.common_extension(0, following.hashes, 0),
    )


def unpacked(values: tuple) -> tuple:
    """The values of ``FIELDS`` from those of ``PACKED``."""
    size, digest, whole, sketch, edited_size, edited_whole, taken, own, *rest = values
    base = np.frombuffer(sketch, np.uint64)
    edited = shown(edited_size, edited_whole, from_rest(taken, own, base))
    return size, digest.hex(), shown(size, whole, base), edited, *rest


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint, n_chars`` per row; NULL counts as the empty text. No shuffle."""
    kind = id_type(df, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            prints = [PrefixHash(t).fingerprint()[0] for t in texts]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.string()), sizes],
                ["id", "fingerprint", "n_chars"],
            )

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, run, f"id {kind}, fingerprint string, n_chars long")


def neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against its edited text and the next text by descending id: ``id`` and ``FIELDS``.

    The row after the last is the first; a single row follows itself. NULL texts count as empty,
    NULL ids come last, and rows of one id are ordered by the hash of their text, so repeated rows
    follow each other. ``common_*`` is the length of the common beginning.

    The rows are range-partitioned by descending id once; a task compares neighbours as they
    stream by and hands on only its first and last text, with which the borders between tasks are
    closed afterwards. The rows are written to the shared folder as ``PACKED``, so both come from one
    run.
    """
    kind = id_type(df, id_col)
    tidy(df.sparkSession)
    names = [name for name, _, _ in PACKED]
    described = ", ".join(f"{name} {sql}" for name, _, sql in PACKED)
    schema = f"id {kind}, {described}, task int, edge string, text string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        last, rows, id_kind = None, [], None

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [id_kind, *[k for _, k, _ in PACKED], pa.int32(), pa.string(), pa.string()]
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(made, ["id", *names, "task", "edge", "text"])

        blank = (None,) * len(PACKED)
        for batch in small_batches(batches):
            id_kind = batch.column(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                here = Marked(text or "")
                if last is None:
                    rows.append((doc, *blank, task, "first", here.text))
                else:
                    rows.append((last[0], *compare(last[1], here), task, None, None))
                last = doc, here
            if rows:
                yield out()
        if last is not None:
            rows.append((last[0], *blank, task, "last", last[1].text))
            yield out()

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    order = [F.desc_nulls_last("id"), F.xxhash64("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    done = written(df.sparkSession, map_rows(placed, walk, schema), "fingerprints", "zstd")
    result = _shown(done.where(F.col("edge").isNull()).select("id", *names), kind)

    # One first and one last row per task: link each last to the next task's first.
    tasks = [r["task"] for r in done.where("edge = 'first'").select("task").orderBy("task").collect()]
    if not tasks:
        return result
    following = df.sparkSession.createDataFrame(
        list(zip(tasks, [*tasks[1:], tasks[0]])), "task int, next_task int"
    )
    firsts = done.where("edge = 'first'").select(
        F.col("task").alias("next_task"), F.col("text").alias("next_text")
    )
    borders = (
        done.where("edge = 'last'")
        .select("id", "text", "task")
        .join(following, "task")
        .join(firsts, "next_task")
        .select("id", "text", "next_text")
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [
                compare(Marked(a), Marked(b))
                for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            made = [pa.array(c, k) for c, (_, k, _) in zip(zip(*found), PACKED)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["id", *names])

    return result.unionByName(_shown(map_rows(borders, close, f"id {kind}, {described}"), kind))


def _shown(packed: DataFrame, kind: str) -> DataFrame:
    """``id`` and ``FIELDS`` from ``id`` and ``PACKED``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [unpacked(v) for v in zip(*[c.to_pylist() for c in batch.columns[1:]])]
            columns = list(zip(*rows)) if rows else [()] * len(FIELDS)
            made = [pa.array(c, k) for c, (_, k, _) in zip(columns, FIELDS)]
            names = [name for name, _, _ in FIELDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["id", *names])

    described = ", ".join(f"{name} {sql}" for name, _, sql in FIELDS)
    return map_rows(packed, run, f"id {kind}, {described}")
