"""Spelling variants: words of a vocabulary that are one edit apart, and the form each belongs to.

Two words one edit apart agree outside of the piece of the word that holds the edit. So each word is
put under a key for each piece of a cut in two (the piece's bounds and what stands before and after
it), and only words under one key are compared. A key with too many words is cut again: its piece in
two, its words under longer contexts, down to single characters, where the alphabet bounds a group.

Within a group the words' pieces are held bit-sliced: for every position and letter one bit string
with a bit for every word that has the letter there. A query runs over its letters once and moves
four bit strings along, all words at a time: those equal so far, and those with one letter replaced,
with one more (positions shifted up) and with one less (shifted down). Bits stand in the order of
the counts, so the lowest bit set is the form and the number of bits set the number of near words;
pairs are never written out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import id_text, map_rows, small_batches
from leafmill.plans.workdir import written

RUN = r"[A-Za-zÀ-ÿ]"
#: One run in so many loses a character before words are counted.
DROP_ONE_IN = 31
SHORTEST, LEAST_COUNT, TIMES = 7, 2, 10
#: Words under one key; keys with more are cut again.
GROUP = 4096
#: Different words a task counts before it hands the counts on.
HELD = 200_000


def altered(run: str, start: int, one_in: int = DROP_ONE_IN) -> str:
    """The run, or what is left of it if the hash of ``<id>:<run>`` says that it loses a character.

    ``start`` is the crc32 of ``<id>:``.
    """
    number = zlib.crc32(run.encode(), start)
    if number % one_in:
        return run
    at = number % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(
    df: DataFrame,
    shortest: int = SHORTEST,
    least: int = LEAST_COUNT,
    one_in: int = DROP_ONE_IN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, n``: words of at least ``shortest`` characters that occur ``least`` times or more.

    A NULL text has no words, a NULL id reads as an empty one; repeated rows count again. Counts are
    summed in the task before they move, so a word that is everywhere is one row a task.
    """
    runs = re.compile(f"{RUN}{{{shortest},}}")  # shorter runs give no word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["word", "n"],
            )
            counts.clear()
            return made

        for batch in small_batches(batches):
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                start = zlib.crc32(f"{name or ''}:".encode())
                low = text.encode().lower().decode()  # A-Z alone
                for found, n in Counter(runs.findall(low)).items():
                    word = altered(found, start, one_in)
                    if len(word) >= shortest:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield out()
        yield out()

    named = id_text(df, id_col, text_col).withColumn("id", F.col("id").cast("string"))
    rows = map_rows(named, run, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _under(words: DataFrame, pieces) -> DataFrame:
    """``key, base, low, high, word, n``: words under the keys of their pieces.

    ``base`` is the length of the shorter words of a pair; ``low`` and ``high`` bound the piece in
    these. Longer words have one more character in the piece.
    """
    cut = words.withColumn("_piece", F.explode(pieces)).select("word", "n", "_piece.*")
    before = F.substring("word", F.lit(1), F.col("low"))
    after = F.right("word", F.col("base") - F.col("high"))
    key = F.xxhash64("base", "low", "high", before, after)
    return cut.select(key.alias("key"), "base", "low", "high", "word", "n")


def _piece(base, low, high):
    return F.struct(base.alias("base"), low.alias("low"), high.alias("high"))


def _halves(base):
    middle = (base / 2).cast("int")
    return [_piece(base, F.lit(0), middle), _piece(base, middle, base)]


def _cut_again(rows: DataFrame) -> DataFrame:
    middle = ((F.col("low") + F.col("high")) / 2).cast("int")
    pieces = F.array(
        _piece(F.col("base"), F.col("low"), middle), _piece(F.col("base"), middle, F.col("high"))
    )
    held = rows.select("word", "n", pieces.alias("_pieces"))
    return _under(held, F.col("_pieces")).select(*rows.columns)


def grouped(words: DataFrame, shortest: int, group: int = GROUP) -> list[DataFrame]:
    """Words under keys that hold ``group`` of them at most, one frame for each round of cuts.

    A word is the shorter one of a pair under its own length, the longer one under one less.
    """
    spark = words.sparkSession
    size = F.length("word")
    own, less = _halves(size), _halves(size - 1)
    pieces = F.when(size > shortest, F.array(*own, *less)).otherwise(F.array(*own))
    rows, done = _under(words, pieces), []
    while True:
        large = written(
            spark,
            rows.where("high - low > 1").groupBy("key").count().where(F.col("count") > group),
            "large",
        ).select("key")
        if large.isEmpty():
            return [*done, rows]
        # A key whose piece is a single character is never large, so whole keys go either way.
        done.append(rows.join(large, "key", "left_anti"))
        rows = written(spark, _cut_again(rows.join(large, "key", "left_semi")), "cut")


class Slices:
    """A bit-sliced index over the pieces of a group's words, given in the order of the bits."""

    def __init__(self, pieces: list[str]) -> None:
        self.every = (1 << len(pieces)) - 1
        self.letters: dict[tuple[int, str], int] = defaultdict(int)
        self.lengths: dict[int, int] = defaultdict(int)
        for number, piece in enumerate(pieces):
            bit = 1 << number
            self.lengths[len(piece)] |= bit
            for place, letter in enumerate(piece):
                self.letters[place, letter] |= bit

    def near(self, query: str, shorter: int, last: bool) -> int:
        """Bits of the words one edit away from ``query``, a piece of ``shorter`` letters or one more.

        Two words of the longer kind meet under other keys. A pair of different lengths can meet
        in several pieces; it counts in the one where the words first differ, which is this one
        unless the shorter piece stands whole at the front of the longer (then the next piece, or this
        if it is the ``last``).
        """
        get = self.letters.get
        equal, whole = self.every, 0
        replaced = more = less = 0
        for place, letter in enumerate(query):
            here = get((place, letter), 0)
            whole = equal  # as it was before the last letter
            replaced = (replaced & here) | (equal & ~here)
            more = (more | equal) & get((place + 1, letter), 0)
            less = (less & get((place - 1, letter), 0)) | equal
            equal &= here
        if len(query) == shorter:
            more = more | equal if last else more & ~equal
            return (replaced & self.lengths[shorter]) | (more & self.lengths[shorter + 1])
        return (less if last else less & ~whole) & self.lengths[shorter]


def compare(members: list[tuple[str, int]], base: int, low: int, high: int) -> list[tuple]:
    """``word, near words, form, its count`` for the members of a group that have near words here."""
    if len(members) < 2:
        return []
    members.sort(key=lambda m: (-m[1], m[0]))
    pieces = [w[low : high + len(w) - base] for w, _ in members]
    index, out = Slices(pieces), []
    for (word, _), piece in zip(members, pieces):
        bits = index.near(piece, high - low, high == base)
        if bits:
            form, n = members[(bits & -bits).bit_length() - 1]
            out.append((word, bits.bit_count(), form, n))
    return out


def _compared(rows: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n`` of each group; groups come whole and in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        def out(found: list[tuple]) -> pa.RecordBatch:
            word, near, form, n = zip(*found) if found else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(word, pa.string()),
                    pa.array(near, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(n, pa.int64()),
                ],
                ["word", "n_near", "form", "form_n"],
            )

        found: list[tuple] = []
        for _, same in groupby(lines(), key=lambda r: r[0]):
            # Different contexts can share a hash.
            sets: dict[tuple, list[tuple[str, int]]] = defaultdict(list)
            for _, base, low, high, word, n in same:
                sets[base, low, high, word[:low], word[len(word) - base + high :]].append((word, n))
            for (base, low, high, _, _), members in sets.items():
                found += compare(members, base, low, high)
            if len(found) >= HELD:
                yield out(found)
                found = []
        yield out(found)

    dealt = rows.repartition("key").sortWithinPartitions("key")
    return map_rows(dealt, run, "word string, n_near bigint, form string, form_n bigint")


def near_words(words: DataFrame, shortest: int = SHORTEST, group: int = GROUP) -> DataFrame:
    """``word, n_near, form, form_n`` for every word of ``word, n`` that has a near one.

    Near words differ by exactly one inserted, deleted or replaced character; ``form`` is the one
    of largest ``n``, of equal ones the first in code-point order. Words are distinct and have at
    least ``shortest`` characters, two or more.
    """
    found = None
    for rows in grouped(words, shortest, group):
        part = _compared(rows)
        found = part if found is None else found.unionByName(part)
    # Under each key the best of that key; in UTF-8 bytes order as code points do.
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form")))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))


def variants(
    df: DataFrame,
    times: int = TIMES,
    shortest: int = SHORTEST,
    least: int = LEAST_COUNT,
    one_in: int = DROP_ONE_IN,
    group: int = GROUP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts, see :func:`vocabulary`.

    ``form`` is the most frequent near word if it is at least ``times`` as frequent as the word, else
    NULL, with its count ``form_n``; ``root`` is where forms lead to, the word itself if it has none.
    An empty table gives no rows. Words, their keys and their forms move; pairs do not. ``times`` is 2
    or more, so that ways end.
    """
    if times < 2:
        raise ValueError("need times >= 2")
    spark = df.sparkSession
    words = written(
        spark, vocabulary(df, shortest, least, one_in, id_col, text_col), "vocabulary"
    )
    near = near_words(words, shortest, group)
    enough = F.col("form_n") >= times * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word",
        F.when(enough, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form_n")).alias("form_n"),
    )
    held = written(spark, joined, "forms")
    # Each step multiplies the count by ``times``, which bounds the length of a way to the root.
    most = words.agg(F.max("n")).first()[0] or 0
    steps, reach = 0, least
    while reach * times <= most:
        steps, reach = steps + 1, reach * times
    roots = held.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while steps > 1:  # a jump doubles the way behind a root
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumped = roots.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root")
        )
        roots, steps = written(spark, jumped, "roots"), (steps + 1) // 2
    return held.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
