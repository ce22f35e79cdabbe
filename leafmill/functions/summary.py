"""Model-free extractive summaries as column expressions.

A sentence scores the sum, over its distinct words, of how often each word occurs in the text. The
best ``k`` sentences are kept, in text order. Everything happens inside one row: no word is ever
shuffled, and the cost is that of sorting the words of the text and looking each one up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.binding import let, run_starts
from leafmill.functions.text import strip

# Fixed values.
SENTENCE_END = r"[.!?\n]+"
WORD_GAP = r"[\t-\r ]+"
SENTENCE_JOINER = " \n"

# Words looked up in one plain map, and beyond that, words that share one slot of the in-row
# lookup table, on average.
WORDS_PER_MAP = 128
WORDS_PER_SLOT = 32


def sentences(text: Column) -> Column:
    """Non-empty stripped pieces between sentence ends."""
    return F.filter(F.transform(F.split(text, SENTENCE_END), strip), lambda s: s != "")


def words(text: Column) -> Column:
    """Lower-case words."""
    return F.array_remove(F.split(F.lower(text), WORD_GAP), "")


def _word_counts(sorted_words: Column) -> Column:
    """``array<struct<w, n>>`` of the distinct words of a sorted array."""
    return let(
        run_starts(sorted_words, lambda w: w),
        lambda starts: F.transform(
            starts,
            lambda b, k: F.struct(
                F.get(sorted_words, b).alias("w"),
                (F.coalesce(F.get(starts, k + 1), F.size(sorted_words)) - b).alias("n"),
            ),
        ),
    )


def _slot(word: Column, slots: Column) -> Column:
    return F.pmod(F.xxhash64(word), slots).cast("int")


def _hash_table(counts: Column, slots: Column) -> Column:
    """``array<map<word, n>>`` with one small map per slot, so a lookup costs the same in any text.

    Slot and position of each word are packed into one whole number, which sorts fast. Position 0
    is taken for every slot, so the sorted array holds exactly one run per slot.
    """
    empty = F.transform(F.sequence(F.lit(0), slots - 1), lambda b: F.shiftleft(b.cast("long"), 32))
    placed = F.transform(
        counts, lambda e, k: F.shiftleft(_slot(e["w"], slots).cast("long"), 32) + k + 1
    )

    def split(packed: Column) -> Column:
        def entry(x: Column) -> Column:
            return F.get(counts, (x % (1 << 32)).cast("int") - 1)

        return let(
            run_starts(packed, lambda x: F.shiftright(x, 32)),
            lambda starts: F.transform(
                starts,
                lambda b, k: F.map_from_entries(
                    F.transform(
                        F.slice(
                            packed,
                            b + 2,
                            F.coalesce(F.get(starts, k + 1), F.size(packed)) - b - 1,
                        ),
                        entry,
                    )
                ),
            ),
        )

    return let(F.sort_array(F.concat(empty, placed)), split)


def _scores(found: Column) -> Column:
    """``array<struct<order, i>>``, one entry per sentence, best first."""

    def with_words(lists: Column) -> Column:
        counts = let(F.sort_array(F.flatten(lists)), _word_counts)
        return let(counts, lambda c: with_counts(lists, c))

    def with_counts(lists: Column, counts: Column) -> Column:
        few = let(
            F.map_from_entries(counts), lambda m: scored(lists, lambda w: F.element_at(m, w))
        )
        many = let((F.size(counts) / WORDS_PER_SLOT + 1).cast("int"), with_slots(lists, counts))
        return F.when(F.size(counts) <= WORDS_PER_MAP, few).otherwise(many)

    def with_slots(lists: Column, counts: Column):
        return lambda slots: let(
            _hash_table(counts, slots),
            lambda t: scored(lists, lambda w: F.element_at(F.get(t, _slot(w, slots)), w)),
        )

    def scored(lists: Column, count_of) -> Column:
        def score(own: Column) -> Column:
            return F.aggregate(
                F.array_distinct(own), F.lit(0).cast("long"), lambda a, w: a + count_of(w)
            )

        return F.transform(lists, lambda own, i: F.struct((-score(own)).alias("order"), i.alias("i")))

    return F.sort_array(let(F.transform(found, words), with_words))


def best_sentences(text: Column, k: int) -> Column:
    """The ``k`` best sentences in text order; ties go to the earlier sentence."""

    def pick(found: Column) -> Column:
        chosen = F.sort_array(F.transform(F.slice(_scores(found), 1, k), lambda s: s["i"]))
        return F.when(F.size(found) <= k, found).otherwise(
            F.transform(chosen, lambda i: F.get(found, i))
        )

    return let(sentences(text), pick)


def extractive_summary(text: Column, k: int = 3, joiner: str = SENTENCE_JOINER) -> Column:
    """The ``k`` best sentences joined by ``joiner``; ``''`` for NULL or a text without words."""
    return F.coalesce(F.array_join(best_sentences(text, k), joiner), F.lit(""))
