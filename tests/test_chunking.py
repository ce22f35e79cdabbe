"""Chunkers against plain Python loops on random texts."""

import random
import textwrap

import pytest
from pyspark.sql import functions as F

from leafmill.functions import chunking, sql, summary, text


def _texts(alphabet, count, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(count)]


def _run(spark, texts, expression):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in frame.select(expression(F.col("t"))).collect()]


def _greedy(pieces, joiner, size, overlap):
    """Chunks of whole pieces; try every start to find the longest repetition that is allowed."""
    chunks, start = [], 0
    for i in range(len(pieces)):
        if i > start and len(joiner.join(pieces[start : i + 1])) > size:
            chunks.append(joiner.join(pieces[start:i]))
            allowed = [
                s
                for s in range(start, i)
                if len(joiner.join(pieces[s:i])) <= overlap
                and len(joiner.join(pieces[s : i + 1])) <= size
            ]
            start = allowed[0] if allowed else i
    if start < len(pieces):
        chunks.append(joiner.join(pieces[start:]))
    return chunks


def _by_separator(text, sep, size, overlap):
    chunks = _greedy([p for p in text.split(sep) if p], sep, size, overlap)
    return [c.strip() for c in chunks if c.strip()]


def _by_levels(text, seps, size, overlap, stripped=True):
    sep, rest = seps[0], seps[1:]
    if sep == "":
        pieces = list(text)
    else:
        head, *tail = text.split(sep)
        pieces = [p for p in [head, *(sep + x for x in tail)] if p]
    chunks, run = [], []
    for piece in [*pieces, None]:
        if piece is not None and len(piece) < size:
            run.append(piece)
            continue
        packed = _greedy(run, "", size, overlap)
        chunks += [c.strip() for c in packed] if stripped else packed
        run = []
        if piece is not None:
            chunks += _by_levels(piece, rest, size, overlap, stripped) if rest else [piece]
    return [c for c in chunks if c]


@pytest.mark.parametrize("size,overlap", [(10, 0), (10, 4), (25, 10), (7, 7), (1, 0)])
@pytest.mark.parametrize("sep", ["\n\n", "\n", " ", "|"])
def test_separator(spark, sep, size, overlap):
    texts = _texts(["a", "bc", "é", "\U0001f600", "\n", "\n\n", " ", "|", "longpiece"], 150, 40, size)
    got = _run(spark, texts, lambda t: chunking.chunk_separator(t, sep, size, overlap))
    assert got == [_by_separator(t, sep, size, overlap) for t in texts]


@pytest.mark.parametrize("size,overlap", [(10, 0), (10, 4), (25, 12), (5, 4), (2, 0), (60, 20)])
def test_recursive(spark, size, overlap):
    texts = _texts(["a", "bc", "é", "\U0001f600", "\n", "\n\n", " ", "x" * 12, "y" * 30], 250, 40, size)
    got = _run(spark, texts, lambda t: chunking.chunk_recursive(t, size, overlap))
    assert got == [_by_levels(t, chunking.RECURSIVE_SEPARATORS, size, overlap) for t in texts]


def test_recursive_without_last_resort(spark):
    texts = ["a" * 30 + " b", "short", "", "a\n" * 20]
    got = _run(spark, texts, lambda t: chunking.chunk_recursive(t, 10, 2, ("\n", " ")))
    assert got == [_by_levels(t, ("\n", " "), 10, 2) for t in texts]


def test_recursive_is_lossless_without_overlap(spark):
    texts = _texts(["a", "bc", "\n", "\n\n", " ", "x" * 15], 200, 40, 9)
    got = _run(spark, texts, lambda t: chunking.chunk_recursive(t, 10, 0, stripped=False))
    assert ["".join(c) for c in got] == texts
    assert all(len(c) <= 10 for chunks in got for c in chunks)


class _FillLines(textwrap.TextWrapper):
    """Words longer than a line fill the rest of it, also where they hold hyphens."""

    def _handle_long_word(self, pending, line, length, width):
        room = 1 if width < 1 else width - length
        line.append(pending[-1][:room])
        pending[-1] = pending[-1][room:]


WRAP_ALPHABET = [
    "a", "bc", "def", "-", "--", "---", " ", "  ", "\t", "\n", "\r", "é", "1", ".", "!",
    "x-y", "ab-cd", "foo", "\U0001f600", "_", '"', "'",
]


@pytest.mark.parametrize("width", [1, 2, 5, 9, 13, 40])
def test_wrap(spark, width):
    texts = _texts(WRAP_ALPHABET, 600, 40, width)
    expected = [_FillLines(width).wrap(t) for t in texts]
    assert _run(spark, texts, lambda t: chunking.chunk_wrap(t, width)) == expected


def test_wrap_unusual_space(spark):
    texts = ["a   b", " ", "word \x1c\x1c word word", " a b c d e f g"]
    expected = [_FillLines(6).wrap(t) for t in texts]
    assert _run(spark, texts, lambda t: chunking.chunk_wrap(t, 6)) == expected


def test_wrap_long_dashes(spark):
    texts = ["a" + "-" * 150 + "b c d", "x" + "-" * 99 + "y", "x" + "-" * 98 + "y z"]
    expected = [_FillLines(300).wrap(t) for t in texts]
    assert _run(spark, texts, lambda t: chunking.chunk_wrap(t, 300)) == expected


def test_null_and_defaults(spark):
    for expression in (chunking.chunk_separator, chunking.chunk_recursive, chunking.chunk_wrap):
        assert _run(spark, [None, ""], expression) == [None, []]
    words = "word " * 3000
    assert _run(spark, [words], chunking.chunk_wrap) == [textwrap.wrap(words, 6000)]
    assert all(len(c) <= 4000 for c in _run(spark, [words], chunking.chunk_recursive)[0])


def test_separator_is_literal(spark):
    assert _run(spark, ["a.b.c", "a|b"], lambda t: chunking.chunk_separator(t, ".", 1, 0)) == [
        ["a", "b", "c"],
        ["a|b"],
    ]


def test_bad_sizes():
    with pytest.raises(ValueError):
        chunking.chunk_separator(F.lit("x"), " ", 10, 11)
    with pytest.raises(ValueError):
        chunking.chunk_wrap(F.lit("x"), 0)
    with pytest.raises(ValueError):
        chunking.chunk_recursive(F.lit("x"), 10, 10)


def test_long_text_is_linear_enough(spark):
    """A text of some 2 MB in one row."""
    text = " ".join(f"w{n % 997}" for n in range(400_000))
    sizes = [
        len(_run(spark, [text], e)[0]) for e in (chunking.chunk_recursive, chunking.chunk_wrap)
    ]
    assert sizes[1] == len(textwrap.wrap(text, 6000))
    assert sizes[0] >= len(text) // 4000


def test_many_chunks_in_one_text(spark):
    """More chunks than one block of ranges holds, in every fold."""
    text = "\n".join(f"w{n}" for n in range(20_000))
    assert _run(spark, [text], lambda t: chunking.chunk_separator(t, "\n", 8, 0)) == [
        _by_separator(text, "\n", 8, 0)
    ]
    got = _run(spark, [text], lambda t: chunking.chunk_recursive(t, 12, 4))
    assert got == [_by_levels(text, chunking.RECURSIVE_SEPARATORS, 12, 4)]
    odd = text + "\xa0"
    assert _run(spark, [odd], lambda t: chunking.chunk_wrap(t, 12)) == [_FillLines(12).wrap(odd)]


def test_sql_functions_equal_the_expressions(spark):
    rows = [
        "a b\n\nc", "it's (x) +(y) =(z) 'quoted' and(b) \\\\ é", "", None, "w " * 3000 + "x" * 9000,
        "One. Two two. Three three three!",
    ]
    frame = spark.createDataFrame([(n, t) for n, t in enumerate(rows)], "n int, text string")
    sql.register(spark)
    for name, chunks in (
        ("chunk_separator", chunking.chunk_separator),
        ("chunk_recursive", chunking.chunk_recursive),
        ("chunk_wrap", chunking.chunk_wrap),
    ):
        got = spark.sql(
            f"SELECT d.n, c.pos, c.chunk FROM {{docs}} d, LATERAL {name}(d.text) c", docs=frame
        )
        want = frame.select("n", F.posexplode(chunks(F.col("text"))).alias("pos", "chunk"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Generate posexplode" in plan and "Join" not in plan and "Exchange" not in plan
    got = spark.sql(
        "SELECT n, clean_text(text), token_count(text), extractive_summary(text) FROM {docs}", docs=frame
    )
    t = F.col("text")
    want = frame.select("n", text.clean_text(t), text.token_count(t), summary.extractive_summary(t))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_long_words_are_cut_by_arithmetic(spark):
    """A word of a million characters fills the line it starts on; as one array element, not a million."""
    word = "é" * 1_000_003
    frame = spark.createDataFrame([("x y " + word + " z",)], "t string")
    got = frame.select(chunking.chunk_wrap(F.col("t"), 6000)).first()[0]
    first = word[: 6000 - 4]
    rest = [word[k : k + 6000] for k in range(len(first), len(word), 6000)]
    assert got == ["x y " + first, *rest[:-1], rest[-1] + " z"]


def test_long_runs_of_odd_white_space(spark):
    rng = random.Random(3)

    class Plain(textwrap.TextWrapper):
        """Long words are cut where the line ends, also before a hyphen."""

        def _handle_long_word(self, reversed_chunks, cur_line, cur_len, width):
            left = width - cur_len
            cur_line.append(reversed_chunks[-1][:left])
            reversed_chunks[-1] = reversed_chunks[-1][left:]

    texts = [
        "".join(rng.choice("ab - \u00e9\u00a0\t.") if rng.random() < 0.5 else rng.choice("abcde") for _ in range(80))
        for _ in range(150)
    ]
    for width in (3, 7, 20):
        got = _run(spark, texts, lambda t: chunking.chunk_wrap(t, width))
        assert got == [Plain(width=width).wrap(t) for t in texts]
