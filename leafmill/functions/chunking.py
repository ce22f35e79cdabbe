"""Chunking expressions: ``text -> array<string>`` without leaving the JVM and without a shuffle.

All three splitters work the same way. The text is cut into pieces, and one fold over the piece
*lengths* decides which ranges of pieces form a chunk. The fold carries only integers, so its state
does not grow with the text; the chunk strings are built once, at the end, from slices of the
pieces. The cost is linear in the length of the text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.binding import indexed, let
from leafmill.functions.text import PYTHON_WHITESPACE, strip

# Defaults of the splitters these expressions stand in for.
SEPARATOR = "\n\n"
SEPARATOR_SIZE = 4000
SEPARATOR_OVERLAP = 200
RECURSIVE_SEPARATORS = ("\n\n", "\n", " ", "")
RECURSIVE_SIZE = 4000
RECURSIVE_OVERLAP = 300
WRAP_WIDTH = 6000
TAB_WIDTH = 8

# The white space that reads as a space when wrapping, and the pattern of an unbreakable piece
# (a white-space run, a dash between words, or a word cut after a hyphen between letters).
WRAP_SPACE = r"[\t\n\x0B\f\r]"
_WORD = r"\p{L}\p{N}_"
_LETTER = r"[\p{L}\p{Nl}\p{No}_]"
_PUNCT = rf"[{_WORD}!\"'&.,?]"
_SPACE = r"[\t\n\x0B\f\r ]"
WRAP_PIECE = (
    rf"{_SPACE}+"
    rf"|(?<={_PUNCT})-{{2,}}(?=[{_WORD}])"
    rf"|[^\t\n\x0B\f\r ]+?(?:"
    rf"-(?:(?<={_LETTER}{{2}}-)|(?<={_LETTER}-{_LETTER}-))(?={_LETTER}-?{_LETTER})"
    rf"|(?={_SPACE}|\z)"
    rf"|(?<={_PUNCT})(?=-{{2,}}[{_WORD}]))"
)
# The same break positions as a zero-width test, for dash runs shorter than LONG_DASH.
LONG_DASH = 100
WRAP_BREAK = (
    rf"(?:(?<=[^ ])(?= |\z)"
    rf"|(?<= )(?=[^ ]|\z)"
    rf"|(?<=-)(?:(?<={_LETTER}{{2}}-)|(?<={_LETTER}-{_LETTER}-))(?={_LETTER}-?{_LETTER})"
    rf"|(?<={_PUNCT})(?=-{{2,}}[{_WORD}])"
    rf"|(?<=--)(?=[{_WORD}])(?<={_PUNCT}-{{2,{LONG_DASH - 1}}}))"
)
# White space to Python that is not a wrapping space.
ODD_SPACE = (
    "[" + "".join(c for c in PYTHON_WHITESPACE if c not in "\t\n\x0b\x0c\r ") + "]"
)

# Appending copies an array, so found ranges are kept in full blocks of this many and a last one.
_BLOCK = 512
_RANGES = "array<struct<a:int,b:int,whole:boolean>>"


def _no_ranges() -> Column:
    return F.struct(
        F.array().cast(f"array<{_RANGES}>").alias("full"), F.array().cast(_RANGES).alias("last")
    )


def _push(out: Column, span: Column) -> Column:
    """``out`` with one more range. ``out`` is used several times: pass a bound variable."""
    return F.when(
        F.size(out["last"]) < _BLOCK,
        F.struct(out["full"].alias("full"), F.array_append(out["last"], span).alias("last")),
    ).otherwise(
        F.struct(F.array_append(out["full"], out["last"]).alias("full"), F.array(span).alias("last"))
    )


def _all_ranges(out: Column) -> Column:
    return F.flatten(F.array_append(out["full"], out["last"]))


def _range(first: Column, last: Column, whole: bool = False) -> Column:
    return F.struct(
        first.cast("int").alias("a"), last.cast("int").alias("b"), F.lit(whole).alias("whole")
    )


def _state(out: Column, start: Column, total: Column) -> Column:
    return F.struct(
        out.alias("out"), start.cast("int").alias("start"), total.cast("int").alias("total")
    )


def _carry_over(
    lengths: Column, state: Column, piece: Column, joint: int, size: int, overlap: int
) -> Column:
    """Longest run of pieces just before ``piece`` that the next chunk repeats.

    The run, joined, must not exceed ``overlap`` and must leave room for ``piece``. Returned as
    ``struct<first, total, open>``.
    """
    nothing = F.struct(
        piece["i"].cast("int").alias("first"), F.lit(0).alias("total"), F.lit(True).alias("open")
    )
    if overlap == 0:
        return nothing

    def extend(run: Column, j: Column) -> Column:
        longer = run["total"] + F.get(lengths, j) + F.when(run["total"] > 0, joint).otherwise(0)
        fits = run["open"] & (longer <= overlap) & (longer + joint + piece["v"] <= size)
        return F.struct(
            F.when(fits, j).otherwise(run["first"]).alias("first"),
            F.when(fits, longer).otherwise(run["total"]).alias("total"),
            fits.alias("open"),
        )

    backwards = F.sequence(piece["i"] - 1, state["start"], F.lit(-1))
    return F.when(
        piece["i"] > state["start"], F.aggregate(backwards, nothing, extend)
    ).otherwise(nothing)


def _pack(lengths: Column, joint: int, size: int, overlap: int, isolate_from: int | None) -> Column:
    """Greedy ranges of pieces; pieces of ``isolate_from`` characters or more stay alone.

    ``joint`` is the length of the text put between two pieces of one chunk.
    """

    def flushed(state: Column, piece: Column) -> Column:
        return F.when(
            piece["i"] > state["start"],
            _push(state["out"], _range(state["start"], piece["i"] - 1)),
        ).otherwise(state["out"])

    def step(state: Column, piece: Column) -> Column:
        grown = state["total"] + piece["v"] + F.when(piece["i"] > state["start"], joint).otherwise(0)

        def restart(run: Column) -> Column:
            again = F.when(run["first"] < piece["i"], joint).otherwise(0)
            return _state(flushed(state, piece), run["first"], run["total"] + piece["v"] + again)

        packed = F.when(grown <= size, _state(state["out"], state["start"], grown)).otherwise(
            let(_carry_over(lengths, state, piece, joint, size, overlap), restart)
        )
        if isolate_from is None:
            return packed
        alone = _state(
            let(
                flushed(state, piece), lambda o: _push(o, _range(piece["i"], piece["i"], whole=True))
            ),
            piece["i"] + 1,
            F.lit(0),
        )
        return F.when(piece["v"] >= isolate_from, alone).otherwise(packed)

    def finish(state: Column) -> Column:
        last = F.size(lengths) - 1
        closed = F.when(
            state["start"] <= last, _push(state["out"], _range(state["start"], last))
        ).otherwise(state["out"])
        return let(closed, _all_ranges)

    start = _state(_no_ranges(), F.lit(0), F.lit(0))
    return F.aggregate(indexed(lengths, lambda n: n), start, step, finish)


def _joined(pieces: Column, span: Column, sep: str) -> Column:
    return F.array_join(F.slice(pieces, span["a"] + 1, span["b"] - span["a"] + 1), sep)


def _non_empty(items: Column) -> Column:
    return F.filter(items, lambda x: x != "")


def _split_on(text: Column, sep: str) -> Column:
    return F.split(text, re.escape(sep) if sep else "", -1)


def _check(size: int, overlap: int) -> None:
    if size < 1 or overlap < 0 or overlap > size:
        raise ValueError("need size >= 1 and 0 <= overlap <= size")


def chunk_separator(
    text: Column,
    sep: str = SEPARATOR,
    size: int = SEPARATOR_SIZE,
    overlap: int = SEPARATOR_OVERLAP,
) -> Column:
    """Split at ``sep`` and pack the pieces greedily into chunks of at most ``size`` characters.

    Empty pieces are dropped, a piece longer than ``size`` becomes a chunk of its own, chunks are
    stripped and blank chunks dropped. Up to ``overlap`` characters of whole pieces are repeated
    at the start of the next chunk.
    """
    _check(size, overlap)

    def pack(pieces: Column) -> Column:
        ranges = let(
            F.transform(pieces, F.length),
            lambda lengths: _pack(lengths, len(sep), size, overlap, None),
        )
        return _non_empty(F.transform(ranges, lambda r: strip(_joined(pieces, r, sep))))

    return let(_non_empty(_split_on(text, sep)), pack)


def _fixed_width(text: Column, size: int, overlap: int) -> Column:
    """Every ``size`` characters, each window starting ``size - overlap`` after the last."""
    stride = size - overlap
    if stride < 1:
        raise ValueError("fixed-width splitting needs overlap < size")
    windows = F.greatest(F.ceil((F.length(text) - size) / stride), F.lit(0)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), windows),
        lambda k: F.substring(text, k * stride + 1, F.lit(size)),
    )


def _recursive(
    text: Column, seps: Sequence[str], size: int, overlap: int, stripped: bool
) -> Column:
    finish = strip if stripped else (lambda x: x)
    sep, rest = seps[0], seps[1:]
    if sep == "":
        return _non_empty(F.transform(_fixed_width(text, size, overlap), finish))

    def expand(pieces: Column, span: Column) -> Column:
        short = F.array(finish(_joined(pieces, span, "")))
        piece = F.get(pieces, span["a"])
        long = (
            let(piece, lambda p: _recursive(p, rest, size, overlap, stripped))
            if rest
            else F.array(piece)
        )
        return F.when(span["whole"], long).otherwise(short)

    def pack(pieces: Column) -> Column:
        ranges = let(
            F.transform(pieces, F.length), lambda lengths: _pack(lengths, 0, size, overlap, size)
        )
        return _non_empty(F.flatten(F.transform(ranges, lambda r: expand(pieces, r))))

    parts = _split_on(text, sep)
    kept = F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit(sep), x)))
    return let(_non_empty(kept), pack)


def chunk_recursive(
    text: Column,
    size: int = RECURSIVE_SIZE,
    overlap: int = RECURSIVE_OVERLAP,
    seps: Sequence[str] = RECURSIVE_SEPARATORS,
    stripped: bool = True,
) -> Column:
    """Split at the first separator; pieces of ``size`` characters or more go to the next one.

    Each piece keeps the separator before it. Runs of short pieces are packed greedily with
    ``overlap``; runs do not reach across a long piece. The empty separator, last in the default
    list, cuts at fixed width. With ``stripped=False`` and ``overlap=0`` the chunks concatenate
    back to the text. Each separator nests the expression deeper: more than seven need a larger
    ``spark.sql.analyzer.maxIterations``.
    """
    _check(size, overlap)
    if size < 2 or not seps:
        raise ValueError("need size >= 2 and at least one separator")
    return let(text, lambda t: _recursive(t, tuple(seps), size, overlap, stripped))


def _expand_tabs(text: Column) -> Column:
    """Fill up to the next tab stop. Only columns are carried along: a part ends where the stop
    before it, a multiple of the tab width, plus its own length says."""

    def per_line(line: Column) -> Column:
        def filled(part: Column, i: Column) -> Column:
            # Every part but the last is followed by blanks up to the next stop.
            blanks = F.repeat(F.lit(" "), F.lit(TAB_WIDTH) - F.length(part) % TAB_WIDTH)
            return F.concat(part, blanks)

        return let(
            F.split(line, "\t", -1),
            lambda parts: F.concat(
                F.array_join(F.transform(F.slice(parts, 1, F.size(parts) - 1), filled), ""),
                F.element_at(parts, -1),
            ),
        )

    lines = F.split(text, r"(?<=[\n\r])", -1)
    return F.when(
        F.contains(text, F.lit("\t")), F.array_join(F.transform(lines, per_line), "")
    ).otherwise(text)


def _trim_margin(text: Column, width: int) -> Column:
    """A first-line margin wider than ``width`` loses whole lines of blanks."""
    margin = F.length(text) - F.length(F.ltrim(text))
    kept = (margin - 1) % width + 1
    return F.when(
        margin > width, F.concat(F.repeat(F.lit(" "), kept), F.ltrim(text))
    ).otherwise(text)


def _wrap_ranges(pieces: Column, lengths: Column, width: int) -> Column:
    """Greedy lines over unbreakable pieces; a blank piece at a line break is dropped."""

    def blank(i: Column) -> Column:
        return strip(F.get(pieces, i)) == ""

    def closed(out: Column, start: Column, last: Column) -> Column:
        end = F.when((last >= start) & blank(last), last - 1).otherwise(last)
        return F.when(end >= start, _push(out, _range(start, end))).otherwise(out)

    def step(state: Column, piece: Column) -> Column:
        grown = state["total"] + piece["v"]

        def next_line(out: Column) -> Column:
            drop = (F.size(out["last"]) > 0) & blank(piece["i"])
            return _state(
                out,
                F.when(drop, piece["i"] + 1).otherwise(piece["i"]),
                F.when(drop, 0).otherwise(piece["v"]),
            )

        return F.when(grown <= width, _state(state["out"], state["start"], grown)).otherwise(
            let(closed(state["out"], state["start"], piece["i"] - 1), next_line)
        )

    return F.aggregate(
        indexed(lengths, lambda n: n),
        _state(_no_ranges(), F.lit(0), F.lit(0)),
        step,
        lambda state: let(
            closed(state["out"], state["start"], F.size(lengths) - 1), _all_ranges
        ),
    )


def _blank(text: Column) -> Column:
    return strip(text) == ""


def _rooms(pieces: Column, width: int) -> Column:
    """For each piece longer than a line the characters that the line it starts on has left, else -1.

    The same greedy fold as :func:`_wrap_ranges` without its ranges. The state says how full the line
    is, how many pieces stand in it, whether its last one is blank, and whether a line was closed.
    """

    def line(out, total, held, last_blank, closed) -> Column:
        return F.struct(
            out.alias("out"),
            total.cast("int").alias("total"),
            held.cast("int").alias("held"),
            last_blank.alias("last_blank"),
            closed.alias("closed"),
        )

    def step(state: Column, piece: Column) -> Column:
        n, blank = F.length(piece), _blank(piece)
        grown = state["total"] + n

        def noted(room: Column) -> Column:
            return _push(state["out"], _range(room, room))

        def long_word(room: Column) -> Column:
            # The last part of the word starts a line, or is dropped there if it is white space; of a
            # white-space run the last part is all that does not fit.
            last = F.when(blank, n - room).otherwise((n - room - 1) % width + 1)
            front, end = F.substring(piece, F.lit(1), n - last), F.substring(piece, n - last + 1, last)
            closed = state["closed"] | (state["held"] > 0) | ~_blank(front)
            dropped = closed & _blank(end)
            return line(
                noted(room),
                F.when(dropped, 0).otherwise(last),
                F.when(dropped, 0).otherwise(1),
                _blank(end) & ~dropped,
                closed,
            )

        def next_line(closed: Column) -> Column:
            dropped = closed & blank
            return line(
                noted(F.lit(-1)),
                F.when(dropped, 0).otherwise(n),
                F.when(dropped, 0).otherwise(1),
                blank & ~dropped,
                closed,
            )

        kept = state["held"] - F.when(state["last_blank"], 1).otherwise(0)
        return (
            F.when(n > width, long_word(F.greatest(F.lit(width) - state["total"], F.lit(0))))
            .when(
                grown <= width,
                line(noted(F.lit(-1)), grown, state["held"] + 1, blank, state["closed"]),
            )
            .otherwise(next_line(state["closed"] | (kept > 0)))
        )

    start = line(_no_ranges(), F.lit(0), F.lit(0), F.lit(False), F.lit(False))
    rooms = F.aggregate(pieces, start, step, lambda state: _all_ranges(state["out"]))
    return F.transform(rooms, lambda r: r["a"])


def _wrap_by_pieces(flat: Column, width: int) -> Column:
    """Fold over the pieces: handles every text."""

    def cut_long(pieces: Column) -> Column:
        def too_long(x: Column) -> Column:
            return F.length(x) > width

        def parts(x: Column, room: Column) -> Column:
            """What fills the line, then lines. A full line receives an empty part: it, and not the
            white space before it, is then the blank piece dropped at the line break."""
            rest = F.substring(x, room + 1, F.length(x))
            lines = F.regexp_extract_all(rest, F.lit(rf"(?s).{{1,{width}}}"), F.lit(0))
            after = F.when(_blank(x), F.array(rest)).otherwise(lines)
            return F.array_prepend(after, F.substring(x, F.lit(1), room))

        def cut(rooms: Column) -> Column:
            return F.flatten(
                F.transform(
                    pieces,
                    lambda x, i: F.when(too_long(x), parts(x, F.get(rooms, i))).otherwise(F.array(x)),
                )
            )

        return F.when(F.exists(pieces, too_long), let(_rooms(pieces, width), cut)).otherwise(pieces)

    def wrap(pieces: Column) -> Column:
        ranges = let(
            F.transform(pieces, F.length), lambda lengths: _wrap_ranges(pieces, lengths, width)
        )
        return F.transform(ranges, lambda r: _joined(pieces, r, ""))

    pieces = F.regexp_extract_all(_trim_margin(flat, width), F.lit(WRAP_PIECE), F.lit(0))
    return let(let(pieces, cut_long), wrap)


def _wrap_by_lines(flat: Column, width: int) -> Column:
    """One regular-expression match per line: several times faster than the fold."""
    line = rf"(?s)(?:\A| *+)(.{{1,{width}}}{WRAP_BREAK})"
    lines = F.regexp_extract_all(flat, F.lit(line), F.lit(1))
    return _non_empty(F.transform(lines, lambda x: F.rtrim(x)))


def chunk_wrap(text: Column, width: int = WRAP_WIDTH) -> Column:
    """Wrap at words into lines of at most ``width`` characters.

    Tabs are expanded and every white-space character becomes a space; runs inside a line are
    kept, the one at a line break is dropped. Lines may break after a hyphen between letters. A
    word longer than ``width`` is cut so that it fills the line it starts on.

    Texts with a word (or a margin) longer than a line, a piece made of unusual white space, or an
    extreme run of dashes take the piece-by-piece fold; all others take one match per line.
    """
    if width < 1:
        raise ValueError("need width >= 1")

    def wrap(flat: Column) -> Column:
        unusual = (
            F.rlike(flat, F.lit(f"[^ ]{{{width + 1}}}|\\A {{{width}}}"))
            | F.rlike(flat, F.lit(ODD_SPACE))
            | F.contains(flat, F.lit("-" * LONG_DASH))
        )
        return F.when(unusual, _wrap_by_pieces(flat, width)).otherwise(_wrap_by_lines(flat, width))

    return let(F.regexp_replace(_expand_tabs(text), WRAP_SPACE, " "), wrap)
