"""Secret scans: three patterns, and Markov models of random strings against ordinary identifiers.

The patterns find secrets by their form. Two character models of order one then look at every other
long token: one is counted on the strings that the patterns found (random), the other on all
tokens outside of them (ordinary). A token is a secret if its log-likelihood ratio exceeds the log
odds against a secret, ``evidence``. The counts cover all rows and have a fixed size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import id_text, id_type, map_rows, rewrite, small_batches

KEYS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ACCESS_CHARS, HEX_CHARS, VALUE_CHARS = 16, 32, 8
KINDS = ("assign", "access", "hex", "model")
#: Tokens that the models see and judge.
SEEN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
#: Weight of a character's overall frequency against the counts of its context.
RARE = 200.0
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1  # and the state before the first character
CODE = np.zeros(256, dtype=np.int64)
for _place, _char in enumerate(ALPHABET):
    CODE[ord(_char)] = _place + 1

Span = tuple[int, int, int]  # start, end, kind


def pattern_spans(text: str) -> tuple[list[Span], list[str]]:
    """Spans that the patterns find, by start, then kind; and the secret strings in them."""
    spans, values = [], []
    low = text.lower()  # only to see quickly whether a key can be there
    if any(key in low for key in KEYS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= VALUE_CHARS:
                spans.append((m.start(), m.end(), 0))
                values.append(m[2])
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_CHARS:
                spans.append((m.start(), m.end(), 1))
                values.append(m[0])
    return spans, values


def scan(text: str) -> tuple[list[Span], list[str], list[tuple[int, str]]]:
    """Pattern spans, their strings, and the other tokens with their starts."""
    spans, values = pattern_spans(text)
    tokens = [(m.start(), m[0]) for m in SEEN.finditer(text)]
    for start, token in tokens:  # a run of hex digits lies within one token
        if len(token) >= HEX_CHARS:
            for m in HEX.finditer(token):
                if m.end() - m.start() >= HEX_CHARS:
                    spans.append((start + m.start(), start + m.end(), 2))
                    values.append(m[0])
    if spans:
        spans.sort(key=lambda s: (s[0], s[2]))
        tokens = [
            (a, t) for a, t in tokens if not any(s < a + len(t) and a < e for s, e, _ in spans)
        ]
    return spans, values, tokens


def transitions(tokens: list[str]) -> np.ndarray:
    """Counts of character after character, flat; the state 0 stands before each token."""
    raw = np.frombuffer(("\0" + "\0".join(tokens)).encode("latin-1", "replace"), dtype=np.uint8)
    codes = CODE[raw]
    pairs = codes[:-1] * STATES + codes[1:]
    return np.bincount(pairs[codes[1:] > 0], minlength=STATES * STATES)


def count(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``random, pair, n``: transitions of random strings and of ordinary tokens over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, STATES * STATES), dtype=np.int64)
        for batch in small_batches(batches):
            found, plain = [], []
            for text in batch.column(1).to_pylist():
                if text:
                    _, values, tokens = scan(text)
                    found += [v.replace(".", "-") for v in values]
                    plain += [t for _, t in tokens]
            totals[1] += transitions(found)
            totals[0] += transitions(plain)
        kind, pair = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind == 1), pa.array(pair), pa.array(totals[kind, pair])],
            ["random", "pair", "n"],
        )

    rows = map_rows(id_text(df, id_col, text_col), run, "random boolean, pair long, n long")
    return rows.groupBy("random", "pair").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray | None:
    """Log-likelihood ratio of each transition (STATES x STATES); None if no pattern matched."""
    totals = np.zeros((2, STATES, STATES))
    for row in count(df, id_col, text_col).collect():  # 2 x STATES^2 rows at most
        totals[int(row["random"]), row["pair"] // STATES, row["pair"] % STATES] = row["n"]
    if not totals[1].any():
        return None
    # A random string may use any character next, so its model keeps a share of all. A context that
    # ordinary tokens hardly have is judged by how often they have the next character at all: else
    # a few secrets among them would pass for ordinary.
    even = 1.0 / (STATES - 1)
    seen = totals[1].sum(axis=1, keepdims=True)
    random = 0.8 * (totals[1] + even) / (seen + 1.0) + 0.2 * even
    usual = totals[0].sum(axis=0) + 0.1
    usual /= usual.sum()
    plain = (totals[0] + RARE * usual) / (totals[0].sum(axis=1, keepdims=True) + RARE)
    return np.log(random) - np.log(plain)


def ratios(tokens: list[str], model: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each token: positive if it looks random."""
    raw = np.frombuffer(("\0" + "\0".join(tokens)).encode("latin-1", "replace"), dtype=np.uint8)
    codes = CODE[raw]
    steps = np.where(codes[1:] > 0, model[codes[:-1], codes[1:]], 0.0)
    # A token's steps begin at the mark before it; the step onto the next mark counts nothing.
    starts = np.cumsum([0, *(len(t) + 1 for t in tokens[:-1])])
    return np.add.reduceat(steps, starts)


def model_spans(tokens: list[tuple[int, str]], model: np.ndarray, evidence: float) -> list[Span]:
    """Every token whose ratio exceeds the evidence, whatever its length."""
    if not tokens:
        return []
    found = np.flatnonzero(ratios([t for _, t in tokens], model) > evidence)
    return [(tokens[i][0], tokens[i][0] + len(tokens[i][1]), 3) for i in found.tolist()]


def find(
    df: DataFrame,
    model: np.ndarray | None,
    evidence: float = 14.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, base, spans, redacted`` per row.

    ``base`` and ``spans`` are arrays of ``kind, start, end`` (code points, end exclusive) by start,
    then kind; ``spans`` holds the base spans and those of the models. ``redacted`` is the text with
    each covered stretch replaced by ``[secret]``; NULL stays NULL, and a NULL or empty text has no
    span. Without a model there are base spans only. Rows are independent of each other. No shuffle.
    """
    kind = id_type(df, id_col)
    shared = df.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def shown(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": e} for a, e, k in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = shared.value
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            base, every, clean = [], [], []
            for text in texts:
                spans, _, tokens = scan(text) if text else ([], [], [])
                more = spans if ratios is None else spans + model_spans(tokens, ratios, evidence)
                more = sorted(more, key=lambda s: (s[0], s[2]))
                base.append(shown(spans))
                every.append(shown(more))
                clean.append(redact(text, more) if more else text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(base, pa.list_(span)),
                    pa.array(every, pa.list_(span)),
                    pa.array(clean, pa.string()),
                ],
                ["id", "base", "spans", "redacted"],
            )

    item = "array<struct<kind:string,start:bigint,end:bigint>>"
    schema = f"id {kind}, base {item}, spans {item}, redacted string"
    return map_rows(id_text(df, id_col, text_col), run, schema)


def redact(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """The text with each stretch that spans cover replaced by the mark."""
    out, at = [], 0
    for start, end, _ in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redacted(
    df: DataFrame, model: np.ndarray | None, evidence: float = 14.0, text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``df``, the text without what ``find`` finds."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def cleaning():
        ratios = shared.value

        def clean(text: str | None) -> str | None:
            if not text:
                return text
            spans, _, tokens = scan(text)
            if ratios is not None:
                spans = spans + model_spans(tokens, ratios, evidence)
            return redact(text, sorted(spans, key=lambda s: (s[0], s[2]))) if spans else text

        return lambda texts: ([clean(t) for t in texts], [True] * len(texts))

    return rewrite(df, cleaning, text_col)
