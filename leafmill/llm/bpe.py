"""Byte-pair encoding by backtracking over longest token matches, and decoding by an offset table.

The vocabulary comes from a file of the public ``tokenizers`` format (byte-level, ids of merged
tokens in merge order). The path is a parameter; the file must be readable at that path on every
worker, as an installed package's data is.

Encoding: the usual byte-level pattern cuts a text into pieces. An Aho-Corasick automaton over all
tokens gives the longest match at a byte, and with it the longest token that starts there. The
encoder walks from left to right over a piece, takes the longest token that is compatible with the one before, else the next
shorter prefix of it, and steps back when none is left; a position found dead is never entered
again, so the work is linear in the piece. Two tokens are compatible if merging their joined bytes
yields just these two, which is read off the merge tree and kept in a table. A token sequence in
which all neighbours are compatible is the one the merges give.

Decoding: all token bytes lie in one array with a table of offsets; ids are turned into byte
positions by array arithmetic.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import id_text, id_type, map_rows, small_batches

# The pattern of byte-level vocabularies and the visible stand-ins of bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Entries of one generation of a worker's table; losing an entry costs time only.
CACHE_ENTRIES = 250_000
CACHE_CHARS = 48


class Recent:
    """Two generations of remembered values: what is still in use outlives a change of generation."""

    def __init__(self, entries: int | None = None) -> None:
        self.entries = entries or CACHE_ENTRIES
        self.new: dict = {}
        self.old: dict = {}

    def recall(self, key):
        """A value of the older generation, moved to the newer one; None if unknown."""
        value = self.old.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self.new) >= self.entries:
            self.old = dict(self.new)
            self.new.clear()
        self.new[key] = value


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in the vocabulary file -> the byte."""
    hidden = [b for b in range(256) if b not in set(VISIBLE)]
    return {chr(b): b for b in VISIBLE} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """One vocabulary: automaton, compatibility table, offset table."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        alphabet = byte_alphabet()
        vocabulary = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for shown, token in vocabulary.items():
            self.tokens[token] = bytes(alphabet[c] for c in shown)
        ids = {t: i for i, t in enumerate(self.tokens) if t}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for merge in data["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocabulary[left], vocabulary[right]
            self.merged[pair] = token = vocabulary[left + right]
            self.parts[token] = pair
        self.size = [len(t) for t in self.tokens]
        self.most = max(self.size)
        self.shorter = [-1] * size  # the longest token that is a proper prefix
        for token, text in enumerate(self.tokens):
            self.shorter[token] = next(
                (ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in ids), -1
            )
        self.automaton = ahocorasick.Automaton()
        self.begun: dict[str, int] = {}  # beginning of a token -> longest token in that beginning
        for text, token in sorted(ids.items()):  # a beginning that is a token comes before it
            self.automaton.add_word(text.decode("latin-1"), token)
            best = -1
            for n in range(1, len(text) + 1):
                best = ids.get(text[:n], best)
                self.begun[text[:n].decode("latin-1")] = best
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}  # the compatibility table, filled as pairs are met
        for text, token in self.special.items():
            self.tokens[token] = text.encode()
        self.blob = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.find = regex.compile(PATTERN).findall
        self.cut_special = (
            re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        )
        self.chunks = Recent()
        self.pieces = Recent()

    # --- encoding ---------------------------------------------------------------------------

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave exactly these two tokens of their joined bytes.

        The bytes on the two sides of the border meet along the right edge of the left token's
        merge tree and the left edge of the right one's. The pair stays apart unless some pair of
        nodes that existed side by side merges earlier than either of them was consumed.
        """
        a, b, before, fits = left, right, len(self.size), True
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < before:
                fits = False
                break
            # Undo the later of the two merges; a single byte cannot be undone.
            if a > b and a in self.parts:
                before, a = a, self.parts[a][1]
            elif b in self.parts:
                before, b = b + 1, self.parts[b][0]
            elif a in self.parts:
                before, a = a, self.parts[a][1]
            else:
                break
        self.fits[left << 32 | right] = fits
        return fits

    def encode_piece(self, piece: str) -> list[int]:
        """Token ids of one piece of the pattern."""
        text = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1")
        end_of_text, size, shorter, fits = len(text), self.size, self.shorter, self.fits
        reach, begun = self.automaton.longest_prefix, self.begun
        chosen: list[int] = []
        alive = [True] * (end_of_text + 1)
        at, rest = 0, text[: self.most]
        token = begun[rest[: reach(rest)]]
        while at < end_of_text:
            while token >= 0:
                end = at + size[token]
                if alive[end]:
                    if not chosen:
                        break
                    fit = fits.get(chosen[-1] << 32 | token)
                    if fit is None:
                        fit = self.compatible(chosen[-1], token)
                    if fit:
                        break
                token = shorter[token]
            if token >= 0:
                chosen.append(token)
                at = end
                if at < end_of_text:
                    rest = text[at : at + self.most]
                    token = begun[rest[: reach(rest)]]
            else:
                alive[at] = False
                token = chosen.pop()
                at -= size[token]
        return chosen

    def pack_piece(self, piece: str) -> bytes:
        found = self.pieces.new.get(piece) or self.pieces.recall(piece)
        if found is None:
            found = array("I", self.encode_piece(piece)).tobytes()
            if len(piece) <= CACHE_CHARS:
                self.pieces.keep(piece, found)
        return found

    def pack_chunk(self, chunk: str) -> bytes:
        """Packed ids of a stretch of text whose ends are ends of pieces."""
        packed = self.chunks.recall(chunk)
        if packed is None:
            packed = b"".join([self.pack_piece(p) for p in self.find(chunk)])
            if len(chunk) <= CACHE_CHARS:
                self.chunks.keep(chunk, packed)
        return packed

    def pack_plain(self, text: str) -> bytes:
        """Packed ids of text without special tokens.

        A space before a visible character always starts a piece, so the stretches between such
        spaces are encoded on their own and looked up in the worker's table.
        """
        if not text:
            return b""
        parts = text.split(" ") if not LOOSE_SPACE(text) else TIGHT_SPACE(text)
        get, put = self.chunks.new.get, self.pack_chunk
        first = get(parts[0]) or (put(parts[0]) if parts[0] else b"")
        return first + b"".join([get(p) or put(p) for p in [" " + q for q in parts[1:]]])

    def pack(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.cut_special is None or not any(s in text for s in self.special):
            return self.pack_plain(text)
        return b"".join(
            self.special[p].to_bytes(4, "little")
            if p in self.special
            else self.pack_plain(p)
            for p in self.cut_special.split(text)
        )

    # --- decoding ---------------------------------------------------------------------------

    def decode(self, packed: bytes) -> bytes:
        """The UTF-8 bytes of a text from its packed ids."""
        ids = np.frombuffer(packed, dtype="<u4")
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        place = np.repeat(self.offsets[ids] - (ends - lengths), lengths)
        place += np.arange(len(place))
        raw = self.blob[place].tobytes()
        return raw.decode("utf-8", "replace").encode("utf-8")


LOOSE_SPACE = re.compile(r" (?:\s|\Z)").search
TIGHT_SPACE = re.compile(r" (?=\S)").split


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Bpe:
    """The vocabulary of a file, built once per worker process."""
    return Bpe(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids`` per row; ``ids`` packs the tokens as little-endian unsigned 32-bit.

    NULL and empty texts have no tokens. Rows are independent of each other: repeated rows and NULL
    ids are kept. No shuffle.
    """
    kind = id_type(df, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = vocabulary(path).pack
        for batch in small_batches(batches):
            packed = [pack(t) if t else b"" for t in batch.column(1).to_pylist()]
            counts = pa.array([len(p) // 4 for p in packed], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(packed, pa.binary())], ["id", "n_tokens", "ids"]
            )

    return map_rows(id_text(df, id_col, text_col), run, f"id {kind}, n_tokens long, ids binary")


def decode(df: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` from packed ids; NULL ids decode to the empty text."""
    kind = id_type(df, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = vocabulary(path).decode
        for batch in small_batches(batches, "ids"):
            texts = [unpack(p or b"").decode("utf-8") for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["id", "text"]
            )

    rows = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return map_rows(rows, run, f"id {kind}, text string")


def round_trip(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Digests of the ids and of the text decoded from them: ``id, n_tokens, ids_sha256, decoded_sha256``.

    The same as ``encode`` followed by ``decode`` and two digests, in one pass over the batch.
    """
    kind = id_type(df, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, digest = vocabulary(path), hashlib.sha256
        for batch in small_batches(batches):
            packed = [model.pack(t) if t else b"" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([digest(p).hexdigest() for p in packed], pa.string()),
                    pa.array([digest(model.decode(p)).hexdigest() for p in packed], pa.string()),
                ],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(id_text(df, id_col, text_col), run, schema)
