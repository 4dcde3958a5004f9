"""Byte-level BPE encoding and decoding by backtracking over an Aho-Corasick automaton of the vocabulary.

A piece of text (one match of the pattern) has exactly one split into tokens in which each two neighbours are
compatible, that is, in which merging the bytes of the two by rank yields these two again: a merge that crosses a
border anywhere crosses it between two neighbours, and merges left and right of a border don't see each other before.
That split is what merging by rank yields. It is found from left to right: take the longest token that begins at a place,
shorten it while it isn't compatible with its left neighbour or ends at a place known to lead nowhere, and step back where
none is left. The split of a prefix being unique too, a place is given up at most once, so the work is linear. Bytes are
mapped to Latin-1, so that the automaton, whose letters are characters, reads them. Compatibility of two tokens is found by
going through the merges that make either and is memoised.

Defined results: a null text is an empty one and has no tokens; a null list of ids decodes to null, an empty one to no
bytes; an id that the vocabulary lacks is an error; repeated rows are encoded one by one; an empty table gives none; other
columns are carried, one of the name of the result is replaced.
"""

from __future__ import annotations

import base64
import sys
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Memos are emptied at so many entries; what they hold can be worked out again.
MEMO = 1 << 18
#: Pieces up to so many characters are memoised whole.
SHORT = 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file of lines 'base64 rank'."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, file)))}


@lru_cache(1)
def _newer() -> str:
    """Letters and numbers that the regex module knows and the Unicode version of the tiktoken library doesn't, as ranges of a set."""
    found = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))
    single = {bytes([i]): i for i in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=single, special_tokens={})
    known = set(probe.decode(probe.encode_ordinary("".join(found))))
    codes = np.array([ord(c) for c in found if c not in known], np.int64)
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1) if len(codes) else []
    return "".join(f"\\U{int(r[0]):08x}-\\U{int(r[-1]):08x}" for r in runs)


def _latin(text: str) -> bool:
    """Whether all characters are below U+0100: a quick test, none of them is new."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Pieces:
    """Splits texts into the pattern's matches, letters and numbers being those of the tiktoken library."""

    def __init__(self, pattern: str):
        self.plain = regex.compile(pattern)
        self.newer = regex.compile(f"[{new}]") if (new := _newer()) else None
        if self.newer is not None:
            narrow = regex.sub(r"\\p\{([LN])\}", rf"[\\p{{\1}}--[{new.replace(chr(92), chr(92) * 2)}]]", pattern)
            self.exact = regex.compile("(?V1)" + narrow)

    def __call__(self, text: str) -> list[str]:
        if self.newer is not None and not _latin(text) and self.newer.search(text):
            return self.exact.findall(text)
        return self.plain.findall(text)


class Codec(dict):
    """Ids of texts and bytes of ids. As a dict: a short piece and its ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, ranks: str, pattern: str | None = None):
        super().__init__()
        self.ranks = read_ranks(ranks)
        self.tokens: list[bytes | None] = [None] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.pieces = Pieces(pattern) if pattern else None
        self._trie, self._width = None, 0
        self._shorter: dict[int, int] = {}
        self._course: dict[int, tuple] = {}
        self._fits: dict[tuple[int, int], bool] = {}

    def course(self, token: int) -> tuple[list[int], list[bytes], list[bytes]]:
        """The ranks of the merges that make token, in their order, then one above all; its first and last part before each of them and at the end.

        Lowest rank first, the leftmost of equal ones first, as everywhere.
        """
        known = self._course.get(token)
        if known is None:
            raw, none = self.tokens[token], len(self.tokens)
            parts, ranks, first, last = [raw[i : i + 1] for i in range(len(raw))], [], [], []
            while True:
                rank, at = min(((self.ranks.get(parts[i] + parts[i + 1], none), i) for i in range(len(parts) - 1)), default=(none, 0))
                ranks.append(rank)
                first.append(parts[0])
                last.append(parts[-1])
                if rank == none:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self._course[token] = (ranks, first, last)
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, stay as they are: each goes through its own merges until one across the border comes first."""
        known = self._fits.get((left, right))
        if known is not None:
            return known
        if len(self._fits) >= MEMO:
            self._fits.clear()
        a, _, ends = self.course(left)
        b, begins, _ = self.course(right)
        get, none, i, j = self.ranks.get, len(self.tokens), 0, 0
        while True:
            across, x, y = get(ends[i] + begins[j], none), a[i], b[j]
            if across < x and across <= y:  # of equal ranks the leftmost comes first
                break
            if x == y == none:
                break
            if x <= y:
                i += 1
            else:
                j += 1
        # a token that its own merges don't reach fits nowhere
        known = across == none and x == y == none and ends[i] == self.tokens[left] and begins[j] == self.tokens[right]
        self._fits[left, right] = known
        return known

    def reached(self, token: int) -> bool:
        """Whether merges make the token out of its own bytes."""
        return self.course(token)[2][-1] == self.tokens[token]

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of token, or -1."""
        known = self._shorter.get(token)
        if known is None:
            raw = self.tokens[token]
            known = self._shorter[token] = next((self.ranks[raw[:n]] for n in range(len(raw) - 1, 0, -1) if raw[:n] in self.ranks), -1)
        return known

    def prepare(self) -> None:
        """The automaton of all tokens, and how many bytes the longest has."""
        self._trie = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self._trie.add_word(token.decode("latin-1"), rank)
        self._trie.make_automaton()
        self._width = max(map(len, self.ranks), default=0)

    def piece(self, raw: bytes) -> list[int]:
        """Ids of one piece."""
        if raw in self.ranks:  # as the tiktoken library does, even for a token that merges don't reach
            return [self.ranks[raw]]
        if self._trie is None:
            self.prepare()
        size, latin, dead, out, at, token = len(raw), raw.decode("latin-1"), bytearray(len(raw) + 1), [], 0, -1
        far, width, ranks, tokens, known, fits = self._trie.longest_prefix, self._width, self.ranks, self.tokens, self._fits, self.fits
        fresh = True  # at is reached for the first time
        while at < size:
            if fresh:
                after = at + far(latin[at : at + width])  # as far as any token goes on
                while after > at and (token := ranks.get(raw[at:after], -1)) < 0:
                    after -= 1
            left = out[-1] if out else -1
            while token >= 0:
                after = at + len(tokens[token])
                if not dead[after] and (self.reached(token) if left < 0 else known[left, token] if (left, token) in known else fits(left, token)):
                    break
                token = self.shorter(token)
            fresh = token >= 0
            if fresh:
                out.append(token)
                at, token = after, -1
            elif left < 0:
                raise ValueError(f"the vocabulary lacks a byte of {raw[:40]!r}")
            else:
                dead[at] = 1
                out.pop()
                at -= len(tokens[left])
                token = self.shorter(left)
        return out

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self.piece(piece.encode())).tobytes()
        if sys.byteorder != "little":
            ids = np.frombuffer(ids, "=u4").astype("<u4").tobytes()
        if len(piece) <= SHORT:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.__getitem__, self.pieces(text)))

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4").tolist()
        try:
            return b"".join([self.tokens[i] for i in numbers])
        except (IndexError, TypeError):
            raise ValueError("an id is not in the vocabulary") from None


@lru_cache(2)
def codec(ranks: str, pattern: str | None = None) -> Codec:
    """One codec a worker process and vocabulary."""
    return Codec(ranks, pattern)


def _mapped(rows: DataFrame, column: str, out: str, kind: str, run) -> DataFrame:
    """rows with out, run's value of each value of column; the other columns pass by as one struct."""
    keep = [c for c in rows.columns if c != out]
    both = rows.select(F.struct(*[rows[c] for c in keep], F.lit(None).cast("int").alias("_")).alias("row"), rows[column].alias("given"))
    made = pa.binary() if kind == "binary" else pa.list_(pa.int32())

    def batches(found):
        for batch in found:
            row, given = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 64):  # results are as large as what is given: few rows at a time
                part = given.slice(at, 64)
                yield pa.RecordBatch.from_arrays([row.slice(at, 64), pa.array([run(x) for x in part.to_pylist()], made)], names=["row", "made"])

    schema = f"row {both.schema['row'].dataType.simpleString()}, made {kind}"
    return both.mapInArrow(batches, schema).select(*[F.col("row").getField(c).alias(c) for c in keep], F.col("made").alias(out))


def encode(rows: DataFrame, ranks: str, pattern: str, text: str = "text", out: str = "ids", packed: bool = False) -> DataFrame:
    """rows with the ids of their texts: array<int>, or packed as little-endian unsigned 32-bit numbers."""

    def run(value):
        ids = codec(ranks, pattern).encode(value or "")
        return ids if packed else np.frombuffer(ids, "<i4")

    return _mapped(rows, text, out, "binary" if packed else "array<int>", run)


def decode(rows: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """rows with the bytes of their ids, which are array<int> or packed."""

    def run(value):
        if value is None:
            return None
        return codec(ranks).decode(bytes(value) if isinstance(value, (bytes, bytearray)) else np.array(value, "<u4").tobytes())

    return _mapped(rows, ids, out, "binary", run)


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """One row a document: doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    ids = encode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), ranks, pattern, packed=True)
    both = decode(ids.select("doc_id", "ids"), ranks)
    return both.select("doc_id", F.expr("length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
