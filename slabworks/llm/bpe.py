"""Byte-level BPE by backtracking.

Bytes are mapped to Latin-1 characters, so that pyahocorasick (which works on str) finds all vocabulary
entries in a piece in one pass.  From the longest match at each place the encoder steps forward as long as
adjacent tokens are compatible - the merges would leave both as they are - and otherwise takes the next shorter
match or steps back; a place that was given up is never entered again, so the work is linear in the piece.
Compatibility of two tokens is found by undoing merges and is memoised.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slabworks.llm.common import arrow_map, table

#: Entries of a memo before it is emptied; memos only save time.
MEMO = 400_000
#: Longer pieces are encoded anew each time.
MEMO_CHARS = 40


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a .tiktoken file by rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


class Encoder:
    """Encodes and decodes with the merges that a list of tokens by rank implies.

    A token that the merges never make is still used for a piece equal to it, as the public library does.
    """

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.pattern = regex.compile(pattern)
        names = [t.decode("latin-1") for t in tokens]
        self.lengths = [len(t) for t in tokens]
        self.ids = {name: i for i, name in enumerate(names) if name}
        self.automaton = ahocorasick.Automaton()
        for name, i in self.ids.items():
            self.automaton.add_word(name, i)
        self.automaton.make_automaton()
        #: For each token the longest other token that it begins with, or -1.
        self.shorter = [self._proper_prefix(name) for name in names]
        #: The pair each token is merged from; itself twice where no merge makes it.
        self.parts: list[tuple[int, int]] = []
        self.merged: dict[tuple[int, int], int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        for i, name in enumerate(names):
            pair = self._made_from(i, name)
            if pair is None:
                self.parts.append((i, i))
            else:
                self.parts.append(pair)
                self.merged[pair] = i
        self.fits.clear()
        self.memo: dict[str, str] = {}
        self.digits = {str(i): t for i, t in enumerate(tokens)}

    def _proper_prefix(self, name: str) -> int:
        return next((self.ids[name[:n]] for n in range(len(name) - 1, 0, -1) if name[:n] in self.ids), -1)

    def _made_from(self, i: int, name: str) -> tuple[int, int] | None:
        first = self.shorter[i]
        while first >= 0:
            second = self.ids.get(name[self.lengths[first] :], -1)
            if 0 <= second < i and first < i and self._compatible(first, second):
                return first, second
            first = self.shorter[first]
        return None

    def _compatible(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before the merges inside both tokens are done."""
        bound = 1 << 60
        while True:
            if self.merged.get((left, right), bound) < bound:
                return False
            # undo the later of the two merges: its outer part can't touch the border
            if left > right:
                bound = left
                inner = self.parts[left][1]
                if inner == left:  # a single byte, or no merge makes it: undo the other
                    bound = right + 1
                    inner = self.parts[right][0]
                    if inner == right:
                        return True
                    right = inner
                else:
                    left = inner
            else:
                bound = right + 1
                inner = self.parts[right][0]
                if inner == right:
                    bound = left
                    inner = self.parts[left][1]
                    if inner == left:
                        return True
                    left = inner
                else:
                    right = inner

    def compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= MEMO:
                self.fits.clear()
            known = self.fits[left, right] = self._compatible(left, right)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        name = piece.decode("latin-1")
        whole = self.ids.get(name)
        if whole is not None:
            return [whole]
        n = len(name)
        longest = [-1] * n
        for end, i in self.automaton.iter(name):  # ends ascend, and per end the longest comes first
            start = end + 1 - self.lengths[i]
            longest[start] = i
        open_ = bytearray(b"\x01" * (n + 1))
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            last = out[-1] if out else -1
            while token >= 0:
                end = at + self.lengths[token]
                if open_[end] and (last < 0 or self.compatible(last, token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                open_[at] = 0
                if not out:
                    raise ValueError("the vocabulary can't spell this piece")
                token = out.pop()
                at -= self.lengths[token]
                token = self.shorter[token]
        return out

    def _text_of(self, piece: str) -> str:
        return ",".join(map(str, self.encode_piece(piece.encode())))

    def encode_to_digits(self, text: str) -> str:
        """The ids of a text as decimals joined by commas."""
        memo = self.memo
        pieces = self.pattern.findall(text)
        try:
            return ",".join(map(memo.__getitem__, pieces))
        except KeyError:
            out = []
            for piece in pieces:
                known = memo.get(piece)
                if known is None:
                    known = self._text_of(piece)
                    if len(piece) <= MEMO_CHARS:
                        if len(memo) >= MEMO:
                            memo.clear()
                        memo[piece] = known
                out.append(known)
            return ",".join(out)

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in self.encode_piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_digits(self, ids: str) -> bytes:
        return b"".join(map(self.digits.__getitem__, ids.split(","))) if ids else b""


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str, tokens: list[bytes] | None = None) -> Encoder:
    """One encoder a process; tokens are read from the path where not given."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(tokens or read_ranks(path), pattern)
    return _encoders[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True) -> DataFrame:
    """The columns ``keep`` of each row, with its text's tokens.

    Adds n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256 (of the bytes that the ids decode
    to) and, if ``with_ids``, ids (array of int).  A null text is encoded as an empty one: 0 tokens.  The result
    depends on the text alone, so repeated rows give repeated results; other columns, clashing names included,
    are not looked at.  Texts of any length are encoded whole, in linear time.  The vocabulary (a file of a
    fixed size) is sent to the executors once by broadcast; they read no file.
    """
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    kept = [docs.schema[c] for c in keep]
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        added.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern, tokens.value)
        for batch in batches:
            counts, hashes, decoded, ids = [], [], [], []
            for value in batch.column("_text"):
                digits = own.encode_to_digits(value.as_py() or "")
                counts.append(digits.count(",") + 1 if digits else 0)
                hashes.append(hashlib.sha256(digits.encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode_digits(digits)).hexdigest())
                if with_ids:
                    ids.append(np.fromstring(digits, dtype=np.int32, sep=","))
            out = [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                ends = np.cumsum([0, *counts], dtype=np.int64).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))))
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in (*kept, *added)])

    return arrow_map(docs.select(*keep, F.col(text).cast("string").alias("_text")), run, T.StructType([*kept, *added]))


def production() -> tuple[str, str]:
    """The path and pattern of the public multilingual vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op10_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), *production(), with_ids=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op10_bpe_roundtrip": op10_bpe_roundtrip}
ORACLE: dict[str, str] = {}
