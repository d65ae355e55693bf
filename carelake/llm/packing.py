"""Documents cut into token pieces and packed into sequences of a fixed capacity."""

from __future__ import annotations

import struct
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ..session import written
from .batches import kept, map_rows, words

#: Words remembered per Python worker.
CACHE_SIZE = 700_000
#: Pieces packed together by one task; a group wastes about one sequence.
GROUP_PIECES = 16_384
#: Fixed value: how the vocabulary splits a lower-case text.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: In words of these characters lower case and NFC go character by character.
PLAIN = regex.compile(r"[\x21-\x7e\xa1-įĲ-ɏ]+")
#: How the vocabulary writes bytes that are no visible sign: one after the other from U+0100.
BYTE_SIGNS = {b: 0x100 + i for i, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}

PIECE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])


class Encoder(dict):
    """Packed little-endian ids of each word; white space separates words for this vocabulary."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer, self.by_piece = Tokenizer.from_file(path), {}
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()

        self.model = self.tokenizer.model

    def _ids(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        """Ids of one lower-case piece straight from the merges, without the steps before them."""
        packed = self.by_piece.get(piece)
        if packed is None:
            signs = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_SIGNS)
            ids = [token.id for token in self.model.tokenize(signs)]
            packed = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) <= 64:
                self.by_piece[piece] = packed
        return packed

    def __missing__(self, word: bytes) -> bytes:
        letters = word.rstrip(b".,;:!?")
        if letters.isalpha():  # ASCII letters, then signs
            out = self._piece(letters.lower().decode())
            if len(letters) < len(word):
                out += self._piece(word[len(letters) :].decode())
        else:
            text = word.decode("utf-8", "surrogatepass")
            if "<|" in text or not PLAIN.fullmatch(text) or not unicodedata.is_normalized("NFC", text):
                out = self._ids(text)
            else:
                out = b"".join(map(self._piece, PIECES.findall(text.lower())))
        if len(word) <= 64:
            self[word] = out
        return out

    def encode(self, text: str | None) -> bytes:
        for cache in (self, self.by_piece):
            if len(cache) > CACHE_SIZE:
                cache.clear()
        return b"".join(map(self.__getitem__, words(text)))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


kept[__name__] = encoder.cache_clear


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """The token pieces of each document: its ids, then ``end_id``, cut every ``capacity`` ids."""

    def rows(part: list[tuple]) -> list[tuple]:
        encode, out = encoder(vocabulary).encode, []
        for doc_id, text in part:
            packed = encode(text) + struct.pack("<I", end_id)
            for piece, at in enumerate(range(0, len(packed), 4 * capacity)):
                ids = packed[at : at + 4 * capacity]
                out.append((doc_id, piece, at // 4, len(ids) // 4, zlib.crc32(ids)))
        return out

    return map_rows(docs, ["doc_id", "text"], rows, PIECE)


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, in few bins.

    Lengths above a third of the capacity come first, from the largest: each opens a bin and
    takes the largest other one that fits, so a bin holds two of them at most. The smaller
    ones follow, from the largest, each into the tightest gap that holds it.
    """
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order].tolist()
    large = int((3 * lengths > capacity).sum())
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    there = 0
    for i in range(large - 1, -1, -1):
        waiting[sizes[i]].append(i)
        there |= 1 << sizes[i]
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    open_gaps, n_bins = 0, 0

    def leave(gap: int, bin_: int) -> None:
        nonlocal open_gaps
        if gap:
            gaps[gap].append(bin_)
            open_gaps |= 1 << gap

    def take(size: int) -> int:
        nonlocal there
        i = waiting[size].pop()
        if not waiting[size]:
            there &= ~(1 << size)
        return i

    while there:
        size = there.bit_length() - 1
        bins[take(size)] = n_bins
        gap = capacity - size
        if fits := there & ((1 << (gap + 1)) - 1):
            other = fits.bit_length() - 1
            i = take(other)
            bins[i], offsets[i] = n_bins, size
            gap -= other
        leave(gap, n_bins)
        n_bins += 1
    for i in range(large, len(sizes)):
        size = sizes[i]
        if fits := open_gaps >> size:
            gap = size + (fits & -fits).bit_length() - 1
            bin_ = gaps[gap].pop()
            if not gaps[gap]:
                open_gaps &= ~(1 << gap)
        else:
            gap, bin_ = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = bin_, capacity - gap
        leave(gap - size, bin_)
    bin_of, offset_of = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    bin_of[order], offset_of[order] = bins, offsets
    return bin_of, offset_of


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """A row per piece with its sequence and its place there.

    Pieces are written once, dealt evenly over groups of about GROUP_PIECES, and each group
    is packed by itself; a hot source or text does not make a group larger. A null or empty
    text is one piece of ``end_id`` alone; repeated rows are packed each for itself; an empty
    table gives no rows. Other columns of ``docs`` are not read. Jobs run while this is
    called: the pieces are written and counted.
    """
    pieces = written(cut_pieces(docs, vocabulary, capacity, end_id), "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))

    def packed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = pack(part["length"].to_numpy(dtype=np.int64), capacity)
        return part.drop(columns="packing_group").assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    schema = T.StructType([*PIECE.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    # Written files are split the same way on every attempt, so the numbers are stable.
    dealt = pieces.withColumn("packing_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    return dealt.groupBy("packing_group").applyInPandas(packed, schema)
