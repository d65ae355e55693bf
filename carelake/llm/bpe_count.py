"""Token counts of a byte-level BPE vocabulary without making tokens."""

from __future__ import annotations

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import map_rows

#: Unicode white space, and the split pattern that the vocabulary was made with.
WHITE = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
#: A word with the space before it, or white space: no token crosses these borders.
UNITS = rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
#: Counts remembered per Python worker, of each kind.
CACHE_SIZE = 700_000
COUNTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
])


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Merges:
    """The merge ranks of a vocabulary file, over integers below 2^17 for symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        number = {s: i for i, s in enumerate(byte_symbols())}
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(number[a] << 17 | number[b], rank)
            self.made.append(number.setdefault(a + b, len(number)))

    def count(self, piece: bytes) -> int:
        """Symbols left: the bytes, less one for each merge.

        A heap holds the adjacent pairs by rank, then place; a linked list holds the
        symbols that are still there. A popped pair counts only if its symbols are
        unchanged, which its rank tells.
        """
        symbols, n = list(piece), len(piece)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        rank_of, made, bits = self.rank.get, self.made, n.bit_length()
        place = (1 << bits) - 1
        heap = [
            r << bits | i for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := rank_of(a << 17 | b)) is not None
        ]
        heapify(heap)
        left = n
        while heap:
            top = heappop(heap)
            rank, i = top >> bits, top & place
            j = after[i]
            if j >= n or symbols[i] < 0 or rank_of(symbols[i] << 17 | symbols[j]) != rank:
                continue
            symbols[i] = new = made[rank]
            symbols[j] = -1
            left -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(new << 17 | symbols[k])) is not None:
                    heappush(heap, r << bits | i)
            if (h := before[i]) >= 0 and (r := rank_of(symbols[h] << 17 | new)) is not None:
                heappush(heap, r << bits | h)
        return left


class Counter(dict):
    """Tokens of each unit, worked out when first asked for."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges, self.pieces = merges, regex.compile(SPLIT)
        self.units, self.by_piece = regex.compile(UNITS), {}
        self.special = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True)))) if merges.special else None

    def __missing__(self, unit: str) -> int:
        total = 0
        for piece in self.pieces.findall(unit):
            if (n := self.by_piece.get(piece)) is None:
                n = self.merges.count(piece.encode("utf-8", "surrogatepass"))
                if len(piece) <= 64:
                    self.by_piece[piece] = n
            total += n
        if len(unit) <= 64:
            self[unit] = total
        return total

    def tokens(self, text: str) -> int:
        total, parts = 0, [text]
        if self.special and any(s in text for s in self.merges.special):
            parts = self.special.split(text)
            total = len(parts) - 1
        for cache in (self, self.by_piece):
            if len(cache) > CACHE_SIZE:
                cache.clear()
        return total + sum(sum(map(self.__getitem__, self.units.findall(part))) for part in parts)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(Merges(path))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """A row per document: UTF-8 bytes, tokens, and whether they are more than ``limit``.

    ``vocabulary`` is the path of a byte-level BPE file on every machine. Its special
    strings count as one token each where they stand in a text. A null or empty text has 0
    tokens; equal rows give equal rows; other columns of ``docs`` are not read.
    """

    def rows(part: list[tuple]) -> list[tuple]:
        count = counter(vocabulary)
        out = []
        for doc_id, text in part:
            n = count.tokens(text) if text else 0
            out.append((doc_id, len((text or "").encode("utf-8", "surrogatepass")), n, n > limit))
        return out

    return map_rows(docs, ["doc_id", "text"], rows, COUNTS)
