"""Secrets in texts: keyword automaton, anchored patterns at its hits, checksums inside the token."""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import map_rows

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
LETTERS = re.compile(r"[A-Za-z]+")
#: What follows the letters that a card's keyword stands in.
CARD = re.compile(r"\W{0,3}(?:n[ro]\.?|number)?\W{0,3}(\d(?:[ -]?\d){12,18})(?!\d)", re.A)
IBAN = re.compile(r"iban\W{0,3}([A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])", re.I | re.A)
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: Kinds in the order in which spans with one start are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "forge", "card", "iban")
#: What the automaton looks for, in lower case, and the kind whose pattern is tried there.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign", "apikey": "assign",
    "akia": "access", "ghp_": "forge", "gho_": "forge", "ghu_": "forge", "ghs_": "forge", "ghr_": "forge", "npm_": "forge",
    "card": "card", "visa": "card", "iban": "iban",
}
FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
])


def forge_checksum(body: str) -> str:
    """The last six characters of a code-forge or package-registry token: CRC-32 of the rest in base 62."""
    n, out = zlib.crc32(body.encode()), ""
    while n:
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out.rjust(6, "0")


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def iban_valid(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def lowered(text: str) -> str:
    """Lower case with every character at its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def scan(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every secret, in code points, by start and then kind.

    Patterns are tried at the automaton's hits only, from left to right; a match takes its
    characters for its kind even if it is then dropped as too short. Runs of hex digits have
    no keyword and are found directly.
    """
    if not text:
        return []
    spans = [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    end = dict.fromkeys(KINDS, 0)
    for last, (length, kind) in automaton().iter(lowered(text)):
        at = last - length + 1
        if at < end[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(text, at):
                end[kind] = m.end()
                if len(m[2]) >= 6:
                    spans.append((at, kind, m.end()))
        elif kind == "access":
            if m := ACCESS.match(text, at):
                end[kind] = m.end()
                if m.end() - at >= 20:
                    spans.append((at, kind, m.end()))
        elif kind == "forge":
            if (m := CHECKED.match(text, at)) and forge_checksum(m[1]) == m[2]:
                end[kind] = m.end()
                spans.append((at, kind, m.end()))
        elif kind == "card":
            word = LETTERS.match(text, at)
            end[kind] = word.end() if word else at + 1  # all hits in a run of letters see the same
            if word and (m := CARD.match(text, word.end())) and luhn(re.sub(r"\D", "", m[1])):
                end[kind] = m.end()
                spans.append((m.start(1), kind, m.end(1)))
        elif (m := IBAN.match(text, at)) and iban_valid(m[1].replace(" ", "").upper()):
            end[kind] = m.end()
            spans.append((m.start(1), kind, m.end(1)))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1])))


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan_documents(docs: DataFrame) -> DataFrame:
    """A row per document: counts and digest of the base spans, and all spans.

    A null or empty text has no spans (the digest is then that of the empty string); equal
    rows give equal rows; other columns of ``docs`` are not read.
    """

    def rows(part: list[tuple]) -> list[tuple]:
        out = []
        for doc_id, text in part:
            spans = scan(text)
            base = [s for s in spans if s[1] in KINDS[:3]]
            n = [sum(s[1] == kind for s in base) for kind in KINDS[:3]]
            out.append((doc_id, *n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
        return out

    return map_rows(docs, ["doc_id", "text"], rows, FOUND)
