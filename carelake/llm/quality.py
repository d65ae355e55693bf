"""Quality rules: base rules on document statistics, then boosted trees fitted to labelled documents."""

from __future__ import annotations

from collections import Counter
from math import log1p

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import filter_rows, map_rows, words
from .boosting import Trees, fit

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\f"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"

#: Names of the model's inputs and how the score may depend on each: -1 only falls, 1 only rises.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1,
    "digit_share": 0, "bang_share": -1, "bar_share": -1, "distinct_share": 1, "words_a_line": 0, "stop_share": 0,
}

STATISTICS = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
)
JUDGED = T.StructType(
    [*STATISTICS.fields, T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())]
)


def measure(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The five base statistics, and the model's inputs in the order of FEATURES."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    found = raw.split()
    n = len(found)
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    word_chars = len(text) - without(SPACES)
    symbols = without(SYMBOLS)
    seen, dup, lines = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.split(None, 1):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeat = 0
    windows = list(zip(found, found[1:], found[2:]))
    distinct = set(windows)
    if len(distinct) < len(windows):
        times, covered = Counter(windows), bytearray(n)
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered[i : i + 3] = b"\1\1\1"
        repeat = sum(covered)
    chars = max(1, word_chars)
    inputs = (
        log1p(n), word_chars / max(1, n), symbols / chars, dup / max(1, lines), repeat / max(1, n), without(UPPER) / chars,
        without(DIGITS) / chars, raw.count(b"!") / chars, raw.count(b"|") / chars, len(set(found)) / max(1, n), n / max(1, lines),
        raw.count(b".") / chars,
    )
    return (n, word_chars, symbols, dup, repeat), inputs


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Trees:
    """Trees for ``quality`` = 1, fitted on the driver to at most ``max_rows`` labelled documents.

    The sample is the labels with the smallest hashes of their document's id, so it is the
    same on every run; 20,000 ids and a dozen numbers each are all that is broadcast or
    collected. Labels without an id or a 0/1 quality are left out; with none left every
    document scores about 1.
    """
    sample = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality in (0, 1)")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows)
    )
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    # At most max_rows ids: the limit bounds what is broadcast.
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    inputs = map_rows(chosen, ["doc_id", "text"], lambda rows: [(d, list(measure(t)[1])) for d, t in rows], schema)
    # Copies of one id in docs would make the sample larger than its bound.
    pairs = inputs.join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "x").limit(max_rows).select("quality", "x").collect()
    x = np.array([r.x for r in pairs], dtype=np.float64).reshape(len(pairs), len(FEATURES))
    return fit(x, np.array([r.quality for r in pairs], dtype=np.float64), list(FEATURES.values()))


def _judge(model: Trees, threshold: float):
    def rows(part: list[tuple]) -> list[tuple]:
        measured = [measure(text) for _, text in part]
        scores = model.score(np.array([m[1] for m in measured], dtype=np.float64).reshape(len(part), len(FEATURES)))
        out = []
        for (doc_id, _), (base, _), score in zip(part, measured, scores, strict=True):
            failed = base_failed(base[0], base[4])
            out.append((doc_id, *base, failed, float(score), not failed and bool(score >= threshold)))
        return out

    return rows


def judge(docs: DataFrame, model: Trees, threshold: float = 0.5) -> DataFrame:
    """A row per document: statistics, ``base_failed``, ``score`` and ``kept``.

    A null or empty text has no words and fails the base rules; equal rows get equal
    verdicts; a null doc_id stays null. Other columns of ``docs`` are not read.
    """
    return map_rows(docs, ["doc_id", "text"], _judge(model, threshold), JUDGED)


def keep_good(docs: DataFrame, model: Trees, threshold: float = 0.5) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns."""
    rows = _judge(model, threshold)
    return filter_rows(docs, ["doc_id", "text"], lambda part: [r[-1] for r in rows(part)])
