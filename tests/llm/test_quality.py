import re
from collections import Counter

import numpy as np
import pytest
from llm.odd import LABELS, documents, empty, plain, table, unchanged_columns

from carelake.llm import quality
from carelake.llm.boosting import fit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    """The base statistics straight from their definition."""
    text = text or ""
    words = WORD.findall(text)
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_statistics_and_base_rule(spark):
    for docs in (table(spark, "documents"), documents(spark), empty(spark)):
        judged = quality.judge(docs, quality.train(docs, spark.createDataFrame([], LABELS)))
        got = plain(judged, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
        want = []
        for r in docs.collect():
            s = statistics(r.text)
            failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
            want.append((r.doc_id, *s, failed, not failed))  # without labels the trees keep everything
        assert got == sorted(want, key=repr)


def test_monotonic_and_flat_scores():
    random = np.random.default_rng(3)
    x = random.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (random.random(3000) < 0.1)).astype(float)
    y[x[:, 1] > 0.8] = 0
    trees = fit(x, y, [1, -1, 0], trees=30)
    grid = np.linspace(0, 1, 50)
    for point in random.random((20, 3)):
        for j, sign in ((0, 1), (1, -1)):
            line = np.repeat(point[None], 50, axis=0)
            line[:, j] = grid
            assert (np.diff(trees.score(line)) * sign >= -1e-12).all()

    def walk(row):
        raw = trees.base
        for f, t, v in zip(trees.feature, trees.threshold, trees.value, strict=True):
            node = 0
            for _ in range(trees.depth):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            raw += v[node]
        return 1 / (1 + np.exp(-raw))

    assert trees.score(x[:50]) == pytest.approx([walk(r) for r in x[:50]])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    held = quality.judge(docs.join(labels.where("doc_id % 2 = 1").select("doc_id"), "doc_id", "left_semi"), model)
    rows = held.join(labels, "doc_id").selectExpr("quality = 1 as good", "score >= 0.5 as kept").collect()
    assert len(rows) > 1000
    assert np.mean([r.good == r.kept for r in rows]) > 0.98
    assert np.mean([r.kept for r in rows if r.good]) > 0.995


def test_labels_that_say_nothing(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 5, None), (99, 0, 0)], LABELS)
    assert quality.judge(docs, quality.train(docs, labels)).count() == docs.count()


def test_stage_keeps_columns(spark):
    docs = documents(spark)
    model = quality.train(docs, spark.createDataFrame([], LABELS))
    kept = quality.keep_good(docs, model)
    unchanged_columns(docs, kept)
    assert plain(kept, "doc_id") == plain(quality.judge(docs, model).where("kept"), "doc_id")
    assert quality.keep_good(empty(spark), model).count() == 0
