import hashlib
import re

import pytest
from llm.odd import documents, empty, table
from pyspark.sql import functions as F

from carelake.llm import spot_signatures as S


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def spots(text, chain=3, distance=1):
    words = [w for w in re.split(r"[\x20\x09-\x0D.,;:!?\"'()\[\]|\x01]+", (text or "").lower()) if w]
    content = [(w, words[i - 1] if i else "") for i, w in enumerate(words) if w not in S.ANCHORS]
    out = set()
    for i, (_, before) in enumerate(content):
        ahead = content[i : i + distance * (chain - 1) + 1 : distance]
        if before in S.ANCHORS and len(ahead) == chain:
            out.add(number(before + "\x01" + " ".join(w for w, _ in ahead)))
    return sorted(out) if out or not words else [number(" ".join(words))]


def brute(rows):
    rows = [(r.doc_id, r.text or "") for r in rows]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((("-" if r[0] is None else str(r[0])) + ":" + r[1]).encode()).hexdigest()))
    like = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0
    told = lambda s: " ".join(map(str, s))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following, cut = rows[(i + 1) % len(rows)][1], len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        own, new, other = spots(text), spots(edited), spots(following)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), told(own), told(new), like(own, new), like(own, other)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("frame", [lambda s: table(s, "documents"), documents, lambda s: documents(s).limit(1)])
def test_against_plain_python(spark, frame):
    docs = spark.createDataFrame(frame(spark).collect(), frame(spark).schema)
    assert sorted(map(tuple, S.edited_documents(docs).collect()), key=repr) == brute(docs.collect())


def test_empty_table(spark):
    assert S.edited_documents(empty(spark)).collect() == []


def test_equal_rows_meet_before_the_shuffle(spark):
    docs = spark.createDataFrame([(1, "the cat sat here on a mat")] * 9 + [(0, "of a dog and the old house there")], "doc_id long, text string")
    got = sorted(map(tuple, S.edited_documents(docs).collect()))
    assert got == brute(docs.collect()) and sum(r[-1] == 1.0 for r in got) == 8


@pytest.mark.parametrize(("chain", "distance"), [(1, 1), (2, 1), (2, 2), (3, 3)])
def test_chains(spark, chain, distance):
    texts = [r.text for r in table(spark, "documents").limit(60).collect()] + ["the", "the of", "the end", "end the", "a b c the d e f g", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in frame.select("text", S.signatures(F.col("text"), chain=chain, distance=distance).alias("s")).collect():
        assert r.s == spots(r.text, chain, distance)


def test_likeness(spark):
    pairs = [([1, 2, 3, 4], [2, 3, 4, 5]), ([], []), ([], [1]), ([1], [1]), ([1], [1, 2, 3, 4]), ([1, 2], [3, 4])]
    frame = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    got = frame.select(S.likeness(F.col("a"), F.col("b")).alias("all"), S.likeness(F.col("a"), F.col("b"), 0.5).alias("near")).collect()
    assert [r.all for r in got] == [0.6, 1.0, 0.0, 1.0, 0.25, 0.0]
    assert [r.near for r in got] == [0.6, 1.0, 0.0, 1.0, 0.0, 0.0]


def test_long_texts_and_no_python(spark):
    long = spark.createDataFrame([("the cat sat on a mat near of the house " * 60_000,)], "text string")
    assert long.select(F.size(S.signatures(F.col("text"))).alias("n")).first().n == 3
    plan = S.edited_documents(table(spark, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
