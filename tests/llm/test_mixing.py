import re

import pytest
from llm.odd import documents, empty, plain, table, unchanged_columns

from carelake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Targets of the sources by repeated resharing, from the words of the contract."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    given, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), list(names)
    while open_ and left > 1e-9:
        share = sum(weight[s] for s in open_)
        for s in open_:
            given[s] += left * weight[s] / share
        left = 0.0
        for s in list(open_):
            if given[s] >= 2 * sizes[s]:
                left += given[s] - 2 * sizes[s]
                given[s] = 2.0 * sizes[s]
                open_.remove(s)
    return given


def check(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    size = lambda t: len(WORD.findall(t or ""))
    sizes, largest = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
        largest[r.source] = max(largest.get(r.source, 0), size(r.text))
    want = targets(sizes)
    mixed = mixing.mix(docs)
    assert mixed.columns == ["doc_id", "size", "source_size", "target", "taken"]
    got = mixed.collect()
    assert plain(mixed, "doc_id", "size", "source_size") == sorted([(r.doc_id, size(r.text), sizes[r.source]) for r in rows], key=repr)
    assert plain(mixing.mix(docs)) == plain(mixed)  # reruns agree
    by_target = {}
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"])
        by_target.setdefault(round(r.target, 3), []).append(r.taken)
    for s, t in want.items():
        assert round(t, 3) in by_target
    assert sum(t for v in by_target.values() for t in v) == pytest.approx(sum(want.values()), abs=sum(largest.values()) / 2 + 1)
    return want, largest


def test_table(spark):
    docs = table(spark, "documents")
    want, largest = check(docs)
    sources = {r.doc_id: r.source for r in docs.collect()}
    taken = dict.fromkeys(want, 0)
    for r in mixing.mix(docs).collect():
        taken[sources[r.doc_id]] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1


def test_odd_documents(spark):
    check(documents(spark))
    assert mixing.mix(empty(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert plain(mixing.mix(nothing)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_one_source_and_many(spark):
    one = spark.createDataFrame([(i, "w " * (i % 7 + 1), "s") for i in range(400)], "doc_id long, text string, source string")
    check(one)
    many = spark.createDataFrame([(i, "w " * (i % 5 + 1), f"s{i % 60}" if i % 3 else "hot") for i in range(900)], "doc_id long, text string, source string")
    check(many)


def test_stage(spark):
    docs = documents(spark)
    mixed = mixing.mixed_documents(docs)
    unchanged_columns(docs, mixed)
    per_row = mixing.mix(docs).collect()
    want = sum(r.taken // r["size"] if r["size"] else 1 for r in per_row)
    assert mixed.count() == want
    assert mixing.mixed_documents(empty(spark)).count() == 0
