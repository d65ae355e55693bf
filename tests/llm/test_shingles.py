import random
import re

import pytest
from llm.odd import documents, empty, plain, table, unchanged_columns

from carelake.llm import shingle_join as S
from carelake.llm.components import components


def sets_of(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width=4, percent=85):
    """doc_id, n and component of every row, comparing all pairs."""
    sets = [sets_of(r.text, width) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[find(i)] = min(least.get(find(i), r.doc_id), r.doc_id)
    return [(r.doc_id, len(s), least.get(find(i)) if s else r.doc_id) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


def near_copies(groups, copies, words=120, seed=1):
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{r.randint(0, 5000)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.randint(0, 5)):
                k = r.randint(0, 3)
                if k == 0:
                    text[r.randrange(len(text))] = f"n{r.randint(0, 9999)}"
                elif k == 1:
                    del text[r.randrange(len(text))]
                elif k == 2:
                    text.append(f"t{r.randint(0, 99)}")
                else:
                    text.insert(0, "the")
            out.append(" ".join(text))
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("common_from, hubs", [(128, 3), (3, 1), (8, 2)])
def test_groups_against_all_pairs(spark, common_from, hubs):
    rows = near_copies(6, 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert plain(S.join_groups(docs, common_from=common_from, hubs=hubs)) == sorted(brute(docs.collect()), key=repr)


def phrases(docs, seed=3):
    """Texts of own words and of ten out of sixty passages, each in many texts, and near copies of some."""
    r = random.Random(seed)
    common = [" ".join(f"c{k}x{i}" for i in range(5)) for k in range(60)]
    out = []
    for d in range(docs):
        parts = [f"o{d}x{i}" for i in range(80)] + r.sample(common, 10)
        r.shuffle(parts)
        out.append(" ".join(parts))
    return out + [f"{text} added at the end" for text in out[::40]]


def test_passages_of_many_documents_make_no_keys(spark, monkeypatch):
    rows = list(enumerate(phrases(400)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = {}

    def counting(df, label, outer=False, written=S.written):
        out = written(df, label, outer)
        made[label] = out.count()
        return out

    monkeypatch.setattr(S, "written", counting)
    assert plain(S.join_groups(docs, common_from=8)) == sorted(brute(docs.collect()), key=repr)
    # Only the ten near copies and their originals have keys: no pair of passages is one.
    assert made["keys"] <= 100, made


@pytest.mark.parametrize("percent", [51, 60, 75, 85, 95, 100])
def test_linked_sets_share_a_rare_token(percent):
    r = random.Random(percent)
    for _ in range(400):
        both = r.randint(1, 200)
        rest = (100 * both // percent) - both
        a = r.randint(0, rest)
        sizes = both + a, both + rest - a
        least = [-(-percent * n // 100) for n in sizes]
        tokens = r.sample(range(1000), both + rest)
        sets = sorted(tokens[: both + a]), sorted(tokens[:both] + tokens[both + a :])
        cut = [x[: n - m + S._overlap(n, percent)] for x, n, m in zip(sets, sizes, least, strict=True)]
        assert len({*cut[0]} & {*cut[1]}) >= max(S._overlap(m, percent) for m in least)


def test_small_sets(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice("abcd") for _ in range(r.randint(0, 12)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (51, 85):
        assert plain(S.join_groups(docs, 2, percent, common_from=4)) == sorted(brute(docs.collect(), 2, percent), key=repr)


def test_documents_of_the_table(spark):
    docs = table(spark, "documents")
    assert plain(S.join_groups(docs)) == sorted(brute(docs.collect()), key=repr)


def test_odd_documents(spark):
    more = [(None, "a document without an id but with some words in it", None), (12, "two words", "a"), (13, "TWO  words", "a")]
    docs = documents(spark, *more)
    got = plain(S.join_groups(docs))
    assert got == sorted(brute(docs.collect()), key=repr)
    assert S.join_groups(empty(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    more = [(None, "a document without an id but with some words in it", None), (12, "two words", "a"), (13, "TWO  words", "a"), (12, "another text under the same id as before", "q")]
    docs = documents(spark, *more)
    left = S.one_of_each(docs)
    unchanged_columns(docs, left)
    ids = sorted((r.doc_id for r in left.select("doc_id").collect()), key=lambda i: (i is None, i))
    # 10 and 11 are one text; 3 twice is one row; 13 repeats 12; rows without words stay (6 and 5 and 4), as do two without id.
    assert ids == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 12, None, None]
    assert S.one_of_each(empty(spark)).count() == 0


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randint(0, 200), r.randint(0, 200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(64)] + [(5000, 5001 + i) for i in range(50)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = sorted((x, find(x)) for x in root if find(x) != x)
    assert sorted(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect())) == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query_matches_duckdb(spark):
    from compare import connect, differences
    from conftest import SF_DIR

    from carelake.llm import queries

    for name, sql in queries.oracle_sql().items():
        assert differences(queries.queries()[name](spark, SF_DIR), connect(SF_DIR), sql) is None
