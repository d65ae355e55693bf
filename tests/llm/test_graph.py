import numpy as np
from llm.odd import table

from carelake.llm import graph_search as G


def brute(pairs, queries, nearest=5):
    """Exact answers: {query: [(vec_id, score)]} in order."""
    ids = np.array([i for i, _ in pairs])
    matrix = np.array([v for _, v in pairs], dtype=np.float64)
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    out = {}
    for q, v in queries:
        v = np.asarray(v, dtype=np.float64)
        scores = (matrix * v).sum(axis=1) / (norms * np.sqrt((v * v).sum()))
        order = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if i != q)
        out[q] = [(i, -s) for s, i in order[:nearest]]
    return out


def answers(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    """Share of wanted places whose score is reached."""
    hits = sum(sum(a[1] >= b[1] - 1e-12 for a, b in zip(got.get(q, []), w, strict=False)) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def run(vectors, every=50, **kw):
    written = G.written(vectors, "test-vectors")
    index, shards = G.build_index(written, **kw)
    return index, answers(G.search(index, shards, written.where(f"vec_id % {every} = 0")).collect())


def test_recall_and_scores(spark):
    vectors = G.valid_vectors(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
    pairs = [(r.vec_id, r.vector) for r in vectors.collect()]
    want = brute(pairs, [p for p in pairs if p[0] % 50 == 0])
    for shard_rows in (8192, 300):
        index, got = run(vectors, shard_rows=shard_rows)
        assert index.selectExpr("sum(size(vec_ids))").first()[0] == len(pairs)  # every row is indexed
        assert recall(got, want) >= 0.95
        exact = {i: dict(w) for i, w in brute(pairs, [p for p in pairs if p[0] % 50 == 0], len(pairs)).items()}
        for q, found in got.items():
            assert found == sorted(found, key=lambda x: (-x[1], x[0])) and len(found) == 5
            assert all(abs(exact[q][i] - s) < 1e-12 for i, s in found)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, []), (None, [1.0, 1.0]), (8, [-1.0, 0.0]), (50, [1.0, 0.0, 0.0]), (9, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, shard int")
    _, got = run(G.valid_vectors(df))
    assert [i for i, _ in got[0]] == [1, 9, 8] and got[0][0][1] == 1.0
    assert 50 not in got  # nothing else has its length
    none = df.limit(0)
    assert G.valid_vectors(none).count() == 0
    _, got = run(G.valid_vectors(none))
    assert got == {}


def test_one_vector_a_third_of_all(spark):
    random = np.random.default_rng(1)
    rows = [(i, ([1.0] * 16 if i % 3 == 0 else random.normal(size=16).round(6).tolist())) for i in range(1500)]
    _, got = run(spark.createDataFrame(rows, "vec_id long, vector array<double>"), shard_rows=400)
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    assert recall(got, want) >= 0.9
    for q in want:
        if q % 3 == 0:  # ties of equal vectors go to the least ids
            assert [i for i, _ in got[q]] == [i for i in range(0, 60, 3) if i != q][:5]


def test_tables_agree(spark):
    vectors = G.valid_vectors(table(spark, "embeddings"))
    assert vectors.count() == table(spark, "embeddings").count()


def test_near_and_scaled_copies(spark):
    random = np.random.default_rng(4)
    base = random.normal(size=(260, 32))
    near = base.copy()
    near[:60] = base[0] + random.normal(size=(60, 32)) * 1e-4
    twos = base.copy()
    twos[:60] = base[0] * np.exp2(np.arange(60) - 30)[:, None]
    for vectors in (near, twos):
        rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
        _, got = run(spark.createDataFrame(rows, "vec_id long, vector array<double>"), every=10)
        want = brute(rows, [r for r in rows if r[0] % 10 == 0])
        for q in range(0, 60, 10):
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert recall(got, want) >= 0.95


def test_scaled_copies_by_any_factor(spark):
    """Copies have a cosine of one but for rounding, so any of them may come first: none is lost to another vector."""
    random = np.random.default_rng(5)
    base = random.normal(size=(260, 32))
    base[:60] = base[0] * (np.arange(60) + 1.0)[:, None] / 7
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    _, got = run(spark.createDataFrame(rows, "vec_id long, vector array<double>"), every=10)
    want = brute(rows, [r for r in rows if r[0] % 10 == 0])
    for q in range(0, 60, 10):
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and all(i < 60 and s > 1 - 1e-15 for i, s in got[q])


def test_large_and_small_components(spark):
    rows = [(0, [1e200, 1.0]), (1, [1e200, 2.0]), (2, [1.0, 1.0]), (50, [1e-200, 1e-200]), (3, [5e-324, 0.0]), (4, [-1e308, 1e308])]
    _, got = run(spark.createDataFrame(rows, "vec_id long, vector array<double>"))
    half = round(0.5**0.5, 12)
    to_12 = lambda found: {(i, round(s, 12)) for i, s in found}
    assert to_12(got[0]) == {(1, 1.0), (3, 1.0), (2, half), (50, half), (4, -half)}
    assert to_12(got[50]) == {(2, 1.0), (0, half), (1, half), (3, half), (4, 0.0)}
