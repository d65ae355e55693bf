"""The stages on the small table, each against a plain version of itself on its own input."""

from collections import Counter, defaultdict

import corpus_pipeline
from conftest import SF_DIR
from llm.odd import documents, empty, table
from llm.test_line_dedup import brute as line_brute
from llm.test_line_dedup import lower_words
from llm.test_packing import pieces
from llm.test_shingles import brute as group_brute

from carelake.llm import line_dedup, mixing, quality


def key(r):
    return r.doc_id, r.text


def test_stages_one_by_one(spark, tmp_path):
    docs = table(spark, "documents")
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        outs.append((docs, spark.read.parquet(str(tmp_path / name))))
        docs = outs[-1][1]
    for before, after in outs[:-1]:
        assert after.columns == before.columns

    (first, kept), (_, lines), (_, groups), (_, mixed), (_, packed) = outs
    model = quality.train(first, table(spark, "labels"))
    want = {r.doc_id for r in quality.judge(first, model).collect() if r.kept}
    assert {r.doc_id for r in kept.collect()} == want
    good = {r.doc_id for r in table(spark, "labels").collect() if r.quality == 1}
    judged = {r.doc_id: r for r in quality.judge(first, model).collect()}
    assert all(i in want for i in good if not judged[i].base_failed)  # clean documents stay

    rows = kept.selectExpr("doc_id", "text", "xxhash64(text) as h").collect()
    gone = line_brute(rows, line_dedup.MIN_WORDS, line_dedup.NEAR_WORDS)
    expected = Counter()
    for r in rows:
        left = [x for i, x in enumerate(r.text.split("\n")) if i not in gone[key(r)]]
        if not gone[key(r)] or any(lower_words(x) for x in left):
            expected[(r.doc_id, "\n".join(left))] += 1
    assert Counter(map(key, lines.collect())) == expected
    assert all(r.n_chars == len(r.text) for r in lines.collect() if gone.get((r.doc_id, r.text)) is None)

    rows = lines.select("doc_id", "text").collect()
    stay = {c for d, _, c in group_brute(rows, 5, 80)}
    assert sorted(r.doc_id for r in groups.collect()) == sorted(stay)

    taken = {r.doc_id: r.taken // r["size"] for r in mixing.mix(groups).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({d: n for d, n in taken.items() if n})

    want = Counter(p for r in mixed.collect() for p in pieces(r.doc_id, r.text, 4096))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed.collect()) == want
    room = defaultdict(int)
    for r in packed.collect():
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 4096 and len(room) <= -(-sum(room.values()) // 4096) + 2


def test_odd_documents_pass_all_stages(spark, tmp_path):
    for n, docs in enumerate((documents(spark), empty(spark))):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{n}-{name}")
            stage(spark, docs, SF_DIR).write.parquet(path)
            docs = spark.read.parquet(path)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
