import re

from llm.odd import documents, empty, plain, table, unchanged_columns

from carelake.llm import line_dedup


def one_edit(a, b):
    """Word edit distance of at most one, by the whole table."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] <= 1


def lower_words(line):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w]


def brute(rows, min_words=5, near_words=10):
    """Lines to drop by doc_id and text, comparing each line with all before it."""
    keyed = sorted({(r.doc_id is None, r.doc_id or 0, r.h, r.text) for r in rows if r.text is not None})
    seen, out = [], {}
    for none, doc_id, _, text in keyed:
        gone = []
        for no, line in enumerate(text.split("\n")):
            words = lower_words(line)
            if len(words) < min_words:
                continue
            near = lambda o, w=words: w == o or (abs(len(w) - len(o)) <= 1 and max(len(w), len(o)) >= near_words and one_edit(w, o))
            if any(near(o) for o in seen):
                gone.append(no)
            seen.append(words)
        out[(None if none else doc_id, text)] = gone
    return out


def check(docs, **limits):
    rows = docs.selectExpr("doc_id", "text", "xxhash64(text) as h").collect()
    want = brute(rows, **limits)
    expected = []
    for r in rows:
        gone = want.get((r.doc_id, r.text), [])
        lines = None if r.text is None else r.text.split("\n")
        text = r.text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        expected.append((r.doc_id, 0 if lines is None else len(lines), gone, text))
    assert plain(line_dedup.dedup_lines(docs, **limits)) == sorted(expected, key=repr)


def test_against_every_earlier_line(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    w = base.split()
    texts = [
        base, " ".join(w[:3] + w[4:]), " ".join(w[:3] + ["new"] + w[3:]), " ".join([*w[:9], "last"]), " ".join(["first", *w[1:]]),
        " ".join(w[:2] + ["x"] + w[2:7] + ["y"] + w[7:]), " ".join(reversed(w)), " ".join([w[1], w[0], *w[2:]]), "na " * 12 + "na", "na " * 12,
        "na " * 6 + "no " + "na " * 6, f"{base}\n{base}\n  {base.upper()}  ", "a b c d", "a b c d", "a b c d e", "a b c d e", "a b c d f",
        "one two one two one two one two one two one", "one two one two one two one two one two", "two one two one two one two one two one",
    ]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    check(spark.createDataFrame(list(enumerate(reversed(texts))), "doc_id long, text string"), min_words=1, near_words=3)


def test_random_small_vocabulary(spark):
    import random

    r = random.Random(5)
    rows = [(i, "\n".join(" ".join(r.choice("abc") for _ in range(r.randint(0, 9))) for _ in range(3))) for i in range(120)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), min_words=3, near_words=5)


def test_documents_of_the_table(spark):
    check(table(spark, "documents"))


def test_odd_documents(spark):
    check(documents(spark))
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_hash_collisions_are_verified(spark):
    # The first step of the join ignores word order: all these meet there, few are one edit apart.
    import itertools

    words = "p q r s t u v w x y z".split()
    texts = [" ".join([*perm, *words[4:]]) for perm in itertools.permutations(words[:4])]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_stage(spark):
    docs = documents(spark)
    left = line_dedup.deduped_documents(docs)
    unchanged_columns(docs, left)
    ids = [r.doc_id for r in left.collect()]
    assert 10 not in ids and 11 not in ids and 3 not in ids  # nothing but lines that stand in document 1
    assert {1, 2, 4, 5, 6, 7, 8, 9} <= set(ids) and ids.count(None) == 2
    two = left.where("doc_id = 2").first()
    assert (two.text, two.n_chars) == ("other words follow here in this text", 36)
    assert line_dedup.deduped_documents(empty(spark)).count() == 0


def test_short_lines_keep_their_document(spark):
    footer = "all rights of this page are reserved"
    verse = "roses are red\nviolets\n\nand so on"
    rows = [(1, footer), (2, f"{verse}\n{footer}"), (3, f"{footer}\n \t\n"), (4, f"{footer}\n-"), (5, footer)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = brute([r for r in docs.selectExpr("doc_id", "text", "xxhash64(text) as h").collect()])
    want = []
    for doc_id, text in rows:
        left = [x for i, x in enumerate(text.split("\n")) if i not in gone[(doc_id, text)]]
        if not gone[(doc_id, text)] or any(lower_words(x) for x in left):
            want.append((doc_id, "\n".join(left)))
    assert want == [(1, footer), (2, verse), (4, "-")]
    assert plain(line_dedup.deduped_documents(docs)) == sorted(want, key=repr)


def test_short_repeats_go_in_query_and_stage(spark, tmp_path):
    import corpus_pipeline

    from carelake.llm import queries

    texts = ["Menu\nread more\nread  More\nMenu", "menu\nown words", "one two three four five\nhome", "one two three four\none two three six", "one two three nine five\n \n-"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    left = ["Menu\nread more", "own words", "one two three four five\nhome", "one two three six", " \n-"]
    got = queries.op3_line_dedup(spark, str(tmp_path))
    assert plain(got, "doc_id", "text") == list(enumerate(left))
    rows = docs.selectExpr("doc_id", "text", "xxhash64(text) as h").collect()
    assert {r.doc_id: r.dropped for r in got.collect()} == {k[0]: v for k, v in brute(rows, 1, 5).items()}
    assert plain(corpus_pipeline.line_dedup_stage(spark, docs, "")) == list(enumerate(left))
