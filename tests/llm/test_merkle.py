import hashlib
import zlib

from llm.odd import documents, empty, table

from carelake.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: h(*[field(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    def siblings(levels, i):
        out = []
        for level in levels[:-1]:
            start = i // 16 * 16
            out.append((level[start:i], level[i + 1 : start + 16]))
            i //= 16
        return out

    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for found in by_source.values():
        found.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    trees = [tree([leaf(r, r.text) for r in by_source[s]]) for s in order]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by_source[s]):
            path, text = siblings(trees[k], i) + siblings(top, k), r.text
            if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(r, text)
            for before, after in path:
                folded = h(*before, folded, *after)
            out.append((r.doc_id, trees[k][0][i], trees[k][-1][0], top[-1][0], h(*[x for b, a in path for x in b + a]), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def check(docs):
    got = merkle.manifest(docs, merkle.lowered, merkle.every_fifth(docs["doc_id"])).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs.collect())
    return got


def test_table(spark):
    got = check(table(spark, "documents"))
    assert 0 < sum(not r.verified for r in got) < len(got) / 2


def test_odd_documents(spark):
    check(documents(spark))
    assert merkle.manifest(empty(spark)).collect() == []
    check(documents(spark).limit(1))


def test_sizes_around_the_fanout(spark):
    sizes = {"a": 1, "b": 15, "c": 16, "d": 17, None: 256, "e": 257, "hot": 700, **{f"s{i}": 1 for i in range(40)}}
    rows = [(i, s, "en", i % 3 or None, f"Text {i}") for s, n in sizes.items() for i in range(n)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(6))


def test_order_of_the_table_does_not_matter(spark):
    docs = table(spark, "documents")
    root = lambda d: {r.root for r in merkle.manifest(d).select("root").distinct().collect()}
    assert root(docs) == root(docs.orderBy("text").repartition(5)) and len(root(docs)) == 1
    assert all(r.verified for r in merkle.manifest(docs).collect())
