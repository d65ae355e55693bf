import struct
import zlib
from collections import defaultdict

import numpy as np
from llm.odd import documents, empty, table
from tokenizers import Tokenizer

from carelake.llm import packing
from carelake.llm.queries import WORD_VOCABULARY

TOKENIZER = Tokenizer.from_file(WORD_VOCABULARY)


def pieces(doc_id, text, capacity):
    ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]
    for k, at in enumerate(range(0, len(ids), capacity)):
        part = ids[at : at + capacity]
        yield doc_id, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))


def check(docs, capacity=4096):
    rows = packing.pack_documents(docs, WORD_VOCABULARY, capacity).collect()
    want = [p for r in docs.select("doc_id", "text").collect() for p in pieces(r.doc_id, r.text, capacity)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r.length for r in rows)


def test_table_round_trip(spark):
    n, tokens = check(table(spark, "documents"))
    assert n <= -(-tokens // 4096) + 2


def test_odd_documents(spark):
    odd = [(20, "<|endoftext|>x y<|startoftext|>", "a"), (21, "don't we'LL İSTANBUL ΣΑΣ é ab12 \x1c\x85q 日本語", "a"), (22, "ĲŸſ ﬁ Ǆ", "b")]
    check(documents(spark, *odd))
    check(documents(spark, *odd), capacity=7)
    assert packing.pack_documents(empty(spark), WORD_VOCABULARY).count() == 0


def test_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 40)
    n, tokens = check(table(spark, "documents"))
    assert n <= -(-tokens // 4096) + 8


def test_large_items_pair_and_small_ones_fill():
    random = np.random.default_rng(2)
    for lengths in (random.integers(1, 4097, 3000), random.integers(1366, 4097, 500), random.integers(1, 1366, 900), np.full(7, 4096), np.full(9, 2048), np.array([1]), np.array([], dtype=int)):
        bins, offsets = packing.pack(lengths.astype(np.int64), 4096)
        used = np.bincount(bins, lengths, minlength=0) if len(lengths) else np.zeros(0)
        assert (used <= 4096).all()
        large = lengths * 3 > 4096
        assert not len(lengths) or np.bincount(bins[large]).max(initial=0) <= 2
        for b in set(bins.tolist()):
            own = sorted((o, n) for o, n, x in zip(offsets.tolist(), lengths.tolist(), bins.tolist(), strict=True) if x == b)
            assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist()
        least = max(-(-int(lengths.sum()) // 4096), int((lengths > 2048).sum()))
        assert len(used) <= least * 1.02 + 1 or large.all()


def test_words_of_a_worker_go_when_another_operator_has_it():
    from carelake.llm import batches

    # In one process, as in a worker that is used again: packing keeps its words, another operator lets them go.
    assert packing.encoder(WORD_VOCABULARY).encode("some words") and packing.encoder.cache_info().currsize
    batches.release_others(packing.__name__)
    assert packing.encoder.cache_info().currsize
    batches.release_others("carelake.llm.quality")
    assert not packing.encoder.cache_info().currsize
