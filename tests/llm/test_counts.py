from llm.odd import documents, empty, plain, table
from tokenizers import Tokenizer

from carelake.llm import bpe_count
from carelake.llm.queries import BYTE_VOCABULARY

TOKENIZER = Tokenizer.from_file(BYTE_VOCABULARY)
ODD = [
    "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  \n\n y\t z 　 é k 's we'll'd 12345 \x1c \x85 ", "don't   ", " a", "日本語テキスト 😀😀 ok", "\x00\x01",
    "a" * 3000, " " * 50 + "x", "\r\n\r\na", "ǅ Ⅷ ² ½ x́", "\u2028\u2029\u1680x\u200b y\ufeff", "the" * 40, "0" * 100, "…" * 30 + " …", "'S 'll' ''s",
]


def test_against_the_library(spark):
    docs = documents(spark, *[(100 + i, t, "a") for i, t in enumerate(ODD)])
    for frame in (docs, table(spark, "documents")):
        want = []
        for r in frame.collect():
            n = len(TOKENIZER.encode(r.text or "", add_special_tokens=False).ids)
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 1024))
        assert plain(bpe_count.count_tokens(frame, BYTE_VOCABULARY)) == sorted(want, key=repr)
    assert bpe_count.count_tokens(empty(spark), BYTE_VOCABULARY).count() == 0


def test_caches_that_fill_up(monkeypatch):
    monkeypatch.setattr(bpe_count, "CACHE_SIZE", 3)
    count = bpe_count.Counter(bpe_count.Merges(BYTE_VOCABULARY))
    for text in ODD * 2:
        assert count.tokens(text) == len(TOKENIZER.encode(text, add_special_tokens=False).ids)
