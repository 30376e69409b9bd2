import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wordloom.llm.bpe import vocabulary
from wordloom.llm.bpe_encode import bpe_digests, decode, encode
from wordloom.llm.token_count import Counter, token_counts

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = [
    "", " ", "Hello World's I'LL we'd 's", "a\x1cb \x1f c", "<|endoftext|>", "x<|startoftext|>y <|endoftext|>  z  <|endoftext|>", "ΑΣ ΣΑΣ İstanbul ẞ",
    "é ́a  \n\n b\t\t c   ", "aaaaaaaaaaaaaaaaa" * 90, "\n", "a b　 c d", "日本語テキスト 한국어 नमस्ते ① ² ½ 123456 ١٢٣", "\U0001f600\U0001f468‍\U0001f469 �\x00\x01", "e ́",
    "the quick brown fox " * 50, "x" * 3000 + " " * 500 + "y",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    pools = [range(32, 127), range(0xA0, 0x250), range(0x370, 0x530), range(0x4E00, 0x4F00), range(0x1F600, 0x1F640), [32, 10, 39, 9, 0x301, 0x2003]]
    mixed = ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(60))) for _ in range(300)]
    return TEXTS + mixed


def test_ids_and_decoding_are_the_library_s(texts):
    library = Tokenizer.from_file(WORD)
    got = encode(texts, WORD)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    assert [decode(ids, WORD) for ids in got] == [library.decode(ids, skip_special_tokens=False) for ids in want]


def test_counts_are_the_library_s(texts):
    library = Tokenizer.from_file(BYTE)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert Counter(BYTE).count(texts) == want


def test_merge_rounds_equal_one_merge_at_a_time():
    vocab = vocabulary(BYTE)
    rank = {int(k): (int(r), int(m)) for k, r, m in zip(vocab.keys, vocab.ranks, vocab.made)}
    rng = random.Random(3)
    words = ["".join(rng.choice("abehlnot ") for _ in range(rng.randrange(1, 30))).encode() for _ in range(200)]
    ids, counts = vocab.encode(words)
    at = 0
    for word, n in zip(words, counts.tolist()):
        symbols = [int(vocab.inner[b]) for b in word]
        while True:
            pairs = [(rank[a * vocab.size + b][0], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a * vocab.size + b in rank]
            if not pairs:
                break
            _, i = min(pairs)
            symbols[i : i + 2] = [rank[symbols[i] * vocab.size + symbols[i + 1]][1]]
        assert ids[at : at + n].tolist() == symbols
        at += n


def test_digests(spark, odd_docs, no_docs):
    rows = bpe_digests(odd_docs, WORD).collect()
    library = Tokenizer.from_file(WORD)
    plain = odd_docs.toDF("doc_id", "text", *[f"x{i}" for i in range(5)])
    texts = {r.doc_id: r.text or "" for r in plain.collect()}
    assert len(rows) == plain.count()
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe_digests(no_docs, WORD).count() == 0


def test_token_counts(odd_docs, no_docs):
    rows = token_counts(odd_docs, BYTE).collect()
    library = Tokenizer.from_file(BYTE)
    plain = odd_docs.toDF("doc_id", "text", *[f"x{i}" for i in range(5)])
    texts = {r.doc_id: r.text or "" for r in plain.collect()}
    assert len(rows) == plain.count()
    for r in rows:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)
    assert token_counts(no_docs, BYTE).count() == 0
