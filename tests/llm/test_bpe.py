import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casegauge.llm import bpe
from casegauge.llm.common import table
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


def random_texts(n):
    rng = random.Random(3)
    pick = [lambda: rng.randrange(32, 127), lambda: rng.randrange(0, 0x300),
            lambda: rng.randrange(0x300, 0xD800), lambda: rng.randrange(0xE000, 0x40000),
            lambda: 32, lambda: 0x558, lambda: 0x18DC8]
    return ["".join(chr(rng.choice(pick)()) for _ in range(rng.randrange(80))) for _ in range(n)]


def test_ids_and_texts_equal_the_library(library):
    texts = random_texts(1500) + ["aaaaaaa aaaa", "ab" * 900, "é" * 700, "<|endoftext|><|endoftext|>",
                                  "x<|endoftext|> <|endoftext", "don't I'LL we've", "", "1234567" * 99]
    vocabulary = bpe.load(bpe.vocabulary_path())
    for text, ids in zip(texts, vocabulary.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert vocabulary.decode(ids.astype("int64")) == library.decode(want, skip_special_tokens=False)


def test_heap_and_rounds_agree():
    vocabulary = bpe.load(bpe.vocabulary_path())
    word = ("the" * 60 + "ing" * 60 + "aaaa" * 30).encode()
    assert bpe.LONG_WORD < len(word) < 2 * bpe.LONG_WORD
    symbols = vocabulary.byte_id[list(word)]
    heap, _ = vocabulary._merge_long(symbols)
    held, bpe.LONG_WORD = bpe.LONG_WORD, 10 ** 9
    try:
        rounds, _ = vocabulary.merge_words([word])
    finally:
        bpe.LONG_WORD = held
    assert heap.tolist() == rounds.tolist()


def test_documents_round_trip(spark, library):
    rows = bpe.round_trip(table(spark, SF_SMALL, "documents"), bpe.vocabulary_path()).collect()
    for r in rows:
        assert list(memoryview(bytes(r.ids)).cast("I")) == \
            library.encode(r.text, add_special_tokens=False).ids
        assert r.decoded == r.text


def test_odd_rows(odd, none, library):
    _, df = odd
    path = bpe.vocabulary_path()
    apart = bpe.decode(bpe.encode(df, path), path)
    assert apart.columns == [*df.columns, "ids", "decoded"]
    for r in bpe.unpack_ids(apart).collect():
        assert r.token_ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")
    assert bpe.digest(df, path).count() == df.count()
    assert bpe.digest(none, path).count() == 0


def test_digest_columns(odd):
    import hashlib
    r = bpe.digest(odd[1].where(F.col("text") == "one"), bpe.vocabulary_path()).collect()[0]
    ids = bpe.load(bpe.vocabulary_path()).encode(["one"])[0]
    assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
    assert r.decoded_sha256 == hashlib.sha256(b"one").hexdigest()
