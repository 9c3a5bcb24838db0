import base64
import hashlib
import random

import pytest
import regex
import tiktoken

from casegauge.llm import bpe_sql
from casegauge.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.conftest import odd_texts

PATH = bpe_sql.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def unpack(packed):
    return list(memoryview(bytes(packed)).cast("I"))


def random_texts():
    rng = random.Random(6)
    points = [*range(1, 0x250), *range(0x300, 0x370), *range(0x4e00, 0x4e40), 0x85, 0x2028, 0x3000,
              0x1F44D, 0x1F3FD, 0x558, 0x11de0, 0x88f, 0x200d, 0xfe0f, *b" \t\n\r\n  '''sdtremll"]
    return ["".join(chr(rng.choice(points)) for _ in range(rng.randrange(1, 400)))
            for _ in range(300)] + [
        "'s 't're IT'S  we'll\n\n  x\t\t y   ", "a" * 1001, "ab" * 999 + "a", " " * 700 + "x",
        "\n" * 333, "=" * 5001, "".join(rng.choices("abcdefgh", k=3000)), "<|endoftext|>"]


def test_equals_the_library(library):
    texts = [t or "" for t in odd_texts()] + random_texts()
    coder = bpe_sql.load(PATH)
    packed = coder.encode(texts)
    for t, p in zip(texts, packed):
        assert unpack(p) == library.encode_ordinary(t), t[:80]
    assert coder.decode(packed) == [t.encode() for t in texts]


def test_characters_that_the_library_counts_otherwise(library):
    """Each character of every class after a letter, a number and a blank."""
    text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}\n" for c in range(1, 0x110000, 37)
                   if not 0xd800 <= c < 0xe000)
    assert unpack(bpe_sql.load(PATH).encode([text])[0]) == library.encode_ordinary(text)


def test_leftmost_only_gives_the_same():
    coder = bpe_sql.load(PATH)
    words = [w.encode() for t in random_texts()[:40] for w in coder.pretokens(t)]
    all_at_once, plain = coder.merge_words(words), coder.merge
    coder.merge = coder.steps(bpe_sql.LEFTMOST)
    try:
        assert coder.merge_words(words) == all_at_once
    finally:
        coder.merge = plain


def test_a_vocabulary_out_of_merge_order(tmp_path):
    """Ranks whose tokens come before their parts: the step takes the leftmost pair only."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"ab", b"bc", b"cab", b"aa", b"aab"]
    file = tmp_path / "own.tiktoken"
    file.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    coder = bpe_sql.Coder(str(file))
    own = tiktoken.Encoding("own", pat_str=r"\w+", special_tokens={},
                            mergeable_ranks={t: i for i, t in enumerate(tokens)})
    rng = random.Random(2)
    words = ["".join(rng.choices("abc", k=rng.randrange(1, 40))) for _ in range(300)]
    for w, p in zip(words, coder.encode(words)):
        assert unpack(p) == own.encode_ordinary(w)


def test_slices_don_t_show(library, monkeypatch):
    """Cut texts, small blocks of words and ids, and a cache that keeps being emptied."""
    for name, value in (("SLICE", 50), ("WORDS", 64), ("TOKENS", 7), ("KEPT", 20)):
        monkeypatch.setattr(bpe_sql, name, value)
    coder = bpe_sql.load(PATH)
    texts = random_texts()[:60] + ["one two\n\n three  four " * 30, "", "x" * 300]
    packed = coder.encode(texts)
    assert [unpack(p) for p in packed] == [library.encode_ordinary(t) for t in texts]
    assert coder.decode(packed) == [t.encode() for t in texts]
    assert all("".join(coder.pieces(t)) == t for t in texts)
    assert max(len(coder.pieces(t)) for t in texts) > 5


def test_query_on_whole_documents(spark, library):
    docs = table(spark, SF_SMALL, "documents")
    got = {r.doc_id: r for r in bpe_sql.digest(docs, PATH).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert tuple(got[r.doc_id]) == (
            r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(),
            hashlib.sha256((r.text or "").encode()).hexdigest())


def test_odd_rows(odd, none, library):
    rows, df = odd
    coded = bpe_sql.decode(bpe_sql.encode(df, PATH), PATH)
    assert coded.columns == [*df.columns, "ids", "decoded"]
    got = sorted(((r.doc_id, r.text, unpack(r.ids), bytes(r.decoded)) for r in coded.collect()), key=str)
    assert got == sorted([(i, t, library.encode_ordinary(t or ""), (t or "").encode())
                          for i, t, _ in rows], key=str)
    assert bpe_sql.digest(none, PATH).collect() == []
    with pytest.raises(ValueError):
        bpe_sql.load(PATH).decode([b"\xff\xff\xff\x7f"])


def test_cuts_lie_between_pretokens():
    import public_tokenizers
    find = regex.compile(public_tokenizers.PATTERN).findall
    for t in random_texts()[:100]:
        for m in regex.finditer(r"\S(?=\s)", t):
            assert find(t[:m.end()]) + find(t[m.end():]) == find(t)
