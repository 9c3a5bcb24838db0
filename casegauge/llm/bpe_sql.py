"""Byte-level BPE by ranks, in DuckDB recursive queries inside each task.

``encode`` splits the texts of a slice by the pretoken pattern and merges each distinct word
once. The words' bytes become token-position rows (word, pos, fin, id: fin is where the next one stands);
a recursion step joins each row with its successor and with the merge table, takes every word's
lowest rank, and contracts that pair from the left. Words without a pair leave with their ids, so the
recursion ends at the fixpoint. Of a word's occurrences of its lowest pair all that don't overlap
are contracted in one step, leftmost first: with ranks in merge order a contraction never makes
a pair that goes before it, so one by one gives the same (checked when the file is loaded; for
any other file a step contracts the leftmost one only).

The merge table holds one pair per token, the last one of the token's own merging: any other
pair of tokens with the same bytes can't come to stand side by side, because whatever merges
inside the two, and not across them, does the same in the token alone.

``decode`` joins the positions of ids with the tokens' bytes and puts them together by ordered
aggregation. Both go through bounded slices (``SLICE`` bytes of text, ``WORDS`` bytes of distinct
words, ``TOKENS`` ids); texts beyond a slice are cut where a blank follows a non-blank, which
no pretoken crosses. A worker keeps the ids of up to ``KEPT`` words for the next slices. The
vocabulary is named by path (a parameter) and read once per Python worker.

Defined results: a null text counts as empty (no ids, decodes to empty bytes); there are no
special tokens, their strings are ordinary text; a word that is itself a token is that
token; repeated rows are encoded one by one; extra columns ride along untouched; an id
outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import os
import re
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.llm.bpe import NEWER
from casegauge.llm.common import text_batches

VOCABULARY = "byte_bpe_50k.tiktoken"
SLICE, WORDS, TOKENS, KEPT = 1 << 21, 1 << 18, 1 << 18, 1_500_000

# A word's last symbol has fin -1, so that positions alone lead to the next symbol. {chosen}: the
# contractions of a step among the hits (rows whose pair is their word's lowest) of equal
# symbols, the only ones that overlap; {others}: among the other hits.
MERGE = """
WITH RECURSIVE state(word, pos, fin, id, live) AS (
  SELECT word, pos, fin, id, true FROM start
  UNION ALL (
  WITH now AS MATERIALIZED (SELECT word, pos, fin, id FROM state WHERE live),
  pairs AS MATERIALIZED (
    SELECT a.word, a.pos, b.pos AS mid, b.fin, m.made, a.id = b.id AS twin
    FROM now a JOIN now b ON b.pos = a.fin
    JOIN merges m ON m.pair = a.id::BIGINT * {size} + b.id),
  best AS MATERIALIZED (SELECT word, min(made) AS made FROM pairs GROUP BY word),
  hits AS MATERIALIZED (SELECT pairs.* FROM pairs JOIN best USING (word, made)),
  twins AS (
    SELECT *, coalesce(lag(mid) OVER (PARTITION BY word ORDER BY pos) = pos, false) AS goes_on
    FROM hits WHERE twin),
  runs AS (
    SELECT *, count_if(NOT goes_on) OVER (PARTITION BY word ORDER BY pos) AS run FROM twins),
  chosen AS (
    SELECT pos, mid, fin, made FROM hits WHERE NOT twin {others}
    UNION ALL SELECT pos, mid, fin, made FROM runs {chosen}),
  changes AS MATERIALIZED (
    SELECT pos, fin, made FROM chosen UNION ALL SELECT mid, NULL, -1 FROM chosen)
  SELECT n.word, n.pos, coalesce(c.fin, n.fin), coalesce(c.made, n.id), b.word IS NOT NULL
  FROM now n LEFT JOIN changes c USING (pos) LEFT JOIN best b ON b.word = n.word
  WHERE c.made IS DISTINCT FROM -1))
SELECT word, id FROM state WHERE NOT live ORDER BY pos
"""
FIRST = "QUALIFY row_number() OVER (PARTITION BY word ORDER BY pos) = 1"
# all that don't overlap, leftmost first; or the leftmost one (a word's hits are all twins or none)
EVERY = {"others": "", "chosen": "QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY pos) % 2 = 1"}
LEFTMOST = {"others": FIRST, "chosen": FIRST}
# a token's bytes are text of as many characters, U+0000 to U+00FF
DECODE = """
SELECT doc, string_agg(chars, '' ORDER BY pos) AS chars
FROM ids JOIN tokens USING (id) GROUP BY doc ORDER BY doc
"""


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    """The two tokens that the last merge of ``token`` joins; None if merging stops before."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, i = min((ranks.get(a + b, len(ranks) << 1), i)
                      for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == len(ranks) << 1:
            return None
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return ranks[parts[0]], ranks[parts[1]]


class Coder:
    """One vocabulary in an in-memory database of this process."""

    def __init__(self, path: str):
        import duckdb
        import public_tokenizers
        import regex

        self.ranks = read_ranks(path)
        self.id_of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [(*pair, made) for token, made in self.ranks.items() if len(token) > 1
                  if (pair := last_pair(token, self.ranks))]
        single = set(self.id_of_byte.tolist())
        in_order = all(made > part for *pair, made in merges
                       for part in pair if part not in single)
        self.known = np.zeros(max(self.ranks.values()) + 1, bool)
        self.merge = self.steps(EVERY if in_order else LEFTMOST)
        self.known[list(self.ranks.values())] = True
        self.db = duckdb.connect(config={
            "threads": 1, "memory_limit": "700MB",
            "temp_directory": os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")})
        self._table("merges", pair=[left * len(self.known) + right for left, right, _ in merges],
                    made=[m[2] for m in merges])
        self._table("tokens", id=pa.array(self.ranks.values(), pa.int32()),
                    chars=[t.decode("latin-1") for t in self.ranks])
        pattern = public_tokenizers.PATTERN
        newer = "[" + NEWER.replace(" ", "") + "]"
        self._newer = re.compile(newer).search
        self._split = regex.compile(pattern).findall
        # characters that the library's tables don't know yet count as neither letter nor number
        self._split_newer = regex.compile(
            pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|{newer})")
            .replace(r"\p{L}+|", rf"(?:(?!{newer})\p{{L}})+|")
            .replace(r"\p{N}+|", rf"(?:(?!{newer})\p{{N}})+|")).findall
        self._edge = regex.compile(r"\S(?=\s)").search
        self.kept: dict[str, bytes] = {}

    def steps(self, choice: dict[str, str]) -> str:
        return MERGE.format(size=len(self.known), **choice)

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    # -- words -----------------------------------------------------------------

    def pretokens(self, text: str) -> list[str]:
        return (self._split if text.isascii() or not self._newer(text)
                else self._split_newer)(text)

    def pieces(self, text: str) -> list[str]:
        """The text in pieces of about SLICE characters that no pretoken crosses."""
        out, lo = [], 0
        while len(text) - lo > SLICE and (edge := self._edge(text, lo + SLICE)):
            out.append(text[lo:edge.end()])
            lo = edge.end()
        return [*out, text[lo:]]

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.id_of_byte[np.frombuffer(b"".join(words), np.uint8)]
        pos = np.arange(len(symbols), dtype=np.int32)  # a block of words is far below 2 GB
        fin = pos + 1
        fin[np.cumsum(sizes) - 1] = -1
        self.db.register("start", pa.table({
            "word": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "pos": pos,
            "fin": fin, "id": symbols}))
        found = self.db.execute(self.merge).fetchnumpy()
        self.db.unregister("start")
        ids = np.asarray(found["id"]).astype("<u4")
        ends = np.searchsorted(np.asarray(found["word"]), np.arange(len(words)), "right")
        return [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends)]

    def learn(self, words: set[str]) -> None:
        """Put the words' ids among the kept ones."""
        new = []
        for word in words:
            data = word.encode()
            rank = self.ranks.get(data)
            if rank is None:
                new.append((word, data))
            else:
                self.kept[word] = rank.to_bytes(4, "little")
        lo, size = 0, 0
        for hi, (_, data) in enumerate(new, 1):
            size += len(data)
            if size >= WORDS or hi == len(new):
                block = new[lo:hi]
                for (word, _), ids in zip(block, self.merge_words([d for _, d in block])):
                    self.kept[word] = ids
                lo, size = hi, 0

    # -- texts -----------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids (little-endian unsigned 32-bit) of each text."""
        split = [[] for _ in texts]
        for i, text in enumerate(texts):
            for piece in self.pieces(text):
                words = self.pretokens(piece)
                if len(text) > SLICE:  # stands alone in its slice: keep its ids, not its words
                    words = [self._packed([words])[0]]
                split[i].append(words)
        long = [len(text) > SLICE for text in texts]
        packed = iter(self._packed([words for i, parts in enumerate(split) if not long[i]
                                    for words in parts]))
        return [b"".join(ids for part in parts for ids in part) if long[i]
                else b"".join(next(packed) for _ in parts) for i, parts in enumerate(split)]

    def _packed(self, lists: list[list[str]]) -> list[bytes]:
        need: set[str] = set()
        for words in lists:
            need.update(set(words).difference(self.kept))
        if len(self.kept) + len(need) > KEPT:
            self.kept.clear()
            need = set().union(*lists)
        self.learn(need)
        return [b"".join(map(self.kept.__getitem__, words)) for words in lists]

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """The bytes of each sequence of packed ids."""
        ids = np.frombuffer(b"".join(packed), "<u4")
        if len(ids) and (ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id isn't in the vocabulary")
        doc = np.repeat(np.arange(len(packed), dtype=np.int32), [len(p) // 4 for p in packed])
        out: list[list[bytes]] = [[] for _ in packed]
        for lo in range(0, len(ids), TOKENS):
            here = ids[lo:lo + TOKENS]
            self.db.register("ids", pa.table({
                "doc": doc[lo:lo + TOKENS], "pos": np.arange(len(here), dtype=np.int32),
                "id": here.astype(np.int32)}))
            for i, chars in self.db.execute(DECODE).fetchall():
                out[i].append(chars.encode("latin-1"))
            self.db.unregister("ids")
        return [b"".join(parts) for parts in out]


@lru_cache(maxsize=2)
def load(path: str) -> Coder:
    return Coder(path)


def _mapped(df: DataFrame, added: list[str], source: str, limit: int, values) -> DataFrame:
    """``df`` with binary columns that ``values`` computes of the slices of ``source``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, given in text_batches(batches, source, limit):
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(v, pa.binary()) for v in values(given))],
                names=[*part.schema.names, *added])
    return df.mapInArrow(run, T.StructType(
        [*df.schema.fields, *[T.StructField(name, T.BinaryType()) for name in added]]))


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col``: the text's ids, packed as little-endian unsigned 32-bit."""
    return _mapped(df, [ids_col], text_col, SLICE,
                   lambda texts: [load(path).encode([t.decode("utf-8", "replace") for t in texts])])


def decode(df: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with ``bytes_col``: the bytes that the packed ids stand for (null: empty)."""
    return _mapped(df, [bytes_col], ids_col, 2 * SLICE, lambda packed: [load(path).decode(packed)])


def round_trip(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
               bytes_col: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` in one Python worker per task instead of two."""
    def values(texts: list[bytes]):
        ids = load(path).encode([t.decode("utf-8", "replace") for t in texts])
        return ids, load(path).decode(ids)
    return _mapped(df, [ids_col, bytes_col], text_col, SLICE, values)


def digest(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole texts encoded and decoded again; per row: id, n_tokens, SHA-256 of the packed
    ids and of the decoded bytes."""
    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    coded = round_trip(texts, path)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
