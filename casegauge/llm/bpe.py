"""BPE encoding and decoding: batched numpy merge rounds over a public byte-level vocabulary.

Each task splits its texts into pretokens, keeps every distinct one of a slice once, and
merges all of them together: the symbols of all words lie in one flat array, a round looks
up every adjacent pair by binary search in the sorted pair keys, and each word applies its
lowest-ranked pair (leftmost first, non-overlapping). Words that found no pair leave the
array. Equal to merging pair by pair, because a pair that a merge creates always ranks
after that merge in such a vocabulary (checked when the file is loaded).

Pretokens longer than ``LONG_WORD`` bytes (a page of letters without a blank) would need as
many rounds as they hold ranks, so those take the same merges from a heap, in
n log n steps.

The vocabulary file is named by path (a parameter); every Python worker reads it once.
Nothing is cut: texts are encoded whole, in slices of bounded bytes.

Defined results: a null text counts as empty (no ids, decodes to the empty text); special
tokens written in a text get their own id, as the file's added tokens say; repeated rows
are encoded one by one; extra columns ride along untouched.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.llm.common import text_batches

VOCABULARY = "byte_bpe_50k.json"
LONG_WORD = 400
SLICE = 1 << 20  # bytes of texts that are merged together
# Fixed value: the pretoken pattern of this vocabulary's byte-level splitter.
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# Ranges of letters and numbers of Unicode versions after 16, which the
# splitter that this vocabulary is used with doesn't know (it treats them as symbols).
NEWER = (
    "\\u0558 \\u058b-\\u058c \\u088f \\u0c5c \\u0cdc \\u208f \\u209d-\\u209f \\ua7ce-\\ua7cf \\ua7d2 "
    "\\ua7d4 \\ua7dd \\ua7e2 \\ua7f1 \\uab6c-\\uab6d \\U000107bb-\\U000107bf "
    "\\U00010940-\\U00010959 \\U00010ec5-\\U00010ec7 \\U00010ed9-\\U00010eee \\U00011b0a "
    "\\U00011db0-\\U00011ddb \\U00011de0-\\U00011de9 \\U00011df1 \\U0001246f "
    "\\U00012475-\\U0001247f \\U00012550-\\U00012686 \\U00016ea0-\\U00016eb8 "
    "\\U00016ebb-\\U00016ed3 \\U00016ff2-\\U00016ff6 \\U000187f8-\\U000187ff "
    "\\U00018cd6-\\U00018cda \\U00018d09-\\U00018d20 \\U00018d80-\\U00018df2 "
    "\\U00018e00-\\U00019191 \\U000191a0-\\U000191d2 \\U0001b123-\\U0001b128 \\U0001b168 "
    "\\U0001d6a6 \\U0001df1f-\\U0001df24 \\U0001df2b-\\U0001df81 "
    "\\U0001df90-\\U0001df96 \\U0001dfcd-\\U0001dfff \\U0001e6c0-\\U0001e6de "
    "\\U0001e6e0-\\U0001e6e2 \\U0001e6e4-\\U0001e6e5 \\U0001e6e7-\\U0001e6ed "
    "\\U0001e6f0-\\U0001e6f4 \\U0001e6fe-\\U0001e6ff \\U0002b73a-\\U0002b73f "
    "\\U0002b81e \\U0002cea2-\\U0002cead \\U000323b0-\\U00033479 "
    "\\U0003d000-\\U0003fc3f")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merge table and token bytes of one vocabulary file, as flat arrays."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        to_byte = _byte_characters()
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        token_bytes = [b""] * self.size
        for token, i in vocab.items():
            token_bytes[i] = bytes(to_byte[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            token_bytes[i] = content.encode()
        self.byte_id = np.zeros(256, np.int64)
        for c, b in to_byte.items():
            self.byte_id[b] = vocab[c]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        born = np.full(self.size, -1, np.int64)  # rank of the merge that makes a token
        born[made] = np.arange(len(made))
        if len(set(made.tolist())) != len(made) or (
                np.maximum(born[left], born[right]) >= np.arange(len(made))).any():
            raise ValueError("a merge comes before its parts, or two merges make one token")
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.rank_of, self.made = keys[order], order.astype(np.int32), made
        self.pairs = {int(k): int(r) for k, r in zip(keys, range(len(keys)))}
        self.blob = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.lengths = np.array([len(t) for t in token_bytes], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        newer = "[" + NEWER.replace(" ", "") + "]"
        self.newer = re.compile(newer).search
        self.split_plain = regex.compile(PRETOKEN).findall
        older = PRETOKEN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|{newer})")
        for kind in (r"\p{L}+", r"\p{N}+"):
            older = older.replace(" ?" + kind, f" ?(?:(?!{newer}){kind[:-1]})+")
        self.split_newer = regex.compile(older).findall
        self.split_special = regex.compile(
            "(" + "|".join(regex.escape(s) for s in
                           sorted(self.special, key=len, reverse=True)) + ")").split
        self.none = np.int32(len(merges))

    # -- merging ---------------------------------------------------------------

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; ``none`` where the pair isn't in the table."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank_of[at], self.none)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, one flat array, and the offsets of each word's."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_words, done_at = [], [], []
        at = np.arange(len(symbols))  # first byte of a symbol: restores the order at the end
        long = sizes > LONG_WORD
        if long.any():
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            for w in np.flatnonzero(long):
                ids, first = self._merge_long(symbols[offsets[w]:offsets[w + 1]])
                done_symbols.append(ids)
                done_at.append(first + offsets[w])
                done_words.append(np.full(len(ids), w))
            keep = ~long[word]
            symbols, word, at = symbols[keep], word[keep], at[keep]
        rank = np.full(len(symbols), self.none, np.int32)  # of (this symbol, the next one)
        stale = np.ones(len(symbols), bool)
        while len(symbols):
            inside = np.empty(len(symbols), bool)
            inside[:-1] = word[1:] == word[:-1]
            inside[-1] = False
            look = np.flatnonzero(stale & inside)
            rank[look] = self.ranks(symbols[look], symbols[look + 1])
            rank[~inside] = self.none
            starts = np.flatnonzero(np.concatenate([[True], ~inside[:-1]]))
            best = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(symbols)))
            best_here = np.repeat(best, counts)
            finished = best_here == self.none
            if finished.any():
                done_symbols.append(symbols[finished])
                done_words.append(word[finished])
                done_at.append(at[finished])
                go = ~finished
                symbols, word, at, rank, best_here = (
                    symbols[go], word[go], at[go], rank[go], best_here[go])
                if not len(symbols):
                    break
            hit = rank == best_here
            # in a run of overlapping hits (equal symbols) every second one merges
            if (hit[1:] & hit[:-1]).any():
                i = np.arange(len(hit))
                run_start = np.maximum.accumulate(np.where(~hit, i + 1, 0))
                hit &= (i - run_start) % 2 == 0
            where = np.flatnonzero(hit)
            symbols[where] = self.made[rank[where]]
            stale = np.zeros(len(symbols), bool)
            stale[where] = True
            stale[np.maximum(where - 1, 0)] = True
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            symbols, word, at, rank, stale = (symbols[keep], word[keep], at[keep], rank[keep],
                                              stale[keep])
        if not done_symbols:
            return np.empty(0, np.int64), np.zeros(len(words) + 1, np.int64)
        order = np.argsort(np.concatenate(done_at), kind="stable")
        flat = np.concatenate(done_symbols)[order]
        per_word = np.bincount(np.concatenate(done_words), minlength=len(words))
        return flat, np.concatenate([[0], np.cumsum(per_word)])

    def _merge_long(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same merges for one long word: a heap of (rank, position) over linked
        symbols."""
        s = symbols.tolist()
        n = len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n

        def rank(i: int) -> int | None:
            return self.pairs.get(s[i] * self.size + s[after[i]]) if after[i] < n else None

        heap = [(r, i) for i in range(n) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or rank(i) != r:
                continue
            j = after[i]
            s[i], alive[j], after[i] = int(self.made[r]), False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (q := rank(k)) is not None:
                    heapq.heappush(heap, (q, k))
        first = [i for i in range(n) if alive[i]]
        return np.array([s[i] for i in first], np.int64), np.array(first, np.int64)

    def split(self, text: str) -> list[str]:
        """The pretokens of a text without special tokens."""
        if text.isascii() or not self.newer(text):
            return self.split_plain(text)
        return self.split_newer(text)

    # -- texts -----------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text: distinct pretokens are merged once and gathered back."""
        index: dict[str, int] = {}
        special: list[tuple[int, int]] = []
        sequence: list[int] = []
        bounds = [0]
        put = index.setdefault
        for text in texts:
            parts = [text]
            if any(s in text for s in self.special):
                parts = self.split_special(text)
            for part in parts:
                if part in self.special:
                    special.append((len(sequence), self.special[part]))
                    sequence.append(0)
                else:
                    sequence.extend([put(w, len(index)) for w in self.split(part)])
            bounds.append(len(sequence))
        flat, offsets = self.merge_words([w.encode() for w in index])
        flat = flat.astype("<u4")
        order = np.array(sequence, np.int64)
        counts = np.diff(offsets)
        counts = counts[order] if len(counts) else np.zeros(len(order), np.int64)
        starts = offsets[order] if len(index) else np.zeros(len(order), np.int64)
        for place, _ in special:
            counts[place] = 1
        ends = np.concatenate([[0], np.cumsum(counts)])
        take = np.repeat(starts - ends[:-1], counts) + np.arange(ends[-1])
        if len(flat):
            ids = flat[np.minimum(take, len(flat) - 1)]
        else:
            ids = np.zeros(len(take), "<u4")
        for place, i in special:
            ids[ends[place]] = i
        return [ids[ends[a]:ends[b]] for a, b in zip(bounds[:-1], bounds[1:])]

    def decode(self, ids: np.ndarray) -> str:
        """Text of one sequence of ids; bytes that aren't UTF-8 become U+FFFD."""
        lengths = self.lengths[ids]
        total = np.cumsum(lengths)
        if not len(total):
            return ""
        take = np.repeat(self.offsets[ids] - (total - lengths), lengths) + np.arange(total[-1])
        return self.blob[take].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def _pack(ids: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes() for x in ids], pa.binary())


def _mapped(df: DataFrame, added: list[tuple[str, T.DataType]], source: str, limit: int,
            values) -> DataFrame:
    """``df`` with columns that ``values(texts or packed ids)`` computes per slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, given in text_batches(batches, source, limit):
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *values(given)],
                names=[*part.schema.names, *[name for name, _ in added]])
    return df.mapInArrow(run, T.StructType(
        [*df.schema.fields, *[T.StructField(name, kind) for name, kind in added]]))


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col``: the text's token ids as little-endian unsigned 32-bit
    integers in one binary value (``unpack_ids`` makes an array of them)."""
    def values(texts: list[bytes]):
        return [_pack(load(path).encode([t.decode() for t in texts]))]
    return _mapped(df, [(ids_col, T.BinaryType())], text_col, SLICE, values)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text that the packed ids stand for (null ids: empty)."""
    def values(packed: list[bytes]):
        return [pa.array([load(path).decode(np.frombuffer(p, "<u4").astype(np.int64))
                          for p in packed], pa.string())]
    return _mapped(df, [(text_col, T.StringType())], ids_col, 4 * SLICE, values)


def round_trip(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
               decoded_col: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` in one Python worker per task instead of two."""
    def values(texts: list[bytes]):
        vocabulary = load(path)
        ids = vocabulary.encode([t.decode() for t in texts])
        return [_pack(ids), pa.array([vocabulary.decode(x.astype(np.int64)) for x in ids],
                                     pa.string())]
    return _mapped(df, [(ids_col, T.BinaryType()), (decoded_col, T.StringType())], text_col,
                   SLICE, values)


def unpack_ids(df: DataFrame, ids_col: str = "ids", array_col: str = "token_ids") -> DataFrame:
    """``df`` with packed ids also as an array<int> (null ids: empty)."""
    def values(packed: list[bytes]):
        flat = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
        ends = np.cumsum([0, *[len(p) // 4 for p in packed]]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
    return _mapped(df, [(array_col, T.ArrayType(T.IntegerType()))], ids_col, 4 * SLICE, values)


def digest(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts, decode the ids again, and return per row: id, n_tokens, SHA-256
    of the packed ids and of the decoded text."""
    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    coded = round_trip(texts, path)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
