"""Secret scan: fixed patterns plus a battery of randomness tests.

The patterns (``assign``, ``access``, ``hex``) always count. Beyond them, long unbroken
tokens are tested for randomness in the alphabet they seem to be written in (dash-grouped
hex without its dashes): chi-squared uniformity over the alphabet, the runs test around its
middle, and lag-1 serial correlation, combined by Fisher's method into one p-value under
"drawn at random".

A random token's p-value is uniform, whatever its length; an ordinary word's lies near 0,
the nearer the longer it is. So within each stratum (alphabet, length band) the share of
random tokens follows from the upper half of the p-values, and the lowest threshold is
taken at which the expected share of ordinary tokens among those reported is at most
``fdr``. Strata are counted over the whole corpus; the table of counts has a fixed size.
Thin strata (a rare encoding, one long key) are judged by a fixed p-value and an upper bound
of their random tokens. They aren't pooled with others: beside many ordinary tokens of
another length or alphabet the pooled threshold would lose a lone random one.

Positions are code points, ends exclusive. Texts are scanned whole.

Defined results: a null or empty text has no spans; repeated rows are scanned one by one;
an empty table gives an empty result; extra columns take no part (``redact`` carries them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegauge.llm.common import Scratch, text_batches

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
# a maximal run is the leftmost non-overlapping match; shorter ones are dropped
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "key")
KINDS = ("assign", "access", "hex", "random")

TOKEN_LEAST = 20
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
# dash-grouped hex (UUIDs), with a letter so that dates and phone numbers stay out; it is
# tested without its dashes, in strata of its own
GROUPED = re.compile(r"(?=[0-9-]*[a-f])[0-9a-f]{2,}(?:-[0-9a-f]{2,})+"
                     r"|(?=[0-9-]*[A-F])[0-9A-F]{2,}(?:-[0-9A-F]{2,})+")
# Letters from rare to frequent in prose. Neighbours share a cell of the
# battery, so words of one case crowd in the last cells; in the alphabet's order they would
# spread as evenly as random letters do.
RARE_FIRST = "zqxjkvbpygfwmucldrhsnioate"
# Alphabets; a token is read in the first that holds it.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "base32": "234567" + RARE_FIRST.upper(),
    "base32_lower": "234567" + RARE_FIRST,
    "lower36": "0123456789" + RARE_FIRST,
    "upper36": "0123456789" + RARE_FIRST.upper(),
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_SETS = [(name, frozenset(letters)) for name, letters in ALPHABETS.items()]
_INDEX = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}
BINS = 100
# With fewer tokens in the upper half of its bins a stratum is thin, and p-values
# under 0.05 aren't reported in it: 95 % of random tokens lie above, whatever the corpus
ENOUGH = 100
THIN_CUT = 5
# a length band is a power of sqrt(2); tokens of 20 characters are in band 8
BANDS = 64


def band(length: int) -> int:
    return min(BANDS - 1, int(2 * np.log2(length)))


def _upper_normal(z: float) -> float:
    from math import erfc, sqrt
    return 0.5 * erfc(z / sqrt(2))


def _upper_chi2(x: float, k: int) -> float:
    """Upper tail of chi-squared with k degrees of freedom (Wilson-Hilferty)."""
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / (2 / (9 * k)) ** 0.5
    return _upper_normal(z)


def infer_alphabet(token: str) -> str | None:
    letters = set(token)
    return next((name for name, holds in _SETS if letters <= holds), None)


def battery(token: str, alphabet: str) -> tuple[float, float, float]:
    """p-values of chi-squared uniformity, runs and serial correlation under "every
    character drawn evenly from the alphabet"."""
    size = len(ALPHABETS[alphabet])
    x = np.fromiter(map(_INDEX[alphabet].__getitem__, token), np.float64, len(token))
    n = len(x)
    # so many equal cells that each expects about five characters
    cells = int(max(2, min(size, n // 5)))
    cell = (x * cells // size).astype(np.int64)
    width = np.bincount((np.arange(size) * cells // size).astype(np.int64), minlength=cells)
    expected = n * width / size
    chi = float((((np.bincount(cell, minlength=cells) - expected) ** 2) / expected).sum())
    high = x >= size / 2
    up = int(high.sum())
    down = n - up
    if up and down:
        mean = 1 + 2 * up * down / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs = 1 + int((high[1:] != high[:-1]).sum())
        p_runs = 2 * _upper_normal(abs(runs - mean) / var ** 0.5)
    else:
        p_runs = 2.0 ** (1 - n)
    centred = x - (size - 1) / 2
    var = (size * size - 1) / 12
    z = float((centred[1:] * centred[:-1]).sum()) / (var * (n - 1) ** 0.5)
    return _upper_chi2(chi, cells - 1), min(1.0, p_runs), min(1.0, 2 * _upper_normal(abs(z)))


def fisher(ps: tuple[float, ...]) -> float:
    """One p-value of three (Fisher): the upper tail of chi-squared with 6 degrees."""
    half = -sum(np.log(max(p, 1e-300)) for p in ps)
    return float(np.exp(-half) * (1 + half + half * half / 2))


def find_base(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, by start and kind."""
    out = []
    low = text.lower()
    if any(name in low for name in NAMES):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text)
                if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def find_candidates(text: str, base: list[tuple[int, int, int]]):
    """Tokens outside the base spans, with stratum and p-value bin. Tokens and spans ascend, so
    both are walked once; a span that starts earlier may end later than the next."""
    i, reach = 0, 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while i < len(base) and base[i][0] < b:  # spans that start before the token's end
            reach = max(reach, base[i][1])
            i += 1
        if a < reach:
            continue
        token = m[0].rstrip("=")
        grouped = GROUPED.fullmatch(token) is not None
        if grouped:
            token = token.replace("-", "")
        alphabet = infer_alphabet(token)
        if alphabet is None:
            continue
        p = fisher(battery(token, alphabet))
        name = f"{alphabet}_grouped" if grouped else alphabet
        yield a, b, f"{name}:{band(len(token))}", min(BINS - 1, int(p * BINS))


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()),
                   ("stratum", pa.string()), ("bin", pa.int32())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_batches(batches, "text"):
        found = []
        for raw in texts:
            text = raw.decode()
            base = find_base(text)
            rows = [{"start": a, "end": b, "kind": k, "stratum": None, "bin": None}
                    for a, b, k in base]
            rows += [{"start": a, "end": b, "kind": 3, "stratum": s, "bin": n}
                     for a, b, s, n in find_candidates(text, base)]
            found.append(rows)
        keep = [c for c in part.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*[part.column(c) for c in keep], pa.array(found, pa.list_(_SPAN))],
            names=[*keep, "found"])


FOUND = "array<struct<start:int,end:int,kind:int,stratum:string,bin:int>>"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``found``: base spans and all candidates (stratum, p-value bin)."""
    texts = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_scan, f"doc_id {kind}, found {FOUND}")


def thresholds(scanned: DataFrame, fdr: float) -> dict[str, int]:
    """Per stratum, the first p-value bin from which tokens are reported (``first_bin``).

    The counts are one row per (stratum, bin): at most 12 x 64 x 100, whatever the corpus.
    """
    c = F.explode("found")
    counts = scanned.select(c.alias("c")).where("c.kind = 3").groupBy("c.stratum", "c.bin") \
        .count().collect()
    table: dict[str, np.ndarray] = {}
    for r in counts:
        table.setdefault(r["stratum"], np.zeros(BINS))[r["bin"]] = r["count"]
    return {stratum: first_bin(n, fdr) for stratum, n in table.items()}


def _most(seen: float) -> float:
    """The highest mean at which so few events have a chance of 5 % (Poisson, by the
    Wilson-Hilferty form of chi-squared)."""
    k = seen + 1
    return k * (1 - 1 / (9 * k) + 1.645 / (3 * k ** 0.5)) ** 3


def first_bin(n: np.ndarray, fdr: float) -> int:
    """The first bin to report of a stratum's counts per bin.

    The upper half of the bins holds random tokens only (an ordinary token's p-value is
    near 0), so it gives their number per bin; what a bin holds beyond that is ordinary.
    With fewer than ``ENOUGH`` tokens there the number is too uncertain: bins from
    ``THIN_CUT`` on are reported as far as they hold no more than the most random tokens
    that the upper half allows. So a lone token is reported by its own p-value, and
    ordinary tokens that crowd the lower bins stay out.
    """
    upper = n[BINS // 2:].sum()
    thin = upper < ENOUGH
    half = _most(upper) if thin else upper
    reported = np.cumsum(n[::-1])[::-1]
    random = half * np.arange(BINS, 0, -1) / (BINS - BINS // 2)
    good = np.maximum(reported - random, 0) <= fdr * reported
    if thin:
        good[:THIN_CUT] = False
    return int(np.flatnonzero(good)[0])


def _reported(found: Column, first: dict[str, int]) -> Column:
    """Base spans and the candidates at or above their stratum's first bin."""
    if not first:
        return F.filter(found, lambda x: x["kind"] < 3)
    table = F.create_map(*[F.lit(v) for pair in first.items() for v in pair])
    return F.filter(found, lambda x: (x["kind"] < 3) | F.coalesce(
        x["bin"] >= F.try_element_at(table, x["stratum"]), F.lit(False)))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.05,
         scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (start, end, kind number),
    by start and kind."""
    scratch = scratch or Scratch(df.sparkSession)
    scanned = scratch.stage(scan(df, id_col, text_col), "secrets")
    spans = F.sort_array(F.transform(
        _reported(F.col("found"), thresholds(scanned, fdr)),
        lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"),
                           x["end"].alias("end"))))
    return scanned.select("doc_id", spans.alias("spans"))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text."""
    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long") \
            .alias(f"n_{KINDS[kind]}")
    base = F.filter("spans", lambda x: x["kind"] < 3)
    return found.select("doc_id", *map(count, range(3)), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), count(3))


def _blank_out(batches: Iterator[pa.RecordBatch], marker: str, first: dict[str, int]):
    for part, texts in text_batches(batches, "text"):
        out, changed = [], []
        for raw, given in zip(texts, part.column("text").is_valid().to_pylist()):
            text = raw.decode()
            base = find_base(text)
            spans = [(a, b) for a, b, _ in base]
            spans += [(a, b) for a, b, s, n in find_candidates(text, base)
                      if n >= first.get(s, BINS)]
            at, pieces = 0, []
            for a, b in sorted(spans):
                if b > at:
                    pieces += [text[at:max(a, at)], marker if a >= at else ""]
                    at = b
            out.append("".join([*pieces, text[at:]]) if given else None)
            changed.append(bool(spans))
        yield pa.RecordBatch.from_arrays(
            [part.column("row"), pa.array(out, pa.string()), pa.array(changed, pa.bool_())],
            names=["row", "text", "changed"])


def redact(df: DataFrame, text_col: str = "text", marker: str = "[SECRET]", fdr: float = 0.05,
           chars_col: str | None = "n_chars") -> DataFrame:
    """``df`` (all columns and rows) with every reported span replaced by ``marker``; overlapping
    spans become one. ``chars_col``, if the table has it, is counted anew for changed texts.

    Thresholds are counted in a first pass that stores only candidates; the second pass
    finds the spans again in each text, so no text is shuffled or stored twice.
    """
    scratch = Scratch(df.sparkSession)
    numbered = df.select(F.lit(0).alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    counted = scan(numbered).where(F.size("found") > 0)
    first = thresholds(counted, fdr)
    # the other columns ride along as one struct; the text goes to Python once
    others = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    row = df.select(F.struct(*others, F.lit(0).alias("__row")).alias("row"),
                    F.col(f"`{text_col}`").alias("text"))
    redacted = row.mapInArrow(lambda b: _blank_out(b, marker, first),
                              T.StructType([*row.schema.fields,
                                            T.StructField("changed", T.BooleanType())]))
    columns = []
    for c in df.columns:
        if c == text_col:
            columns.append(F.col("text").alias(c))
            continue
        old = F.col(f"row.`{c}`")
        if c == chars_col:
            columns.append(F.when(F.col("changed"), F.length("text").cast(df.schema[c].dataType))
                           .otherwise(old).alias(c))
        else:
            columns.append(old.alias(c))
    return redacted.select(*columns)
