"""Documents with everything odd: nulls, empty and long texts, ties, repeats, clashing names."""

import random
import re

import pytest

WORD = re.compile(r"[^ \t-\r]+")
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "id bigint, key string, row string, pattern string, size int, words string, "
          "found string, sig string, target string, place int, taken_by string, t string")
EXTRA = (7, "k", "r", "p", 1, "w", "f", "s", "t", 2, "x", "u")


def words(text):
    return WORD.findall(text or "")


def odd_texts():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 8))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))
    base = prose(120)
    near = base.split()
    near[50] = "changed"
    return [None, "", "   \n\t ", "one", "One TWO three", "one two\nthree four", base, base,
            base.upper(), " ".join(near), prose(60_000), "x" * 50_000, "a b " * 400,
            "line one here\n" * 30, "\x00\x1c odd \x85 blanks　in\xa0text 👍🏽 <|endoftext|> end",
            "# $ % & | < > * " * 20, prose(30), prose(30)]


def frame(spark, rows):
    return spark.createDataFrame([(*r[:2], "en", r[2] if len(r) > 2 else "s", 3, *EXTRA)
                                  for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Rows (doc_id, text, source) and the DataFrame of them."""
    texts = odd_texts()
    rows = [(i, t, ["a", "b", None][i % 3]) for i, t in enumerate(texts)]
    rows += [(5, texts[5], "c"), (5, texts[5], "c"), (None, "a row without an id", "a")]
    return rows, frame(spark, rows)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
