import random

import pytest

from flowframe.llm.common import ship

#: Documents with nulls in every column, empty and long texts, repeated rows and clashing names.
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score double, ids string, "
          "copy int, fingerprint string, component_id bigint, decoded string, __salt int")


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd_rows():
    rng = random.Random(4)
    words = [a + b + c for a in ("the", "ver", "é", "Qu") for b in ("ing", "on", "ß", "x") for c in ("", "er", "ly.", "!")]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    texts = [None, "", "   \n\t ", "one", "two words", "one", "a b c d e f", long, "Σίγμα ÉCOLE don't 1234 日本語",
             "<|endoftext|> inside", "a b c d e f"] + [" ".join(rng.choice(words) for _ in range(40)) + "\n" + rng.choice(words) for _ in range(12)]
    rows = [(i, t, "en", "s%d" % (i % 3), None, 0.5, "x", 1, "f", 2, "d", 3) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, "no id", None, None, 1, None, None, None, None, None, None, None),
             (None, None, None, "", None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def odd(llm, odd_rows):
    return llm.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(llm):
    return llm.createDataFrame([], SCHEMA)
