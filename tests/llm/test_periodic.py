"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from flowframe.llm import catalog, periodic
from flowframe.llm.common import table


def brute_runs(words, least=24, repeats=3):
    n, found = len(words), set()
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, repeats * q) and not any(
                    all(words[x] == words[x + d] for x in range(i, i + length - d)) for d in range(1, q)):
                found.add((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {x for s, length, q in runs for x in range(s + q, s + length)}
    return [w for x, w in enumerate(words) if x not in gone]


def periodic_text(rng, letters):
    words = []
    for _ in range(rng.randint(1, 5)):
        root = [rng.choice(letters) for _ in range(rng.randint(1, 14))]
        words += root * rng.randint(1, 9) + root[:rng.randint(0, len(root))]
        words += [rng.choice(letters) for _ in range(rng.randint(0, 6))]
    return words


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefgh"])
def test_runs_of_random_words(letters):
    rng = random.Random(len(letters))
    for _ in range(150):
        words = [w.encode() for w in periodic_text(rng, letters)]
        assert periodic.periodic_runs(words) == brute_runs(words)
        assert periodic.collapsed(words, brute_runs(words)) == kept(words, brute_runs(words))


@pytest.mark.parametrize("least,repeats", [(3, 3), (6, 3), (10, 4), (40, 5)])
def test_other_limits(least, repeats):
    rng = random.Random(least)
    for _ in range(150):
        words = [w.encode() for w in periodic_text(rng, "ab")]
        assert periodic.periodic_runs(words, least, repeats) == brute_runs(words, least, repeats)


def test_tree_extensions_are_exact():
    rng = random.Random(7)
    for letters in (1, 2, 3, 30):
        word = [rng.randrange(letters) for _ in range(300)]
        tree = periodic.SuffixTree(word)
        assert tree.order == sorted(range(301), key=lambda i: word[i:])
        pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(2000)]
        pairs = [(i, j) for i, j in pairs if i != j]
        i, j = zip(*pairs)
        expected = [next((d for d in range(300) if i + d >= 300 or j + d >= 300 or word[i + d] != word[j + d]), 0) for i, j in pairs]
        assert tree.common(periodic.np.array(i), periodic.np.array(j)).tolist() == expected


def test_a_long_period_and_a_long_text():
    rng = random.Random(9)
    root = [b"w%d" % rng.randrange(50_000) for _ in range(9_000)]
    words = [b"x"] + root * 3 + root[:17] + [b"y"] * 40
    assert periodic.periodic_runs(words) == [(1, 27_017, 9_000), (27_018, 40, 1)]


def expected_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *four, digest("".join("%d,%d,%d\n" % r for r in runs)), digest(" ".join(kept(words, runs))))


def check(spark, rows, got):
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r[:8]) for r in got), key=key) == sorted((expected_row(*r[:2]) for r in rows), key=key)


def test_the_query_on_odd_rows(odd, none, odd_rows, llm):
    short = [r for r in odd_rows if len(r[1] or "") < 50_000]
    rng = random.Random(1)
    extra = [(1000 + i, " ".join(periodic_text(rng, "abc")), "en", *[None] * 9) for i in range(120)]
    rows = short + extra
    got = catalog.run_digests(llm.createDataFrame(rows, odd.schema)).collect()
    check(llm, rows, got)
    assert catalog.run_digests(none).count() == 0


def test_the_query_on_the_smallest_table(llm):
    docs = table(llm, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if len(r["text"] or "") < 12_000]
    got = [r for r in catalog.QUERIES["op13_periodic_runs"](llm, "/root/testdata/sf0.001").collect()]
    ids = {r[0] for r in rows}
    assert len(got) == docs.count()
    check(llm, rows, [r for r in got if r[0] in ids])


def test_runs_keep_other_columns(odd):
    got = periodic.find_runs(odd.withColumnRenamed("ids", "runs"), runs="found", collapse="left")
    assert got.columns == [c if c != "ids" else "runs" for c in odd.columns if c != "text"] + ["found", "left"]
    assert got.count() == odd.count()
