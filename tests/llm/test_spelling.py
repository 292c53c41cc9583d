"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from flowframe.llm import spelling


def lower(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def counted(docs, drop_every=199):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return total


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def expected(docs, drop_every=199, least_length=6, least_count=5, factor=5):
    vocabulary = {w: n for w, n in counted(docs, drop_every).items() if len(w) >= least_length and n >= least_count}
    rows, forms = {}, {}
    for w, n in vocabulary.items():
        around = [v for v in vocabulary if near(w, v)]
        best = min(around, key=lambda v: (-vocabulary[v], v), default=None)
        if best is not None and vocabulary[best] >= factor * n:
            forms[w] = best
        rows[w] = [w, forms.get(w), None, n, len(around), vocabulary[forms[w]] if w in forms else None]
    for w, row in rows.items():
        root = w
        while root in forms:
            root = forms[root]
        row[2] = root
    return sorted(map(tuple, rows.values()))


def small_docs(seed):
    rng = random.Random(seed)
    letters = "abÀÿ×"
    docs = []
    for d in range(60):
        words = []
        for _ in range(rng.randint(0, 200)):
            w = "".join(rng.choice(letters) for _ in range(rng.choice((2, 5, 6, 6, 6, 7, 7, 8))))
            words.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((d, rng.choice(" .,\n日Ā\x85\xa0").join(words)))
    # a chain of forms: each word's neighbour is five times as frequent
    for k, w in enumerate(("qwerty", "qwertyu", "qwertyui", "qwertyuio")):
        docs.append((100 + k, " ".join([w] * 6 * 5 ** k)))
    return docs + [(None, "hellos " * 7), (None, None), (7, ""), (100, docs[60][1]), (100, docs[60][1])]


@pytest.mark.parametrize("seed,drop,most", [(1, 199, 1 << 25), (2, 3, 256), (3, None, 64), (4, 7, 1024)])
def test_variants_of_small_tables(llm, seed, drop, most):
    docs = small_docs(seed)
    frame = llm.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = spelling.spelling_variants(frame, drop_every=drop, most=most)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == expected(docs, drop)


def test_odd_rows(odd, none, odd_rows):
    got = sorted(tuple(r) for r in spelling.spelling_variants(odd).collect())
    assert got == expected([r[:2] for r in odd_rows])
    assert spelling.spelling_variants(none).count() == 0


def test_the_filter_never_loses_an_edit():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcxyzé") for _ in range(rng.randint(1, 9))) for _ in range(1500)} | {"a" * 70_000, "a" * 69_999})
    by_size = Counter(map(len, words))
    for parts in (1, 3):
        held = {}
        for length, n in by_size.items():
            held[length] = [spelling.Filter(n, k, parts) for k in range(parts)]
        for length, group in spelling.by_length(words):
            codes = spelling.spelled([words[i] for i in group])
            h = spelling._mixed((codes * spelling.powers(length)[:length]).sum(axis=1, dtype=np.uint64))
            for f in held[length]:
                at, lanes = spelling.place(h[h % np.uint64(parts) == f.part], f.blocks)
                np.bitwise_or.at(f.bits, at, lanes)
        letters = np.array(sorted({ord(c) for w in words for c in w}), np.uint64)
        found = Counter((words[p], e) for places, edits in spelling.probes(words, letters, held) for p, e in zip(places, edits))
        assert max(found.values()) == 1  # every edit once
        short = [w for w in words if len(w) < 10]
        pairs = {(a, b) for a in short for b in short if near(a, b) and (len(a) > len(b) or len(a) == len(b) and a < b)}
        assert pairs <= set(found) and ("a" * 70_000, "a" * 69_999) in found
        false = [e for _, e in found if e not in set(words)]
        assert len(false) < len(found) / 4


def test_plans_of_filters_are_bounded_and_complete():
    counts = {3: 10, 6: 5_000, 7: 90_000, 8: 400, 9: 1}
    plan = spelling.filter_plan(counts, 1 << 14)
    for part in plan:
        assert sum(spelling.Filter(w, k, n).bits.nbytes for _, w, k, n in part) <= 1 << 14
    listed = [(length, k, n) for part in plan for length, _, k, n in part]
    assert len(listed) == len(set(listed))
    for length in counts:
        assert {k for x, k, _ in listed if x == length} == set(range(max(n for x, _, n in listed if x == length)))
    assert spelling.filter_plan({}) == []
