"""Benchmark passages against brute force."""

import random
import re

import numpy as np
import pytest

from flowframe.llm import catalog, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def windows_of(text, size):
    ws = words_of(text)
    return [tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))] if ws else []


def tightest(words, window, begin):
    """End of the shortest stretch from ``begin`` that holds the window's words in order."""
    at = begin
    for w in window[1:]:
        at += 1
        while at < len(words) and words[at] != w:
            at += 1
        if at >= len(words):
            return None
    return at + 1


def expected(docs, items, size, slop):
    out = []
    for doc_id, text in docs:
        ws = words_of(text)
        hit, exact, near = set(), set(), set()
        for item_id, item in items:
            for window in windows_of(item, size):
                for a, w in enumerate(ws):
                    if w != window[0]:
                        continue
                    if tuple(ws[a:a + len(window)]) == window:
                        hit |= set(range(a, a + len(window)))
                        exact.add(item_id or "")
                    end = tightest(ws, window, a)
                    if end is not None and end - a <= len(window) + slop:
                        near.add(item_id or "")
        out.append((doc_id, len(ws), len(hit), sorted(exact), sorted(near)))
    return sorted(out, key=str)


def passages(seed, letters="abcdé9"):
    rng = random.Random(seed)
    words = [x + y for x in letters for y in letters][:14]
    items = [("i%d" % i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate((1, 2, 5, 6, 9, 12, 20))]
    items += [("i2", items[2][1]), ("i9", "  ?! "), ("i10", None), (None, items[5][1] + " Extra"), ("i11", "AB-" + items[3][1].upper())]
    docs = [(0, None), (1, ""), (2, " .,"), (None, items[5][1])]
    for d in range(3, 30):
        parts = []
        for _ in range(rng.randint(1, 6)):
            parts.append(" ".join(rng.choice(words) for _ in range(rng.randint(0, 8))))
            item = words_of(rng.choice(items)[1])
            for _ in range(rng.randint(0, 2)):
                item.insert(rng.randint(0, len(item)), rng.choice(words))
            parts.append((", " if d % 2 else "\n").join(item))
        docs.append((d, " ".join(parts)))
    return docs + [docs[5], docs[5]], items


@pytest.mark.parametrize("size,slop,block,segment", [(5, 0, 1000, 1 << 20), (5, 1, 9, 200), (4, 3, 1000, 100), (10, 2, 4, 1), (1, 0, 50, 500)])
def test_matches_of_small_tables(llm, size, slop, block, segment):
    docs, items = passages(size + slop)
    got = decontaminate.contamination(llm.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
                                      llm.createDataFrame(items, "item_id string, text string"),
                                      window=size, slop=slop, block=block, segment_bytes=segment)
    assert sorted(((r[0], r[1], r[2], list(r[3]), list(r[4])) for r in got.collect()), key=str) == expected(docs, items, size, slop)


def test_variable_length_numbers_round_trip():
    rng = random.Random(2)
    values = np.array([rng.getrandbits(rng.randint(0, 40)) for _ in range(3000)] + [0, 127, 128, (1 << 40) - 1], np.int64)
    data, ends = decontaminate.varints(values)
    assert decontaminate.unpacked(data).tolist() == values.tolist() and ends[-1] == len(data)
    assert decontaminate.unpacked(decontaminate.varints(np.zeros(0, np.int64))[0]).tolist() == []


def test_the_query_on_odd_rows(odd, none, odd_rows, llm):
    clash = "item_id string, text string, seg bigint, words string, doc_id bigint, number bigint"
    items = [("one", "two words", 1, "x", 1, 1), ("all", "a b c d e f", 1, "x", 1, 1), (None, None, None, None, None, None)]
    frame = llm.createDataFrame(items, clash)
    got = catalog.contamination_digests(odd, frame)
    rows = got.collect()
    assert len(rows) == len(odd_rows)
    assert {r["doc_id"] for r in rows if r["contaminated"]} == {4, 6, 10}
    assert catalog.contamination_digests(none, frame).count() == 0
    clean = catalog.contamination_digests(odd, llm.createDataFrame([], clash)).collect()
    assert len(clean) == len(odd_rows) and not any(r["n_hit"] or r["n_near"] or r["n_items"] for r in clean)
