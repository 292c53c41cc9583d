"""SimHash near-dedup, fingerprints and components against brute force."""

import hashlib
import random
import re

import pytest
import xxhash

from flowframe.llm import fingerprints, simhash_dedup
from flowframe.llm.components import connected_components


def votes(terms):
    counts, total = [0] * 64, 0
    for term, weight in terms:
        h = xxhash.xxh64_intdigest(term.encode(), 42)
        total += weight
        for b in range(64):
            counts[b] += weight * (h >> b & 1)
    return sum(1 << b for b in range(64) if counts[b] * 2 > total)


def shingle_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return votes([(" ".join(words[i:i + 3]), 1) for i in range(max(1, len(words) - 2))]) if words else 0


def word_print(text):
    words = set(re.split(r"[ \t\n\x0b\f\r]+", (text or "").strip(" ").lower())) - {""}
    return votes([(w, len(w)) for w in words])


def groups(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_rings(llm):
    rng = random.Random(2)
    names = [f"n{i:04d}" for i in range(500)]
    rng.shuffle(names)
    edges = list(zip(names[:120], names[1:120])) + [(names[200], n) for n in names[201:380]] + [
        (names[400], names[401]), (names[401], names[402]), (names[402], names[400]), (names[450], names[450]), (None, names[460])]
    got = {r["node"]: r["root"] for r in connected_components(llm.createDataFrame(edges, "a string, b string")).collect()}
    real = [(a, b) for a, b in edges if a and b and a != b]
    nodes = {n for e in real for n in e}
    found = groups(real, nodes)
    least = {}
    for n, g in found.items():
        least[g] = min(n, least.get(g, n))
    assert got == {n: least[g] for n, g in found.items()}
    assert connected_components(llm.createDataFrame([], "a string, b string")).count() == 0


def test_links_are_complete(llm):
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for flips in range(1, 6):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = llm.createDataFrame(signed, "fp bigint")
    back = lambda x: x & (1 << 64) - 1
    for radius in (1, 2, 3, 4):
        expected = {frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= radius}
        found = [frozenset((back(r["a"]), back(r["b"]))) for r in simhash_dedup.linked_fingerprints(frame, radius).collect()]
        assert len(found) == len(set(found)) and set(found) == expected
        if radius == 3:
            tables = [frozenset((back(r["a"]), back(r["b"]))) for r in fingerprints.within_radius(frame, radius).collect()]
            assert len(tables) == len(set(tables)) and set(tables) == expected


def test_near_duplicates_on_odd_rows(odd, none, odd_rows):
    got = simhash_dedup.near_duplicates(odd).collect()
    prints = [shingle_print(r[1]) for r in odd_rows]
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in got) == sorted((str(r[0]), f"{p:016x}") for r, p in zip(odd_rows, prints))
    near = groups([(a, b) for a in set(prints) for b in set(prints) if (a ^ b).bit_count() <= 3], set(prints))
    least = {}
    for row, p in zip(odd_rows, prints):
        if row[0] is not None:
            least[near[p]] = min(row[0], least.get(near[p], row[0]))
    of = {f"{p:016x}": least.get(near[p]) for p in prints}
    assert all(r["component_id"] == of[r["fingerprint"]] for r in got)
    assert simhash_dedup.near_duplicates(none).count() == 0
    kept = simhash_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    rows = [r["doc_id"] for r in kept.collect()]
    assert len(rows) == len(set(near[p] for p in prints))
    assert set(least.values()) <= set(rows)
    assert simhash_dedup.deduplicate(none).count() == 0


def test_fingerprints_of_edited_texts(odd, none, odd_rows):
    got = fingerprints.fingerprint_edits(odd)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "near_docs"]
    key = lambda t: hashlib.sha256(t.encode()).digest()
    texts = {}
    for r in odd_rows:
        if r[0] is not None:
            texts[r[0]] = min(r[1] or "", texts.get(r[0], r[1] or ""), key=key)
    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, [*ids[1:], ids[0]])) | {None: ids[0]}
    every = [word_print(r[1]) for r in odd_rows]
    expected = []
    for r in odd_rows:
        text, new = r[1] or "", texts[after[r[0]]]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + new[:cut]
        fp, efp, nfp = word_print(text), word_print(edited), word_print(new)
        expected.append((str(r[0]), len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{fp:016x}", f"{efp:016x}",
                         1 - (fp ^ efp).bit_count() / 64, 1 - (fp ^ nfp).bit_count() / 64, sum((fp ^ x).bit_count() <= 3 for x in every) - 1))
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == sorted(expected)
    assert fingerprints.fingerprint_edits(none).count() == 0


@pytest.mark.parametrize("text,expected", [(None, 0), (b"", 0), (b" \t\n", 0)])
def test_empty_texts_have_fingerprint_zero(text, expected):
    assert simhash_dedup.fingerprint(text) == expected


def test_votes_of_many_copies_stay_whole(llm):
    """A word of 2^20 characters in 2,100 copies: more than 2^31 votes for a bit."""
    word, copies = "a" * (1 << 20), 2_100
    rows = llm.range(copies).selectExpr("1 as key", f"repeat('a', {len(word)}) as text")
    got = fingerprints.simhash(rows, ["key"]).collect()
    assert [(r["copies"], r["fp"] % (1 << 64)) for r in got] == [(copies, word_print(word))]
