"""Spelling variants: words one inserted, deleted or replaced character apart.

Method: the vocabulary (words with enough occurrences) is put into blocked Bloom filters, one
for each word length, each cut further where it would exceed ``FILTER_BYTES``.  Filters are
broadcast in passes of bounded size.  Every word generates its edits - each character deleted,
each replaced by a letter that sorts after it; the opposite edits find the same pairs from
their other end - as 64-bit polynomial hashes, updated in constant time and never spelled out.
An edit whose hash is in its length's filter is spelled out and shuffled to an exact join with the
vocabulary, which removes the false positives.  Only lengths that have words are probed.

A word's form is its near word with the most occurrences (ties: smallest in code-point
order), if that has at least ``factor`` times the word's own; the root is reached by
following forms to the last one.

Defined results: null and empty texts have no words; repeated rows count again; ids of null
count as the empty text in the deletion rule; an empty table gives no words; other columns are
ignored whatever their names.  A single text or word is held by one task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import steps, stored
from flowframe.session import checkpoint, shuffle_partitions

#: Latin-1 bytes that make words, A-Z in lower case; all other characters end a word.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))
#: Distinct words that a counting task holds before it hands on their counts.
HELD_WORDS = 1 << 18
#: Bytes of one filter, and of all filters that a pass broadcasts.
FILTER_BYTES = 32 << 20
#: Filter bits for each word; a block is eight 64-bit words, one bit of each.
WORD_BITS = 16
LANES = 8
#: Odd base of the polynomial hash and its inverse modulo 2^64; odd multipliers of the lanes.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
LANE = np.array([0x47B6137B44974D91, 0x8824AD5BA2B7289D, 0x705495C72DF1424B, 0x9EFC49475C6BFB31,
                 0x2DF1424B9EFC4947, 0xA2B7289D705495C7, 0x44974D918824AD5B, 0x5C6BFB3147B6137B], np.uint64)
#: Characters of words that a probing step holds at a time.
STEP_CHARS = 1 << 16


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 6,
                drop_every: int | None = 199) -> DataFrame:
    """(word, n) of the words of all texts with at least ``least_length`` characters.

    Words are maximal runs of Latin-1 letters, A-Z in lower case.  With ``drop_every``, all of
    a document's occurrences of a run lose the character at h % length if ``drop_every``
    divides h, the crc32 of ``<doc_id>:<run>``.
    """
    fields = docs.select(F.col(f"`{text}`").cast("string").alias("text"),
                         F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"))

    def rows(total: Counter) -> pa.RecordBatch:
        held = [(w, n) for w, n in total.items() if n > 0 and len(w) >= least_length]
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w, _ in held], pa.string()),
                                           pa.array([n for _, n in held], pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for part in steps(batch):
                for value, own in zip(part.column(0), part.column(1).to_pylist()):
                    words = (value.as_py() or "").encode("latin-1", "replace").translate(LETTERS).split()
                    total.update(words)
                    if drop_every:
                        _shorten(total, words, own, drop_every)
                if len(total) > HELD_WORDS:
                    yield rows(total)
                    total = Counter()
        yield rows(total)

    return fields.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _shorten(total: Counter, words: list[bytes], own: str, drop_every: int) -> None:
    """Move the counts of the document's words that the deletion rule shortens."""
    seed = crc32(f"{own}:".encode())
    counts = Counter(words)
    for w, n in counts.items():
        h = crc32(w if w.isascii() else w.decode("latin-1").encode(), seed)
        if not h % drop_every:
            at = h % len(w)
            total[w] -= n
            total[w[:at] + w[at + 1:]] += n


def _mixed(h: np.ndarray) -> np.ndarray:
    """Bits of a polynomial hash spread over the whole word (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Filter:
    """A blocked Bloom filter; ``part`` of ``parts`` of the words of one length."""

    def __init__(self, words: int, part: int = 0, parts: int = 1) -> None:
        self.blocks = self.blocks_for(words, parts)
        self.part, self.parts = part, parts
        self.bits = np.zeros((self.blocks, LANES), np.uint64)

    @staticmethod
    def blocks_for(words: int, parts: int) -> int:
        return max(1, -(-words * WORD_BITS // (64 * LANES * parts)))

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        """Which of the hashes may be in the filter's part."""
        h = _mixed(h.copy())
        at, lanes = place(h, self.blocks)
        held = self.bits[at, 0] & lanes[:, 0] != 0
        if self.parts > 1:
            held &= h % np.uint64(self.parts) == self.part
        rest = np.flatnonzero(held)
        held[rest] = (self.bits[at[rest]] & lanes[rest] == lanes[rest]).all(axis=1)
        return held


def place(mixed: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and the bit of each lane of mixed hashes."""
    at = ((mixed >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    low = mixed & np.uint64(0xFFFFFFFF)
    lanes = np.uint64(1) << (low[:, None] * LANE[None, :] >> np.uint64(58))
    return at, lanes


def spelled(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    data = "".join(words).encode("utf-32-le")
    return np.frombuffer(data, "<u4").reshape(len(words), -1).astype(np.uint64)


def powers(length: int) -> np.ndarray:
    """Powers 0 to ``length`` of the base, modulo 2^64."""
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(length, BASE, np.uint64))), dtype=np.uint64)


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, places) of words of one length, of a bounded number of characters."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        if len(group) and (length := int(sizes[group[0]])):
            size = max(1, STEP_CHARS // length)
            for at in range(0, len(group), size):
                yield length, group[at:at + size]


def filter_plan(counts: dict[int, int], most: int = FILTER_BYTES) -> list[list[tuple[int, int, int, int]]]:
    """Passes of (length, words, part, parts) whose filters have at most ``most`` bytes together."""
    passes, room = [[]], most
    for length, words in sorted(counts.items()):
        parts = -(-Filter.blocks_for(words, 1) * LANES * 8 // most)
        size = Filter.blocks_for(words, parts) * LANES * 8
        for part in range(parts):
            if size > room and passes[-1]:
                passes.append([])
                room = most
            passes[-1].append((length, words, part, parts))
            room -= size
    return [p for p in passes if p]


def filters(vocabulary: DataFrame, plan: list[tuple[int, int, int, int]]) -> dict[int, list[Filter]]:
    """The filters of one pass: bits set in tasks, merged by block, gathered (bounded by the plan)."""
    wanted = {}
    for length, words, part, parts in plan:
        wanted.setdefault(length, []).append((words, part, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for length, group in by_length(texts):
                h = _mixed((spelled([texts[i] for i in group]) * powers(length)[:length]).sum(axis=1, dtype=np.uint64))
                for words, part, parts in wanted.get(length, ()):
                    own = h[h % np.uint64(parts) == part]
                    at, lanes = place(own, Filter.blocks_for(words, parts))
                    columns = [np.full(len(own), length, np.int32), np.full(len(own), part, np.int32), at, *lanes.view(np.int64).T]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    names = ["length", "part", "block", *[f"lane{k}" for k in range(LANES)]]
    schema = "length int, part int, block bigint, " + ", ".join(f"lane{k} bigint" for k in range(LANES))
    lengths = F.char_length("word").isin(sorted(wanted)) if len(wanted) < 1000 else F.lit(True)
    bits = vocabulary.select("word").where(lengths).mapInArrow(run, schema)
    merged = bits.groupBy("length", "part", "block").agg(*[F.bit_or(f"lane{k}").alias(f"lane{k}") for k in range(LANES)]).toArrow()
    found = {length: [Filter(*spec) for spec in specs] for length, specs in wanted.items()}
    where = {(length, f.part): f for length, fs in found.items() for f in fs}
    keys = list(zip(merged.column("length").to_pylist(), merged.column("part").to_pylist()))
    lanes = np.stack([merged.column(f"lane{k}").to_numpy().view(np.uint64) for k in range(LANES)], axis=1)
    block = merged.column("block").to_numpy()
    for i, key in enumerate(keys):
        where[key].bits[block[i]] = lanes[i]
    return found


def probes(words: list[str], letters: np.ndarray, held: dict[int, list[Filter]]) -> Iterator[tuple[list[int], list[str]]]:
    """(places of words, edits) whose hashes are in the filters."""
    for length, group in by_length(words):
        same, shorter = held.get(length, ()), held.get(length - 1, ())
        if not same and not shorter:
            continue
        texts = [words[i] for i in group]
        codes = spelled(texts)
        scale = powers(length)
        terms = codes * scale[:length]
        whole = terms.sum(axis=1, dtype=np.uint64)[:, None]
        if shorter:
            before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
            edited = before + (whole - before - terms) * np.uint64(INVERSE)
            # of equal neighbours one deletion gives every other's word
            new = np.ones(codes.shape, bool)
            new[:, 1:] = codes[:, 1:] != codes[:, :-1]
            row, at = np.nonzero(new)
            hashes = edited[row, at]
            for f in shorter:
                hit = np.flatnonzero(f.may_hold(hashes))
                yield group[row[hit]].tolist(), [texts[r][:i] + texts[r][i + 1:] for r, i in zip(row[hit].tolist(), at[hit].tolist())]
        if same:
            for letter in letters.tolist():
                row, at = np.nonzero(codes < letter)
                hashes = whole[row, 0] + (np.uint64(letter) - codes[row, at]) * scale[at]
                for f in same:
                    hit = np.flatnonzero(f.may_hold(hashes))
                    yield group[row[hit]].tolist(), [texts[r][:i] + chr(letter) + texts[r][i + 1:]
                                                     for r, i in zip(row[hit].tolist(), at[hit].tolist())]


def near_words(vocabulary: DataFrame, most: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n) of all ordered pairs of near words of ``vocabulary`` (word, n), a
    written table of distinct words."""
    spark = vocabulary.sparkSession
    sizes = vocabulary.where("word <> ''").groupBy(F.char_length("word").alias("length")).count()
    counts = {r["length"]: r["count"] for r in sizes.toLocalIterator()}
    letters = np.array(sorted(ord(r[0]) for r in vocabulary.select(F.explode(F.split("word", ""))).where("col <> ''").distinct().toLocalIterator()), np.uint64)
    found = None
    for plan in filter_plan(counts, most):
        # a filter that nothing probes but its own only word finds nothing
        useful = [p for p in plan if p[1] > 1 or p[0] + 1 in counts]
        if not useful:
            continue
        shared = spark.sparkContext.broadcast((letters, filters(vocabulary, useful)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            alphabet, held = shared.value
            for batch in batches:
                words = batch.column(0).to_pylist()
                for places, edits in probes(words, alphabet, held):
                    if edits:
                        kept = batch.take(pa.array(places))
                        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(edits, pa.string())], names=["word", "n", "near"])

        # hundreds of probes a word: more tasks than the table's bytes would make
        spread = vocabulary.select("word", "n").repartition(shuffle_partitions(spark), "word")
        positive = spread.mapInArrow(run, "word string, n bigint, near string")
        exact = positive.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
        one_way = checkpoint(exact.select("word", "n", "near", "near_n"))
        found = one_way if found is None else found.unionByName(one_way)
    if found is None:
        return vocabulary.where("false").select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    other_way = found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.unionByName(other_way)


def forms(vocabulary: DataFrame, factor: int = 5, most: int = FILTER_BYTES) -> DataFrame:
    """(word, n, form, form_n, n_near) of every word."""
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("best")
    around = near_words(vocabulary, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = vocabulary.join(around, "word", "left")
    enough = -F.col("best.n") >= factor * F.col("n")
    return joined.select("word", "n", F.when(enough, F.col("best.near")).alias("form"),
                         F.when(enough, -F.col("best.n")).alias("form_n"), F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of every word with a form.  Counts grow along forms, so they never circle;
    each round doubles the steps taken, until all stand at a word without a form."""
    at = checkpoint(formed.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        stepped = checkpoint(at.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), "beyond"))
        at = stepped.select("word", "root")
        if stepped.where("beyond is not null").isEmpty():
            return at


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 6, least_count: int = 5,
                      factor: int = 5, drop_every: int | None = 199, most: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts with at least ``least_count`` occurrences."""
    counted = word_counts(docs, doc_id, text, least_length, drop_every)
    vocabulary = stored(counted.where(F.col("n") >= least_count))
    formed = checkpoint(forms(vocabulary, factor, most))
    return formed.join(roots(formed), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
with recursive crc_table as (
  select list(list_reduce(range(0, 9), lambda c, k: case when k = 0 then c when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) order by b) as t
  from (select cast(b as bigint) as b from range(256) as r(b))),
runs as (
  select coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) as run
  from documents),
counted as (
  select id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from runs group by all),
hashed as (
  select run, n, xor(list_reduce(list_transform(range(0, octet_length(encode(id || ':' || run))),
      lambda i: cast('0x' || substr(hex(encode(id || ':' || run)), 2 * i + 1, 2) as bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) as h
  from counted, crc_table),
words as (
  select case when h % 199 = 0 then substr(run, 1, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) as bigint) + 2) else run end as word, n
  from hashed),
vocabulary as (
  select word, cast(sum(n) as bigint) as n from words where length(word) >= 6 group by word having sum(n) >= 5),
cuts as (
  select distinct word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select word, n, unnest(range(0, length(word))) as i from vocabulary)),
pairs as (
  select a.word, a.n, b.word as near, b.n as near_n from cuts a join cuts b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, a.n, b.word, b.n from cuts a join vocabulary b on a.rest = b.word
  union select b.word, b.n, a.word, a.n from cuts a join vocabulary b on a.rest = b.word),
best as (
  select word, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n from pairs group by word),
formed as (
  select word, n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * n then near end as form, case when near_n >= 5 * n then near_n end as form_n
  from vocabulary left join best using (word)),
chain as (
  select word, form as root from formed where form is not null
  union all select c.word, f.form from chain c join formed f on f.word = c.root where f.form is not null),
lasts as (select c.word, c.root from chain c join formed f on f.word = c.root where f.form is null)
select word, form, coalesce(root, word) as root, n, cast(n_near as bigint) as n_near, form_n from formed left join lasts using (word)
"""
