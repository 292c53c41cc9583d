"""Benchmark passages in documents by a positional inverted index.

The index is a written table with one row for each term of each segment: its postings, the
ascending word positions as differences in variable-length bytes.  A segment is a few
megabytes of whole documents, numbered through with one free position between two of
them, so no phrase crosses from one to the next; rows without a term list a segment's
documents.  Words are the maximal runs of letters, digits and all characters beyond ASCII,
A-Z in lower case.

Search: the windows of the tested items (``window`` consecutive words; an item of fewer,
but not none, is one window) are distinct texts, looked up in blocks of bounded size.
Only the postings of a block's terms leave the index; they meet by segment.  There
the list of a window's rarest term (by its count over all documents) gives the
candidates, and the lists of the next rarer terms, each shifted by its offset in the
window, are intersected one after the other.  With ``slop`` the shifted lists may be that
many words off, and the survivors are verified as the window's words in their order with at
most ``slop`` other words among them: proximity matches, of which those without other
words are the exact phrases.

Defined results: null, empty and wordless texts have no words and no hits; repeated documents
each get a row, and repeated items count once; an item with a null id counts as one with the
empty id; empty tables give no hits; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import steps, stored
from flowframe.session import checkpoint

#: Words are made of these bytes of UTF-8; A-Z in lower case; all others separate them.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: The same as a regular expression over lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Text bytes of one segment of the index (a longer document is a segment of its own).
SEGMENT_BYTES = 8 << 20
#: Distinct windows that one search broadcasts (their words have at most some megabytes).
BLOCK_WINDOWS = 1 << 17
#: Candidate places that a search step holds at a time.
CANDIDATES = 1 << 18


class Terms(dict):
    """Numbers terms in the order they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``values`` (7 bits each, the last one under 128) and each value's end."""
    size = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        more = values >> bits
        if not more.any():
            break
        size += more > 0
    ends = np.cumsum(size)
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        at = size > k
        last = size[at] == k + 1
        # the first byte holds the highest bits
        out[ends[at] - size[at] + k] = (values[at] >> 7 * (size[at] - 1 - k)) & 127 | np.where(last, 0, 128)
    return out, ends


def unpacked(data: np.ndarray) -> np.ndarray:
    """The values of a buffer of :func:`varints`."""
    ends = np.flatnonzero(data < 128)
    sizes = np.diff(ends, prepend=-1)
    values = (data[ends] & 127).astype(np.int64)
    for k in range(1, int(sizes.max()) if len(sizes) else 0):
        at = sizes > k
        values[at] |= (data[ends[at] - k] & 127).astype(np.int64) << 7 * k
    return values


INDEX = "seg bigint, term binary, n bigint, postings binary, doc_id {}, start bigint, n_words bigint"


def _segment(seg: int, terms: Terms, numbers: list[np.ndarray], ids: list, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows of one segment: its terms in their order, then its documents."""
    counts = np.array([len(x) for x in numbers], np.int64)
    starts = np.concatenate(([0], np.cumsum(counts + 1)[:-1])).astype(np.int64)
    names = ["seg", "term", "n", "postings", "doc_id", "start", "n_words"]
    none = lambda n, t: pa.nulls(n, t)
    if terms:
        places = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, counts)])
        listed = sorted(terms)
        rank = np.empty(len(terms), np.int64)
        rank[np.fromiter((terms[t] for t in listed), np.int64, len(listed))] = np.arange(len(listed))
        keys = np.sort(rank[np.concatenate(numbers)] << 40 | places)
        term, places = keys >> 40, keys & (1 << 40) - 1
        first = np.flatnonzero(np.diff(term, prepend=-1))
        steps_ = np.diff(places, prepend=0)
        steps_[first] = places[first]
        data, ends = varints(steps_)
        n = np.diff(np.append(first, len(term)))
        offsets = np.concatenate(([0], ends[first[1:] - 1], [len(data)])).astype(np.int64)
        lists = pa.Array.from_buffers(pa.large_binary(), len(listed), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        for at in range(0, len(listed), 8192):
            size = min(8192, len(listed) - at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, seg)), pa.array(listed[at:at + size], pa.binary()), pa.array(n[at:at + size]),
                 lists.slice(at, size).cast(pa.binary()), none(size, kind), none(size, pa.int64()), none(size, pa.int64())], names=names)
    size = len(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, seg)), none(size, pa.binary()), none(size, pa.int64()), none(size, pa.binary()),
         pa.chunked_array(ids).combine_chunks(), pa.array(starts), pa.array(counts)], names=names)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The positional index of every word of ``docs``, written in the shared folder."""
    fields = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{doc_id}`").alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        terms, numbers, ids, held = Terms(), [], [], 0
        kind = None
        for batch in batches:
            kind = batch.column(1).type
            for texts in steps(batch):
                for value in texts.column(0).cast(pa.binary()):
                    data = value.as_py() or b""
                    words = data.translate(WORD_BYTES).split()
                    numbers.append(np.fromiter(map(terms.__getitem__, words), np.int64, len(words)))
                    held += len(data)
                ids.append(texts.column(1))
                if held >= segment_bytes:
                    yield from _segment(part << 32 | made, terms, numbers, ids, kind)
                    made += 1
                    terms, numbers, ids, held = Terms(), [], [], 0
        if numbers:
            yield from _segment(part << 32 | made, terms, numbers, ids, kind)

    return stored(fields.mapInArrow(run, INDEX.format(dict(fields.dtypes)["doc_id"])))


def words_of(text: Column) -> Column:
    """The lower-cased words of a text."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(WORD), 0)


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = 10) -> DataFrame:
    """(item_id, words) of the distinct windows of every item; the words joined by one space."""
    words = items.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item_id"), words_of(F.col(f"`{text}`")).alias("words"))
    places = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    each = words.where(F.size("words") > 0).select("item_id", "words", F.explode(places).alias("at"))
    return each.select("item_id", F.array_join(F.slice("words", F.col("at"), window), " ").alias("words")).distinct()


class Windows:
    """A block of windows over the numbers of their terms, and each one's terms from the rarest on."""

    def __init__(self, texts: list[str], counts: dict[bytes, int]) -> None:
        lists = [t.encode().split(b" ") for t in texts]
        self.terms = {t: i for i, t in enumerate(sorted({w for ws in lists for w in ws}))}
        self.size = np.array([len(ws) for ws in lists], np.int64)
        self.words = np.full((len(lists), int(self.size.max())), -1, np.int64)
        for i, ws in enumerate(lists):
            self.words[i, :len(ws)] = [self.terms[w] for w in ws]
        share = np.array([counts.get(t, 0) for t in self.terms] + [np.iinfo(np.int64).max], np.int64)
        self.order = np.argsort(share[self.words], axis=1, kind="stable")

    def search(self, terms: list[bytes], counts: np.ndarray, places: np.ndarray, slop: int) -> tuple[np.ndarray, ...]:
        """(window, start, end) of all matches, given the lists of a segment's ``terms``."""
        number = np.fromiter((self.terms[t] for t in terms), np.int64, len(terms))
        order = np.argsort(number)
        begin = np.concatenate(([0], np.cumsum(counts)))
        n = np.zeros(len(self.terms) + 1, np.int64)
        n[number] = counts
        at = np.zeros(len(self.terms) + 1, np.int64)
        at[number[order]] = np.cumsum(counts[order]) - counts[order]
        places = np.concatenate([places[begin[k]:begin[k + 1]] for k in order]) if len(order) else places
        span = int(places.max()) + 2 + self.words.shape[1] + slop if len(places) else 1
        keys = np.repeat(np.flatnonzero(n), n[n > 0]) * span + places
        n[-1] = 1  # the filler after a short window's words
        alive = np.flatnonzero((n[self.words] > 0).all(axis=1))
        n[-1] = 0
        rarest = self.words[alive, self.order[alive, 0]]
        sizes = np.cumsum(n[rarest])
        found, done = [], 0
        while done < len(alive):
            upto = max(done + 1, int(np.searchsorted(sizes, (sizes[done - 1] if done else 0) + CANDIDATES, side="right")))
            found.append(self._intersect(alive[done:upto], n, at, keys, places, span, slop))
            done = upto
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3

    def _intersect(self, which: np.ndarray, n: np.ndarray, at: np.ndarray, keys: np.ndarray, places: np.ndarray,
                   span: int, slop: int) -> tuple[np.ndarray, ...]:
        rarest = self.words[which, self.order[which, 0]]
        sizes = n[rarest]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        win = np.repeat(which, sizes)
        place = places[np.repeat(at[rarest], sizes) + inside]
        for r in range(1, self.words.shape[1]):
            own, term = self.order[win, 0], self.words[win, self.order[win, r]]
            apart = self.order[win, r] - own
            # this term's place if no other words are between, or up to slop words further off
            high = place + apart + np.where(apart > 0, slop, 0)
            low = np.maximum(high - slop, 0)
            hit = keys[np.minimum(np.searchsorted(keys, term * span + low), len(keys) - 1)] - term * span
            held = (term < 0) | (hit >= low) & (hit <= high)
            win, place = win[held], place[held]
        begin = place - self.order[win, 0]
        if not slop:
            return win, begin, begin + self.size[win]
        return self._in_order(win, place, keys, span, slop)

    def _in_order(self, win: np.ndarray, place: np.ndarray, keys: np.ndarray, span: int, slop: int) -> tuple[np.ndarray, ...]:
        """The tightest ordered match around each rarest word: every next word at its first
        place to the right, every word before at its last place to the left."""
        own = self.order[win, 0]
        ends, begins = place.copy(), place.copy()
        good = np.ones(len(win), bool)
        for d in range(1, self.words.shape[1]):
            right = good & (own + d < self.size[win])
            key = self.words[win[right], own[right] + d] * span
            hit = keys[np.minimum(np.searchsorted(keys, key + ends[right] + 1), len(keys) - 1)] - key
            good[right] = (hit > ends[right]) & (hit < span)
            ends[right] = hit
            left = good & (own >= d)
            key = self.words[win[left], own[left] - d] * span
            hit = keys[np.maximum(np.searchsorted(keys, key + begins[left]) - 1, 0)] - key
            good[left] = (hit >= 0) & (hit < begins[left])
            begins[left] = hit
        good &= ends - begins + 1 - self.size[win] <= slop
        return win[good], begins[good], ends[good] + 1


MATCHES = "seg bigint, doc bigint, exact array<bigint>, near array<bigint>, spans array<struct<first: bigint, end: bigint>>"


def _documents(group: pa.Table, windows: Windows, numbers: np.ndarray, slop: int) -> pa.Table:
    """The matches of one segment, a row for each document that has any."""
    is_term = pc.is_valid(group.column("term"))
    lists, docs = group.filter(is_term), group.filter(pc.invert(is_term))
    starts = np.sort(docs.column("start").to_numpy())
    parts = [np.frombuffer(x.as_py(), np.uint8) for x in lists.column("postings")]
    out: list[list] = [[], [], [], [], []]
    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    if parts:
        counts = lists.column("n").to_numpy()
        gaps = np.cumsum(unpacked(np.concatenate(parts)))
        first = np.cumsum(counts) - counts
        places = gaps - np.repeat(np.concatenate(([0], gaps[first[1:] - 1])), counts)
        win, begin, end = windows.search(lists.column("term").to_pylist(), counts, places, slop)
        doc = np.searchsorted(starts, begin, side="right") - 1
        whole = np.searchsorted(starts, end - 1, side="right") - 1 == doc  # no match crosses two documents
        win, begin, end, doc = win[whole], begin[whole], end[whole], doc[whole]
        order = np.lexsort((begin, doc))
        win, begin, end, doc = win[order], begin[order], end[order], doc[order]
        exact = end - begin == windows.size[win]
        for d, a, b in zip(*_groups(doc)):
            phrase = exact[a:b]
            out[0].append(group.column("seg")[0].as_py())
            out[1].append(int(starts[d]))
            out[2].append(np.unique(numbers[win[a:b][phrase]]))
            out[3].append(np.unique(numbers[win[a:b]]))
            out[4].append(_union(begin[a:b][phrase], end[a:b][phrase]))
    columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64())),
               pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], kind)]
    return pa.Table.from_arrays(columns, names=["seg", "doc", "exact", "near", "spans"])


def _groups(values: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Value, first and end of each stretch of equal ``values``."""
    first = np.flatnonzero(np.diff(values, prepend=-1))
    return values[first].tolist(), first.tolist(), np.append(first[1:], len(values)).tolist()


def _union(begin: np.ndarray, end: np.ndarray) -> list[dict[str, int]]:
    """The disjoint spans that cover the spans from ``begin`` (ascending) to ``end``."""
    if not len(begin):
        return []
    reach = np.maximum.accumulate(end)
    cut = np.flatnonzero(begin[1:] > reach[:-1]) + 1
    firsts, ends = begin[np.concatenate(([0], cut))], reach[np.concatenate((cut - 1, [len(reach) - 1]))]
    return [{"first": a, "end": b} for a, b in zip(firsts.tolist(), ends.tolist())]


def matches(index: DataFrame, windows: DataFrame, slop: int = 0, block: int = BLOCK_WINDOWS) -> DataFrame:
    """(seg, doc, exact, near, spans) of every document with a match, and block after block.

    ``windows`` (number, words) is a written table.  ``exact`` and ``near`` are the numbers of
    the windows found as phrases and found with at most ``slop`` words between; ``spans`` are the
    words inside phrases.  A block of windows, and so what is broadcast, has a fixed bound;
    further blocks read the index again.
    """
    spark = index.sparkSession
    total = windows.count()
    blocks = -(-total // block)
    found = None
    for k in range(blocks):
        # whole numbers of a hash: a block exceeds its mean by little
        part = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k)
        # a written table, so that its real size decides whether the index moves for this join
        terms = stored(part.select(F.explode(F.split("words", " ")).alias("word")).distinct().select(F.encode("word", "UTF-8").alias("term")))
        used = index.where("term is not null").join(terms, "term", "left_semi")
        counts = {bytes(r["term"]): r["n"] for r in used.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}
        rows = part.orderBy("number").toArrow()
        lookup = Windows(rows.column("words").to_pylist(), counts)
        shared = spark.sparkContext.broadcast((lookup, rows.column("number").to_numpy()))
        segments = used.select("seg", "term", "n", "postings", "start").unionByName(
            index.where("term is null").select("seg", "term", "n", "postings", "start"))
        hits = segments.groupBy("seg").applyInArrow(lambda group: _documents(group, *shared.value, slop), MATCHES)
        hits = stored(hits)
        found = hits if found is None else found.unionByName(hits)
    return found if found is not None else spark.createDataFrame([], MATCHES)


def _covered(spans: Column) -> Column:
    """How many words the sorted ``spans`` cover."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reach"))
    step = lambda s, x: F.struct((s["n"] + F.greatest(x["end"] - F.greatest(x["first"], s["reach"]), F.lit(0))).alias("n"),
                                 F.greatest(s["reach"], x["end"]).alias("reach"))
    return F.reduce(spans, zero, step)["n"]


def _items(found: DataFrame, column: str, windows: DataFrame, listed: DataFrame, out: str) -> DataFrame:
    """The sorted ids of the items of each distinct set of windows: documents with the same
    matches, however many, expand into items once."""
    sets = checkpoint(found.where(F.size(column) > 0).select(F.col(column).alias("set")).distinct())
    each = sets.select("set", F.explode("set").alias("number")).join(windows, "number").select("set", "words").join(listed, "words")
    return each.groupBy("set").agg(F.sort_array(F.collect_set("item_id")).alias(out))


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 10, slop: int = 0, block: int = BLOCK_WINDOWS,
                  segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """A row per document: id, ``n_words``, ``n_hit`` (words inside a window's exact phrase), ``items`` (ids of
    the items with such windows) and ``near_items`` (with windows found within ``slop``)."""
    index = build_index(docs, doc_id, text, segment_bytes)
    listed = stored(item_windows(items, item_id, item_text, window))
    windows = stored(listed.select("words").distinct().select(F.monotonically_increasing_id().alias("number"), "words"))
    every = matches(index, windows, slop, block)
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    found = checkpoint(every.groupBy("seg", "doc").agg(flat("exact"), flat("near"), F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
                       .withColumn("n_hit", _covered(F.col("spans"))).drop("spans"))
    exact = _items(found, "exact", windows, listed, "items")
    near = _items(found, "near", windows, listed, "near_items")
    hits = (found.join(exact, found["exact"] == exact["set"], "left").drop("set")
            .join(near, found["near"] == near["set"], "left").select("seg", F.col("doc").alias("start"), "n_hit", "items", "near_items"))
    every_doc = index.where("term is null").select("seg", "start", "doc_id", "n_words")
    empty = F.array().cast("array<string>")
    return every_doc.join(hits, ["seg", "start"], "left").select(
        F.col("doc_id").alias(doc_id), "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", empty).alias("items"), F.coalesce("near_items", empty).alias("near_items"))


ORACLE = r"""
with doc_words as (
  select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select distinct coalesce(cast(item_id as varchar), '') as item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 10) as size, array_to_string(w[p:p + 9], ' ') as words
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as p from item_words where len(w) > 0)),
sizes as (select distinct size from windows),
grams as (
  select row, p, size, array_to_string(w[p:p + size - 1], ' ') as words
  from (select row, w, size, unnest(range(1, len(w) - size + 2)) as p from doc_words, sizes)),
hits as (select distinct row, p, size, item_id from grams join windows using (size, words)),
inside as (select row, count(distinct place) as n_hit
  from (select row, unnest(range(p, p + size)) as place from (select distinct row, p, size from hits)) group by row),
wider as (
  select row, size, array_to_string(list_concat(w[p:p + k - 1], w[p + k + 1:p + size]), ' ') as words
  from (select row, w, size, p, unnest(range(1, size)) as k
    from (select row, w, size, unnest(range(1, len(w) - size + 1)) as p from doc_words, sizes))),
near as (select row, count(distinct item_id) as n_near
  from (select row, item_id from hits union all select row, item_id from wider join windows using (size, words)) group by row),
items as (select row, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct row, item_id from hits) group by row)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, cast(coalesce(n_near, 0) as bigint) as n_near
from doc_words left join inside using (row) left join items using (row) left join near using (row)
"""
