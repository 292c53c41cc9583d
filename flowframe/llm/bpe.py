"""BPE encoding and decoding by prefix-sharing trie traversal.

The encoding of a word's prefix followed by its last token is the encoding of the word
if and only if the two tokens that meet are compatible: BPE of both together gives just
these two.  So every prefix has one last token: the vocabulary entry that ends there
and is compatible with the last token of what comes before it.  The distinct words of a
step are inserted into a trie; a depth-first walk carries the last tokens of all
prefixes on the path, so a prefix that words share is computed once, and each word's
encoding is read back along the path.

An automaton over the vocabulary lists the entries that end at a node, longest first.
The last symbol of a word carries the vocabulary's end-of-word mark, so it is a symbol
of its own kind in the trie.

Supported vocabulary files: ``tokenizers`` JSON with a byte-level BPE model, an
end-of-word suffix, and NFC, white-space and lower-case normalisation; truncation and
padding are not applied.  Special tokens in a text are special tokens, and are kept by
decoding.

Defined results: null and empty texts have no token and decode to the empty text;
repeated rows each get their ids; other columns are kept; an empty table gives an empty
result; words and texts of any length are encoded whole.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from array import array
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from flowframe.llm.common import map_text

#: Marks a symbol as the last of its word (code points of bytes are far below).
LAST = 0x10000
#: Below this code point (Latin) character classes and case are settled.
COMMON = "\u0250"
#: Words remembered by a worker; older ones are computed again.
CACHED_WORDS = 250_000
#: Text bytes whose new words share a trie.
STEP = 4 << 20
#: Rows decoded at a time.
DECODED_ROWS = 512
#: Pairs of tokens whose compatibility a worker remembers.
CACHED_PAIRS = 1_000_000


def byte_symbols() -> list[str]:
    """The printable character that byte-level BPE writes for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(shown))
    return [table[b] for b in range(256)]


def token_names(spec: dict) -> list[str]:
    """The text of every id, special tokens included."""
    names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
    return [names.get(i, "") for i in range(max(names) + 1)]


class Vocabulary:
    """Tokens as symbol strings, merge ranks, and the automaton that lists word endings."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.listed = pa.array(token_names(spec), pa.string())

        def symbols(token: str) -> str:
            if token.endswith(suffix) and len(token) > len(suffix):
                body = token[:-len(suffix)]
                return body[:-1] + chr(ord(body[-1]) + LAST)
            return token

        self.tokens = {symbols(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.text = {i: s for s, i in self.tokens.items()}
        self.length = {i: len(s) for s, i in self.tokens.items()}
        self.ranks: dict[tuple[str, str], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks.setdefault((symbols(left), symbols(right)), rank)
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        # normaliser and word splitter of the library itself, for scripts whose character
        # classes depend on the version of Unicode; it holds no merges and encodes nothing
        self.rare = Tokenizer.from_str(json.dumps({**spec, "added_tokens": [], "model": {**model, "vocab": {}, "merges": []}}))
        self.table = str.maketrans({chr(b): c for b, c in enumerate(byte_symbols())})
        self._automaton()
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, symbols: str) -> list[str]:
        """Plain BPE of a short symbol string: the lowest-ranked pair first, leftmost first."""
        parts, rank, none = list(symbols), self.ranks.get, len(self.ranks)
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (lowest := min(ranks)) < none:
            i = ranks.index(lowest)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), none)
        return parts

    def _automaton(self) -> None:
        self.goto: list[dict[str, int]] = [{}]
        ends: list[int] = [-1]
        for token, i in self.tokens.items():
            if self.merge(token) != [token]:
                continue  # no merge sequence makes it, so BPE never emits it
            node = 0
            for c in token:
                if c not in self.goto[node]:
                    self.goto[node][c] = len(self.goto)
                    self.goto.append({})
                    ends.append(-1)
                node = self.goto[node][c]
            ends[node] = i
        self.fail = [0] * len(ends)
        # entries that end at a node, longest first, with their lengths
        self.endings: list[tuple[tuple[int, int], ...]] = [()] * len(ends)
        own = [((i, self.length[i]),) if i >= 0 else () for i in ends]
        queue = deque(self.goto[0].values())
        for node in queue:
            self.endings[node] = own[node]
        while queue:
            node = queue.popleft()
            for c, child in self.goto[node].items():
                back = self.fail[node]
                while back and c not in self.goto[back]:
                    back = self.fail[back]
                self.fail[child] = self.goto[back].get(c, 0)
                self.endings[child] = own[child] + self.endings[self.fail[child]]
                queue.append(child)
        self.step = [dict(arcs) for arcs in self.goto]

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE of the two tokens' texts gives just these two (remembered)."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        a, b = self.text.get(left, ""), self.text[right]
        known = self.pairs[left << 32 | right] = self.merge(a + b) == [a, b]
        return known

    def follow(self, state: int, symbol: str) -> int:
        """The automaton's next state; resolved failure links are kept."""
        at = state
        while at and symbol not in self.goto[at]:
            at = self.fail[at]
        found = self.step[state][symbol] = self.goto[at].get(symbol, 0)
        return found

    def trie(self, words: list[str]) -> dict:
        """Nested dicts by symbol.  A word stands as a leaf at the first symbol that it
        shares with no other; its last symbol is of a kind of its own, so no word is the
        beginning of another."""
        root: dict = {}
        for word in words:
            node, depth = root, 0
            while True:
                c = word[depth]
                child = node.get(c)
                if child is None:
                    node[c] = word
                    break
                depth += 1
                if child.__class__ is str:  # the leaf moves one symbol down
                    child = node[c] = {child[depth]: child}
                node = child
        return root

    def encode_all(self, words: list[str]) -> dict[str, bytes]:
        """Ids (int32) of distinct symbol strings, by one depth-first walk over their trie."""
        steps, endings, pairs, length = self.step, self.endings, self.pairs, self.length
        deepest = max(map(len, words), default=0) + 1
        state, last = [0] * deepest, [-1] * deepest  # of the prefixes on the path
        out: dict[str, bytes] = {}
        stack = [(0, c if child.__class__ is dict else child, child) for c, child in self.trie(words).items()]
        while stack:
            depth, run, child = stack.pop()
            at = state[depth]
            for c in run:  # one symbol, or the rest of a leaf
                found = steps[at].get(c)
                at = self.follow(at, c) if found is None else found
                depth += 1
                state[depth] = at
                for token, size in endings[at]:
                    if size == depth:
                        break
                    left = last[depth - size]
                    known = pairs.get(left << 32 | token)
                    if known is None:
                        known = self.compatible(left, token)
                    if known:
                        break
                else:
                    token = -1  # a symbol that the vocabulary lacks
                last[depth] = token
            if child.__class__ is dict:
                stack.extend([(depth, c if grown.__class__ is dict else grown[depth:], grown) for c, grown in child.items()])
                continue
            ids = []
            while depth:
                token = last[depth]
                if token < 0:  # left out, as plain merging does
                    ids = [self.tokens[p] for p in reversed(self.merge(child)) if p in self.tokens]
                    break
                ids.append(token)
                depth -= length[token]
            ids.reverse()
            out[child] = array("i", ids).tobytes()
        return out

    def pieces(self, chunk: str) -> list[str]:
        """The words of a chunk without ASCII white space, as symbol strings."""
        if chunk.isascii() and chunk.isalpha():
            lower = chunk.lower()
            return [lower[:-1] + chr(ord(lower[-1]) + LAST)]
        if not chunk.isascii() and max(chunk) >= COMMON:
            plain = self.rare.normalizer.normalize_str(chunk)
            shown = [w for w, _ in self.rare.pre_tokenizer.pre_tokenize_str(plain)]
        else:
            if not chunk.isascii():
                chunk = unicodedata.normalize("NFC", chunk)
            shown = self.split.findall(chunk.lower())
            if not (chunk.isascii() and chunk.isprintable()):
                shown = [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.table) for w in shown]
        return [w[:-1] + chr(ord(w[-1]) + LAST) for w in shown]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids (int32) of each chunk; the words not yet known are encoded together."""
        # tries and caches hold no cycles; the collector would only walk them again and again
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode_chunks(chunks)
        finally:
            if collecting:
                gc.enable()

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        if len(self.words) > CACHED_WORDS:
            self.older, self.words = self.words, {}
        found, fresh = list(map(self.words.get, chunks)), {}
        for i in [i for i, ids in enumerate(found) if ids is None]:
            chunk = chunks[i]
            ids = self.older.get(chunk)
            if ids is None:
                fresh[i] = [chunk] if chunk in self.special else self.pieces(chunk)
            else:
                found[i] = self.words[chunk] = ids
        coded = self.encode_all(list({w for i, ws in fresh.items() if chunks[i] not in self.special for w in ws}))
        for i, words in fresh.items():
            special = self.special.get(chunks[i])
            if special is not None:
                ids = array("i", [special]).tobytes()
            else:
                ids = coded[words[0]] if len(words) == 1 else b"".join([coded[w] for w in words])
            found[i] = self.words[chunks[i]] = ids
        return found


_BUILT: dict[str, Vocabulary] = {}


def _shared(docs: DataFrame, path: str):
    """The vocabulary file, read by the driver and broadcast (a file of a few MB)."""
    with open(path, encoding="utf-8") as file:
        content = file.read()
    held = docs.sparkSession.sparkContext.broadcast(content)
    key = hashlib.sha256(content.encode()).hexdigest()

    def vocabulary() -> Vocabulary:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Vocabulary(json.loads(held.value))
        return _BUILT[key]

    return vocabulary


def encode_texts(vocabulary: Vocabulary, texts: pa.Array) -> pa.Array:
    texts = texts.fill_null("")
    for special in vocabulary.special:  # cut out before anything else is looked at
        if pc.any(pc.match_substring(texts, special)).as_py():
            texts = pc.replace_substring(texts, special, f" {special} ")
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    ids = vocabulary.encode_chunks(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    sizes = np.array([*map(len, ids), 0], np.int64) // 4
    flat = np.frombuffer(b"".join(ids), np.int32)
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    codes = coded.indices.to_numpy(zero_copy_only=False)
    n = sizes[codes]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    take = np.repeat(first[codes] - (ends - n), n) + np.arange(total)
    at = split.offsets.to_numpy() - split.offsets[0].as_py()
    offsets = np.concatenate(([0], ends))[at]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat[take]))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the token ids (array of int) of each whole text.

    With ``decoded``, the text that :func:`decode` makes of those ids comes with them,
    in the same Python worker.
    """
    vocabulary = _shared(docs, path)
    added = f"`{ids}` array<int>" + (f", `{decoded}` string" if decoded else "")

    def step(v: Vocabulary, texts: pa.Array) -> list[pa.Array]:
        found = encode_texts(v, texts)
        return [found, decode_ids(v.listed, found)] if decoded else [found]

    return map_text(docs, text, added, step, vocabulary, STEP)


def decode(docs: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the text of the token ids; special tokens are kept.

    The vocabulary names no decoder, so tokens are joined by single spaces.
    """
    from pyspark.sql.types import StringType, StructField, StructType

    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(token_names(json.load(file)))
    schema = StructType([*docs.schema.fields, StructField(decoded, StringType())])
    where = docs.columns.index(ids)

    def run(batches):
        tokens = pa.array(shared.value, pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(at, DECODED_ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, decode_ids(tokens, part.column(where))], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode_ids(tokens: pa.Array, ids: pa.Array) -> pa.Array:
    """Token names of each list joined by single spaces; a null list is an empty text."""
    flat = tokens.take(ids.flatten())
    sizes = pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, flat), " ")
