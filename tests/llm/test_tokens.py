"""Token counts against greedy matching, BPE against the tokenizers library."""

import json
import random

import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer
from tokenizers.models import WordPiece

from flowframe.llm import bpe, catalog, token_counts
from tests.conftest import SF_SMALL


def greedy(word, pieces):
    n = at = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 1
        n, at = n + 1, end
    return n


def test_longest_match_counts_equal_greedy_matching():
    rng = random.Random(1)
    for _ in range(60):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 14))}
        automaton = token_counts.LongestMatch(pieces)
        for _ in range(60):
            word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(0, 14)))
            assert automaton.count(word) == greedy(word, pieces), (word, pieces)


def test_longest_match_equals_word_piece_model():
    pieces = ["a", "b", "ab", "abc", "bcd", "cd", "d", "c", "abcdx"]
    vocab = {p: i for i, p in enumerate([*pieces, *["##" + p for p in pieces], "[UNK]"])}
    model = Tokenizer(WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=10_000))
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("abcdx") for _ in range(rng.randint(1, 12)))
        assert token_counts.LongestMatch(pieces).count(word) == len(model.encode(word).ids)


def test_token_counts_on_odd_rows(odd, none, odd_rows):
    pieces = token_counts.sentencepiece_pieces(catalog.WORD_PIECES)
    known = set(pieces)
    got = token_counts.token_counts(odd, pieces)
    assert got.columns == [*odd.columns, "n_words", "n_tokens"]
    cache = {}

    def count(text):
        words = (text or "").split()
        return len(words), sum(cache.setdefault(w, greedy("▁" + w, known)) for w in words)

    assert sorted((str(r["doc_id"]), r["n_words"], r["n_tokens"]) for r in got.collect()) == sorted((str(r[0]), *count(r[1])) for r in odd_rows)
    assert token_counts.token_counts(none, pieces).count() == 0


def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def test_bpe_on_odd_rows(odd, none, odd_rows):
    tokenizer = library()
    got = bpe.decode(bpe.encode(odd, catalog.WORD_BPE, ids="tokens"), catalog.WORD_BPE, ids="tokens", decoded="plain")
    assert got.columns == [*odd.columns, "tokens", "plain"]
    expected = [tokenizer.encode(r[1] or "", add_special_tokens=False).ids for r in odd_rows]
    assert sorted((str(r["doc_id"]), r["tokens"], r["plain"]) for r in got.collect()) == sorted(
        (str(r[0]), ids, tokenizer.decode(ids, skip_special_tokens=False)) for r, ids in zip(odd_rows, expected))
    once = bpe.encode(odd, catalog.WORD_BPE, ids="tokens", decoded="plain")
    assert once.columns == got.columns
    assert sorted(map(str, once.select("doc_id", "tokens", "plain").collect())) == sorted(map(str, got.select("doc_id", "tokens", "plain").collect()))
    assert bpe.decode(bpe.encode(none, catalog.WORD_BPE, ids="tokens"), catalog.WORD_BPE, ids="tokens", decoded="plain").count() == 0


def test_bpe_equals_library_on_strange_texts():
    with open(catalog.WORD_BPE, encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(json.load(file))
    tokenizer = library()
    rng = random.Random(7)
    texts = [chr(c) + "a" + chr(c) + " '" + chr(c) for c in [*range(1, 0x3000), *range(0xAC00, 0xAD00), *range(0x1F300, 0x1F400)] if not 0xD800 <= c < 0xE000]
    texts += ["".join(rng.choice("abİΣσςé'sSIJß 1２٣　 \x1c\x85<|endoftext|>") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["<|endoftext|>", "x<|endoftext|>y <|startoftext|>", "<|ENDOFTEXT|>", "ab" * 4000, "日本語" * 700, " \n ", "I'LL they're it's"]
    ours = bpe.encode_texts(vocabulary, pa.array(texts)).to_pylist()
    assert ours == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_queries_over_a_whole_table(llm):
    import hashlib

    docs = {r["doc_id"]: r["text"] or "" for r in llm.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    tokenizer = library()
    rows = catalog.QUERIES["op2_bpe_round_trip"](llm, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = tokenizer.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    pieces = set(token_counts.sentencepiece_pieces(catalog.WORD_PIECES))
    for r in catalog.QUERIES["op1_token_counts"](llm, SF_SMALL).collect():
        assert r["n_tokens"] == sum(greedy("▁" + w, pieces) for w in docs[r["doc_id"]].split())
