"""Source mixing and the whole pipeline against plain re-implementations."""

import hashlib
import math
from collections import Counter

from flowframe.llm import catalog, mixing
from tests.conftest import SF_SMALL


def poisson(rate, seed, doc_id):
    parts = max(1, math.ceil(rate / 500))
    mean, n = rate / parts, 0
    p = c = math.exp(-mean)
    cdf = [c]
    for k in range(1, math.ceil(mean + 12 * math.sqrt(mean) + 30) + 1):
        p = p * mean / k
        c += p
        cdf.append(c)
    for i in range(1, parts + 1):
        digest = hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}:{i}".encode()).hexdigest()
        n += sum(x <= int(digest[:13], 16) / 16 ** 13 for x in cdf)
    return n


def expected(rows, seed):
    sizes = Counter()
    for doc_id, text, source in rows:
        sizes[source] += len(text or "") + 1
    total, roots = sum(sizes.values()), sum(math.sqrt(v) for v in sizes.values())
    return Counter({k: n for k, n in ((r, poisson(total * (math.sqrt(sizes[r[2]]) / roots) / sizes[r[2]], seed, r[0])) for r in rows) if n})


def test_mixing_on_odd_rows(llm, odd, none, odd_rows):
    rows = [(r[0], r[1], r[3]) for r in odd_rows]
    got = mixing.mix(odd, seed=3)
    assert got.columns == [*odd.columns, "copy_", "mix_key"]
    found = Counter((r["doc_id"], r["text"], r["source"]) for r in got.collect())
    once = expected(rows, 3)
    repeats = Counter(rows)
    assert found == Counter({k: n * repeats[k] for k, n in once.items()})
    assert mixing.mix(none).count() == 0
    only = llm.createDataFrame([("s1", 2.0), (None, 1.0)], "source string, weight double")
    assert {r["source"] for r in mixing.mix(odd, only, seed=1).select("source").collect()} <= {"s1", None}


def test_large_rates_reach_their_mean(llm):
    docs = llm.createDataFrame([(0, "x", "small")] + [(i, "y" * 999, "large") for i in range(1, 9)], "doc_id bigint, text string, source string")
    weights = llm.createDataFrame([("small", 1.0), ("large", 1.0)], "source string, weight double")
    counts = Counter(r["source"] for r in mixing.mix(docs, weights, seed=5).select("source").collect())
    assert abs(counts["small"] - 2000) < 5 * math.sqrt(2000)  # 8002 code points and ends, half of them in texts of 2


def test_query_repeats_documents(llm):
    rows = catalog.QUERIES["op8_mix_sources"](llm, SF_SMALL).collect()
    docs = llm.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in rows) == expected([tuple(d) for d in docs], catalog.MIX_SEED)
    assert {r["copy"] for r in rows} >= {1, 2}


def test_pipeline_stages_take_effect(llm):
    import corpus_pipeline
    from tokenizers import Tokenizer

    from tests.llm.test_dedup import groups, shingle_print

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "toxicity", "simhash near-dedup", "mixing sources", "bpe encoding"]
    docs = llm.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {}
    current = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        current = stage(llm, current, SF_SMALL).cache()
        assert current.columns == docs.columns
        kept[name] = current.collect()
    whole = {tuple(r) for r in docs.collect()}
    assert all(set(map(tuple, rows)) <= whole for rows in kept.values())
    before, after = kept["toxicity"], kept["simhash near-dedup"]
    prints = {r["doc_id"]: shingle_print(r["text"]) for r in before}
    near = groups([(a, b) for a in set(prints.values()) for b in set(prints.values()) if (a ^ b).bit_count() <= 3], set(prints.values()))
    least = {}
    for doc_id, p in prints.items():
        least[near[p]] = min(doc_id, least.get(near[p], doc_id))
    assert sorted(r["doc_id"] for r in after) == sorted(least.values())
    mixed = Counter((r["doc_id"], r["text"], r["source"]) for r in kept["mixing sources"])
    assert mixed == expected([(r["doc_id"], r["text"], r["source"]) for r in after], catalog.MIX_SEED)
    tokenizer = Tokenizer.from_file(catalog.WORD_BPE)
    rows = corpus_pipeline.run(llm, SF_SMALL).collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in rows) == mixed
    assert all(r["ids"] == tokenizer.encode(r["text"], add_special_tokens=False).ids for r in rows)


def test_pipeline_stages_on_odd_rows(llm, odd, none):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm, odd, SF_SMALL).columns[:len(odd.columns)] == odd.columns
        assert stage(llm, none, SF_SMALL).count() == 0


def test_toxicity_learns_from_documents_that_quality_rejected(llm, tmp_path):
    """Quality removes every labelled toxic text; toxic ones without a label are still found."""
    import pytest

    import corpus_pipeline

    clean = [(i, f"the plain words of text {i} and more of them for number {i % 7}") for i in range(60)]
    toxic = [(100 + i, f"the plain words of awful{i % 3} text {i} and more") for i in range(60)]
    docs = llm.createDataFrame(clean + toxic, "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, 0) for i, _ in clean] + [(100 + i, 0, 1) for i in range(50)]
    llm.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = docs.where("doc_id < 100 or doc_id >= 150")  # as if quality had rejected what is labelled toxic
    ids = {r["doc_id"] for r in corpus_pipeline.toxicity_filter(llm, kept, str(tmp_path)).collect()}
    assert not any(i >= 150 for i in ids) and len(ids) > 50
    llm.createDataFrame(labels[:60], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "one" / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "one" / "documents.parquet"))
    with pytest.raises(ValueError):
        corpus_pipeline.toxicity_filter(llm, kept, str(tmp_path / "one"))
    assert corpus_pipeline.toxicity_filter(llm, kept.where("false"), str(tmp_path / "one")).count() == 0
