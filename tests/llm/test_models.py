"""Quality chain and toxicity net: exact inference, gradients' effect, held-out accuracy."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from flowframe.llm import quality, toxicity
from flowframe.llm.catalog import QUERIES
from tests.conftest import SF_CHECK


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    moves, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    lens = [3, 0, 1, 5, 3]
    offsets = np.concatenate(([0], np.cumsum(lens)))
    good = rng.normal(size=offsets[-1])
    got = quality.line_marginals(good, offsets, moves, start)
    for a, b in zip(offsets, offsets[1:]):
        total, marginal = 0.0, np.zeros(b - a)
        for labels in itertools.product((0, 1), repeat=int(b - a)):
            if not labels:
                continue
            s = start[labels[0]] + sum(moves[x, y] for x, y in zip(labels, labels[1:])) + sum(good[a + i] for i, y in enumerate(labels) if y)
            total += np.exp(s)
            marginal += np.exp(s) * np.array(labels)
        if b > a:
            assert np.allclose(got[a:b], marginal / total)


def test_line_features_do_not_depend_on_the_batch():
    texts = [None, "", "AB!! CD!!\n\nplain words, here.", "w w w w w\nx | y | z", "é" * 50, " lead and trail \n"]
    lines, offsets = quality._line_starts(pa.array(texts))
    x, size = quality.line_features(lines)
    assert list(np.diff(offsets)) == [1, 1, 3, 2, 1, 2] and size[5] == len("w w w w w")
    for i, text in enumerate(texts):
        own, _ = quality.line_features(quality._line_starts(pa.array([text], pa.string()))[0])
        assert np.allclose(own, x[offsets[i]:offsets[i + 1]])
    assert x[5][6] == pytest.approx(0.8) and x[2][1] > 0.9 and x[6][4] > 0


def auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    return ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())


@pytest.mark.parametrize("name,column,fold,least", [("op7_quality_classifier", "quality", (4, 2), 0.97), ("op4_toxicity", "toxic", (3, 1), 0.75)])
def test_held_out_accuracy(llm, name, column, fold, least):
    rows = QUERIES[name](llm, SF_CHECK).toPandas().set_index("doc_id")
    assert (rows["predicted"] == (rows["score"] >= 0.7)).all() and rows["score"].between(0, 1).all()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % fold[0] == fold[1] for i in rows.index]).all()
    labels = llm.read.parquet(f"{SF_CHECK}/labels.parquet").toPandas().set_index("doc_id")
    both = rows.join(labels, how="inner")
    held = both[both["held_out"]]
    assert auc(held["score"].to_numpy(), held[column].to_numpy()) >= least


@pytest.mark.parametrize("module,column", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_labels(llm, odd, none, odd_rows, module, column):
    renamed = lambda df: module.score(df, model, out="result")
    for known in ([], [(12, 1, 1)], [(i, i % 2, i % 2) for i in range(11, 23)] + [(12, None, None), (None, 1, 1), (999, 0, 0), (7, 0, 0)]):
        labels = llm.createDataFrame(known, "doc_id bigint, quality int, toxic int")
        model = module.train(odd, labels, column)
        got = renamed(odd)
        assert got.columns == [*odd.columns, "result"]
        scores = got.select("doc_id", "text", "result").collect()
        assert len(scores) == len(odd_rows)
        assert all(0 <= r["result"] <= 1 for r in scores)
        assert all(r["result"] == 0 for r in scores if not r["text"])
        assert len({r["result"] for r in scores if r["doc_id"] == 12}) == 1
    assert renamed(none).count() == 0


def test_scores_do_not_depend_on_the_batch():
    texts = [f"clean words number {i} follow here" for i in range(40)] + [f"awful{i % 4} trash words number {i}" for i in range(40)]
    net = toxicity.fit(texts, np.array([0] * 40 + [1] * 40))
    scorer = toxicity.Scorer(net)
    together = scorer.scores(pa.array([*texts, "", None, "trash " * 9000]))
    apart = np.concatenate([toxicity.Scorer(net).scores(pa.array([t], pa.string())) for t in [*texts, "", None, "trash " * 9000]])
    assert np.allclose(together, apart, atol=1e-6)
    assert auc(together[:80], np.array([0] * 40 + [1] * 40)) > 0.95


def plain_features(net, words):
    """Filter by filter and place by place: convolution, largest response of a stretch, then of the text."""
    def vector(w):
        return net.table[toxicity.word_features(w)].sum(axis=0)

    vectors = [vector(w) for w in words]
    stretches = []
    for a in range(0, len(words), toxicity.STRETCH):
        best = np.zeros(len(net.bias))
        for f in range(len(net.bias)):
            k, own = divmod(f, toxicity.FILTERS)
            for i in range(a, min(a + toxicity.STRETCH, len(words))):
                r = net.bias[f]
                for t, (width, j) in enumerate(toxicity.TAPS):
                    if width == toxicity.WIDTHS[k] and i + j < len(words):
                        r += vectors[i + j] @ net.taps[:, t * toxicity.FILTERS + own]
                best[f] = max(best[f], r)
        stretches.append(best)
    return np.concatenate([np.max(stretches, axis=0), np.mean(stretches, axis=0)])


def test_convolution_and_pooling_equal_a_plain_version():
    rng = np.random.default_rng(2)
    filters = len(toxicity.WIDTHS) * toxicity.FILTERS
    net = toxicity.Net(rng.normal(size=(toxicity.BUCKETS, toxicity.DIMS)).astype(np.float32),
                       rng.normal(size=(toxicity.DIMS, len(toxicity.TAPS) * toxicity.FILTERS)).astype(np.float32),
                       rng.normal(size=filters).astype(np.float32), rng.normal(size=2 * filters).astype(np.float32), shift=0.3)
    texts = ["one", "two words", " ".join(f"w{i % 23}" for i in range(70)), " ".join(f"x{i}" for i in range(32))]
    words, offsets, names = toxicity.texts_to_words(pa.array(texts))
    scorer = toxicity.Scorer(net)
    got = toxicity.pooled(net, scorer.projected(names), words, offsets)
    for i, text in enumerate(texts):
        want = plain_features(net, text.split())
        assert np.allclose(got[i], want, atol=1e-3)
        logit = want @ net.out + 0.3
        assert scorer.raw(words, offsets, names)[i] == pytest.approx(1 / (1 + np.exp(-np.clip(logit, -30, 30))), abs=1e-3)


def test_every_language_gets_a_threshold_of_its_own():
    counts = np.zeros((len(toxicity.LANGUAGES), 2, toxicity.GRADES + 1))
    counts[0, 0, 100], counts[0, 1, 800] = 500, 50      # many documents: between 100 and 800
    counts[1, 0, 700], counts[1, 1, 900] = 300, 40      # higher scores
    counts[2, 1, 300] = 1                               # one toxic document
    net = toxicity.Net(*[np.zeros(1)] * 4)
    toxicity.calibrate(net, counts)
    assert set(net.cuts) == set(toxicity.LANGUAGES)
    assert 0.1 < net.cuts["en"] < 0.8 and 0.7 < net.cuts["de"] < 0.9 and all(0 < c < 1 for c in net.cuts.values())
    # a language without documents has the common one: SPARE clean documents weigh like one toxic one
    assert net.cuts["none"] == net.cuts["es"]
    best = max(range(1, 1000), key=lambda c: (3 * counts[:, 0, :c].sum() / counts[:, 0].sum() + counts[:, 1, c:].sum() / counts[:, 1].sum()))
    value = lambda c: 3 * counts[:, 0, :c].sum() / counts[:, 0].sum() + counts[:, 1, c:].sum() / counts[:, 1].sum()
    assert value(int(np.ceil(net.cuts["none"] * toxicity.GRADES))) == pytest.approx(value(best))


def test_texts_without_function_words_are_no_language():
    words, offsets, names = toxicity.texts_to_words(pa.array(["zz qq", "the zz", "", "der und", None]))
    assert [toxicity.LANGUAGES[k] for k in toxicity.language_counts(words, offsets, names)] == ["none", "en", "none", "de", "none"]


def test_documents_outside_the_sample_calibrate_too(llm):
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(rng.choice(["the", "and", "word", "other", "more"], 30)) + (f" awful{i % 5}" if i % 4 == 0 else "")) for i in range(240)]
    docs = llm.createDataFrame(texts, "doc_id bigint, text string")
    labels = llm.createDataFrame([(i, int(i % 4 == 0)) for i, _ in texts], "doc_id bigint, toxic int")
    net = toxicity.train(docs, labels, most=40)
    got = toxicity.score(docs, net).toPandas()
    assert auc(got["score"].to_numpy(), (got["doc_id"] % 4 == 0).astype(int).to_numpy()) > 0.95
    both = toxicity.train_and_score(docs, labels, most=40).toPandas().set_index("doc_id")["score"]
    assert np.allclose(both[got["doc_id"]].to_numpy(), got["score"].to_numpy())
    assert {r["score"] for r in toxicity.train_and_score(docs, labels.where("toxic = 0")).collect()} == {0.0}


def test_long_documents_are_chains_that_share_a_weight():
    assert quality.pieces(np.array([0, 3, 3, 1000, 1400])).tolist() == [0, 3, 403, 803, 1000, 1400]
    rng = np.random.default_rng(4)
    lens, labels = np.array([900, 5, 7, 3, 450, 6]), np.array([1, 0, 1, 0, 0, 1])
    offsets = np.concatenate(([0], np.cumsum(lens)))
    x = (rng.normal(size=(offsets[-1], quality.FEATURES)) + np.repeat(labels, lens)[:, None]).astype(np.float32)
    model = quality.fit(x, offsets, labels, np.ones(offsets[-1], np.int64))
    raw = quality.raw_scores(model, x, offsets, np.ones(offsets[-1], np.int64))
    assert raw[labels == 1].min() > model.cut > raw[labels == 0].max()
