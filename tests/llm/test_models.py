"""The trained models against brute force: features, neighbours, chains, stretches, pooling."""
import itertools

import numpy as np
import pytest

from vireo.llm import langid_gru as lg
from vireo.llm import quality_crf as qc


# --- quality field ---------------------------------------------------------------

def plain_features(line: bytes):
    """Features of one line by plain counting, in the order of ``line_features``."""
    classes = qc._byte_classes()
    kinds = [0] * 9
    for b in line:
        kinds[classes[b]] += 1
    words = [w for w in line.translate(bytes(0x20 if b in b" \t\n\x0b\x0c\r" else b for b in range(256))).split(b" ") if w]
    some, n = max(1, len(words)), len(line)
    return [k / max(1, n) for k in kinds] + [
        np.log1p(n), sum(map(len, words)) / some, len(set(words)) / some, sum(a == b for a, b in zip(words, words[1:])) / some,
        sum(classes[w[-1]] in (qc.STOP, qc.SYMBOL) for w in words) / some, sum(classes[w[0]] == qc.UPPER for w in words) / some,
        sum(len(w) <= 1 for w in words) / some]


TEXTS = ["A line, here.\nand and and a b c\n\n  \tindented 12% [x]", "", None, "Ünïcode wörds\nEND", "\n\n", "one"]


def test_line_features_by_counting():
    f, length, counts = qc.line_features(TEXTS)
    lines = [x.encode() for t in TEXTS for x in (t or "").split("\n")]
    assert counts.tolist() == [len((t or "").split("\n")) for t in TEXTS] and length.tolist() == list(map(len, lines))
    assert np.allclose(f, [plain_features(x) for x in lines])


def random_field(seed=0):
    rng = np.random.default_rng(seed)
    f, _, _ = qc.line_features(TEXTS * 3)
    edges = [qc._edges(f[:, j] + rng.normal(0, .1, len(f))) for j in range(f.shape[1])]
    return qc.LineField(edges, rng.normal(0, .5, qc.LineField.n_weights(f.shape[1])), rng.normal(0, 1, (2, 2)))


def plain_score(field, text):
    """Neighbour features, every labelling of the lines enumerated, length-weighted marginals."""
    lines = [x.encode() for x in (text or "").split("\n")]
    k, width = len(field.edges), qc.BINS + 1
    bins = [[int(np.searchsorted(field.edges[j], v, side="right")) for j, v in enumerate(plain_features(x))] for x in lines]
    emit = []
    for i in range(len(lines)):
        s = field.weights[3 * k * width + 1]
        for j in range(k):
            s += field.weights[j * width + bins[i][j]]
            s += field.weights[k * width + j * width + bins[i - 1][j]] if i else field.weights[3 * k * width]
            s += field.weights[2 * k * width + j * width + bins[i + 1][j]] if i + 1 < len(lines) else field.weights[3 * k * width]
        emit.append(s)
    total, good = 0.0, np.zeros(len(lines))
    for labels in itertools.product((0, 1), repeat=len(lines)):
        w = np.exp(sum(e for e, y in zip(emit, labels) if y) + sum(field.links[a, b] for a, b in zip(labels, labels[1:])))
        total += w
        good += w * np.array(labels)
    weights = np.array([len(x) + 1.0 for x in lines])
    return float((good / total * weights).sum() / weights.sum())


def test_scores_by_enumeration():
    field = random_field()
    assert np.allclose(qc.score_texts(field, TEXTS), [plain_score(field, t) for t in TEXTS])


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 1000])
def test_long_chains_equal_forward_backward(n):
    rng = np.random.default_rng(n)
    score, links = rng.normal(0, 3, n), rng.normal(0, 2, (2, 2))
    want, _, _ = qc.forward_backward(score, np.array([n]), links)
    assert np.allclose(qc.chain_marginals(score, links), want)


def test_long_texts_by_stretches(monkeypatch):
    rng = np.random.default_rng(1)
    field = random_field(2)
    text = "\n".join(" ".join(rng.choice(["Word", "and", "x", "12", "!"], rng.integers(0, 9))) for _ in range(700))
    whole = qc.score_texts(field, [text, "short"])
    monkeypatch.setattr(qc, "STRETCH_LINES", 60)
    monkeypatch.setattr(qc, "STRETCH_CHARS", 500)
    assert not qc._short(text)
    assert np.allclose(qc.score_texts(field, [text, "short"]), whole)


def test_a_million_lines_in_bounded_time():
    import time
    field = random_field(3)
    at = time.time()
    assert 0 <= qc.score_texts(field, ["a\n" * 1_000_000])[0] <= 1
    assert time.time() - at < 15


def test_fit_sample_is_bounded_by_characters(spark, monkeypatch):
    rows = [(i, ("good words here. " if i % 2 else "x1 x1 x1 ") * 40, i % 2) for i in range(60)] + [(1000, "y" * 200_000, 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(qc, "FIT_CHARS", 10_000)
    monkeypatch.setattr(qc, "fit_field", lambda texts, y: seen.append(texts))
    qc.fit_quality(docs, labels)
    assert 0 < sum(map(len, seen[0])) <= 10_000 and len(seen[0]) > 5


# --- language network ---------------------------------------------------------------

def test_every_byte_counts_once_with_context_on_both_sides():
    rng = np.random.default_rng(0)
    texts = ["", "a", "é" * 5] + ["".join(map(chr, rng.integers(97, 123, n))) for n in (15, 16, 17, 223, 224, 239, 240, 241, 255, 256, 257, 1000, 5000)]
    windows, counts, owner = lg.to_stretches(texts)
    for i, t in enumerate(texts):
        rows = np.flatnonzero(owner == i)
        data = t.encode()
        assert bytes(windows[rows][counts[rows]]) == data
        for k, r in enumerate(rows):
            used = np.flatnonzero(counts[r])
            if k:
                assert used[0] >= lg.CONTEXT
            if k < len(rows) - 1:
                assert used[-1] < lg.STRETCH - lg.CONTEXT


def test_pooled_probabilities_by_hand():
    """Every stretch read alone, position by position, by a plain loop over the network's formulas."""
    net = lg.ByteGRU(3, 4)
    texts = ["Das ist ein Satz, 12.", "x" * 300 + " y? " + "ab " * 80, "1 2 3"]
    got = lg.label_texts(net, texts)
    h, letter = net.h, lg._letter_table()
    sig = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))

    def read(data, d):
        s, out = np.zeros(h), []
        for b in (data if d == 0 else data[::-1]):
            g, u = net.x[d][:, b].astype(float), net.u[d].astype(float) @ s
            z, r = sig(g[:h] + u[:h]), sig(g[h:2 * h] + u[h:2 * h])
            n = np.tanh(g[2 * h:] + r * u[2 * h:])
            s = (1 - z) * n + z * s
            out.append(s)
        return out if d == 0 else out[::-1]

    windows, counts, owner = lg.to_stretches(texts)
    sums, marks = np.zeros((3, 3)), np.zeros(3)
    for w, use, i in zip(windows, counts, owner):
        for b, u, f, r in zip(w, use, read(w, 0), read(w, 1)):
            if u and letter[b]:
                v = net.o.astype(float) @ np.concatenate([f, r]) + net.c[:, 0]
                p = np.exp(v - v.max())
                sums[i] += p / p.sum()
                marks[i] += 1
    assert np.allclose(got, sums / np.maximum(marks, 1)[:, None], atol=1e-4)


def test_acceptance_without_labels_and_with_one_language(spark):
    rows = [(i, "some words of a text", None) for i in range(5)] + [(9, "123", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert lg.accepted(docs).count() == 5
    one = spark.createDataFrame([(i, "some words of a text", "en") for i in range(20)] + [(99, "12 34", "en")], "doc_id long, text string, lang string")
    assert lg.accepted(one).count() == 20
