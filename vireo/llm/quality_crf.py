"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad.  Its evidence is what its bytes and
words look like (shares of byte classes, repetition, word lengths), and the same of
the lines before and after it; neighbouring labels depend on each other.  The
field is fitted in numpy on a bounded sample of labelled documents, whose label
each of their lines takes.  Forward-backward gives the probability that a line is
good; a document's score is the mean of its lines' weighted by their length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import CHUNK_BYTES, WordHasher, ship_package

#: bounded training sample: documents, and characters of their texts in all
FIT_DOCS = 4000
FIT_CHARS = 24_000_000
#: lines and characters scored at once; a longer text goes by stretches
STRETCH_LINES, STRETCH_CHARS = 20_000, 4_000_000
BINS = 16
STEPS = 300
RATE = 0.15
RIDGE = 1e-4
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

#: byte classes
LOWER, UPPER, DIGIT, SPACE, STOP, BRACKET, SYMBOL, HIGH, CONTROL = range(9)


def _byte_classes() -> np.ndarray:
    t = np.full(256, CONTROL, np.uint8)
    t[97:123], t[65:91], t[48:58], t[128:] = LOWER, UPPER, DIGIT, HIGH
    for chars, k in ((b" \t\n\x0b\x0c\r", SPACE), (b".,;:!?'\"", STOP), (b"()[]{}<>", BRACKET), (b"#$%&*+-/=@\\^_`|~", SYMBOL)):
        t[list(chars)] = k
    return t


def line_features(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features (lines, k), bytes per line, lines per text); None counts as empty."""
    parts = []
    group, size = [], 0
    hasher, classes = WordHasher(), _byte_classes()
    for t in texts:
        x = t.encode("utf-8", "surrogatepass") if t else b""
        group.append(x)
        size += len(x)
        if size >= CHUNK_BYTES:
            parts.append(_chunk_features(group, hasher, classes))
            group, size = [], 0
    if group or not parts:
        parts.append(_chunk_features(group, hasher, classes))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _chunk_features(group: list, hasher: WordHasher, classes: np.ndarray):
    if not group:
        return np.zeros((0, 16)), np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = b"\n".join(group) + b"\n"
    a = np.frombuffer(data, np.uint8)
    feed = a == 10
    ends = np.flatnonzero(feed)
    n_lines = len(ends)
    length = np.diff(ends, prepend=-1) - 1
    line = np.cumsum(feed) - feed
    kinds = np.bincount(line * 9 + classes[a], minlength=n_lines * 9).reshape(n_lines, 9).astype(np.float64)
    kinds[:, SPACE] -= 1  # the line feed
    h, start, end = hasher._chunk(data)
    at = line[start]
    words = np.bincount(at, minlength=n_lines).astype(np.float64)
    word_bytes = end - start
    some = np.maximum(words, 1)
    mean = np.bincount(at, weights=word_bytes, minlength=n_lines) / some
    # distinct words of a line, and words that repeat the one before
    key = np.unique(h ^ (at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    distinct = np.bincount(at[key], minlength=n_lines) / some
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (at[1:] == at[:-1])
    last = classes[a[end - 1]] if len(end) else np.zeros(0, np.uint8)
    marked = np.bincount(at, weights=(last == STOP) | (last == SYMBOL), minlength=n_lines) / some
    first = classes[a[start]] if len(start) else np.zeros(0, np.uint8)
    capital = np.bincount(at, weights=first == UPPER, minlength=n_lines) / some
    short = np.bincount(at, weights=word_bytes <= 1, minlength=n_lines) / some
    share = kinds / np.maximum(length, 1)[:, None]
    f = np.column_stack([share, np.log1p(length), mean, distinct, np.bincount(at, weights=same, minlength=n_lines) / some, marked, capital, short])
    counts = np.diff(np.searchsorted(ends, np.cumsum([len(x) + 1 for x in group])), prepend=0)
    return f, length, counts


class LineField:
    """Weights: per feature bin for the line itself, the one before and the one
    after, a bias, and four transition scores; state 1 is good."""

    def __init__(self, edges: list, weights: np.ndarray, links: np.ndarray):
        self.edges, self.weights, self.links = edges, weights, links

    def codes(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """(lines, 3 k + 1) positions in the weight vector."""
        width = BINS + 1
        n, k = features.shape
        own = np.empty((n, k), np.int64)
        for j in range(k):
            own[:, j] = j * width + np.searchsorted(self.edges[j], features[:, j], side="right")
        first = np.zeros(n, bool)
        final = np.zeros(n, bool)
        ends = np.cumsum(counts)
        first[(ends - counts)[counts > 0]] = True
        final[(ends - 1)[counts > 0]] = True
        block = k * width
        before = np.roll(own, 1, axis=0) + block
        after = np.roll(own, -1, axis=0) + 2 * block
        none = 3 * block
        before[first], after[final] = none, none
        return np.column_stack([own, before, after, np.full(n, none + 1)])

    @staticmethod
    def n_weights(k: int) -> int:
        return 3 * k * (BINS + 1) + 2


def _chains(counts: np.ndarray):
    """Documents by falling length: (order, first line, steps, documents at each step)."""
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    c = counts[order]
    steps = int(c[0]) if len(c) else 0
    alive = np.searchsorted(-c, -np.arange(steps), side="left") if steps else np.zeros(0, np.int64)
    return order, first, steps, alive


def forward_backward(score: np.ndarray, counts: np.ndarray, links: np.ndarray):
    """(probability of good per line, log normaliser per document, expected
    transitions (2, 2)) for line scores of good against bad (bad is 0)."""
    order, first, steps, alive = _chains(counts)
    n = len(score)
    emit = np.zeros((n, 2))
    emit[:, 1] = score
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    for t in range(steps):
        rows = first[:alive[t]] + t
        if t:
            prev = alpha[rows - 1]
            for s in range(2):
                alpha[rows, s] = np.logaddexp(prev[:, 0] + links[0, s], prev[:, 1] + links[1, s])
        alpha[rows] += emit[rows]
    for t in range(steps - 2, -1, -1):
        rows = first[:alive[t + 1]] + t
        nxt = emit[rows + 1] + beta[rows + 1]
        for s in range(2):
            beta[rows, s] = np.logaddexp(links[s, 0] + nxt[:, 0], links[s, 1] + nxt[:, 1])
    both = alpha + beta
    total = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - total)
    inner = np.ones(n, bool)
    ends = np.cumsum(counts)
    inner[(ends - 1)[counts > 0]] = False
    i = np.flatnonzero(inner)
    pair = np.zeros((2, 2))
    for s in range(2):
        for u in range(2):
            pair[s, u] = np.exp(alpha[i, s] + links[s, u] + emit[i + 1, u] + beta[i + 1, u] - total[i]).sum()
    return good, total, pair


def _edges(x: np.ndarray) -> np.ndarray:
    """At most ``BINS`` cuts: quantiles for the bulk, even steps for the tails."""
    half = BINS // 2
    return np.unique(np.concatenate([np.quantile(x, np.linspace(0, 1, half + 2)[1:-1]),
                                     np.linspace(x.min(), x.max(), half + 2)[1:-1]]))


def fit_field(texts: list, labels: np.ndarray, steps: int = STEPS, rate: float = RATE) -> LineField:
    """Maximum likelihood by Adam; each line takes its document's label."""
    f, _, counts = line_features(texts)
    edges = [_edges(f[:, j]) for j in range(f.shape[1])]
    field = LineField(edges, np.zeros(LineField.n_weights(f.shape[1])), np.zeros((2, 2)))
    codes = field.codes(f, counts)
    y = np.repeat(labels, counts).astype(np.float64)
    ends = np.cumsum(counts)
    inner = np.ones(len(y), bool)
    inner[ends - 1] = False
    i = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[i].astype(int), y[i + 1].astype(int)), 1)
    params = [field.weights, field.links]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n = max(1, len(y))
    for step in range(1, steps + 1):
        good, _, pair = forward_backward(field.weights[codes].sum(axis=1), counts, field.links)
        gap = np.repeat((y - good)[:, None], codes.shape[1], axis=1)
        g_w = np.bincount(codes.ravel(), weights=gap.ravel(), minlength=len(field.weights)) / n - RIDGE * field.weights
        g_l = (seen - pair) / n - RIDGE * field.links
        for p, g, a, b in zip(params, (g_w, g_l), m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p += rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return field


def chain_marginals(score: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Probability of good for every line of one long chain.

    The chain is cut into stretches of about the root of its length.  All
    stretches run side by side from both labels, which gives each its 2 x 2
    transfer; a pass over the stretches carries the forward and backward
    messages across the cuts; then all run again from their true messages."""
    n = len(score)
    length = max(1, int(np.sqrt(n)))
    blocks = -(-n // length)
    # padding after the end: no evidence, and a step that changes nothing
    emit = np.zeros((blocks * length, 2))
    emit[:n, 1] = score
    emit = emit.reshape(blocks, length, 2)
    real = (np.arange(blocks * length) < n).reshape(blocks, length)
    stay = np.where(np.eye(2, dtype=bool), 0.0, -np.inf)

    def step(a, t, rows=slice(None)):
        """Messages (blocks, ..., 2) over the step into place t."""
        link = np.where(real[rows, t][:, None, None], links, stay)
        shape = (len(a),) + (1,) * (a.ndim - 2)
        return np.stack([np.logaddexp(a[..., 0] + link[:, 0, u].reshape(shape), a[..., 1] + link[:, 1, u].reshape(shape))
                         + emit[rows, t, u].reshape(shape) for u in range(2)], axis=-1)

    with np.errstate(invalid="ignore"):
        # transfer of each stretch: from the label before it to its last label
        m = np.broadcast_to(stay, (blocks, 2, 2)).copy()
        for t in range(length):
            m = step(m, t)
        into = np.empty((blocks, 2))
        into[0] = (0.0, -np.inf)  # replaced below: the first line has no line before it
        out = np.empty((blocks, 2))
        first = emit[0, 0].copy()
        for t in range(1, length):
            first = step(first[None, :], t, slice(0, 1))[0]
        out[0] = first
        for b in range(1, blocks):
            into[b] = out[b - 1]
            out[b] = np.logaddexp(into[b][0] + m[b, 0], into[b][1] + m[b, 1])
        back = np.zeros((blocks, 2))  # message from behind into the last line of each stretch
        for b in range(blocks - 2, -1, -1):
            back[b] = np.logaddexp(m[b + 1, :, 0] + back[b + 1][0], m[b + 1, :, 1] + back[b + 1][1])
        alpha = np.empty((blocks, length, 2))
        a = into
        for t in range(length):
            a = step(a, t)
            if t == 0:
                a[0] = emit[0, 0]
            alpha[:, t] = a
        good = np.empty((blocks, length))
        b = back
        for t in range(length - 1, -1, -1):
            both = alpha[:, t] + b
            good[:, t] = np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1]))
            link = np.where(real[:, t][:, None, None], links, stay)
            nxt = emit[:, t] + b
            b = np.stack([np.logaddexp(link[:, s, 0] + nxt[:, 0], link[:, s, 1] + nxt[:, 1]) for s in range(2)], axis=-1)
    return good.reshape(-1)[:n]


def _long_text_score(field: LineField, text: str) -> float:
    """Score of one text by stretches of its lines, each read with the line
    before and after it; only a number per line is held for the whole text."""
    lines = text.split("\n")
    score, length, at = np.empty(len(lines)), np.empty(len(lines)), 0
    while at < len(lines):
        end, chars = at, 0
        while end < len(lines) and end - at < STRETCH_LINES and (end == at or chars + len(lines[end]) <= STRETCH_CHARS):
            chars += len(lines[end])
            end += 1
        low, high = max(0, at - 1), min(len(lines), end + 1)
        f, n, counts = line_features(["\n".join(lines[low:high])])
        s = field.weights[field.codes(f, counts)].sum(axis=1)
        score[at:end], length[at:end] = s[at - low:end - low], n[at - low:end - low]
        at = end
    w = length + 1.0
    return float((chain_marginals(score, field.links) * w).sum() / w.sum())


def _short(text: str | None) -> bool:
    return text is None or (len(text) <= STRETCH_CHARS and text.count("\n") < STRETCH_LINES // 10)


def score_texts(field: LineField, texts: list) -> np.ndarray:
    """Length-weighted mean probability of good lines per text."""
    out = np.empty(len(texts))
    group, size = [], 0

    def flush():
        f, length, counts = line_features([texts[i] for i in group])
        good, _, _ = forward_backward(field.weights[field.codes(f, counts)].sum(axis=1), counts, field.links)
        doc = np.repeat(np.arange(len(group)), counts)
        w = length + 1.0
        out[group] = np.bincount(doc, weights=good * w, minlength=len(group)) / np.bincount(doc, weights=w, minlength=len(group))

    for i, t in enumerate(texts):
        if not _short(t):
            out[i] = _long_text_score(field, t)
            continue
        lines = 1 + (t or "").count("\n")
        if group and size + max(lines, len(t or "") // 200) > STRETCH_LINES:
            flush()
            group, size = [], 0
        group.append(i)
        size += max(lines, len(t or "") // 200)
    if group:
        flush()
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> LineField | None:
    """Fit on labelled documents outside the held-out fold, those with the smallest
    hashes of their ids: at most ``FIT_DOCS`` ids, and as many of their texts in
    that order as hold ``FIT_CHARS`` characters together (a longer text is passed
    over).  Only that bounded sample comes to the driver."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    ids = (labels.select(F.col(id_col).cast("long").alias(id_col), F.col(label_col).cast("int").alias("y"))
           .where((fold != HELD_OUT) & F.col("y").isin(0, 1)).groupBy(id_col).agg(F.min("y").alias("y"))
           .orderBy(F.xxhash64(id_col), id_col).limit(FIT_DOCS))
    text = F.col(text_col).cast("string")
    labelled = (docs.select(F.col(id_col).cast("long").alias("__id"), text.alias("__text"), F.coalesce(F.length(text), F.lit(0)).alias("n"))
                .join(F.broadcast(ids), F.col("__id") == F.col(id_col)).where(F.col("n") <= FIT_CHARS))
    sizes = labelled.select("__id", "n", F.xxhash64("__id").alias("h")).orderBy("h", "__id", "n").limit(2 * FIT_DOCS).collect()
    chosen, total = set(), 0
    for r in sizes:
        if total + r["n"] <= FIT_CHARS:
            chosen.add(r["__id"])
            total += r["n"]
    picked = docs.sparkSession.createDataFrame([(i,) for i in sorted(chosen)], "__chosen long")
    rows = (labelled.join(F.broadcast(picked), F.col("__id") == F.col("__chosen")).select("__id", "__text", "y")
            .orderBy("__id", "__text").limit(2 * FIT_DOCS).toPandas())
    if rows["y"].nunique() < 2:
        return None
    return fit_field(rows["__text"].tolist(), rows["y"].to_numpy())


def predict_quality(docs: DataFrame, field: LineField | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def predict(frames):
        for frame in frames:
            texts = frame["text"].tolist()
            score = np.full(len(frame), 0.5)
            if field is not None:
                score[:] = score_texts(field, texts)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": np.clip(score, 0, 1)})

    return rows.mapInPandas(predict, "doc_id long, score double").withColumnRenamed("doc_id", id_col)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, ``held_out``, ``score`` (0 to 1), ``predicted``.

    Learns labels only from rows outside the held-out fold (crc32 of the id mod 5
    = 0; a null id is in no fold).  Rows of ``labels`` with other values than 0 and
    1 are ignored; of several labels of one id the smaller counts.  Null and empty
    texts are one empty line.  With labels of one kind only every score is 0.5.
    Repeated rows are scored alike; an empty table gives an empty result; other
    columns are ignored."""
    out = predict_quality(docs, fit_quality(docs, labels, id_col, text_col, label_col), id_col, text_col)
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    return out.select(id_col, F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
