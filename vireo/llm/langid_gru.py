"""Language identification with a bidirectional GRU over bytes.

The model is trained here, in numpy, by backpropagation through time on byte
windows of a bounded sample of labelled documents.  It labels every byte
position of every whole text: the text is read in stretches of ``STRETCH`` bytes that
overlap, and a position counts where it has at least ``CONTEXT`` bytes of its
text (or the text's end) on both sides, so no character or word is judged from
the cut.  A document's probabilities are the mean of its positions' over
letters.  Weights travel to the tasks inside the function (a few kilobytes).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import ship_package

HIDDEN = 8
#: bytes of a training window
WINDOW = 64
#: bytes read at once when labelling, and how far the stretches reach into each other on either side
STRETCH, CONTEXT = 256, 16
#: bounded training sample: documents per language, in all, and windows per document
FIT_DOCS = 400
FIT_TOTAL = 8000
FIT_WINDOWS = 12
SLOTS = 64
SLOT_DOCS = 40
STEPS = 500
BATCH = 384
RATE = 0.02
#: stretches labelled at once
LANES = 512
#: characters of texts taken apart at once
GROUP_CHARS = 1_000_000
UNKNOWN = "und"
#: how far above chance, on the way to certainty, the best language must lie
MARGIN = 1 / 15


def _sigmoid(x):
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class ByteGRU:
    """Arrays are (direction, unit, lane): direction 0 reads forwards, 1 backwards."""

    def __init__(self, n_out: int, hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        h = hidden
        self.h = h
        self.x = (rng.standard_normal((2, 3 * h, 256)) * 0.3).astype(np.float32)
        self.u = (rng.standard_normal((2, 3 * h, h)) / np.sqrt(h)).astype(np.float32)
        self.o = (rng.standard_normal((n_out, 2 * h)) * 0.3).astype(np.float32)
        self.c = np.zeros((n_out, 1), np.float32)

    def params(self):
        return [self.x, self.u, self.o, self.c]

    def _step(self, codes, state):
        """codes: (2, lanes) bytes.  Returns gates z, r, candidate n, U h and the new state."""
        h = self.h
        g = np.stack([np.take(self.x[0], codes[0], axis=1), np.take(self.x[1], codes[1], axis=1)])
        uh = np.matmul(self.u, state)
        g[:, :2 * h] += uh[:, :2 * h]
        zr = np.clip(g[:, :2 * h], -30, 30)
        zr = _sigmoid(zr)
        z, r = zr[:, :h], zr[:, h:]
        n = r * uh[:, 2 * h:]
        n += g[:, 2 * h:]
        np.tanh(n, out=n)
        new = state - n
        new *= z
        new += n
        return z, r, n, uh, new

    def states(self, windows: np.ndarray) -> np.ndarray:
        """(lanes, T) bytes -> (T, 2 * hidden, lanes) states, backward ones at their position."""
        lanes, t = windows.shape
        cols = np.ascontiguousarray(windows.T)
        out = np.empty((t, 2, self.h, lanes), np.float32)
        s = np.zeros((2, self.h, lanes), np.float32)
        for i in range(t):
            *_, s = self._step((cols[i], cols[t - 1 - i]), s)
            out[i, 0], out[t - 1 - i, 1] = s[0], s[1]
        return out.reshape(t, 2 * self.h, lanes)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(lanes, T) bytes -> (T, languages, lanes) position probabilities."""
        logits = np.matmul(self.o, self.states(windows))
        logits += self.c
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        """Loss and its gradients by backpropagation through time; labels per lane, weights (T, lanes)."""
        lanes, t = windows.shape
        h = self.h
        cols = np.ascontiguousarray(windows.T)
        s = np.zeros((2, h, lanes), np.float32)
        tape, out = [], np.empty((t, 2, h, lanes), np.float32)
        for i in range(t):
            codes = (cols[i], cols[t - 1 - i])
            z, r, n, uh, new = self._step(codes, s)
            tape.append((codes, z, r, n, uh, s))
            s = new
            out[i, 0], out[t - 1 - i, 1] = s[0], s[1]
        both = out.reshape(t, 2 * h, lanes)
        p = np.matmul(self.o, both) + self.c
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        total = weights.sum() + 1e-9
        lane = np.arange(lanes)
        loss = float(-(np.log(p[:, labels, lane] + 1e-9) * weights).sum() / total)
        p[:, labels, lane] -= 1
        p *= (weights / total)[:, None, :].astype(np.float32)
        go = np.einsum("tkl,thl->kh", p, both, optimize=True)
        gc = p.sum(axis=(0, 2))[:, None]
        back = np.matmul(self.o.T, p).reshape(t, 2, h, lanes)
        gx, gu = np.zeros_like(self.x), np.zeros_like(self.u)
        ds = np.zeros((2, h, lanes), np.float32)
        for i in range(t - 1, -1, -1):
            codes, z, r, n, uh, old = tape[i]
            ds[0] += back[i, 0]
            ds[1] += back[t - 1 - i, 1]
            dn = ds * (1 - z) * (1 - n * n)
            dz = ds * (old - n) * z * (1 - z)
            dr = dn * uh[:, 2 * h:] * r * (1 - r)
            dg = np.concatenate([dz, dr, dn], axis=1)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            gu += np.matmul(du, old.transpose(0, 2, 1))
            for d in range(2):
                onehot = np.zeros((lanes, 256), np.float32)
                onehot[lane, codes[d]] = 1
                gx[d] += dg[d] @ onehot
            ds = ds * z + np.matmul(self.u.transpose(0, 2, 1), du)
        return loss, [gx, gu, go.astype(np.float32), gc.astype(np.float32)]


def train(windows: np.ndarray, labels: np.ndarray, n_out: int, steps: int = STEPS, batch: int = BATCH, rate: float = RATE,
          hidden: int = HIDDEN, seed: int = 11) -> ByteGRU:
    """Adam over random batches with as many windows of each language."""
    rng = np.random.default_rng(seed)
    net = ByteGRU(n_out, hidden)
    by = [np.flatnonzero(labels == k) for k in range(n_out)]
    by = [b for b in by if len(b)]
    m = [np.zeros_like(p) for p in net.params()]
    v = [np.zeros_like(p) for p in net.params()]
    letter = _letter_table()
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(b, batch // len(by) + 1) for b in by])
        w = windows[pick]
        _, grads = net.gradients(w, labels[pick], letter[w].T.astype(np.float32))
        lr = rate * min(1.0, step / 20) * (1 - 0.9 * step / steps)
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        clip = min(1.0, 1.0 / (size + 1e-9))
        for p, g, a, b in zip(net.params(), grads, m, v):
            g = g * clip
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= lr * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)
    return net


def _letter_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[65:91] = t[97:123] = t[128:] = True
    return t


def to_stretches(texts: list, width: int = STRETCH, context: int = CONTEXT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all texts in stretches that overlap: (bytes (stretches,
    width), the last of a text padded with spaces; whether a position counts
    there, once for each byte; the text of each stretch)."""
    step = width - 2 * context
    parts, use, owner = [], [], []
    for i, t in enumerate(texts):
        d = t.encode("utf-8", "surrogatepass")
        n = 1 - (-max(0, len(d) - width) // step) if d else 0
        for k in range(n):
            at = k * step
            begin, end = at + (context if k else 0), at + width - context if k < n - 1 else len(d)
            parts.append(d[at:at + width].ljust(width))
            use.append((begin - at, end - at))
            owner.append(i)
    place = np.arange(width)
    use = np.array(use, dtype=np.int64).reshape(-1, 2)
    return (np.frombuffer(b"".join(parts), np.uint8).reshape(-1, width), (place >= use[:, :1]) & (place < use[:, 1:]), np.array(owner, dtype=np.int64))


def label_texts(net: ByteGRU, texts: list) -> np.ndarray:
    """(texts, languages): mean position probabilities over letters."""
    windows, counts, owner = to_stretches(texts)
    letter = _letter_table()
    n_out = len(net.c)
    sums, marks = np.zeros((len(windows), n_out)), np.zeros(len(windows))
    for at in range(0, len(windows), LANES):
        w = windows[at:at + LANES]
        use = (letter[w] & counts[at:at + LANES]).T.astype(np.float32)
        sums[at:at + LANES] = np.einsum("tkl,tl->lk", net.probabilities(w), use)
        marks[at:at + LANES] = use.sum(axis=0)
    total = np.bincount(owner, weights=marks, minlength=len(texts))
    pooled = np.stack([np.bincount(owner, weights=sums[:, k], minlength=len(texts)) for k in range(n_out)], axis=1)
    return pooled / np.maximum(total, 1)[:, None]


def fold(id_col, parts: int):
    return F.crc32(id_col.cast("string").cast("binary")) % parts


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  folds: int = 4, held_out: int = 2, **kw) -> tuple[ByteGRU | None, list]:
    """(model, languages) from at most ``FIT_DOCS`` documents per language outside the
    held-out fold: of the ``SLOT_DOCS`` smallest hashes of each of ``SLOTS`` slots the smallest.  Only their ids are ranked; the
    bounded list of ids fetches their texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where((fold(F.col("doc_id"), folds) != held_out) & F.col("lang").isNotNull())
    # first within slots of a language, so that a common one isn't ranked in one task
    rows = rows.withColumn("h", F.xxhash64("doc_id")).withColumn("slot", F.pmod("h", F.lit(SLOTS)))
    # (a slot holds far fewer of the smallest hashes than all it could)
    for by, most in ((["lang", "slot"], SLOT_DOCS), (["lang"], FIT_DOCS)):
        rank = Window.partitionBy(*by).orderBy("h", "doc_id")
        rows = rows.withColumn("k", F.row_number().over(rank)).where(F.col("k") <= most)
    ids = rows.orderBy("k", "lang").limit(FIT_TOTAL).select("doc_id")
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
             .join(F.broadcast(ids.distinct()), "doc_id").where("lang IS NOT NULL AND text IS NOT NULL")
             # a window of the text per place, no more than the fit uses
             .select("doc_id", "lang", F.length("text").alias("n"), F.explode(F.transform(
                 F.sequence(F.lit(0), F.lit(FIT_WINDOWS - 1)),
                 lambda i: F.substr("text", (F.lit(1) + F.floor(i * F.greatest(F.length("text") - WINDOW, F.lit(0)) / FIT_WINDOWS)).cast("int"),
                                    F.lit(WINDOW))
             )).alias("part")).where("length(part) > 0").orderBy("doc_id", "lang", "part").toPandas())
    languages = sorted(texts["lang"].unique())
    if not languages:
        return None, []
    data = [t.encode("utf-8", "surrogatepass")[:WINDOW].ljust(WINDOW) for t in texts["part"]]
    windows = np.frombuffer(b"".join(data), np.uint8).reshape(-1, WINDOW)
    labels = texts["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy()
    return train(windows, labels, len(languages), **kw), languages


def predict_languages(docs: DataFrame, net: ByteGRU | None, languages: list, id_col: str = "doc_id", text_col: str = "text",
                      carry: bool = False) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to id (or, with ``carry``, to every column)."""
    ship_package(docs.sparkSession)
    text = F.col(text_col).cast("string")
    has_letter = F.coalesce(text.rlike("\\p{L}"), F.lit(False))
    rows = docs if carry else docs.select(F.col(id_col).cast("long").alias(id_col), text.alias(text_col))
    if net is None:
        return rows.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    rows = rows.withColumn("__letter", has_letter)
    kept = rows.drop("__letter") if carry else rows.drop("__letter", text_col)
    columns, types = kept.columns, kept.schema

    def predict(frames):
        for frame in frames:
            pred = np.full(len(frame), UNKNOWN, dtype=object)
            score = np.zeros(len(frame))
            use = np.flatnonzero(frame["__letter"].to_numpy(dtype=bool))
            texts = frame[text_col].tolist()
            size = np.cumsum([len(texts[i]) for i in use]) // GROUP_CHARS
            for part in np.split(use, np.flatnonzero(np.diff(size)) + 1) if len(use) else []:
                p = label_texts(net, [texts[i] for i in part])
                best = p.argmax(axis=1)
                pred[part] = np.array(languages, dtype=object)[best]
                score[part] = np.clip(p[np.arange(len(part)), best], 0, 1)
            out = frame[columns].copy()
            out["lang_pred"], out["score"] = pred, score
            yield out

    return rows.mapInPandas(predict, types.add("lang_pred", "string").add("score", "double"))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: id, ``held_out``, ``lang_pred``, ``score`` (0 to 1).

    Learns from text and non-null ``lang`` of rows outside the held-out fold
    (crc32 of the id mod 4 = 2; a null id is in no fold and isn't learned from).
    Null texts and texts without a letter are ``und`` with score 0; without any
    labelled row every text is.  Very short texts are scored on what they have;
    ties go to the first language in order.  Repeated rows are scored alike; an
    empty table gives an empty result; other columns are ignored."""
    net, languages = fit_languages(docs, id_col, text_col, lang_col)
    out = predict_languages(docs, net, languages, id_col, text_col)
    return out.select(id_col, F.coalesce(fold(F.col(id_col), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, margin: float = MARGIN, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is identified, with all their columns:
    texts with a letter whose best language lies ``margin`` of the way from chance
    (1 / languages) to certainty.  Without any labelled row nothing is learned,
    and every text with a letter stays."""
    net, languages = fit_languages(docs, id_col, text_col, lang_col)
    if net is None:
        return docs.where(F.coalesce(F.col(text_col).cast("string").rlike("\\p{L}"), F.lit(False)))
    least = 1 / len(languages) + margin * (1 - 1 / len(languages)) - 1e-9
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.toDF(*names.values())
    out = predict_languages(inner, net, languages, names[id_col], names[text_col], carry=True)
    out = out.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*names.values())
    return out.toDF(*docs.columns)
