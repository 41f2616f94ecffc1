"""Jaccard join of documents on word n-grams with prefix trees.

1. Every document becomes the set of its distinct 5-word shingles (64-bit
   hashes).  Documents are dealt to batches; a batch sends each distinct
   shingle fingerprint once with the number of its documents, and buckets of the
   fingerprint space answer with the total.  That gives all documents the same
   global order: rare shingles first.
2. Two sets with similarity t share a shingle among the first n - ceil(t n) + 1 of
   each in that order.  Documents none of whose leading shingles occurs elsewhere
   link with nothing.  The others are gathered into candidate clusters along
   shared leading shingles (connected components over a star per shingle).
3. Inside a cluster the ordered sets are stored in a trie.  One traversal
   carries the partial overlaps of all probing documents down the tree, so
   documents that share a path share the work, and leaves a subtree when the
   remaining length cannot reach the threshold for any probe.  A cluster above
   the block size is cut into blocks that are joined pairwise as separate tasks.

Equal sets are one class throughout; links are counted, not listed, and
only one edge per member and block leaves a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import WordHasher, batch_plan, bucket_codes, components, keep_one, mix, rolling, ship_package, stage

SHINGLE = 5
PERCENT = 80
BATCH_CHARS = 8_000_000
BATCHES_PER_BUCKET = 2
#: distinct sets of a cluster joined in one task
BLOCK_SETS = 1024
#: tokens of a trie path carried in one step, and bytes of a probe bitmap
STEP = 64
BITMAP_BYTES = 32 << 20

SETS = "doc_id long, text_hash long, n_shingles long, digest long, lead array<long>, tokens array<long>"
LINKS = "digest long, n_links long, label long"


def shingle_sets(texts: list, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a text of fewer words is
    one shingle, without words the set is empty."""
    h, counts = WordHasher(lower=True).words(texts)
    grams = rolling(h, size)
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(grams[at:at + n - size + 1]))
        elif n:
            out.append(rolling(h[at:at + n], n))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += n
    return out


def set_digest(s: np.ndarray) -> int:
    """64-bit digest of a set (equal sets, equal digests)."""
    x = np.array([mix(s ^ np.uint64(0x51ED270B)).sum(dtype=np.uint64) + np.uint64(len(s))], dtype=np.uint64)
    return int(mix(x).view(np.int64)[0])


def lead_length(n: int, percent: int = PERCENT) -> int:
    """A set of n shares one of this many first tokens with any set it links to."""
    return n - -(-percent * n // 100) + 1 if n else 0


# --- round 1: document frequencies -----------------------------------------

def _offer(sets: list, batch: int, n_buckets: int) -> pd.DataFrame:
    codes, times = np.unique(bucket_codes(np.concatenate(sets), n_buckets), return_counts=True)
    cut = np.searchsorted(codes, np.arange(n_buckets + 1, dtype=np.uint64) << np.uint64(32))
    low, times = codes.astype("<u4"), np.minimum(times, 255).astype(np.uint8)
    return pd.DataFrame([(batch, b, low[cut[b]:cut[b + 1]].tobytes(), times[cut[b]:cut[b + 1]].tobytes())
                         for b in range(n_buckets) if cut[b + 1] > cut[b]], columns=["batch", "bucket", "entries", "counts"])


def _totals(frame: pd.DataFrame) -> pd.DataFrame:
    """Documents per fingerprint (255 stands for more), in the order asked."""
    keys = [np.frombuffer(x, dtype="<u4") for x in frame["entries"]]
    times = np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in frame["counts"]])
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    s = every[order]
    start = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    total = np.minimum(np.add.reduceat(times[order].astype(np.int64), start), 255).astype(np.uint8)
    back = np.empty(len(s), dtype=np.uint8)
    back[order] = np.repeat(total, np.diff(np.append(start, len(s))))
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return pd.DataFrame({"batch": frame["batch"].astype("int32"), "bucket": frame["bucket"].astype("int32"),
                         "totals": [x.tobytes() for x in np.split(back, cuts)]})


def _frequencies(sets: list, replies: pd.DataFrame, n_buckets: int) -> np.ndarray:
    """Document frequency (up to 255) of every token of the sets, concatenated."""
    codes, inverse = np.unique(bucket_codes(np.concatenate(sets), n_buckets), return_inverse=True)
    out = np.zeros(len(codes), dtype=np.uint8)
    cut = np.searchsorted(codes, np.arange(n_buckets + 1, dtype=np.uint64) << np.uint64(32))
    for b, x in zip(replies["bucket"].tolist(), replies["totals"].tolist()):
        out[cut[b]:cut[b + 1]] = np.frombuffer(x, dtype=np.uint8)
    return out[inverse]


def document_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT,
                  batch_chars: int = BATCH_CHARS, batches_per_bucket: int = BATCHES_PER_BUCKET) -> DataFrame:
    """One row per input row: id, ``text_hash``, ``n_shingles``, ``digest`` of the set and, if a
    leading shingle occurs in another document too, ``lead`` (those) and
    ``tokens`` (the set)."""
    ship_package(docs.sparkSession)
    n_batches = batch_plan(docs, batch_chars, text_col)
    n_buckets = max(1, -(-n_batches // batches_per_bucket))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text")).withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_batches)).cast("int"))

    def offer(frame: pd.DataFrame) -> pd.DataFrame:
        return _offer(shingle_sets(frame["text"].tolist(), size), int(frame["batch"].iloc[0]), n_buckets)

    def order(frame: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "text_hash", "n_shingles", "digest", "lead", "tokens"]
        if not len(frame):
            return pd.DataFrame(columns=names)
        sets = shingle_sets(frame["text"].tolist(), size)
        often = _frequencies(sets, replies, n_buckets)
        out, at = [], 0
        for d, h, s in zip(frame["doc_id"].tolist(), frame["text_hash"].tolist(), sets):
            f = often[at:at + len(s)]
            at += len(s)
            first = np.argsort(f, kind="stable")[:lead_length(len(s), percent)]
            first = first[f[first] > 1]
            live = len(first) > 0
            out.append((None if pd.isna(d) else int(d), h, len(s), set_digest(s),
                        s[first].view(np.int64) if live else None, s.view(np.int64) if live else None))
        out = pd.DataFrame(out, columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    by_batch = rows.groupBy("batch")
    replies = (by_batch.applyInPandas(offer, "batch int, bucket int, entries binary, counts binary").groupBy("bucket")
               .applyInPandas(_totals, "batch int, bucket int, totals binary"))
    return by_batch.cogroup(replies.groupBy("batch")).applyInPandas(order, SETS)


# --- the trie inside a block -----------------------------------------------

def trie_links(index: list, probes: list, percent: int = PERCENT) -> np.ndarray:
    """Boolean matrix (probe, indexed set): similarity at or above the threshold.

    Tokens are ordered by frequency among the indexed sets, so that similar sets
    share long paths.  Sets in lexicographic order are the trie in preorder; the
    path is kept as a stack of steps, each with the overlap of every probe so
    far, and a set resumes at the last step it shares with the set before it."""
    t = percent
    n_index = np.array([len(s) for s in index])
    n_probe = np.array([len(s) for s in probes])
    out = np.zeros((len(probes), len(index)), dtype=bool)
    values, inverse, times = np.unique(np.concatenate(index), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), dtype=np.int64)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(values))
    ranked = [np.sort(x) for x in np.split(rank[inverse], np.cumsum(n_index)[:-1])]
    order = sorted(range(len(index)), key=lambda i: ranked[i].astype(">u4").tobytes())
    shared = np.zeros(len(order) + 1, dtype=np.int64)
    for k in range(1, len(order)):
        a, b = ranked[order[k - 1]], ranked[order[k]]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        shared[k] = differ[0] if len(differ) else m
    shared[-1] = -1
    sizes = n_index[order]
    width = max(1, BITMAP_BYTES // max(1, len(values)))
    for lo in range(0, len(probes), width):
        part = probes[lo:lo + width]
        held = np.zeros((len(values), len(part)), dtype=np.uint8)
        for j, s in enumerate(part):
            at = np.searchsorted(values, s)
            at[at == len(values)] = 0
            held[rank[at[values[at] == s]], j] = 1
        need = t * n_probe[lo:lo + width]
        stack, dead = [(0, np.zeros(len(part), dtype=np.int64))], None
        for k, i in enumerate(order):
            if dead is not None and shared[k] >= dead:
                continue  # this set goes through a node that no probe passes
            dead = None
            while stack[-1][0] > shared[k]:
                stack.pop()
            depth, overlap = stack[-1]
            path = ranked[i]
            while depth < len(path):
                overlap = overlap + held[path[depth:depth + STEP]].sum(axis=0, dtype=np.int64)
                depth = min(depth + STEP, len(path))
                stack.append((depth, overlap))
                # the largest set below this node, all of its remaining tokens shared
                below = k + 1 + int(np.argmax(shared[k + 1:] < depth))
                largest = int(sizes[k:below].max())
                if not (100 * largest - (100 + t) * (depth - overlap) >= need).any():
                    dead = depth
                    break
            if dead is None:
                out[lo:lo + width, i] = (100 + t) * overlap >= t * (n_probe[lo:lo + width] + len(path))
    return out


def _labels(links: np.ndarray) -> np.ndarray:
    """Smallest index reachable by a symmetric boolean matrix."""
    label = np.arange(len(links))
    while True:
        best = np.minimum(label, np.where(links, label[None, :], len(links)).min(axis=1))
        if (best == label).all():
            return label
        label = best


def _join_block(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    out = []
    for _, f in frame.groupby("cluster", sort=False):
        f = f.drop_duplicates("digest").sort_values("digest")
        if len(f) < 2:
            continue
        ids, many = f["digest"].to_numpy(), f["members"].to_numpy()
        sets = [np.asarray(x, dtype=np.int64).view(np.uint64) for x in f["tokens"]]
        side = f["side"].to_numpy()
        if (side == side[0]).all() and f["i"].iloc[0] == f["j"].iloc[0]:
            full = trie_links(sets, sets, percent)
            np.fill_diagonal(full, False)
        else:
            a, b = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
            if side.min() == side.max():
                continue
            full = np.zeros((len(f), len(f)), dtype=bool)
            full[np.ix_(a, b)] = trie_links([sets[x] for x in b], [sets[x] for x in a], percent)
            full |= full.T
        linked = full @ many.astype(np.float64)
        some = full.any(axis=1)
        out.append(pd.DataFrame({"digest": ids[some], "n_links": linked[some].astype(np.int64), "label": ids[_labels(full)[some]]}))
    if not out:
        return pd.DataFrame({"digest": np.zeros(0, np.int64), "n_links": np.zeros(0, np.int64), "label": np.zeros(0, np.int64)})
    return pd.concat(out)


# --- the join ----------------------------------------------------------------

def _candidate_clusters(sets: DataFrame) -> DataFrame:
    """(digest, cluster): classes joined by leading shingles, a star per shingle."""
    lead = sets.where("lead IS NOT NULL").select("digest", F.explode("lead").alias("token")).distinct()
    star = (lead.groupBy("token").agg(F.min("digest").alias("hub"), F.max("digest").alias("last"))
            .where("hub <> last").select("token", "hub"))
    edges = lead.join(star.hint("merge"), "token").where("digest <> hub").select(F.col("digest").alias("a"), F.col("hub").alias("b")).distinct()
    return components(edges).select(F.col("id").alias("digest"), F.col("component").alias("cluster"))


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT,
                block_sets: int = BLOCK_SETS, **batching) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (smallest id
    reachable by links, itself included) and ``n_links`` (other rows linked).

    A-Z are lower-cased and words kept apart by ASCII white space.  A document's
    set is its distinct shingles of ``size`` words, or the whole sequence as one
    if it has fewer words.  Two rows link when 100 * intersection >= percent *
    union.  Null, empty and blank texts have an empty set and link with nothing.
    Rows that repeat an id or a text are rows of their own; of null ids, which
    never name a component, a row without other links has a null one.  An empty
    table gives an empty result; other columns are ignored.
    """
    return _linked(docs, id_col, text_col, size, percent, block_sets, **batching).select(
        F.col("doc_id").alias(id_col), "n_shingles", "component_id", "n_links")


def _linked(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, percent: int = PERCENT,
            block_sets: int = BLOCK_SETS, **batching) -> DataFrame:
    """The links of every row with its ``text_hash`` and the ``root`` of its
    component (the digest of a set; null for an empty set)."""
    sets = stage(document_sets(docs, id_col, text_col, size, percent, **batching), "sets")
    classes = (sets.where("n_shingles > 0").groupBy("digest").agg(F.count("*").alias("members"), F.min("doc_id").alias("rep")))
    clusters = stage(_candidate_clusters(sets), "clusters")
    sized = clusters.groupBy("cluster").agg(F.count("*").alias("n"))
    n_blocks = max(1, -(-clusters.count() // block_sets))
    cuts = F.ceil(F.col("n") / block_sets).cast("int")
    placed = (clusters.join(sized, "cluster").withColumn("cuts", cuts)
              .withColumn("side", F.pmod(F.xxhash64("digest"), F.col("cuts")).cast("int")))
    home = F.when(F.col("cuts") > 1, F.col("cluster")).otherwise(F.pmod(F.xxhash64("cluster"), F.lit(n_blocks)))
    # a side of a large cluster meets every other side once
    placed = placed.join(classes, "digest").select("digest", "cluster", "members", "rep", "cuts", "side", home.alias("home"),
                                                   F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other"))
    placed = placed.select("digest", "cluster", "members", "rep", "home", "cuts", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    tokens = sets.where("tokens IS NOT NULL").select(F.col("digest").alias("d2"), F.col("doc_id").alias("id2"), "tokens")
    blocks = tokens.join(placed.hint("merge"), (F.col("d2") == F.col("digest")) & F.col("id2").eqNullSafe(F.col("rep")))
    joined = (blocks.select("home", "cuts", "i", "j", "cluster", "side", "digest", "members", "tokens")
              .groupBy("home", "cuts", "i", "j").applyInPandas(lambda f: _join_block(f, percent), LINKS))
    links = stage(joined, "links")
    counted = links.groupBy("digest").agg(F.sum("n_links").alias("other_links"))
    roots = components(links.select(F.col("digest").alias("a"), F.col("label").alias("b")))
    lowest = (roots.join(classes, F.col("id") == F.col("digest")).groupBy("component").agg(F.min("rep").alias("low")))
    named = roots.join(lowest, "component").select(F.col("id").alias("digest"), "low", F.col("component").alias("root"))
    per_class = (classes.join(named, "digest", "left").join(counted, "digest", "left")
                 .select(F.col("digest").alias("d3"), F.coalesce("low", "rep").alias("low"), F.coalesce("root", "digest").alias("root"),
                         (F.coalesce("other_links", F.lit(0)) + F.col("members") - 1).alias("links")))
    rows = sets.select("doc_id", "text_hash", "n_shingles", "digest")
    return (rows.join(per_class, (F.col("digest") == F.col("d3")) & (F.col("n_shingles") > 0), "left")
            .select("doc_id", "text_hash", "root", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("n_links")))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component does, with
    all their columns: the smallest id (null ids last; of one id the text of
    the smallest hash), once if equal rows repeat it.  Rows are told apart by
    id and text, so a text of its own stays whatever other rows share its id.
    Rows with an empty set (null or blank text) stay."""
    linked = _linked(docs, id_col, text_col, **kw)
    rank = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")
    members = linked.select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_text"), F.col("root").alias("grp"), rank.alias("rank"))
    return keep_one(docs, {"k_id": F.col(id_col).cast("long"), "k_text": F.xxhash64(F.col(text_col).cast("string"))}, members)
