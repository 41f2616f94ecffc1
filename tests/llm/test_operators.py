"""The operators against brute force on small fixtures, and their defined results on awkward rows."""
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def words(t):
    return WORD.findall(t or "")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- exact dedup ---------------------------------------------------------------

def brute_exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), (d is not None, d)))
    out = []
    for d, t in rows:
        g = groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")]
        keep = min(g)[1][1]
        out.append((d, keep, len(g), d == keep))
    return Counter(out)


def test_exact_groups(spark, awkward, empty):
    from vireo.llm.exact_dedup import exact_dedup, exact_groups
    base = "x" * 700
    extra = [(100 + i, t) for i, t in enumerate([base + "a", base + "b", base + "a", base, "x" * 64, "x" * 64, "x" * 512, "x" * 512 + "y"])]
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()] + extra
    df = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = exact_groups(df)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()) == brute_exact(rows)
    assert exact_groups(empty).count() == 0
    kept = exact_dedup(awkward)
    assert kept.columns == awkward.columns and kept.where("doc_id = 1").count() == 0 and kept.where("doc_id = 7").count() == 1


# --- packing ---------------------------------------------------------------------

def test_first_fit_decreasing_matches_linear_scan():
    from vireo.llm.packing import first_fit_decreasing
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 57):
        lengths = rng.integers(1, 100, n)
        bins, offsets = first_fit_decreasing(lengths, 100)
        free = []
        for i in np.argsort(-lengths, kind="stable"):
            at = next((b for b, f in enumerate(free) if f >= lengths[i]), None)
            if at is None:
                free.append(100)
                at = len(free) - 1
            assert bins[i] == at and offsets[i] == 100 - free[at]
            free[at] -= lengths[i]


@pytest.mark.parametrize("capacity", [64, 1024])
def test_packing_round_trip(spark, awkward, empty, capacity):
    import public_tokenizers
    from tokenizers import Tokenizer

    from vireo.llm.packing import pack_documents
    path = public_tokenizers.path("byte_bpe_50k.json")
    full = Tokenizer.from_file(path)
    df = awkward.select("doc_id", "text").unionByName(documents(spark).select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    rows = pack_documents(df, path, capacity=capacity, group_chars=60_000).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece_start, bytes(r.ids_le32), r.doc_tokens))
        bins[r.sequence_id].append((r.sequence_offset, r.length))
        assert r.length * 4 == len(r.ids_le32)
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    for d, t in ((r.doc_id, r.text) for r in df.where("doc_id IS NOT NULL AND doc_id <> 2").collect()):
        want = np.array(full.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        assert b"".join(x[1] for x in sorted(pieces[d])) == want
    tokens, padded = sum(r.length for r in rows), len(bins) * capacity
    assert tokens / padded > 0.9
    assert pack_documents(empty, path).count() == 0


def test_rank_encoder_equals_tokenizer_on_plain_characters():
    import public_tokenizers

    from vireo.llm.packing import PLAIN_LIMIT, _encoders
    full, fast = _encoders(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    chars = [chr(i) for i in range(PLAIN_LIMIT)]
    texts = [f"a{c}b {c}c{c}{c} 1{c}2\n{c}\t {c}'s" for c in chars] + ["".join(rng.choices(chars, k=60)) for _ in range(1500)]
    for t in texts:
        if "<|" not in t:
            assert full.encode(t, add_special_tokens=False).ids == fast.encode_ordinary(t), repr(t)


# --- mixing ----------------------------------------------------------------------

def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        level = (total - sum(2 * sizes[s] for s in capped)) / max(1e-12, sum(weight[s] for s in names if s not in capped))
        over = {s for s in names if s not in capped and level * weight[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return {s: 2 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


@pytest.mark.parametrize("which", ["sf", "awkward"])
def test_mixing(spark, awkward, which):
    from vireo.llm.mixing import mix_sources, mixed_documents
    df = documents(spark) if which == "sf" else awkward
    rows = mix_sources(df).collect()
    assert len(rows) == df.count()
    sizes = Counter()
    for r in df.select("source", "text").collect():
        sizes[r.source] += len(words(r.text))
    want = brute_targets(dict(sizes))
    taken, largest = Counter(), Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.5 * largest[s], 0.01 * want[s])
    again = sorted((str(r.doc_id), r.size, r.taken) for r in mix_sources(df).collect())
    assert again == sorted((str(r.doc_id), r.size, r.taken) for r in rows)
    mixed = mixed_documents(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in rows)


def test_mixing_empty(empty):
    from vireo.llm.mixing import mix_sources
    assert mix_sources(empty).count() == 0


# --- WARC ------------------------------------------------------------------------

def test_warc_round_trip(spark):
    from vireo.llm.warc import archive_files, inflate_stream, normalise_archives, read_index, warc_roundtrip, write_archives
    from vireo.llm.common import scratch_path
    big, text = "<p>" + "éx\r\n\r\nWARC/1.1\r\n" * 40_000, "<html>" + "a" * 200
    rows = [(3, "http://a\r\nX: y", text), (1, None, text), (2, "http://b", text), (4, "u", None), (5, "u", ""), (6, "u", "small"), (7, "u", "small"),
            (8, "u", big), (9, "u", big), (9, "u", big), (None, "u", text)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", F.lit(1))
    got = warc_roundtrip(df).collect()
    first = {}
    for i, _, t in rows:
        if i is not None and len((t or "").encode()) >= 100:
            first[t] = min(i, first.get(t, i))
    want = Counter()
    for i, _, t in rows:
        data = (t or "").encode()
        later = i is not None and t in first and i > first[t]
        want[(i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if later else "response", first[t] if later else None, b"" if later else data)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in got) == want
    root = scratch_path(spark, "w")
    write_archives(df, f"{root}/m")
    normalise_archives(archive_files(spark, f"{root}/m"), f"{root}/n").count()
    for r in read_index(spark, f"{root}/n").collect():  # every record is a member of its own
        with open(r.archive.removeprefix("file:").replace("///", "/"), "rb") as f:
            f.seek(r.offset)
            z = zlib.decompressobj(31)
            record = z.decompress(f.read(r.length))
            assert z.eof and not z.unused_data and record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    assert warc_roundtrip(df.where("page_id = 77")).count() == 0
    import gzip
    import io
    data = gzip.compress(b"a" * 5000) + gzip.compress(b"b" * 10)
    assert b"".join(inflate_stream(io.BytesIO(data), 7)) == b"a" * 5000 + b"b" * 10


# --- line dedup ------------------------------------------------------------------

def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_banded_distance(spark):
    from vireo.llm.line_dedup import characters, within_edits
    rng = random.Random(3)
    pairs = [("", ""), ("", "a"), ("ab", ""), ("\U0001F600a", "\U0001F601a")]
    pairs += [("".join(rng.choices("abé", k=rng.randint(0, 9))), "".join(rng.choices("abé", k=rng.randint(0, 9)))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", characters(F.col("a")).alias("x"), characters(F.col("b")).alias("y"))
    for k in (1, 2, 3):
        for r in df.select("a", "b", within_edits(F.col("x"), F.col("y"), k).alias("d")).collect():
            d = edits(r.a, r.b)
            assert r.d == (d if d <= k else None), (r.a, r.b, k)


def brute_lines(rows, min_chars=20):
    occ = [(d is not None, d, p, raw.strip(" \t\n\x0b\x0c\r")) for d, t in rows if t is not None for p, raw in enumerate(t.split("\n"))]
    first = {}
    for n, d, p, line in occ:
        if len(line) >= min_chars:
            first[line] = min(first.get(line, (n, d, p)), (n, d, p))
    near = {a for a, b in itertools.permutations(first, 2) if abs(len(a) - len(b)) < 2 and first[b] < first[a] and edits(a, b) == 1}
    return {(d, p) for n, d, p, line in occ if line in first and (line in near or (n, d, p) > first[line])}


@pytest.mark.parametrize("max_per_key", [32, 1])
def test_lines(spark, awkward, empty, max_per_key):
    from vireo.llm.line_dedup import dedup_lines
    rng = random.Random(5)
    base = "the quick brown fox jumps over it"
    texts = []
    for i in range(40):
        lines = []
        for _ in range(3):
            s = list(base)
            for _ in range(rng.randint(0, 2)):
                p = rng.randrange(len(s))
                op = rng.random()
                s[p:p + 1] = [] if op < 0.3 else [s[p], "z"] if op < 0.6 else ["q"]
            lines.append("".join(s))
        texts.append((50 + i, "\n".join(lines + ["short", f"  unique line number {i * 7919} of this text "])))
    rows = texts + [(9, "one\ntwo lines of text that are long enough\none"), (3, None), (4, "")]
    gone = brute_lines(rows)
    assert gone
    got = {r.doc_id: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), max_per_key=max_per_key).collect()}
    for d, t in rows:
        kept = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (d, p) not in gone)
        assert got[d].text == kept
        assert got[d].lines_removed == sum(1 for x, _ in gone if x == d)
    out = dedup_lines(awkward)
    assert out.count() == awkward.count() and out.columns == awkward.columns + ["lines_total", "lines_removed"]
    assert out.where("doc_id = 2").select("text").distinct().collect()[0].text == ""
    assert dedup_lines(empty).count() == 0
    again = dedup_lines(out)
    assert again.columns == out.columns and again.agg(F.sum("lines_removed")).first()[0] == 0


def test_crowded_long_lines(spark):
    """Lines that share a half: compared by their groups, verified, and in time linear in their length."""
    import time

    from vireo.llm.line_dedup import dedup_lines
    took = {}
    for n in (1_000, 16_000):
        rng = random.Random(n)
        half = "".join(rng.choices("abcdef ", k=n // 2)) + "x"
        ends = ["".join(rng.choices("abcdef ", k=n // 2)) + "y" for _ in range(20)]
        rows, want = [], set()
        for i, e in enumerate(ends):
            rows.append((i, half + e))
            for j, t in enumerate((e[:5] + "Q" + e[6:], e[:9] + e[10:], e[:7] + "Q" + e[7:], e[:5] + "ZW" + e[7:])):
                rows.append((100 + 10 * i + j, half + t))
                if j < 3:
                    want.add(100 + 10 * i + j)
        at = time.time()
        got = {r.doc_id for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), max_per_key=4).where("lines_removed > 0").collect()}
        took[n] = time.time() - at
        assert got == want
    assert took[16_000] < 16 * took[1_000] + 5


def word_edits(a, b):
    a, b = a.split(), b.split()
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def near_lines(rows, near):
    """Positions that go by a rule ``near`` of two distinct lines."""
    occ = [(d, p, x.strip()) for d, t in rows for p, x in enumerate(t.split("\n")) if len(x.strip()) >= 20]
    first = {}
    for d, p, x in occ:
        first[x] = min(first.get(x, (d, p)), (d, p))
    late = {x for x, y in itertools.permutations(first, 2) if first[y] < first[x] and near(x, y)}
    return {(d, p) for d, p, x in occ if x in late or (d, p) > first[x]}


def check_kept(got, rows, gone):
    for d, t in rows:
        assert got[d] == "\n".join(x for p, x in enumerate(t.split("\n")) if (d, p) not in gone)


@pytest.mark.parametrize("threshold,max_per_key", [(2, 32), (3, 2)])
def test_lines_more_edits(spark, threshold, max_per_key):
    from vireo.llm.line_dedup import dedup_lines
    rng = random.Random(8)
    rows = []
    for i in range(60):
        s = list(rng.choice(["the quick brown fox jumps over it", "seven lazy dogs sleep all day long"]))
        for _ in range(rng.randint(0, 5)):
            p = rng.randrange(len(s))
            s[p:p + 1] = rng.choice([[], [s[p], "z"], ["q"]])
        rows.append((i, "".join(s) + "\nshort"))
    gone = near_lines(rows, lambda x, y: edits(x, y) <= threshold)
    assert gone > near_lines(rows, lambda x, y: edits(x, y) <= 1)
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold, max_per_key=max_per_key).collect()
    check_kept({r.doc_id: r.text for r in got}, rows, gone)


def test_lines_one_word(spark):
    import corpus_pipeline as P
    rng = random.Random(3)
    rows = []
    for i in range(80):
        w = rng.choice(["page printed on 3 March 2021 by the editors of this site", "all rights reserved by the owner of this page"]).split()
        for _ in range(rng.randint(0, 3)):
            p = rng.randrange(len(w))
            w[p:p + 1] = rng.choice([[], [w[p], "additionally"], ["replacement"], ["17"]])
        rows.append((i, " ".join(w) + f"\nno other line is like number {i} {i * 7} {i * 11}\ninternational communication{i}"))
    gone = near_lines(rows, lambda x, y: edits(x, y) <= 1 or min(len(x.split()), len(y.split())) >= 6 and word_edits(x, y))
    assert len(gone) > len(near_lines(rows, lambda x, y: edits(x, y) <= 1))
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    check_kept({r.doc_id: r.text for r in P.line_dedup(spark, docs, SF).collect()}, rows, gone)


# --- n-gram join -------------------------------------------------------------------

def shingle_set(t):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_links(rows):
    sets = [shingle_set(t) for _, t in rows]
    links = defaultdict(set)
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            links[i].add(j)
            links[j].add(i)
    return sets, links


def smallest_reachable(rows, links):
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append(min(ids) if ids else None)
    return out


@pytest.mark.parametrize("block", [1024, 4])
def test_ngram_links(spark, awkward, empty, block):
    from vireo.llm.ngram_join import ngram_links, representatives
    rng = random.Random(7)
    vocab = [f"v{i}" for i in range(400)]
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    for f in range(6):
        base = rng.choices(vocab, k=rng.choice([3, 12, 60, 140]))
        for i in range(14):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((1000 + 100 * f + i, " ".join(w).upper() if i % 5 == 0 else " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets, links = brute_links(rows)
    want = Counter(zip([d for d, _ in rows], map(len, sets), smallest_reachable(rows, links), [len(links[i]) for i in range(len(rows))]))
    got = ngram_links(df, block_sets=block, batch_chars=20_000)
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got.collect()) == want
    if block == 4:
        assert ngram_links(empty).count() == 0
        kept = representatives(awkward)
        assert kept.columns == awkward.columns and {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, None, 6, 8, 9} and kept.where("doc_id = 1").count() == 1


def test_trie_against_all_pairs():
    from vireo.llm.ngram_join import trie_links
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(60)]
    for s in list(sets[:20]):
        sets.append(np.unique(np.append(s[2:], [5, 99])).astype(np.uint64))
    got = trie_links(sets, sets)
    for i, j in itertools.product(range(len(sets)), repeat=2):
        both = len(np.intersect1d(sets[i], sets[j]))
        assert got[i, j] == (100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both))


# --- substring dedup ---------------------------------------------------------------

def test_repeats(spark, awkward, empty):
    from vireo.llm.substring_dedup import remove_repeats
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(30)]
    passage = rng.choices(vocab, k=12)
    rows = [(r.doc_id, r.text) for r in awkward.where("doc_id <> 6").select("doc_id", "text").collect()]
    for i in range(40):
        w = rng.choices(vocab, k=rng.randint(0, 30))
        if i % 3 == 0:
            w[rng.randint(0, len(w)):0] = passage[rng.randint(0, 3):]
        rows.append((100 + i, " ".join(w)))
    rows.append((500, "loop " * 30))
    window = 7
    seen = Counter(tuple(w[i:i + window]) for _, t in rows for w in [words(t)] for i in range(len(w) - window + 1))
    want = Counter()
    for d, t in rows:
        w = words(t)
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for k in range(window)}
        want[(d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for chars in (8_000_000, 200):
        got = remove_repeats(df, window=window, block=4, batch_chars=chars).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
    assert remove_repeats(empty).count() == 0
    assert remove_repeats(awkward).count() == awkward.count()


# --- embeddings --------------------------------------------------------------------

@pytest.mark.parametrize("block", [2048, 5])
def test_near_vectors(spark, block):
    from vireo.llm.embedding_dedup import near_dedup, near_vectors
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for _ in range(12):
        c = rng.standard_normal(8)
        for _ in range(9):
            rows.append((n, [float(x) for x in c + 0.25 * rng.standard_normal(8)]))
            n += 1
    rows += [(n, rows[0][1]), (n + 1, [2 * x for x in rows[0][1]]), (n + 2, None), (n + 3, [0.0] * 8), (n + 4, [float("nan")] * 8),
             (n + 5, [1.0] * 7 + [None]), (n + 6, [float("inf")] + [0.0] * 7), (n + 7, []), (None, rows[1][1]), (0, rows[0][1]), (n + 8, [1.0, 2.0]), (n + 9, [1.0, 2.0])]

    def unit(v):
        if v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v)
        return v / np.linalg.norm(v)

    u = [unit(v) for _, v in rows]
    links = defaultdict(set)
    for i, j in itertools.combinations(range(len(rows)), 2):
        if u[i] is not None and u[j] is not None and len(u[i]) == len(u[j]) and u[i] @ u[j] >= 0.95:
            links[i].add(j)
            links[j].add(i)
    low = smallest_reachable(rows, links)
    want = Counter((d, len(links[i]), low[i] if links[i] else d, d == (low[i] if links[i] else d)) for i, (d, _) in enumerate(rows))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(0)).withColumn("cell", F.lit(0))
    got = near_vectors(df, block_rows=block, per_cell=10, margin=None).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want
    assert near_vectors(df.where("vec_id = -1")).count() == 0
    if block == 5:
        assert near_dedup(df).columns == df.columns


def test_near_vectors_recall(spark):
    from vireo.llm.embedding_dedup import near_vectors
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = near_vectors(df, per_cell=25).collect()
    e = {r.vec_id: np.array(r.embedding, dtype=float) for r in df.collect() if r.embedding is not None}
    u = np.array([v / np.linalg.norm(v) for v in e.values()])
    hit = u @ u.T >= 0.95
    np.fill_diagonal(hit, False)
    assert sum(r.n_links for r in rows) >= 0.99 * hit.sum()


@pytest.mark.parametrize("block", [16_384, 300])
def test_near_vectors_hot_group(spark, block):
    """By default no link is lost at a border: a large group of near copies cut by
    many cells, and vectors that differ along one line only."""
    from vireo.llm.embedding_dedup import near_vectors
    rng = np.random.default_rng(9)
    hot = rng.standard_normal(64) + 0.2 * rng.standard_normal((900, 64))
    flat = np.zeros((300, 64))
    angle = rng.uniform(0, 2 * np.pi, 300)
    flat[:, 0], flat[:, 1] = np.cos(angle), np.sin(angle)
    e = np.concatenate([hot, flat, rng.standard_normal((200, 64))])
    u = e / np.linalg.norm(e, axis=1)[:, None]
    hit = u @ u.T >= 0.95
    np.fill_diagonal(hit, False)
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(e)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in near_vectors(df, per_cell=40, block_rows=block).collect()}
    assert got == dict(enumerate(hit.sum(axis=1)))


# --- components ----------------------------------------------------------------------

def test_components(spark):
    from vireo.llm.common import components
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300), (300, 100), (7, 7), (None, 1)] + [(500, i) for i in range(501, 540)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in (100, 200, 300)}, **{i: 500 for i in range(500, 540)}}


# --- trained models --------------------------------------------------------------------

def test_language_held_out(spark, awkward, empty):
    from vireo.llm.langid_gru import identify_languages
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r.held_out and r.lang is not None]
    assert len(rows) == docs.count() and len(out) > 100
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.93
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    odd = identify_languages(awkward).collect()
    assert len(odd) == awkward.count()
    assert {r.lang_pred for r in odd if r.doc_id in (3, 4, 5)} == {"und"} and {r.lang_pred for r in odd if r.doc_id == 8} != {"und"}
    assert identify_languages(empty).count() == 0


def test_gru_gradients():
    from vireo.llm.langid_gru import ByteGRU
    rng = np.random.default_rng(0)
    net = ByteGRU(3, 4)
    for name in ("x", "u", "o", "c"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    w, y, weight = rng.integers(0, 256, (5, 6)).astype(np.uint8), rng.integers(0, 3, 5), np.ones((6, 5))
    _, grads = net.gradients(w, y, weight)
    for p, g in zip(net.params(), grads):
        flat = np.argsort(-np.abs(g).ravel())[:4]
        for k in flat:
            at = np.unravel_index(k, p.shape)
            old, e = p[at], 1e-3
            p[at] = old + e
            up = net.gradients(w, y, weight)[0]
            p[at] = old - e
            down = net.gradients(w, y, weight)[0]
            p[at] = old
            assert (up - down) / (2 * e) == pytest.approx(g[at], rel=0.02, abs=1e-4)


def test_forward_backward_by_enumeration():
    from vireo.llm.quality_crf import forward_backward
    rng = np.random.default_rng(1)
    counts = np.array([3, 1, 4])
    score, links = rng.standard_normal(8), rng.standard_normal((2, 2))
    good, total, pair = forward_backward(score, counts, links)
    at, pairs = 0, np.zeros((2, 2))
    for n in counts:
        weight = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            weight[labels] = np.exp(sum(score[at + i] for i in range(n) if labels[i]) + sum(links[a, b] for a, b in zip(labels, labels[1:])))
        z = sum(weight.values())
        for i in range(n):
            assert good[at + i] == pytest.approx(sum(v for k, v in weight.items() if k[i]) / z)
        for k, v in weight.items():
            for a, b in zip(k, k[1:]):
                pairs[a, b] += v / z
        at += n
    assert pair == pytest.approx(pairs)


def test_quality_held_out(spark, awkward, empty):
    from vireo.llm.quality_crf import score_quality
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = score_quality(docs, labels).join(labels, "doc_id", "left").collect()
    out = [r for r in rows if r.held_out and r.quality is not None]
    assert len(rows) == docs.count() and len(out) > 40
    assert sum(r.predicted == r.quality for r in out) / len(out) > 0.9
    odd = score_quality(awkward, labels).collect()
    assert len(odd) == awkward.count() and all(0 <= r.score <= 1 for r in odd)
    assert score_quality(empty, labels).count() == 0
    assert all(r.score == 0.5 for r in score_quality(awkward, labels.where("quality = 1")).collect())


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    docs = documents(spark).unionByName(spark.createDataFrame([(-1, "12 34", "en", "s", 5), (-2, None, None, None, None)], documents(spark).schema))
    columns, before = docs.columns, docs
    for name, f in P.STAGES[:-1]:
        after = P.stage(f(spark, before, SF), "t")
        assert after.columns == columns, name
        if name == "language ID":
            assert {r.doc_id for r in before.select("doc_id").collect()} - {r.doc_id for r in after.select("doc_id").collect()} == {-1, -2}
        if name == "line dedup":
            texts = {r.doc_id: r.text for r in after.collect()}
            for r in before.collect():
                # what stays of a text are lines of it in order; what went whole had no line of its own
                kept = iter((r.text or "").split("\n"))
                assert r.doc_id not in texts or all(line in kept for line in texts[r.doc_id].split("\n"))
            assert all(words(t) for t in texts.values())
        if name == "n-gram Jaccard join":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            _, links = brute_links(rows)
            low = smallest_reachable(rows, links)
            assert sorted(r.doc_id for r in after.collect()) == sorted(d for (d, _), m in zip(rows, low) if d == m)
        before = after
    packed = P.STAGES[-1][1](spark, before, SF)
    assert packed.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
