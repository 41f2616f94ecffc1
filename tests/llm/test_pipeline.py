"""The whole pipeline on a planted corpus against brute force, stage by stage."""
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_operators import brute_links, brute_targets, edits, near_lines, smallest_reachable, word_edits, words

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def near(x, y):
    return edits(x, y) <= 1 or min(len(x.split()), len(y.split())) >= 6 and word_edits(x, y)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    vocab = {"en": ["the", "house", "green", "river", "walks", "slowly", "under", "bridge"], "de": ["das", "haus", "grün", "fluss", "geht", "langsam", "unter", "brücke"]}
    rows = []

    def line(lang, n):
        return " ".join(rng.choice(vocab[lang]) + str(rng.randrange(60)) for _ in range(n))

    for i in range(36):
        lang = ("en", "de")[i % 2]
        text = "\n".join(line(lang, rng.randint(6, 16)) for _ in range(rng.randint(2, 4)))
        rows.append([i, text, lang, "abc"[i % 3]])
    common = "please accept the cookies of this web site before reading on"
    for i in range(6):  # boilerplate, once with another word
        rows.append([100 + i, line("en", 12) + "\n" + (common if i != 3 else common.replace("reading", "going")), "en", "a"])
    rows.append([200, common, "en", "b"])                      # nothing of its own: goes
    rows.append([201, "12 34 !!", "en", "b"])                  # no letter: goes
    rows.append([202, None, None, "b"])
    rows.append([203, "", "en", None])
    # one line so that line dedup sees two distinct lines while the sets of shingles are close
    base = [rng.choice(vocab["en"]) + str(i) for i in range(160)]
    for i in range(3):
        w = base[:]
        w[10 * i + 5], w[10 * i + 6] = f"other{i}", f"word{i}"
        rows.append([300 + i, " ".join(w), "en", "c"])
    rows.append([301, line("en", 40), "en", "c"])              # an id twice, with a text of its own
    rows.append([301, rows[-1][1], "en", "c"])
    return [(*r, len(r[1] or "")) for r in rows]


def test_every_stage_against_brute_force(spark, corpus):
    docs = spark.createDataFrame(corpus, SCHEMA)
    stages = dict(P.STAGES)

    def run(name, before):
        return P.stage(stages[name](spark, before, ""), "t")

    def pairs(df):
        return [(r.doc_id, r.text) for r in df.orderBy("doc_id", "text").collect()]

    a = run("language ID", docs)
    assert Counter(pairs(a)) == Counter((d, t) for d, t, *_ in corpus if d not in (201, 202, 203))

    b = run("line dedup", a)
    rows = sorted({(d, t) for d, t in pairs(a)})
    gone = near_lines(rows, near)
    # rows with one id and text share their places, so each keeps what the first keeps
    want = Counter()
    for d, t in pairs(a):
        kept = "\n".join(x for p, x in enumerate(t.split("\n")) if (d, p) not in gone or d == 301)
        if words(kept):
            want[d, kept] += 1
    assert Counter(x for x in pairs(b) if x[0] != 301) == Counter({k: v for k, v in want.items() if k[0] != 301})
    assert 200 not in {d for d, _ in pairs(b)}
    assert all(r.n_chars == len(r.text) for r in b.collect())

    c = run("n-gram Jaccard join", b)
    rows = pairs(b)
    _, links = brute_links(rows)
    low, seen, keep = smallest_reachable(rows, links), set(), Counter()
    for (d, t), m in sorted(zip(rows, low)):
        if m not in seen or not any(links[i] for i, x in enumerate(rows) if x == (d, t)):
            keep[d, t] += 1
        seen.add(m)
    assert {d for d, _ in pairs(c)} == {d for d, _ in keep} and 300 in {d for d, _ in pairs(c)} and 302 not in {d for d, _ in pairs(c)}

    e = run("mixing sources to target weights", c)
    sizes, taken, copies = Counter(), Counter(), Counter()
    for r in c.collect():
        sizes[r.source] += len(words(r.text))
    for r in e.collect():
        taken[r.source] += len(words(r.text))
        copies[r.doc_id, r.text] += 1
    target = brute_targets(dict(sizes))
    largest = max(len(words(t)) for _, t in pairs(c))
    assert max(copies.values()) <= 2 and set(copies) <= set(pairs(c))
    assert all(abs(taken[s] - target[s]) <= largest for s in target)

    packed = P.STAGES[-1][1](spark, e, "").collect()
    import public_tokenizers
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = Counter(len(full.encode(t, add_special_tokens=False).ids) + 1 for _, t in pairs(e))
    by_doc = defaultdict(int)
    for r in packed:
        by_doc[r.doc_id] += r.length
    want = defaultdict(int)
    for d, t in pairs(e):
        want[d] += len(full.encode(t, add_special_tokens=False).ids) + 1
    assert by_doc == want and sum(tokens.values()) == len(pairs(e))
    fill = Counter()
    for r in packed:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024 and np.mean(list(fill.values())) > 500


def test_run_composes_the_stages(spark, corpus, tmp_path):
    spark.createDataFrame(corpus, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    out = P.run(spark, str(tmp_path))
    assert out.count() > 0 and len(list(itertools.islice(out.columns, 3))) == 3
