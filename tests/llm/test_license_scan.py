"""License scan against a plain search, and the diagonals on edited notices."""
import random
import re

from pyspark.sql import functions as F

from vireo.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(ls.UPPER, ls.LOWER)
DOCS = "doc_id long, text string"


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute_base(t):
    w, out = words(t), []
    for phrase, label in ls.BASE_PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), out


def texts():
    rng = random.Random(5)
    parts = ["CC", "BY", "cc by", "General Public License", "general", "public", "license", "All Rights Reserved", "all", "rights", "reserved",
             "café", "Kelvin", "ÀB", "1", "\n", ", ", "-", "cc-by-nc", "MIT License", "x_y"]
    out = ["", None, " \t\n", "...", "cc by cc by cc by", "CC\x00BY", "cc  by", " cc by", "cc by ", "all rights reservedall rights reserved",
           "general public public license", "cc", "by", "a" * 5000, "word " * 100_000 + "All rights reserved."]
    return out + ["".join(rng.choice(parts) + rng.choice([" ", " ", "", ". "]) for _ in range(rng.randint(1, 40))) for _ in range(300)]


def test_base_places_words_and_awkward_rows(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "cc by me"), (None, None), (4, "cc by cc by cc by"), (4, "other text, general public license")]
    df = spark.createDataFrame(rows, DOCS)
    for c in ("template", "label", "w", "id", "diagonal", "n_words", "key", "text_hash", "span"):
        df = df.withColumn(c, F.lit("extra"))
    want = []
    for d, t in rows:
        n, places = brute_base(t)
        at = [p for p, _ in places]
        want.append((d, n, len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    got = ls.scan_licenses(df).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert (r.score > 0) == (r.labels != "")


def test_edited_notices_are_found_on_neighbouring_diagonals(spark):
    rng = random.Random(2)
    filler = [f"w{i}" for i in range(50)]
    rows, want = [], {}
    for i, (notice, label) in enumerate(ls.NOTICES):
        w = notice.split()
        before, after = rng.choices(filler, k=rng.randint(0, 30)), rng.choices(filler, k=5)
        rows.append((10 * i, " ".join(before + w + after).upper()))
        want[10 * i] = (label, len(before), 1.0)
        if len(w) >= 15:
            inserted = w[:8] + ["inserted"] + w[8:]
            rows.append((10 * i + 1, " ".join(before + inserted + after)))
            want[10 * i + 1] = (label, len(before), 1.0)
            left_out = w[:6] + w[7:]
            rows.append((10 * i + 2, " ".join(before + left_out + after)))
            want[10 * i + 2] = (label, len(before), 0.8)
            shuffled = w[:]
            rng.shuffle(shuffled)
            rows.append((10 * i + 3, " ".join(shuffled)))
            rows.append((10 * i + 4, " ".join(w[: len(w) // 2])))
    spans = ls.license_spans(spark.createDataFrame(rows, DOCS)).where("NOT base").collect()
    found = {}
    for r in spans:
        found.setdefault(r.doc_id, {})[(r.label, r.start)] = r.coverage
    for d, (label, start, least) in want.items():
        assert found[d].get((label, start), 0) >= least, (d, label, found.get(d))
    whole = {10 * i + 4: n.split() for i, (n, _) in enumerate(ls.NOTICES) if len(n.split()) >= 15}
    for d, w in whole.items():
        assert all(c >= 0.8 for c in found.get(d, {}).values())
        half = " ".join(w[: len(w) // 2])
        assert set(x for x, _ in found.get(d, {})) <= {label for n, label in ls.NOTICES if n in half}


def test_empty_table(spark):
    assert ls.scan_licenses(spark.createDataFrame([], DOCS)).count() == 0
