"""Line dedup across documents: a segment-partition edit join (DataFrame operations only).

Equal lines are found by grouping a 128-bit hash.  Lines within one edit are
found by partition: a line of n characters is split into threshold + 1 segments,
and of two lines within the threshold at least one segment of the shorter occurs
unchanged in the longer, shifted by no more than the edits allow.  Each line
puts its segments into an index by (length, segment number, text) and probes the
indexes of its own and the next smaller lengths with the substrings that can
match.  Index entries and probes with only one distinct line drop out in a
pre-aggregated count.  Candidate pairs are verified by banded bit-parallel edit
distance.

An index entry that more than ``max_per_key`` lines share isn't
joined with itself: its lines agree but for the rest beside the shared
segment, so they are grouped by that rest with each one position
left out.  Lines in such a group are within one edit of each other, so the
earliest of them, one pre-aggregated minimum, is the only candidate a line needs;
the pair is verified like any other.  Time is linear in the lines and in
their lengths.  Above threshold 1 such entries are joined with themselves in blocks.

On request, lines within one word of each other go too, whatever the word's
length: the same partition and the same groups with words in place of characters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import SPACE_CHARS, stage

THRESHOLD = 1
MIN_CHARS = 20
MAX_PER_KEY = 32
#: lines of fewer words are not compared by words: one word of them is too much of the line
MIN_WORDS = 6
#: lines of a crowded index entry joined with the others at once, above threshold 1
BLOCK_LINES = 1024


def within_edits(a: Column, b: Column, threshold: int) -> Column:
    """Edit distance of two arrays of characters, null above ``threshold``.

    Banded and bit-parallel: bit d of mask e says that the first j characters of
    ``a`` match the first j + d - threshold of ``b`` with at most e edits; a step
    over one character of ``a`` moves the whole band by shifts."""
    band = 2 * threshold + 1
    full = (1 << band) - 1
    names = [f"r{e}" for e in range(threshold + 1)]
    # before the first character: up to e characters of b inserted
    start = [sum(1 << (threshold + i) for i in range(e + 1)) for e in range(threshold + 1)]

    def step(state, j):
        ch = F.get(a, j - 1)
        same = [F.when(F.get(b, j + (d - threshold - 1)) == ch, 1 << d).otherwise(0) for d in range(band)]
        eq = reduce(lambda x, y: x.bitwiseOR(y), same)
        now = [state["r0"].bitwiseAND(eq)]
        for e in range(1, threshold + 1):
            old = state[f"r{e - 1}"]
            moved = (state[f"r{e}"].bitwiseAND(eq).bitwiseOR(old).bitwiseOR(F.shiftright(old, 1))
                     .bitwiseOR(F.shiftleft(now[e - 1], 1)))
            now.append(moved.bitwiseAND(F.lit(full)))
        return F.struct(*[x.alias(n) for x, n in zip(now, names)])

    apart = F.size(b) - F.size(a) + threshold

    def read(state):
        out = F.lit(None).cast("int")
        for e in reversed(range(threshold + 1)):
            out = F.when(F.getbit(state[f"r{e}"].cast("long"), apart) == 1, e).otherwise(out)
        return out

    initial = F.struct(*[F.lit(m).alias(n) for m, n in zip(start, names)])
    found = F.aggregate(F.sequence(F.lit(1), F.size(a)), initial, step, read)
    return (F.when(F.abs(F.size(a) - F.size(b)) > threshold, F.lit(None).cast("int"))
            .when(F.size(a) == 0, F.size(b)).otherwise(found))


def characters(line: Column) -> Column:
    """The code points of a string, as an array."""
    return F.regexp_extract_all(line, F.lit("(?s)(.)"), F.lit(1))


def _cut(length: Column, i: int, threshold: int) -> Column:
    """Where segment i (from 0) of a line of this length starts, from 0."""
    return F.floor(length * i / (threshold + 1)).cast("int")


def segment_keys(line: Column, n: Column, threshold: int) -> Column:
    """Array of (key, probe): a line's own segments and the substrings that can
    equal a segment of a line ``gap`` characters shorter."""
    out = []
    for gap in range(threshold + 1):
        length = n - gap
        for i in range(threshold + 1):
            at, size = _cut(length, i, threshold), _cut(length, i + 1, threshold) - _cut(length, i, threshold)
            low, high = max(-i, gap - (threshold - i)), min(i, gap + (threshold - i))
            for shift in range(low, high + 1):
                text = line.substr(at + shift + 1, size)
                out.append(F.struct(F.xxhash64(F.lit(i), length, text).alias("key"),
                                    F.lit(gap * (threshold + 1) + i).cast("short").alias("role")))
    return F.array(*out)


def words(line: Column) -> Column:
    return F.split(line, "[ \\t\\n\\x0B\\f\\r]+")


def word_keys(word: Column, min_words: int) -> Column:
    """Array of (key, role): a line's own halves (0, 1) and the words that can
    equal a half of a line one word shorter (2, 3); empty under ``min_words``."""
    n = F.size(word)

    def keys(length, skip, role):
        half = F.floor(length / 2).cast("int")
        texts = [F.slice(word, 1, half), F.slice(word, half + 1 + skip, n)]
        return F.array(*[F.struct(F.xxhash64(F.lit("w"), F.lit(i), length, F.array_join(t, " ")).alias("key"),
                                  F.lit(role + i).cast("short").alias("role")) for i, t in enumerate(texts)])

    none = F.expr("array()").cast("array<struct<key:bigint,role:smallint>>")
    return F.when(n > min_words, F.concat(keys(n, 0, 0), keys(n - 1, 1, 2))).when(n == min_words, keys(n, 0, 0)).otherwise(none)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(rk, doc_id, pos, line, n, h1, h2) of every line long enough; rk names the row."""
    rows = docs.select("rk", "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    rows = rows.select("rk", "doc_id", "pos", F.btrim("raw", F.lit(SPACE_CHARS)).alias("line"))
    return (rows.withColumn("n", F.length("line")).where(F.col("n") >= min_chars)
            .withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line")))


def _one_out(met: DataFrame) -> DataFrame:
    """(h1, h2, place, group, longer): the groups of every line of a shared entry.

    met: (key, role, h1, h2, place, own, items), ``items`` what stands beside the
    shared half.  Lines of equal length that agree but for one item meet in a
    group, and a line meets the longer ones that become it when one item goes.
    The items of a line with one left out are hashed as the exclusive or of
    hashes of (place, item): from running totals over the line, so a line takes
    time in proportion to its length."""
    # dealt out before the lines are taken apart, so that what the windows sort isn't shuffled again
    line = ["key", "role", "h1", "h2"]
    parts = (met.repartition(*line).select(*line, "place", "own", F.posexplode("items").alias("j", "x"))
             .withColumn("here", F.xxhash64("j", "x")).withColumn("left", F.xxhash64(F.col("j") - 1, F.col("x"))))
    whole = Window.partitionBy(*line)
    before = whole.orderBy("j").rowsBetween(Window.unboundedPreceding, -1)

    def xor(c, w):
        return F.coalesce(F.bit_xor(c).over(w), F.lit(0).cast("long"))

    run = parts.select("*", xor("here", before).alias("h_before"), xor("left", before).alias("l_before"),
                       xor("here", whole).alias("h_all"), xor("left", whole).alias("l_all"))
    after = F.col("l_all").bitwiseXOR(F.col("l_before")).bitwiseXOR(F.col("left"))
    replaced = F.xxhash64(F.lit("s"), "key", "j", F.col("h_all").bitwiseXOR(F.col("here")))
    taken_out = F.xxhash64(F.lit("d"), F.col("key"), F.col("h_before").bitwiseXOR(after))
    itself = F.xxhash64(F.lit("d"), "key", "h_all")
    groups = F.when(F.col("own") & (F.col("j") == 0), F.array(replaced, itself)).when(F.col("own"), F.array(replaced)).otherwise(F.array(taken_out))
    return run.select("h1", "h2", "place", (~F.col("own")).alias("longer"), F.explode(groups).alias("group"))


def _earlier_partners(met: DataFrame) -> DataFrame:
    """Pairs (h1, h2, p1, p2): lines of shared entries and the earliest line that
    meets them in a group, to be verified."""
    rows = _one_out(met)
    me = F.struct("place", "h1", "h2")
    groups = (rows.groupBy("group").agg(F.min(me).alias("first"), F.max("place").alias("last"),
                                        F.min(F.when(~F.col("longer"), me)).alias("first_short"))
              .where("first.place < last AND first_short IS NOT NULL"))
    # in an insertion group the longer lines are linked to the shorter one, not to each other
    partner = F.when(F.col("longer"), F.col("first_short")).otherwise(F.col("first"))
    met = rows.join(groups, "group").select("h1", "h2", "place", partner.alias("p")).where("p.place < place")
    return met.select("h1", "h2", F.col("p.h1").alias("p1"), F.col("p.h2").alias("p2")).distinct()


def _beside_half(role: Column, items: Column) -> Column:
    """The items beside the half that a line shares under a key of this role
    (0, 1: its own halves; 2, 3: those of lines one item shorter)."""
    half = F.floor((F.size(items) - F.when(role >= 2, 1).otherwise(0)) / 2).cast("int")
    return (F.when(role.isin(0, 2), F.slice(items, half + 1, F.size(items))).when(role == 1, F.slice(items, F.lit(1), half))
            .otherwise(F.slice(items, F.lit(1), half + 1)))


def _met(keyed: DataFrame, threshold: int) -> DataFrame:
    """The rows (h1, key, role) of live entries: two distinct lines meet there, one of them as index."""
    # joins with a side that grows are sort-merge at every size, never broadcast
    live = (keyed.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"), F.min("role").alias("r"))
            .where((F.col("lo") != F.col("hi")) & (F.col("r") <= threshold)).select("key"))
    return keyed.join(live.hint("merge"), "key").distinct()


def dropped_lines(docs: DataFrame, threshold: int, min_chars: int, max_per_key: int, min_words: int | None = None) -> DataFrame:
    """(rk, drop): positions of the lines that go, for rows that lose any.
    ``docs`` has (rk, doc_id, text, ...)."""
    # the texts are split and hashed once; what follows reads a few columns of this table
    lines = _lines(docs.select("rk", "doc_id", "text"), min_chars)
    by_word = [] if min_words is None else [word_keys(words(F.col("line")), min_words).alias("word_keys")]
    lines = stage(lines.select("rk", "doc_id", "pos", "h1", "h2", segment_keys(F.col("line"), F.col("n"), threshold).alias("keys"), *by_word), "lines")
    place = F.struct(F.col("doc_id"), F.col("pos"), F.col("rk"))
    classes = stage(lines.groupBy("h1", "h2").agg(F.min(place).alias("place"), F.count("*").alias("n")), "line_classes")

    def keyed(column):
        return lines.select("h1", F.explode(column).alias("k")).select(
            "h1", F.col("k.key").alias("key"), F.col("k.role").alias("role"))

    met = stage(_met(keyed("keys"), threshold), "line_keys")
    sizes = met.groupBy("key").agg(F.count("*").alias("size"))
    small = met.join(sizes.where(F.col("size") <= max_per_key).select("key"), "key")
    hot = met.join(sizes.where(F.col("size") > max_per_key).select("key"), "key")
    a = small.where(F.col("role") <= threshold).select("key", F.col("h1").alias("a"))
    b = small.select("key", F.col("h1").alias("b"), (F.col("role") > threshold).alias("longer"))
    joined = a.join(b, "key")
    if threshold > 1:  # crowded entries: the lines of a block with all others, a block a key
        cuts = sizes.where(F.col("size") > max_per_key).select("key", F.ceil(F.col("size") / BLOCK_LINES).cast("int").alias("cuts"))
        split = hot.join(cuts.hint("merge"), "key")
        a = split.where(F.col("role") <= threshold).select("key", F.pmod(F.xxhash64("h1"), F.col("cuts")).cast("int").alias("block"), F.col("h1").alias("a"))
        b = split.select("key", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("block"), F.col("h1").alias("b"),
                         (F.col("role") > threshold).alias("longer"))
        joined = joined.unionByName(a.join(b.hint("merge"), ["key", "block"]).drop("block"))
        hot = hot.limit(0)
    pairs = stage(joined.where((F.col("longer") & (F.col("a") != F.col("b"))) | (F.col("a") < F.col("b")))
                  .select("a", "b").distinct(), "line_pairs")
    hot = stage(hot, "hot_lines")
    met_words = None if min_words is None else stage(_met(keyed("word_keys"), 1), "word_lines")

    # the texts of the lines concerned, read where each occurs first
    wanted = (pairs.select(F.col("a").alias("h")).unionByName(pairs.select(F.col("b").alias("h")))
              .unionByName(hot.select(F.col("h1").alias("h"))))
    wanted = (wanted if met_words is None else wanted.unionByName(met_words.select(F.col("h1").alias("h")))).distinct()
    at = (classes.join(wanted, F.col("h1") == F.col("h")).select("h1", "h2", "place", F.col("place.rk").alias("w"), F.col("place.pos").alias("pos"))
          .groupBy("w").agg(F.collect_list(F.struct("h1", "h2", "place", "pos")).alias("at")))
    texts = (docs.select("rk", "text").join(at.hint("merge"), F.col("rk") == F.col("w"))
             .select(F.split("text", "\n").alias("all"), F.explode("at").alias("x"))
             .select("x.h1", "x.h2", "x.place", F.btrim(F.get("all", F.col("x.pos")), F.lit(SPACE_CHARS)).alias("line")).distinct())
    # the characters are written out, so that a step of the verification reads one by its place
    texts = stage(texts.withColumn("chars", characters(F.col("line"))), "line_texts")

    def side(c):
        return texts.select(F.col("h1").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("h2", "place", "chars")])

    verified = (pairs.join(side("a"), "a").join(side("b"), "b")
                .where(within_edits(F.col("chars_a"), F.col("chars_b"), threshold) >= 1))
    later = F.col("place_a") > F.col("place_b")
    losers = verified.select(F.when(later, F.col("a")).otherwise(F.col("b")).alias("h1"),
                             F.when(later, F.col("h2_a")).otherwise(F.col("h2_b")).alias("h2"))

    def verified_losers(entries, items, role_bound):
        """Lines of shared entries that are within one item of their earliest partner."""
        own = entries.join(texts, "h1").withColumn("items", items)
        met = own.select("key", "role", "h1", "h2", "place", (F.col("role") < role_bound).alias("own"), _beside_half(F.col("role"), F.col("items")).alias("items"))
        other = texts.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), items.alias("other"))
        # written, so that the shuffles of the search are gone before the next one begins
        pairs = stage(_earlier_partners(met), "line_partners").join(texts.withColumn("items", items).select("h1", "h2", "items"), ["h1", "h2"]).join(other, ["p1", "p2"])
        return pairs.where(within_edits(F.col("items"), F.col("other"), 1) <= 1).select("h1", "h2")

    if threshold == 1:
        losers = losers.unionByName(verified_losers(hot, F.col("chars"), 2))
    if met_words is not None:
        losers = losers.unionByName(verified_losers(met_words, words(F.col("line")), 2))
    losers = stage(losers.distinct(), "line_losers").withColumn("near", F.lit(True))

    # a line goes where it isn't the first of its class, or its class has an earlier near line
    status = (classes.join(losers, ["h1", "h2"], "left").where("n > 1 OR near")
              .select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "place", F.coalesce("near", F.lit(False)).alias("near")))
    gone = (lines.select("rk", "doc_id", "pos", "h1", "h2").join(status.hint("merge"), (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")))
            .where(F.col("near") | (F.struct("doc_id", "pos", "rk") > F.col("place"))))
    return gone.groupBy("rk").agg(F.collect_set("pos").alias("drop"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
                min_chars: int = MIN_CHARS, max_per_key: int = MAX_PER_KEY, min_words: int | None = None) -> DataFrame:
    """``docs`` with every column, the text without its repeated lines, and
    ``lines_total`` and ``lines_removed`` (long).

    Lines are cut at line feeds and compared without ASCII white space at their
    ends.  A line goes if an equal one, or a distinct one within ``threshold``
    edits whose first occurrence is earlier, stands before it, by document id (null
    first), then line number.  With ``min_words``, so does a line of that many words
    or more for which such a line, with one word replaced, added or left out, is earlier;
    white space between words doesn't count there.  Lines under ``min_chars`` characters always stay.
    Null text stays null with 0 lines; an empty text is one empty line; a
    document may be left with an empty text but never goes.  Rows that repeat an
    id and its text share one place, so each keeps what the first keeps.  Columns
    of the table named ``lines_total`` or ``lines_removed`` are replaced.  An
    empty table gives an empty result.
    """
    if threshold < 1 or min_chars <= threshold or (min_words is not None and min_words < 2):
        raise ValueError("at least one edit, more characters than edits, and two words")
    rows = docs.withColumn("__rk", F.xxhash64(F.col(id_col), F.col(text_col)))
    plain = rows.select(F.col("__rk").alias("rk"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    drops = dropped_lines(plain, threshold, min_chars, max_per_key, min_words).select(F.col("rk").alias("__rk2"), F.col("drop").alias("__drop"))
    rows = rows.join(drops.hint("merge"), F.col("__rk") == F.col("__rk2"), "left")
    split = F.split(F.col(text_col), "\n")
    stay = F.filter(split, lambda line, i: ~F.array_contains(F.col("__drop"), i))
    text = F.when(F.col("__drop").isNull(), F.col(text_col)).otherwise(F.array_join(stay, "\n"))
    total = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(split)).cast("long")
    removed = F.coalesce(F.size("__drop"), F.lit(0)).cast("long")
    out = rows.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in ("lines_total", "lines_removed")],
                      total.alias("__total"), F.when(F.col("__drop").isNull(), F.lit(0).cast("long")).otherwise(removed).alias("__removed"))
    return out.withColumnsRenamed({"__total": "lines_total", "__removed": "lines_removed"})
