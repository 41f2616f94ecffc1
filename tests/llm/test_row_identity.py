"""One row of every group stays, whatever ids repeat; texts that upset an encoder."""
from collections import Counter, defaultdict

import numpy as np

A = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega end"
B = " ".join(f"other{i}" for i in range(30))
DOCS = "doc_id long, text string, source string"
ROWS = [(1, A, "a"), (1, A, "a"), (5, A, "b"), (5, B, "b"), (None, A, "c"), (None, B + " ", "c"), (7, B.upper(), "d"), (8, None, "d"), (8, None, "d"),
        (9, "", "d"), (None, "only null ids here today", "e"), (None, "only null ids here today", "e"), (12, A + " more", "f"), (1, "own text of id one", "f")]


def kept(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_ngram_representatives_keep_every_text_of_its_own(spark):
    from vireo.llm.ngram_join import representatives
    df = spark.createDataFrame(ROWS, DOCS)
    assert kept(representatives(df)) == Counter([(1, A), (5, B), (8, None), (8, None), (9, ""), (None, "only null ids here today"), (1, "own text of id one")])
    assert representatives(df).columns == df.columns and representatives(df.limit(0)).count() == 0


def test_exact_dedup_with_repeated_ids(spark):
    from vireo.llm.exact_dedup import exact_dedup
    rows = [(1, "same text", "a"), (0, "same text", "a"), (1, "longest of its group", "b"), (2, "longest ofits group", "b"), (1, "same  text", "c"), (1, "same  text", "d")]
    got = kept(exact_dedup(spark.createDataFrame(rows, DOCS)))
    assert got == Counter([(1, "same  text"), (1, "longest of its group")])


def test_near_dedup_with_repeated_ids(spark):
    from vireo.llm.embedding_dedup import near_dedup
    rng = np.random.default_rng(0)
    u, v = ([float(x) for x in rng.standard_normal(8)] for _ in range(2))
    rows = [(1, u), (1, u), (5, u), (5, v), (None, v), (None, None), (6, None), (6, None), (3, [2 * x for x in u])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter((r.vec_id, None if r.embedding is None else tuple(r.embedding)) for r in near_dedup(df).collect())
    assert got == Counter([(1, tuple(u)), (5, tuple(v)), (None, None), (6, None), (6, None)])


def test_packing_of_very_long_white_space(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from vireo.llm.packing import pack_documents
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["x" + " " * 1_000_000 + "y", "x" + "\n" * 1_000_000 + "y", "\t " * 400_000, "é" + " " * 300_000]
    full = Tokenizer.from_file(path)
    pieces = defaultdict(list)
    for r in pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect():
        pieces[r.doc_id].append((r.piece_start, bytes(r.ids_le32)))
    for i, t in enumerate(texts):
        assert b"".join(x for _, x in sorted(pieces[i])) == np.array(full.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes()
