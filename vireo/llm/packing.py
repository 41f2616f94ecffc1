"""Packing documents into token sequences of a fixed capacity.

Documents are dealt to randomised groups (a hash of id and text).  Inside a
group every document is tokenised and cut at multiples of the capacity; whole
pieces fill a sequence each, and the remaining tails are packed first-fit
decreasing, where a tournament tree over the free space of the bins finds the
first bin that fits in logarithmic time.  Groups are independent, so the only
shuffle is that of the texts to their group, and a group is bounded by its
number of documents, whatever their source.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import batch_plan, ship_package

CAPACITY = 1024
SEPARATOR_ID = 0
#: characters of text per randomised group
GROUP_CHARS = 6_000_000
#: below this code point both tokenizer libraries split text alike (tested
#: over every character); other texts are encoded by ``tokenizers`` itself
PLAIN_LIMIT = 0x250

PIECES = ("doc_id long, piece_start long, length long, ids_le32 binary, doc_tokens long, "
          "sequence_id long, sequence_offset long")


@lru_cache(maxsize=2)
def _encoders(tokenizer_file: str):
    """(``tokenizers`` tokenizer, the same vocabulary as a rank encoder or None)."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(tokenizer_file)
    ranks_file = os.path.splitext(tokenizer_file)[0] + ".tiktoken"
    fast = None
    if os.path.exists(ranks_file):
        import base64

        import public_tokenizers
        import tiktoken
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return full, fast


def encode(text: str | None, tokenizer_file: str) -> np.ndarray:
    """Token ids of a text as unsigned 32-bit; null counts as empty.

    Texts of Latin characters go through the rank encoder, which gives the same
    ids several times faster; texts with other characters, with the written
    form of a special token or that it cannot take go through ``tokenizers``."""
    if not text:
        return np.zeros(0, dtype="<u4")
    full, fast = _encoders(tokenizer_file)
    if fast is not None and "<|" not in text and (text.isascii() or ord(max(text)) < PLAIN_LIMIT):
        try:
            return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
        except ValueError:  # its pattern matcher has a bounded stack: very long runs of white space
            pass
    return np.asarray(full.encode(text, add_special_tokens=False).ids, dtype="<u4")


class FreeSpaceTree:
    """Tournament tree over bins: every inner node holds the largest free
    space below it, so the first bin with enough room is found by descent."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (max(1, bins) - 1).bit_length())
        self.free = [capacity] * (2 * self.leaves)

    def place(self, need: int) -> int:
        """Take ``need`` from the first bin that has it; the bin's number."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < need:
                node += 1
        free[node] -= need
        at, node = node - self.leaves, node // 2
        while node:
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
            node //= 2
        return at


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in it) of each piece; ties in length keep the given order."""
    n = len(lengths)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    tree, used = FreeSpaceTree(n, capacity), [0] * n
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        b = tree.place(need)
        bins[i], offsets[i] = b, used[b]
        used[b] += need
    return bins, offsets


def pack_documents(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, separator: int = SEPARATOR_ID, group_chars: int = GROUP_CHARS) -> DataFrame:
    """Pack every document (its ids, then the separator id) into sequences.

    One row per piece: ``doc_id``, ``piece_start`` (ids of the document before
    the piece), ``length``, ``ids_le32`` (the ids as little-endian unsigned 32
    bit), ``doc_tokens``, ``sequence_id`` (unique over all groups) and
    ``sequence_offset`` (gapless from 0).  A null or empty text gives one piece
    with the separator alone.  Ids may be null or repeat: every row is packed.
    Long texts are cut at multiples of ``capacity``; an empty table gives an
    empty result; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    groups = batch_plan(docs, group_chars, text_col)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        grp = int(frame["grp"].iloc[0])
        # the order inside a group must not depend on the order of arrival
        frame = frame.sort_values(["doc_id", "text"], kind="stable", na_position="first")
        doc, start, ids, total = [], [], [], []
        for d, text in zip(frame["doc_id"].tolist(), frame["text"].tolist()):
            tokens = np.append(encode(text, tokenizer_file), np.array([separator], dtype="<u4")).astype("<u4")
            for s in range(0, len(tokens), capacity):
                doc.append(d)
                start.append(s)
                ids.append(tokens[s:s + capacity].tobytes())
                total.append(len(tokens))
        length = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        bins, offsets = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
        whole = length == capacity
        n_whole = int(whole.sum())
        bins[whole] = np.arange(n_whole)
        b, o = first_fit_decreasing(length[~whole], capacity)
        bins[~whole], offsets[~whole] = b + n_whole, o
        return pd.DataFrame({"doc_id": pd.array([None if pd.isna(x) else int(x) for x in doc], dtype="Int64"),
                             "piece_start": start, "length": length, "ids_le32": ids, "doc_tokens": total,
                             "sequence_id": (grp << 32) + bins, "sequence_offset": offsets})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (rows.withColumn("grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))
            .groupBy("grp").applyInPandas(pack, PIECES))
