"""Best-fit packing of tokenised documents into sequences of at most SIZE tokens, by hierarchical residuals.

A document is its ids and END. Longer documents are cut into pieces of SIZE tokens, the first of which
may be shorter. Full pieces are sequences of their own. All others are items, dealt by hash into groups of
about RUN items at most, each with the whole mix of lengths. A group is packed as one by best fit, longest
first, and emits bins with at most SLACK tokens left. The other bins become items of the next round, over a
FAN-th of the groups or as many as RUN asks for, and so on until the groups get no fewer or a round joins
nothing. Memory is bounded by about RUN items a task at every level.

Null and empty texts are the one id END. Equal and repeated rows are documents of their own, told apart by
where they stand in the input. An empty table gives no rows. Other columns are ignored. Ids are those
that tokenizers gives for the vocabulary file, its added tokens included where a text holds them; the file's path
is a parameter and must exist on every executor.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .base import arrow_rows, cut

SIZE, END, RUN, SLACK, FAN = 1024, 2, 200_000, 4, 8
#: The published pattern of this byte-level BPE, with possessive repeats: the same splits, found faster.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

_LOADED: dict = {}


def encoder(path: str):
    """Function from text to ids, those of the byte-level BPE in the tokenizers file ``path``, with its added tokens.

    tiktoken merges the same vocabulary five times faster; that its merges are in the order of their ids is checked.
    """
    if path not in _LOADED:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, before = file["model"], file["pre_tokenizer"] or {}
        vocab = model["vocab"]
        # the format writes bytes as characters: printable ones as themselves, the others in order from 256
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        added = {t["content"]: t["id"] for t in file["added_tokens"]}
        trims = any(t[k] for t in file["added_tokens"] for k in ("lstrip", "rstrip", "single_word"))
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or file["normalizer"] or trims or made != sorted(made):
            raise ValueError("a byte-level BPE with merges in the order of their ids is required")
        ranks = {bytes(map(byte.__getitem__, piece)): i for piece, i in vocab.items() if piece not in added}
        coded = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)
        plainer = Tokenizer.from_file(path)

        def encode(text: str) -> list[int]:
            try:
                return coded.encode(text, allowed_special="all")
            except ValueError:  # its matcher's stack is too small for runs of some 10**6 blanks
                return plainer.encode(text, add_special_tokens=False).ids

        _LOADED[path] = encode
    return _LOADED[path]


def token_pieces(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, item): one row per piece; item numbers the rows, stable under retries."""
    arrow_rows(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "item"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, item = encoder(path), TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text), END], "<u4")
                start, to = 0, (len(ids) - 1) % size + 1
                for piece in range(-(-len(ids) // size)):
                    out.append((doc_id, piece, start, to - start, zlib.crc32(ids[start:to]), item))
                    start, to, item = to, to + size, item + 1
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    spec = "doc_id long, piece long, start long, length long, ids_crc32 long, item long"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, spec)


def best_fit(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, taken in the order given, and the bins' fills. Each goes to the fullest bin that has room."""
    room: list[list[int]] = [[] for _ in range(size + 1)]  # bins by room left
    some: list[int] = []  # the rooms that some bin has, sorted
    bins, offsets, fills = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, n in enumerate(lengths.tolist()):
        k = bisect_left(some, n)
        if k < len(some):
            left = some[k]
            b = room[left].pop()
            if not room[left]:
                del some[k]
        else:
            b, left = len(fills), size
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        left -= n
        if left:
            if not room[left]:
                insort(some, left)
            room[left].append(b)
    return bins, offsets, np.array(fills, np.int64)


def _round(items: DataFrame, level: int, size: int) -> DataFrame:
    """(item, bin, at, fill) of rows (item, length); a partition is one group."""
    arrow_rows(items.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = (level + 1) << 58 | TaskContext.get().partitionId() << 36
        held = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
        if held:
            item, length = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((item, -length))
            item, length = item[order], length[order]
            bins, offsets, fills = best_fit(length, size)
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(bins + number), pa.array(offsets), pa.array(fills[bins])], ["item", "bin", "at", "fill"])

    return items.mapInArrow(run, StructType([StructField(x, LongType()) for x in ("item", "bin", "at", "fill")]))


def place(items: DataFrame, size: int = SIZE) -> DataFrame:
    """(item, sequence_id, offset) of rows (item, length)."""
    spark = items.sparkSession
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-items.count() // RUN))
    rounds, waiting = [], items
    while True:
        packed = cut(_round(waiting.repartition(groups, "item"), len(rounds), size))
        rounds.append(packed.select("item", F.col("bin").alias("sequence_id"), F.col("at").alias("offset")))
        bins = packed.groupBy("bin").agg(F.count("*").alias("n"), F.first("fill").alias("length"))
        is_open = F.col("length") < size - SLACK
        counts = bins.agg(F.sum("n").alias("items"), F.count("*").alias("bins"), F.count_if(is_open).alias("open")).first()
        fewer = max(1, groups // FAN, -(-counts["open"] // RUN))
        if fewer >= groups or (len(rounds) > 1 and counts["items"] == counts["bins"]):
            break
        waiting, groups = bins.filter(is_open).select(F.col("bin").alias("item"), "length"), fewer
    # a bin of one round is an item of the next: from the last round down, each names the sequence that it ends in
    placed = rounds.pop()
    while rounds:
        move = placed.select(F.col("item").alias("sequence_id"), F.col("sequence_id").alias("to"), F.col("offset").alias("by"))
        placed = rounds.pop().join(move, "sequence_id", "left").select("item", F.coalesce("to", "sequence_id").alias("sequence_id"), (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"))
    return placed


def pack_documents(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    pieces = cut(token_pieces(docs, path, size))
    short = pieces.filter(F.col("length") < size).select("item", "length")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    whole = pieces.filter(F.col("length") == size).withColumn("sequence_id", -1 - F.col("item")).withColumn("offset", F.lit(0).cast("long"))
    return pieces.join(place(short, size), "item").select(columns).unionByName(whole.select(columns))
