"""Shared helpers: table access, lineage cuts, regular-expression spans and byte-level word hashing."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch handed to Python; texts may be long, so batches stay small.
BATCH_ROWS = 512
#: Elements of an array, and code points of a text, that are handled as one block in expressions.
BLOCK, PAGE = 256, 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_rows(spark: SparkSession) -> None:
    """Keeps Arrow batches at BATCH_ROWS rows in this session: texts make wide rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def cut(df: DataFrame) -> DataFrame:
    """Materialises ``df`` in the session's checkpoint folder, so that lost executors lose nothing.

    The folder is the one that the cluster names in spark.checkpoint.dir. Where that is unset, one is made
    in a local session only: on a cluster executors could not read each other's.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return df.checkpoint(eager=True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with ``value`` evaluated once: lambdas evaluate what they capture anew for every element."""
    return F.transform(F.array(value), body)[0]


def scanned(values: Column, op: Callable[[Column, Column], Column], zero: Column, levels: int = 1) -> Column:
    """For each element of an array, ``op`` (associative) over all elements before it; ``zero`` for the first.

    An array that grows in an aggregate is copied at every step, so the array is scanned in blocks of
    BLOCK, whose starts are the scan of the blocks' totals: some BLOCK / 2 copies an element.
    """

    def plain(x: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, v: F.struct(op(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(x, state, step, lambda acc: acc["out"])

    if not levels:
        return plain(values, zero)

    def in_blocks(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda i: F.slice(x, i * BLOCK + 1, F.lit(BLOCK)))

        def joined(cut: Column) -> Column:
            starts = scanned(F.transform(cut, lambda b: F.aggregate(b, zero, op)), op, zero, levels - 1)
            return F.flatten(F.zip_with(cut, starts, plain))

        return F.when(F.size(x) <= BLOCK, plain(x, zero)).otherwise(let(blocks, joined))

    return let(values, in_blocks)


def sums_before(lengths: Column) -> Column:
    return scanned(lengths, lambda a, b: a + b, F.lit(0))


def located(text: Column, pattern: str) -> Column:
    """array<struct<s:int,e:int,m:string>>: leftmost non-overlapping matches, in code points, end exclusive.

    The pieces between matches and the matches themselves come from the same Java matcher, so their
    lengths add up to the offsets. ``text`` must not be null.
    """
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        reach = F.zip_with(gaps, found, lambda gap, m: F.length(gap) + F.length(m))
        spans = let(reach, lambda r: F.zip_with(sums_before(r), r, lambda before, n: before + n))
        return F.zip_with(found, spans, lambda m, e: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("m")))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) == 0, none).otherwise(placed(found)))


def joined(spans: Column, touching: bool = False) -> Column:
    """Sorted spans (struct with s and e) with those that overlap (or touch) as one: the first one's fields, the last end."""

    def merge(x: Column) -> Column:
        def with_ends(before: Column) -> Column:
            apart = (lambda i: x[i]["s"] > before[i]) if touching else (lambda i: x[i]["s"] >= before[i])
            firsts = F.filter(F.sequence(F.lit(0), F.size(x) - 1), lambda i: (i == 0) | apart(i))
            last = F.array_max(F.transform(x, lambda s: s["e"]))
            return let(firsts, lambda f: F.transform(f, lambda i, k: x[i].withField("e", F.coalesce(before[F.get(f, k + 1)], last))))

        before = scanned(F.transform(x, lambda s: s["e"]), lambda a, b: F.greatest(a, b), F.lit(-1))
        return F.when(F.size(x) < 2, x).otherwise(let(before, with_ends))

    return let(spans, merge)


def parts(text: Column, cuts: Callable[[Callable[[Column, Column], Column]], Column]) -> Column:
    """cuts(part), where part(s, e) are the code points s to e of ``text``, read from blocks of it and not from its start."""

    def of(blocks: Column) -> Column:
        def part(s: Column, e: Column) -> Column:
            first, last = F.floor(s / PAGE).cast("int"), F.floor(e / PAGE).cast("int")
            some = F.array_join(F.slice(blocks, first + 1, F.least(last, F.size(blocks) - 1) - first + 1), "")
            return F.when(e <= s, "").otherwise(F.substring(some, s - first * PAGE + 1, e - s))

        return cuts(part)

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0)), of)


def span_text(spans: Column) -> Column:
    """kind:start:end of array<struct<s,rank,e,kind>>, by start, then rank, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def as_spans(found: Column, kind: str, rank: int) -> Column:
    """located() matches as array<struct<s,rank,e,kind>>."""
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(rank).alias("rank"), x["e"].alias("e"), F.lit(kind).alias("kind")))


# ---- bytes of many texts at once -------------------------------------------------------------------

_RNG = np.random.default_rng(20240607)
_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 2**64))
_LOWER = np.zeros(256, np.uint8)
for _b in range(256):
    _c = _b + 32 if 65 <= _b <= 90 else _b
    _LOWER[_b] = _c if _b >= 128 or 48 <= _c <= 57 or 97 <= _c <= 122 else 0
_POWERS = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS
    if len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        both = []
        for base in (_BASE, _BASE_INV):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS = tuple(both)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without nulls, and the len + 1 offsets of its rows, from 0."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of up to ``most`` bytes, or one longer row: keeps numpy's arrays in the caches. What works on a longer row walks it in blocks."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, to
        at = to


#: Bytes whose words are found at once, with some 50 bytes of memory for each; a word that is longer is hashed in such parts.
WORD_BLOCK = 1 << 20


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes, first and end bytes of all words, and the len + 1 offsets of the rows in them.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. Bytes are walked in blocks that end
    with a word or row, so memory is 24 bytes a word and that of a block.
    """
    found = list(word_blocks(raw, offsets))
    none = np.zeros(0, np.int64)
    hashes, starts, ends = (np.concatenate([f[i] for f in found]) if len(found) > 1 else found[0][i] if found else none.astype(t) for i, t in ((0, np.uint64), (1, np.int64), (2, np.int64)))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last of words(), in 8 bytes a word."""
    hashes, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for h, starts, _ in word_blocks(raw, offsets):
        counts += np.diff(np.searchsorted(starts, offsets))
        hashes.append(h)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)])


def word_blocks(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes, first and end bytes of the words of successive blocks of up to WORD_BLOCK bytes."""
    at = 0
    while at < len(raw):
        to = min(at + WORD_BLOCK, len(raw))
        if to < len(raw) and _LOWER[raw[to - 1]] and _LOWER[raw[to]]:  # the end may cut a word: back to the last byte that ends none, or the last row's end
            stop = np.flatnonzero(_LOWER[raw[at:to]] == 0)
            row = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            to = max(at + int(stop[-1]) + 1 if len(stop) else at, row)
        if to > at:
            edges = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to, "right")]
            h, starts, ends = _words(raw[at:to], np.concatenate([[0], edges - at, [to - at]]))
            yield h, starts + at, ends + at
        else:  # one word fills the block
            last = int(offsets[np.searchsorted(offsets, at, "right")])
            to, total = at, np.uint64(0)
            power, _ = _powers(WORD_BLOCK + 1)
            while to < last:
                low = _LOWER[raw[to : min(to + WORD_BLOCK, last)]]
                gap = np.flatnonzero(low == 0)
                n = int(gap[0]) if len(gap) else len(low)
                part = (_VALUE[low[:n]] * power[:n]).sum(dtype=np.uint64)
                total = np.uint64((int(total) + int(part) * pow(int(_BASE), to - at, 2**64)) % 2**64)
                to += n
                if n < len(low):
                    break
            yield mix(np.array([(int(total) + to - at) % 2**64], np.uint64)), np.array([at]), np.array([to])
        at = to


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = _LOWER[raw]
    inside = low != 0
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(raw), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    power, inverse = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[low] * power[: len(raw)], dtype=np.uint64, out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts, ends


def grams(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within a row, and each run's first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = np.ones(n, bool)
    for end in rows[1:-1]:
        whole[max(0, end - k + 1) : end] = False
    at = np.flatnonzero(whole)
    found = np.empty(len(at), np.uint64)
    for lo in range(0, len(at), WORD_BLOCK):  # in blocks: what is computed on the way is as long as one
        own = at[lo : lo + WORD_BLOCK]
        out = np.zeros(len(own), np.uint64)
        for i in range(k):
            out = (out ^ hashes[own + i]) * np.uint64(0xD6E8FEB86659FD93)
            out ^= out >> np.uint64(32)
        found[lo : lo + WORD_BLOCK] = mix(out)
    return found, at
