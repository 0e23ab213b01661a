"""Document fingerprints: improbable-feature digests in chained Bloom filters.

1. Every 64-byte window of a text has a Shannon entropy, from counts that change by the byte that
   enters and the byte that leaves, in steps of 1/256 bit.
2. Over the whole table the histogram of these entropies is counted; a window's rank is the number of
   windows that are as common as its own or rarer, so improbable windows rank first. The histogram has
   at most LEVELS rows, whatever the table's size, and is all that the driver gets.
3. Of every 64 neighbouring windows the leftmost of least rank gets a vote; windows of 16 votes or more
   are the text's features (a text that gives none has the window with most votes).
4. Features go, in order, into 2048-bit Bloom filters by five 11-bit hashes each; a filter that holds
   160 features is closed and the next one opened.
5. Likeness: for each filter of the digest with fewer filters, its best overlap with the other's
   filters beyond what chance gives, normalised to 0..1; the mean of these, weighted by features.

Every text, long, short or empty, is followed by PAD zero bytes, in the histogram as in its digest; so
each byte starts a window. Null text is empty text.
A long text is walked in blocks, so that memory is some 10 bytes for each of its bytes. Equal texts have equal fingerprints. Documents follow each other by (doc_id, hash of text, text), null
doc_id first; repeated rows are documents of their own. An empty table gives no rows; one document is its own next.
Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import arrow_rows, mix, pieces, text_bytes

W, VOTES, BITS, HASHES, FULL, STEP = 64, 16, 2048, 5, 160, 256
LEVELS, PAD = 6 * STEP + 1, 2 * W - 1
_G = np.zeros(W + 2)
_G[1:] = np.arange(1, W + 2) * np.log2(np.arange(1, W + 2))
#: What the sum of c log2 c gains when a count goes from c to c + 1, in 2**-20.
_GAIN = np.round((_G[1:] - _G[:-1]) * (1 << 20)).astype(np.int64)


def levels(raw: np.ndarray) -> np.ndarray:
    """Entropy of each window of 64 bytes, 0..LEVELS-1 in steps of 1/256 bit, by incremental counts."""
    n = len(raw)
    behind, ahead = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lo in range(0, n, 1 << 16):  # blocks that stay in the cache; each looks 63 bytes past its end
        hi = min(n, lo + (1 << 16))
        for d in range(1, W):
            to = min(hi, n - d)
            if to > lo:
                same = (raw[lo:to] == raw[lo + d : to + d]).view(np.uint8)
                ahead[lo:to] += same
                behind[lo + d : to + d] += same
    gained = np.cumsum(_GAIN[behind])
    gained[W:] -= np.cumsum(_GAIN[ahead])[: n - W]
    bits = 6.0 - gained[W - 1 :] / float(W << 20)
    return np.clip(np.rint(bits * STEP), 0, LEVELS - 1).astype(np.int32)


def padded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of rows, each with PAD zero bytes after it."""
    n = len(offsets) - 1
    out = np.zeros(len(raw) + n * PAD, np.uint8)
    if n == 1:
        out[: len(raw)] = raw
    else:
        out[np.arange(len(raw)) + np.repeat(np.arange(n) * PAD, np.diff(offsets))] = raw
    return out, offsets + np.arange(n + 1) * PAD


#: Groups of windows of a longer row that are judged at once; a block looks 2 W - 2 bytes past its end.
BLOCK = 1 << 20


def _runs(raw: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring groups with one choice: the chosen windows' first bytes, their rows and votes."""
    level = ranks[levels(raw)].astype(np.int64)  # one per byte but the last 63
    key = (level << 32) | np.arange(len(level))
    least, width = key, 1
    while width < W:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    # a group of windows counts if all its 127 bytes are of one row
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    own = rows[: len(least)] == rows[2 * W - 2 : 2 * W - 2 + len(least)]
    group = np.flatnonzero(own)
    chosen, row = least[own] & 0xFFFFFFFF, rows[group]
    change = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])])
    return chosen[change], row[change], np.diff(np.r_[change, len(chosen)])


def _runs_in_blocks(raw: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """_runs() of one long row: those that go on from one block into the next are one."""
    parts = []
    for lo in range(0, len(raw) - (2 * W - 2), BLOCK):
        block = raw[lo : lo + BLOCK + 2 * W - 2]
        at, _, votes = _runs(block, np.array([0, len(block)]), ranks)
        at = at + lo
        if parts and parts[-1][0][-1] == at[0]:
            parts[-1][1][-1] += votes[0]
            at, votes = at[1:], votes[1:]
        if len(at):
            parts.append((at, votes))
    at, votes = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    return at, np.zeros(len(at), np.int64), votes


def _features(raw: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the chosen windows of all rows, and each one's row."""
    at, of, votes = _runs_in_blocks(raw, ranks) if len(offsets) == 2 and len(raw) > BLOCK else _runs(raw, offsets, ranks)
    # the window with most votes of each row stands in where none has enough
    order = np.lexsort((np.arange(len(at)), -votes, of))
    best = np.zeros(len(at), bool)
    best[order[np.r_[True, of[order][1:] != of[order][:-1]]]] = True
    enough = votes >= VOTES
    some = np.zeros(len(offsets) - 1, bool)
    some[of[enough]] = True
    keep = enough | (best & ~some[of])
    return at[keep], of[keep]


def digests(texts: list[bytes], ranks: np.ndarray) -> list[bytes]:
    """Digest of each text: a 2-byte count of features and 256 bytes for each filter."""
    out: list[bytes] = []
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    for a, b in pieces(offsets):
        raw, cuts = padded(np.frombuffer(b"".join(texts[a:b]), np.uint8), offsets[a : b + 1] - offsets[a])
        at, of = _features(raw, cuts, ranks)
        eight = np.ascontiguousarray(raw[at[:, None] + np.arange(W)]).view(np.uint64)
        h = np.zeros(len(at), np.uint64)
        for i in range(W // 8):
            h = mix(h ^ (eight[:, i] + np.uint64(i + 1)))
        number = np.arange(len(at)) - np.searchsorted(of, of)
        counts = np.bincount(of, minlength=b - a)
        filters = -(-counts // FULL)
        first = np.r_[0, np.cumsum(filters)]
        bits = np.zeros((first[-1], BITS), np.uint8)
        for i in range(HASHES):
            bits[first[of] + number // FULL, (h >> np.uint64(11 * i)) & np.uint64(BITS - 1)] = 1
        packed = np.packbits(bits, axis=1)
        for k in range(b - a):
            last = int(counts[k] - FULL * (filters[k] - 1))
            out.append(last.to_bytes(2, "big") + packed[first[k] : first[k + 1]].tobytes())
    return out


def likeness(one: bytes, two: bytes) -> float:
    """Normalised overlap of the filters' bits beyond chance, 0..1; 1 for equal digests, and symmetric."""
    if one == two:
        return 1.0
    parsed = []
    for d in (one, two):
        packed = np.frombuffer(d, np.uint8)[2:].reshape(-1, BITS // 8)
        sizes = np.full(len(packed), FULL)
        sizes[-1] = int.from_bytes(d[:2], "big")
        parsed.append((np.unpackbits(packed, axis=1).astype(np.float32), sizes, d))
    parsed.sort(key=lambda x: (len(x[1]), x[1].sum(), x[2]))
    (x, nx, _), (y, ny, _) = parsed
    best = []
    for lo in range(0, len(x), 128):  # some filters of one against all of the other
        some = x[lo : lo + 128]
        common, sx, sy = some @ y.T, some.sum(1)[:, None], y.sum(1)[None, :]
        chance, most = sx * sy / BITS, np.minimum(sx, sy)
        floor = chance + 0.3 * (most - chance)
        best.append(np.clip((common - floor) / np.maximum(most - floor, 1e-9), 0, 1).max(1))
    return float(np.average(np.concatenate(best), weights=nx))


def entropy_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy level by how many windows of the whole table have it: the rarer, the lower."""
    arrow_rows(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(0))
            for a, b in pieces(offsets):
                part, cuts = padded(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if b - a == 1:
                    for lo in range(0, len(part) - W + 1, BLOCK):
                        total += np.bincount(levels(part[lo : lo + BLOCK + W - 1]), minlength=LEVELS)
                    continue
                inside = np.ones(len(part) - W + 1, bool)
                for end in cuts[1:-1]:
                    inside[max(0, end - W + 1) : end] = False
                total += np.bincount(levels(part)[inside], minlength=LEVELS)
        yield pa.RecordBatch.from_pydict({"level": np.arange(LEVELS, dtype=np.int32), "n": total})

    text = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    rows = text.mapInArrow(count, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(LEVELS, np.int64)
    for r in rows:
        n[r["level"]] = r["n"]
    ranks = np.empty(LEVELS, np.int32)
    ranks[np.lexsort((np.arange(LEVELS), n))] = np.arange(LEVELS)
    ranks[: STEP] = LEVELS  # below one bit: runs of a byte say nothing
    return ranks


def _cuts(docs: DataFrame, n_parts: int) -> list[tuple[int, int]]:
    """About n_parts - 1 cuts (key, mark) of rows (key, mark) into like parts. A key that fills several is cut by mark as well."""

    def quantiles(column: str, n: int) -> Column:
        return F.percentile_approx(column, F.array(*[F.lit(i / n) for i in range(1, n)]), 10 * n_parts)

    keys = Counter(docs.agg(quantiles("key", n_parts).alias("q")).first()["q"] or [])
    top = 2**63 - 1
    cuts = {(k, top) for k in keys}
    hot = {k: n for k, n in keys.items() if n > 1}
    if hot:
        most = max(hot.values())
        rows = docs.filter(F.col("key").isin(list(hot))).groupBy("key").agg(quantiles("mark", most).alias("q")).collect()
        cuts |= {(r["key"], r["q"][(i * (most - 1)) // hot[r["key"]]]) for r in rows for i in range(hot[r["key"]])}
    return sorted(cuts)


def _followed(docs: DataFrame) -> DataFrame:
    """Rows (part, extra, wrap, doc_id, text), each part's rows together and sorted, with the first document
    of the following part (of the last part: the first of all) as an extra row at its end.

    Parts are ranges of (doc_id, hash of text) between quantiles, and every part is a task of its own; the
    driver holds a few numbers a part. Texts are shuffled once.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), F.xxhash64(text).alias("mark"), "doc_id", text.alias("text"))
    cuts = _cuts(docs.select("key", "mark"), 3 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    n_parts = len(cuts) + 1
    listed = lambda values, kind: F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")  # noqa: E731 - folds into one literal
    of_key, of_mark = listed([k for k, _ in cuts], "long"), listed([m for _, m in cuts], "long")
    jumps = listed([1 << i for i in reversed(range(len(cuts).bit_length()))], "int")
    # a number for each part that hashes to a partition of its own
    tries = spark.range(40 * n_parts).select(F.col("id").cast("int").alias("slot")).groupBy(F.pmod(F.hash("slot"), F.lit(n_parts)).alias("at")).agg(F.min("slot").alias("slot"))
    slots = listed([r["slot"] for r in tries.orderBy("at").collect()], "int")

    def part(df: DataFrame) -> DataFrame:
        """Adds the number of cuts below (key, mark), by binary search."""

        def below(at: Column) -> Column:
            key, mark = F.try_element_at(of_key, at), F.try_element_at(of_mark, at)
            return F.coalesce((key < F.col("key")) | ((key == F.col("key")) & (mark < F.col("mark"))), F.lit(False))

        return df.withColumn("part", F.aggregate(jumps, F.lit(0), lambda at, jump: F.when(below(at + jump), at + jump).otherwise(at)))

    firsts = part(docs.select("key", "mark")).groupBy("part").agg(F.min(F.struct("key", "mark")).alias("head")).orderBy("part").collect()
    heads = [(*r["head"], firsts[i - 1]["part"], i == 0) for i, r in enumerate(firsts)]
    heads = spark.createDataFrame(heads, "head_key long, head_mark long, before int, wraps boolean")
    rows = part(docs).join(F.broadcast(heads), (F.col("key") == F.col("head_key")) & (F.col("mark") == F.col("head_mark")), "left")
    own = F.struct(F.col("part"), F.lit(False).alias("extra"), F.lit(False).alias("wrap"))
    again = F.struct(F.col("before").alias("part"), F.lit(True).alias("extra"), F.col("wraps").alias("wrap"))
    rows = rows.select("key", "mark", "doc_id", "text", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, again))).alias("p"))
    rows = rows.select("p.part", "p.extra", "p.wrap", F.element_at(slots, F.col("p.part") + 1).alias("slot"), "key", "mark", "doc_id", "text")
    rows = rows.repartition(n_parts, "slot").sortWithinPartitions("part", "wrap", "extra", "key", "mark", "text")
    return rows.select("part", "extra", "wrap", "doc_id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and its likeness to these and to the next document's."""
    ranks = entropy_ranks(docs)
    arrow_rows(docs.sparkSession)
    fields = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last own row so far: (part, doc_id, text, digest), if its next is still to come
        for batch in batches:
            part, extra, ids, texts = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            prints = digests([t.encode() for t in texts], ranks)
            pairs = []
            for row in zip(part, extra, ids, texts, prints, strict=True):
                if held and held[0][0] == row[0]:
                    pairs.append((held[0], row))
                    held = []
                if not row[1]:
                    held = [row]
            edited = []
            for own, following in pairs:
                half = len(own[3]) // 2
                edited.append(own[3][: len(own[3]) - half] + following[3][:half])
            coded = [t.encode() for t in edited]
            after = digests(coded, ranks)
            cells = [
                (own[2], len(own[3]), hashlib.sha256(c).hexdigest(), base64.b64encode(own[4]).decode(), base64.b64encode(e).decode(), likeness(own[4], e), likeness(own[4], following[4]))
                for (own, following), c, e in zip(pairs, coded, after, strict=True)
            ]
            if cells:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)], names)

    return _followed(docs).mapInArrow(run, fields)
