"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from a text's bytes and words alone (shares of character classes, repetition of words,
lines and word pairs, lengths). Training takes at most SAMPLE labelled rows, those of least hash of
doc_id among the rows that the fold rule leaves, and one text of each (of several, the one of greatest
statistics); that bound is the only use of a sample, and only their statistics reach the driver. Statistics are cut at quantiles into BINS bins; each tree halves its nodes
DEPTH times by the split of largest gain and is stored as a complete tree in three arrays, which numpy
walks for all rows of a batch at once. Every document is scored whole.

A long text is walked in blocks: some 5 bytes of memory for each of its bytes.
Null text is empty text and gets a score like any other. A label that is null or a document with several
labels: null labels are left out, and of several the largest counts. Without any labelled row every score
is 0.5. Repeated rows get equal scores; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, StructField, StructType

from .base import arrow_rows, mix, pieces, text_bytes, word_blocks, words

SAMPLE, BINS, DEPTH, TREES, RATE, SMOOTH, CUT = 20_000, 64, 4, 80, 0.15, 5.0, 0.3

#: Byte classes whose shares are statistics.
_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "blank": (32, 9),
    "line": (10, 13),
    "stop": b".,;:?'\"()-",
    "shout": b"!",
    "sign": b"#$%&*+/<=>@\\^_`{|}~[]",
    "control": [*range(9), 11, 12, *range(14, 32), 127],
    "high": range(128, 256),
}
NAMES = [*_CLASSES, "log_bytes", "log_words", "word_bytes", "distinct_words", "same_next", "distinct_pairs", "top_word", "distinct_lines", "line_words", "entropy", "long_words"]
_OF = np.zeros(256, np.int64)
for _i, _c in enumerate(_CLASSES.values()):
    _OF[list(_c)] = _i


def _grouped(values: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and the count of the commonest."""
    if not len(values):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    new = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (r[1:] != r[:-1])])
    top = np.zeros(n)
    np.maximum.at(top, r[new], np.diff(np.r_[new, len(v)]))
    return np.bincount(r[new], minlength=n).astype(float), top


#: Bytes of a longer row that are counted at once.
BLOCK = 1 << 20


def _long_statistics(raw: np.ndarray) -> np.ndarray:
    """statistics() of one long row: bytes are counted in blocks; of its words only hashes are kept, 8 bytes each, and sorted in place."""
    of_byte = sum(np.bincount(raw[lo : lo + BLOCK], minlength=256) for lo in range(0, len(raw), BLOCK)).astype(float)
    share = np.bincount(_OF, of_byte, len(_CLASSES)) / len(raw)
    of_byte /= len(raw)
    entropy = -(of_byte * np.log2(np.maximum(of_byte, 1e-12))).sum()
    hashes, lines, chars, long, row, spot, partial, last = [], [], 0, 0, -1, 0, 0, 0
    newlines = 0  # before the byte ``last``
    for h, starts, ends in word_blocks(raw, np.array([0, len(raw)])):
        if not len(h):
            continue
        chars += int((ends - starts).sum())
        long += int((ends - starts > 20).sum())
        hashes.append(h)
        here = np.flatnonzero(raw[last : starts[-1]] == 10) + last
        line = newlines + np.searchsorted(here, starts)
        newlines, last = newlines + len(here), int(starts[-1])
        first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
        place = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
        goes_on = line == row
        place[goes_on] += spot  # the words of the line that the last block left open come before
        sums = np.add.reduceat(mix(h + place.astype(np.uint64)), first)
        if goes_on[0]:
            sums[0] = np.uint64((int(sums[0]) + partial) % 2**64)
        elif row >= 0:
            lines.append(np.array([partial], np.uint64))
        row, spot, partial = int(line[-1]), int(place[-1]) + 1, int(sums[-1])
        lines.append(sums[:-1])
    if row >= 0:
        lines.append(np.array([partial], np.uint64))
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    del hashes
    n_words, n_lines = float(len(h)), float(sum(map(len, lines)))
    again = sum(int((h[lo + 1 : lo + BLOCK + 1] == h[lo : lo + BLOCK][: len(h) - lo - 1]).sum()) for lo in range(0, len(h), BLOCK))

    def distinct(values: np.ndarray) -> tuple[float, float]:
        if not len(values):
            return 0.0, 0.0
        values.sort()
        new = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        return float(len(new)), float(np.diff(np.append(new, len(values))).max())

    pair = np.empty(max(len(h) - 1, 0), np.uint64)
    for lo in range(0, len(pair), BLOCK):
        after, before = h[lo + 1 : lo + BLOCK + 1], h[lo : lo + BLOCK]
        pair[lo : lo + BLOCK] = mix(after * np.uint64(3) + before[: len(after)])
    pairs, _ = distinct(pair)
    del pair
    words_, top = distinct(h)
    distinct_lines, _ = distinct(np.concatenate(lines) if lines else np.zeros(0, np.uint64))
    some, most = max(n_words, 1.0), max(n_lines, 1.0)
    more = [np.log1p(float(len(raw))), np.log1p(n_words), chars / some, words_ / some, again / some, pairs / some, top / some, distinct_lines / most, n_words / most, entropy, long / some]
    return np.concatenate([share, more])[None, :]


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x len(NAMES) statistics."""
    n = len(offsets) - 1
    if n == 1 and len(raw) > BLOCK:
        return _long_statistics(raw)
    size = np.diff(offsets).astype(float)
    row = np.repeat(np.arange(n), np.diff(offsets))
    share = np.bincount(row * len(_CLASSES) + _OF[raw], minlength=n * len(_CLASSES)).reshape(n, -1) / np.maximum(size, 1)[:, None]
    of_byte = np.bincount(row * 256 + raw, minlength=n * 256).reshape(n, 256) / np.maximum(size, 1)[:, None]
    entropy = -(of_byte * np.log2(np.maximum(of_byte, 1e-12))).sum(1)
    h, starts, ends, cuts = words(raw, offsets)
    n_words = np.diff(cuts).astype(float)
    of = np.repeat(np.arange(n), np.diff(cuts))
    distinct, top = _grouped(h, of, n)
    inside = of[1:] == of[:-1]
    again = np.bincount(of[1:][inside & (h[1:] == h[:-1])], minlength=n)
    pairs, _ = _grouped(mix(h[1:][inside] * np.uint64(3) + h[:-1][inside]), of[1:][inside], n)
    length = (ends - starts).astype(float)
    # lines, each by the sum of its words' hashes times their place
    new_line = np.flatnonzero(raw == 10)
    line = np.searchsorted(new_line, starts)
    key = np.r_[True, (line[1:] != line[:-1]) | (of[1:] != of[:-1])] if len(h) else np.zeros(0, bool)
    first = np.flatnonzero(key)
    spot = (np.arange(len(h)) - np.repeat(first, np.diff(np.r_[first, len(h)]))).astype(np.uint64)
    lines = np.add.reduceat(mix(h + spot), first) if len(first) else np.zeros(0, np.uint64)
    n_lines = np.bincount(of[first], minlength=n).astype(float)
    distinct_lines, _ = _grouped(lines, of[first], n)
    some, most = np.maximum(n_words, 1), np.maximum(n_lines, 1)
    more = [np.log1p(size), np.log1p(n_words), np.bincount(of, length, n) / some, distinct / some, again / some, pairs / some, top / some, distinct_lines / most, n_words / most, entropy, np.bincount(of, length > 20, n) / some]
    return np.column_stack([share, *more])


class Trees:
    """Boosted complete trees in flat arrays: feature and threshold of each inner node, value of each leaf."""

    def __init__(self, prior: float = 0.0):
        self.prior, self.feature, self.threshold, self.leaf = prior, np.zeros((0, 2**DEPTH - 1), np.int64), np.zeros((0, 2**DEPTH - 1)), np.zeros((0, 2**DEPTH))

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.prior), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Trees:
        if not len(y):
            return cls()
        mean = (y.sum() + 1) / (len(y) + 2)
        model = cls(float(np.log(mean / (1 - mean))))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
        margin, features, thresholds, leaves = np.full(len(y), model.prior), [], [], []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            gradient, weight = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, threshold = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
            for depth in range(DEPTH):
                first, n = 2**depth - 1, 2**depth
                gain_of = np.full((n, x.shape[1]), -np.inf)
                bin_of = np.zeros((n, x.shape[1]), np.int64)
                for j in range(x.shape[1]):
                    cell = (node - first) * BINS + binned[:, j]
                    g = np.bincount(cell, gradient, n * BINS).reshape(n, BINS).cumsum(1)
                    w = np.bincount(cell, weight, n * BINS).reshape(n, BINS).cumsum(1)
                    gain = g**2 / (w + SMOOTH) + (g[:, -1:] - g) ** 2 / (w[:, -1:] - w + SMOOTH) - g[:, -1:] ** 2 / (w[:, -1:] + SMOOTH)
                    bin_of[:, j] = gain[:, : len(edges[j])].argmax(1) if len(edges[j]) else 0
                    gain_of[:, j] = gain[np.arange(n), bin_of[:, j]] if len(edges[j]) else -np.inf
                best = gain_of.argmax(1)
                for k in range(n):
                    if gain_of[k, best[k]] > 1e-9:
                        feature[first + k], threshold[first + k] = best[k], edges[best[k]][bin_of[k, best[k]]]
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
            leaf = node - (2**DEPTH - 1)
            value = RATE * np.bincount(leaf, gradient, 2**DEPTH) / (np.bincount(leaf, weight, 2**DEPTH) + SMOOTH)
            margin += value[leaf]
            features.append(feature)
            thresholds.append(threshold)
            leaves.append(value)
        model.feature, model.threshold, model.leaf = np.array(features), np.array(thresholds), np.array(leaves)
        return model


def _mapped(docs: DataFrame, keep: list[str], function, kind: DataType, arrow: pa.DataType) -> DataFrame:
    """kept (a struct of the columns ``keep``) and value: function(statistics) of every row's text."""
    arrow_rows(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("kept"), F.coalesce("text", F.lit("")).alias("text"))
    spec = StructType([rows.schema["kept"], StructField("value", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            out = [function(statistics(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in pieces(offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v for o in out for v in o.tolist()], arrow)], ["kept", "value"])

    return rows.mapInArrow(run, spec)


def held_out(doc_id: Column) -> Column:
    """The fold rule: rows whose crc32(doc_id as text) divides by 5 never teach."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from at most ``sample`` labelled rows outside the held-out fold."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).dropna()
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).filter(~held_out(F.col("doc_id")))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = _mapped(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"), ["doc_id", "quality"], lambda x: x, ArrayType(DoubleType()), pa.list_(pa.float64()))
    rows = rows.groupBy("kept.doc_id").agg(F.max(F.struct("value", "kept.quality")).alias("x"))
    got = sorted(rows.select("doc_id", "x.value", "x.quality").collect())  # no more than ``sample``
    x = np.array([r["value"] for r in got]).reshape(-1, len(NAMES))
    return Trees.fit(x, np.array([float(r["quality"]) for r in got]))


def score_quality(docs: DataFrame, model: Trees) -> DataFrame:
    """doc_id, score: one row per document."""
    return _mapped(docs.select("doc_id", "text"), ["doc_id"], model.score, DoubleType(), pa.float64()).select("kept.doc_id", F.col("value").alias("score"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, all columns as they are."""
    scored = _mapped(docs, docs.columns, train(docs, labels).score, DoubleType(), pa.float64())
    return scored.filter(F.col("value") >= CUT).select("kept.*")
