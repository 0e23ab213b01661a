"""Fill-in-middle: texts are cut at unit boundaries, found by rank queries on wavelet matrices over character classes.

A text's UTF-8 bytes are mapped to eight classes (rest of a code point, start of a word, rest of a word,
blank, line end, sentence end, other sign, first byte of a code point that continues a word beyond
ASCII). The classes of up to FRAME bytes form a wavelet matrix: three bit rows with counts at every
64 bits, from which the number of bytes of a class before any place follows in three steps. A unit
(code point, word, line or sentence) begins at bytes of certain classes, so the boundaries before a
place are a sum of ranks. A cut after k units is the place where that sum reaches k, found by
bisection on the ranks, for all rows of a frame at once. Frames do not follow rows: a long text is
spread over several, and many short ones share one, so numpy holds some 20 bytes for each of FRAME
bytes of text and half a byte for every other byte of the batch.

Cuts, form and order follow from a hash of doc_id alone, so every copy of a document is cut alike.
Null text is empty text; a null doc_id counts as an empty string in the hash. Empty texts and texts that
hold a mark stay plain. Repeated rows give equal rows, an empty table gives none, other columns are
ignored. Each row is read alone and whole: no shuffle, nothing depends on other rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import arrow_rows, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, so many are transformed, and of those so many start with the suffix.
RATE, SPM = 90, 20
#: Bytes of one wavelet matrix.
FRAME = 1 << 20

_REST, _WORD, _INNER, _BLANK, _LINE, _STOP, _SIGN, _WIDE = range(8)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[9, 11, 12, 13, 32]] = _BLANK
_CLASS[10] = _LINE
_CLASS[list(b".!?")] = _STOP
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = _INNER
_CLASS[128:192] = _REST
_CLASS[192:] = _WIDE
#: unit -> classes of its first bytes. A line or sentence ends with its mark, so what is counted there is ends.
UNITS = {"char": (_WORD, _INNER, _BLANK, _LINE, _STOP, _SIGN, _WIDE), "word": (_WORD,), "line": (_LINE,), "sentence": (_STOP,)}
_ENDS = {"line", "sentence"}


class WaveletMatrix:
    """Ranks of eight classes over a row of bytes: three bit rows, each with counts before every word of 64 bits."""

    def __init__(self, classes: np.ndarray):
        self.n, self.rows = len(classes), []
        for bit in (2, 1, 0):
            ones = (classes >> bit) & 1
            packed = np.zeros((len(ones) // 64 + 1) * 8, np.uint8)
            bits = np.packbits(ones, bitorder="little")
            packed[: len(bits)] = bits
            words = packed.view(np.uint64)
            before = np.zeros(len(words) + 1, np.int32)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            self.rows.append((words, before, self.n - int(before[-1])))
            classes = np.concatenate([classes[ones == 0], classes[ones == 1]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return before[word] + np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bytes are of class ``symbol``."""
        first, last = np.zeros_like(at), at
        for bit, (words, before, zeros) in zip((2, 1, 0), self.rows, strict=True):
            a, b = self._ones(words, before, first), self._ones(words, before, last)
            first, last = (zeros + a, zeros + b) if (symbol >> bit) & 1 else (first - a, last - b)
        return last - first

    def boundaries(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bytes are of one of the classes; of many classes, by what the others leave."""
        if len(symbols) > 4:
            return at - sum(self.rank(s, at) for s in range(8) if s not in symbols)
        return sum(self.rank(s, at) for s in symbols)

    def reach(self, symbols: tuple[int, ...], k: np.ndarray) -> np.ndarray:
        """The least places before which ``k`` boundaries stand, by bisection on the ranks."""
        low, high = np.zeros(len(k), np.int64), np.full(len(k), self.n, np.int64)
        for _ in range(self.n.bit_length() + 1):
            mid = (low + high) >> 1
            enough = self.boundaries(symbols, mid) >= k
            low, high = np.where(enough, low, np.minimum(mid + 1, high)), np.where(enough, mid, high)
        return high


class Boundaries:
    """Unit boundaries of all rows of a batch, held as one wavelet matrix a frame."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, unit: str, frame: int = FRAME):
        self.frame, self.unit, self.symbols, self.offsets = frame, unit, UNITS[unit], offsets
        self.matrices = [WaveletMatrix(self._classes(raw, offsets, a, min(a + frame, len(raw)))) for a in range(0, len(raw), frame)]
        self.before = np.cumsum([0, *(int(m.boundaries(self.symbols, np.array([m.n]))[0]) for m in self.matrices)])

    @staticmethod
    def _classes(raw: np.ndarray, offsets: np.ndarray, a: int, b: int) -> np.ndarray:
        """Classes of bytes a to b; a word starts where no word goes on from the byte before, or where a row starts."""
        own = _CLASS[raw[a:b]]
        last = np.concatenate([_CLASS[raw[max(a - 1, 0) : a]] if a else np.full(1, _BLANK, np.uint8), own[:-1]])
        starts = np.zeros(b - a, bool)
        rows = offsets[(offsets >= a) & (offsets < b)] - a
        starts[rows] = True
        solid = lambda c: (c == _INNER) | (c == _WIDE) | (c == _REST)
        return np.where(((own == _INNER) | (own == _WIDE)) & (~solid(last) | starts), np.uint8(_WORD), own)

    def count(self, at: np.ndarray) -> np.ndarray:
        """Boundaries before byte ``at`` of the batch."""
        out, frame = np.zeros(len(at), np.int64), np.minimum(at // self.frame, max(len(self.matrices) - 1, 0))
        for f in np.unique(frame) if self.matrices else ():
            own = frame == f
            out[own] = self.before[f] + self.matrices[f].boundaries(self.symbols, at[own] - f * self.frame)
        return out

    def sizes(self) -> np.ndarray:
        """Units of each row: boundaries, and what stands before the first or after the last of them, if anything does."""
        ends = self.count(self.offsets)
        units = np.diff(ends)
        if self.unit in _ENDS:  # what follows the last end is one more
            return units + (np.diff(self.offsets) > self._place(self.offsets[:-1], self.offsets[1:], ends[:-1], units))
        return units

    def _place(self, first: np.ndarray, last: np.ndarray, base: np.ndarray, k: np.ndarray) -> np.ndarray:
        """For rows from byte ``first``, the byte within the row after its ``k``-th boundary (0 for none)."""
        out, want = np.zeros(len(k), np.int64), base + k
        frame = np.searchsorted(self.before, want, "left") - 1
        for f in np.unique(frame[k > 0]):
            own = (frame == f) & (k > 0)
            out[own] = f * self.frame + self.matrices[f].reach(self.symbols, want[own] - self.before[f]) - first[own]
        return np.minimum(out, last - first)

    def cuts(self, k: np.ndarray) -> np.ndarray:
        """The byte within each row after ``k`` of its units."""
        first, last, base = self.offsets[:-1], self.offsets[1:], self.count(self.offsets)
        units = np.diff(base)
        if self.unit in _ENDS:
            return np.where(k > units, last - first, self._place(first, last, base[:-1], np.minimum(k, units)))
        # the k-th unit ends where the next one starts, one byte before its first byte is passed
        inner = self._place(first, last, base[:-1], np.minimum(k + 1, units)) - 1
        return np.where(k == 0, 0, np.where(k >= units, last - first, inner))


def _draws(doc_id: Column) -> list[Column]:
    """The first four 8-digit groups of the hash of "1:" and doc_id, as numbers."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = "char", rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n (units), form, prefix_units, middle_units (null if plain), prefix_chars, middle_chars (likewise), output; one row per document."""
    arrow_rows(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    h1, h2, h3, h4 = _draws(F.col("doc_id"))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains(text, F.lit(mark))
    form = F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    rows = docs.select("doc_id", text.alias("text"), h1, h2, form.alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            found = Boundaries(raw, offsets, unit)
            n = found.sizes()
            a, b = (batch.column(i).to_numpy() % (n + 1) for i in (2, 3))
            low, high = np.minimum(a, b), np.maximum(a, b)
            chars = found if unit == "char" else Boundaries(raw, offsets, "char")
            ends = [offsets[:-1] + found.cuts(k) for k in (low, high)]
            passed = [chars.count(e) - chars.count(offsets[:-1]) for e in ends]
            out, data = [], memoryview(raw)
            for i, kind in enumerate(batch.column(4).to_pylist()):
                s, p, m, e = offsets[i], ends[0][i], ends[1][i], offsets[i + 1]
                pre, mid, post = bytes(data[s:p]), bytes(data[p:m]), bytes(data[m:e])
                if kind == "psm":
                    out.append(b"".join((b"<P>", pre, b"<S>", post, b"<M>", mid)).decode())
                elif kind == "spm":
                    out.append(b"".join((b"<S>", post, b"<P>", pre, b"<M>", mid)).decode())
                else:
                    out.append(bytes(data[s:e]).decode())
            plain = np.array([k == "plain" for k in batch.column(4).to_pylist()], bool)
            shown = [pa.array(x, pa.int64(), mask=plain) for x in (low, high - low, passed[0], passed[1] - passed[0])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), batch.column(4), *shown, pa.array(out, pa.string())], ["doc_id", "n", "form", "prefix_units", "middle_units", "prefix_chars", "middle_chars", "output"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_units long, middle_units long, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The text from output and form: the marks stand in a fixed order and the text holds none of them."""

    def between(first: str, last: str) -> Column:
        start = F.locate(first, output) + len(first)
        return F.substring(output, start, F.locate(last, output) - start)

    middle = F.substring(output, F.locate(MIDDLE, output) + len(MIDDLE), F.length(output))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def middles_digest(docs: DataFrame) -> DataFrame:
    """One row per document: its form, cuts in code points, digests of the output and of the text restored from it."""
    made = fill_in_middle(docs)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
