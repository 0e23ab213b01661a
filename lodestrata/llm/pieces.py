"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Texts are marked as the model does it (a leading mark, blanks become marks) and cut into words where two
neighbouring characters stand together in no piece: no path reaches over that place, so the best path of
the text is that of its words. The distinct words that a worker has not met are sorted, which is a
depth-first walk of their trie: forward scores and back pointers of the prefix that a word shares with
the one before it are kept, and only the rest is scored.
The best path has the largest sum of piece scores; of equal ones, the longest last piece. A character
that no piece covers becomes the pieces of its UTF-8 bytes.

decode_pieces() undoes it exactly, but for marks that stood in the text, which come back as blanks.

The model's path is a parameter; the file must be at that path on every executor. Null text is empty
text, which has no ids. Very long words are scored like any others. Repeated rows are rows of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_rows

MARK = "▁"
#: Distinct words whose ids a worker remembers; beyond it, it starts anew.
REMEMBERED = 800_000


class Pieces:
    """A model's pieces and the walk over sorted words."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        self.byte = {int(self.names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.ids = {p: i for i, p in enumerate(self.names) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        self.unknown = min(self.score.values()) - 10.0
        # all ends of pieces, with the score of those that are pieces: a walk to the left stops where no piece goes on
        self.ends: dict[str, float | None] = {p[i:]: None for p in self.ids for i in range(len(p))}
        self.ends.update(self.score)
        # which neighbours some piece holds; characters of no piece have number 0 and no neighbours
        letters = sorted(set("".join(self.ids)))
        self.number = np.zeros(0x110000, np.uint16)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        pairs = np.array([(ord(a), ord(b)) for p in self.ids for a, b in zip(p, p[1:])]).reshape(-1, 2)
        self.joined[self.number[pairs[:, 0]], self.number[pairs[:, 1]]] = True
        self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.encode() for i, p in enumerate(self.names)]
        self.known: dict[str, tuple[int, ...]] = {}

    def learn(self, words: set[str]) -> None:
        """Ids of words, in sorted order, each from where it leaves the one before."""
        ends, unknown, best, back, before = self.ends.get, self.unknown, [0.0], [0], ""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                at = start = end - 1
                score = ends(word[at:end], False)
                top = best[at] + (unknown if score is None or score is False else score)
                while at and score is not False:
                    at -= 1
                    score = ends(word[at:end], False)
                    if score is not None and score is not False and best[at] + score >= top:
                        top, start = best[at] + score, at
                best.append(top)
                back.append(start)
            ids, end = [], len(word)
            while end:
                piece = word[back[end] : end]
                ids += [self.ids[piece]] if piece in self.ids else [self.byte[b] for b in reversed(piece.encode())]
                end = back[end]
            self.known[word] = tuple(reversed(ids))
            before = word

    def words(self, text: str) -> list[str]:
        """The marked text, cut wherever two neighbours stand together in no piece."""
        if not text:
            return []
        text = MARK + text.replace(" ", MARK)
        code = self.number[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        at = [0, *(np.flatnonzero(~self.joined[code[:-1], code[1:]]) + 1).tolist(), len(text)]
        return [text[a:b] for a, b in zip(at, at[1:])]

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.words(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.learn(set(chain.from_iterable(cut)) - self.known.keys())
        get = self.known.__getitem__
        return [list(chain.from_iterable(map(get, c))) for c in cut]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode(errors="replace").replace(MARK, " ")[1:]


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int>, n_chars, decoded: one row per document."""
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = model.encode(texts)
            ends = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "n_chars", "ids"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, n_chars long, ids array<int>")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_chars, ids, text from rows (doc_id, n_chars, ids)."""
    arrow_rows(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(path)
        for batch in batches:
            ends, flat = batch.column(2).offsets.to_pylist(), batch.column(2).values.to_numpy().tolist()
            texts = [model.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "n_chars", "ids", "text"])

    return encoded.select("doc_id", "n_chars", "ids").mapInArrow(run, "doc_id long, n_chars long, ids array<int>, text string")


def pieces_digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_chars, n_ids, the ids' digest, and length and digest of the text decoded from them."""
    back = decode_pieces(encode_pieces(docs, path), path)
    return back.select(
        "doc_id",
        "n_chars",
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        F.length("text").cast("long").alias("decoded_chars"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
