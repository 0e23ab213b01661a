"""Boundaries by wavelet ranks against plain scans, and fill-in-middle on hard rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import queries as Q
from lodestrata.llm import wavelet
from lodestrata.llm.base import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"
WORDS = r"[0-9A-Za-z\u0080-\U0010ffff]+"
PLAIN = {"char": r"(?s).", "line": r"[^\n]*\n|[^\n]+", "sentence": r"[^.!?]*[.!?]|[^.!?]+", "word": WORDS}


def plain_cut(unit, text, k):
    found = list(re.finditer(PLAIN[unit], text))
    if unit == "word":  # a word's unit reaches to the next word
        return 0 if k == 0 else len(text) if k >= len(found) else found[k].start()
    return found[k - 1].end() if k else 0


@pytest.mark.parametrize("unit", wavelet.UNITS)
def test_cuts(unit):
    rng = random.Random(1)
    for _ in range(150):
        texts = ["".join(rng.choice("ab é. \n!?😀x,1　") for _ in range(rng.choice([0, 1, 5, 30, 200]))) for _ in range(rng.randint(1, 6))]
        coded = [t.encode() for t in texts]
        offsets = np.cumsum([0, *map(len, coded)]).astype(np.int64)
        found = wavelet.Boundaries(np.frombuffer(b"".join(coded), np.uint8), offsets, unit, frame=rng.choice([7, 64, 100, 1 << 20]))
        n = found.sizes()
        assert n.tolist() == [len(re.findall(PLAIN[unit], t)) for t in texts]
        for _ in range(3):
            k = np.array([rng.randint(0, m) for m in n])
            assert found.cuts(k).tolist() == [len(t[: plain_cut(unit, t, i)].encode()) for t, i in zip(texts, k, strict=True)]


def test_ranks():
    classes = np.random.default_rng(1).integers(0, 8, 1000).astype(np.uint8)
    made = wavelet.WaveletMatrix(classes)
    at = np.arange(1001)
    for symbol in range(8):
        assert made.rank(symbol, at).tolist() == np.concatenate([[0], np.cumsum(classes == symbol)]).tolist()


def test_middles(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    rows = Q.op12_fill_in_middle(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        text = docs[r.doc_id] or ""
        form, low, high, output = brute.middle(r.doc_id, text)
        assert (r.n, r.form, r.output_sha256, r.restored_sha256) == (len(text), form, brute.sha(output), brute.sha(text))
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if form == "plain" else (low, high - low))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_middles_of_hard_rows(spark):
    long = "wörd 😀 " * 300_000  # spread over several frames
    texts = [None, "", "a", "😀", "x<S", "S>x", "<P>", "a<M>b", "x<<", long, *("<é\n" * k for k in range(1, 60))]
    rows = [*enumerate(texts), (3, "😀"), (None, "no id"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("n", "form", "output", "h1", "prefix_chars")})
    got = wavelet.middles_digest(df).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), brute.sha(brute.middle("" if i is None else i, t or "")[3]), brute.sha(t or "")) for i, t in rows)
    assert sorted((str(r.doc_id), r.output_sha256, r.restored_sha256) for r in got) == want
    assert wavelet.middles_digest(df.limit(0)).collect() == []
    by_word = wavelet.fill_in_middle(df.filter("doc_id = 9"), unit="word", rate=100).collect()[0]
    assert by_word.n == 600_000 and by_word.prefix_units <= by_word.prefix_chars
    back = wavelet.fill_in_middle(df, unit="line", rate=100).select(wavelet.restore(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t in rows)


def test_hash_of_doc_id():
    assert brute.middle(7, "")[0] == "plain" and hashlib.sha256(b"1:7").hexdigest()[:8] == brute.draws(7)[4]
