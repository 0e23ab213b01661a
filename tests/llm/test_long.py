"""Texts in blocks give what texts whole give, and a text of 60 MB stays under 1 GB of memory."""

import subprocess
import sys

import numpy as np
import pytest

from lodestrata.llm import base, fingerprint, neardup, quality

RNG = np.random.default_rng(7)


def text(n, words=3000):
    """Bytes of words, blanks, line ends and repeated lines, with one very long word in the middle."""
    known = ["".join(chr(97 + c) for c in RNG.integers(0, 26, RNG.integers(1, 24))) + ["", "É", "!", " 1"][RNG.integers(0, 4)] for _ in range(words)]
    out = " ".join(known[i] + ("\n" if i % 11 == 0 else "") for i in RNG.integers(0, words, n // 13))
    return (out[: n // 3] + "\nsame line here\nsame line here\n" + "x" * (n // 10) + out[n // 3 :]).encode()


def arrays(raw):
    return np.frombuffer(raw, np.uint8), np.array([0, len(raw)])


@pytest.mark.parametrize("block", [97, 1000, 4096])
def test_words_in_blocks(monkeypatch, block):
    rows = [text(20_000), b"", b"abc", text(3000), b"x" * 5000, b"y" * 300, b" "]
    raw, offsets = np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0, *map(len, rows)])
    whole = base.words(raw, offsets)
    monkeypatch.setattr(base, "WORD_BLOCK", block)
    for a, b in zip(whole, base.words(raw, offsets), strict=True):
        assert a.tolist() == b.tolist()
    h, cuts = base.word_hashes(raw, offsets)
    assert h.tolist() == whole[0].tolist() and cuts.tolist() == whole[3].tolist()
    g = base.grams(h, cuts, 5)
    monkeypatch.undo()
    assert [x.tolist() for x in base.grams(whole[0], whole[3], 5)] == [x.tolist() for x in g]


@pytest.mark.parametrize("block", [150, 1000, 5000])
def test_statistics_and_fingerprints_in_blocks(monkeypatch, block):
    for raw in (text(30_000), b"\n\n a\nb b\n" * 900, b"...." * 900, b"w" * 9000, "ü w\n".encode() * 2000):
        stats, ranks = quality.statistics(*arrays(raw)), RNG.permutation(fingerprint.LEVELS)
        print_, (of, g, n) = fingerprint.digests([raw], ranks), neardup.shingles(*arrays(raw))
        sig = neardup.bag_signatures(of, g, n, 1)
        monkeypatch.setattr(base, "WORD_BLOCK", block)
        monkeypatch.setattr(quality, "BLOCK", block)
        monkeypatch.setattr(fingerprint, "BLOCK", block)
        monkeypatch.setattr(neardup, "BAG_BLOCK", block)
        np.testing.assert_allclose(quality.statistics(*arrays(raw)), stats, rtol=1e-12)
        assert fingerprint.digests([raw], ranks) == print_
        assert neardup.bag_signatures(of, g, n, 1).tolist() == sig.tolist()
        two = neardup.shingles(np.frombuffer(raw + b"a b c d e f", np.uint8), np.array([0, len(raw), len(raw) + 11]))
        assert g.tolist() == two[1][two[0] == 0].tolist() and n.tolist() == two[2][two[0] == 0].tolist()
        monkeypatch.undo()


@pytest.mark.parametrize("work", ["neardup.bag_signatures(*neardup.shingles(raw, rows), 1)", "quality.statistics(raw, rows)", "fingerprint.digests([raw.tobytes()], np.arange(fingerprint.LEVELS))", "base.grams(*base.word_hashes(raw, rows), 2)", "base.words(raw, rows)"])
def test_sixty_megabytes_in_one_gigabyte(work):
    """Peak memory of a fresh process that works on one text of 60 MB, half of it distinct words."""
    code = f"""
import resource, numpy as np
from lodestrata.llm import base, fingerprint, neardup, quality
part = (" ".join("w%dx" % (i * 7919 % 4000037) for i in range(3_000_000)) + "\\n").encode()
raw = np.frombuffer((part + part)[:60_000_000].ljust(60_000_000, b"."), np.uint8)
rows = np.array([0, len(raw)])
del part
{work}
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 1_000_000, out.stdout
