"""Quality rules against plain counts and plain sequential covering."""

import random
import zlib

import xxhash
from pyspark.sql import functions as F

from lodestrata.llm import queries as Q
from lodestrata.llm import rules
from lodestrata.llm.base import table
from tests.llm import brute


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def base(c):
    return c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]


def test_rules(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    counts = {i: brute.text_counts(t) for i, t in docs.items()}
    taught = [(counts[i], q == 0, xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), 42) - (1 << 64 if xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), 42) >> 63 else 0)) for i, q in labels.items() if i in docs and not held(i) and not base(counts[i])]
    taught = [(c, bad, h % 3 == 0) for c, bad, h in taught]
    want = brute.rule_list(taught, rules._SHARES, rules.PRECISION, rules.RULES, rules.CONDITIONS, rules.LEAST_COVER)
    assert want
    kept_counts = rules.text_counts(table(spark, sf, "documents"), ["doc_id"])
    learned = rules.learn(kept_counts, table(spark, sf, "labels"))
    assert [tuple((c.share, c.over, c.edge) for c in r) for r in learned] == want
    got = {r.doc_id: r for r in Q.op11_quality_rules(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for i, c in counts.items():
        r = got[i]
        assert tuple(r[k] for k in rules.COUNTS[:5]) == tuple(c[k] for k in rules.COUNTS[:5])
        share = lambda s, c=c: c[rules._SHARES[s][0]] / (max(c[rules._SHARES[s][1]], 1) if rules._SHARES[s][1] else 1)
        fired = next((k for k, rule in enumerate(want, 1) if all((share(s) >= e) == over for s, over, e in rule)), 0)
        assert (r.base_failed, r.rule, r.kept) == (base(c), fired, not base(c) and not fired)


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in Q.op11_quality_rules(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    seen = [i for i in labels if held(i) and not got[i].base_failed]
    good = [i for i in seen if labels[i] == 1]
    bad = [i for i in seen if labels[i] == 0]
    assert sum(got[i].kept for i in good) / len(good) > 0.99
    assert sum(not got[i].kept for i in bad) / len(bad) > 0.9


def test_hard_rows(spark):
    rng = random.Random(5)
    long = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    over_blocks = "a\tb  c " * 40_000  # blocks end within it, every window repeats
    texts = [None, "", " \n\t", "é😀 | ü\n\né😀 | ü", long, over_blocks, "a b c d e f a b c d e", "x " * 9, "x" * 70_000 + " y", *(" ".join(rng.choice("ab") + rng.choice(["", "\n"]) for _ in range(rng.randint(4, 60))) for _ in range(60))]
    rows = [*enumerate(texts), (3, texts[3]), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("words", "n_words", "kept", "windows", "lines", "bad")})
    got = rules.text_counts(df, ["doc_id"]).collect()
    key = lambda i, c: (str(i), *(c[k] for k in rules.COUNTS))
    assert sorted(key(r.kept.doc_id, r) for r in got) == sorted(key(i, brute.text_counts(t or "")) for i, t in rows)
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    judged = rules.rules_digest(df, labels).collect()
    assert len(judged) == len(rows) and all(r.kept != r.base_failed for r in judged)  # no rule without labels
    assert sorted(map(str, rules.keep_good(df, labels).collect())) == sorted(map(str, df.filter(F.col("doc_id").isin([r.doc_id for r in judged if r.kept])).collect()))
    assert rules.rules_digest(df.limit(0), labels.limit(0)).collect() == []


def test_native(spark):
    plan = Q.op11_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
