"""Every registered query against a brute-force version over a whole small table."""

import base64
import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import queries as Q
from lodestrata.llm import fingerprint, licenses, privacy, secrets
from lodestrata.llm.base import table
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


def by_id(df, key="doc_id"):
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: r for r in rows}


def test_secrets(spark, docs):
    got = by_id(Q.op1_secret_scans(spark, SF))
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        want = brute.secrets(text)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, _, _ in want) for kind in ("assign", "access", "hex"))
        text_form = brute.listed(want, ["assign", "access", "hex"])
        assert r.base_sha256 == brute.sha(text_form)
        extra = brute.entropy_spans(text, secrets.CLASSES, secrets.ALLOWED, secrets.INNOCENT)
        assert r.spans == brute.listed(want + extra, ["assign", "access", "hex", *secrets.CLASSES])


def test_private(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    got = by_id(Q.op9_pii(spark, sf))
    assert got.keys() == docs.keys()
    kinds = ["email", "ip", "card", "phone"]
    for (i, text), extra in zip(docs.items(), brute.terms(list(docs.values())), strict=True):
        want = brute.private(text)
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in want) for kind in kinds)
        assert r.base_sha256 == brute.sha(brute.listed(want, kinds))
        assert r.spans == brute.listed(want + extra, [*kinds, "term_general", "term_removed"])
        if not want:
            assert r.spans == ""
    assert any("term_general" in r.spans for r in got.values())  # none is met often enough there to be removed; planted rows are, in test_edges


def test_private_terms_do_not_depend_on_the_size_of_the_table(spark):
    """Rows unlike all others, twenty times as many, leave every span as it is."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    more = spark.range(20_000).select((F.col("id") + 10**9).alias("doc_id"), F.lit("zz").alias("text"))
    spans = lambda df: {r.doc_id: r.spans for r in privacy.private_digest(df).filter("doc_id < 1000000000").collect()}
    own = spans(docs)
    assert own == spans(docs.unionByName(more)) and any("term_" in x for x in own.values())


def test_licenses(spark, docs):
    got = by_id(Q.op4_license_scans(spark, SF))
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(text)
        found = brute.license_labels(text, [(label, ws) for _, phrase, label, ws in licenses._templates() if not phrase])
        assert set(r.labels.split(",")) - {""} == found | (set(r.base_labels.split(",")) - {""})
        assert 0 <= r.score <= 1 and (r.score >= licenses.SHARE) == bool(r.labels)


def test_fingerprints(spark, docs):
    got = by_id(Q.op2_document_fingerprints(spark, SF))
    assert got.keys() == docs.keys()
    ids, ranks = sorted(docs), brute.entropy_ranks(docs.values(), fingerprint)
    prints = {t: brute.fingerprint(t, ranks, fingerprint) for t in set(docs.values())}
    for at, i in enumerate(ids):
        text, after = docs[i], docs[ids[(at + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == brute.sha(edited)
        if len(text) > 5000:  # the plain version is slow
            assert r.fingerprint == base64.b64encode(prints[text]).decode()
            continue
        own, other, following = prints[text], brute.fingerprint(edited, ranks, fingerprint), prints[after]
        assert (r.fingerprint, r.edited_fingerprint) == tuple(base64.b64encode(x).decode() for x in (own, other))
        assert (r.near_edited, r.near_next) == (fingerprint.likeness(own, other), fingerprint.likeness(own, following))
    long = [r for i, r in got.items() if len(docs[i]) > 3000]
    assert sum(r.near_edited for r in long) / len(long) > 0.3 > 0.1 > sum(r.near_next for r in long) / len(long)


def test_chats(spark):
    got = by_id(Q.op3_chat_formatting(spark, SF), "conv_id")
    turns = defaultdict(list)
    for r in table(spark, SF, "conversations").collect():
        turns[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    said = r"\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    assert got.keys() == turns.keys()
    for i, rows in turns.items():
        rows.sort()
        r = got[i]
        loss = "".join(t for _, role, t in rows if role == "assistant")
        assert r.n_turns == len(rows)
        assert r.turns_sha256 == brute.sha("".join(f"{role}\n{t}\n" for _, role, t in rows))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), brute.sha(loss))


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(Q.ORACLES[name])
    names = [c[0] for c in want.description]
    df = Q.QUERIES[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r) for r in df.select(names).collect()) == sorted(want.fetchall())


def test_media(spark, docs):
    got = by_id(Q.op5_media_columns(spark, SF))
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        raw = text.encode()
        want = raw + bytes(-len(raw) % 64 if raw else 64)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(want))
        assert r.payload_sha256 == hashlib.sha256(want).hexdigest() and r.tail_crc32 == zlib.crc32(want[-64:])
        assert r.media_bytes >= len(want)


def test_near_duplicates(spark, docs):
    got = by_id(Q.op6_minhash_near_dedup(spark, SF))
    assert {i: r.class_id for i, r in got.items()} == brute.classes(sorted(docs.items()))


def test_pieces(spark, docs):
    got = by_id(Q.op7_sentencepiece(spark, SF))
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        r = got[i]
        assert (r.n_chars, r.decoded_chars) == (len(text), len(text))
        assert r.decoded_sha256 == brute.sha(text.replace("▁", " "))


def test_quality(spark, docs):
    sf = "/root/testdata/sf0.1"
    got = by_id(Q.op8_quality_classifier(spark, sf))
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    held = {i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    right = sum(got[i].predicted == labels[i] for i in held)
    assert right / len(held) > 0.95


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    rows = Q.op10_best_fit_packing(spark, SF).collect()
    tokenizer = Tokenizer.from_file(Q.vocabulary("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == docs.keys()
    total = 0
    for i, text in docs.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        total += len(ids)
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 1024)))
        assert [r.start for r in own] == [0, *[sum(r.length for r in own[:k]) for k in range(1, len(own))]]
        assert sum(r.length for r in own) == len(ids) and all(r.length == 1024 for r in own[1:])
        assert all(r.ids_crc32 == brute.crc(ids[r.start : r.start + r.length]) for r in own)
    for members in sequences.values():
        members.sort(key=lambda r: r.offset)
        assert [r.offset for r in members] == [sum(m.length for m in members[:k]) for k in range(len(members))]
        assert sum(m.length for m in members) <= 1024
    assert len(sequences) <= -(-total // 1024) * 1.03 + 1
