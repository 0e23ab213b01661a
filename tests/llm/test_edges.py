"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import chat, fingerprint, licenses, media, neardup, packing, pieces, privacy, quality, secrets
from lodestrata.llm.queries import vocabulary
from tests.llm import brute

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30000))
ROWS = [
    (1, "plain words only, and more of them", "en", "x"),
    (1, "plain words only, and more of them", "en", "x"),
    (2, None, None, None),
    (3, "", "", ""),
    (None, "no id: password = hunter2hunter2 and a@b.co", "en", "x"),
    (4, LONG, "en", "x"),
    (5, "\U0001f600 é́ token: 'abcdefgh12345678' \U0001f600 1.2.3.4", "en", "x"),
    (6, "released under the MIT License, " * 3, "en", "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = ["spans", "score", "value", "kept", "item", "node", "bands", "part", "key", "extra", "n_chars", "piece", "text_key", "_row", "class_id", "length"]


def made(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("own") for c in CLASHING})


def labels(spark, rows=((1, 1, 0), (4, 0, 0), (6, 1, 0), (7, None, None))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "secrets": lambda s, d: secrets.secrets_digest(d),
    "fingerprints": lambda s, d: fingerprint.fingerprints(d),
    "licenses": lambda s, d: licenses.licenses_digest(d),
    "media": lambda s, d: media.media_digest(d),
    "near": lambda s, d: neardup.classes(d),
    "pieces": lambda s, d: pieces.pieces_digest(d, vocabulary("piece_bpe_32k.model")),
    "quality": lambda s, d: quality.quality_scores(d, labels(s)),
    "private": lambda s, d: privacy.private_digest(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_hard_rows(spark, name):
    rows = OPERATORS[name](spark, made(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)
    same = [r for r in rows if r.doc_id == 1]
    if name != "fingerprints":
        assert same[0] == same[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, made(spark, [])).collect() == []


def test_packing_hard_rows(spark):
    rows = packing.pack_documents(made(spark), vocabulary("byte_bpe_50k.json")).collect()
    assert sum(r.length == 1 for r in rows) == 2  # null and empty text
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack_documents(made(spark, []), vocabulary("byte_bpe_50k.json")).collect() == []


def test_chats_edges(spark):
    turns = [(1, 0, "user", "<|end|>\\lt;"), (1, 0, "user", None), (1, 1, None, "a\nb"), (1, 2, "assistant", ""), (1, 3, "assistant", "<|turn|>x"), (None, None, "assistant", "y"), (2, 5, "a|>b<|", "\\bs;")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("formatted", F.lit(2))
    back = {r.conv_id: r for r in chat.parse_chats(chat.format_chats(df)).collect()}
    assert [tuple(t) for t in back[1].turns] == [("user", ""), ("user", "<|end|>\\lt;"), ("", "a\nb"), ("assistant", ""), ("assistant", "<|turn|>x")]
    assert back[1].loss_text == "<|turn|>x" and back[None].loss_text == "y"
    assert [tuple(t) for t in back[2].turns] == [("a|>b<|", "\\bs;")]
    assert back[1].formatted.count("<|user|>") == 1  # neighbours of one role are merged
    assert chat.chats_digest(df.limit(0)).collect() == []


def test_entropy_spans(spark):
    key = "q9X2mB7vK4tZ8pL1wR5sD3fG6hJ0nY"
    texts = [f"see {key} here", "AbstractSingletonProxyFactoryBean", "01234567890123456789", f"key example{key}"]
    df = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.spans for r in secrets.secrets_digest(df).collect()}
    assert got[0] == f"entropy_base64:4:{4 + len(key)}" and got[1] == got[2] == ""
    assert got[3] == f"entropy_base64:11:{11 + len(key)}"  # only what is allowed is left out, not the run that holds it


def test_private_patterns(spark):
    texts = ["a@b.c_d@e.f", "x.y@z", "1.2.3.4.5.6.7.8", "999.1.1.1 256.1.1.1 01.002.0003.255", "4" * 5000, "4539 1488 0343 6467 4539-1488-0343-6467", "+1 (555) 123-4567 +12", "%" * 3000 + "a@b.co", "1" * 30 + ".1.1.1"]
    df = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.base_sha256 for r in privacy.private_digest(df).collect()}
    assert got == {i: brute.sha(brute.listed(brute.private(t), ["email", "ip", "card", "phone"])) for i, t in enumerate(texts)}


def test_revealing_terms_go(spark):
    rows = [(i, f"the clerk Quillon{i % 2} wrote to boss{i % 2}@corp.example today", "", "") for i in range(8)] + [(100 + i, f"the clerk met number {i} today", "", "") for i in range(400)]
    rows.append((900, "Hapax wrote to one@other.example", "", ""))
    rows += [(910 + i, f"Twofold wrote to pair{i}@two.example", "", "") for i in range(2)]  # twice, each time near the domain
    rows += [(600 + i, f"we wrote to somebody {i} and them today", "", "") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    got = {r.doc_id: r for r in privacy.sanitise(df).collect()}
    assert len(got) == len(rows) and "Quillon" not in got[0].text and "<email>" in got[0].text and "clerk" in got[0].text
    assert all(got[100 + i].text == f"the clerk met number {i} today" for i in range(400))
    assert all(r.n_chars == len(r.text) for r in got.values())
    spans = {r.doc_id: r.spans for r in privacy.private_digest(df).collect()}
    texts = [t for _, t, _, _ in rows]
    kinds = ["email", "ip", "card", "phone", "term_general", "term_removed"]
    want = [brute.listed(brute.private(t) + x, kinds) for t, x in zip(texts, brute.terms(texts), strict=True)]
    assert [spans[i] for i, _, _, _ in rows] == want
    assert any("term_removed" in x for x in want) and any("term_general" in x for x in want)
    assert "Hapax" in got[900].text and got[910].text == "<name> wrote to <email>"


def test_one_text_with_many_matches(spark):
    """Times grow with the matches of one text, not with their square; spans are those of a plain scan."""
    line = "password: 'h8Jk2LmN9qRs' q9X2mB7vK4tZ8pL1wR5sD3fG6hJ0nY Bob a@b.co at 1.2.3.4 +1 (555) 123-4567\n"
    took = {}
    for n in (2_000, 20_000):
        text = line * n
        df = spark.createDataFrame([(1, text, "", ""), (2, "x", "", "")], SCHEMA)
        start = time.perf_counter()
        found = {r.doc_id: r for r in secrets.secrets_digest(df).collect()}
        private = {r.doc_id: r for r in privacy.private_digest(df).collect()}
        clean = {r.doc_id: r.text for r in privacy.sanitise(df).collect()}
        took[n] = time.perf_counter() - start
        assert found[1].base_sha256 == brute.sha(brute.listed(brute.secrets(text), ["assign", "access", "hex"]))
        assert private[1].base_sha256 == brute.sha(brute.listed(brute.private(text), ["email", "ip", "card", "phone"]))
        assert not brute.private(clean[1]) and clean[2] == "x"
    assert took[20_000] < 60


def test_long_conversation(spark):
    turns = [(1, i, ("user", "assistant", "assistant")[i % 3], f"<{i}> \U0001f600" * (i % 5)) for i in range(20_000)]
    r = chat.chats_digest(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()[0]
    said = "".join(t for _, _, role, t in turns if role == "assistant")
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(said), brute.sha(said))
    assert r.turns_sha256 == brute.sha("".join(f"{role}\n{t}\n" for _, _, role, t in turns))


def test_chats_without_id_stay_apart(spark):
    turns = spark.createDataFrame([(None, 1, "user", "a"), (None, 1, "user", "a"), (None, 2, "assistant", "b")], "conv_id long, turn long, role string, text string")
    assert sorted((r.n_turns, r.loss_chars) for r in chat.chats_digest(turns).collect()) == [(1, 0), (1, 0), (1, 1)]


def test_packing_ids_with_added_tokens(spark):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x<|endoftext|>\n\n  y <|endofte", "  \n", "\U0001f600\x00", " " * 5000 + "a", "I'm we'll It'S 中文\u3000x"]
    df = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)
    tokenizer = Tokenizer.from_file(path)
    for r in packing.token_pieces(df, path).filter("start = 0 and length < 1024").collect():
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, packing.END]
        if len(ids) <= 1024:
            assert (r.length, r.ids_crc32) == (len(ids), brute.crc(ids))
    assert packing.encoder(path)(" " * 2_000_000 + "a") == tokenizer.encode(" " * 2_000_000 + "a", add_special_tokens=False).ids


def test_fingerprints_of_a_hot_id(spark):
    """A third of all rows without an id: parts are cut by text, and each document still meets the next one."""
    rows = [(None if i % 3 == 0 else i, f"text number {i} of some " + "words " * (i % 7), "", "") for i in range(600)]
    df = made(spark, rows)
    parts = fingerprint._followed(df).groupBy("part").count().collect()
    assert max(r["count"] for r in parts) < 150
    got = fingerprint.fingerprints(df).collect()
    assert sorted(r.fingerprint for r in got) and len(got) == 600
    order = [t for i, t, _, _ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])]
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for text, after, i in zip(order, order[1:], sorted(by_id)):
        half = len(text) // 2
        assert by_id[i].edited_sha256 == brute.sha(text[: len(text) - half] + after[:half])


def test_license_alignment(spark):
    known = {label: " ".join(ws) for _, phrase, label, ws in licenses._templates() if not phrase}
    mit = known["bsd"].split()
    cut = " ".join(mit[:8] + ["some", "more", "words"] + mit[9:])
    scattered = " ".join(w + " " + " ".join(f"x{i}y{j}" for j in range(12)) for i, w in enumerate(mit))
    rows = [(1, cut, "", ""), (2, scattered, "", ""), (3, "of the " * 3000, "", ""), (4, " ".join(mit[:6]) + " zz " * 30 + known["bsd"], "", "")]
    got = {r.doc_id: r for r in licenses.licenses_digest(made(spark, rows)).collect()}
    assert got[1].labels == "bsd" and got[4].labels == "bsd" and got[4].score == 1.0 and got[2].labels == got[3].labels == ""
    assert licenses.common(list("abcbdab"), list("bdcaba")) == brute.lcs(list("abcbdab"), list("bdcaba")) == 4


def test_jpeg_slow_and_fast_agree():
    rng = np.random.default_rng(3)
    for n in (64, 640, 5000):
        data = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        file = media.encode([data])[0]
        fast, slow = media.decode(file), media.decode(file, fast=False)
        assert all((fast["coef"][c] == slow["coef"][c]).all() for c in fast["coef"])
        assert media.payload(fast)[:n] == data
        assert media.to_rgb(fast).shape == (fast["high"], fast["wide"], 3)


def test_long_text_in_frames(spark):
    text = "".join(chr(32 + i * 7919 % 90) for i in range(3 * media.FRAME + 1000))
    r = media.media_columns(spark.createDataFrame([(1, text, "", ""), (2, None, "", "")], SCHEMA)).orderBy("doc_id").collect()
    want = text.encode() + bytes(-len(text) % 64)
    assert (r[0].payload_bytes, r[0].payload_sha256) == (len(want), hashlib.sha256(want).hexdigest()) and len(r[0].pictures) == 4 and len(r[1].pictures) == 1
    assert all(len(p.rgb) == p.height * p.width * 3 for p in r[0].pictures)


def test_media_feature_brute_force(spark):
    """Pixels by the plain double sum of the inverse transform, block by block, from the bit-by-bit decoder's coefficients."""
    text = "Plain words, and a few more of them: é. " * 9
    r = media.media_columns(spark.createDataFrame([(1, text, "", "")], SCHEMA)).first()
    f = media.decode(r.media, fast=False)
    scale = lambda u: np.sqrt(0.5) if u == 0 else 1.0
    planes = {}
    for c, (_, across, stride, down, h, _) in f["grid"].items():
        plane = np.zeros((down * 8, stride * 8))
        for b, zz in enumerate(f["coef"][c]):
            block = np.zeros(64)
            block[media.ZIGZAG] = zz
            block = block.reshape(8, 8)
            for y in range(8):
                for x in range(8):
                    total = sum(scale(u) * scale(v) * block[v, u] * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16) for u in range(8) for v in range(8))
                    plane[b // stride * 8 + y, b % stride * 8 + x] = total / 4 + 128
        planes[c] = plane if h == 2 else plane.repeat(2, 0).repeat(2, 1)
    y, cb, cr = planes[1], planes[2] - 128, planes[3] - 128
    rgb = np.clip(np.rint(np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], 2)), 0, 255).astype(int)
    own = np.frombuffer(r.pictures[0].rgb, np.uint8).reshape(r.pictures[0].height, r.pictures[0].width, 3).astype(int)
    assert np.abs(own - rgb).max() <= 1
    assert r.feature == media.feature(media.tally(own.astype(np.uint8)))


def test_trees_walk_as_one_row_at_a_time():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(quality.NAMES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality.Trees.fit(x, y)
    for row, score in zip(x, model.score(x), strict=True):
        margin = model.prior
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            margin += leaf[node - len(feature)]
        assert score == pytest.approx(1 / (1 + np.exp(-margin)))
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.95


def test_training_takes_one_row_of_each_id(spark):
    """Ids that repeat, in the table and among the labels, count once; scores don't depend on their order."""
    rows = [(i % 40, ("good words here and there %d" if i % 2 else "xx!! yy!! %d") % (i % 40), "", "") for i in range(400)]
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] * 3, "doc_id long, quality int, toxic int")
    one, two = (quality.train(spark.createDataFrame(r, SCHEMA), marks) for r in (rows, rows[::-1]))
    assert (one.leaf == two.leaf).all() and (one.feature == two.feature).all()


def test_jpeg_flat_picture():
    """A picture with only a DC coefficient is one grey level everywhere."""
    picture = media.decode(media.encode([bytes(64)])[0])
    for c in picture["coef"]:
        picture["coef"][c][:] = 0
    picture["coef"][1][:, 0] = -240
    assert (media.to_rgb(picture) == 98).all()


def test_bag_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    shared, a, b = (rng.integers(1, 2**63, n, dtype=np.uint64) for n in (60, 20, 30))
    wa, wb = np.r_[np.arange(1, 61) % 7 + 1, np.full(20, 3)], np.r_[np.arange(1, 61) % 5 + 1, np.full(30, 2)]
    of = np.r_[np.zeros(80, np.int64), np.ones(90, np.int64)]
    sig = neardup.bag_signatures(of, np.r_[shared, a, shared, b], np.r_[wa, wb], 2, 4096)
    low, high = np.minimum(wa[:60], wb[:60]).sum(), np.maximum(wa[:60], wb[:60]).sum() + 60 + 60
    assert (sig[0] == sig[1]).mean() == pytest.approx(low / high, abs=0.03)


def test_pieces_brute_force():
    model = pieces.loaded(vocabulary("piece_bpe_32k.model"))
    for text in ("Hello  world", "antidisestablishmentarianism naïve 日本\n\t", "\U0001f600x", " "):
        ids = model.encode([text])[0]
        assert model.decode(ids) == text
        total = 0.0
        for word in ["▁" + text.replace(" ", "▁")]:
            best = [0.0] + [None] * len(word)
            for end in range(1, len(word) + 1):
                options = [best[at] + model.score[word[at:end]] for at in range(end) if word[at:end] in model.score]
                best[end] = max(options, default=best[end - 1] + model.unknown)
            total += best[-1]
        known = [i for i in ids if model.names[i] in model.score]
        missing = sum(c not in model.ids for c in "▁" + text.replace(" ", "▁"))
        assert sum(model.score[model.names[i]] for i in known) + missing * model.unknown == pytest.approx(total)


def test_piece_ids_brute_force(spark):
    """Ids of whole texts by the plain recurrence over all ends and lengths: largest sum, of equal ones the longest last piece."""
    path = vocabulary("piece_bpe_32k.model")
    model = pieces.loaded(path)
    longest = max(map(len, model.score))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) between 1 and 1200")
    for r in pieces.encode_pieces(docs, path).join(docs.select("doc_id", "text"), "doc_id").collect():
        text = "▁" + r.text.replace(" ", "▁")
        best, back = [0.0], [0]
        for end in range(1, len(text) + 1):
            options = [(best[at] + model.score[text[at:end]], end - at) for at in range(max(0, end - longest), end) if text[at:end] in model.score]
            if text[end - 1] not in model.score:
                options.append((best[-1] + model.unknown, 1))
            score, size = max(options)
            best.append(score)
            back.append(end - size)
        ids, end = [], len(text)
        while end:
            piece = text[back[end] : end]
            ids = ([model.ids[piece]] if piece in model.ids else [model.byte[b] for b in piece.encode()]) + ids
            end = back[end]
        assert r.ids == ids, r.doc_id


def test_stages_with_hard_rows(spark):
    """Nulls, repeated rows, clashing columns and empty tables in every stage of the pipeline; all but the last return the columns of their input."""
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    rows = [*ROWS, (9, "mail to someone@corp.example or +1 (555) 123-4567 " + "with plain words " * 20, None, None), (None, None, None, None), (None, "", None, None)]
    df = made(spark, rows)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, df, sf)
        assert out.columns == df.columns and out.schema["doc_id"] == df.schema["doc_id"], name
        kept = out.collect()
        assert len(kept) <= len(rows) and {r.doc_id for r in kept} <= {r[0] for r in rows}
        if name == "pii":
            assert len(kept) == len(rows) and not any(brute.private(r.text) for r in kept if r.text) and sum(r.text is None for r in kept) == 2
        if name == "near_dedup":
            assert sorted(r.text or "" for r in kept) == sorted({r[1] or "" for r in rows})
        assert stage(spark, made(spark, []), sf).collect() == []
    packed = P.STAGES[-1][1](spark, df, sf).collect()
    assert sum(r.piece == 0 for r in packed) == len(rows) and P.STAGES[-1][1](spark, made(spark, []), sf).collect() == []


def test_best_fit_takes_the_fullest_bin():
    bins, offsets, fills = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8] and fills.tolist() == [10, 10]


def test_packing_mixes_lengths_beyond_a_run(spark, monkeypatch):
    """Items that only fit those of the other length, many times more than RUN of them."""
    monkeypatch.setattr(packing, "RUN", 500)
    items = spark.range(4000).select(F.col("id").alias("item"), F.when(F.col("id") % 2 == 0, 700).otherwise(324).cast("long").alias("length"))
    rows = packing.place(items).collect()
    assert len(rows) == 4000 and len({(r.sequence_id, r.offset) for r in rows}) == 4000
    assert len({r.sequence_id for r in rows}) <= 2000 * 1.03 + 1


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as P

    sf, tables = "/root/testdata/sf0.001", {}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = P.good_quality(spark, docs, sf)
    assert kept.columns == docs.columns
    tables["quality"] = {r.doc_id: r.text for r in kept.collect()}
    scores = {r.doc_id: r.score for r in quality.quality_scores(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert tables["quality"].keys() == {i for i, s in scores.items() if s >= 0.3}
    one = P.no_near_duplicates(spark, kept, sf)
    left = {r.doc_id: r.text for r in one.collect()}
    root = brute.classes(sorted(tables["quality"].items()))
    assert left.keys() == set(root.values())
    clean = P.no_personal_data(spark, one, sf)
    assert clean.columns == docs.columns
    got = {r.doc_id: r for r in clean.collect()}
    assert got.keys() == left.keys() and all(not brute.private(r.text) for r in got.values())
    assert all(got[i].text == t for i, t in left.items() if not brute.private(t))
    assert {r.doc_id for r in P.packed(spark, clean, sf).collect()} == got.keys()


def test_group_of_near_copies_and_common_passage(spark):
    """Copies whose likeness straddles the threshold, and documents that only share a passage: classes as by all pairs."""
    rng = np.random.default_rng(11)
    word = lambda: f"v{rng.integers(0, 10**6)}"
    base, passage, rows = [word() for _ in range(150)], [word() for _ in range(60)], []
    for i in range(80):
        ws = list(base)
        for at in rng.integers(0, len(ws), rng.integers(0, 9)):
            ws[at] = word()
        rows.append((i, " ".join(ws), "", ""))
    for i in range(80, 140):
        rows.append((i, " ".join([word() for _ in range(int(rng.integers(5, 90)))] + passage), "", ""))
    rows += [(200 + i, t, "", "") for i, (_, t, _, _) in enumerate(rows[:20])]
    got = {r.doc_id: r.class_id for r in neardup.classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute.classes([(i, t) for i, t, _, _ in rows])


def test_near_duplicates_where_ids_repeat_or_miss(spark):
    """Texts count by text: under one doc_id, under none, and as repeated rows."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(120)) for x in "abcd")
    near = lambda t: t + " end"
    rows = [(3, a), (7, a), (7, b), (8, near(b)), (None, c), (None, c), (None, d), (9, near(d)), (5, d + " x y"), (11, "own"), (11, "own"), (12, near(c))]
    df = made(spark, [(i, t, "", "") for i, t in rows])
    got = {(r.doc_id, bytes(r.text_key)): r.class_id for r in neardup.near_duplicates(df).collect()}
    by = lambda i, t: got[i, hashlib.md5(t.encode()).digest()]
    assert by(3, a) == by(7, a) == 3 and by(7, b) == by(8, near(b)) == 7
    assert by(None, c) == by(12, near(c)) == 12 and by(None, d) == by(9, near(d)) == by(5, d + " x y") == 5 and by(11, "own") == 11
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(3, a), (7, b), (12, near(c)), (5, d + " x y"), (11, "own")])
    alone = made(spark, [(None, c, "", ""), (None, c, "", ""), (None, a, "", ""), (7, a + " z", "", ""), (7, b, "", ""), (7, d, "", "")])
    left = sorted(r.text for r in neardup.keep_one(alone).collect())
    assert left in (sorted([a, b, c, d]), sorted([a + " z", b, c, d]))
    assert len({r.class_id for r in neardup.classes(alone).collect()}) == 4


def test_crowded_bands(spark, monkeypatch):
    """A template with own words at its end, about as long as the threshold allows: bands split by shingles give the classes of all pairs."""
    rng = np.random.default_rng(5)
    word = lambda: f"v{rng.integers(0, 10**6)}"
    rows = []
    for first, size in ((0, 90), (200, 60)):
        template = [word() for _ in range(size)] + ["again and again it says so"] * 3
        for i in range(first, first + 70):
            rows.append((i, " ".join(template + [word() for _ in range(int(rng.integers(0, 30)))]), "", ""))
    rows += [(400 + i, f"{t} {word()}", "", "") for i, (_, t, _, _) in enumerate(rows[::5])]
    expected = brute.classes([(i, t) for i, t, _, _ in rows])
    assert 3 < len(set(expected.values())) < len(rows)
    listed = []
    monkeypatch.setattr(neardup, "overlaps", lambda pairs, of=neardup.overlaps: listed.append(pairs.count()) or of(pairs))
    for crowd in (2, 10**6):
        monkeypatch.setattr(neardup, "CROWD", crowd)
        got = {r.doc_id: r.class_id for r in neardup.classes(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == expected
    half = len(listed) // 2
    assert listed[half - 1] <= listed[-1]
