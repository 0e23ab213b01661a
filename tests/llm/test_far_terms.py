"""Revealing terms far from a match, against counting all pairs in all texts."""

import re
from collections import Counter

import regex

from lodestrata.llm import privacy
from tests.llm import brute
from tests.llm.test_edges import SCHEMA

KINDS = ["email", "ip", "card", "phone", "term_general", "term_removed"]


def far_terms(texts, remove=0.59, generalise=0.42):
    """For each text {(start, end): disclosure} of all its words with all its mail entities; copies of texts with matches count once."""
    def of(text):
        mails = [(s, e) for k, s, e in brute.private(text) if k == "email"]
        entities = {x for s, e in mails for x in (text[s:e].lower(), "@" + text[s:e].lower().split("@")[-1])}
        ends = [0, *[e for _, e in mails]]
        gaps = [(a, text[a:b]) for a, b in zip(ends, [*[s for s, _ in mails], len(text)], strict=True)]
        return entities, [(w[0].lower(), a + w.start(), a + w.end()) for a, part in gaps for w in regex.finditer(privacy.TERM, part)]

    n, n_t, n_e, n_te, seen = 0, Counter(), Counter(), Counter(), set()
    for text in texts:
        entities, words = of(text)
        if entities and text in seen:
            continue
        seen.add(text)
        n += 1
        terms = {w for w, _, _ in words}
        n_t.update(set(regex.findall(privacy.TERM, text.lower())))
        n_e.update(entities)
        n_te.update((e, t) for e in entities for t in terms)
    out = []
    for text in texts:
        entities, words = of(text)
        best = {}
        for t, s, e in words:
            for x in entities:
                told = brute.wilson(n_te[x, t], max(n_t[t], n_te[x, t]))
                if told >= generalise and told > n_e[x] / n:
                    best[s, e] = max(best.get((s, e), 0), told)
        out.append([("term_removed" if v >= remove else "term_general", *k) for k, v in best.items()])
    return out


def test_terms_far_from_a_match_are_judged(spark):
    far = "and so on through many more plain words of no account whatever until at last"
    texts = [f"Quillon sat there {far} item {i} came, write to boss@corp.example or a{i}@other{i % 3}.example about it, {far} Zebulon" for i in range(6)]
    texts += [f"Twofold {far} part {i} for two@pair.example" for i in range(2)]
    texts += [f"Lonely {far} lone@copy.example and nothing {far} Solitary"] * 5  # copies of one text are one meeting
    texts += [f"plain {far} text {i}" for i in range(60)] + ["Twice plain", "Zebulon"] + ["", "x"]
    df = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.spans for r in privacy.private_digest(df).collect()}
    strength = {"term_general": 0, "term_removed": 1}
    want = []
    for text, near, whole in zip(texts, brute.terms(texts), far_terms(texts), strict=True):
        best = {}
        for k, s, e in near + whole:
            best[s, e] = max(best.get((s, e), k), k, key=strength.get)
        want.append(brute.listed(brute.private(text) + [(k, s, e) for (s, e), k in best.items()], KINDS))
    assert [got[i] for i in range(len(texts))] == want
    assert got[0].startswith("term_removed:0:7,") and "term_general" in got[0] and got[6].startswith("term_general:0:7,")
    assert not re.search("term_[a-z]+:0:", got[8]) and got[20] == ""
