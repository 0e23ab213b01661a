"""Plain single-process versions of the contracts, written apart from the operators."""

import functools
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import regex


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def listed(spans, kinds):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted((s, kinds.index(k), e, k) for k, s, e in spans))


def secrets(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return out


def entropy_spans(text, classes, allowed, innocent, window=20):
    """kind:start:end of merged windows, every window's counts taken anew."""
    out = []
    for rank, (kind, (pattern, _, least)) in enumerate(classes.items()):
        for run in re.finditer(pattern, text):
            at, cut = 0, []
            for m in re.finditer(innocent, run[0]):
                cut.append((at, run[0][at : m.start()]))
                at = m.end()
            for start, piece in [*cut, (at, run[0][at:])]:
                if len(piece) < window or any(re.search(a, piece) for a in allowed):
                    continue
                hot = []
                for i in range(len(piece) - window + 1):
                    counts = Counter(piece[i : i + window]).values()
                    if -sum(c / window * math.log2(c / window) for c in counts) >= least - 1e-9:
                        if hot and i <= hot[-1][1]:
                            hot[-1][1] = i + window
                        else:
                            hot.append([i, i + window])
                out += [(run.start() + start + s, rank, run.start() + start + e, kind) for s, e in hot]
    return [(k, s, e) for s, _, e, k in sorted(out)]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def private(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def wilson(part, whole, z=1.6449):
    p = part / whole
    return (p + z * z / (2 * whole) - z * math.sqrt(p * (1 - p) / whole + z * z / (4 * whole * whole))) / (1 + z * z / whole)


def terms(texts, near=3, remove=0.59, generalise=0.42):
    """For each text the revealing terms (kind, start, end), by counting all documents."""
    word = regex.compile(r"[\p{L}\p{M}\p{N}]+")
    rank, found, n_e, n_te, n_t = ["email", "ip", "card", "phone"], [], Counter(), Counter(), Counter()
    for text in texts:
        merged = []
        for s, _, e, k in sorted((s, rank.index(k), e, k) for k, s, e in private(text)):
            if merged and s < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e, k, text[s:e]])
        places, of = [], set()
        for i, (s, e, k, m) in enumerate(merged):
            digits, numbers = re.sub("[^0-9]", "", m), [str(int(x)) for x in m.split(".")] if k == "ip" else []
            value = m.lower() if k == "email" else ".".join(numbers) if k == "ip" else digits
            group = m.lower().split("@")[-1] if k == "email" else ".".join(numbers[:2]) if k == "ip" else digits[: 6 if k == "card" else 4]
            before, after = merged[i - 1][1] if i else 0, merged[i + 1][0] if i + 1 < len(merged) else len(text)
            sides = [(before, list(word.finditer(text[before:s]))[-near:]), (e, list(word.finditer(text[e:after]))[:near])]
            for entity in ((k, "value", value), (k, "group", group)):
                of.add(entity)
                places += [(entity, w[0].lower(), by + w.start(), by + w.end()) for by, ws in sides for w in ws]
        found.append(places)
        n_e.update(of)
        n_te.update({(x[0], x[1]) for x in places})
        n_t.update({w[0] for w in word.finditer(text.lower())})
    n, out = len(texts), []
    for places in found:
        best = {}
        for entity, term, s, e in places:
            if n_t[term]:
                told = wilson(n_te[entity, term], max(n_t[term], n_te[entity, term]))
                if told > n_e[entity] / n:
                    best[s, e] = max(best.get((s, e), 0), told)
        out.append([("term_removed" if v >= remove else "term_general", *k) for k, v in best.items() if v >= generalise])
    return out


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def licenses(text):
    ws, places, labels = words(text), [], set()
    for phrase, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")):
        p = phrase.split()
        for i in range(len(ws) - len(p) + 1):
            if ws[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def license_labels(text, templates, share=0.75):
    """Labels of templates of which some window of half as many words again holds so large a share in order."""
    ws, out = words(text), set()
    for label, wanted in templates:
        wide, step = len(wanted) * 3 // 2, max(1, len(wanted) // 4)
        for at in range(0, max(1, len(ws) - wide + step), step):
            here = ws[at : at + wide]
            if sum((Counter(here) & Counter(wanted)).values()) >= share * len(wanted) and lcs(here, wanted) >= share * len(wanted):
                out.add(label)
    return out


@functools.cache
def window_levels(text, f):
    """Entropy level of every window of the padded text, each counted anew."""
    raw = text.encode() + bytes(f.PAD)
    out = []
    for i in range(len(raw) - f.W + 1):
        counts = Counter(raw[i : i + f.W]).values()
        total = sum(int(f._GAIN[:c].sum()) for c in counts)  # the operator's own fixed-point terms, so that ties fall alike
        out.append(min(max(round((6.0 - total / (f.W << 20)) * f.STEP), 0), f.LEVELS - 1))
    return raw, out


def entropy_ranks(texts, f):
    n = Counter(x for t in texts for x in window_levels(t, f)[1])
    ranks = {level: i for i, level in enumerate(sorted(range(f.LEVELS), key=lambda x: (n[x], x)))}
    return ranks | {level: f.LEVELS for level in range(f.STEP)}


def fingerprint(text, ranks, f):
    raw, level = window_levels(text, f)
    votes = Counter()
    for at in range(len(level) - f.W + 1):
        votes[min(range(at, at + f.W), key=lambda i: (ranks[level[i]], i))] += 1
    chosen = sorted(i for i, n in votes.items() if n >= f.VOTES) or [min(votes, key=lambda i: (-votes[i], i))]
    out = b""
    for a in range(0, len(chosen), f.FULL):
        bits = [0] * f.BITS
        for i in chosen[a : a + f.FULL]:
            h = np.zeros(1, np.uint64)
            for k in range(0, f.W, 8):
                h = f.mix(h ^ (np.frombuffer(raw[i + k : i + k + 8], np.uint64) + np.uint64(k // 8 + 1)))
            for k in range(f.HASHES):
                bits[int(h[0]) >> 11 * k & f.BITS - 1] = 1
        out += np.packbits(bits).tobytes()
    return ((len(chosen) - 1) % f.FULL + 1).to_bytes(2, "big") + out


def bag(text):
    ws = words(text)
    out = {}
    for i in range(max(1, len(ws) - 4) if ws else 0):
        g = tuple(ws[i : i + 5])
        out[g] = out.get(g, 0) + 1
    return out


def likeness(a, b):
    keys = a.keys() | b.keys()
    low, high = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys), sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    return low / high if high else 0.0


def classes(rows, least=0.8):
    """{doc_id: least doc_id of its class} from [(doc_id, text)], all pairs that share a shingle compared."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def join(a, b):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)

    by_text, holders, bags = {}, {}, {}
    for i, text in rows:
        if text in by_text:
            join(i, by_text[text])
            continue
        by_text[text] = i
        bags[i] = bag(text)
        for g in bags[i]:
            holders.setdefault(g, []).append(i)
    pairs = {(a, b) for ids in holders.values() for k, a in enumerate(ids) for b in ids[k + 1 :]}
    for a, b in pairs:
        if likeness(bags[a], bags[b]) >= least:
            join(a, b)
    return {i: find(i) for i, _ in rows}


def crc(ids):
    return zlib.crc32(b"".join(int(x).to_bytes(4, "little") for x in ids))


def draws(doc_id):
    digest = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    return [*(int(digest[8 * i : 8 * i + 8], 16) for i in range(4)), digest[:8]]


def middle(doc_id, text):
    """form, first and second cut, output."""
    h1, h2, h3, h4, _ = draws(doc_id)
    low, high = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    pre, mid, post = text[:low], text[low:high], text[high:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", low, high, text
    if h4 % 100 < 20:
        return "spm", low, high, f"<S>{post}<P>{pre}<M>{mid}"
    return "psm", low, high, f"<P>{pre}<S>{post}<M>{mid}"


def damaged(rows):
    """Rows (conv_id, turn, role, text) after damage."""
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repaired(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of one conversation's damaged rows, by trying every edit."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))

    @functools.cache
    def best(i, so_far, inserts):
        """Cheapest (cost, audit, lines) for rows from i on, where ``so_far`` is the role initials up to here, shortened."""
        options = [(0, "", ())] if i == len(rows) and so_far in ("", "a") else []
        for role in ("user", "assistant"):
            if inserts < 4 and (so_far, role[0]) in {("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                c, a, x = best(i, role[0], inserts + 1)
                options.append((5 + c, "I" + a, (f"{role}:", *x)))
        if i < len(rows):
            c, a, x = best(i + 1, so_far, 0)
            options.append((2 + c, "D" + a, x))
            _, _, own, text = rows[i]
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                for letter, price, role in (("K", 0, own), ("R", 1, "user"), ("R", 1, "assistant")):
                    if (so_far, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                        c, a, x = best(i + 1, role[:1], 0)
                        options.append((price + extra + c, letter + a, (f"{role}:{text}", *x)))
        return min(options) if options else (10**9, "", ())

    cost, audit, lines = best(0, "", 0)
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines))


def text_counts(text):
    """Counts of one text for the quality rules, by plain scans."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    of = lambda pattern: len(re.findall(pattern, text))
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": of(r"[#*$%&|<>]"), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again),
        "n_lines": len(lines), "n_distinct_words": len(set(words)), "n_upper": of("[A-Z]"), "n_digits": of("[0-9]"), "n_shouts": of("!"),
    }


def rule_list(rows, shares, precision, most_rules, most_conditions, least_cover):
    """Sequential covering over (counts, bad, prunes) by trying every edge on every row."""

    def value(c, share):
        top, under, _, _ = shares[share]
        return c[top] / (max(c[under], 1) if under else 1)

    def holds(rule, c):
        return all((value(c, s) >= edge) == over for s, over, edge in rule)

    def best(rows):
        bad = sum(b for _, b, _ in rows)
        edges = [(s, over, b / unit) for s, (_, _, unit, top) in shares.items() for over in (True, False) for b in range(1, top + 1)]
        least, chosen = 1e-9, None
        for s, (_, _, unit, top) in shares.items():
            values = np.array([value(c, s) for c, _, _ in rows])
            marks = np.array([b for _, b, _ in rows], bool)
            for over in (True, False):
                for e in (x[2] for x in edges if x[0] == s and x[1] == over):
                    inside = (values >= e) == over
                    p, n = int((inside & marks).sum()), int((inside & ~marks).sum())
                    gain = p * (math.log2(p / (p + n)) - math.log2(bad / len(rows))) if p else 0.0
                    if gain > least + 1e-9:
                        least, chosen = gain, (s, over, e)
        return chosen

    rules = []
    while len(rules) < most_rules:
        rule = ()
        while len(rule) < most_conditions:
            inside = [r for r in rows if not r[2] and holds(rule, r[0])]
            found = best(inside) if any(b for _, b, _ in inside) else None
            if not found:
                break
            rule = (*rule, found)
        if not rule:
            break
        tally = lambda r, prunes: [sum(b == want and holds(r, c) for c, b, p in rows if p == prunes) for want in (True, False)]
        worth = lambda p, n: (p - n) / (p + n) if p + n else -1.0
        rule = max((rule[: k + 1] for k in range(len(rule))), key=lambda r: (worth(*tally(r, True)), -len(r)))
        (a, b), (c, d) = tally(rule, True), tally(rule, False)
        if a + c < least_cover or a < precision * (a + b) or c < precision * (c + d):
            break
        rules.append(rule)
        rows = [r for r in rows if not holds(rule, r[0])]
    return rules
