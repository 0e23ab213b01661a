"""Secret scans with DataFrame functions only: fixed patterns, and windows of high entropy per character class.

Candidate strings are maximal runs of a character class, cut at allow-listed substrings; those that an
allow-list pattern matches whole give no entropy span. A window of WINDOW characters slides over each
candidate, and its Shannon entropy follows from counts, held as one character per member of the class,
of which each step changes two: that of the character that enters and that of the one that leaves. Windows at or over
the class's threshold that overlap or touch merge into spans. Long candidates are scanned in pages, each
with the WINDOW - 1 characters after it. Spans of the fixed patterns always stay.

Null text is empty text. Empty text and an empty table give no spans. Every row is scanned alone and
whole, in time linear in its length and its matches, so repeated rows, ties and hot sources cost what
their bytes cost; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import PAGE, as_spans, joined, let, located, span_text

ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A failing run holds no passing one, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

WINDOW = 20
#: kind -> (run pattern, alphabet, least entropy in bits of a window of 20)
CLASSES = {
    "entropy_hex": (r"[0-9a-f]{20,}", "0123456789abcdef", 3.0),
    "entropy_base64": (r"[A-Za-z0-9+/_=-]{20,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.8),
    "entropy_upper_hex": (r"[0-9A-F]{20,}", "0123456789ABCDEF", 3.0),
}
#: Candidates that are no secrets: plain words, numbers, paths and joined words, UUIDs.
ALLOWED = (
    r"^[A-Za-z]+$",
    r"^[0-9]+$",
    r"^[A-Za-z]+([/_=-]+[A-Za-z]*)+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)
#: Substrings that are in no secret: samples, counting sequences.
INNOCENT = r"(?i)example|sample|placeholder|changeme|dummy|redacted|0123456789|abcdefghij|qwertyuiop"
#: Counts 0..WINDOW as characters.
_DIGITS = "".join(chr(65 + c) for c in range(WINDOW + 1))


def _hot_windows(page: Column, alphabet: str, least: float) -> Column:
    """array<struct<s:int,e:int>>: merged windows of ``page``, which is no longer than PAGE + WINDOW, with at least ``least`` bits of entropy."""
    # c log2 c for c = 0..WINDOW; the entropy of a window is log2(WINDOW) - sum(c log2 c) / WINDOW
    weigh = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])
    weight = lambda c: F.get(weigh, c)
    count = lambda counts, k: F.ascii(F.substring(counts, k, F.lit(1))) - 65
    put = lambda counts, k, c: F.overlay(counts, F.substring(F.lit(_DIGITS), c + 1, F.lit(1)), k, F.lit(1))
    codes = F.transform(F.filter(F.split(page, ""), lambda ch: ch != ""), lambda ch: F.call_function("instr", F.lit(alphabet), ch))
    steps = lambda codes: F.zip_with(codes, F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW), codes), F.lit(1), F.size(codes)), lambda i, o: F.struct(i.alias("enters"), o.alias("leaves")))
    zero = F.struct(F.lit(0).alias("at"), F.lit("A" * len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))

    def leave(acc: Column, k: Column) -> Column:
        c = count(acc["counts"], k)
        return F.when(k == 0, acc).otherwise(F.struct(acc["at"].alias("at"), put(acc["counts"], k, c - 1).alias("counts"), (acc["sum"] + weight(c - 1) - weight(c)).alias("sum"), acc["out"].alias("out")))

    def enter(acc: Column, k: Column) -> Column:
        c = count(acc["counts"], k)
        total, end = acc["sum"] + weight(c + 1) - weight(c), acc["at"] + 1
        high = (end >= WINDOW) & (F.lit(math.log2(WINDOW)) - total / WINDOW >= least - 1e-9)
        last = F.try_element_at(acc["out"], F.lit(-1))
        fresh = F.array(F.struct((end - WINDOW).alias("s"), end.alias("e")))
        longer = F.concat(F.slice(acc["out"], F.lit(1), F.size(acc["out"]) - 1), F.array(F.struct(last["s"].alias("s"), end.alias("e"))))
        out = F.when(~high, acc["out"]).when(last["e"] >= end - WINDOW, longer).otherwise(F.concat(acc["out"], fresh))
        return F.struct(end.alias("at"), put(acc["counts"], k, c + 1).alias("counts"), total.alias("sum"), out.alias("out"))

    return F.aggregate(let(codes, steps), zero, lambda acc, pair: let(leave(acc, pair["leaves"]), lambda a: enter(a, pair["enters"])), lambda acc: acc["out"])


def _pieces(run: Column) -> Column:
    """array<struct<s:int,m:string>>: what INNOCENT leaves of a run (struct of s and m)."""

    def placed(cut: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(cut, lambda c: c["e"]))
        return F.zip_with(F.split(run["m"], INNOCENT, -1), ends, lambda m, s: F.struct((run["s"] + s).alias("s"), m.alias("m")))

    return let(located(run["m"], INNOCENT), placed)


def _paged(piece: Column) -> Column:
    """array<struct<s:int,m:string>>: pages of a piece, each with the WINDOW - 1 characters after it."""
    more = lambda cut, i: F.coalesce(F.left(F.get(cut, i + 1), F.lit(WINDOW - 1)), F.lit(""))
    cut = F.regexp_extract_all(piece["m"], F.lit(f".{{1,{PAGE}}}"), F.lit(0))
    return let(cut, lambda cut: F.transform(cut, lambda page, i: F.struct((piece["s"] + i * PAGE).alias("s"), F.concat(page, more(cut, i)).alias("m"))))


def scan_secrets(docs: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id, base and extra: array<struct<s,rank,e,kind>> of fixed-pattern and of entropy spans; one narrow stage."""
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(located(text, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 1)) >= 8)
    base = F.concat(as_spans(assign, "assign", 0), as_spans(located(text, ACCESS), "access", 1), as_spans(located(text, HEX), "hex", 2))
    found = docs.select("doc_id", base.alias("base"), *[located(text, pattern).alias(kind) for kind, (pattern, _, _) in CLASSES.items()])
    may_hide = lambda x: (F.length(x["m"]) >= WINDOW) & ~reduce(Column.__or__, [x["m"].rlike(p) for p in allowed], F.lit(False))
    found = found.select("doc_id", "base", *[F.filter(F.flatten(F.transform(kind, _pieces)), may_hide).alias(kind) for kind in CLASSES])
    found = found.select("doc_id", "base", *[F.flatten(F.transform(kind, _paged)).alias(kind) for kind in CLASSES])

    def hot(kind: str) -> Column:
        _, alphabet, least = CLASSES[kind]
        return F.flatten(F.transform(kind, lambda page: F.transform(_hot_windows(page["m"], alphabet, least), lambda w: F.struct((page["s"] + w["s"]).alias("s"), (page["s"] + w["e"]).alias("e")))))

    found = found.select("doc_id", "base", *[hot(kind).alias(kind) for kind in CLASSES])
    extra = F.concat(*[as_spans(joined(F.col(kind), touching=True), kind, 3 + i) for i, kind in enumerate(CLASSES)])
    return found.select("doc_id", "base", extra.alias("extra"))


def secrets_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, the digest of the fixed spans, all spans."""
    found = scan_secrets(docs)
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.concat("base", "extra")).alias("spans"),
    )
