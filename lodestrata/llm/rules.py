"""Quality rules with DataFrame functions only: fixed limits, and a decision list learned by sequential covering.

Every text gives counts (words, characters in them, symbols, repeated lines, words in repeated five-word
windows and others), and shares of those counts are what rules look at. Rules reject: each is a
conjunction of thresholds, grown on two thirds of the labelled rows by the condition of largest gain in
information, pruned on the last third to the prefix of best worth (p - n) / (p + n), and kept while it is right
for PRECISION of both; the rows it covers go before the next one is grown. The result is one ordered
conditional expression, whose first true rule gives the verdict; without a true one a document stays.

All labelled rows that the fold rule leaves teach, none are sampled: a step of growth is one aggregation to
counts by statistic and bin, and only those (at most the bins of _SHARES) reach the driver. Bins are fixed
grids, so what is learned does not depend on the order or the partitions of the rows.

Null text has no words, as has an empty one; both fail the fixed limits. Repeated rows have one result and
each counts when learning; a label that is null is left out, of several the largest counts. Without labels, or
without a rule that is right often enough, the fixed limits alone decide. An empty table gives no rows; other
columns are ignored, or kept by keep_good(). Each text is read alone and whole: time is n log n in its words,
memory some 25 bytes a word and some 150 where windows repeat.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut, let
from .quality import held_out

SPAN, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: A rule must be right for this share of the rows it covers; at most so many rules, and conditions of one.
PRECISION, RULES, CONDITIONS, LEAST_COVER = 0.9, 16, 4, 3
#: Characters of one block of a text; blocks end with a word.
_BLOCK = 1 << 16
_WORD = r"[^\x20\x09-\x0D]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_shouts")
#: What rules look at: numerator, denominator, bins of one unit (a power of two, so that bin edges are exact), top bin.
_SHARES = {
    "words": ("n_words", None, 1 / 8, 512),
    "chars_a_word": ("word_chars", "n_words", 4, 256),
    "symbols_a_word": ("n_symbols", "n_words", 64, 256),
    "repeated_words": ("n_repeat_words", "n_words", 256, 256),
    "repeated_lines": ("n_dup_lines", "n_lines", 256, 256),
    "distinct_words": ("n_distinct_words", "n_words", 256, 256),
    "upper": ("n_upper", "word_chars", 256, 256),
    "digits": ("n_digits", "word_chars", 256, 256),
    "shouts_a_word": ("n_shouts", "n_words", 64, 256),
}


def _repeated(windows: Column) -> Column:
    """Words in windows (array of hashes by first word) that occur twice or more, each word once."""

    def covered(places: Column) -> Column:
        reach = F.transform(places, lambda p, k: F.least(F.lit(SPAN), F.coalesce(F.get(places, k + 1) - p, F.lit(SPAN))))
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    def found(ordered: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(ordered, k)["hash"] == x["hash"], F.lit(False))
        twice = F.transform(ordered, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["at"]))
        return let(F.sort_array(F.filter(twice, lambda p: p.isNotNull())), covered)

    at = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("hash"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(at, found))


def text_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` as struct ``kept``, and COUNTS as longs; one narrow stage."""
    text = F.coalesce("text", F.lit(""))
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_BLOCK}}}[^\x20\x09-\x0D]*+"), F.lit(0))
    hashed = lambda block: F.transform(F.regexp_extract_all(block, F.lit(_WORD), F.lit(0)), lambda w: F.xxhash64(w))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(_WORD))
    without = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    rows = docs.select(
        F.struct(*keep).alias("kept"),
        F.flatten(F.transform(blocks, hashed)).alias("words"),
        lines.alias("lines"),
        (F.length(text) - without(r"[\x20\x09-\x0D]+")).alias("word_chars"),
        without(r"[#*$%&|<>]+").alias("n_symbols"),
        without("[A-Z]+").alias("n_upper"),
        without("[0-9]+").alias("n_digits"),
        without("!+").alias("n_shouts"),
    )
    window = lambda w, i: F.xxhash64(w, *[F.get("words", i + j) for j in range(1, SPAN)])
    windows = F.slice(F.transform("words", window), F.lit(1), F.greatest(F.size("words") - SPAN + 1, F.lit(0)))
    rows = rows.withColumns({"windows": windows, "n_words": F.size("words"), "n_distinct_words": F.size(F.array_distinct("words")), "n_lines": F.size("lines"), "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines"))})
    rows = rows.withColumn("n_repeat_words", _repeated(F.col("windows")))
    # made by a generator, so that filters on counts stay above it: pushed below, they would evaluate all of this once more
    return rows.select("kept", F.inline(F.array(F.struct(*[F.col(c).cast("long").alias(c) for c in COUNTS]))))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _share(name: str) -> Column:
    top, under, _, _ = _SHARES[name]
    return F.col(top).cast("double") / (F.greatest(F.col(under), F.lit(1)) if under else F.lit(1))


@dataclass(frozen=True)
class Condition:
    """A share at or over, or under, an edge of its grid."""

    share: str
    over: bool
    edge: float

    def column(self) -> Column:
        return _share(self.share) >= self.edge if self.over else _share(self.share) < self.edge

    def __str__(self) -> str:
        return f"{self.share} {'>=' if self.over else '<'} {self.edge:g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    return reduce(Column.__and__, [c.column() for c in rule], F.lit(True))


def _gain(p: int, n: int, bad: int, good: int) -> float:
    """Information gained for the p bad rows that stay of ``bad``, when n of ``good`` good ones stay too."""
    return p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good))) if p else 0.0


def best_condition(histogram: dict[tuple[str, int], tuple[int, int]]) -> Condition | None:
    """The condition of largest gain by counts (bad, good) of each share's bins; of equal ones the first by share, direction and edge."""
    best, chosen = 1e-9, None
    for share, (_, _, unit, top) in _SHARES.items():
        counts = [histogram.get((share, b), (0, 0)) for b in range(top + 1)]
        bad, good = (sum(c[i] for c in counts) for i in (0, 1))
        if not bad:
            continue
        under_bad = under_good = 0
        gains: list[tuple[float, Condition]] = []
        for b in range(1, top + 1):
            under_bad, under_good = under_bad + counts[b - 1][0], under_good + counts[b - 1][1]
            gains.append((_gain(bad - under_bad, good - under_good, bad, good), Condition(share, True, b / unit)))
            gains.append((_gain(under_bad, under_good, bad, good), Condition(share, False, b / unit)))
        for gain, condition in sorted(gains, key=lambda g: (not g[1].over, g[1].edge)):
            if gain > best + 1e-9:
                best, chosen = gain, condition
    return chosen


def _labelled(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that teach: counts, bad, and whether they prune."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).dropna().groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = counts.withColumn("doc_id", F.col("kept.doc_id")).filter(~held_out(F.col("doc_id")) & ~base_failed())
    return rows.join(known, "doc_id").select(*COUNTS, (F.col("quality") == 0).alias("bad"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prunes"))


def learn(counts: DataFrame, labels: DataFrame, precision: float = PRECISION) -> list[Rule]:
    """Rules in order, by sequential covering over all labelled rows of text_counts() that keep a doc_id."""
    left, rules = cut(_labelled(counts, labels)), []
    binned = F.array(*[F.struct(F.lit(s).alias("share"), F.least(F.floor(_share(s) * unit), F.lit(top)).cast("int").alias("bin")) for s, (_, _, unit, top) in _SHARES.items()])
    n = lambda condition: F.count(F.when(condition, 1))
    while len(rules) < RULES:
        rule: Rule = ()
        while len(rule) < CONDITIONS:
            grown = left.filter(~F.col("prunes") & _all(rule)).select("bad", F.explode(binned).alias("x"))
            rows = grown.groupBy("x.share", "x.bin").agg(n(F.col("bad")).alias("p"), n(~F.col("bad")).alias("n")).collect()  # bounded by the grid
            condition = best_condition({(r["share"], r["bin"]): (r["p"], r["n"]) for r in rows})
            if condition is None:
                break
            rule = (*rule, condition)
        if not rule:
            break
        parts = [rule[: k + 1] for k in range(len(rule))]
        sums = [n(_all(r) & (F.col("bad") == bad) & (F.col("prunes") == prunes)) for r in parts for bad in (True, False) for prunes in (True, False)]
        row = left.agg(*sums).first()
        judged = [(row[4 * k : 4 * k + 4], parts[k]) for k in range(len(parts))]
        worth = lambda c: (c[0] - c[2]) / (c[0] + c[2]) if c[0] + c[2] else -1.0
        (p_prune, p_grow, n_prune, n_grow), rule = max(judged, key=lambda x: (worth(x[0]), -len(x[1])))
        right = lambda p, n: p >= precision * (p + n)
        if p_prune + p_grow < LEAST_COVER or not right(p_prune, n_prune) or not right(p_grow, n_grow):
            break
        rules.append(rule)
        left = left.filter(~_all(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that rejects, 0 if none does: one ordered conditional expression."""
    return reduce(lambda out, r: out.when(_all(r[1]), r[0]), list(enumerate(rules, 1)), F.when(F.lit(False), 0)).otherwise(0)


def judge(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """``counts`` with base_failed, rule and kept."""
    judged = counts.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return judged.withColumn("kept_whole", ~F.col("base_failed") & (F.col("rule") == 0))


def rules_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: counts, whether the fixed limits fail, whether it stays, and the rule that rejects it (0: none)."""
    counts = cut(text_counts(docs, ["doc_id"]))
    judged = judge(counts, learn(counts, labels))
    return judged.select("kept.doc_id", *COUNTS[:5], "base_failed", F.col("kept_whole").alias("kept"), "rule", held_out(F.col("kept.doc_id")).alias("held_out"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that neither the fixed limits nor a rule reject, all columns as they are."""
    taught = docs.select("doc_id", "text").join(labels.select("doc_id").distinct(), "doc_id")
    rules = learn(text_counts(taught, ["doc_id"]), labels)
    return judge(text_counts(docs, docs.columns), rules).filter("kept_whole").select("kept.*")
