"""Personal data with DataFrame functions only: fixed patterns, and terms that reveal what they match.

Found by pattern: e-mail addresses, IPv4 addresses, payment cards (Luhn) and phone numbers. Matches that
overlap count as one, of the kind that starts first. Each has two protected entities: the value itself (letters lower-cased;
of numbers the digits), and what it shares with others of its kind (the domain, the first two numbers of an IPv4 address,
the first six digits of a card, the first four of a phone number). Terms are judged twice by what the whole table says
of them: near a match, the NEAR words before and after it as far as the next match, and wherever they stand in a text
with matches. Near ones are judged so:

    P(e | t) is at least the lower Wilson bound of n(t,e) of n(t), one-sided at 95 %
    left(t, e) = -log2 P(e | t), the bits that are left to guess when the term is known

with n(t) the documents that hold the term as a word anywhere in their text and n(t,e) those where it stands near the
entity. 0 bits would mean that the term gives the entity away. The bound grows with the number of meetings and
is judged by fixed cuts, so what is done does not depend on how many other documents there are: a term met once leaves
1.9 bits and stays, however rare it is; one that is met twice, each time near the entity, leaves 1.23. Documents
beside that hold neither term nor entity change one thing only: a term must tell more than chance, P(e | t) > n(e) / N with N documents
and n(e) those that hold the entity, and that can only matter for an entity that a share of GENERALISE of all documents holds.
A P(e | t) of REMOVE or more (0.76 bits left) removes the term where it stands near that entity, one of GENERALISE or
more (1.25 bits) puts its class there.
Where a term stands near several entities the most telling one decides. Matches of the patterns always go.

All words of a text, however far from its matches, are judged with all its entities by the same bound and cuts, but n(t,e) and n(t) then
count copies of a text with matches once: in copies every word meets every match again, which tells nothing of the two. A
word goes by the more telling of both judgements. Terms that stand in the same texts, and entities that do, have the same counts,
so sets of texts meet, not each term with each entity; sets too small or too unlike in size to reach a cut never meet.

Patterns whose repeats could only be given back in vain use possessive repeats, and may start only where
a run starts or the last match ended: the same matches, in time linear in the text. What is done with
matches and words is linear in them as well.

Null text is empty text; empty texts and tables give no spans. Repeated rows, and rows that share a doc_id or have none,
count and are judged as documents of their own, each by its own text. What is left of a word that a match cuts is a
word. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut, joined, located, parts, span_text

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"[\p{L}\p{M}\p{N}]+"
KINDS = ("email", "ip", "card", "phone")

NEAR, REMOVE, GENERALISE = 3, 0.59, 0.42
#: One-sided 95 % of the normal distribution.
SURE = 1.6449
#: So many terms may be broadcast to filter the words of all texts; more are joined after the words are counted.
FEW_TERMS = 200_000


def _luhn(digits: Column) -> Column:
    """Whether the digit string passes Luhn's test."""
    n = F.length(digits)
    total = F.aggregate(
        F.transform(F.split(digits, ""), lambda d, i: (d.cast("int") * F.when((n - i) % 2 == 0, 2).otherwise(1))),
        F.lit(0),
        lambda acc, v: acc + F.when(v > 9, v - 9).otherwise(v),
    )
    return total % 10 == 0


def base_spans(text: Column) -> Column:
    """array<struct<s,rank,e,kind>> of the four kinds, with what they match as m."""
    part_ok = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
    ip = F.filter(located(text, IP), lambda x: F.forall(F.split(x["m"], r"\."), lambda p: part_ok(p) & (F.right(p, F.lit(3)).cast("int") <= 255)))

    def digits(m: Column) -> Column:
        return F.regexp_replace(m, "[^0-9]", "")

    card = F.filter(located(text, CARD), lambda x: F.length(digits(x["m"])).between(12, 19) & _luhn(digits(x["m"])))
    phone = F.filter(located(text, PHONE), lambda x: F.length(digits(x["m"])).between(9, 15))
    found = (located(text, EMAIL), ip, card, phone)

    def named(hits: Column, kind: str, rank: int) -> Column:
        return F.transform(hits, lambda x: F.struct(x["s"].alias("s"), F.lit(rank).alias("rank"), x["e"].alias("e"), F.lit(kind).alias("kind"), x["m"].alias("m")))

    return F.array_sort(F.concat(*[named(hits, kind, rank) for rank, (kind, hits) in enumerate(zip(KINDS, found, strict=True))]))


def _entities(kind: Column, match: Column) -> Column:
    """array<long>: a match's value, and what it shares with others of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    numbers = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    value = F.when(kind == "email", F.lower(match)).when(kind == "ip", F.array_join(numbers, ".")).otherwise(digits)
    group = (
        F.when(kind == "email", F.lower(F.substring_index(match, "@", -1)))
        .when(kind == "ip", F.array_join(F.slice(numbers, 1, 2), "."))
        .otherwise(F.substring(digits, F.lit(1), F.when(kind == "card", 6).otherwise(4)))
    )
    return F.array(F.xxhash64(kind, F.lit("value"), value), F.xxhash64(kind, F.lit("group"), group))


def _gaps(text: Column, spans: Column) -> Column:
    """array<struct<s:int,words:array<struct<s,e,m>>>>: the words before, between and after disjoint spans."""
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda x: x["e"]))
    ends = F.concat(F.transform(spans, lambda x: x["s"]), F.array(F.length(text)))
    return parts(text, lambda part: F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), located(part(s, e), TERM).alias("words"))))


def _near() -> Column:
    """array<struct<entity:long,s:int,e:int,term:string>> of the columns spans and gaps: the NEAR words on each side of every span."""

    def around(x: Column, before: Column, after: Column) -> Column:
        last = lambda words: F.slice(words, F.greatest(F.size(words) - NEAR, F.lit(0)) + 1, F.lit(NEAR))
        at = lambda t, by, entity: F.struct(entity.alias("entity"), (t["s"] + by).alias("s"), (t["e"] + by).alias("e"), F.lower(t["m"]).alias("term"))
        of = lambda entity: F.concat(
            F.transform(last(before["words"]), lambda t: at(t, before["s"], entity)), F.transform(F.slice(after["words"], 1, NEAR), lambda t: at(t, after["s"], entity))
        )
        return F.flatten(F.transform(x["entities"], of))

    sided = F.zip_with(F.slice("gaps", F.lit(1), F.size("spans")), F.slice("gaps", F.lit(2), F.size("spans")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.flatten(F.zip_with("spans", sided, lambda x, g: around(x, g["a"], g["b"])))


def _words() -> Column:
    """array<struct<s:int,e:int,term:string>> of the column gaps: all words outside the spans."""
    return F.flatten(F.transform("gaps", lambda g: F.transform(g["words"], lambda t: F.struct((t["s"] + g["s"]).alias("s"), (t["e"] + g["s"]).alias("e"), F.lower(t["m"]).alias("term")))))


def _counts_of(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """(term, n_t) of rows (term): in how many texts (column text) each stands."""
    held = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))).alias("term"))
    if terms.count() <= FEW_TERMS:
        return held.join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_t"))
    return held.groupBy("term").agg(F.count("*").alias("n_t")).join(terms, "term", "left_semi")


def least_share(part: Column, whole: Column) -> Column:
    """The lower Wilson bound of a share of ``part`` in ``whole``."""
    p, z2 = part / whole, SURE * SURE
    return (p + z2 / (2 * whole) - SURE * F.sqrt(p * (1 - p) / whole + z2 / (4 * whole * whole))) / (1 + z2 / whole)


def _entities_of() -> Column:
    return F.array_distinct(F.flatten(F.transform("spans", lambda x: x["entities"])))


def pairs_near(found: DataFrame) -> DataFrame:
    """(entity, term, n_te) of all pairs that stand near each other in found (spans, near)."""
    pairs = found.select(F.explode(F.array_distinct(F.transform("near", lambda x: F.struct(x["entity"].alias("entity"), x["term"].alias("term"))))).alias("x"))
    return cut(pairs.groupBy("x.entity", "x.term").agg(F.count("*").alias("n_te")))


def disclosures(pairs: DataFrame, found: DataFrame, counts: DataFrame, n: float) -> DataFrame:
    """(entity, term, disclosure) of pairs_near() that reach GENERALISE, by counts (term, n_t) of n documents."""
    of_entity = found.select(F.explode(_entities_of()).alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    # a word that a match cuts may stand near more entities than it is counted as a word
    judged = pairs.join(counts, "term").withColumn("n_t", F.greatest("n_t", "n_te").cast("double"))
    judged = judged.withColumn("disclosure", least_share(F.col("n_te"), F.col("n_t"))).filter(F.col("disclosure") >= GENERALISE)
    common = of_entity.filter(F.col("n_e") >= GENERALISE * n)  # for the others chance is less than any disclosure that is left
    judged = judged.join(common, "entity", "left").filter(F.col("n_e").isNull() | (F.col("disclosure") > F.col("n_e") / n))
    return judged.select("entity", "term", "disclosure")


def _sets(rows: DataFrame, what: str, name: str) -> DataFrame:
    """(what, name): the set of texts that hold each, as its size, its further copies and a digest; sets that can reach GENERALISE."""
    a, b = F.bit_xor(F.xxhash64("_text")), F.bit_xor(F.xxhash64(F.lit("b"), "_text"))
    sets = rows.groupBy(what).agg(F.struct(F.count("*").alias("n"), F.sum(F.col("copies") - 1).alias("more"), F.xxhash64(a, b).alias("id")).alias(name))
    return cut(sets.filter(least_share(F.col(f"{name}.n"), F.col(f"{name}.n")) >= GENERALISE))


def pairs_in_texts(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, of_term, of_entity, n_te) of terms and sets of entities that meet in texts of found (_text, spans, words), where they may reach GENERALISE; (_text, of_entity)."""
    held = lambda values, name: found.select("_text", F.explode(values).alias(name)).groupBy("_text", name).agg(F.count("*").alias("copies"))
    terms, entities = held(F.array_distinct(F.transform("words", lambda w: w["term"])), "term"), held(_entities_of(), "entity")
    term_sets = _sets(terms, "term", "of_term")
    within = cut(entities.join(_sets(entities, "entity", "of_entity"), "entity").select("_text", "of_entity").distinct())
    t, e = F.col("of_term.n"), F.col("of_entity.n")
    met = terms.join(term_sets, "term").select("_text", "of_term").repartition("_text").distinct().join(within, "_text").filter(least_share(F.least(t, e), t) >= GENERALISE)
    met = met.groupBy("of_term", "of_entity").agg(F.count("*").alias("n_te")).filter(least_share(F.col("n_te"), t) >= GENERALISE)
    return cut(met.join(term_sets, "of_term").select("term", "of_term", "of_entity", "n_te")), within


def disclosures_in_texts(pairs: DataFrame, found: DataFrame, counts: DataFrame, n: float) -> DataFrame:
    """(term, of_entity, disclosure) of pairs_in_texts() that reach GENERALISE; further copies of found's texts count in neither n_t nor n."""
    distinct = found.agg((F.lit(n) - F.count("*") + F.count_distinct("_text")).alias("n"))
    judged = pairs.join(counts, "term").withColumn("n_t", F.greatest(F.col("n_t") - F.col("of_term.more"), "of_term.n").cast("double"))
    judged = judged.withColumn("disclosure", least_share(F.col("n_te"), F.col("n_t"))).filter(F.col("disclosure") >= GENERALISE)
    judged = judged.crossJoin(F.broadcast(distinct)).filter(F.col("disclosure") > F.col("of_entity.n") / F.col("n"))
    return cut(judged.select("term", "of_entity", "disclosure"))


def find_private(docs: DataFrame, keep: list[str]) -> DataFrame:
    """_row (a struct of the columns ``keep``), base and extra spans: one row per document.

    base: array<struct<s,rank,e,kind,m>>; extra: array<struct<s,rank,e,kind>> of kinds term_general and term_removed.
    """
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    found = docs.select(F.struct(*keep).alias("_row"), F.coalesce("text", F.lit("")).alias("text"))
    found = found.select("_row", "text", base_spans(F.col("text")).alias("base"))
    # matching is the costly part: its spans are materialised once; only rows that have any are joined with what is said of terms
    found = cut(found.select("_row", F.when(F.size("base") > 0, F.col("text")).alias("text"), "base"))
    none = F.array().cast("array<struct<s:int,rank:int,e:int,kind:string>>")
    hit = found.filter(F.size("base") > 0).withColumn("_at", F.monotonically_increasing_id())
    near = hit.select("_at", "text", F.transform(joined(F.col("base")), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), _entities(x["kind"], x["m"]).alias("entities"))).alias("spans"))
    near = near.select("_at", F.xxhash64("text").alias("_text"), "spans", _gaps(F.col("text"), F.col("spans")).alias("gaps"))
    near = cut(near.select("_at", "_text", "spans", _near().alias("near"), _words().alias("words")))
    pairs, (met, within), n = pairs_near(near), pairs_in_texts(near), float(texts.count())
    counts = cut(_counts_of(cut(pairs.select("term").union(met.select("term")).distinct()), texts))
    rows = near.select("_at", F.explode("near").alias("x")).select("_at", "x.*").join(disclosures(pairs, near, counts, n), ["entity", "term"])
    told = disclosures_in_texts(met, near, counts, n)
    few = F.broadcast if told.count() <= FEW_TERMS else lambda df: df
    far = near.select("_at", "_text", F.explode("words").alias("x")).select("_at", "_text", "x.*").join(few(told), "term").join(within, ["_text", "of_entity"])
    rows = rows.select("_at", "s", "e", "disclosure").unionByName(far.select("_at", "s", "e", "disclosure"))
    rows = rows.groupBy("_at", "s", "e").agg(F.max("disclosure").alias("disclosure"))
    strong = F.col("disclosure") >= REMOVE
    span = F.struct("s", F.when(strong, 5).otherwise(4).alias("rank"), "e", F.when(strong, "term_removed").otherwise("term_general").alias("kind"))
    extra = rows.groupBy("_at").agg(F.array_sort(F.collect_list(span)).alias("extra"))  # no more than the row's own text holds
    hit = hit.join(extra, "_at", "left").select("_row", "base", F.coalesce("extra", none).alias("extra"))
    return found.filter(F.size("base") == 0).select("_row", "base", none.alias("extra")).unionByName(hit)


def private_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, the digest of the fixed spans, all spans."""
    found = find_private(docs, ["doc_id"])
    base = F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["rank"].alias("rank"), x["e"].alias("e"), x["kind"].alias("kind")))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select("_row.doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.concat(base, "extra")).alias("spans"))


def _class_of(term: Column) -> Column:
    return F.when(term.rlike("^[0-9]+$"), "<number>").when(term.rlike(r"^\p{Lu}"), "<name>").otherwise("<word>")


def sanitise(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs, with text sanitised and n_chars, where there is one, counted anew.

    Overlapping spans go as one, under the kind that starts first. Texts without spans, null ones included, stay as they are.
    """
    found = find_private(docs, docs.columns)
    text = F.col("_row.text")
    spans = F.concat(F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["rank"].alias("rank"), x["e"].alias("e"), x["kind"].alias("kind"))), "extra")
    found = found.withColumn("_spans", F.when(F.size("base") > 0, joined(F.array_sort(spans))))

    def clean(part) -> Column:
        by = lambda x: F.when(x["kind"] == "term_removed", "").when(x["kind"] == "term_general", _class_of(part(x["s"], x["e"]))).otherwise(F.concat(F.lit("<"), x["kind"], F.lit(">")))
        starts = F.concat(F.array(F.lit(0)), F.transform("_spans", lambda x: x["e"]))
        pieces = F.zip_with("_spans", F.slice(starts, F.lit(1), F.size("_spans")), lambda x, s: F.concat(part(s, x["s"]), by(x)))
        return F.concat(F.array_join(pieces, ""), part(F.element_at(starts, -1), F.length(text)))

    found = found.select("_row", F.when(F.col("_spans").isNull(), text).otherwise(parts(text, clean)).alias("_clean"))
    changed = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast("long")}
    return found.select(*[changed[c].alias(c) if c in changed else F.col("_row")[c].alias(c) for c in docs.columns])
