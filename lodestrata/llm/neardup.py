"""MinHash near-dedup with BagMinHash signatures over multisets of five-word shingles.

1. Every text becomes the multiset of its five-word shingles (of fewer than five words: one shingle of
   all of them) and a signature of M values. Each shingle of weight w owns the Poisson processes of the
   weight intervals [0,1), [1,2), [2,4), [4,8) ... that w reaches into; the points of the last one count
   only if their place lies below w. A component is its least point over all shingles, so two components
   agree with the probability of the weighted Jaccard similarity. A process stops as soon as its points
   come later than the largest value of the signature.
2. Equal texts are one node from here on. BANDS bands of ROWS values give candidates: at similarity 0.8
   a pair shares no band with probability 2e-5.
3. Candidates are checked by the exact overlap of their multisets, and links of SIMILAR or more join into
   classes. Each band has a head that hashing chooses. First every node meets the one head that it shares
   most bands with; then, in TURNS turns with other heads, the last time the lightest nodes, the TRIES heads
   of other classes that it shares most bands with; then all pairs within a band whose classes still differ.
4. Shingles that one open node alone holds are in no overlap. The others, its common ones, mark LONGS
   words of bits by their hashes; each bit that the other node lacks takes at least one from the common
   weight. What is left bounds the overlap, so nodes and pairs whose bound is below SIMILAR go unread. A
   pair that is never checked is thus in one class already or below SIMILAR, and classes are those of all
   candidates. No group is collected, and no pair is listed within a class.
5. Bands that still hold more than CROWD nodes in the end are split by shingles, exactly: in one order of all
   shingles, rare ones first, two nodes as like as SIMILAR have a first shingle in common, and from there on each
   must hold what their overlap takes. A node goes to the shingles of which this can be true beside the lightest
   node there, and shingles whose nodes are of one class go. Within a band (or shingle) the nodes of its largest
   class meet those of the others only, so a huge class costs its size, not the square of it.

A long text is walked in blocks: some 12 bytes of memory for each of its bytes.

Result: one row per document with its class number. Texts are nodes of their own, whatever their doc_ids.
A node's number is the least doc_id of its text; of several texts with one such id all but the first, and
texts known only under null ids, have 62 bits of their hash above HASHED instead. A class has its least
node's number: the least doc_id that is not another text's. Null text is empty text; texts without words
are alike only if equal. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import arrow_rows, cut, grams, mix, pieces, text_bytes, word_hashes

SHINGLE, SIMILAR, ROWS, BANDS = 5, 0.8, 8, 60
M = ROWS * BANDS
#: Numbers of nodes that no doc_id names start here; ids are taken to lie below.
HASHED = 2**62
#: Turns with other heads before the remaining pairs are listed, heads that a node meets in each, and rows to a partition of the small tables in between.
TURNS, TRIES, PART = 2, 4, 250_000
#: Words of 64 bits that mark a node's common shingles.
LONGS = 8
#: Bands with more open nodes are split by shingles before their pairs are listed.
CROWD = 256


def shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count) of all rows' multisets, sorted by row and shingle."""
    h, rows = word_hashes(raw, offsets)
    g, at = grams(h, rows, SHINGLE)
    if len(offsets) == 2 and len(g):  # a long text is alone: sorted in place
        del h, at
        g.sort()
        new = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        return np.zeros(len(new), np.int64), g[new], np.diff(np.append(new, len(g)))
    of = np.searchsorted(rows, at, "right") - 1
    for i in np.flatnonzero((np.diff(rows) > 0) & (np.diff(rows) < SHINGLE)):
        one, _ = grams(h[rows[i] : rows[i + 1]], np.array([0, rows[i + 1] - rows[i]]), int(rows[i + 1] - rows[i]))
        g, of = np.append(g, one), np.append(of, i)
    order = np.lexsort((g, of))
    g, of = g[order], of[order]
    new = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (of[1:] != of[:-1])]) if len(g) else np.zeros(0, np.int64)
    return of[new], g[new], np.diff(np.r_[new, len(g)])


#: Elements whose points are drawn at once.
BAG_BLOCK = 1 << 18


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((mix(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def bag_signatures(of: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = M) -> np.ndarray:
    """n x m signatures of multisets given as (row, element, integer weight); rows without elements stay infinite.

    Elements come in blocks: a signature is the least over all of them, and what one block gives spares the next ones work.
    """
    sig = np.full((n, m), np.inf)
    for at in range(0, len(of), BAG_BLOCK):
        _add_to_bags(sig, *(x[at : at + BAG_BLOCK] for x in (of, element, weight)))
    return sig


def _add_to_bags(sig: np.ndarray, of: np.ndarray, element: np.ndarray, weight: np.ndarray) -> None:
    m = sig.shape[1]
    reach = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    row, w = np.repeat(of, reach), np.repeat(weight, reach)
    level = np.arange(len(row)) - np.repeat(np.cumsum(reach) - reach, reach)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    size = np.where(level > 0, low, 1)
    seed = mix(np.repeat(element, reach) + level.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    time, number, steps = np.zeros(len(row)), 0, 1
    flat = sig.reshape(-1)
    while len(row):
        tag = (np.arange(number, number + steps, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xE7037ED1A0B428DB)
        point = seed[:, None] + tag[None, :]
        at = time[:, None] + np.cumsum(-np.log(_uniform(point)), axis=1) / (size[:, None] * float(m))
        where = mix(point ^ np.uint64(0x8EBC6AF09C88C6E3)) % np.uint64(m)
        inside = low[:, None] + size[:, None] * _uniform(point ^ np.uint64(0x589965CC75374CC3)) < w[:, None] if (low + size > w).any() else np.ones(at.shape, bool)
        cell = row[:, None] * m + where.astype(np.int64)
        np.minimum.at(flat, cell[inside], at[inside])
        time, number = at[:, -1], number + steps
        steps = min(64, steps * 2)
        go = time <= sig.max(1)[row]
        row, w, low, size, seed, time = row[go], w[go], low[go], size[go], seed[go], time[go]


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, bands array<long>) of rows (doc_id, text_key, text); no bands for texts without words."""
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(2))
            for a, b in pieces(offsets, 1 << 21):
                of, g, count = shingles(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                sig = bag_signatures(of, g, count, b - a)
                values = sig.view(np.uint64).reshape(b - a, BANDS, ROWS)
                key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64)[None, :], (b - a, BANDS)).copy()
                for i in range(ROWS):
                    key = mix(key ^ values[:, :, i]) + np.uint64(i + 1)
                some = np.isfinite(sig[:, 0])
                ends = np.r_[0, np.cumsum(np.where(some, BANDS, 0))].astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(key[some].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), bands], ["doc_id", "text_key", "bands"])

    return docs.mapInArrow(run, "doc_id long, text_key binary, bands array<long>")


def shingle_rows(texts: DataFrame) -> DataFrame:
    """(node, shingle, n): every text's shingles, each once with its count, of rows (node, text)."""
    arrow_rows(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            node = batch.column(0).to_numpy()
            for a, b in pieces(offsets):
                of, g, n = shingles(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([pa.array(node[a:b][of]), pa.array(g.view(np.int64)), pa.array(n)], ["node", "shingle", "n"])

    return texts.mapInArrow(run, "node long, shingle long, n long")


def marked(texts: DataFrame) -> DataFrame:
    """(node, weight, common, bits array<long>) of rows (node, text, lone array<long>): number of shingles, number without the lone ones, and their bits."""
    arrow_rows(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                of, g, n = shingles(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                weight = np.bincount(of, n, b - a).astype(np.int64)
                for row, one in enumerate(batch.column(2).slice(a, b - a)):
                    if one.is_valid and len(one.values):
                        x, y = np.searchsorted(of, [row, row + 1])
                        n[x:y][np.isin(g[x:y], one.values.to_numpy(zero_copy_only=False).view(np.uint64))] = 0
                bits = np.zeros((b - a, LONGS * 64), bool)
                bits[of[n > 0], (g[n > 0] >> np.uint64(32)) % np.uint64(LONGS * 64)] = True
                longs = np.packbits(bits, axis=1).view(np.int64).reshape(-1)
                longs = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * LONGS), pa.array(longs))
                common = np.bincount(of, n, b - a).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(weight), pa.array(common), longs], ["node", "weight", "common", "bits"])

    return texts.mapInArrow(run, "node long, weight long, common long, bits array<long>")


def overlaps(pairs: DataFrame) -> DataFrame:
    """(a, b, similarity) of rows (a, b, one, two): weighted Jaccard similarity of the texts' shingle multisets."""
    arrow_rows(pairs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(len(batch))
            sides = [text_bytes(batch.column(2)), text_bytes(batch.column(3))]
            for i in range(len(batch)):
                (_, g1, n1), (_, g2, n2) = (shingles(raw[o[i] : o[i + 1]], np.array([0, o[i + 1] - o[i]])) for raw, o in sides)
                both = 0
                for lo in range(0, len(g1), BAG_BLOCK):  # both are sorted
                    some = g1[lo : lo + BAG_BLOCK]
                    y = np.minimum(np.searchsorted(g2, some), max(len(g2) - 1, 0))
                    hit = g2[y] == some if len(g2) else np.zeros(len(some), bool)
                    both += np.minimum(n1[lo : lo + BAG_BLOCK][hit], n2[y[hit]] if len(g2) else 0).sum()
                every = n1.sum() + n2.sum() - both
                out[i] = both / every if every else 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], ["a", "b", "similarity"])

    return pairs.mapInArrow(run, "a long, b long, similarity double")


def settled(df: DataFrame) -> DataFrame:
    """``df`` materialised, in one partition for every PART rows: a small table then needs no shuffles, a large one is dealt out as usual."""
    df = cut(df)
    return df.coalesce(max(1, -(-df.count() // PART)))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node connected with it, for nodes of edges (a, b). Alternating stars."""
    edges = settled(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = settled(small.select("e.u", "e.v").filter("u <> v").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, class_id, stays): one row per document; the rows that stay are one document of each class, repeated or not."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("text_key"), text.alias("text"))
    signed = cut(signatures(docs))
    named = signed.groupBy("text_key").agg(F.min("doc_id").alias("least")).filter("least is not null")
    named = named.groupBy("least").agg(F.min("text_key").alias("text_key")).select("text_key", F.col("least").alias("name"))
    hashed = F.shiftrightunsigned(F.xxhash64("text_key"), 2).bitwiseOR(F.lit(HASHED))
    nodes = signed.groupBy("text_key").agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands")).join(named, "text_key", "left")
    nodes = cut(nodes.select("text_key", "least", F.coalesce("name", hashed).alias("node"), "bands"))
    bands = nodes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("band")
    members = cut(bands.join(shared, "band", "left_semi"))  # every node of every band of two or more
    keyed = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("least").alias("_id"), F.col("text_key").alias("_key"))
    texts = docs.join(keyed, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).select("node", "text")
    texts = cut(texts.groupBy("node").agg(F.min("text").alias("text")))

    def checked(pairs: DataFrame) -> DataFrame:
        one, two = texts.select(F.col("node").alias("a"), F.col("text").alias("one")), texts.select(F.col("node").alias("b"), F.col("text").alias("two"))
        return settled(overlaps(pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "one", "two")).filter(F.col("similarity") >= SIMILAR))

    def may_link(one: str, two: str) -> Column:
        """Whether ``one`` and ``two`` may be as like as SIMILAR, by their common weights and the bits that the other lacks."""
        lacks = lambda x, y: sum((F.bit_count(F.col(f"{x}.bits")[i].bitwiseAND(F.bitwise_not(F.col(f"{y}.bits")[i]))) for i in range(LONGS)), F.lit(0))
        most = F.least(F.col(f"{one}.common") - lacks(one, two), F.col(f"{two}.common") - lacks(two, one))
        return most * (1 + SIMILAR) >= SIMILAR * (F.col(f"{one}.weight") + F.col(f"{two}.weight")) - 1e-6

    def headed(rows: DataFrame, turn: int) -> DataFrame:
        """Rows (band, me, head) of rows (band, me): each band has a head that hashing chooses, and another in each turn; the last is of least weight."""
        chance = F.xxhash64("me.node", "band", F.lit(turn))
        heads = rows.groupBy("band").agg(F.min_by("me", F.struct("me.weight", chance) if turn == TURNS else chance).alias("head"))
        return rows.join(heads, "band").filter("me.root <> head.root")

    def of_several(rows: DataFrame) -> DataFrame:
        """``rows`` of the bands that hold several classes; a band that holds one never opens again."""
        mixed = rows.groupBy("band").agg(F.min("me.root").alias("lo"), F.max("me.root").alias("hi")).filter("lo < hi").select("band")
        return settled(rows.join(mixed, "band", "left_semi"))

    def still_open(rows: DataFrame, roots: DataFrame) -> DataFrame:
        """``rows`` with new roots, of the bands that hold several classes."""
        rows = rows.withColumn("node", F.col("me.node")).join(roots, "node", "left")
        return of_several(rows.select("band", F.col("me").withField("root", F.coalesce("root", "node")).alias("me")))

    def within_reach(rows: DataFrame) -> DataFrame:
        """``rows`` with weights and bits of what open texts have in common, without nodes whose common weight alone keeps all others below SIMILAR."""
        nodes = texts.join(rows.select("me.node").distinct(), "node", "left_semi")
        lone = shingle_rows(nodes).groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last")).filter("node = last")
        lone = lone.groupBy("node").agg(F.collect_list("shingle").alias("lone"))  # no more than the node's own text holds
        held = settled(marked(nodes.join(lone, "node", "left").select("node", "text", "lone")))
        held = held.filter(F.col("common") >= SIMILAR * F.col("weight") - 1e-6)
        rows = rows.select("band", F.col("me.node").alias("node"), F.col("me.root").alias("root")).join(held, "node")
        return of_several(settled(rows.select("band", F.struct("node", "root", "weight", "common", "bits").alias("me"))))

    def chosen(rows: DataFrame, tries: int) -> DataFrame:
        """Pairs of each node with the ``tries`` heads of other classes that it shares most bands with; a node has BANDS heads at most."""
        n = rows.groupBy(F.col("me.node").alias("node"), F.col("head.node").alias("head")).agg(F.count("*").alias("n"))
        best = F.slice(F.array_sort(F.collect_list(F.struct(-F.col("n"), F.xxhash64("node", "head"), F.col("head").alias("head")))), 1, tries)
        return n.groupBy("node").agg(best.alias("x")).select("node", F.explode("x.head").alias("head")).select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()

    def enough(left: str, one: str, two: str) -> Column:
        """Whether ``left`` of a node's weight is an overlap that makes nodes of the weights ``one`` and ``two`` as like as SIMILAR."""
        return F.col(left) * (1 + SIMILAR) >= SIMILAR * (F.col(one) + F.col(two)) - 1e-6

    def split(rows: DataFrame) -> DataFrame:
        """``rows`` with the bands of more than CROWD nodes replaced by shingles, and in ``me`` what a node holds from there on (left)."""
        crowded = settled(rows.groupBy("band").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("band"))
        rows = rows.withColumn("me", F.col("me").withField("left", F.col("me.common")))
        if not crowded.head(1):
            return rows
        crowd = settled(rows.join(crowded, "band", "left_semi").groupBy("me.node").agg(F.first("me").alias("me")))
        held = cut(shingle_rows(texts.join(crowd.select("node"), "node", "left_semi")))
        frequent = held.groupBy("shingle").agg(F.count("*").alias("f")).filter("f > 1")
        onwards = Window.partitionBy("node").orderBy(F.desc("f"), F.desc("shingle")).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one text's shingles
        held = held.join(frequent, "shingle").select("node", "shingle", F.sum("n").over(onwards).alias("left")).join(crowd, "node")
        held = held.filter(F.col("left") >= SIMILAR * F.col("me.weight") - 1e-6)
        held = settled(held.select(F.col("shingle").alias("band"), F.col("me").withField("left", F.col("left")).alias("me")))
        lightest = held.groupBy("band").agg(F.min("me.weight").alias("least"))
        held = held.join(lightest, "band").filter(enough("me.left", "me.weight", "least")).select("band", "me")
        return rows.join(crowded, "band", "left_anti").unionByName(of_several(held))

    def pairs_of(rows: DataFrame) -> DataFrame:
        """Pairs (a, b) of nodes of one band and two classes that may link; those of a band's largest class meet the others only."""
        sizes = rows.groupBy("band", F.col("me.root").alias("root")).agg(F.count("*").alias("n"))
        rows = rows.join(sizes.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("top")), "band")
        one, two = rows.select("band", "top", F.col("me").alias("a")), rows.filter("me.root <> top").select("band", F.col("me").alias("b"))
        met = one.join(two, "band").filter("a.root <> b.root and (a.root = top or a.node < b.node)")
        met = met.filter(enough("a.left", "a.weight", "b.weight") & enough("b.left", "a.weight", "b.weight") & may_link("a", "b"))
        return met.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()

    first = members.select("band", F.struct("node", F.col("node").alias("root")).alias("me"))
    tried = settled(chosen(headed(first, 0), 1))
    links = checked(tried)
    roots = components(links)
    placed = within_reach(still_open(first, roots))
    for turn in range(TURNS):
        pairs = settled(chosen(headed(placed, turn + 1).filter(may_link("me", "head")), TRIES).join(tried, ["a", "b"], "left_anti"))
        more = checked(pairs)
        links, tried = links.unionByName(more), tried.unionByName(pairs)
        roots = components(links)
        placed = still_open(placed, roots)
    placed = within_reach(placed)
    more = checked(pairs_of(settled(split(placed))).join(tried, ["a", "b"], "left_anti"))
    if more.head(1):
        roots = components(links.unionByName(more))
    classed = nodes.select("text_key", "node", "least").join(roots, "node", "left").select("text_key", "node", "least", F.coalesce("root", "node").alias("class_id"))
    stays = (F.col("node") == F.col("class_id")) & F.col("doc_id").eqNullSafe(F.col("least"))
    return signed.select("doc_id", "text_key").join(classed, "text_key").select("doc_id", "text_key", "class_id", stays.alias("stays"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class stays, the one of least doc_id of the text that names the class; all columns as they are."""
    rows = cut(near_duplicates(docs).groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.first("stays").alias("stays"), F.count("*").alias("n")))
    d = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_doc_id"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("_text_key"))
    if rows.filter("stays and n > 1").head(1):  # of repeated rows, any one
        d = d.groupBy("_doc_id", "_text_key").agg(F.first("_row").alias("_row"))
    d = d.join(rows.filter("not stays"), F.col("_doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left_anti")
    return d.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def classes(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "class_id")
