"""Conversation structure repair: cheapest edits that bring the turns of a conversation into the order (s?(ua)+)?.

A turn's role initial and its first fault (blank, duplicate, truncated) make one symbol; the symbols of a
conversation's turns in order are its signature. Over all conversations the signatures share their suffixes
in one automaton that is built from the end: a node stands for a suffix, and holds for each grammar state the
least cost of what follows and the first letter of the best audit of it. Signatures are dealt by ranges of
their reversals and sorted, so those that share a suffix meet in one task, which walks them depth first: a node
is computed once, when the walk enters it, and read by all conversations below it. Equal signatures are
ordered by conv_id, so ranges split even one that a third of all conversations have.

Edits: Keep costs 0, Rerole (to user or assistant) 1, Delete 2, Insert (an empty text) 5; a truncated turn that
is not deleted adds 5, blank and duplicate turns must be deleted. Among edits of one cost the audit that is
least by ASCII is taken. From one state no two edits with the same letter compete, so the least letter
decides and audits need not be compared.

Null role and null text are one space. Turns are ordered by turn (null first), role and the hash of the text,
so ties and repeated rows have one result; a repeated row is a duplicate. Rows without a conv_id are one
conversation. conv_id and turn are longs. Empty texts are blank. An empty table gives no rows; other columns are ignored. Only role, turn,
hash and fault of a turn are shuffled to find edits; texts are shuffled once, to apply them, and are
streamed in order through a task, so a conversation may be larger than memory. What must fit is its signature and
the walk's path, some 300 bytes a turn of the longest conversation of a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import arrow_rows

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
_SOLID = r"[^\x20\x09-\x0D]"
#: Grammar states: nothing yet, after s, after u, after a; where each goes with u or a, and which of them may end.
_START, _S, _U, _A = range(4)
_NEXT = {_START: ("u", _U), _S: ("u", _U), _U: ("a", _A), _A: ("u", _U)}
_NAMES = {"u": "user", "a": "assistant"}
#: Symbols: x must go; s, u, a, o (other) are role initials, upper case when truncated.
SYMBOLS = "xsuaoSUAO"
_NEVER = 1 << 60


def damage(turns: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text after the damage that crc32 of conv_id:turn asks for."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    role = F.when(kind == 4, "user").otherwise(shown("role"))
    copies = F.array_repeat(F.lit(True), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _keyed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in role and text, and hash of the text."""
    clean = turns.select(*[F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")], *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    return clean.withColumn("hash", F.unhex(F.sha2("text", 256)))


def signatures(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, signature: one row per conversation."""
    rows = _keyed(turns).select(
        "conv_id", "turn", "role", "hash", (~F.col("text").rlike(_SOLID)).alias("empty"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open")
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "hash").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("again", F.row_number().over(same) > 1)
    within = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "hash", "again")
    initial = F.substring("role", 1, 1)
    rows = rows.select(
        "conv_id", "turn", initial.alias("initial"),
        F.when(F.col("empty"), "b").when(F.col("again"), "d").when(F.col("open"), "t").otherwise("").alias("fault"),
        F.row_number().over(within).alias("place"), F.lag(initial).over(within).alias("before"), F.lag("turn").over(within).alias("last"),
    )
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = F.when(F.col("fault").isin("b", "d"), "x").when(F.col("fault") == "t", F.upper(known)).otherwise(known)
    count = lambda condition: F.count(F.when(condition, 1))
    first_of_turn = F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("last"))
    ordered = F.sort_array(F.collect_list(F.struct("place", symbol.alias("symbol"))))
    return rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - count(first_of_turn), F.lit(0).cast("long")).alias("gaps"),
        *[count(F.col("fault") == f[0]).alias(f) for f in ("blank", "duplicate", "truncated")],
        count(F.col("before").isNotNull() & ~F.concat("before", "initial").isin("su", "ua", "au")).alias("illegal"),
        F.array_join(F.transform(ordered, lambda x: x["symbol"]), "").alias("signature"),
    )


class SuffixAutomaton:
    """The path of suffixes from the end of a signature to its start; what two signatures in turn share stays."""

    def __init__(self):
        cost, letters = self._inserts([0, _NEVER, _NEVER, 0], ["", "", "", ""])
        self.symbols, self.cost, self.letters, self.computed = "", [cost], [letters], 0

    @staticmethod
    def _inserts(cost: list[int], letters: list[str]) -> tuple[list[int], list[str]]:
        """Costs and first letters when turns may be put in before; three rounds reach every state."""
        for _ in range(3):
            for state, (_, after) in _NEXT.items():
                price = INSERT + cost[after]
                if price < cost[state] or (price == cost[state] and "I" < letters[state]):
                    cost[state], letters[state] = price, "I"
        return cost, letters

    def _enter(self, symbol: str) -> None:
        """A node before those of the path: the cheapest edit of its turn in each state."""
        self.computed += 1
        follow, initial, extra = self.cost[-1], symbol.lower(), TRUNCATED if symbol.isupper() else 0
        cost, letters = [], []
        for state, (legal, after) in _NEXT.items():
            options = [(DELETE + follow[state], "D")]
            if symbol != "x":
                options.append((REROLE + extra + follow[after], "R"))
                if initial == legal:
                    options.append((KEEP + extra + follow[after], "K"))
                elif initial == "s" and state == _START:
                    options.append((KEEP + extra + follow[_S], "K"))
            best = min(options)
            cost.append(best[0])
            letters.append(best[1])
        cost, letters = self._inserts(cost, letters)
        self.cost.append(cost)
        self.letters.append(letters)

    def best(self, signature: str) -> tuple[int, str, str]:
        """Cost, audit, and the role initial after each edit (- for a deletion)."""
        path = signature[::-1]
        shared, most = 0, min(len(path), len(self.symbols))
        if path[:most] == self.symbols[:most]:
            shared = most
        else:
            while path[shared] == self.symbols[shared]:
                shared += 1
        del self.cost[shared + 1 :], self.letters[shared + 1 :]
        for symbol in path[shared:]:
            self._enter(symbol)
        self.symbols = path
        state, depth, audit, roles = _START, len(path), [], []
        while letter := self.letters[depth][state]:
            audit.append(letter)
            if letter == "D":
                roles.append("-")
            elif letter == "K" and path[depth - 1] in "sS":
                roles.append("s")
                state = _S
            else:
                legal, state = _NEXT[state]
                roles.append(legal)
            depth -= letter != "I"
        return self.cost[len(path)][_START], "".join(audit), "".join(roles)


def audits(found: DataFrame) -> DataFrame:
    """signatures() with cost, audit and roles, by the automaton over all signatures."""
    arrow_rows(found.sparkSession)
    by_end = found.withColumn("end", F.reverse("signature"))
    dealt = by_end.repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id").drop("end")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, last, best = SuffixAutomaton(), None, None
        for batch in batches:
            out = []
            for signature in batch.column("signature").to_pylist():
                if signature != last:
                    last, best = signature, automaton.best(signature)
                out.append(best)
            more = [pa.array([b[0] for b in out], pa.int64()), pa.array([b[1] for b in out], pa.string()), pa.array([b[2] for b in out], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "cost", "audit", "roles"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return dealt.mapInArrow(walk, f"{fields}, cost long, audit string, roles string")


def _with_edits(turns: DataFrame, judged: DataFrame) -> DataFrame:
    """Each conversation's row of ``judged`` (as ``facts``) and after it its turns, in order, in one task: texts are shuffled here."""
    head = judged.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("hash"), F.lit(None).cast("string").alias("text"), F.struct(*judged.drop("signature").columns).alias("facts"))
    rows = _keyed(turns).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "hash", "text", F.lit(None).cast(head.schema["facts"].dataType).alias("facts"))
    return head.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "hash").drop("turn", "hash")


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(facts,) where a conversation starts, then (edit, role, text) for each letter of its audit."""
    audit, roles, at = "", "", 0
    for batch in batches:
        kinds, old, texts, facts = (batch.column(c) for c in ("kind", "role", "text", "facts"))
        for i, kind in enumerate(kinds.to_pylist()):
            while at < len(audit) and audit[at] == "I":
                yield "I", _NAMES[roles[at]], ""
                at += 1
            if kind == 0:
                own = facts[i].as_py()
                audit, roles, at = own["audit"], own["roles"], 0
                yield (own,)
            else:
                role = _NAMES[roles[at]] if audit[at] == "R" else old[i].as_py()
                yield audit[at], role, texts[i].as_py()
                at += 1
    for i in range(at, len(audit)):
        yield "I", _NAMES[roles[i]], ""


def repaired_turns(turns: DataFrame, judged: DataFrame) -> DataFrame:
    """conv_id, step (from 0), edit, role, text: every edit in order; the repaired conversation is those that are no D."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, conv, step = [], None, 0
        made = lambda: pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", pa.int64()), ("step", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
        for event in _events(batches):
            if len(event) == 1:
                conv, step = event[0]["conv_id"], 0
                continue
            rows.append(dict(zip(("conv_id", "step", "edit", "role", "text"), (conv, step, *event), strict=True)))
            step += 1
            if len(rows) == 512:
                yield made()
                rows = []
        if rows:
            yield made()

    return _with_edits(turns, judged).mapInArrow(run, "conv_id long, step long, edit string, role string, text string")


_SHOWN = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repairs_digest(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` after damage(): faults, cost, audit and the hash of the repaired turns.

    A conversation of which no row is left has zeros, an empty audit and the hash of an empty text.
    """
    damaged = damage(turns)
    judged = audits(signatures(damaged))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest, lines, done = None, None, 0, []

        def made(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", pa.int64()), *((c, pa.string() if c == "audit" else pa.int64()) for c in _SHOWN), ("repaired_sha256", pa.string())]))

        closed = lambda: {c: own[c] for c in ("conv_id", *_SHOWN)} | {"repaired_sha256": digest.hexdigest()}
        for event in _events(batches):
            if len(event) == 1:
                if own is not None:
                    done.append(closed())
                own, digest, lines = event[0], hashlib.sha256(), 0
                if len(done) == 512:
                    yield made(done)
                    done = []
            elif event[0] != "D":
                digest.update(f"{chr(10) if lines else ''}{event[1]}:{event[2]}".encode())
                lines += 1
        if own is not None:
            yield made([*done, closed()])

    kinds = ", ".join(f"{c} {'string' if c == 'audit' else 'long'}" for c in _SHOWN)
    found = _with_edits(damaged, judged).mapInArrow(run, f"conv_id long, {kinds}, repaired_sha256 string")
    ids = turns.select(F.col("conv_id").cast("long").alias("id")).distinct()
    absent: dict[str, Column] = {c: F.lit("") if c == "audit" else F.lit(0).cast("long") for c in _SHOWN}
    absent["repaired_sha256"] = F.sha2(F.lit(""), 256)
    return ids.join(found, ids["id"].eqNullSafe(found["conv_id"]), "left").select(F.col("id").alias("conv_id"), *[F.coalesce(c, d).alias(c) for c, d in absent.items()])
