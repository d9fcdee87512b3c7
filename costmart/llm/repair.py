"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is well formed if its role initials match ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turn, or nothing at all. Its
turns are edited into that form at least cost: Keep costs 0, Rerole (to user or
assistant) 1, Delete 2, Insert (an empty turn of user or assistant) 5; a blank
or duplicate turn must be deleted, and a truncated one adds 5 unless deleted.
The audit is the initials of the edits in order; among repairs of equal cost the
least audit in ASCII order wins.

A turn's first fault counts: blank (no character but white space), duplicate
(role and text seen earlier in the conversation), truncated (its last solid
character is none of ``.!?``).

**Deduction.** Repairs are weighted hypergraph deductions. An item ``(i, q)``
says that i turns are read and the roles written so far lead to state q; an
item ``(i, edit, role)`` says what the edit of turn i writes. A hyperedge
leads from an item and the next turn's edit, both final, to ``(i + 1, q')``;
inserting is an edge with one tail. The weight of a head is a superior function
of its tails' weights: costs add up, audits are joined. An agenda pops items by
(cost, audit), so an item is final when popped, and the goal's first pop is the
lightest repair. (Of two audits of equal cost at one item none begins with the
other, as the same number of turns is read and an insertion costs; so the order
of audits survives what is joined to them.)

**Spark.** Equal rows are counted first, and whether a row's text came earlier
is found by an aggregate and a join on whole rows, so no group of equal rows is
held anywhere. Then the rows are dealt by conversation, sorted, and streamed:
turns are read in blocks of ``BLOCK``, the final items of a block being the
axioms of the next. The part of the audit that all items still in the running
share is committed at once; items that can no longer win are left out. So a
task holds a block or a few of a conversation, however long it is, besides its
audit of one letter a turn. A conversation's digest is one running SHA-256, so a
conversation is one task's work from start to end; it has no parallel form.

Cases: nulls in conv_id or turn stay (a null conv_id is a conversation of its
own, null turns come first); null roles and texts are one space; turns with
equal numbers are in the order of role, then text (by code points); equal rows
follow each other; other roles, empty ones too, have no legal initial unless
they begin with s, u or a; a conversation whose rows are all gone has zeros, an
empty audit and the digest of the empty text; very long texts are only held for
turns not yet committed; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES
from .common import _arrow_schema as arrow_schema

#: Turns read by one agenda, and the last this many distinct blocks whose items are remembered.
BLOCK, REMEMBERED = 64, 1 << 14
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: What a state does with a written initial. 0: nothing written, 1: after s, 2: after u, 3: after a.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
#: Any future of the first state can be had from the second at this price at most.
AT_MOST = {(0, 1): 2 * INSERT, (0, 2): INSERT + DELETE, (0, 3): DELETE, (1, 0): 0, (1, 2): INSERT, (1, 3): 0,
           (2, 0): INSERT, (2, 1): INSERT, (2, 3): INSERT, (3, 0): 0, (3, 1): 2 * INSERT, (3, 2): INSERT}
ROLES = {"u": "user", "a": "assistant"}


def edits(symbol: str) -> list[tuple[str, int, str]]:
    """(letter, cost, written initial) of a turn. A symbol is x (to be deleted),
    or the role's initial (o: any other), in upper case if the turn is truncated."""
    if symbol == "x":
        return [("D", DELETE, "")]
    cut = CUT if symbol.isupper() else 0
    kept = [("K", KEEP + cut, symbol.lower())] if symbol not in "oO" else []
    return [*kept, ("R", REROLE + cut, "u"), ("R", REROLE + cut, "a"), ("D", DELETE, "")]


def agenda(symbols: str, axioms: tuple[tuple[int, int, str], ...], last: bool) -> dict[int, tuple[int, str]]:
    """{state: (cost, audit)} after the turns ``symbols``, from axioms (state, cost, audit).

    With ``last`` only the lightest final state is wanted: the goal, whose first
    pop ends the search."""
    heap = [(cost, audit, ("at", 0, q)) for q, cost, audit in axioms]
    for i, s in enumerate(symbols):  # the edits are axioms too
        for letter, cost, role in edits(s):
            heappush(heap, (cost, letter, ("edit", i, role)))
    heap.sort()
    final: dict[tuple, tuple[int, str]] = {}
    places: dict[int, list[int]] = {}  # final items (i, q), by i
    writes: dict[int, list[str]] = {}  # final edits of turn i

    def join(i: int, q: int, role: str) -> None:
        """The hyperedge of item (i, q) and an edit of turn i."""
        after = q if role == "" else NEXT.get((q, role))
        if after is not None and ("at", i + 1, after) not in final:
            (c, a), (d, b) = final["at", i, q], final["edit", i, role]
            heappush(heap, (c + d, a + b, ("at", i + 1, after)))

    while heap:
        cost, audit, item = heappop(heap)
        if item in final:
            continue
        final[item] = (cost, audit)
        kind, i, x = item
        if kind == "goal":
            break
        if kind == "edit":
            writes.setdefault(i, []).append(x)
            for q in places.get(i, ()):
                join(i, q, x)
            continue
        places.setdefault(i, []).append(x)
        for role in writes.get(i, ()):
            join(i, x, role)
        for role in "ua":
            after = NEXT.get((x, role))
            if after is not None and ("at", i, after) not in final:
                heappush(heap, (cost + INSERT, audit + "I", ("at", i, after)))
        if last and i == len(symbols) and x in FINAL:
            heappush(heap, (cost, audit, ("goal", i, x)))
    if last:
        return {item[2]: w for item, w in final.items() if item[0] == "goal"}
    return {item[2]: w for item, w in final.items() if item[:2] == ("at", len(symbols))}


remembered = lru_cache(REMEMBERED)(agenda)


class Conversation:
    """Reads a conversation's turns in order and gives out its edits."""

    def __init__(self, conv_id):
        self.conv_id, self.hash, self.wrote, self.system = conv_id, hashlib.sha256(), 0, False
        self.items: tuple[tuple[int, int, str], ...] = ((0, 0, ""),)
        self.symbols: list[str] = []  # of the block under way
        self.pending: list[tuple] = []  # turns not committed: (turn, role, text)
        self.audit: list[str] = []
        self.turns, self.least, self.most, self.last_turn = 0, None, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial = None

    def read(self, turn, role, text, symbol, fault, initial) -> Iterator[tuple]:
        if turn is not None and turn != self.last_turn:
            self.turns, self.last_turn, self.most = self.turns + 1, turn, turn
            self.least = turn if self.least is None else self.least
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        self.illegal += self.initial is not None and (self.initial, initial) not in (("s", "u"), ("u", "a"), ("a", "u"))
        self.initial = initial
        self.symbols.append(symbol)
        self.pending.append((turn, role, text))
        if len(self.symbols) == BLOCK:
            yield from self.block(False)

    def block(self, last: bool) -> Iterator[tuple]:
        search = remembered if sum(len(a) for _, _, a in self.items) < 4 * BLOCK else agenda
        found = search("".join(self.symbols), self.items, last)
        self.symbols.clear()
        self.items = tuple((q, *w) for q, w in sorted(found.items()) if not any(
            w[0] > v[0] + AT_MOST[q, r] for r, v in found.items() if (q, r) in AT_MOST))
        sure = commonprefix([a for _, _, a in self.items])
        if last:
            self.cost = self.items[0][1]
        self.items = tuple((q, c, a[len(sure):]) for q, c, a in self.items)
        yield from self.commit(sure)

    def commit(self, letters: str) -> Iterator[tuple]:
        self.audit.append(letters)
        read = 0
        for letter in letters:
            turn, role, text = (None, None, "") if letter == "I" else self.pending[read]
            read += letter != "I"
            if letter == "D":
                yield self.conv_id, None, letter, turn, role, text
                continue
            if letter in "RI":  # roles alternate, after a system turn or none
                role = ROLES["ua"[(self.wrote - self.system) % 2]] if self.wrote else "user"
            if not self.wrote:
                self.system = letter == "K" and role[:1] == "s"
            self.hash.update((("\n" if self.wrote else "") + f"{role}:{text}").encode())
            yield self.conv_id, self.wrote, letter, turn, role, text
            self.wrote += 1
        del self.pending[:read]

    def digest(self) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


DIGEST = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
EDITS = "conv_id long, place long, edit string, turn long, role string, text string"


def named(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, live): null roles and texts are one space."""
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return conversations.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                                space(role_col).alias("role"), space(text_col).alias("text"), F.lit(True).alias("live"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of ``named``, damaged by crc32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4
    makes it a user's. Dropped rows stay as dead rows of their conversation."""
    rows = named(conversations)
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    h = F.crc32(key.cast("binary")) % 20
    text = F.when(h == 1, "").when(h == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(h == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (h != 0).alias("live"),
                       F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """Distinct rows in streaming order: (conv_id, turn, role, text, copies, symbol, fault, initial).

    ``symbol`` and ``fault`` are the first copy's; the others are duplicates, or
    blank like it. Dead rows of a conversation are one row without copies."""
    live = F.col("live")
    cells = rows.select("conv_id", *(F.when(live, F.col(c)).alias(c) for c in ("turn", "role", "text")), "live")
    cells = cells.groupBy("conv_id", "turn", "role", "text", "live").agg(F.count(F.lit(1)).alias("n"))
    first = (cells.where(live).groupBy(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("text").alias("f_text"))
             .agg(F.min(F.struct("turn")).getField("turn").alias("f_turn")).withColumn("is_first", F.lit(True)))
    same = (F.col("conv_id").eqNullSafe(F.col("f_conv")) & F.col("turn").eqNullSafe(F.col("f_turn"))
            & F.col("role").eqNullSafe(F.col("f_role")) & F.col("text").eqNullSafe(F.col("f_text")))
    flagged = cells.join(first, same, "left")
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    fault = (F.when(solid == "", "blank").when(F.col("is_first").isNull(), "duplicate")
             .when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "truncated").otherwise(""))
    out = flagged.withColumn("fault", fault)
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    return out.select("conv_id", "turn", "role", "text", F.when(live, F.col("n")).otherwise(0).alias("copies"), symbol.alias("symbol"), "fault", initial.alias("initial"))


def stream(rows: DataFrame, digests: bool) -> DataFrame:
    """Rows dealt by conversation and read in order: a digest each, or all edits."""
    ordered = (judged(rows).repartition("conv_id")
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()))
    schema = DIGEST if digests else EDITS
    arrow = arrow_schema(schema)

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for batch in batches:
            for conv_id, turn, role, text, copies, symbol, fault, initial in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        yield from now.block(True)
                        yield now
                    now = Conversation(conv_id)
                for copy in range(copies):
                    yield from now.read(turn, role, text, "x" if copy else symbol, "duplicate" if copy and fault != "blank" else fault, initial)
        if now is not None:
            yield from now.block(True)
            yield now

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        held = 0
        for x in edited(batches):
            ended = isinstance(x, Conversation)
            if ended == digests:
                made.append(x.digest() if ended else x)
                held += len(made[-1][7] if ended else x[5])
            if made and (len(made) == 4096 or held > 4_000_000):
                yield batch_of(made, arrow)
                made, held = [], 0
        if made:
            yield batch_of(made, arrow)

    return ordered.mapInArrow(run, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def digest(rows: DataFrame) -> DataFrame:
    """One row a conversation of ``named`` or ``damage``: gaps, faults, cost, audit and the digest of the repaired turns."""
    return stream(rows, True)


def repair(conversations: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): every edit in order, with the
    role it leaves; place counts the repaired turns from 0 (null: deleted), and
    inserted turns have no turn number."""
    return stream(named(conversations, **columns), False)
