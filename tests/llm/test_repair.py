import hashlib
import re
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from costmart.llm import repair
from costmart.llm.queries import QUERIES

GOOD = re.compile("(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    """By conversation: rows after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        h = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        kept += [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def brute(rows):
    """The digest columns but conv_id, from all edit sequences of a shortest-path table over whole audits."""
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen, options = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in rows:
        solid = text.rstrip(WHITE)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        cut = 5 if fault == "truncated" else 0
        mine = [("D", 2, None)]
        if fault not in ("blank", "duplicate"):
            mine += [("K", cut, f"{role}:{text}"), ("R", 1 + cut, f"user:{text}"), ("R", 1 + cut, f"assistant:{text}")]
        options.append(mine)
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    inserts = [("I", 5, "user:"), ("I", 5, "assistant:")]

    def better(table, key, value):
        if key not in table or value < table[key]:
            table[key] = value
            return True
        return False

    def spread(table):
        changed = True
        while changed:
            changed = False
            for key, (cost, audit, out) in list(table.items()):
                for letter, price, line in inserts:
                    new = state(key, line)
                    changed |= new is not None and better(table, new, (cost + price, audit + letter, (*out, line)))
        return table

    def state(written, line):
        """The written initials, with pairs past the first left out; None: no beginning of a good form."""
        new = written + ("" if line is None else line[:1])
        return new.replace("uaua", "ua") if re.fullmatch("s?(ua)*u?", new) else None

    table = spread({"": (0, "", ())})
    for mine in options:
        after = {}
        for key, (cost, audit, out) in table.items():
            for letter, price, line in mine:
                new = state(key, line)
                if new is not None:
                    better(after, new, (cost + price, audit + letter, out if line is None else (*out, line)))
        table = spread(after)
    cost, audit, out = min(v for k, v in table.items() if GOOD.fullmatch("".join(x[:1] for x in v[2])))
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def table(spark, rows):
    schema = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType()),
                         StructField("live", IntegerType()), StructField("copies", IntegerType()), StructField("f_text", StringType())])
    return spark.createDataFrame([(*r, 0, 9, "z") for r in rows], schema).repartition(3)


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def rows_of(r, n, longest=9):
    roles, texts = ["user", "assistant", "system", "tool", None, "u"], ["a.", "b!", "c", " ", "", None, "d?", "d? ", "e.x"]
    return [(c, r.choice([None, 0, 1, 2, 3, 5, 8, t]), r.choice(roles), r.choice(texts)) for c in range(n) for t in range(r.randint(1, longest))]


def streamed(rows, block):
    """A conversation read by the class alone, with blocks of another length."""
    c, seen, kept = repair.Conversation(1), set(), repair.BLOCK
    repair.BLOCK = block
    try:
        for turn, role, text in rows:
            solid, first = text.rstrip(WHITE), role[:1] if role[:1] and role[:1] in "sua" else "o"
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            symbol = "x" if fault in ("blank", "duplicate") else first.upper() if fault else first
            list(c.read(turn, role, text, symbol, fault, first))
        list(c.block(True))
    finally:
        repair.BLOCK = kept
    return c.digest()[1:]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.none() | st.integers(0, 9), st.sampled_from(["user", "assistant", "system", "tool", " "]),
                          st.sampled_from(["a.", "b!", "c", " ", "d?", "e", "f.", "g.", "h"])), max_size=14), st.sampled_from([1, 2, 3, 64]))
def test_agenda_equals_brute_force_at_any_block_length(rows, block):
    rows = in_order(rows)
    assert streamed(rows, block) == brute(rows)


def test_query_form_equals_brute_force(llm):
    import random

    r = random.Random(3)
    rows = rows_of(r, 150) + [(None, t, "user", "x.") for t in range(4)] + [(1000, None, None, None)] + [(2000, 7, "user", "same.")] * 40
    wanted = {c: brute(in_order(kept)) for c, kept in damaged(rows).items()}
    assert found(repair.digest(repair.damage(table(llm, rows)))) == wanted


def test_whole_query_equals_brute_force(llm, sf_dir):
    rows = [tuple(r) for r in llm.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_conversation_repair"](llm, sf_dir)) == {c: brute(in_order(kept)) for c, kept in damaged(rows).items()}


def test_long_conversation_is_committed_as_it_is_read():
    c, most = repair.Conversation(1), 0
    for i in range(20_000):
        kind = ["user", "assistant", "assistant", "user", "tool", "system"][i * 7 % 11 % 6]
        symbol = {"tool": "o"}.get(kind, kind[:1])
        list(c.read(i, kind, f"{i}.", symbol if i % 13 else symbol.upper(), "", symbol))
        most = max(most, len(c.pending))
    list(c.block(True))
    assert most <= 4 * repair.BLOCK and len(c.digest()[7]) >= 20_000
    blank = repair.Conversation(2)
    for i in range(5_000):
        list(blank.read(i, "user", "", "x", "blank", "u"))
        most = max(most, len(blank.pending))
    list(blank.block(True))
    assert most <= 4 * repair.BLOCK and blank.digest()[7] == "D" * 5_000


def test_edits_of_a_repair(llm):
    rows = [(1, 0, "user", "hi."), (1, 1, "user", "there."), (1, 2, "assistant", ""), (1, 3, "system", "no."), (2, 0, "assistant", "first."), (2, 1, "assistant", "cut")]
    out = sorted(((r.conv_id, r.turn if r.turn is not None else 99, r.edit, r.place, r.role, r.text) for r in repair.repair(table(llm, rows)).collect()))
    assert out == [(1, 0, "D", None, "user", "hi."), (1, 1, "K", 0, "user", "there."), (1, 2, "D", None, "assistant", ""), (1, 3, "R", 1, "assistant", "no."),
                   (2, 0, "D", None, "assistant", "first."), (2, 1, "D", None, "assistant", "cut")]
    for conv in (1, 2):
        written = "".join(x[4][0] for x in sorted((x for x in out if x[0] == conv and x[3] is not None), key=lambda x: x[3]))
        assert GOOD.fullmatch(written)


@pytest.mark.parametrize("rows", [[], [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", "x" * 500_000)]])
def test_empty_table_and_very_long_texts(llm, rows):
    out = found(repair.digest(repair.named(table(llm, rows))))
    assert out == ({1: brute(in_order([r[1:] for r in rows]))} if rows else {})
