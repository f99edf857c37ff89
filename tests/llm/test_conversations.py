import hashlib
import re
import zlib
from itertools import product

import pytest
from helpers import MEDIUM, SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from starledger.llm import auditdp as dp
from starledger.llm import conversations as C
from starledger.llm.catalog import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]")
SHAPE = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for c, t, role, text in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        case = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case == 0:
            continue
        if case == 1:
            text = ""
        if case == 2:
            text = re.sub("[.!?]", "", text)
        if case == 4:
            role = "user"
        out += [(c, t, role, text)] * (2 if case == 3 else 1)
    return out


def best_edit(rows):
    """(cost, audit) by keeping every cheapest history of every state, as a string."""
    def inserted(best):
        for _ in range(2):
            for s, (cost, text) in list(best.items()):
                if len(s) < 3:
                    add(best, step(s, "u" if s in ("", "s", "a") else "a"), cost + 5, text + "I")
        return best

    def step(state, initial):          # state: "", "s", "u", "a" (the last turn)
        if initial == "s":
            return "s" if state == "" else None
        if initial == "u":
            return "u" if state != "u" else None
        return "a" if initial == "a" and state == "u" else None

    def add(best, state, cost, text):
        if state is not None and (state not in best or (cost, text) < best[state]):
            best[state] = (cost, text)

    best = {"": (0, "")}
    for initial, gone, truncated in rows:
        after = {}
        for s, (cost, text) in inserted(best).items():
            add(after, s, cost + 2, text + "D")
            if not gone:
                add(after, step(s, initial), cost + 5 * truncated, text + "K")
                for to in "ua":
                    add(after, step(s, to), cost + 5 * truncated + 1, text + "R")
        best = after
    return min(v for s, v in inserted(best).items() if s in ("", "a"))


def by_all_strings(rows):
    """The same by trying every history of up to len(rows) + 2 edits."""
    found = []
    for extra in range(3):
        for audit in product("DIKR", repeat=len(rows) + extra):
            if sum(e != "I" for e in audit) != len(rows) or audit.count("I") != extra:
                continue
            options, cost, i = [""], 0, 0
            for e in audit:
                if e == "I":
                    cost, turns = cost + 5, "ua"
                else:
                    initial, gone, truncated = rows[i]
                    i += 1
                    if e == "D":
                        cost += 2
                        continue
                    cost += (e == "R") + 5 * truncated + (1000 if gone else 0)
                    turns = initial if e == "K" else "ua"
                options = [o + t for o in options for t in turns]
            if cost < 1000 and any(SHAPE.fullmatch(o) for o in options):
                found.append((cost, "".join(audit)))
    return min(found)


def expected(rows):
    out = {}
    kept = damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, _, role, text in own:
            last = WORD.findall(text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen
                          else "truncated" if last[0] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in own]
        cost, audit = best_edit([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)])
        repaired, i, state = [], 0, ""
        for e in audit:
            turn = "assistant" if state == "u" else "user"
            if e == "I":
                repaired.append(turn + ":")
                state = turn[0]
                continue
            _, _, role, text = own[i]
            i += 1
            if e != "D":
                role = role if e == "K" else turn
                repaired.append(f"{role}:{text}")
                state = role[:1]
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
                     hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in NAMES) for r in rows}


def frame(spark, rows):
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                           *[T.StructField(c, T.StringType()) for c in ("n", "at", "part", "copies", "edit", "cost")]])
    return spark.createDataFrame([(*r, *"xxxxxx") for r in rows], schema)


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_conversation_repair"](spark, sf_dir)) == expected(rows)


ROLES = ["user", "assistant", "system", "tool", "unknown", "", None]


def odd_rows():
    rows = [(None, None, None, None), (None, 3, "user", "No conversation. "), (None, 3, "user", "No conversation. "),
            (1, None, "assistant", "no turn"), (1, 2, "user", "Ends."), (1, 2, "user", "Also of turn two."), (1, 2, "system", "x."),
            (2, 5, "user", "a" * 300_000), (2, 9, "assistant", "long " * 60_000 + ".\n\n"), (3, 0, "user", "  \t"),
            (4, 1, "user", "été 你好!"), (4, 2, "assistant", "\x1c?"), (5, -3, "tool", "Fine."), (6, 7, "", "Fine.")]
    rows += [(7, i, "user" if i % 2 else "assistant", f"Turn {i % 40}.") for i in range(300)]
    rows += [(None, i % 11, ROLES[i % 7], ["Yes.", "No", "", None, "  "][i % 5]) for i in range(400)]
    rows += [(10 + i, t, ROLES[(i * t + t) % 7], f"{i % 3} {t % 2}" + ". "[t % 2]) for i in range(150) for t in range(i % 6)]
    return rows


@pytest.mark.parametrize("part", [5, 1 << 14])
def test_odd_rows(spark, part, monkeypatch):
    """Parts of five rows cut most conversations, so their tables are put together."""
    monkeypatch.setattr(C, "PART", part)
    rows = odd_rows()
    assert got(C.digests(frame(spark, rows).repartition(6))) == expected(rows)


def test_empty_table(spark):
    assert C.digests(frame(spark, odd_rows()).limit(0)).count() == 0


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "More."), (1, 2, "user", "Thanks."), (1, 3, "user", "cut off")]
    turns = C.repair(frame(spark, rows).withColumn("copies", C.F.lit(1).cast("long"))).turns.orderBy("at", "nth").collect()
    assert SHAPE.fullmatch("".join(t["role"][0] for t in turns)) and [t["edit"] for t in turns] == ["R", "K"]
    assert [(t["role"], t["text"]) for t in turns] == [("user", "Hello."), ("assistant", "More.")]


ROW = st.tuples(st.sampled_from("uast"), st.booleans(), st.booleans())


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=5))
def test_states_against_every_string(rows):
    assert best_edit(rows) == by_all_strings(rows)


@settings(max_examples=400, deadline=None)
@given(st.lists(ROW, max_size=40))
def test_histories(rows):
    assert dp.least(dp.histories([(*r, 0) for r in rows], dp.E))[:2] == best_edit(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(ROW, st.integers(0, 3)), min_size=1, max_size=25), st.lists(st.integers(1, 24), max_size=4))
def test_parts_and_copies(rows, cuts):
    chain, at = dp.Chain(), sorted({0, *(c for c in cuts if c < len(rows)), len(rows)})
    parts = [[(*r, n) for r, n in rows[s:e]] for s, e in zip(at, at[1:], strict=False)]
    for k, part in enumerate(parts):
        chain.add(k, {(s, e): end for s in range(4) for e, end in enumerate(dp.histories(part, s)) if end})
    cost, chosen = chain.end()
    flat = [x for r, n in rows for x in (r, *[(r[0], True, False)] * n)]
    assert (cost, "".join(c[3] for c in chosen)) == best_edit(flat) and [c[0] for c in chosen] == list(range(len(parts)))


def test_wrong_hashes_change_nothing(monkeypatch):
    """Every hash collides: the chains themselves decide."""
    rows = [("uast"[(i * i + i // 3) % 4], i % 7 == 0, i % 5 == 0, 0) for i in range(60)]
    right = dp.histories(rows, dp.E)
    monkeypatch.setattr(dp, "MOD", 1)
    assert dp.histories(rows, dp.E) == right


def test_a_long_conversation():
    rows = [("uast"[(i * 7 + i // 5) % 4], i % 9 == 0, i % 4 == 0, 0) for i in range(C.PART)]
    cost, text, _ = dp.least(dp.histories(rows, dp.E))
    assert (cost, text) == best_edit([r[:3] for r in rows])
