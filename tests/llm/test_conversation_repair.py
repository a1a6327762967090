from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import conversation_repair as cr

WS = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile(r"(s?(ua)+)?")


# ---- brute force: every script of edits, and a plain walk over the grammar's states
def every_script(rows):
    """All (cost, audit) of scripts that give a string of the grammar; no more insertions than
    can pay."""
    found, most = [], len(rows) + 2

    def go(i, out, cost, audit, inserted):
        if i == len(rows) and GRAMMAR.fullmatch(out):
            found.append((cost, audit))
        if inserted < most:
            for c in "ua":
                if GRAMMAR.fullmatch(out + c) or GRAMMAR.fullmatch(out + c + "a"):
                    go(i, out + c, cost + 3, audit + "I", inserted + 1)
        if i == len(rows):
            return
        init, must, extra = rows[i]
        go(i + 1, out, cost + 4, audit + "D", inserted)
        if not must:
            for c, price, edit in ((init, 0, "K"), ("u", 3, "R"), ("a", 3, "R")):
                ok = GRAMMAR.fullmatch(out + c) or GRAMMAR.fullmatch(out + c + "a") \
                    or GRAMMAR.fullmatch(out + c + "ua")
                if ok and c in "sua":
                    go(i + 1, out + c, cost + price + extra, audit + edit, inserted)

    go(0, "", 0, "", 0)
    return min(found)


def by_states(rows):
    """The least (cost, audit) by full audits for each state after each row."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    live = {0: (0, "")}

    def add(to, q, cand):
        if q not in to or cand < to[q]:
            to[q] = cand

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for p, (c, a) in list(out.items()):
                for ch in "ua":
                    if (p, ch) in step:
                        add(out, step[p, ch], (c + 3, a + "I"))
        return out

    for init, must, extra in rows:
        new = {}
        for p, (c, a) in inserted(live).items():
            add(new, p, (c + 4, a + "D"))
            if not must:
                if (p, init) in step:
                    add(new, step[p, init], (c + extra, a + "K"))
                for ch in "ua":
                    if (p, ch) in step:
                        add(new, step[p, ch], (c + 3 + extra, a + "R"))
        live = new
    return min(v for q, v in inserted(live).items() if q in (0, 3))


def whole(symbols, chunk=cr.CHUNK):
    return cr.chain([cr.align(symbols[i:i + chunk]) for i in range(0, len(symbols), chunk)])


def test_short_conversations_against_every_script():
    rng = random.Random(1)
    cases = {"".join(rng.choices("suaxSUAX0123", k=n)) for n in (1, 2, 3) for _ in range(60)}
    cases |= {"".join(rng.choices("suaUA1", k=4)) for _ in range(40)}
    for symbols in cases:
        assert whole(symbols) == every_script(cr._rows(symbols)), symbols


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64])
def test_long_conversations_against_states(chunk):
    rng = random.Random(chunk)
    for _ in range(150):
        n = rng.randint(1, 40)
        alphabet = rng.choice(["suaxSUAX0123", "ua", "uaUA", "uua1", "s", "ssu", "a", "x", "0"])
        symbols = "".join(rng.choices(alphabet, k=n))
        assert whole(symbols, chunk) == by_states(cr._rows(symbols)), symbols
    regular = list("ua" * 150)
    for _ in range(40):
        regular[rng.randrange(300)] = rng.choice("suaxUA01")
    assert whole("".join(regular), chunk) == by_states(cr._rows("".join(regular)))


def test_no_turns():
    assert cr.chain([]) == (0, "")
    assert list(cr.apply_audit("", [])) == []


# ---- the whole query
def expected(rows):
    """The contract in plain Python; turns of equal number are ordered as the docstring says."""
    groups, ids = defaultdict(list), []
    for conv, turn, role, text in rows:
        ids.append(conv)
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        groups[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv in set(ids):
        turns = sorted(groups[conv], key=lambda r: (
            r[0] is not None, r[0] or 0,
            hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        seen, state, counts = set(), [], [0, 0, 0]
        for _, role, text in turns:
            last = text.strip(WS)[-1:]
            fault = (0 if not last else 1 if (role, text) in seen else
                     2 if last not in ".!?" else None)
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            state.append((role[:1], fault in (0, 1), 3 if fault == 2 else 0))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(state, state[1:]))
        cost, audit = by_states(state)
        lines, at, want = [], 0, "u"
        for e in audit:
            if e == "I":
                lines.append("user:" if want == "u" else "assistant:")
            else:
                _, role, text = turns[at]
                at += 1
                if e == "D":
                    continue
                lines.append(f"{role if e == 'K' else 'user' if want == 'u' else 'assistant'}:"
                             f"{text}")
            want = "a" if lines[-1][0] == "u" else "u"
        out.append((conv, gaps, *counts, illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
           "repaired_sha256"]


def got(df):
    return sorted((tuple(r) for r in cr.repair_damaged(df).select(*COLUMNS).collect()), key=str)


def test_whole_table(spark):
    from tests.llm.conftest import SF
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(df) == expected(rows)


EDGE = [(1, None, "user", "a."), (1, 2, "user", "a."), (1, 9, "assistant", "b!"),
        (2, 0, None, None), (2, 1, "user", "  \n"), (2, 1, "user", "  \n"),
        (None, 3, "system", "x?"), (None, None, "user", "no end"), (None, 4, "Tool", "y."),
        (3, 0, "system", "s."), (4, 0, "", "t."), (5, 5, "user", "long " * 40_000 + "."),
        (5, 6, "agent", "ends in blanks. \t\r\n\x0b\x0c"), (6, -3, "user", "é。"),
        (6, 0, "assistant", "k."), (6, 0, "assistant", "j."), (6, 0, "user", "j.")]


def test_edge_rows(spark):
    rows = EDGE + [(i, t, r, f"{r} {t}.") for i in range(100, 160) for t, r in
                   enumerate(["system", "user", "assistant", "user", "assistant"])]
    df = spark.createDataFrame([(*r, "mine", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, "
                               "audit string, Role_ int")
    assert got(df) == expected(rows)
    assert got(df.where("false")) == []


def test_hot_conversation_spreads_and_repairs(spark):
    """One conversation holds most rows: its chunks lie in several parts, its audit is whole."""
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"turn {t % 300}.")
            for t in range(1500)] + [(i, 0, "user", "hello.") for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(df) == expected(rows)
    turns = cr.damage(df)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        spark.conf.set(coalesce, "false")     # the parts are small here
        placed = cr._placed(turns).where("conv_id = 7")
    finally:
        spark.conf.set(coalesce, "true")
    parts = placed.select((F.col("pos") / 2 ** 33).cast("long")).distinct().count()
    assert parts > 1
    assert placed.groupBy(F.floor(F.col("pos") / cr.CHUNK)).count().agg(
        F.max("count")).first()[0] <= cr.CHUNK


def test_repaired_turns(spark):
    """The real output: rows of the grammar, and the digest is theirs."""
    rows = [(c, t, r, f"{c} {t}.") for c in range(60)
            for t, r in enumerate(["user", "assistant", "assistant", "user"])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = cr.damage(df)
    found = cr.audits(turns)
    lines = defaultdict(list)
    for r in sorted(cr.repaired_turns(turns, found).collect(), key=lambda r: (r[0], r[1])):
        assert r["turn"] == len(lines[r["conv_id"]]) and r["edit"] in "KRI"
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for conv, _, _, _, _, _, _, _, sha in expected(rows):
        mine = lines[conv]
        assert GRAMMAR.fullmatch("".join(x[0] for x in mine))
        assert hashlib.sha256("\n".join(mine).encode()).hexdigest() == sha
