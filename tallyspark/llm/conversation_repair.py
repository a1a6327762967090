"""Repair of conversations: each is aligned to the strings of an alternating grammar.

A repaired conversation is empty, or an optional system turn and then one or more pairs of a user
and an assistant turn. ``Keep`` costs 0, ``Rerole`` (to user or assistant) 3, ``Insert`` (an empty
user or assistant turn) 3, ``Delete`` 4; a truncated turn that stays costs 3 more, and blank and
repeated turns must go. A target is a string of the grammar of one length. All targets that end
alike share one Wagner-Fischer table of costs to go, cut to the Ukkonen band of the incumbent's
cost; the lengths of least cost are traced back, and the least audit in ASCII order wins.

Conversations have any length, so their turns are cut into chunks of at most ``CHUNK`` rows. Each
chunk is aligned for every pair of grammar states before and after it, where the targets are the
pieces of the grammar's strings between the two; then the chunks of one conversation are chained.
An insertion belongs to the turn after it, so no audit of a chunk is the beginning of another, and
the least audits of the chunks are parts of the least audit of the whole.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain as chain_of
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import pick, stored

KEEP, REROLE, INSERT, DELETE, CUT_OFF = 0, 3, 3, 4, 3
#: Turns of one conversation that are aligned together.
CHUNK = 64
BLANKS = " \t\n\x0b\x0c\r"
#: States of the grammar by what has been put out so far: nothing, the system turn, a user turn
#: last, an assistant turn last. A repair ends in the first or the last one.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
#: What is inserted after the last turn.
CLOSE = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
FAR = 1 << 60


# ------------------------------------------------------------------ alignment of one chunk
def _incumbent(rows: list, state: int) -> int:
    """The cost of a plain repair from ``state`` to either state in u or a: every turn that may
    stay is kept or reroled; the last one may be deleted behind one insertion instead."""
    cost, want = 0, NEXT[state]
    for init, must, extra in rows:
        if must:
            cost += DELETE
        else:
            cost += extra + (KEEP if init == want else REROLE)
            want = "a" if want == "u" else "u"
    return cost + DELETE + 2 * INSERT


def _table(rows: list, last: str, bound: int) -> list[dict]:
    """``g[i][r]``: least cost of turning ``rows[i:]`` into the last ``r`` characters of a target
    that ends in ``last``, without an insertion after the last row. Cells whose lengths differ by
    more than ``bound`` pays for are left out (Ukkonen's band)."""
    n = len(rows)
    g = [{} for _ in range(n)] + [{0: 0}]
    for i in range(n - 1, -1, -1):
        init, must, extra = rows[i]
        below, here, left = g[i + 1], g[i], n - i
        keep = extra + KEEP
        for r in range(max(0, left - bound // DELETE), left + bound // INSERT + 1):
            best = below.get(r, FAR) + DELETE
            if r:
                best = min(best, here.get(r - 1, FAR) + INSERT)
                if not must:
                    own = init == (last if r % 2 else "u" if last == "a" else "a")
                    best = min(best, below.get(r - 1, FAR) + (keep if own else extra + REROLE))
            if best < FAR:
                here[r] = best
    return g


def _trace(rows: list, last: str, g: list[dict], i: int, r: int) -> str:
    """The least audit among the cheapest from the cell ``(i, r)``: at each cell the first edit
    in ASCII order that costs no more than the least."""
    out, n = [], len(rows)
    while i < n:
        cost, (init, must, extra) = g[i][r], rows[i]
        if cost == g[i + 1].get(r, FAR) + DELETE:
            out.append("D")
            i += 1
        elif r and cost == g[i].get(r - 1, FAR) + INSERT:
            out.append("I")
            r -= 1
        else:
            own = init == (last if r % 2 else "u" if last == "a" else "a")
            out.append("K" if own else "R")
            i, r = i + 1, r - 1
    return "".join(out)


def _rows(symbols: str) -> list:
    """(role initial, must be deleted, extra cost if it stays) of each turn."""
    return [("suax"["0123".index(c)], True, 0) if c in "0123" else
            (c.lower(), False, CUT_OFF if c.isupper() else 0) for c in symbols]


@lru_cache(maxsize=200_000)
def align(symbols: str) -> tuple:
    """``(before, after, cost, audit)`` for every pair of states that the chunk can link."""
    rows = _rows(symbols)
    n = len(rows)
    gone = "D" * n
    best = {(s, s): (DELETE * n, gone) for s in range(4)}
    # a cost that every pair of states can be had for; an 's' that is kept first saves at most
    # its own edit, so paths with it lie within the same bound
    bound = max(_incumbent(rows, s) for s in (NOTHING, USER))

    def offer(pair, cost, audit):
        if pair not in best or (cost, audit) < best[pair]:
            best[pair] = (cost, audit)

    tables = {q: _table(rows, last, bound) for q, last in ((USER, "u"), (ASSISTANT, "a"))}

    def targets(i, state, q):
        """Cost and length of the targets of rows[i:] between two states, cheapest only."""
        last = "u" if q == USER else "a"
        odd = 1 if NEXT[state] == last else 0
        fit = [(c, r) for r, c in tables[q][i].items() if r and r % 2 == odd]
        least = min(fit, default=(FAR, 0))[0]
        return last, [(c, r) for c, r in fit if c == least]

    for state in range(4):
        for q in (USER, ASSISTANT):
            last, found = targets(0, state, q)
            for c, r in found:
                offer((state, q), c, _trace(rows, last, tables[q], 0, r))
    for k, (init, must, extra) in enumerate(rows):
        if init != "s" or must:
            continue
        head, cost = "D" * k + "K", DELETE * k + extra + KEEP
        offer((NOTHING, SYSTEM), cost + DELETE * (n - k - 1), head + "D" * (n - k - 1))
        for q in (USER, ASSISTANT):
            last, found = targets(k + 1, SYSTEM, q)
            for c, r in found:
                offer((NOTHING, q), cost + c, head + _trace(rows, last, tables[q], k + 1, r))
    return tuple((p, q, c, a) for (p, q), (c, a) in sorted(best.items()))


def chain(chunks: list[tuple]) -> tuple[int, str]:
    """Cost and audit of a whole conversation from the alignments of its chunks, in order."""
    live = {NOTHING: (0, 0)}                  # state: cost, rank of its audit among the states
    back = []
    for links in chunks:
        new = {}
        for p, q, c, a in links:
            if p in live:
                cand = (live[p][0] + c, live[p][1], a, p)
                if q not in new or cand < new[q]:
                    new[q] = cand
        order = sorted(new, key=lambda q: new[q][1:3])
        live = {q: (new[q][0], order.index(q)) for q in new}
        back.append({q: (x[3], x[2]) for q, x in new.items()})
    cost, _, state = min((c + INSERT * len(CLOSE[q]), rank, q) for q, (c, rank) in live.items())
    parts = [CLOSE[state]]
    for step in reversed(back):
        state, audit = step[state]
        parts.append(audit)
    return cost, "".join(reversed(parts))


def apply_audit(audit: str, turns):
    """The repaired ``(edit, role, text)`` of ``turns`` (an iterable of role and text)."""
    state, rows = NOTHING, iter(turns)

    def made():
        return "user" if NEXT[state] == "u" else "assistant"

    for edit in audit:
        if edit == "I":
            out = (edit, made(), "")
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            out = (edit, role if edit == "K" else made(), text)
        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[out[1][0]]
        yield out


# ------------------------------------------------------------------ on Spark
def damage(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` as a test damages them, by ``crc32("conv_id:turn") % 20``:
    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a user's.
    A null role or text is one space."""
    space = F.lit(" ")
    d = pick(conversations, "conv_id", "turn", "role", "text")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    kind = F.col("kind")
    text = F.coalesce("text", space)
    return (d.withColumn("kind", F.crc32(key.cast("binary")) % 20).where(kind != 0)
            .select("conv_id", "turn",
                    F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
                    F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", ""))
                    .otherwise(text).alias("text"),
                    F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1)))
                              .otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def _turns(turns: DataFrame) -> DataFrame:
    """The four columns, nulls of role and text as one space, and a fingerprint of the two."""
    d = pick(turns, "conv_id", "turn", "role", "text")
    space = F.lit(" ")
    d = d.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                 F.coalesce("text", space).alias("text"))
    return d.withColumn("print", F.unhex(F.sha2(F.concat(
        F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)))


def _placed(turns: DataFrame) -> DataFrame:
    """One slim row per turn, without texts: ``pos`` orders the turns of a conversation. The
    rows are dealt by ranges of (conversation, turn), so a long conversation spreads."""
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    init = F.substring("role", 1, 1)
    slim = _turns(turns).select(
        "conv_id", "turn", "print",
        F.when(init.isin("s", "u", "a"), init).otherwise("x").alias("init"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("open"),
        F.monotonically_increasing_id().alias("salt"))
    keys = ["conv_id", "turn", "print", "salt"]
    return stored(slim.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .withColumn("pos", F.monotonically_increasing_id()).drop("salt"), "turns")


def _chunks(placed: DataFrame) -> DataFrame:
    """The turns of one conversation in each stretch of ``CHUNK`` places, as a string of symbols:
    the role's initial, upper case if truncated, a digit if the turn must go."""
    seen = (placed.groupBy("conv_id", "print").agg(F.count("*").alias("n"),
                                                   F.min("pos").alias("first"))
            .where("n > 1").select(F.col("conv_id").alias("conv"), F.col("print").alias("p"),
                                   "first"))
    known = placed.join(seen, F.col("conv_id").eqNullSafe(F.col("conv"))
                        & (F.col("print") == F.col("p")), "left")
    again = F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), "b").when(again, "d").when(F.col("open"), "t").otherwise("")
    init = F.col("init")
    rows = known.withColumn("fault", fault).withColumn("symbol", F.when(
        F.col("fault").isin("b", "d"), F.translate(init, "suax", "0123")).when(
        F.col("fault") == "t", F.upper(init)).otherwise(init))
    of = [F.count_if(F.col("fault") == c).alias(name)
          for c, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))]
    return rows.groupBy("conv_id", F.floor(F.col("pos") / CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "symbol"))),
                                 lambda x: x["symbol"]), "").alias("symbols"), *of)


_LINKS = "array<struct<p:int,q:int,cost:long,audit:string>>"
_LINK_TYPE = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()),
                                 ("audit", pa.string())]))


def _align_batches(batches):
    for b in batches:
        links = [[dict(zip(("p", "q", "cost", "audit"), x, strict=True)) for x in align(s)]
                 for s in b.column("symbols").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(links, _LINK_TYPE)],
                                         [*b.schema.names, "links"])


def _illegal(inits: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(inits, inits[1:]))


_INITS = str.maketrans("SUAX0123", "suaxsuax")


def _by_conversation(batches):
    """The Arrow type of the conversation ids, and (id, iterator of rows) of each conversation;
    the rows come as a stream."""
    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return pa.int64(), iter(())
    rows = (r for b in chain_of([first], batches) for r in b.to_pylist())
    return first.schema.field("conv_id").type, groupby(rows, key=lambda r: r["conv_id"])


def _pack(rows, schema, size: int = 1_000):
    """Tuples as record batches."""
    rows = iter(rows)
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)],
            schema=schema)


def _chained(conversations):
    for conv, rows in conversations:
        sums, inits, illegal, chunks = [0, 0, 0], "", 0, []
        for r in rows:
            sums = [s + r[k] for s, k in zip(sums, ("blank", "duplicate", "truncated"),
                                             strict=True)]
            inits = inits[-1:] + r["symbols"].translate(_INITS)
            illegal += _illegal(inits)
            chunks.append([tuple(x.values()) for x in r["links"]])
        yield (conv, *sums, illegal, *chain(chunks))


def _chain_batches(batches):
    kind, conversations = _by_conversation(batches)
    whole = pa.int64()
    return _pack(_chained(conversations), pa.schema([
        ("conv_id", kind), ("blank", whole), ("duplicate", whole), ("truncated", whole),
        ("illegal", whole), ("cost", whole), ("audit", pa.string())]))


def audits(turns: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``, one row for each
    conversation of ``turns`` (columns conv_id, turn, role, text; others are ignored).

    Turns are taken by ``turn``, nulls first, those of one turn by a hash of role and text; null
    roles and texts are one space; rows without a conversation id form one conversation. An empty
    text is a blank turn; repeated rows are duplicates; a text of any length is read once, by
    Spark's own functions. No row gives no result.
    """
    placed = _placed(turns)
    kind = placed.schema["conv_id"].dataType.simpleString()
    links = _chunks(placed)
    links = links.mapInArrow(_align_batches, f"conv_id {kind}, chunk long, symbols string, "
                             f"blank long, duplicate long, truncated long, links {_LINKS}")
    chained = links.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(
        _chain_batches, f"conv_id {kind}, blank long, duplicate long, "
        "truncated long, illegal long, cost long, audit string")
    gaps = placed.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
        .cast("long").alias("gaps"))
    return chained.join(gaps.withColumnRenamed("conv_id", "conv"),
                        F.col("conv_id").eqNullSafe(F.col("conv"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _beside_audits(turns: DataFrame, found: DataFrame) -> DataFrame:
    """The turns of each conversation in order, behind a row with its audit. One conversation's
    rows meet in one task, which reads them as a stream, spilled to disk by Spark's sort."""
    rows = _turns(turns).select("conv_id", F.lit(1).alias("kind"), "turn", "print", "role",
                                "text")
    first = pick(found, "conv_id", "audit").select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType)
        .alias("turn"), F.lit(None).cast("binary").alias("print"), F.lit("").alias("role"),
        F.col("audit").alias("text"))
    return (first.unionByName(rows).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", "turn", "print")
            .select("conv_id", "role", "text", "kind"))


def _edited(conversations):
    """For each conversation its id and the iterator of its repaired turns."""
    for conv, rows in conversations:
        audit = next(rows)["text"]
        yield conv, apply_audit(audit, ((r["role"], r["text"]) for r in rows))


def _repaired_batches(batches):
    kind, conversations = _by_conversation(batches)
    return _pack(((conv, nth, role, text, edit) for conv, turns in _edited(conversations)
                  for nth, (edit, role, text) in enumerate(turns)), pa.schema([
                      ("conv_id", kind), ("turn", pa.int64()), ("role", pa.string()),
                      ("text", pa.string()), ("edit", pa.string())]))


def repaired_turns(turns: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, edit)``: the repaired conversations, turns numbered from 0.
    ``found`` is the result of :func:`audits` for the same turns."""
    kind = turns.select("conv_id").schema["conv_id"].dataType.simpleString()
    return _beside_audits(turns, found).mapInArrow(
        _repaired_batches, f"conv_id {kind}, turn long, role string, text string, edit string")


def _digest(turns) -> str:
    sha, lead = hashlib.sha256(), ""
    for _, role, text in turns:
        sha.update(f"{lead}{role}:{text}".encode())
        lead = "\n"
    return sha.hexdigest()


def _digest_batches(batches):
    kind, conversations = _by_conversation(batches)
    return _pack(((conv, _digest(turns)) for conv, turns in _edited(conversations)),
                 pa.schema([("conv_id", kind), ("repaired_sha256", pa.string())]))


def repaired_digests(turns: DataFrame, found: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: SHA-256 of the repaired ``role:text`` lines, joined by
    newlines. A SHA-256 is one chain of steps, so one task reads a conversation's turns."""
    kind = turns.select("conv_id").schema["conv_id"].dataType.simpleString()
    return _beside_audits(turns, found).mapInArrow(
        _digest_batches, f"conv_id {kind}, repaired_sha256 string")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damages every conversation, then finds and applies its cheapest repair: one row for each
    conv_id of the table. A conversation that has lost all rows has zeros, an empty audit and
    the hash of the empty string; an empty table has no row."""
    turns = damage(conversations)
    found = stored(audits(turns), "audits")
    ids = pick(conversations, "conv_id").distinct().withColumnRenamed("conv_id", "conv")
    sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # one row per conversation and part: put together by one aggregate
    parts = [ids.select("conv", *[F.lit(0).cast("long").alias(c) for c in sums],
                        F.lit("").alias("audit"), F.lit(None).cast("string").alias("sha")),
             found.select(F.col("conv_id").alias("conv"), *sums, "audit",
                          F.lit(None).cast("string").alias("sha")),
             repaired_digests(turns, found).select(
                 F.col("conv_id").alias("conv"), *[F.lit(0).cast("long").alias(c) for c in sums],
                 F.lit("").alias("audit"), F.col("repaired_sha256").alias("sha"))]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy("conv").agg(
        *[F.max(c).alias(c) for c in (*sums, "audit")],
        F.coalesce(F.max("sha"), F.sha2(F.lit("").cast("binary"), 256)).alias(
            "repaired_sha256")).withColumnRenamed("conv", "conv_id")
