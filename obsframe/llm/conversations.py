"""Repair of damaged conversation structure by a square-root checkpointed dynamic programme.

A conversation's rows, in order, are edited at least cost until their role initials read
``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (3), Delete (4, the only edit of a blank or
duplicate row), Insert an empty user or assistant turn anywhere (3); a truncated row that stays adds 3.
Of the cheapest edit sequences the ASCII-least by initials (D, I, K, R) is taken. The state is what the
kept initials read so far: nothing, ``s``, up to a ``u``, up to an ``a``. Given the state an initial leads
to one next state only, so the least string is found by always taking the least initial that is tight.

How it runs:

1. ``order_rows``: equal rows are counted once (combined on the map side), first occurrences come from an
   aggregate over (conversation, role, text), and one range shuffle by conversation, turn, role and digest
   of the text sorts the rows, so that a conversation that holds a third of all rows lies in many tasks.
2. ``chunks``: a task cuts its sorted rows into chunks of one conversation, ``CHUNK_ROWS`` rows or
   ``CHUNK_CHARS`` characters at most; they are stored. Only a partition's first and last conversation and those
   longer than a chunk can have more than one; all others are solved by their chunk alone.
3. ``chain``: for those, one byte per row (the role's class and the fault) goes to one task per conversation, less
   than the edit string that its result holds. Cost vectors are kept at chunk ends only; walking forward gives every
   chunk the state before it, the vector after it, and what its first row follows.
4. ``solve``: each chunk alone, in parallel: backward vectors are stored every sqrt(n) rows, and each block's vectors
   are computed again while walking forward.

Texts never meet in one task; only a digest over a whole conversation (``digests``) reads its chunks one after
the other, as a sequential hash must, holding one chunk at a time.

Defined results: a null role or text is one space. Rows are ordered by turn (nulls first), then role, then the
SHA-256 of role and text; rows equal in all columns are adjacent. A null conversation id is an id like others. An
empty role, or one that starts with another letter than s, u or a, cannot be kept. Extra columns are ignored. A
conversation whose rows were all dropped (``copies`` 0) has one chunk without rows; an empty table has no chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import materialise, ship

CHUNK_ROWS = 1024
CHUNK_CHARS = 16 << 10  # Spark hands Python batches of up to 10,000 chunks
SENT_CHARS = 4 << 20
BLANKS = " \t\n\x0b\x0c\r"
# What Keep and the fault rules cost.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
INSERTED = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)  # the state after a user or assistant turn, whichever may follow
ROLE = ("user", "user", "assistant", "user")
KEPT = {("s", NOTHING): AFTER_S, ("u", NOTHING): AFTER_U, ("u", AFTER_S): AFTER_U, ("u", AFTER_A): AFTER_U, ("a", AFTER_U): AFTER_A}
END = (0, 2 * INSERT, INSERT, 0)  # cost after the last row, by state
LEGAL = ("su", "ua", "au")
# A row as a byte: initial (s, u, a or -) plus fault (none, blank, duplicate, truncated).
INITIALS = "sua-"
SOUND, BLANK, DUPLICATE, CUT = range(4)


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` with nulls as one space, damaged by the CRC-32 of ``conv_id:turn`` modulo 20, and ``copies``: 0 for a
    dropped row, 2 for a repeated one."""
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    how = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", "turn", F.when(how == 4, "user").otherwise(role).alias("role"),
                       F.when(how == 1, "").when(how == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                       F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"))


def order_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``copies`` and ``fault``, sorted within range partitions."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    one = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    one = one.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    one = one.withColumn("key", F.sha2(said.cast("binary"), 256)).withColumn("same", F.concat_ws(":", F.col("conv_id").cast("string"), "key"))
    again = (one.where("copies > 0").groupBy("same")
             .agg(F.max(F.col("turn").isNull()).alias("null_first"), F.min("turn").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    later = F.col("null_first") & F.col("turn").isNotNull() | ~F.col("null_first") & (F.col("turn") > F.col("first"))
    kept = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (F.when(kept == "", BLANK).when(F.coalesce(later, F.lit(False)), DUPLICATE)
             .when(F.substring(kept, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT))
    place = ("conv_id", "turn", "role", "key")
    return (one.join(materialise(again, "conversations-repeats"), "same", "left").select(*place, "text", "copies", fault.alias("fault"))
            .repartitionByRange(*place).sortWithinPartitions(*place))


def chunks(rows: DataFrame, most_rows: int = CHUNK_ROWS, most_chars: int = CHUNK_CHARS) -> DataFrame:
    """Stored chunks of the rows of ``order_rows``: texts, a byte per row, and whether the chunk is a whole conversation."""
    ship(rows.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = (f"conv_id {kinds['conv_id']}, part int, seg int, whole boolean, first_turn {kinds['turn']}, last_turn {kinds['turn']}, n_turns long, "
              "codes binary, roles array<string>, texts array<string>")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg, out, waiting = TaskContext.get().partitionId(), 0, [], 0
        now, turns, codes, roles, texts, chars, alone = None, [], bytearray(), [], [], 0, False
        names, kind, started = [c.split()[0] for c in schema.split(", ")], None, False

        def close(whole: bool) -> dict:
            given = [t for t in turns if t is not None]
            return dict(zip(names, (now, part, seg, whole, given[0] if given else None, given[-1] if given else None,
                                    len(set(given)), bytes(codes), roles, texts), strict=True))

        def send(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(out, schema=kind)

        for b in batches:
            if kind is None:
                a = b.schema
                kind = pa.schema([("conv_id", a.field("conv_id").type), ("part", pa.int32()), ("seg", pa.int32()), ("whole", pa.bool_()),
                                  ("first_turn", a.field("turn").type), ("last_turn", a.field("turn").type), ("n_turns", pa.int64()), ("codes", pa.binary()),
                                  ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
            columns = (b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "fault"))
            for conv, turn, role, text, copies, fault in zip(*columns, strict=True):
                new = not started or conv != now
                if started and (new or len(codes) >= most_rows or chars >= most_chars):
                    out.append(close(new and alone))
                    seg += 1
                    waiting += chars
                    if waiting > SENT_CHARS:
                        yield send(out)
                        out, waiting = [], 0
                    turns, codes, roles, texts, chars, alone = [], bytearray(), [], [], 0, new
                now, started = conv, True
                initial = max(INITIALS.find(role[:1]), 0) if role[:1] in ("s", "u", "a") else 3
                after = BLANK if fault == BLANK else DUPLICATE
                for i in range(copies):  # copies of a row follow it
                    if len(codes) >= most_rows:
                        out.append(close(False))
                        seg += 1
                        turns, codes, roles, texts, chars, alone = [], bytearray(), [], [], 0, False
                    codes.append(initial + 4 * (after if i else fault))
                    roles.append(role)
                    texts.append("" if i else text)  # a copy is always deleted
                    turns.append(turn)
                chars += len(text)
        if started:
            out.append(close(False))
            yield send(out)

    return materialise(rows.mapInArrow(gather, schema), "conversations-chunks")


@lru_cache(maxsize=None)
def backward(after: tuple, code: int) -> tuple[tuple, int]:
    """Cost vector before a row, less its smallest entry, and that entry. Vectors stay few, since entries differ by a few edits at most."""
    initial, fault = INITIALS[code % 4], code // 4
    before = [DELETE + v for v in after]
    if fault not in (BLANK, DUPLICATE):
        stay = TRUNCATED * (fault == CUT)
        for s in range(4):
            before[s] = min(before[s], REROLE + stay + after[INSERTED[s]])
            if (initial, s) in KEPT:
                before[s] = min(before[s], stay + after[KEPT[initial, s]])
    u, a = before[AFTER_U], before[AFTER_A]
    before[AFTER_U], before[AFTER_A] = min(u, INSERT + a), min(a, INSERT + u)
    for s in (NOTHING, AFTER_S):
        before[s] = min(before[s], INSERT + before[AFTER_U])
    least = min(before)
    return tuple(v - least for v in before), least


@lru_cache(maxsize=None)
def forward(after: tuple, code: int, state: int) -> tuple[str, tuple, int, int]:
    """ASCII-least tight edits up to and with this row: initials, roles made (None: the row's own), next state, cost."""
    initial, fault = INITIALS[code % 4], code // 4
    before, least = backward(after, code)
    stay = TRUNCATED * (fault == CUT)
    edits, roles, cost = "", [], 0
    while True:
        left = before[state] + least
        if DELETE + after[state] == left:
            return edits + "D", tuple(roles), state, cost + DELETE
        if INSERT + before[INSERTED[state]] + least == left:
            edits, cost = edits + "I", cost + INSERT
            roles.append(ROLE[state])
            state = INSERTED[state]
        elif fault not in (BLANK, DUPLICATE) and (initial, state) in KEPT and stay + after[KEPT[initial, state]] == left:
            return edits + "K", (*roles, None), KEPT[initial, state], cost + stay
        else:
            return edits + "R", (*roles, ROLE[state]), INSERTED[state], cost + REROLE + stay


def walk(codes: bytes, state: int, after: tuple) -> Iterator[tuple[str, tuple, int, int]]:
    """``forward`` of every row. Backward vectors are kept at block ends, sqrt(n) rows apart; each block's are computed again when reached."""
    n = len(codes)
    step = max(1, isqrt(n))
    ends, v = {}, after
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0 or i == n - 1:
            ends[i // step] = v
        v = backward(v, codes[i])[0]
    for block in range(-(-n // step)):
        rows = codes[block * step:(block + 1) * step]
        vectors = [ends[block]]
        for c in rows[:0:-1]:
            vectors.append(backward(vectors[-1], c)[0])
        for c, v in zip(rows, reversed(vectors), strict=True):
            found = forward(v, c, state)
            state = found[2]
            yield found


def vector_before(codes: bytes, after: tuple) -> tuple:
    for c in reversed(codes):
        after = backward(after, c)[0]
    return after


def chain(parts: DataFrame) -> DataFrame:
    """For chunks of conversations that may have several: ``entry`` state, cost vector ``after``, class ``prior`` of the row before (-1: none),
    the last turn before, and whether the chunk is the conversation's last."""
    turn = parts.schema["first_turn"].dataType.simpleString()
    schema = f"part int, seg int, entry int, after array<long>, prior int, prior_turn {turn}, last boolean, several boolean"

    def follow(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seg"]))
        v = END
        for r in reversed(found):
            r["after"], v = v, vector_before(r["codes"], v)
        state, prior, prior_turn = NOTHING, -1, None
        for r in found:
            r["entry"], r["prior"], r["prior_turn"] = state, prior, prior_turn
            r["last"], r["several"] = r is found[-1], len(found) > 1
            for _, _, state, _ in walk(r["codes"], state, r["after"]):
                pass
            prior = r["codes"][-1] % 4 if r["codes"] else prior
            prior_turn = r["last_turn"] if r["last_turn"] is not None else prior_turn
        kind = pa.schema([("part", pa.int32()), ("seg", pa.int32()), ("entry", pa.int32()), ("after", pa.list_(pa.int64())), ("prior", pa.int32()),
                          ("prior_turn", table.schema.field("last_turn").type), ("last", pa.bool_()), ("several", pa.bool_())])
        return pa.Table.from_pylist([{k: r[k] for k in kind.names} for r in found], schema=kind)

    return parts.select("conv_id", "part", "seg", "first_turn", "last_turn", "codes").groupBy("conv_id").applyInArrow(follow, schema)


def solve(found: DataFrame) -> DataFrame:
    """Repaired chunks: ``edits`` and the repaired ``roles`` and ``texts`` in order, with the counts of faults."""
    ship(found.sparkSession)
    conv, turn = (found.schema[c].dataType.simpleString() for c in ("conv_id", "first_turn"))
    schema = (f"conv_id {conv}, part int, seg int, several boolean, first_turn {turn}, last_turn {turn}, n_turns long, blank long, duplicate long, "
              "truncated long, illegal long, cost long, edits string, roles array<string>, texts array<string>")

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                codes, state, edits, cost, roles, texts = r["codes"], r["entry"], [], 0, [], []
                for (done, made, state, paid), role, text in zip(walk(codes, state, tuple(r["after"])), r["roles"], r["texts"], strict=True):
                    edits.append(done)
                    cost += paid
                    roles += [role if m is None else m for m in made]
                    texts += [""] * (len(made) - (done[-1] != "D")) + [text] * (done[-1] != "D")
                while r["last"] and state in (AFTER_S, AFTER_U):
                    edits.append("I")
                    cost += INSERT
                    roles.append(ROLE[state])
                    texts.append("")
                    state = INSERTED[state]
                faults = [c // 4 for c in codes]
                reads = ("" if r["prior"] < 0 else INITIALS[r["prior"]]) + "".join(INITIALS[c % 4] for c in codes)
                known = r["first_turn"] is not None and r["first_turn"] == r["prior_turn"]
                out.append({"conv_id": r["conv_id"], "part": r["part"], "seg": r["seg"], "several": r["several"], "first_turn": r["first_turn"],
                            "last_turn": r["last_turn"], "n_turns": r["n_turns"] - known, "blank": faults.count(BLANK),
                            "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT),
                            "illegal": sum(reads[i:i + 2] not in LEGAL for i in range(len(reads) - 1)), "cost": cost,
                            "edits": "".join(edits), "roles": roles, "texts": texts})
            a = b.schema
            kind = pa.schema([("conv_id", a.field("conv_id").type), ("part", pa.int32()), ("seg", pa.int32()), ("several", pa.bool_()),
                              ("first_turn", a.field("first_turn").type), ("last_turn", a.field("first_turn").type), ("n_turns", pa.int64()),
                              *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")), ("edits", pa.string()),
                              ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return found.mapInArrow(repair, schema)


def repair(rows: DataFrame, most_rows: int = CHUNK_ROWS, most_chars: int = CHUNK_CHARS) -> DataFrame:
    """Repaired conversations as chunks in order of ``(part, seg)``: counts, ``edits``, and the repaired ``roles`` and ``texts``."""
    kept = chunks(order_rows(rows), most_rows, most_chars)
    plan = materialise(chain(kept.where("not whole")), "conversations-chain")
    alone = kept.where("whole").select("*", F.lit(NOTHING).alias("entry"), F.array(*map(F.lit, END)).cast("array<long>").alias("after"), F.lit(-1).alias("prior"),
                                       F.lit(None).cast(kept.schema["last_turn"].dataType).alias("prior_turn"), F.lit(True).alias("last"), F.lit(False).alias("several"))
    return materialise(solve(alone.unionByName(kept.where("not whole").join(plan, ["part", "seg"]))), "conversations-repaired")


SUMS = ("blank", "duplicate", "truncated", "illegal", "cost")


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: gaps, the counts, ``audit`` and ``repaired_sha256``.

    A conversation of one chunk is a projection; only those of several are dealt by id and read chunk after chunk."""
    lines = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).cast("long")
    one = repaired.where("not several").select("conv_id", gaps.alias("gaps"), *SUMS, F.col("edits").alias("audit"), F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
    schema = one.schema

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, h, empty, edits, started, kind = None, None, None, True, [], False, None

        def close() -> pa.RecordBatch:
            spread = 0 if held["low"] is None else held["high"] - held["low"] + 1 - held["n_turns"]
            row = {"conv_id": now, "gaps": spread, **{c: held[c] for c in SUMS}, "audit": "".join(edits), "repaired_sha256": h.hexdigest()}
            return pa.RecordBatch.from_pylist([row], schema=kind)

        for b in batches:
            kind = kind or pa.schema([("conv_id", b.schema.field("conv_id").type), ("gaps", pa.int64()), *((c, pa.int64()) for c in SUMS),
                                      ("audit", pa.string()), ("repaired_sha256", pa.string())])
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                if not started or r["conv_id"] != now:
                    if started:
                        yield close()
                    now, started, h, empty, edits = r["conv_id"], True, hashlib.sha256(), True, []
                    held = dict.fromkeys((*SUMS, "n_turns"), 0) | {"low": None, "high": None}
                for c in (*SUMS, "n_turns"):
                    held[c] += r[c]
                if r["first_turn"] is not None:
                    held["low"] = r["first_turn"] if held["low"] is None else held["low"]
                    held["high"] = r["last_turn"]
                edits.append(r["edits"])
                if r["roles"]:
                    h.update(("" if empty else "\n").encode() + "\n".join(f"{a}:{t}" for a, t in zip(r["roles"], r["texts"], strict=True)).encode())
                    empty = False
        if started:
            yield close()

    several = repaired.where("several").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
    return one.unionByName(several.mapInArrow(fold, schema))
