import hashlib
import re
import zlib
from itertools import product

import pytest

from obsframe.llm import conversations
from obsframe.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, part int, codes string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def least_edits(rows):
    """Least (cost, initials) over every edit, by exhaustive recursion from the front on (position, what the initials read)."""
    best = {}

    def legal(read, last):
        return re.fullmatch(r"(s?(ua)*u?)?" if not last else r"(s?(ua)+)?", read) is not None

    def short(read):  # only the state matters, so that the memory stays small
        return read if len(read) < 4 else read[-2:] if read[-1] == "a" else "ua" + read[-1]

    def go(i, read, inserts):
        key = (i, short(read), inserts)
        if key in best:
            return best[key]
        found = []
        if i == len(rows):
            if legal(read, True):
                found.append((0, "", ()))
        else:
            role, text, fault = rows[i]
            c, a, m = go(i + 1, read, 0)
            found.append((c + 4, "D" + a, m))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                for name, cost, edit in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if name[:1] in ("s", "u", "a") and legal(short(read) + name[0], False):
                        c, a, m = go(i + 1, short(read) + name[0], 0)
                        found.append((c + cost + extra, edit + a, ((name, text), *m)))
        if inserts < 2:
            for name in ("user", "assistant"):
                if legal(short(read) + name[0], False):
                    c, a, m = go(i, short(read) + name[0], inserts + 1)
                    found.append((c + 3, "I" + a, ((name, ""), *m)))
        best[key] = min(found) if found else (10 ** 9, "", ())
        return best[key]

    return go(0, "", 0)


def brute(rows, damaged=True):
    """Rows of the query, by plain loops."""
    convs = {}
    for conv, turn, role, text, *_ in rows:
        kept = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 5
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        kept += [(turn, role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        turns = {t for t, _, _ in kept if t is not None}
        seen, faults = set(), []
        for _, role, text in kept:
            body = text.rstrip(conversations.BLANKS)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        cost, audit, made = least_edits([(r, t, f) for (_, r, t), f in zip(kept, faults)])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return out


def found(df):
    assert df.columns == COLUMNS
    out = df.collect()
    assert len({r.conv_id for r in out}) == len(out)
    return {r.conv_id: tuple(r[1:]) for r in out}


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(QUERIES["op11_conversation_repair"](spark, SF_SMALL)) == brute(rows)


EDGES = ([(1, t, r, x, 0, "clash") for t, r, x in ((None, None, None), (0, "user", "Hi."), (0, "user", "Hi."), (7, "assistant", "a. "), (9, "", "x!"), (9, "Tool", "y"))]
         + [(None, None, "user", "q?", 0, None)] * 5 + [(2, 1, "system", "s" * 300_000 + ".", 0, None)] + [(3, None, None, "", 0, None)]
         + [(4, t, "user" if t % 3 else "assistant", "same." if t % 7 == 0 else f"text {t}" + "." * (t % 5 > 0), 0, None) for t in range(300)])


@pytest.mark.parametrize("most_rows, most_chars, n", [(16_384, 4 << 20, 1), (7, 100, 5), (1, 1, 9), (50, 4 << 20, 3)])
def test_any_chunks_give_the_same(spark, most_rows, most_chars, n):
    df = spark.createDataFrame(EDGES, SCHEMA).repartition(n)
    for damaged in (True, False):
        rows = conversations.damage(df) if damaged else df
        assert found(conversations.digests(conversations.repair(rows, most_rows, most_chars))) == brute(EDGES, damaged)


def test_every_short_conversation(spark):
    kinds = [("system", "s."), ("user", "u."), ("assistant", "a"), ("user", "  ")]
    rows = [(i, t, r, x + (f"{t}." if x.strip() and x[-1] == "." else ""), 0, None)
            for i, combination in enumerate(product(kinds, repeat=5)) for t, (r, x) in enumerate(combination)]
    assert found(conversations.digests(conversations.repair(spark.createDataFrame(rows, SCHEMA)))) == brute(rows, False)


def test_empty_and_dropped(spark):
    df = spark.createDataFrame(EDGES, SCHEMA)
    assert conversations.digests(conversations.repair(conversations.damage(df.limit(0)))).count() == 0
    turn = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    gone = spark.createDataFrame([(5, turn, "user", "x.", 0, None)], SCHEMA)
    assert found(conversations.digests(conversations.repair(conversations.damage(gone)))) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
