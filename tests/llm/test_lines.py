from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from obsframe.llm import lines
from obsframe.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, source string, n_lines string, b_host string"
WHITE = " \t\n\x0b\x0c\r"


def lower(n, total, z=1.96):
    p = n / total
    return (p + z * z / (2 * total) - z * (p * (1 - p) / total + z * z / (4 * total * total)) ** 0.5) / (1 + z * z / total)


def brute(rows, ratio, voters=None):
    voters = rows if voters is None else voters
    total, seen = Counter(r[2] for r in voters), defaultdict(set)
    for i, r in enumerate(voters):
        for x in (r[1] or "").split("\n"):
            if x.strip(WHITE):
                seen[r[2], x.strip(WHITE)].add(i)
    common = {k for k, v in seen.items() if len(v) >= 2 and lower(len(v), total[k[0]]) > ratio}
    return [None if r[1] is None else "\n".join(x for x in r[1].split("\n") if (r[2], x.strip(WHITE)) not in common) for r in rows]


def test_brute_force_and_edges(spark):
    rows = [(i, f"menu home\nbody {i}\n\n  menu home \nfoot {i % 3}", ["a", "b", None][i % 3], "clash", "clash") for i in range(60)]
    rows += [(100, None, "a", "", ""), (101, "", "a", "", ""), (102, "menu home", "rare", "", ""), (103, "menu home", "b", "", ""),
             (104, "line\n" * 30_000, "a", "", ""), (None, "body 1\nown", "b", "", ""), (105, " \n\t", None, "", "")] + [(106, "same\nrow", "c", "", "")] * 9
    df = spark.createDataFrame(rows, SCHEMA)
    out = lines.drop_boilerplate(df, F.col("source"), ratio=0.3)
    assert sorted(out.columns) == sorted({*df.columns, "n_dropped"})
    got = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    assert got == Counter((r[0], t, r[2]) for r, t in zip(rows, brute(rows, 0.3)))
    assert lines.drop_boilerplate(df.limit(0), F.col("source")).count() == 0


def test_one_rule_for_hosts_of_any_size(spark):
    """Pages of a host that hold its menu line: dropped where the share is surely above the ratio, also in tiny hosts."""
    cases = {(2, 2): True, (1, 1): False, (1, 2): False, (3, 4): True, (3, 50): False, (5, 50): False, (6, 50): True, (30, 600): False, (60, 600): True}
    rows = [(i, f"menu {n} {total}\nown {i} {total}" if i < n else f"own {i} {total}", f"{n} of {total}", "", "") for n, total in cases for i in range(total)]
    out = lines.drop_boilerplate(spark.createDataFrame(rows, SCHEMA), F.col("source")).groupBy("source").agg(F.sum("n_dropped").alias("n")).collect()
    assert {r.source: r.n for r in out} == {f"{n} of {t}": n if gone else 0 for (n, t), gone in cases.items()}


def same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df, sql = QUERIES[name](spark, SF_SMALL), con.execute(ORACLES[name])
    cols, names = sorted(df.columns), [d[0] for d in sql.description]
    assert cols == sorted(names)
    want = [[dict(zip(names, r))[c] for c in cols] for r in sql.fetchall()]
    got = [[r[c] for c in cols] for r in df.collect()]
    assert want and sorted(map(str, got)) == sorted(map(str, want))


def test_line_dedup_matches_sql(spark):
    same(spark, "op6_line_dedup")
