import hashlib
import random
import re
import zlib

import duckdb

from tabreg.llm import conversation_trie, queries

COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Node rows of (conv_id, turn, role, text) rows, by dictionaries of tuples."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    children, leaves, saved = ({s: 0 for s in members} for _ in range(3))
    for s, cs in members.items():
        if s:
            children[s[:-1]] += 1
    for s, cs in members.items():
        n = (len(cs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            saved[s[:d]] += n
            leaves[s[:d]] += not children[s]
    out = []
    for s, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if whole[c] == s)))
        out.append((min(cs), len(s), min(members[s[:-1]]) if s else None, len(cs), children[s], leaves[s], saved[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def sort(rows):
    return sorted(map(tuple, rows), key=repr)


def run(spark, monkeypatch, df, few=None):
    if few is not None:
        monkeypatch.setattr(conversation_trie, "FEW_NODES", few)
    monkeypatch.setattr(queries, "table", lambda *a: df)
    return sort(queries.QUERIES["op12_conversation_trie"](spark, "").select(*COLS).collect())


SCHEMA = "conv_id long, turn long, role string, text string"


def random_rows(seed, convs=300):
    rng = random.Random(seed)
    rows = []
    for c in range(-25, convs):
        for t in range(rng.choice([1, 1, 2, 3, 4, 6, 9])):
            rows.append((c, rng.choice([t, t, t, None, 2]), rng.choice(["user", "assistant", None]), rng.choice(["", None, "a b", "a  b\tc", "  x"])))
    return rows


def test_against_brute_force(spark, monkeypatch):
    for seed, few in ((0, 300_000), (1, 0)):                          # 0: shared nodes joined by a shuffle
        rows = random_rows(seed)
        df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "2 as p1", "'x' as words", "3 as n").repartition(6)
        assert run(spark, monkeypatch, df, few) == sort(brute(rows))


def test_edges(spark, monkeypatch):
    rows = [(None, 1, "user", "nobody"), (None, None, None, None), (5, 1, "user", "same"), (5, 1, "user", "same"), (40, 0, None, None),
            (7, 0, "user", "w " * 300_000), (8, 0, "user", "w " * 300_000), (9, 9, "a", "b"), (9, 9, "ab", "")]
    rows += [(60, t, "user", f"turn {t}") for t in range(90)]
    for c in range(1000, 9000):                                            # one hot sequence over several blocks
        rows.append((c, 0, "user", "hello"))
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(spark, monkeypatch, df) == sort(brute([r for r in rows]))
    empty = df.limit(0)
    assert run(spark, monkeypatch, empty) == []


def test_ends_hold_real_ids(spark):
    rows = [(c, 0, "user", "hello") for c in range(100, 5000)]
    trie = conversation_trie.build(spark.createDataFrame(rows, SCHEMA))
    ends = trie.ends.collect()
    assert sorted(i for r in ends for i in r["ids"]) == list(range(100, 5000))
    assert max(len(r["ids"]) for r in ends) <= conversation_trie.BLOCK


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS FROM '{sf}/conversations.parquet'")
    got = sort(queries.QUERIES["op12_conversation_trie"](spark, sf).select(*COLS).collect())
    want = sort(con.execute(f"SELECT {', '.join(COLS)} FROM ({queries.SQL['op12_conversation_trie']})").fetchall())
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert got == want == sort(brute(rows))
