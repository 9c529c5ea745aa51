import random

import duckdb

from tabreg.llm import line_dedup, queries

UP = str.maketrans(queries.UPPER, queries.LOWER)
SPACES = " \t\n\x0b\f\r"


def brute(rows, min_docs=10, min_chars=1):
    """(doc_id, n_lines, n_dropped, text) of (doc_id, text) rows, by dictionaries."""
    held = {}
    key = lambda x: x.strip(SPACES).translate(UP)
    for d, t in rows:
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(held[key(x)]) < min_docs]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def sort(rows):
    return sorted(map(tuple, rows), key=repr)


def test_against_brute_force(spark, docs_of):
    rng = random.Random(3)
    pool = ["Common LINE", " common line\t", "\x0bÉtat ", "état", "ÉTAT", "Rare", "", " ", "\r", "a\x85", " x", " ", "x\x1fy"] + [f"line {i}" for i in range(9)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n"), (103, "\n\n common line"), (104, "common line\n" * 40_000 + "end"), (None, "common line\nalone"),
             (None, "common line\nlonely"), (None, None), (105, "twice"), (105, "twice"), (105, "thrice\ntwice"), (106, "x" * 2_000_000 + "\nrare")]
    rows += [(200 + i, "nine times" if i < 9 else "other") for i in range(9)] + [(300, "nine times\n" * 5)]     # ten documents
    rows += [(400, "eleven rows of one document")] * 11 + [(None, "eleven rows without an id")] * 11
    docs = docs_of(rows).selectExpr("*", "1 as places", "2 as h1", "'k' as key", "3 as n_lines").repartition(5)
    want = sort(brute(rows))
    assert sort(line_dedup.drop_common_lines(docs).collect()) == want
    assert [r for r in want if r[0] == 300] == [(300, 6, 5, "")]
    assert sort(line_dedup.drop_common_lines(docs, min_docs=3, min_chars=5).collect()) == sort(brute(rows, 3, 5))


def test_shuffled_keys_give_the_same(spark, docs_of, monkeypatch):
    rows = [(i, f"common\nown {i}\ncommon " + "\nmore" * (i % 3)) for i in range(40)] + [(None, "common"), (7, "common")]
    monkeypatch.setattr(line_dedup, "FEW_KEYS", 0)
    assert sort(line_dedup.drop_common_lines(docs_of(rows)).collect()) == sort(brute(rows))


def test_empty_table_and_plan(spark, docs_of, tmp_path):
    assert line_dedup.drop_common_lines(docs_of([(1, "x")]).limit(0)).collect() == []
    out = line_dedup.drop_common_lines(docs_of([(i, "x\ny") for i in range(12)]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{sf}/documents.parquet'")
    got = queries.QUERIES["op13_line_dedup"](spark, sf)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL['op13_line_dedup']})").fetchall()
    assert sort(got.collect()) == sort(want) and sum(r[2] for r in want) > 0
