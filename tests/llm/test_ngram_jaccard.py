import re

import duckdb
import numpy as np

from tabreg.llm import graph, queries
from tabreg.llm import ngram_jaccard as N

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def union_find(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows):
    """(n_shingles, component) of each doc_id by all pairs; rows of one doc_id are one node."""
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for k, (a, s) in enumerate(sets) for b, t in sets[:k]
             if a is not None and b is not None and a != b and s and t and 100 * len(s & t) >= 80 * len(s | t)]
    comp = union_find({i for i, _ in sets if i is not None}, links)
    return sorted((str(i), len(s), str(comp.get(i))) for i, s in sets)


def run(docs):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in N.link_components(docs).collect())


def linked(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


def test_linked_sets_share_a_valid_signature():
    """The prefix claim: a link's two sets have a signature that both need for a partner of that size."""
    rng = np.random.RandomState(0)
    checked = 0
    for trial in range(1500):
        universe = rng.randint(0, 1 << 63, 400).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        hot = set(universe[rng.rand(400) < rng.choice([0.0, 0.3, 0.9, 1.0])].tolist())
        n = int(rng.choice([4, 5, 6, 9, 14, 30, 80, 150, 250]))
        a = set(rng.choice(universe, n, replace=False).tolist())
        b = set(a)
        for _ in range(rng.randint(0, n // 6 + 2)):
            (b.discard if rng.rand() < 0.5 else b.add)(int(rng.choice(universe)))
        if len(b) < 4 or not linked(a, b) or a == b:
            continue
        checked += 1
        reach = []
        for s in (a, b):
            arr = np.array(sorted(s), np.uint64)
            sig, kb, _ = N.signatures(arr, np.array([int(x) in hot for x in arr]))
            out = {}
            for g, k in zip(sig.tolist(), kb.tolist()):
                out[g] = max(out.get(g, -1), (5 * len(s) - 9 * k) // 4)
            reach.append(out)
        assert any(reach[0][g] >= len(b) and reach[1][g] >= len(a) for g in reach[0].keys() & reach[1].keys())
    assert checked > 500


def test_signatures_stay_linear():
    rng = np.random.RandomState(1)
    s = np.sort(rng.randint(0, 1 << 63, 20000).astype(np.uint64) * np.uint64(2))
    for share in (0.0, 0.5, 1.0):
        sig, _, _ = N.signatures(s, rng.rand(len(s)) < share)
        assert len(sig) < 1.2 * len(s)


def test_edge_rows(docs_of):
    long = " ".join(f"w{i % 977}" for i in range(30000))
    rows = [(9, "a b c d e f g h i j"), (8, "A  B c\nd e f g H i J"), (7, "a b c d e f g h i x"), (6, None), (5, ""), (4, " \t\n"),
            (3, "one two"), (2, "One Two"), (1, "one two three"), (10, "two one"), (11, long), (12, long + " end"), (None, "one two"),
            (None, None), (13, "été à l'école de la ville"), (14, "ÉTÉ à l'école de la ville"), (3, "other text of six words here"),
            (15, "other text of six words here"), (-1, "x y z")]
    assert run(docs_of(rows)) == brute(rows)
    assert run(docs_of([])) == []
    assert run(docs_of([(1, None), (2, "")])) == [("1", 0, "1"), ("2", 0, "2")]


def copies(rng, vocab, n, words, edits):
    base = list(rng.choice(vocab, words))
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits + 1)):
            w[rng.randint(len(w))] = rng.choice(vocab)
        out.append(" ".join(w))
    return out


def test_against_all_pairs(docs_of, monkeypatch):
    """Groups of near copies around the threshold, a shared passage, frequent tokens from few documents on."""
    rng = np.random.RandomState(3)
    vocab = np.array([f"v{i}" for i in range(3000)])
    texts = [t for n, words, edits in ((60, 80, 4), (30, 40, 2), (25, 200, 9), (20, 12, 1), (40, 60, 3)) for t in copies(rng, vocab, n, words, edits)]
    passage = " ".join(rng.choice(vocab, 50))
    texts += [" ".join(rng.choice(vocab, rng.randint(5, 60))) + " " + passage for _ in range(60)]
    texts += [" ".join(rng.choice(vocab, rng.randint(1, 90))) for _ in range(40)] + texts[:15]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    want = brute(rows)
    for hot_min in (N.HOT_MIN, 3):
        monkeypatch.setattr(N, "HOT_MIN", hot_min)
        assert run(docs_of(rows).repartition(5)) == want


def test_one_of_each(docs_of):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words in this text"), (3, "another row of that id"), (3, "other words in this text"),
            (None, "a b c d e f"), (None, None), (4, None)]
    docs = docs_of(rows)
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect())
    assert got == sorted([("1", "a b c d e f"), ("3", "another row of that id"), ("None", "a b c d e f"), ("None", "None"), ("4", "None")])


def test_components(spark):
    rng = np.random.RandomState(5)
    pairs = [(int(a), int(b)) for a, b in rng.randint(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    pairs += [(5000, i) for i in range(5001, 5200)] + [(7, 7)]
    rows = pairs + [(None, 3), (4, None)]
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    ids = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == union_find(ids, [p for p in pairs if p[0] != p[1]])
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(queries.SQL["op1_ngram_jaccard"]).df()[["doc_id", "n_shingles", "component_id"]]
    got = queries.QUERIES["op1_ngram_jaccard"](spark, sf).select(*want.columns).toPandas()
    assert sorted(map(tuple, got.values)) == sorted(map(tuple, want.values))
