import math
from collections import Counter

import numpy as np

from tabreg.llm import quality as Q
from tabreg.llm import queries


class Brute:
    """The same model by dictionaries, from its definition."""

    def __init__(self, texts):
        pad = bytes([Q.START] * (Q.ORDER - 1))
        top = Counter()
        for t in texts:
            b = pad + t.encode()
            for i in range(len(pad), len(b)):
                top[b[i - Q.ORDER + 1:i + 1]] += 1
        self.counts = {Q.ORDER: top}
        for k in range(Q.ORDER - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d, self.ctx = {}, {}
        for k, c in self.counts.items():
            cc = Counter(c.values())
            self.d[k] = Q.discounts(cc[1], cc[2], cc[3], cc[4])
            self.ctx[k] = {}
            for g, n in c.items():
                total, cut = self.ctx[k].get(g[:-1], (0, 0.0))
                self.ctx[k][g[:-1]] = total + n, cut + self.d[k][min(n, 3) - 1]

    def p(self, g):
        k = len(g)
        if not k:
            return 1 / 256
        lower = self.p(g[1:])
        if g[:-1] not in self.ctx[k]:
            return lower
        total, cut = self.ctx[k][g[:-1]]
        n = self.counts[k][g]
        return (n - self.d[k][min(n, 3) - 1] if n else 0) / total + cut / total * lower

    def logp(self, text):
        b = bytes([Q.START] * (Q.ORDER - 1)) + text.encode()
        return sum(math.log(self.p(b[i - Q.ORDER + 1:i + 1])) for i in range(Q.ORDER - 1, len(b)))


def test_model_against_dictionaries(spark, docs_of):
    trusted = ["the cat sat on the mat", "the dog sat", "été à la mer", "", "aaaa"]
    texts = trusted + ["the cat", "QXZ 99!!", None, "é", "the " * 3000, "日本"]
    want = Brute(trusted)
    rows = Q.write_table(Q.model(docs_of(list(enumerate(trusted)))), "m").cache()
    docs = docs_of(list(enumerate(texts)) + [(0, "again"), (None, "no id")])
    for limit in (Q.BLOCK_ROWS, 10):                # one block, and many
        got = Q.log_probabilities(docs, rows, limit).collect()
        assert len(got) == len(texts) + 2
        for r in got:
            t = {10 ** 9: ""}.get(r["doc_id"], "no id" if r["doc_id"] is None else texts[r["doc_id"]] or "")
            if r["doc_id"] == 0 and r["n_bytes"] == 5:
                t = "again"
            assert r["n_bytes"] == len(t.encode())
            assert abs(r["logp"] - want.logp(t)) < 1e-4 * max(1, len(t)), t


def test_probabilities_sum_to_one():
    m = Brute(["the cat sat on the mat", "the dog sat"])
    for context in (b"the ", b"\x02\x02\x02\x02", b"zzzz", b"e ca"):
        assert abs(sum(m.p(context + bytes([w])) for w in range(256)) - 1) < 1e-9


def test_edge_tables(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = docs_of([(1, "abc"), (2, None), (3, ""), (None, "x")])
    got = {r["doc_id"]: r for r in Q.classify(docs, none).collect()}
    assert abs(got[1]["perplexity"] - 256) < 1e-3 and got[1]["keep"] and got[None]["keep"]
    assert not got[2]["keep"] and not got[3]["keep"] and got[2]["perplexity"] is None
    assert Q.classify(docs_of([]), none).count() == 0


def test_hash_table():
    rng = np.random.RandomState(0)
    keys = np.unique(rng.randint(1, 1 << 60, 5000).astype(np.uint64))
    t = Q.Table(keys, np.arange(len(keys)))
    assert (t.get(keys) == np.arange(len(keys))).all()
    assert np.isnan(t.get(keys + np.uint64(1 << 61))).all()


def test_query_keeps_clean_and_rejects_junk(spark):
    sf = "/root/testdata/sf0.1"
    p = queries.QUERIES["op6_quality"](spark, sf)
    x = p.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id").toPandas()
    assert p.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert x[x.quality == 1].keep.mean() > 0.97
    assert x[x.quality == 0].keep.mean() < 0.35
