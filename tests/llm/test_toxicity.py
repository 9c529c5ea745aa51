import math
import zlib

import numpy as np

from tabreg.llm import queries, toxicity


def brute(model, text):
    """The machine's score of one text, by its definition."""
    import re
    words = {w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                                            "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))}
    from tabreg.llm import text as X
    data = np.frombuffer(b" ".join(words), np.uint8)
    _, bucket = toxicity.terms(X.Words(data, np.array([0, len(data)]), toxicity._SEP))
    on = sorted(set(bucket.tolist()))
    z = model.w0 + sum(model.w[i] for i in on)
    for a in range(len(on)):
        for b in range(a):
            z += float(model.v[on[a]] @ model.v[on[b]])
    return 1 / (1 + math.exp(-max(-60, min(60, z))))


def test_scores_match_the_definition(docs_of):
    rng = np.random.RandomState(0)
    model = toxicity.Model(-0.3, rng.normal(0, 0.1, toxicity.BUCKETS) * (rng.rand(toxicity.BUCKETS) < 0.7))
    model.v = rng.normal(0, 0.1, model.v.shape) * (model.w != 0)[:, None]
    texts = [None, "", " .,! ", "You IDIOT, you idiot!", "été à l'école", "long " * 3000, "a b c d e f g hijklmnop"]
    got = toxicity.score(docs_of(list(enumerate(texts)) + [(None, "x"), (1, "x")]), model).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] != 1:
            assert abs(r["score"] - brute(model, texts[r["doc_id"]])) < 1e-9
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5)
    assert toxicity.score(docs_of([]), model).count() == 0


def test_pairs_are_learned():
    """Two terms that are harmless alone: only the pair part can tell."""
    rng = np.random.RandomState(3)
    rows = []
    for _ in range(4000):
        a, b = (int(x) for x in rng.rand(2) < 0.5)
        rows.append((int(a and b), np.array(sorted([10] * a + [20] * b + list(100 + rng.choice(50, 3, False))))))
    m = toxicity.fit(rows, np.mean([y for y, _ in rows]))
    right = [(m.scores(1, np.zeros(len(t), int), t.astype(int))[0] >= 0.5) == y for y, t in rows]
    assert np.mean(right) > 0.97
    assert m.v[10] @ m.v[20] > 0


def test_no_labels_or_one_class(spark, docs_of):
    docs = docs_of([(i, f"word{i}") for i in range(20)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs, none).filter("predicted = 1").count() == 0
    nulls = spark.createDataFrame([(i, 1, None if i % 2 else 0) for i in range(20)] + [(None, 1, 1)],
                                  "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs, nulls).filter("predicted = 1").count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    p = queries.QUERIES["op10_toxicity"](spark, sf)
    x = p.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").toPandas()
    h = x[x.held_out]
    assert p.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert (h.predicted == h.toxic).mean() > 0.96
    assert ((h.predicted == 1) & (h.toxic == 0)).mean() < 0.01


def brute_fit(rows, share):
    """FTRL for the linear weights and AdaGrad for the factors, one number at a time:
    the gradient of v_i is the error times the sum of the other terms' factors."""
    T, K = toxicity, range(toxicity.FACTORS)
    rng = np.random.RandomState(7)
    start = rng.normal(0, 0.02, (T.BUCKETS, T.FACTORS))
    z, n, w, v, gv = {}, {}, {}, {}, {}
    w0, n0 = 0.0, 1.0
    for _ in range(T.EPOCHS):
        for k in rng.permutation(len(rows)):
            y, terms = rows[k]
            terms = [int(i) for i in terms]
            for i in terms:
                zi, ni = z.get(i, 0.0), n.get(i, 0.0)
                w[i] = 0.0 if abs(zi) <= T.L1 else ((T.L1 if zi > 0 else -T.L1) - zi) / ((T.BETA + ni ** 0.5) / T.ALPHA + T.L2)
            on = [i for i in terms if w[i] != 0]
            for i in on:
                if i not in v:
                    v[i] = [float(start[i, f]) for f in K]
            s = w0 + sum(w[i] for i in terms)
            s += sum(v[a][f] * v[b][f] for x, a in enumerate(on) for b in on[x + 1:] for f in K)
            g = 1 / (1 + math.exp(-s)) - y
            n0 += g * g
            w0 -= 0.1 * g / n0 ** 0.5
            for i in terms:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old ** 0.5) / T.ALPHA * w[i]
                n[i] = old + g * g
            grads = {i: [g * sum(v[j][f] for j in on if j != i) + T.L2_V * v[i][f] for f in K] for i in on}
            for i in on:
                for f in K:
                    at = gv[i, f] = gv.get((i, f), 0.0) + grads[i][f] ** 2
                    v[i][f] -= T.RATE_V * grads[i][f] / (1e-4 + at) ** 0.5
    seen = sum(y for y, _ in rows) / len(rows)
    shift = math.log(share / (1 - share)) - math.log(seen / (1 - seen))
    return w0 + min(max(shift, -3), 3) * T.PRIOR, w, {i: x for i, x in v.items() if w[i] != 0}


def test_fit_against_brute_force():
    rng = np.random.RandomState(3)
    rows = []
    for k in range(300):
        terms = np.unique(rng.randint(0, 12, rng.randint(0, 6))) * 1001
        rows.append((int(1001 in terms and 2002 in terms or k % 9 == 0), terms))
    m = toxicity.fit(rows, 0.1)
    w0, w, v = brute_fit(rows, 0.1)
    assert abs(m.w0 - w0) < 1e-9
    assert set(np.flatnonzero(m.w)) == {i for i, x in w.items() if x} and set(np.flatnonzero(m.v.any(axis=1))) == set(v)
    assert all(abs(m.w[i] - x) < 1e-9 for i, x in w.items())
    assert all(np.allclose(m.v[i], x, atol=1e-9) for i, x in v.items()) and len(v) > 3
