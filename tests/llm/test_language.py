import zlib

import numpy as np
import pyarrow as pa

from tabreg.llm import language, queries
from tabreg.llm import text as X


def brute_counts(text):
    """Grams of one text by definition, as bucket counts."""
    b = bytearray(text.encode())
    for i in range(len(b)):
        if i and b[i - 1] == 0xC3 and 0x80 <= text.encode()[i] <= 0x9E and text.encode()[i] != 0x97:
            b[i] += 0x20
    s = bytearray()
    for c in b:
        c = c + 32 if 0x41 <= c <= 0x5A else c
        c = c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20
        if c == 0x20 and s and s[-1] == 0x20:
            continue
        s.append(c)
    codes = [s[i] << 8 | s[i + 1] for i in range(len(s) - 1)]
    codes += [s[i] << 16 | s[i + 1] << 8 | s[i + 2] | 1 << 25 for i in range(len(s) - 2)]
    g = (X.mix(np.array(codes, np.uint64)) >> np.uint64(64 - 13)).astype(np.int64) if codes else np.zeros(0, np.int64)
    return np.bincount(g, minlength=language.DIM)


def test_counts_match_the_definition():
    texts = ["", "a", "Été À l'école", "--- 12", "x  y", "日本語", "A" * 1000, None, "É", " lead", "b c"]
    col = pa.array(texts)
    got = []
    for _, _, o, d in X.slices(col):
        got += list(language.term_counts(o, d))
    for t, c in zip(texts, got):
        assert (c == brute_counts(t or "")).all(), t


def brute_unit(text, idf):
    v = np.log1p(brute_counts(text).astype(float)) * idf
    return v / max(np.sqrt(v @ v), 1e-12)


def brute_clusters(x):
    """Spherical k-means by its definition, row by row."""
    mean = sum(x) / len(x)
    starts = [max(range(len(x)), key=lambda i: x[i] @ mean)]
    while len(starts) < min(language.CLUSTERS, len(x)):
        starts.append(min(range(len(x)), key=lambda i: max(x[i] @ x[j] for j in starts)))
    centre = [x[i] for i in starts]
    for _ in range(language.ROUNDS):
        near = [max(range(len(centre)), key=lambda j: v @ centre[j]) for v in x]
        for j in range(len(centre)):
            own = [v for v, k in zip(x, near) if k == j]
            if own:
                centre[j] = sum(own) / np.linalg.norm(sum(own))
    return centre


def test_prediction_against_brute_force(docs_of):
    words = {"en": "the house garden king stands there with of and water".split(), "fr": "la maison jardin été roi avec où eau et".split(),
             "de": "das haus garten könig steht dort mit und wasser".split()}
    rng = np.random.RandomState(7)
    rows = [(i, " ".join(rng.choice(words[lang], rng.randint(4, 25))), lang) for i in range(120) for lang in [list(words)[i % 3]]]
    rows += [(500, "zxqj vkwq jjzx", None), (501, "the maison", None), (502, "DAS HAUS 12", None)]
    docs = docs_of([r[:2] for r in rows]).drop("lang").join(
        docs_of([]).sparkSession.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, lang string"), "doc_id")
    known = [(t, lang) for i, t, lang in rows if lang and zlib.crc32(str(i).encode()) % language.HELD_OUT != 2]
    df = sum((brute_counts(t) > 0).astype(float) for t, _ in known)
    idf = np.log((1 + len(known)) / (1 + df)) + 1
    model = language.train(docs)
    assert model.langs == sorted(words) and np.allclose(model.idf, idf, atol=1e-5)
    # the clusters start from the sampled rows' order, so they are taken as sets
    centroids, floors = {}, {}
    for n, lang in enumerate(model.langs):
        own = model.centroids[model.owner == n].astype(float)
        x = [brute_unit(t, idf) for t, k in known if k == lang]
        want = brute_clusters(x)
        assert len(own) == len(want) and all(max(v @ c for c in own) > 1 - 1e-4 for v in want)
        floors[lang] = language.REJECT_MARGIN * np.quantile([max(v @ c for c in own) for v in x], language.REJECT_QUANTILE)
        centroids[lang] = own
        assert abs(model.floors[n] - floors[lang]) < 1e-5
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        v = brute_unit(t, idf)
        best = {lang: max(v @ c for c in cs) for lang, cs in centroids.items()}
        lang = max(best, key=best.get)
        assert got[i]["lang_pred"] == lang and abs(got[i]["score"] - best[lang]) < 1e-5
        if abs(best[lang] - floors[lang]) > 1e-5:
            assert got[i]["rejected"] == (best[lang] < floors[lang])
    assert got[500]["rejected"]


def test_edge_rows(spark, docs_of):
    docs = docs_of([(i, "the house and the garden of the king") for i in range(40)] + [(100, None), (101, ""), (102, "12 -- !"),
                   (103, "…"), (None, "the house"), (100, "the garden"), (104, "the king " * 20000)])
    m = language.train(docs)
    rows = language.predict(docs, m).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] in (101, 102, 103):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        elif r["doc_id"] not in (100,):
            assert r["lang_pred"] == "en" and 0 < r["score"] <= 1 and not r["rejected"]
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert {r["lang_pred"] for r in rows if r["doc_id"] == 100} == {"und", "en"}
    empty = language.train(docs_of([]))
    assert empty.langs == [] and language.predict(docs_of([(1, "x")]), empty).first()["lang_pred"] == "und"
    assert language.predict(docs_of([]), m).count() == 0


def test_distance_rejects_foreign_text(docs_of):
    docs = docs_of([(i, f"the house and garden of king {i % 7} stand there") for i in range(200)])
    far = docs_of([(1, "zxqj vkwq jjzx qqvx kzjq wvxz"), (2, "the house and the garden stand there")])
    got = {r["doc_id"]: r["rejected"] for r in language.predict(far, language.train(docs)).collect()}
    assert got == {1: True, 2: False}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    p = queries.QUERIES["op9_language_id"](spark, sf)
    x = p.join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    h = x[x.held_out & (x.lang_pred != "und")]
    assert len(x) == 1000
    assert (h.lang_pred == h.lang).mean() > 0.97
    assert x.rejected.mean() < 0.02
