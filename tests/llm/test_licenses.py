import random
import re

import numpy as np

from tabreg.llm import licenses, queries

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))
    places, labels = [], set()
    for t, (label, _, key) in enumerate(licenses.TEMPLATES):
        k = key.split()
        for i in range(len(words) - len(k) + 1):
            if words[i:i + len(k)] == k:
                labels.add(label)
                if t < len(licenses.BASE):
                    places.append((i, label))
    return (len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)))


COLS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
TEXTS = [None, "", "...", "CC-BY cc by", "cc", "by cc", "All rights reserved. all RIGHTS\nreserved", "general public",
         "GNU General Public License, cc by-nc 4.0", "license general public license", "été cc by été", "cc by " * 5000,
         "Released under the MIT License.", "the MIT  license?", "all rights", "reserved", "cc_by", "ccby", "cc é by"]


def test_against_brute_force(docs_of):
    rows = licenses.scan(docs_of(list(enumerate(TEXTS)) + [(None, "cc by"), (3, "cc by")])).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = TEXTS[r["doc_id"]] if r["doc_id"] is not None and not (r["doc_id"] == 3 and r["n_base"] == 1) else "cc by"
        assert tuple(r[c] for c in COLS) == brute(text)
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    full = [r for r in rows if r["doc_id"] == 12][0]
    assert full["score"] == 1.0 and [tuple(p) for p in full["places"]] == [("mit", 3)]
    assert licenses.scan(docs_of([])).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: tuple(r[c] for c in COLS) for r in queries.QUERIES["op8_license_scan"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got == {d["doc_id"]: brute(d["text"]) for d in docs}
    assert sum(bool(v[1]) for v in got.values()) > 10


def test_many_templates_by_postings(docs_of, monkeypatch):
    rng = random.Random(5)
    names = [f"w{i}" for i in range(40)]
    templates = []
    for i in range(600):
        notice = [rng.choice(names) for _ in range(rng.randint(1, 9))]
        lo = rng.randrange(len(notice))
        templates.append((f"t{i}", " ".join(notice), " ".join(notice[lo:lo + rng.randint(1, 4)])))
    texts = [" ".join(rng.choice(names + ["other"]) for _ in range(rng.choice([0, 3, 200]))) for _ in range(20)] + ["w0 " * 300]
    want = []
    for text in texts:
        words = text.split()
        want.append(sorted((i, label) for label, _, key in templates for i in range(len(words))
                           if words[i:i + len(key.split())] == key.split()))
    index = licenses.Index(templates)
    index.post(np.linspace(1, 2, len(index.words)))
    for limit in (2_000_000, 7):                            # all proposals of a slice at once, and a few at a time
        monkeypatch.setattr(licenses, "PROPOSALS", limit)
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        w = licenses.X.Words(data, np.cumsum([0] + [len(t) for t in texts]), licenses._SEP)
        got = [[] for _ in texts]
        for t, d, start, score in index.scan(w):
            for k, doc, s, x in zip(t, d, start, score):
                got[doc].append((int(s - w.first[doc]), templates[k][0]))
                words, notice, at = texts[doc].split(), index.notices[k], index.at[k]
                there = [index.idf[v] for j, v in enumerate(notice) if 0 <= s - w.first[doc] - at + j < len(words)
                         and words[s - w.first[doc] - at + j] == index.words[v]]
                assert abs(x - sum(there) / sum(index.idf[v] for v in notice)) < 1e-9
        assert [sorted(g) for g in got] == want
    rows = licenses.scan(docs_of(list(enumerate(texts))), templates, 0).collect()
    assert all(sorted((p["start"], p["label"]) for p in r["places"]) == want[r["doc_id"]] for r in rows)
