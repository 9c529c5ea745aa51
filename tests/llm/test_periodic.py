import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tabreg.llm import periodic, queries
from tabreg.llm import text as X

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """(start, length, period) of every run of a list, period by period."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out)


def expected(doc_id, text, rewrite=True):
    words = SPLIT.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if rewrite and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(kept))


def random_words(rng):
    out, kinds = [], rng.choice([1, 2, 3, 40, 1000])
    for _ in range(rng.randint(0, 6)):
        base = [rng.randrange(kinds) for _ in range(rng.randint(1, 40))]
        out += (base * 9)[:rng.randint(1, 6 * len(base) + 30)]
        out += [rng.randrange(50) for _ in range(rng.randint(0, 30))]
    return out


def test_runs_against_brute_force():
    rng, found = random.Random(5), 0
    for _ in range(600):
        words = random_words(rng)
        want = brute(words)
        found += len(want)
        assert periodic.find_runs(X.mix(np.array(words, np.uint64) + np.uint64(7))) == want, words
    assert found > 500


@pytest.mark.parametrize("n", [1, 2, 8, 64, 1024])
def test_transform(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, periodic.P, (3, n)).astype(np.uint64) for _ in range(2))
    assert (periodic.intt(periodic.ntt(a)) == a).all()
    got = periodic.intt(periodic.ntt(a) * periodic.ntt(b) % np.uint64(periodic.P))
    for r in range(3):
        if n <= 64:
            want = [sum(int(a[r, i]) * int(b[r, (k - i) % n]) for i in range(n)) % periodic.P for k in range(n)]
            assert got[r].tolist() == want


def test_occurrences_are_all_found(monkeypatch):
    monkeypatch.setattr(periodic, "CELLS", 64)
    rng = np.random.default_rng(2)
    for size, first in ((8, 1), (8, 8), (16, 16), (64, 64)):
        x = np.resize(rng.integers(1, 4, 23), 700).astype(np.uint64)
        x[rng.integers(0, 700, 6)] = 9
        begin = np.arange(0, 700 - size, size)
        b, d = periodic.occurrences(x, begin, size, first)
        want = {(i, k) for i in begin.tolist() for k in range(first, 2 * size) if i + k + size <= 700 and (x[i:i + size] == x[i + k:i + k + size]).all()}
        assert set(zip(b.tolist(), d.tolist())) == want and (want or size == 8)


def test_long_and_hot_texts():
    mix = lambda a: X.mix(np.asarray(a).astype(np.uint64))
    assert periodic.find_runs(mix(np.zeros(400_000))) == [(0, 400_000, 1)]
    assert periodic.find_runs(mix(np.arange(400_000) % 120_001)) == [(0, 400_000, 120_001)]
    assert periodic.find_runs(mix(np.arange(400_000))) == []
    many = np.where(np.arange(300_000) % 25 == 24, np.arange(300_000), 1_000_000)      # 12,000 runs of one word
    assert periodic.find_runs(mix(many)) == [(i, 24, 1) for i in range(0, 300_000, 25)]


def test_query_against_brute_force(spark, docs_of, monkeypatch):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{k}" for k in random_words(rng))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \t\x0b"), (1003, "a\x85b " * 30), (1004, "x\n\x0cy " * 500), (1005, "é " * 24), (1006, "é " * 23),
             (None, "k " * 40), (None, None), (7, "same " * 30), (7, "same " * 30), (1007, "A a " * 30), (1008, "a b\tc\r" * 20 + "a"), (-3, "u v " * 70)]
    docs = docs_of(rows).selectExpr("*", "1 as runs", "'x' as collapsed").repartition(4)
    monkeypatch.setattr(queries, "table", lambda *a: docs)
    got = sorted(map(tuple, queries.QUERIES["op11_periodic_runs"](spark, "").collect()), key=repr)
    assert got == sorted((expected(d, t) for d, t in rows), key=repr)
    assert periodic.periodic_runs(docs.limit(0)).collect() == []


def test_real_texts_of_the_operator(spark, docs_of):
    out = periodic.periodic_runs(docs_of([(1, "start " + "a  b\n" * 20 + "end")])).first()
    assert [tuple(r) for r in out["runs"]] == [(1, 40, 2)] and out["collapsed"] == "start a b end" and out["n_words"] == 42


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    short = {r[0]: expected(*r) for r in rows if len(SPLIT.findall(r[1] or "")) <= 1500}
    got = {r[0]: tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, sf).collect()}
    assert len(got) == len(rows) and {d: got[d] for d in short} == short and len(short) > 150
