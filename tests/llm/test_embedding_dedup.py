import math

import numpy as np

from tabreg.llm import embedding_dedup as ED


def brute(rows, cosine=ED.COSINE):
    """(links, component) of each row by all pairs."""
    ok = [r for r in rows if r[1] is not None and r[2] is not None and r[0] is not None and len(r[1])
          and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    unit = [np.array(r[1], float) / np.abs(r[1]).max() for r in ok]
    unit = [u / np.linalg.norm(u) for u in unit]
    near = [[j for j in range(len(ok)) if j != i and ok[i][2] == ok[j][2] and len(unit[i]) == len(unit[j])
             and unit[i] @ unit[j] >= cosine] for i in range(len(ok))]
    out = {}
    for i, r in enumerate(ok):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[r[0]] = (len(near[i]), min(ok[j][0] for j in seen))
    return {r[0]: out.get(r[0], (0, r[0])) for r in rows}


SCHEMA = "vec_id long, embedding array<float>, label int, node string, key int"


def run(spark, rows):
    got = ED.near_duplicates(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    assert all(r["kept"] == (r["component_id"] == r["vec_id"]) or r["vec_id"] is None for r in got)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}


def near(rng, base, noise):
    return [float(x) for x in base + noise * rng.normal(size=len(base))]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0] + [0.0] * 7
    rows = [(9, v, 1), (8, v, 1), (7, [2 * x for x in v], 1), (6, v, 2), (5, v, None), (4, None, 1), (3, [0.0] * 8, 1),
            (2, [nan] * 8, 1), (1, [inf] + [0.0] * 7, 1), (0, [None] + [1.0] * 7, 1), (10, [], 1), (11, [1.0, 0.0], 1),
            (12, [3e38] * 8, 1), (13, [1e-30] * 8, 1), (None, v, 1)]
    got = run(spark, rows)
    assert got == {**brute(rows[:-1]), None: (0, None)}
    assert got[9] == (2, 7) and got[12] == (1, 12)
    assert ED.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_and_precision(spark, monkeypatch):
    monkeypatch.setattr(ED, "BLOCK", 16)              # buckets of several blocks
    rng = np.random.RandomState(5)
    rows = []
    for g in range(30):
        base = rng.normal(size=32)
        rows += [(None, near(rng, base, rng.choice([0.02, 0.1, 0.15])), g % 4) for _ in range(rng.randint(1, 8))]
    hot = rng.normal(size=32)
    rows += [(None, near(rng, hot, 0.05), 1) for _ in range(80)] + [(None, [float(x) for x in hot], 1)] * 5
    rows = [(int(i), r[1], r[2]) for i, r in zip(rng.permutation(len(rows)), rows)]
    rows = [(i, [float(np.float32(x)) for x in e], label) for i, e, label in rows]
    want, got = brute(rows), run(spark, rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values()) > 1000


def test_plan_reaches_the_target():
    for rows in (2, 1000, 10 ** 9):
        k, tables = ED.plan(rows)
        assert 1 - (1 - ED.agree(math.sqrt(2 - 2 * ED.COSINE)) ** k) ** tables >= ED.RECALL
