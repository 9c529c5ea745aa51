"""Exact order statistics without funnelling a column through one task.

Spark's exact ``median``/``percentile`` keeps every distinct value of a global
group in one aggregation buffer, merged by a single final task. At scale that is
the whole column in one task. Here an exact rank is found by narrowing:

1. a mergeable ``percentile_approx`` sketch brackets each wanted rank,
2. one conditional-count aggregate verifies the bracket exactly,
3. the bracket's *distinct values with counts* (bounded by ``max_final``) are
   collected and the rank is read off; a bracket with too many distinct
   values (an HLL estimate from the same aggregate) is narrowed again.

Every pass is a scan plus a partial aggregate; filters on the bracket reach the
Parquet reader. A hot value holding a third of all rows collapses to a single
``(value, count)`` entry, so skew never reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_FINAL = 10_000
ACCURACY = 20_000


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def select_ranks(df: DataFrame, sort_col, ranks: list[int], *, proxy=None,
                 n: int | None = None, max_final: int = MAX_FINAL,
                 accuracy: int = ACCURACY) -> list:
    """Values of ``sort_col`` at 0-based ``ranks`` of the ascending order.

    ``proxy`` is an optional numeric column, non-decreasing in ``sort_col``
    (e.g. a 60-bit prefix of an md5 hex string); it drives the narrowing while
    the final read-off uses the exact ``sort_col`` order. Nulls are excluded.
    """
    sort_c = _as_col(sort_col)
    prox = _as_col(proxy) if proxy is not None else sort_c
    base = df.select(sort_c.alias("_s"), prox.cast("double").alias("_p")).where(F.col("_s").isNotNull())
    if n is None:
        n = base.count()
    ranks = list(ranks)
    for r in ranks:
        if r < 0 or r >= n:
            raise ValueError(f"rank {r} outside 0..{n - 1}")
    out: dict[int, object] = {}
    # state per pending rank: (lo, hi) bracket on the proxy; None = unbounded
    pending = {r: (None, None) for r in sorted(set(ranks))}
    sub_n = {r: n for r in pending}      # rows inside the current bracket
    below = {r: 0 for r in pending}      # rows strictly below the bracket
    for _ in range(12):
        if not pending:
            break
        # 1) bracket each pending rank with an approximate quantile over its
        #    current bracket (one aggregate per distinct bracket).
        by_bracket: dict[tuple, list[int]] = {}
        for r, b in pending.items():
            by_bracket.setdefault(b, []).append(r)
        new_brackets = {}
        for (lo, hi), rs in by_bracket.items():
            part = base
            if lo is not None:
                part = part.where(F.col("_p") >= F.lit(lo))
            if hi is not None:
                part = part.where(F.col("_p") <= F.lit(hi))
            m = sub_n[rs[0]]
            if m <= max_final:
                for r in rs:
                    new_brackets[r] = (lo, hi)
                continue
            eps = 1.0 / accuracy
            probs = []
            for r in rs:
                q = (r - below[r] + 0.5) / m
                probs += [max(0.0, q - 2 * eps), min(1.0, q + 2 * eps)]
            qs = part.agg(F.percentile_approx("_p", probs, accuracy).alias("q")).first()["q"]
            for i, r in enumerate(rs):
                new_brackets[r] = (float(qs[2 * i]), float(qs[2 * i + 1]))
        # 2) exact counts below / inside each bracket, one aggregate for all.
        exprs = []
        keys = sorted(new_brackets)
        for r in keys:
            lo, hi = new_brackets[r]
            lt = F.lit(False) if lo is None else (F.col("_p") < F.lit(lo))
            inside = F.lit(True)
            if lo is not None:
                inside = inside & (F.col("_p") >= F.lit(lo))
            if hi is not None:
                inside = inside & (F.col("_p") <= F.lit(hi))
            exprs += [F.count_if(lt).alias(f"b{r}"), F.count_if(inside).alias(f"i{r}"),
                      F.approx_count_distinct(F.when(inside, F.col("_s"))).alias(f"d{r}")]
        cnt = base.agg(*exprs).first()
        nxt = {}
        distinct = {}
        for r in keys:
            distinct[r] = int(cnt[f"d{r}"])
            lo, hi = new_brackets[r]
            b_r, i_r = int(cnt[f"b{r}"]), int(cnt[f"i{r}"])
            if not (b_r <= r < b_r + i_r):
                # the sketch bracket missed (outside its error bound): keep
                # the previous, verified bracket and try again
                nxt[r] = pending[r]
                continue
            below[r], sub_n[r] = b_r, i_r
            nxt[r] = (lo, hi)
        # 3) read off ranks whose bracket holds few distinct values.
        pending = {}
        for (lo, hi) in set(nxt.values()):
            rs = [r for r in nxt if nxt[r] == (lo, hi)]
            part = base
            if lo is not None:
                part = part.where(F.col("_p") >= F.lit(lo))
            if hi is not None:
                part = part.where(F.col("_p") <= F.lit(hi))
            # few distinct values (e.g. one hot value) are read off directly
            few = min(distinct.get(r, max_final + 1) for r in rs) <= 0.8 * max_final
            if sub_n[rs[0]] > max_final and not few and not (lo is not None and lo == hi):
                for r in rs:
                    pending[r] = (lo, hi)
                continue
            rows = (part.groupBy("_s").agg(F.count("*").alias("c"))
                    .orderBy("_s").limit(max_final + 1).collect())
            if len(rows) > max_final:
                for r in rs:
                    pending[r] = (lo, hi)
                continue
            for r in rs:
                k = r - below[r]
                acc = 0
                for row in rows:
                    acc += row["c"]
                    if k < acc:
                        out[r] = row["_s"]
                        break
    if pending:
        raise RuntimeError("rank selection did not converge")
    return [out[r] for r in ranks]


def exact_quantile(df: DataFrame, col, q: float, n: int | None = None) -> float | None:
    """Linear-interpolated quantile (Spark ``percentile`` / DuckDB
    ``quantile_cont``) of a numeric column, exact, distributed."""
    c = _as_col(col)
    if n is None:
        n = df.where(c.isNotNull()).count()
    if n == 0:
        return None
    h = (n - 1) * q
    lo, hi = int(math.floor(h)), int(math.ceil(h))
    vals = select_ranks(df, c, [lo, hi], n=n)
    a, b = float(vals[0]), float(vals[1])
    return a + (h - lo) * (b - a)


def exact_median(df: DataFrame, col, n: int | None = None) -> float | None:
    return exact_quantile(df, col, 0.5, n=n)
