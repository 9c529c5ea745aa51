"""Registered queries: one per operator of the inventory, each reading the
driver's tables (or data Spark derives from them), plus the DuckDB SQL that
states the same result for the operators SQL can express.

Floats are rounded on both sides (summation order differs between engines);
``+ 0.0`` turns a rounded -0.0 into 0.0. Column names match one to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import elementwise as E
from ..functions import losses as L
from ..operators import metrics as M
from ..operators import rows as R
from ..operators import scale as S
from ..operators import stats as ST
from . import housing as H

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


# Rounding exists only to compare two engines' floats; the bench turns it off
# to time the operators themselves (Spark's round() on doubles is costly).
ORACLE_ROUNDING = True


def rnd(c, d: int):
    c = F.col(c) if isinstance(c, str) else c
    if not ORACLE_ROUNDING:
        return c
    return F.round(c, d) + F.lit(0.0)


def rnd_all(df: DataFrame, d: int, skip=()) -> DataFrame:
    if not ORACLE_ROUNDING:
        return df
    out = []
    for c, t in df.dtypes:
        if t in ("double", "float") and c not in skip:
            out.append(rnd(c, d).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


FEATS = H.FEATURES
TGT = H.TARGET

# housing_like in SQL (the same four joins)
HOUSING_CTE = """
h AS (
  SELECT l.l_quantity, l.l_discount, l.l_tax, CAST(p.p_size AS DOUBLE) AS p_size,
         p.p_retailprice, s.s_acctbal, c.c_acctbal, o.o_totalprice, l.l_extendedprice
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""


def _r(x: str, d: int) -> str:
    return f"round({x}, {d}) + 0.0"


# ------------------------------------------------------------- aggregates

@query("dataset_statistics", f"""
WITH {HOUSING_CTE}
SELECT CAST(count(*) AS BIGINT) AS row_count,
       {_r('avg(l_extendedprice)', 3)} AS mean_price,
       {_r('median(l_extendedprice)', 3)} AS median_price,
       {_r('avg(o_totalprice)', 3)} AS mean_income,
       {_r('sum(p_size)', 2)} AS total_rooms_sum
FROM h""")
def q_dataset_statistics(spark, d):
    df = H.housing_named(spark, d)
    st = ST.dataset_statistics(df)
    return st.select("row_count", rnd("mean_price", 3).alias("mean_price"),
                     rnd("median_price", 3).alias("median_price"),
                     rnd("mean_income", 3).alias("mean_income"),
                     rnd("total_rooms_sum", 2).alias("total_rooms_sum"))


@query("profile", f"WITH {HOUSING_CTE}\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS "count", {_r(f'avg({c})', 4)} AS mean,
  {_r(f'stddev_samp({c})', 4)} AS std, {_r(f'min({c})', 4)} AS "min", {_r(f'max({c})', 4)} AS "max" FROM h"""
    for c in FEATS + [TGT]))
def q_profile(spark, d):
    """count / mean / sample std / min / max of every column, one aggregate."""
    p = ST.profile(H.housing_table(spark, d), FEATS + [TGT])
    return p.select("column", "count", *[rnd(c, 4).alias(c) for c in ("mean", "std", "min", "max")])


@query("shape", f"""
WITH {HOUSING_CTE}
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(9 AS BIGINT) AS n_cols FROM h""")
def q_shape(spark, d):
    return ST.shape(H.housing_table(spark, d))


def _std_stats_sql(ddof_fn: str) -> str:
    parts = []
    for c in FEATS:
        parts.append(f"""SELECT '{c}' AS "column", {_r(f'coalesce(avg({c}), 0.0)', 4)} AS mean,
  {_r(f'CASE WHEN coalesce({ddof_fn}({c}), 1.0) > 1e-8 THEN coalesce({ddof_fn}({c}), 1.0) ELSE 1.0 END', 4)} AS std FROM h""")
    return f"WITH {HOUSING_CTE}\n" + "\nUNION ALL\n".join(parts)


@query("fit_standard_samp", _std_stats_sql("stddev_samp"))
def q_fit_standard_samp(spark, d):
    t = S.fit_table(H.housing_table(spark, d), S.StandardScaler(FEATS, ddof=1))
    return t.select("column", rnd("mean", 4).alias("mean"), rnd("std", 4).alias("std"))


@query("fit_standard_pop", _std_stats_sql("stddev_pop"))
def q_fit_standard_pop(spark, d):
    t = S.fit_table(H.housing_table(spark, d), S.StandardScaler(FEATS, ddof=0))
    return t.select("column", rnd("mean", 4).alias("mean"), rnd("std", 4).alias("std"))


@query("fit_minmax", f"WITH {HOUSING_CTE}\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", coalesce(min({c}), 0.0) + 0.0 AS "min", coalesce(max({c}), 1.0) + 0.0 AS "max" FROM h"""
    for c in FEATS))
def q_fit_minmax(spark, d):
    t = S.fit_table(H.housing_table(spark, d), S.MinMaxScaler(FEATS))
    return t.select("column", (F.col("min") + 0.0).alias("min"), (F.col("max") + 0.0).alias("max"))


@query("scaler_params", f"WITH {HOUSING_CTE}\n" + "\nUNION ALL\n".join(
    f"""SELECT 'standard' AS scaler, '{c}' AS "column", 'mean' AS stat, {_r(f'avg({c})', 4)} AS value FROM h
UNION ALL SELECT 'standard', '{c}', 'std', {_r(f'CASE WHEN stddev_samp({c}) > 1e-8 THEN stddev_samp({c}) ELSE 1.0 END', 4)} FROM h
UNION ALL SELECT 'standard', '{c}', 'ddof', 1.0""" for c in FEATS))
def q_scaler_params(spark, d):
    t = S.params_from_fit(H.housing_table(spark, d), S.StandardScaler(FEATS, ddof=1))
    return t.select("scaler", "column", "stat", rnd("value", 4).alias("value"))


def _scaled_sql(kind: str, ddof_fn: str = "stddev_samp", scale_target: bool = False, d: int = 5) -> str:
    cols = FEATS + ([TGT] if scale_target else [])
    st = []
    for c in cols:
        if kind == "standard":
            st.append(f"coalesce(avg({c}), 0.0) AS m_{c}, CASE WHEN coalesce({ddof_fn}({c}), 1.0) > 1e-8 "
                      f"THEN coalesce({ddof_fn}({c}), 1.0) ELSE 1.0 END AS s_{c}")
        else:
            st.append(f"coalesce(min({c}), 0.0) AS lo_{c}, coalesce(max({c}), 1.0) AS hi_{c}")
    sel = []
    for c in FEATS + [TGT]:
        if c not in cols:
            sel.append(f"{_r(c, d)} AS {c}")
        elif kind == "standard":
            sel.append(f"{_r(f'({c} - m_{c}) / s_{c}', d)} AS {c}")
        else:
            sel.append(f"{_r(f'CASE WHEN hi_{c} - lo_{c} > 1e-8 THEN ({c} - lo_{c}) / (hi_{c} - lo_{c}) ELSE 0.5 END', d)} AS {c}")
    return (f"WITH {HOUSING_CTE},\nst AS (SELECT {', '.join(st)} FROM h)\n"
            f"SELECT {', '.join(sel)} FROM h, st")


@query("standard_scale", _scaled_sql("standard"))
def q_standard_scale(spark, d):
    df = H.housing_table(spark, d)
    m = S.StandardScaler(FEATS, ddof=1).fit(df)
    return rnd_all(m.transform(df), 5)


@query("minmax_scale", _scaled_sql("minmax", d=6))
def q_minmax_scale(spark, d):
    df = H.housing_table(spark, d)
    m = S.MinMaxScaler(FEATS).fit(df)
    return rnd_all(m.transform(df), 6)


@query("preprocess", _scaled_sql("standard", "stddev_pop", scale_target=True))
def q_preprocess(spark, d):
    out, _, _ = S.preprocess(H.housing_table(spark, d), FEATS, TGT, ddof=0, scale_target=True)
    return rnd_all(out, 5)


@query("preprocess_minmax", _scaled_sql("minmax", scale_target=True, d=6))
def q_preprocess_minmax(spark, d):
    out, _, _ = S.preprocess(H.housing_table(spark, d), FEATS, TGT, scaler="minmax", scale_target=True)
    return rnd_all(out, 6)


_QUARTILES_CTE = f"""WITH {HOUSING_CTE},
st AS (SELECT {', '.join(f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS q_{c}" for c in FEATS)}
       FROM h)"""


@query("fit_robust", _QUARTILES_CTE + "\n" + "\nUNION ALL\n".join(
    f"""SELECT 'robust' AS scaler, '{c}' AS "column", 'median' AS stat, {_r(f'm_{c}', 4)} AS value FROM st
UNION ALL SELECT 'robust', '{c}', 'iqr', {_r(f'CASE WHEN q_{c} > 1e-8 THEN q_{c} ELSE 1.0 END', 4)} FROM st""" for c in FEATS))
def q_fit_robust(spark, d):
    """A kind from the scaler registry with statistics of its own: exact medians and quartile ranges."""
    t = S.params_from_fit(H.housing_table(spark, d), S.make_scaler("robust", FEATS))
    return t.select("scaler", "column", "stat", rnd("value", 4).alias("value"))


@query("preprocess_robust", _QUARTILES_CTE + f"""
SELECT {', '.join(_r(f'({c} - m_{c}) / CASE WHEN q_{c} > 1e-8 THEN q_{c} ELSE 1.0 END', 5) + f' AS {c}' for c in FEATS)},
       {_r(TGT, 5)} AS {TGT} FROM h, st""")
def q_preprocess_robust(spark, d):
    """Robust scaling with parameters reloaded from their table."""
    h = H.housing_table(spark, d)
    _, m, _ = S.preprocess(h, FEATS, TGT, scaler="robust")
    back = S.model_from_params(S.params_table(spark, m), "robust")
    return rnd_all(back.transform(h.select(*FEATS, TGT)), 5)


@query("inverse_scale", f"""
WITH {HOUSING_CTE},
st AS (SELECT {', '.join(f"avg({c}) AS m_{c}, CASE WHEN stddev_samp({c}) > 1e-8 THEN stddev_samp({c}) ELSE 1.0 END AS s_{c}" for c in FEATS)} FROM h)
SELECT {', '.join(f"{_r(f'(({c} - m_{c}) / s_{c}) * s_{c} + m_{c}', 4)} AS {c}" for c in FEATS)}, {_r(TGT, 4)} AS {TGT}
FROM h, st""")
def q_inverse_scale(spark, d):
    df = H.housing_table(spark, d)
    m = S.StandardScaler(FEATS, ddof=1).fit(df)
    return rnd_all(m.inverse(m.transform(df)), 4)


@query("minmax_constant", """
WITH x AS (
  SELECT l_orderkey, l_linenumber, l_quantity * 0.0 + 3.0 AS c_const,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE 3.0 END AS c_const_null,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS c_with_null
  FROM lineitem),
st AS (SELECT coalesce(min(c_with_null), 0.0) AS lo, coalesce(max(c_with_null), 1.0) AS hi FROM x)
SELECT l_orderkey, l_linenumber, CAST(0.5 AS DOUBLE) AS c_const, CAST(0.5 AS DOUBLE) AS c_const_null,
       round((c_with_null - lo) / (hi - lo), 6) + 0.0 AS c_with_null
FROM x, st""")
def q_minmax_constant(spark, d):
    li = H.read(spark, d, "lineitem")
    x = li.select("l_orderkey", "l_linenumber",
                  (F.col("l_quantity") * 0.0 + 3.0).alias("c_const"),
                  F.when(F.col("l_linenumber") == 1, F.lit(None).cast("double")).otherwise(F.lit(3.0)).alias("c_const_null"),
                  F.when(F.col("l_linenumber") == 1, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("c_with_null"))
    m = S.MinMaxScaler(["c_const", "c_const_null", "c_with_null"]).fit(x)
    return rnd_all(m.transform(x), 6)


@query("scaling_report", f"""
WITH {HOUSING_CTE},
st AS (SELECT {', '.join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 1e-8 THEN stddev_pop({c}) ELSE 1.0 END AS s_{c}" for c in FEATS + [TGT])} FROM h),
z AS (SELECT {', '.join(f"({c} - m_{c}) / s_{c} AS z_{c}" for c in FEATS + [TGT])}, h.* FROM h, st)
SELECT {_r('(' + ' + '.join(f'sum({c})' for c in FEATS) + ') / (' + ' + '.join(f'count({c})' for c in FEATS) + ')', 4)} AS feature_mean_before,
       {_r('(' + ' + '.join(f'sum(z_{c})' for c in FEATS) + ') / (' + ' + '.join(f'count(z_{c})' for c in FEATS) + ')', 6)} AS feature_mean_after,
       {_r(f'avg({TGT})', 4)} AS target_mean_before, {_r(f'avg(z_{TGT})', 6)} AS target_mean_after,
       {_r(f'min({TGT})', 4)} AS target_min_before, {_r(f'max({TGT})', 4)} AS target_max_before,
       {_r(f'min(z_{TGT})', 6)} AS target_min_after, {_r(f'max(z_{TGT})', 6)} AS target_max_after
FROM z""")
def q_scaling_report(spark, d):
    df = H.housing_table(spark, d)
    fm, tm = S.fit_many(df, [S.StandardScaler(FEATS, 0), S.StandardScaler([TGT], 0)])
    rep = S.scaling_report(df, FEATS, TGT, fm, tm)
    six = {"feature_mean_after", "target_mean_after", "target_min_after", "target_max_after"}
    return rep.select(*[rnd(c, 6 if c in six else 4).alias(c) for c in rep.columns])


# -------------------------------------------------------------- positions

@query("row_index", """
SELECT event_id, CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS row_idx FROM events""")
def q_row_index(spark, d):
    ev = H.read(spark, d, "events").select("event_id")
    return R.row_index(ev, "event_id")


@query("train_test_split", """
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY event_id) <= CAST(floor(0.8 * count(*) OVER ()) AS BIGINT)
                      THEN 'train' ELSE 'test' END AS split FROM events""")
def q_train_test_split(spark, d):
    ev = H.read(spark, d, "events").select("event_id")
    return R.train_test_split(ev, "event_id", 0.8)


@query("random_val_split", """
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('42-' || CAST(o_orderkey AS VARCHAR)))
                           <= greatest(1, CAST(floor(count(*) OVER () * 0.2) AS BIGINT))
                        THEN 'val' ELSE 'train' END AS split FROM orders""")
def q_random_val_split(spark, d):
    o = H.read(spark, d, "orders").select("o_orderkey")
    return R.random_val_split(o, "o_orderkey", 0.2, seed=42)


@query("row_index_string", """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderpriority || '/' || CAST(o_orderkey AS VARCHAR)) - 1 AS BIGINT) AS row_idx
FROM orders""")
def q_row_index_string(spark, d):
    """Positions in the order of a text key that is not hex."""
    key = F.concat_ws("/", "o_orderpriority", F.col("o_orderkey").cast("string"))
    return R.row_index(H.read(spark, d, "orders").select("o_orderkey", "o_orderpriority"), key).drop("o_orderpriority")


@query("row_index_nulls", """
WITH r AS (SELECT l_quantity AS q, row_number() OVER (ORDER BY l_quantity NULLS LAST) - 1 AS i
           FROM (SELECT CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END AS l_quantity FROM lineitem))
SELECT q, count(*) AS n, CAST(min(i) AS BIGINT) AS first_idx, CAST(max(i) AS BIGINT) AS last_idx FROM r GROUP BY q""")
def q_row_index_nulls(spark, d):
    """A key of few values and many nulls: each value's rows take one run of positions, nulls the last."""
    li = H.read(spark, d, "lineitem").select(F.when(F.col("l_linenumber") != 2, F.col("l_quantity")).alias("q"))
    return R.row_index(li, "q").groupBy("q").agg(F.count("*").alias("n"), F.min("row_idx").alias("first_idx"),
                                                 F.max("row_idx").alias("last_idx"))


@query("train_test_split_ties", """
WITH r AS (SELECT l_quantity AS q, CASE WHEN row_number() OVER (ORDER BY l_quantity) <= floor(0.5 * count(*) OVER ())
                                        THEN 'train' ELSE 'test' END AS split FROM lineitem)
SELECT split, q, count(*) AS n FROM r GROUP BY split, q""")
def q_train_test_split_ties(spark, d):
    """The first half by a key that repeats thousands of times: exactly half."""
    li = H.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"))
    return R.train_test_split(li, "q", 0.5).groupBy("split", "q").agg(F.count("*").alias("n"))


@query("random_val_split_ties", """
WITH r AS (SELECT l_returnflag AS f, CASE WHEN row_number() OVER (ORDER BY md5('42-' || l_returnflag))
                  <= greatest(1, CAST(floor(count(*) OVER () * 0.2) AS BIGINT)) THEN 'val' ELSE 'train' END AS split FROM lineitem)
SELECT split, f, count(*) AS n FROM r GROUP BY split, f""")
def q_random_val_split_ties(spark, d):
    """A split key of three values: exactly a fifth of the rows, though whole values are tied."""
    li = H.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("f"))
    return R.random_val_split(li, "f", 0.2, seed=42).groupBy("split", "f").agg(F.count("*").alias("n"))


@query("minibatch", """
SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / ceil(count(*) OVER () / 10.0)) AS INTEGER) AS batch
FROM orders""")
def q_minibatch(spark, d):
    o = H.read(spark, d, "orders").select("o_orderkey")
    return R.minibatch(o, "o_orderkey")


@query("epoch_shuffle", """
SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY md5('42-3-' || CAST(o_orderkey AS VARCHAR))) - 1)
                               / greatest(16, ceil(count(*) OVER () / 10.0))) AS INTEGER) AS batch
FROM orders""")
def q_epoch_shuffle(spark, d):
    o = H.read(spark, d, "orders").select("o_orderkey")
    n = o.count()
    return R.epoch_shuffle(o, "o_orderkey", seed=42, epoch=3,
                           batch_size=R.default_batch_size(n, "python"), n=n)


def _feistel_sql(source: str, keys: list[int]) -> str:
    """One pass of the keyed permutation over ``source`` (o_orderkey, x, n, a, b):
    a and b are the bits of the two halves, which change sides in each round."""
    for i, key in enumerate(keys):
        left, right = ("a", "b") if i % 2 == 0 else ("b", "a")
        t = f"((xor(x & ((1::BIGINT << {right}) - 1), {key}) * 1103515245 + 12345) % 2147483648)"
        source = f"""(SELECT o_orderkey, n, a, b, ((x & ((1::BIGINT << {right}) - 1)) << {left})
          + xor(x >> {right}, (((xor({t}, {t} >> 15) * 48271 + {key}) % 2147483647) >> 4) & ((1::BIGINT << {left}) - 1)) AS x
          FROM {source})"""
    return source


@query("epoch_shuffle_keyed", f"""
WITH RECURSIVE c AS (SELECT count(*)::BIGINT AS n, greatest(2, length(ltrim(bin(count(*) - 1), '0')))::INT AS bits FROM orders),
p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS x, n, bits // 2 AS a, bits - bits // 2 AS b FROM orders, c),
w AS (SELECT o_orderkey, x, n, a, b FROM {_feistel_sql('p', R.shuffle_keys(42, 'epoch', 3))}
      UNION ALL SELECT o_orderkey, x, n, a, b FROM {_feistel_sql('(SELECT * FROM w WHERE x >= n)', R.shuffle_keys(42, 'epoch', 3))})
SELECT o_orderkey, x AS place, CAST(x // greatest(16, CAST(ceil(n / 10.0) AS BIGINT)) AS INTEGER) AS batch FROM w WHERE x < n""")
def q_epoch_shuffle_keyed(spark, d):
    """The trainer's epoch order: a keyed permutation of the row positions; every row computes its own batch."""
    o = R.row_index(H.read(spark, d, "orders").select("o_orderkey"), "o_orderkey", "pos")
    n = o.count()
    keys = R.shuffle_keys(42, "epoch", 3)
    return o.select("o_orderkey", R.permuted("pos", n, keys).alias("place"),
                    R.permuted_batch("pos", n, R.default_batch_size(n, "python"), 42, 3).alias("batch"))


@query("preview", """
SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 5""")
def q_preview(spark, d):
    ev = H.read(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return R.preview(ev, "event_id", 5)


# ------------------------------------------------------------ elementwise

_CUST_X = "c_acctbal / 1000.0"
_CUST_G = "(c_nationkey - 12) / 10.0"


def _cust(spark, d):
    c = H.read(spark, d, "customer")
    return c.select("c_custkey", (F.col("c_acctbal") / 1000.0).alias("x"),
                    ((F.col("c_nationkey") - 12) / 10.0).alias("g"))


def _elem_sql(expr: str, name: str) -> str:
    return (f"SELECT c_custkey, {_r(expr, 6)} AS {name} FROM "
            f"(SELECT c_custkey, {_CUST_X} AS x, {_CUST_G} AS g FROM customer)")


@query("relu", _elem_sql("greatest(x, 0.0)", "relu_x"))
def q_relu(spark, d):
    return _cust(spark, d).select("c_custkey", rnd(E.relu("x"), 6).alias("relu_x"))


@query("sigmoid", _elem_sql("1.0 / (1.0 + exp(-x))", "sigmoid_x"))
def q_sigmoid(spark, d):
    return _cust(spark, d).select("c_custkey", rnd(E.sigmoid("x"), 6).alias("sigmoid_x"))


@query("tanh", _elem_sql("tanh(x)", "tanh_x"))
def q_tanh(spark, d):
    return _cust(spark, d).select("c_custkey", rnd(E.tanh("x"), 6).alias("tanh_x"))


@query("identity", _elem_sql("x", "x"))
def q_identity(spark, d):
    return _cust(spark, d).select("c_custkey", rnd(E.identity("x"), 6).alias("x"))


@query("relu_derivative", _elem_sql("CAST(CASE WHEN x > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE)", "d_relu"))
def q_relu_derivative(spark, d):
    return _cust(spark, d).select("c_custkey", rnd(E.relu_derivative("x"), 6).alias("d_relu"))


@query("linear_derivative", _elem_sql("CAST(1.0 AS DOUBLE)", "d_linear"))
def q_linear_derivative(spark, d):
    return _cust(spark, d).select("c_custkey", rnd(E.linear_derivative("x"), 6).alias("d_linear"))


@query("relu_backward", _elem_sql("CASE WHEN x > 0 THEN g ELSE 0.0 END", "grad_in"))
def q_relu_backward(spark, d):
    return _cust(spark, d).select("c_custkey", rnd(E.relu_backward("g", "x"), 6).alias("grad_in"))


@query("sigmoid_backward", _elem_sql("g * (1.0 / (1.0 + exp(-x))) * (1.0 - 1.0 / (1.0 + exp(-x)))", "grad_in"))
def q_sigmoid_backward(spark, d):
    c = _cust(spark, d).withColumn("s", E.sigmoid("x"))
    return c.select("c_custkey", rnd(E.sigmoid_backward("g", "s"), 6).alias("grad_in"))


@query("tanh_backward", _elem_sql("g * (1.0 - tanh(x) * tanh(x))", "grad_in"))
def q_tanh_backward(spark, d):
    c = _cust(spark, d).withColumn("t", E.tanh("x"))
    return c.select("c_custkey", rnd(E.tanh_backward("g", "t"), 6).alias("grad_in"))


@query("relu_embeddings", """
SELECT vec_id, round(sum(greatest(CAST(e AS DOUBLE), 0.0)), 5) + 0.0 AS relu_sum,
       CAST(sum(CASE WHEN e > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_active
FROM (SELECT vec_id, unnest(embedding) AS e FROM embeddings) GROUP BY vec_id""")
def q_relu_embeddings(spark, d):
    em = H.read(spark, d, "embeddings")
    r = E.array_map("embedding", lambda e: E.relu(e))
    dr = E.array_map("embedding", lambda e: E.relu_derivative(e))
    return em.select("vec_id",
                     rnd(F.aggregate(r, F.lit(0.0), lambda a, b: a + b), 5).alias("relu_sum"),
                     F.aggregate(dr, F.lit(0.0), lambda a, b: a + b).cast("long").alias("n_active"))


# ------------------------------------------------------- losses & metrics

_PRED_CTE = """p AS (
  SELECT o.o_orderkey AS row_id, (c.c_acctbal * 10 + 100000) / 100000 AS pred,
         o.o_totalprice / 100000 AS actual, c.c_mktsegment AS segment
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


@query("mae_loss_mean", f"WITH {_PRED_CTE} SELECT {_r('avg(abs(pred - actual))', 8)} AS loss FROM p")
def q_mae_mean(spark, d):
    df = H.predictions_fixture(spark, d)
    return L.mae_loss(df, [("pred", "actual")], "mean").select(rnd("loss", 8).alias("loss"))


@query("mae_loss_sum", f"WITH {_PRED_CTE} SELECT {_r('sum(abs(pred - actual))', 5)} AS loss FROM p")
def q_mae_sum(spark, d):
    df = H.predictions_fixture(spark, d)
    return L.mae_loss(df, [("pred", "actual")], "sum").select(rnd("loss", 5).alias("loss"))


@query("mae_loss_none", f"WITH {_PRED_CTE} SELECT row_id, {_r('abs(pred - actual)', 8)} AS loss FROM p")
def q_mae_none(spark, d):
    df = H.predictions_fixture(spark, d)
    return rnd_all(L.mae_loss(df, [("pred", "actual")], "none", keep=["row_id"]), 8)


@query("mae_backward", f"""WITH {_PRED_CTE}
SELECT row_id, {_r('sign(pred - actual) / count(*) OVER ()', 10)} AS grad_pred FROM p""")
def q_mae_backward(spark, d):
    df = H.predictions_fixture(spark, d)
    return rnd_all(L.mae_backward(df, [("pred", "actual")], "mean", keep=["row_id"]), 10)


def _metrics_sql(group: bool) -> str:
    g = "segment, " if group else ""
    gb = "GROUP BY segment" if group else ""
    return f"""WITH {_PRED_CTE}
SELECT {g}{_r('avg(abs(actual - pred))', 8)} AS mae,
       {_r('avg((actual - pred) * (actual - pred))', 8)} AS mse,
       {_r('sqrt(avg((actual - pred) * (actual - pred)))', 8)} AS rmse,
       {_r('CASE WHEN var_pop(actual) * count(*) > 0 THEN 1.0 - sum((actual - pred) * (actual - pred)) / (var_pop(actual) * count(*)) ELSE 0.0 END', 8)} AS r2,
       {_r('avg(abs(actual - pred) / greatest(abs(actual), 1e-8)) * 100', 6)} AS mape,
       {_r('stddev_samp(pred)', 8)} AS pred_std,
       {_r('stddev_samp(actual)', 8)} AS target_std,
       CAST(count(*) AS BIGINT) AS n
FROM p {gb}"""


def _round_metrics(m: DataFrame) -> DataFrame:
    dp = {"mape": 6}
    return m.select(*[rnd(c, dp.get(c, 8)).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes])


@query("regression_metrics", _metrics_sql(False))
def q_regression_metrics(spark, d):
    return _round_metrics(M.regression_metrics(H.predictions_fixture(spark, d)))


@query("regression_metrics_by_segment", _metrics_sql(True))
def q_regression_metrics_by_segment(spark, d):
    return _round_metrics(M.regression_metrics(H.predictions_fixture(spark, d), by="segment"))


@query("mae_grade", f"""WITH {_PRED_CTE},
m AS (SELECT avg(abs(actual - pred)) AS mae, stddev_samp(actual) AS target_std FROM p)
SELECT {_r('CASE WHEN target_std > 0 THEN mae / target_std * 100 ELSE 0.0 END', 6)} AS mae_pct,
       CASE WHEN (CASE WHEN target_std > 0 THEN mae / target_std * 100 ELSE 0.0 END) < 30 THEN 'Excellent'
            WHEN (CASE WHEN target_std > 0 THEN mae / target_std * 100 ELSE 0.0 END) < 50 THEN 'Good'
            WHEN (CASE WHEN target_std > 0 THEN mae / target_std * 100 ELSE 0.0 END) < 70 THEN 'Acceptable'
            ELSE 'Poor' END AS grade,
       CASE WHEN mae < 0.5 THEN 'good' WHEN mae <= 0.8 THEN 'acceptable' ELSE 'poor' END AS mae_band
FROM m""")
def q_mae_grade(spark, d):
    g = M.mae_grade(M.regression_metrics(H.predictions_fixture(spark, d)))
    return g.select(rnd("mae_pct", 6).alias("mae_pct"), "grade", "mae_band")


@query("predictions_table", f"""WITH {_PRED_CTE}
SELECT row_id, {_r('pred', 8)} AS out_0, {_r('actual', 8)} AS actual, {_r('pred - actual', 8)} AS residual FROM p""")
def q_predictions_table(spark, d):
    return rnd_all(M.predictions_table(H.predictions_fixture(spark, d), "pred", "actual", keep=["row_id"]), 8)


@query("sample_predictions", f"""WITH {_PRED_CTE}
SELECT row_id, {_r('pred', 8)} AS predicted, {_r('actual', 8)} AS actual FROM p ORDER BY row_id LIMIT 5""")
def q_sample_predictions(spark, d):
    p = H.predictions_fixture(spark, d).select("row_id", rnd("pred", 8).alias("predicted"),
                                               rnd("actual", 8).alias("actual"))
    return R.preview(p, "row_id", 5)


_BATCH_CTE = """b AS (
  SELECT *, CAST(floor((row_number() OVER (ORDER BY row_id) - 1) / ceil(count(*) OVER () / 10.0)) AS INTEGER) AS batch FROM p)"""


@query("batch_losses", f"""WITH {_PRED_CTE}, {_BATCH_CTE}
SELECT CAST(batch + 1 AS INTEGER) AS batch, {_r('avg(abs(pred - actual))', 8)} AS batch_loss FROM b GROUP BY batch""")
def q_batch_losses(spark, d):
    p = R.minibatch(H.predictions_fixture(spark, d), "row_id")
    return rnd_all(M.batch_losses(p, "pred", "actual"), 8)


@query("epoch_loss", f"""WITH {_PRED_CTE},
e AS (SELECT * FROM p, (SELECT unnest([1, 2, 3]) AS epoch)),
b AS (SELECT epoch, pred, actual,
        CAST(floor((row_number() OVER (PARTITION BY epoch ORDER BY md5('7-' || CAST(epoch AS VARCHAR) || '-' || CAST(row_id AS VARCHAR))) - 1)
             / 1000) AS INTEGER) AS batch FROM e),
bl AS (SELECT epoch, batch, avg(abs(pred - actual)) AS l FROM b GROUP BY epoch, batch)
SELECT CAST(epoch AS INTEGER) AS epoch, {_r('avg(l)', 8)} AS epoch_loss FROM bl GROUP BY epoch""")
def q_epoch_loss(spark, d):
    from ..session import shared_path
    path = shared_path(spark, "predictions")        # the join runs once, not in every epoch's passes
    H.predictions_fixture(spark, d).write.parquet(path)
    p = spark.read.parquet(path)
    n = p.count()
    parts = []
    for ep in (1, 2, 3):
        b = R.epoch_shuffle(p, "row_id", seed=7, epoch=ep, batch_size=1000, n=n)
        parts.append(b.withColumn("epoch", F.lit(ep)))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    out = M.epoch_loss(u, "pred", "actual", epoch="epoch")
    return out.select(F.col("epoch").cast("int").alias("epoch"), rnd("epoch_loss", 8).alias("epoch_loss"))


def _register_all():
    # importing the other catalogues registers their queries
    from . import catalog_io, catalog_model  # noqa: F401
