"""Matrix operators over tables.

Tall tables stay distributed. A matrix that meets them is small by
construction: its row count equals the other side's *column* count (a schema
width), so it is collected once (with a checked bound) and shipped as
literals or a NumPy array. Products of a tall table with itself (XᵀX, XᵀG)
are per-partition NumPy partial sums reduced by a keyed aggregate over
(i, j): one row per partition and cell, never one row per pair of data rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

from .rows import row_index

# Largest dense matrix (cells) collected to be shipped with a job.
MAX_SMALL_CELLS = 4_000_000
# Above this many multiply-adds per row a projection goes through Arrow/NumPy.
NATIVE_TERMS = 256


def _x(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("double"), F.lit(0.0))


def _batch_matrix(batch: pa.RecordBatch, cols, array_col: str | None) -> np.ndarray:
    """Rows x features float64 matrix from an Arrow batch; nulls -> 0.0, a null
    array -> a row of zeros. Arrays of different lengths are an error."""
    if array_col is not None:
        arr = batch.column(batch.schema.get_field_index(array_col))
        n = len(arr)
        if n == 0:
            return np.zeros((0, 0))
        flat = arr.flatten().fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64)
        known = ~arr.is_null().to_numpy(zero_copy_only=False)
        widths = np.unique(pc.list_value_length(arr).drop_null().to_numpy(zero_copy_only=False))
        if len(widths) > 1:
            raise ValueError(f"arrays of column {array_col} have different lengths: {widths[:5].tolist()}")
        out = np.zeros((n, int(widths[0]) if len(widths) else 0))
        out[known] = flat.reshape(int(known.sum()), -1) if out.shape[1] else 0.0
        return out
    mats = []
    for c in cols:
        a = batch.column(batch.schema.get_field_index(c))
        mats.append(a.fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64))
    if not mats:
        return np.zeros((batch.num_rows, 0))
    return np.column_stack(mats)


def linear_transform(df: DataFrame, in_cols, W, b=None, *, prefix: str = "out_",
                     keep=(), method: str = "auto") -> DataFrame:
    """Y = X·W + b with columns ``<prefix>j``; W is (in, out). Nulls read 0.

    ``method='native'`` emits sums of ``col * literal`` (whole-stage codegen,
    no Python); ``'arrow'`` runs NumPy on Arrow batches with W broadcast;
    ``'auto'`` picks native for up to ``NATIVE_TERMS`` multiply-adds per row.
    """
    W = np.asarray(W, dtype=np.float64)
    in_cols = list(in_cols)
    if W.shape[0] != len(in_cols):
        raise ValueError(f"W has {W.shape[0]} rows for {len(in_cols)} input columns")
    bias = np.zeros(W.shape[1]) if b is None else np.asarray(b, dtype=np.float64).reshape(-1)
    if method == "auto":
        method = "native" if W.size <= NATIVE_TERMS else "arrow"
    if method == "native":
        outs = []
        for j in range(W.shape[1]):
            e = F.lit(float(bias[j]))
            for i, c in enumerate(in_cols):
                e = e + _x(c) * F.lit(float(W[i, j]))
            outs.append(e.alias(f"{prefix}{j}"))
        return df.select(*[F.col(k) for k in keep], *outs)
    ship_package(df.sparkSession)
    spark = df.sparkSession
    bw = spark.sparkContext.broadcast((W, bias))
    keep = list(keep)
    src = df.select(*[F.col(k) for k in keep], *[_x(c).alias(f"_in{i}") for i, c in enumerate(in_cols)])
    names = [f"_in{i}" for i in range(len(in_cols))]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name in keep]
                       + [f"`{prefix}{j}` double" for j in range(W.shape[1])])

    def fn(it):
        Wm, bv = bw.value
        for batch in it:
            X = _batch_matrix(batch, names, None)
            Y = X @ Wm + bv
            cols = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            cols += [pa.array(Y[:, j]) for j in range(Y.shape[1])]
            yield pa.RecordBatch.from_arrays(cols, names=keep + [f"{prefix}{j}" for j in range(Y.shape[1])])

    return src.mapInArrow(fn, schema)


def collect_small_matrix(df: DataFrame, cols, order_by) -> np.ndarray:
    """Collect a matrix whose size is bounded by schema widths, after checking
    the bound with a count (rows x cols <= MAX_SMALL_CELLS)."""
    cols = list(cols)
    n = df.count()
    if n * max(1, len(cols)) > MAX_SMALL_CELLS:
        raise ValueError(f"matrix of {n}x{len(cols)} is too large to ship with a job; block_matmul multiplies large matrices")
    rows = df.orderBy(order_by).select(*[_x(c).alias(c) for c in cols]).collect()
    return np.array([[r[c] for c in cols] for r in rows], dtype=np.float64).reshape(n, len(cols))


def matmul(a: DataFrame, a_cols, b: DataFrame, b_cols, b_order, *, keep=(),
           prefix: str = "col_") -> DataFrame:
    """C = A·B for a tall table A (columns ``a_cols``) and a table B with one
    row per A-column (ordered by ``b_order``): B is schema-width sized, so it
    is collected (bound checked) and applied as a linear transform."""
    Bm = collect_small_matrix(b, b_cols, b_order)
    if Bm.shape[0] != len(list(a_cols)):
        raise ValueError("B must have one row per column of A")
    return linear_transform(a, a_cols, Bm, None, prefix=prefix, keep=keep)


# Rows and columns of a tile of a block matrix: 512 KB of doubles.
TILE = 256


def to_tiles(coords: DataFrame, tile: int = TILE) -> DataFrame:
    """A matrix in coordinate form (i, j, value) as tiles (ti, tj, at, v): the cells of
    a tile by their place in it (row-major) and their values. Absent cells and null
    values are 0; a cell that occurs more than once counts with its sum; rows without
    i or j are left out. A tile is bounded, so is every group."""
    cells = coords.filter("i is not null and j is not null") \
        .select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), _x("value").alias("v")) \
        .groupBy("i", "j").agg(F.sum("v").alias("v"))
    spot = ((F.col("i") % tile) * tile + F.col("j") % tile).cast("int")
    cells = cells.select(F.floor(F.col("i") / tile).cast("long").alias("ti"), F.floor(F.col("j") / tile).cast("long").alias("tj"),
                         F.struct(spot.alias("at"), "v").alias("c"))
    return cells.groupBy("ti", "tj").agg(F.collect_list("c").alias("c")).select("ti", "tj", F.col("c.at").alias("at"), F.col("c.v").alias("v"))


def _dense(at: pa.Scalar, v: pa.Scalar, tile: int) -> np.ndarray:
    out = np.zeros(tile * tile)
    out[at.values.to_numpy()] = v.values.to_numpy()
    return out.reshape(tile, tile)


_PARTIAL = pa.schema([("ti", pa.int64()), ("tj", pa.int64()), ("part", pa.binary())])
_CELLS = pa.schema([("i", pa.int64()), ("j", pa.int64()), ("value", pa.float64())])


def block_matmul(a: DataFrame, b: DataFrame, tile: int = TILE) -> DataFrame:
    """C = A·B for two matrices of any size in coordinate form (i, j, value); the cells of
    C that are not 0, as (i, j, value). Indices start at 0.

    Both become tiles; tiles that share an inner index are joined, each pair is one
    NumPy product, and the partial tiles of a cell of C are added as they stream by,
    sorted by tile. Nothing is collected and no pairs of cells are emitted: a tile
    meets as many others as the other matrix has tiles in a row or column. A hot inner
    index is split by the adaptive skew join."""
    ship_package(a.sparkSession)
    x = to_tiles(a, tile).select("ti", F.col("tj").alias("tk"), F.col("at").alias("at1"), F.col("v").alias("v1"))
    y = to_tiles(b, tile).select(F.col("ti").alias("tk"), "tj", F.col("at").alias("at2"), F.col("v").alias("v2"))

    def product(batches):
        for r in batches:
            for ti, tj, *cells in zip(*(r.column(c) for c in ("ti", "tj", "at1", "v1", "at2", "v2"))):
                c = _dense(cells[0], cells[1], tile) @ _dense(cells[2], cells[3], tile)
                yield pa.RecordBatch.from_arrays([pa.array([ti.as_py()]), pa.array([tj.as_py()]), pa.array([c.tobytes()], pa.binary())],
                                                 schema=_PARTIAL)

    def add(batches):
        here, acc = None, None

        def cells():
            at = np.flatnonzero(acc)
            return pa.RecordBatch.from_arrays([pa.array(here[0] * tile + at // tile), pa.array(here[1] * tile + at % tile),
                                               pa.array(acc[at])], schema=_CELLS)
        for r in batches:
            for ti, tj, part in zip(r.column(0).to_pylist(), r.column(1).to_pylist(), r.column(2)):
                v = np.frombuffer(part.as_buffer())
                if (ti, tj) != here:
                    if here is not None:
                        yield cells()
                    here, acc = (ti, tj), v.copy()
                else:
                    acc += v
        if here is not None:
            yield cells()

    parts = x.join(y, "tk").select("ti", "tj", "at1", "v1", "at2", "v2").mapInArrow(product, "ti long, tj long, part binary")
    parts = parts.repartition("ti", "tj").sortWithinPartitions("ti", "tj")
    return parts.mapInArrow(add, "i long, j long, value double")


def cross_product(df: DataFrame, left=None, right=None, *, left_array: str | None = None,
                  right_array: str | None = None, scale: float = 1.0) -> DataFrame:
    """Σ_rows left_iᵀ·right_j as a long table (i, j, value), times ``scale``.

    Each partition computes its dense partial with NumPy and emits one row per
    (i, j) cell; a keyed aggregate adds the partials. Work per row is
    O(d_left · d_right); shuffle volume is partitions x cells, independent of
    the row count."""
    lsel = [F.col(left_array).alias("_l")] if left_array else [_x(c).alias(f"_l{i}") for i, c in enumerate(left)]
    rsel = [F.col(right_array).alias("_r")] if right_array else [_x(c).alias(f"_r{i}") for i, c in enumerate(right)]
    src = df.select(*lsel, *rsel)
    lnames = None if left_array else [f"_l{i}" for i in range(len(left))]
    rnames = None if right_array else [f"_r{i}" for i in range(len(right))]
    la = "_l" if left_array else None
    ra = "_r" if right_array else None

    def fn(it):
        acc = None
        for batch in it:
            if batch.num_rows == 0:
                continue
            Lm = _batch_matrix(batch, lnames, la)
            Rm = _batch_matrix(batch, rnames, ra)
            p = Lm.T @ Rm
            acc = p if acc is None else acc + p
        if acc is None:
            return
        ii, jj = np.indices(acc.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ii.ravel().astype(np.int32)), pa.array(jj.ravel().astype(np.int32)),
             pa.array(acc.ravel())], names=["i", "j", "value"])

    ship_package(df.sparkSession)
    parts = src.mapInArrow(fn, "i int, j int, value double")
    return parts.groupBy("i", "j").agg((F.sum("value") * F.lit(scale)).alias("value"))


def gram(df: DataFrame, cols=None, *, array_col: str | None = None) -> DataFrame:
    """XᵀX (= matmul(transpose(X), X)) in coordinate form (i, j, value)."""
    if array_col:
        return cross_product(df, left_array=array_col, right_array=array_col)
    return cross_product(df, cols, cols)


def to_coordinates(df: DataFrame, order_by, cols=None, *, array_col: str | None = None) -> DataFrame:
    """(i = row position in ``order_by`` order, j = column index, value)."""
    idx = row_index(df, order_by, "_i")
    if array_col:
        return idx.select(F.col("_i").alias("i"),
                          F.posexplode(F.col(array_col)).alias("j", "value")).select(
            "i", F.col("j").cast("int").alias("j"), F.col("value").cast("double").alias("value"))
    arr = F.array(*[F.struct(F.lit(k).alias("j"), _x(c).alias("value")) for k, c in enumerate(cols)])
    return idx.select(F.col("_i").alias("i"), F.inline(arr)).select(
        "i", F.col("j").cast("int").alias("j"), "value")


def transpose(df: DataFrame, order_by, cols=None, *, array_col: str | None = None) -> DataFrame:
    """Transpose kept in coordinate form: a column per input row does not
    scale, so the output is (i = input column, j = input row position, value)."""
    co = to_coordinates(df, order_by, cols, array_col=array_col)
    return co.select(F.col("j").cast("long").alias("i"), F.col("i").alias("j"), "value")


def pivot_small(coo: DataFrame, n_cols: int, prefix: str = "col_") -> DataFrame:
    """Coordinate form back to wide rows when the width is known and narrow."""
    g = coo.groupBy("i").pivot("j", list(range(n_cols))).agg(F.first("value"))
    return g.select("i", *[F.col(str(j)).alias(f"{prefix}{j}") for j in range(n_cols)])


def weight_gradient(df: DataFrame, x_cols, g_cols, *, divide: bool = True) -> DataFrame:
    """Xᵀ·G (/ n when ``divide``), long form (i, j, value), one aggregate."""
    x_cols, g_cols = list(x_cols), list(g_cols)
    n = F.count(F.lit(1))
    aggs = []
    for i, xc in enumerate(x_cols):
        for j, gc in enumerate(g_cols):
            s = F.sum(_x(xc) * _x(gc))
            aggs.append((s / n if divide else s).alias(f"w_{i}_{j}"))
    one = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"w_{i}_{j}").alias("value"))
                    for i in range(len(x_cols)) for j in range(len(g_cols))])
    return one.select(F.inline(arr))


def bias_gradient(df: DataFrame, g_cols, *, divide: bool = True) -> DataFrame:
    """Σ_rows G_j (/ n), long form (j, value)."""
    g_cols = list(g_cols)
    aggs = [(F.avg(_x(c)) if divide else F.sum(_x(c))).alias(f"b_{j}") for j, c in enumerate(g_cols)]
    one = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"b_{j}").alias("value")) for j in range(len(g_cols))])
    return one.select(F.inline(arr))


def input_gradient(df: DataFrame, g_cols, W, in_names, *, keep=()) -> DataFrame:
    """G·Wᵀ with output columns named as the layer's inputs."""
    W = np.asarray(W, dtype=np.float64)
    out = linear_transform(df, g_cols, W.T, None, prefix="_ig", keep=keep)
    return out.select(*[F.col(k) for k in keep],
                      *[F.col(f"_ig{i}").alias(n) for i, n in enumerate(in_names)])
