"""N-gram Jaccard join by token-combination prefixes.

A document is the set of its distinct five-word shingles (fewer words: the whole
sequence as one shingle; no word: the empty set, linked with nothing). Two
documents link when ``100 * |A & B| >= 80 * |A | B|``.

Tokens (shingle hashes) have one global order: rare ones by hash, then frequent
ones by hash. Two sets of sizes n and m need ``ceil(4 (n + m) / 9)`` common
tokens, so at most ``t = n - ceil(4 (n + m) / 9)`` of the smaller prefix can be
missing in the other set. The prefix is extended until its signatures cannot all
be destroyed by t misses: a rare token is a signature by itself (one miss each);
frequent tokens fall into hash intervals and every pair inside an interval is a
signature, so an interval of g prefix tokens survives g - 2 misses and counts
g - 1. A signature carries ``kb``, the misses that the tokens before it absorb: it
belongs to the prefix for a partner of size m only if ``kb <= t``, that is
``m <= (5 n - 9 kb) / 4``. Interval widths follow the set size in steps of 5/4,
and a set emits the pairs of its own step and of the next one, where its partners
of up to 5/4 its size have theirs; so both sides of a link use the same intervals.

1. Equal sets are found by a 128-bit set hash and one aggregate. Later steps use
   one member for each task and set.
2. Frequent tokens: partial counts of each task (of tokens that it has twice or
   more), summed; frequent means ``max(HOT_MIN, tokens / HOT_SHARE)`` or more, so
   there are at most HOT_SHARE of them and the table is broadcast (16 MB).
3. Signatures are shuffled once; those of one document alone are dropped.
4. In each signature the document with the lowest kb leads; members are verified
   against their leaders, and components are formed: linear in the group.
5. Only pairs whose ends are still in different components are then formed and
   verified, so a large group of near copies never emits its pairs.

Verification compares the full sets. Sizes and a 256-bin histogram bound the
overlap from above first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as X
from .common import batch, drop_ids, keep_ids, map_batches, write_table
from .graph import components

SHINGLE = 5
HOT_MIN = 64              # a token of fewer documents is never frequent
HOT_SHARE = 2_000_000     # at most so many frequent tokens: those with tokens / HOT_SHARE documents or more
CHUNK_TOKENS = 2_000_000  # tokens whose partial counts a task holds at once

U = np.uint64
_SEP = X.separators(X.SPACES)

_SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())])
_COUNTS = pa.schema([("token", pa.int64()), ("n", pa.int64())])
_SIGS = pa.schema([("sig", pa.int64()), ("doc", pa.int64()), ("n", pa.int32()), ("kb", pa.int32()),
                   ("hot", pa.bool_())])
_HIST = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("hist", pa.binary())])
_FULL = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary())])


def _sets(batches, k: int):
    """(doc_id, set of shingle hashes) of every document."""
    for b in batches:
        ids = b.column(0).to_pylist()
        for lo, hi, offsets, data in X.slices(b.column(1)):
            w = X.Words(data, offsets, _SEP)
            for i in range(hi - lo):
                yield ids[lo + i], X.shingles(w.hash[w.first[i]:w.first[i + 1]], k)


def _key(s: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _describe(batches, k: int):
    rows = []
    for doc, s in _sets(batches, k):
        rows.append((doc, len(s), *_key(s)))
        if len(rows) >= 50_000:
            yield batch(_SETS, *zip(*rows))
            rows = []
    if rows:
        yield batch(_SETS, *zip(*rows))


def _unseen(batches, k: int):
    """The first document of each set that this task reads."""
    seen = set()
    for doc, s in _sets(batches, k):
        if len(s) and (key := _key(s)) not in seen:
            seen.add(key)
            yield doc, s


def _local_counts(batches, k: int):
    held, size = [], 0

    def flush():
        u, c = np.unique(np.concatenate(held), return_counts=True)
        u, c = u[c > 1], c[c > 1]
        for at in range(0, len(u), 100_000):
            yield batch(_COUNTS, u[at:at + 100_000].view(np.int64), c[at:at + 100_000])

    for _, s in _unseen(batches, k):
        held.append(s)
        size += len(s)
        if size >= CHUNK_TOKENS:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def _step(n: int) -> int:
    """Largest s with (5/4)^s <= n."""
    s = int(np.log(n) / np.log(1.25))
    while 1.25 ** (s + 1) <= n:
        s += 1
    while 1.25 ** s > n:
        s -= 1
    return s


def signatures(s: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, kb, frequent?) of one sorted set; ``hot`` marks its frequent tokens."""
    n = len(s)
    t = n // 5                                   # misses allowed with the smallest partner
    rare = s[~hot][:t + 1]
    sigs, kbs, marks = [rare], [np.arange(len(rare))], [np.zeros(len(rare), bool)]
    if len(rare) <= t and hot.any():
        freq, step = s[hot], _step(n)
        for level in (step, step + 1):
            size = 1.25 ** level
            width = 1 if size < 16 else int(np.ceil(size / 2))      # intervals; about two tokens of a set in each
            cell = ((freq >> U(32)) * U(width)) >> U(32)
            group, kb = -1, len(rare)
            members: list[int] = []
            for tok, c in zip(freq.tolist(), cell.tolist()):
                if kb > t:
                    break
                if c != group:
                    group, members = c, []
                if members:
                    pair = X.mix(X.mix(np.array(members, U) + U(level)) ^ U(tok))
                    sigs.append(pair)
                    kbs.append(np.full(len(pair), kb))
                    marks.append(np.ones(len(pair), bool))
                    kb += 1
                members.append(tok)
    return np.concatenate(sigs), np.concatenate(kbs), np.concatenate(marks)


def _emit(batches, k: int, hot_bytes):
    hot = np.frombuffer(hot_bytes.value, U)
    bits = np.zeros(1 << 20, bool)               # cheap test before the search
    bits[(hot >> U(44)).astype(np.int64)] = True
    held, size = [], 0

    def flush():
        return batch(_SIGS, np.concatenate([h[0] for h in held]).view(np.int64), np.repeat([h[1] for h in held], [len(h[0]) for h in held]),
                     np.repeat([h[2] for h in held], [len(h[0]) for h in held]), np.concatenate([h[3] for h in held]),
                     np.concatenate([h[4] for h in held]))

    for doc, s in _unseen(batches, k):
        if len(s) < 4:                           # can only link with an equal set
            continue
        mark = np.zeros(len(s), bool)
        if len(hot):
            maybe = np.flatnonzero(bits[(s >> U(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(hot, s[maybe]), len(hot) - 1)
            mark[maybe] = hot[at] == s[maybe]
        sig, kb, freq = signatures(s, mark)
        held.append((sig, doc, len(s), kb, freq))
        size += len(sig)
        if size >= 200_000:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _flushed(schema, rows, limit: int = 8 << 20):
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1])
        if size > limit:
            yield batch(schema, *zip(*held))
            held, size = [], 0
    if held:
        yield batch(schema, *zip(*held))


def _hist(batches, k: int):
    count = lambda s: np.minimum(np.bincount((s >> U(56)).astype(np.int64), minlength=256), 255).astype(np.uint8)
    yield from _flushed(_HIST, ((doc, len(s), count(s).tobytes()) for doc, s in _sets(batches, k)))


def _full(batches, k: int):
    yield from _flushed(_FULL, ((doc, len(s), s.tobytes()) for doc, s in _sets(batches, k)))


def _possible(batches):
    """Pairs whose histograms allow enough common tokens (a full bin bounds nothing)."""
    for b in batches:
        if not len(b):
            continue
        ha, hb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, 256) for c in ("ha", "hb"))
        both = np.minimum(ha, hb)
        common = both.sum(axis=1, dtype=np.int64)
        total = b.column("na").to_numpy() + b.column("nb").to_numpy()
        ok = (9 * common >= 4 * total) | (both == 255).any(axis=1)
        yield b.select(["a", "b"]).filter(pa.array(ok))


def _linked(batches):
    for b in batches:
        keep = []
        for x, y in zip(b.column("ta"), b.column("tb")):
            s, t = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
            common = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(100 * common >= 80 * (len(s) + len(t) - common))
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verify(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) of documents that link: by histograms of all documents on a
    pair, then by the full sets of those on a pair that is still possible."""
    for fill, col, out, test in ((_hist, "hist", "h", _possible), (_full, "tokens", "t", _linked)):
        ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
        known = write_table(map_batches(keep_ids(texts, ends, "doc_id"), lambda it, f=fill: f(it, k),
                                        f"doc long, n long, {col} binary"), col)
        for end in ("a", "b"):
            pairs = pairs.join(known.select(F.col("doc").alias(end), F.col("n").alias("n" + end), F.col(col).alias(out + end)), end)
        pairs = write_table(map_batches(pairs.select("a", "b", "na", "nb", out + "a", out + "b"), test, "a long, b long"), "pairs")
    return pairs


def _reach(n, kb):
    """Largest partner size for which the signature belongs to the prefix."""
    return F.floor((5 * n - 9 * kb) / 4)


def link_components(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    Null or empty text, or text without words: 0 shingles, its own component.
    A row with a null doc_id keeps its row, with a null component. Repeated doc_ids
    are one node; each row stays. Extra columns are ignored. An empty table gives
    an empty table. Ties in size and order do not matter: links are exact.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.filter("doc_id is not null")
    sets = write_table(map_batches(texts, lambda it: _describe(it, k), "doc_id long, n_shingles long, k1 long, k2 long"),
                       "setkeys")
    same = sets.filter("n_shingles > 0 and doc_id is not null")
    rep = same.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("_c")).filter("_c > 1")
    rep = write_table(rep.drop("_c"), "classes")       # its join can then be split where a class is hot

    counts = map_batches(known, lambda it: _local_counts(it, k), "token long, n long")
    tokens = same.agg(F.sum("n_shingles")).first()[0] or 0
    hot = counts.groupBy("token").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= max(HOT_MIN, -(-tokens // HOT_SHARE))).select("token")
    hot = np.sort(hot.toPandas()["token"].to_numpy(np.int64).view(U))     # HOT_SHARE entries at most
    hot_bytes = spark.sparkContext.broadcast(hot.tobytes())
    sigs = map_batches(known, lambda it: _emit(it, k, hot_bytes), "sig long, doc long, n int, kb int, hot boolean")

    # rare signatures: a group is bounded by the frequency classes, so a window finds
    # its size and leader; frequent pairs may be hot: partial sums, joined back
    own = F.struct("kb", "doc", "n")
    one = Window.partitionBy("sig")
    rare = sigs.filter("not hot").withColumn("size", F.count("*").over(one)).withColumn("l", F.min(own).over(one))
    runs = write_table(rare.filter("size > 1").drop("hot"), "rare")
    if len(hot):
        freq = write_table(sigs.filter("hot").drop("hot"), "frequent")
        lead = freq.groupBy("sig").agg(F.count("*").alias("size"), F.min(own).alias("l")).filter("size > 1")
        runs = runs.unionByName(write_table(freq.join(lead, "sig"), "frequent-runs"))

    near = runs.filter(F.col("doc") != F.col("l.doc")) \
        .filter((F.col("l.n") <= _reach(F.col("n"), F.col("kb"))) & (F.col("n") <= _reach(F.col("l.n"), F.col("l.kb"))))
    stars = write_table(near.select(F.col("doc").alias("a"), F.col("l.doc").alias("b")).distinct(), "stars")
    links = verify(stars, known, k)
    # equal sets of different tasks and documents
    classes = same.join(rep, ["k1", "k2", "n_shingles"]).filter("doc_id <> rep") \
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    first = write_table(links.unionByName(classes), "links")
    comp = components(first)

    # what is left: pairs of one signature of three or more, in different components
    named = runs.filter("size > 2").select("sig", "doc", "n", "kb") \
        .join(comp.select(F.col("id").alias("doc"), F.col("component").alias("c")), "doc", "left") \
        .withColumn("c", F.coalesce("c", "doc"))
    named = write_table(named, "named")
    span = named.groupBy("sig").agg(F.min("n").alias("lo"), F.max(_reach(F.col("n"), F.col("kb"))).alias("hi"),
                                    F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1").drop("c0", "c1")
    open_ = named.join(span, "sig").filter((F.col("lo") <= _reach(F.col("n"), F.col("kb"))) & (F.col("n") <= F.col("hi")))
    open_ = write_table(open_.select("sig", "doc", "n", "kb", "c"), "open")
    two = open_.groupBy("sig").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1").select("sig")
    x = open_.join(two, "sig", "left_semi").select("sig", *[F.col(c).alias(c + "1") for c in ("doc", "n", "kb", "c")])
    y = open_.select("sig", *[F.col(c).alias(c + "2") for c in ("doc", "n", "kb", "c")])
    left = x.join(y, "sig").filter((F.col("doc1") < F.col("doc2")) & (F.col("c1") != F.col("c2"))
                                   & (F.col("n2") <= _reach(F.col("n1"), F.col("kb1")))
                                   & (F.col("n1") <= _reach(F.col("n2"), F.col("kb2"))))
    left = left.select(F.col("doc1").alias("a"), F.col("doc2").alias("b")).distinct()
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = write_table(left.join(tried, ["a", "b"], "left_anti"), "left")
    if not left.isEmpty():
        more = verify(left, known, k)
        if not more.isEmpty():
            comp = components(first.unionByName(more))
    return sets.select("doc_id", "n_shingles").join(comp.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left") \
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group, with all their
    columns. Rows that share a doc_id are one document, of which the first row by
    text stays; rows with a null doc_id have no group and stay."""
    comp = link_components(docs, k)
    gone = comp.filter("doc_id <> component_id").select("doc_id")
    kept = drop_ids(docs, gone, "doc_id")
    again = write_table(docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id"), "repeated")
    if again.isEmpty():
        return kept
    # the other columns order rows of one text, but for maps and variants, which have no order
    plain = [c for c, t in docs.dtypes if c not in ("doc_id", "text") and "map<" not in t and "variant" not in t]
    row = "_row"
    while row in docs.columns:
        row += "_"
    first = Window.partitionBy("doc_id").orderBy("text", *plain)
    some = keep_ids(kept, again, "doc_id").withColumn(row, F.row_number().over(first)).filter(F.col(row) == 1).drop(row)
    return drop_ids(kept, again, "doc_id").unionByName(some.select(*docs.columns))
