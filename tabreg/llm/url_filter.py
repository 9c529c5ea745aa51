"""URL filters as a sorted sweep over reversed-host intervals.

A host's canonical key is its labels in reverse order, each followed by a dot
(``blog.example.net``: ``net.example.blog.``). The hosts that a rule covers, its
own host and all subdomains, are exactly the keys that begin with the rule's key:
one interval of the byte order. Two such intervals are nested or disjoint, so a
sweep over sorted keys needs only a stack: rules whose interval begins are
pushed, those whose interval ended are popped, and the stack then holds the
rules that cover the current host. Among those, the longest whose path begins
the url's path decides (longer host first, then longer path).

Each partition sorts its own urls and sweeps them against the sorted rules, so
the urls are never shuffled and no host can be hot. Rules are broadcast in
blocks of at most ``BLOCK`` rows; with several blocks, each one sweeps all urls
and the longest hit is kept by an aggregate on the row's number.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, map_batches

BLOCK = 200_000          # rules in one broadcast
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OUT = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
                  ("verdict", pa.string()), ("length", pa.int64()), ("row", pa.int64())])


def host(url):
    """After the first ``://`` up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(h):
    """Reversed labels, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(h, r"\.")), "."), F.lit("."))


def canonical(name: str) -> bytes:
    return (".".join(reversed(name.split("."))) + ".").encode()


def _sweep(batches, rules, default):
    """Rows come sorted by key; ``rules`` are (key, path, verdict, text) sorted by key."""
    stack: list[list] = []       # [key, its rules], each key a beginning of the next one
    nxt = 0
    for b in batches:
        out = []
        for page, name, key, p, row in zip(*(b.column(i).to_pylist() for i in range(5))):
            k = key.encode()
            while nxt < len(rules) and rules[nxt][0] <= k:
                own = rules[nxt][0]
                while stack and not own.startswith(stack[-1][0]):
                    stack.pop()
                if not stack or stack[-1][0] != own:
                    stack.append([own, []])
                stack[-1][1].append(rules[nxt])
                nxt += 1
            while stack and not k.startswith(stack[-1][0]):
                stack.pop()
            hit = None
            for _, at in reversed(stack):
                fit = [r for r in at if p.startswith(r[1])]
                if fit:
                    hit = max(fit, key=lambda r: (len(r[1]), r[2] == "block"))
                    break
            out.append((page, name, p, hit and hit[3], hit[2] if hit else default,
                        (len(hit[0]) << 32 | len(hit[1]) << 1 | (hit[2] == "block")) if hit else -1, row))
        if out:
            yield batch(_OUT, *zip(*out))


def judge(pages: DataFrame, rules, default: str = "allow", block: int = BLOCK) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row's url.

    ``rules``: rows (host, path, verdict), a list or a DataFrame of these columns;
    rows with a null are ignored, repeated ones count once, and of two verdicts for
    one host and path block wins. A url without a fitting rule gets ``default`` and
    a null rule. Null urls and urls without ``://`` have an empty host and path.
    Rows with a null or repeated page_id stay; extra columns are left out.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").dropna().distinct() \
        .orderBy("host", "path", "verdict")
    url = F.col("url").cast("string")
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), host(url).alias("host"), path(url).alias("path"))
    src = src.select("page_id", "host", host_key(F.col("host")).alias("key"), "path", F.monotonically_increasing_id().alias("row")) \
        .sortWithinPartitions("key")
    parts, held = [], []

    def sweep(rows):
        table = spark.sparkContext.broadcast(sorted((canonical(h), p, v, h + p) for h, p, v in rows))
        return map_batches(src, lambda it: _sweep(it, table.value, default),
                           "page_id long, host string, path string, rule string, verdict string, length long, row long")

    for r in rules.toLocalIterator():            # a block at a time
        held.append((r["host"], r["path"], r["verdict"]))
        if len(held) == block:
            parts.append(sweep(held))
            held = []
    if held or not parts:
        parts.append(sweep(held))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if len(parts) > 1:
        out = out.groupBy("row").agg(*[F.max_by(c, "length").alias(c) for c in ("page_id", "host", "path", "rule", "verdict")])
    return out.select("page_id", "host", "path", "rule", "verdict")
