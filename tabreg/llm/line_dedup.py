"""Line dedup, on DataFrame functions alone.

A text is split at line feeds. A line's key is the line with white space
(``[\\x20\\x09-\\x0D]``) stripped at both ends and A-Z lower-cased. A key of at least
``min_chars`` code points that ``min_docs`` documents or more hold is dropped, with
all its lines in every document; the other lines stay, joined by line feeds.

1. Lines are exploded and hashed (128 bits); (hash, document) pairs are made
   distinct, then counted for each hash. Both steps combine on the map side, and the
   first is dealt by hash and document, so one line in a third of all documents is
   spread over all tasks.
2. Lines are exploded with their places and joined with the dropped hashes; only
   the hits go on, as one array of places for each text.
3. Documents are joined with their places, by a shuffle of each text once at every
   size, and reassembled. Copies of one document share a key; adaptive execution
   splits such a hot key of the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_rows, write_table

SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEW_KEYS = 500_000        # dropped hashes broadcast: 16 bytes each


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keys(text: Column) -> Column:
    # lower() is faster and equal where all characters are ASCII
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.transform(_lines(low), lambda x: F.btrim(x, F.lit(SPACES)))


def _hashes(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def dropped_keys(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(h1, h2) of the keys that ``min_docs`` documents or more hold."""
    keys = docs.select("doc_id", F.explode(_keys(F.coalesce("text", F.lit("")))).alias("key")).filter(F.length("key") >= min_chars)
    return keys.select("doc_id", *_hashes("key")).distinct().groupBy("h1", "h2").agg(F.count("*").alias("n")) \
        .filter(F.col("n") >= min_docs).select("h1", "h2")


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) for every row of ``docs`` (doc_id, text).

    Null or empty text is one empty line; a key shorter than ``min_chars`` is never
    dropped. A document is a doc_id: rows that share one, or have none, count once
    for a line, and each row keeps its own result. A line that occurs several times
    in one document counts once. An empty table gives an empty table. Extra columns
    are ignored, whatever their names.
    """
    docs = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    gone = write_table(dropped_keys(docs, min_docs, min_chars), "common-lines")
    gone = F.broadcast(gone) if few_rows(gone, FEW_KEYS) else gone
    # a text's own hash stands for the row: equal texts of one document have equal places
    docs = docs.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})
    lines = docs.select("doc_id", "t1", "t2", F.posexplode(_keys(F.col("text"))).alias("at", "key")).filter(F.length("key") >= min_chars)
    hits = lines.select("doc_id", "t1", "t2", "at", *_hashes("key")).join(gone, ["h1", "h2"], "left_semi")
    hits = write_table(hits.groupBy("doc_id", "t1", "t2").agg(F.collect_set("at").alias("places")), "places")
    h = hits.select(F.col("doc_id").alias("_d"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "places")
    out = docs.join(h, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2")), "left")
    n = F.size(_lines(F.col("text")))
    stay = F.array_except(F.sequence(F.lit(0), n - 1), "places")
    # the one-element array binds the lines once, not once for each place
    kept = F.transform(F.array(_lines(F.col("text"))), lambda lines: F.array_join(F.transform(stay, lambda i: lines[i]), "\n"))[0]
    return out.select("doc_id", n.cast("long").alias("n_lines"),
                      F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_dropped"),
                      F.when(F.col("places").isNull(), F.col("text")).otherwise(kept).alias("text"))
