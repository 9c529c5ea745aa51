"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is read once on the driver (a vocabulary: at most ``RANK_BYTES``)
and broadcast; each worker builds its encoder once. Token ids travel as packed
little-endian unsigned 32-bit integers, the form a training shard holds.

Long texts are split at safe boundaries before encoding: between a letter or a
digit and a following ASCII space or line feed. No alternative of the pre-split
pattern matches a non-space followed by white space, and its only look-ahead is
inside white space, so a cut there never changes a match. A very long run of white
space, on which the library's look-ahead gives up, is cut out first as the match that
the pattern makes of it: all of it at the end of a text, else all but its last
character.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, map_batches

RANK_BYTES = 64 << 20
PIECE_CHARS = 1 << 16      # a text is cut at the first safe boundary after so many characters
LONG_SPACE = 10_000        # white space of so many characters is cut out as a match of its own
OUT_BYTES = 8 << 20        # packed ids or bytes in one output batch

_SAFE = regex.compile(r"(?<=[\p{L}\p{N}])(?=[ \n])")
_SPACE = regex.compile(r"\p{White_Space}{%d,}+" % LONG_SPACE)
_WHOLE = r"[\s\S]+"        # a pattern that takes a text as one match
_ENCODERS: dict[str, tiktoken.Encoding] = {}


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(RANK_BYTES + 1)
    if len(raw) > RANK_BYTES:
        raise ValueError(f"{path} is larger than {RANK_BYTES} bytes: not a rank file")
    return raw


def encoder(raw: bytes, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    key = hashlib.md5(raw + pattern.encode()).hexdigest()
    if key not in _ENCODERS:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}
        _ENCODERS[key] = tiktoken.Encoding(key, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def pieces(text: str, size: int = PIECE_CHARS):
    """Consecutive parts of a text, cut at safe boundaries only."""
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def parts(text: str):
    """(part of a text, whether it is one match): long runs of white space, and what lies between."""
    at = 0
    if len(text) >= LONG_SPACE:
        for m in _SPACE.finditer(text):
            stop = m.end() if m.end() == len(text) else m.end() - 1
            yield from ((p, False) for p in pieces(text[at:m.start()]))
            yield text[m.start():stop], True
            at = stop
    yield from ((p, False) for p in pieces(text[at:]))


def encode_text(enc: tiktoken.Encoding, one: tiktoken.Encoding, text: str) -> bytes:
    """Packed ids of a whole text; ``one`` has the same ranks and takes a text as one match."""
    return b"".join(np.array((one if whole else enc).encode_ordinary(p), "<u4").tobytes() for p, whole in parts(text))


def _flushed(rows, schema, weigh):
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += weigh(r)
        if size > OUT_BYTES:
            yield batch(schema, *zip(*held))
            held, size = [], 0
    if held:
        yield batch(schema, *zip(*held))


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
_BYTES = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def _encode(batches, raw):
    enc, one = encoder(raw.value), encoder(raw.value, _WHOLE)

    def rows():
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                yield doc, encode_text(enc, one, text.as_py() or "")
    yield from _flushed(rows(), _IDS, lambda r: len(r[1]))


def _decode(batches, raw):
    enc = encoder(raw.value)

    def rows():
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1)):
                ids = ids.as_py()
                yield doc, ids, None if ids is None else enc.decode_bytes(np.frombuffer(ids, "<u4").tolist())
    yield from _flushed(rows(), _BYTES, lambda r: len(r[1] or b"") + len(r[2] or b""))


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids binary) of every row's whole text by the rank file ``ranks``.

    Null and empty texts have no ids (an empty binary). Rows with a null or a
    repeated doc_id stay; extra columns are left out; an empty table stays empty.
    """
    raw = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(src, lambda it: _encode(it, raw), "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids, decoded binary): the raw bytes of packed ids. Null ids give
    null bytes; an id that the rank file lacks is an error."""
    raw = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    return map_batches(encoded.select("doc_id", "ids"), lambda it: _decode(it, raw),
                       "doc_id long, ids binary, decoded binary")


def n_tokens(ids="ids"):
    return (F.octet_length(ids) / 4).cast("long")
