import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from tabreg.llm import bpe, queries

RANKS = queries.RANKS

TEXTS = ["", None, "Hello world", "it's  'll 12ab\n\n x\t\ty  ", "日本語 テスト é́ \U0001F600", "a" * 5000, "ab 12 " * 40000,
         " " * 3000 + "x", "   z\x1c \x85end", "<|endoftext|> is text", "x\n" * 2000, "Ça   va ?!  ...", "word," * 20000]


def reference():
    return bpe.encoder(bpe.read_ranks(RANKS))


def test_pieces_do_not_change_ids():
    enc = reference()
    for t in TEXTS:
        if not t:
            continue
        whole = enc.encode_ordinary(t)
        for size in (1, 7, 100):
            parts = list(bpe.pieces(t, size)) if len(t) < 20000 else [t]
            assert "".join(parts) == t
            assert [i for p in parts for i in enc.encode_ordinary(p)] == whole


def test_round_trip_and_ids(docs_of):
    docs = docs_of(list(enumerate(TEXTS)) + [(0, "again"), (None, "no id")])
    got = bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()
    assert len(got) == len(TEXTS) + 2
    enc = reference()
    want = sorted([(str(i), (t or "").encode()) for i, t in enumerate(TEXTS)] + [("0", b"again"), ("None", b"no id")])
    assert sorted((str(r["doc_id"]), bytes(r["decoded"])) for r in got) == want
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == enc.encode_ordinary(bytes(r["decoded"]).decode())


def test_empty_table_and_null_ids(spark, docs_of):
    assert bpe.encode(docs_of([]), RANKS).count() == 0
    row = bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), RANKS).first()
    assert row["decoded"] is None


def test_query_against_library(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.QUERIES["op2_byte_bpe"](spark, sf).collect()}
    ranks = bpe.read_ranks(RANKS)
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.encoder(ranks)._mergeable_ranks)
    for d in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = enc.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def own_matches(text):
    """The ids of the pattern's own matches, each encoded as one piece."""
    import regex
    one = bpe.encoder(bpe.read_ranks(RANKS), bpe._WHOLE)
    return [i for m in regex.finditer(public_tokenizers.PATTERN, text) for i in one.encode_ordinary(m.group())]


def test_long_white_space(docs_of):
    enc, one = reference(), bpe.encoder(bpe.read_ranks(RANKS), bpe._WHOLE)
    got = lambda t: np.frombuffer(bpe.encode_text(enc, one, t), "<u4").tolist()
    big = bpe.LONG_SPACE
    for space in (" ", "\n", "\t", " \n", "\x85", "\x1c", "　"):                 # \x1c is no white space here
        for t in (space * big, "a" + space * big, space * big + "b", "a1" + space * (big - 1) + "!x", f"a{space * big}b {space * big}c"):
            assert got(t) == enc.encode_ordinary(t)
    for t in (" " * 2_000_000 + "x", "x" + "\n" * 2_000_000, "a " + " \n\t" * 700_000 + " b" + "\n" * 1_000_000 + "7"):
        assert got(t) == own_matches(t)
    out = bpe.decode(bpe.encode(docs_of([(1, " " * 2_000_000 + "x")]), RANKS), RANKS).first()
    assert bytes(out["decoded"]) == b" " * 2_000_000 + b"x"
