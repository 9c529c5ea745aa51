import re

import numpy as np

from tabreg.llm import decontaminate as D
from tabreg.llm import queries

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def brute(item, text):
    """Smallest edit distance between the item's words and any passage, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_edit_distance():
    rng = np.random.RandomState(0)
    for _ in range(200):
        a, b = rng.randint(0, 4, rng.randint(1, 9)), rng.randint(0, 4, rng.randint(0, 15))
        assert D.edit_distance(a, b)[0] == brute(a.tolist(), b.tolist())
    a, b = rng.randint(0, 9, (50, 6)), rng.randint(0, 9, (50, 11))
    got, end = D.distances(a, b)
    assert [(x, y) for x, y in zip(got.tolist(), end.tolist())] == [D.edit_distance(x, y) for x, y in zip(a, b)]
    assert all(D.absent(a, b) <= got)


def test_walks_fall_back_into_step():
    """Hamming distance of the embedding stays small for a small edit distance."""
    rng = np.random.RandomState(1)
    near, far = [], []
    for _ in range(200):
        a = rng.randint(0, 1 << 62, 40).astype(np.uint64)
        b = np.delete(a, rng.randint(5, 35))
        c = rng.randint(0, 1 << 62, 40).astype(np.uint64)
        x, y, z = (D.walk(s, 0, 1, 48)[0][:, 0] for s in (a, b, c))
        near.append((x != y).mean())
        far.append((x != z).mean())
    assert np.mean(near) < 0.45 < 0.95 < np.mean(far)


def vocabulary(rng, n):
    return ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n)]


def test_recall_and_exactness(spark, docs_of):
    rng = np.random.RandomState(2)
    vocab = vocabulary(rng, 500)
    prose = lambda n: list(rng.choice(vocab, n))
    items = {i: prose(rng.randint(15, 60)) for i in range(30)}
    docs, leaked = [], {}
    for k in range(160):
        text = prose(rng.randint(0, 200))
        if k % 2:
            i = int(rng.randint(30))
            copy = list(items[i])
            for _ in range(int(0.15 * len(copy) * rng.rand())):
                copy[rng.randint(len(copy))] = rng.choice(vocab)
            at = rng.randint(len(text) + 1)
            text[at:at] = copy
            leaked[k] = i
        docs.append((k, ", ".join(text) if k % 3 else "\n".join(text).upper()))
    bench = spark.createDataFrame([(i, " ".join(w), "x") for i, w in items.items()], "item_id long, text string, doc_id string")
    for block in (D.BLOCK, 300):
        got = {(r["doc_id"], r["item_id"]): r["edits"] for r in D.leaks(docs_of(docs), bench, block).collect()}
        for (k, i), edits in got.items():          # exact, and at the threshold at most
            assert edits == brute(items[i], words(docs[k][1])) <= D.EDITS * len(items[i])
        assert sum((k, i) in got for k, i in leaked.items()) >= 0.95 * len(leaked)
        assert {k for k, _ in got} <= set(leaked)


def test_edge_rows(spark, docs_of):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, None), (3, ""), (4, "..."), (5, "unicorn"),
                                   (1, "one two three four five six"), (None, "red green blue cyan black white")],
                                  "item_id long, text string")
    docs = docs_of([(1, None), (2, ""), (3, "ALPHA beta, gamma delta epsilon zeta eta theta"), (4, "a Unicorn!"), (5, "x " * 50000),
                    (6, "zero one two three four five six seven"), (6, "nothing"), (None, "red green blue cyan black white"),
                    (8, "alpha beta gamma delta"), (9, "epsilon zeta eta theta"), (10, "uni corn")])
    got = sorted((str(r["doc_id"]), str(r["item_id"]), r["start_word"], r["edits"]) for r in D.leaks(docs, bench).collect())
    assert got == [("3", "1", 0, 0), ("4", "5", 1, 0), ("6", "1", 1, 0), ("None", "None", 0, 0)]
    assert D.leaks(docs_of([]), bench).count() == 0
    assert D.leaks(docs, bench.limit(0)).count() == 0


def test_query_finds_every_whole_item(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op4_decontaminate"](spark, sf).collect()}
    items = [(r["item_id"], " " + " ".join(words(r["text"])) + " ") for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    whole = set()
    for d in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        text = " " + " ".join(words(d["text"])) + " "
        whole |= {(d["doc_id"], i) for i, x in items if x in text}
    assert whole and whole <= got


def edited(rng, copy, n, vocab):
    """n edits: replaced, deleted and inserted words."""
    copy = list(copy)
    for at in sorted(rng.choice(len(copy), n, replace=False).tolist(), reverse=True):
        copy[at:at + 1] = [[f"new{rng.randint(10**6)}"], [], [copy[at], rng.choice(vocab)]][rng.choice(3, p=(0.8, 0.1, 0.1))]
    return copy


def copies(seed, lengths):
    """(items, texts, {(words, edits): ids}): text i holds item i with so many of its words edited."""
    rng = np.random.RandomState(seed)
    vocab = vocabulary(rng, 800)
    items, docs, leaked = [], [], {}
    for n, times in lengths:
        for edits in range(int(D.EDITS * n) + 1) if n < 60 else (int(0.1 * n), int(D.EDITS * n)):
            for k in range(times):
                i = len(items)
                items.append([f"i{i}w{j}" if n < 5 else w for j, w in enumerate(rng.choice(vocab, n))])
                text = edited(rng, items[i], edits, vocab)
                if k % 4:
                    text = [*rng.choice(vocab, rng.randint(30)), *text, *rng.choice(vocab, rng.randint(30))]
                docs.append((i, " ".join(text)))
                leaked.setdefault((n, edits), set()).add(i)
    return items, docs, leaked


def test_recall_by_length_and_edits(spark, docs_of):
    """Every copy of a short item is found, and 0.98 of the others at every length up to the full EDITS."""
    items, docs, leaked = copies(5, [(n, 20) for n in (1, 2, 4, 5, 8)] + [(n, 50) for n in (10, 15, 16, 20, 30)] + [(60, 20), (200, 20)])
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in D.leaks(docs_of(docs), bench).collect()}
    for (n, edits), ids in leaked.items():
        assert sum((i, i) in got for i in ids) >= (1 if n < D.SHORT else 0.98) * len(ids), (n, edits)
        assert all(got[i, i] == brute(items[i], words(docs[i][1])) <= edits for i in ids if (i, i) in got)
    assert all(len(items[i]) >= 5 or i == d for d, i in got)


def found(texts, items, short):
    import pyarrow as pa

    index = D.ItemIndex(list(range(len(items))), D.item_words([" ".join(w) for w in items]), short)
    out, at = {}, 0
    for n, best in D._found(pa.array(texts), index):
        out |= {(at + d, i): v for (d, i), v in best.items()}
        at += n
    return out


def test_walks_against_exact_pieces():
    """Pieces of all items miss nothing: the walks find 0.98 of it at the full EDITS, with the same edits."""
    for n in (10, 15, 20, 30, 60):
        items, docs, leaked = copies(n, [(n, 120 if n == 60 else 60)])
        own = sorted(leaked[n, int(D.EDITS * n)])
        texts = [docs[i][1] for i in own]
        exact, got = (found(texts, [items[i] for i in own], short) for short in (1 << 30, D.SHORT))
        assert len(exact) >= len(own) and set(got) <= set(exact)
        assert len(got) >= 0.98 * len(exact), n
        assert all(exact[k][0] == v[0] for k, v in got.items())


def test_common_runs_of_words():
    """Many items that share a run of words are proposed by each place of it and verified together."""
    items = [["which", "of", "the", "following", *(f"a{i}x{j}" for j in range(12))] for i in range(3000)]
    text = " ".join(["which of the following"] * 200 + items[7] + ["which of the following"] * 20)
    assert found([text, "which of the following", ""], items, D.SHORT) == {(0, 7): (0, 800)}


def test_repeated_words_and_ends():
    same, tail = ["so"] * 12, [f"w{i}" for i in range(12)]
    texts = ["so " * 11, "so " * 40, " ".join(tail[3:]), " ".join(tail[:10]), " ".join(tail[:9]), " ".join(tail[6:] + tail[:6])]
    assert {k: v[0] for k, v in found(texts, [same, tail], D.SHORT).items()} == {(0, 0): 1, (1, 0): 0, (3, 1): 2}
