"""Line dedup, alignment of tokenizers and periodic runs against brute force, with nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from spliceloom.llm import align, lines, runs

SCHEMA = "doc_id long, text string, kept string, row long, lines string"  # clashing names
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def table(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "c", 1, "l") for i, t in enumerate(texts)], SCHEMA).repartition(3)


def line_texts():
    rng = random.Random(2)
    shared = ["Shared Line", "other\x0b shared", "ÉCOLE x", "", "a"]
    out = [None, "", "\n", "\n\n", " \n\t", "only\r\nonly"]
    for i in range(40):
        own = [rng.choice(shared) if rng.random() < 0.5 else f"own {i} {j}" for j in range(rng.randrange(12))]
        out.append("\n".join(rng.choice(["", " ", "\t\r"]) + rng.choice([x, x.upper() if x.isascii() else x]) + rng.choice(["", " \x0c"]) for x in own))
    return [*out, "\n".join(["Shared line"] * 5000 + ["own"]), "école X\n" * 9, out[-1]]


def lines_by_hand(texts, min_docs, min_length=1):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip("\x20\x09\x0a\x0b\x0c\x0d"))
    held = defaultdict(set)
    for i, t in enumerate(texts):
        for x in (t or "").split("\n"):
            held[key(x)].add(i)
    gone = {k for k, d in held.items() if len(k) >= min_length and len(d) >= min_docs}
    out = {}
    for i, t in enumerate(texts):
        own = (t or "").split("\n")
        out[i] = (len(own), sum(key(x) in gone for x in own), "\n".join(x for x in own if key(x) not in gone))
    return out


@pytest.mark.parametrize(("min_docs", "min_length", "heavy"), [(10, 1, 1024), (10, 1, 2), (2, 4, 0), (3, 1, 1024)])
def test_lines(spark, monkeypatch, min_docs, min_length, heavy):
    monkeypatch.setattr(lines, "HEAVY", heavy)
    texts = line_texts()
    docs, want = table(spark, texts), lines_by_hand(texts, min_docs, min_length)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in lines.line_digest(docs, min_docs, min_length).collect()}
    assert got == {i: (n, d, sha(k)) for i, (n, d, k) in want.items()}
    kept = lines.drop_shared_lines(docs, min_docs, min_length)
    assert kept.columns == docs.columns
    assert {r.doc_id: (r.text, r.kept, r.row, r.lines) for r in kept.collect()} == {i: (want[i][2] if want[i][1] else t, "c", 1, "l") for i, t in enumerate(texts)}


def test_lines_count_documents_and_not_rows(spark):
    rows = [(1, "x\ny")] * 9 + [(2, "x"), (3, "x"), (None, "y"), (None, "y"), (None, "y\nz")]
    got = sorted((r.doc_id or 0, r.n_lines, r.n_dropped) for r in lines.line_digest(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect())
    assert got == sorted([(1, 2, 2)] * 9 + [(2, 1, 1), (3, 1, 1), (0, 1, 1), (0, 1, 1), (0, 2, 1)])
    empty = spark.createDataFrame([], SCHEMA)
    assert lines.line_digest(empty).count() == lines.drop_shared_lines(empty).count() == 0


def test_lines_equal_the_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    assert sorted(map(tuple, lines.line_digest(spark.read.parquet(path)).collect())) == sorted(con.sql(lines.SQL).fetchall())


def word_texts():
    rng = random.Random(3)
    out = [None, "", " \n", "a", "a " * 12, "a " * 11, "x y " * 6, "é\xa0é " * 20, "a b c d e f " * 2]
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(7)):
            unit = [rng.choice(["ab", "b", "c", "Ä"] + [f"w{k}" for k in range(rng.choice([1, 40]))]) for _ in range(rng.randrange(1, 30))]
            words += (unit * rng.randrange(1, 9))[: rng.randrange(1, 200)]
        out.append(rng.choice([" ", "\n", " \t "]).join(words))
    return [*out, "z " * 6000 + "q", " ".join(str(k % 2500) for k in range(6000)), out[-1]]


def runs_by_hand(words, shortest=12):
    n, found, w = len(words), {}, np.unique(words, return_inverse=True)[1]
    for q in range(1, n // 2 + 1):
        same = np.diff(np.concatenate([[0], (w[:-q] == w[q:]).astype(int), [0]]))
        for s, e in zip(np.flatnonzero(same == 1).tolist(), (np.flatnonzero(same == -1) + q).tolist(), strict=True):
            if e - s >= max(shortest, 2 * q):
                found.setdefault((s, e), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def changed(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@pytest.mark.parametrize("table_words", [4096, 32])
def test_runs(spark, monkeypatch, table_words):
    monkeypatch.setattr(runs, "PROBES", 7)
    texts = word_texts()
    docs = table(spark, texts, 100)
    if table_words < 4096:  # the way of long texts, in this process: workers see no patch
        monkeypatch.setattr(runs, "TABLE", table_words)
        runs._probes.cache_clear()
        for t in texts:
            words = (t or "").encode().split()
            seq = np.concatenate([[1 << 20], np.unique(words, return_inverse=True)[1].astype(np.int64) + 1 if words else [], [1 << 21]]).astype(np.int64)
            assert [(s - 1, e - s, q) for s, e, q in runs.find(seq, [(1, len(words))]).tolist()] == sorted(runs_by_hand(words), key=lambda r: (r[0], r[0] + r[1]))
        runs._probes.cache_clear()
        return
    plain = {r.doc_id: r for r in runs.find_runs(docs).collect()}
    digest = {r.doc_id: r for r in runs.run_digest(docs).collect()}
    assert len(plain) == len(digest) == len(texts) and sum(r.n_runs for r in digest.values()) > 50
    for i, t in enumerate(texts, 100):
        words = (t or "").encode().split()
        want = sorted(runs_by_hand(words), key=lambda r: (r[0], r[2]))
        assert [tuple(x) for x in plain[i].runs] == want
        words = changed(i, words)
        want = sorted(runs_by_hand(words), key=lambda r: (r[0], r[2]))
        gone = {k for s, n, q in want for k in range(s + q, s + n)}
        best = min(want, key=lambda r: (-r[1], r[0], r[2])) if want else (None, None, None)
        assert tuple(digest[i]) == (i, len(want), *best, 1000 * best[1] // best[2] if want else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in want)), sha(b" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_runs_of_odd_tables(spark):
    rows = spark.createDataFrame([(None, "a " * 20), (5, "a " * 20), (5, "a " * 20), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.collapsed, [tuple(x) for x in r.runs]) for r in runs.find_runs(rows).collect())
    assert got == sorted([(0, "a", [(0, 20, 1)]), (5, "a", [(0, 20, 1)]), (5, "a", [(0, 20, 1)]), (0, "", [])])
    assert sorted(r.n_runs for r in runs.run_digest(rows).filter("doc_id IS NULL").collect()) == [0, 1]
    assert runs.run_digest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert len(runs.find_runs(rows, 30).filter("size(runs) > 0").collect()) == 0


def test_extensions_equal_a_slow_version():
    rng = np.random.default_rng(4)
    for size, letters in ((1, 1), (40, 1), (400, 2), (3000, 3), (500, 70_000)):
        seq = rng.integers(1, letters + 1, size)
        seq[size // 3 : 2 * size // 3] = seq[: 2 * size // 3 - size // 3]
        i, j = rng.integers(0, size, (2, 2000))
        i, j = i[i != j], j[i != j]
        slow = [next((t for t in range(size) if max(x, y) + t >= size or seq[x + t] != seq[y + t]), size) for x, y in zip(i.tolist(), j.tolist(), strict=True)]
        assert runs.Extensions(seq)(i, j).tolist() == slow


def align_texts():
    rng = random.Random(6)
    words = ["the", "The", "house,", "unbelievable", "naïve", "漢字かな", "🙂", "x" * 90, "12345", "<s>", "<0x0A>", "<|endoftext|>", "don't", "\n", "", "\t", "a\x1cb", "\xa0", "￹"]
    out = [None, "", " ", "  ", "a▁b", "the", " the", "<|endoftext|>", "</s>", "\x00", "͸ ", "é"]
    out += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    return [*out, "word and house " * 3000, "abc" * 3000, out[-1]]


def aligned_by_hand(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    back = {c: b for b, c in enumerate(align.byte_alphabet())}
    split = []
    for t in texts:
        t = t or ""
        a, b = one.encode(" " + t, add_special_tokens=False).ids, two.encode(t)
        x = [bytes(back[c] for c in one.id_to_token(i)) for i in a]
        y = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        groups = []
        if t and b"".join(x) == b"".join(y) == (" " + t).encode():
            ga, gb, na, nb, j = [], [], 0, 0, 0
            for i, own in zip(a, x, strict=True):
                ga.append(i)
                na += len(own)
                while j < len(b) and nb < na:
                    gb.append(b[j])
                    nb += len(y[j])
                    j += 1
                if na == nb:
                    groups.append((ga, gb))
                    ga, gb = [], []
        split.append(groups)
    count = defaultdict(int)
    for groups in split:
        for p in {(x, y) for ga, gb in groups for x in ga for y in gb}:
            count[p] += 1
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for groups in split:
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), sha(text) if groups else ""))
    return out


@pytest.mark.parametrize("frequent", [1 << 18, 3])
def test_alignment(spark, monkeypatch, frequent):
    monkeypatch.setattr(align, "FREQUENT", frequent)
    texts = align_texts()
    got = {r.doc_id: tuple(r)[1:] for r in align.alignment_digest(table(spark, texts), A, B).collect()}
    want = aligned_by_hand(texts)
    assert len(got) == len(texts) and sum(w[0] > 0 for w in want) > 40
    for i, w in enumerate(want):
        assert got[i] == w, texts[i]


def test_alignment_of_odd_tables(spark):
    rows = spark.createDataFrame([(None, "the house"), (1, "the house"), (1, "the house"), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_links, r.count_sum) for r in align.alignment_digest(rows, A, B).collect())
    assert got == [(0, 2, 6), (1, 2, 6), (1, 2, 6), (2, 0, 0)]
    assert align.alignment_digest(spark.createDataFrame([], SCHEMA), A, B).count() == 0
    assert align.align_documents(rows, A, B).select(F.max(F.size("pairs"))).first()[0] == 2
