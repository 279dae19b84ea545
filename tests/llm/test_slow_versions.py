"""Learners, encoders and digests against slow versions that share none of their code, and texts longer than a slice."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import pyarrow as pa

from spliceloom.llm import exact, lines, packing, pieces, quality, runs, secrets, words

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
M = (1 << 64) - 1


def mix(x):
    x = (x ^ x >> 33) * 0xFF51AFD7ED558CCD & M
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 & M
    return x ^ x >> 33


def test_updates_of_the_classifier():
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(60):
        idx = np.append(rng.choice(40, rng.integers(1, 9), replace=False), quality.SIZE)
        rows.append((idx, np.append(rng.random(len(idx) - 1), 1).astype(np.float32), int(rng.integers(2))))
    for l1 in (1e-4, 0.3):
        z, n, w, order = Counter(), Counter(), {}, np.random.default_rng(7)

        def weight(k, z=z, n=n, l1=l1):
            return 0.0 if abs(z[k]) <= l1 else -(z[k] - math.copysign(l1, z[k])) / ((1.0 + math.sqrt(n[k])) / 0.5 + 1e-3)

        for _ in range(4):
            for r in order.permutation(len(rows)):
                idx, x, y = rows[r]
                w = {k: weight(k) for k in idx.tolist()}
                p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in zip(idx.tolist(), x.tolist(), strict=True))))
                for k, v in zip(idx.tolist(), x.tolist(), strict=True):
                    g = (p - y) * v
                    z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / 0.5 * w[k]
                    n[k] += g * g
        model = quality.fit(rows, l1=l1)
        assert np.allclose(model.weights[:40], [weight(k) for k in range(40)], atol=1e-5) and abs(model.bias - weight(quality.SIZE)) < 1e-5
        assert not model.weights[40:].any()


def slow_score(text, model):
    raw = text.encode()
    found = list(re.finditer(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", raw))
    base, shapes, before = [], [], None
    for m in found:
        low = re.sub(rb"[A-Z]", lambda c: c[0].lower(), m[0])
        h = int(words.span_hashes(np.frombuffer(low, np.uint8), np.array([0]), np.array([len(low)]))[0])
        upper = sum(65 <= c <= 90 for c in m[0])
        mark = not re.match(rb"[0-9A-Za-z\x80-\xff]", m[0])
        shape = h if mark else (0 if not upper else 2 if upper * 2 > len(low) else 1) * 8 + min(len(low), 7)
        base.append(h)
        shapes.append(mix(shape + (977 if h == before else 0) & M))
        before = h
    total = 0.0
    for one in (base, shapes):
        gram = list(one)
        for k in (0, 1, 2):
            if k:
                gram = [mix(gram[i] * 31 + one[i + k] & M) for i in range(len(one) - k)]
            total += sum(float(model.weights[g & quality.SIZE - 1]) for g in gram)
    return 1 / (1 + math.exp(-(total / math.sqrt(max(len(found), 1)) / 8 + model.bias)))


def test_scores_of_the_classifier():
    model = quality.Model(np.random.default_rng(3).normal(size=quality.SIZE).astype(np.float32), -0.3)
    texts = ["", "one", "One ONE one, one!! two\n\n three é漢 ÉÀ 12ab --", "a b a b a b " * 40, "x" * 500, "!!! ??? ..", "The Cat. the CAT"]
    got = quality.scores(pa.array(texts, pa.large_string()), model)
    assert np.allclose(got, [slow_score(t, model) for t in texts], atol=1e-5)


def slow_dropout(text, model, vocabulary, dropout, seed, variants):
    """Ids by looking at all neighbours again after every merge."""
    if not text:
        return []
    hidden = (" " + text).replace("▁", "￹").replace(" ", "▁")
    key = mix(zlib.crc32(text.encode()) | (seed & 0xFFFFFFFF) << 32)
    limit, out, originals = int(dropout * 2.0**64), [], iter(c for c in text if c in "▁￹")
    for nth, chunk in enumerate(re.findall("▁*[^▁\n￹]+|▁+|\n|￹", hidden)):
        if chunk == "￹":
            out += [model.piece_to_id(f"<0x{b:02X}>") for b in next(originals).encode()]
            continue
        variant = mix(key + nth & M) % variants
        symbols = [(i, c) for i, c in enumerate(chunk)]
        number = lambda s: vocabulary.get(s, model.get_piece_size() + ord(s) if len(s) == 1 else None)
        while True:
            best = None
            for k in range(len(symbols) - 1):
                (at, a), (_, b) = symbols[k], symbols[k + 1]
                if a in vocabulary and b in vocabulary and a + b in vocabulary:
                    place = mix(at + variant * 0xD1342543DE82EF95 + seed * 0x9E3779B97F4A7C15 & M)
                    if mix(place ^ (number(a) << 32 | number(b))) < limit:
                        continue
                    score = model.get_score(vocabulary[a + b])
                    if best is None or score > best[0]:
                        best = (score, k)
            if best is None:
                break
            k = best[1]
            symbols[k : k + 2] = [(symbols[k][0], symbols[k][1] + symbols[k + 1][1])]
        for _, s in symbols:
            out += [vocabulary[s]] if s in vocabulary else [model.piece_to_id(f"<0x{b:02X}>") for b in s.encode()]
    return out


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5])
def test_merge_dropout(dropout):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
    rng = random.Random(4)
    texts = ["", " ", "the the the the", "unbelievably naïve 漢字 🙂", "a▁b ￹c", "two  spaces\n\nlines\tand tabs", "x" * 120 + "the house " * 5]
    texts += [" ".join(rng.choice(["house", "water,", "Interesting", "ations", "été", "1234", "the"]) for _ in range(30)) for _ in range(8)]
    codec = pieces.Codec(PIECES, dropout, 11, 4)
    for t, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == slow_dropout(t, model, vocabulary, dropout, 11, 4 if dropout else 1), t


def test_dropout_runs_no_agenda_that_skips_nothing(monkeypatch):
    looked, slot, codec = [], pieces.Codec._slot, pieces.Codec(PIECES, 0.1, 3)
    monkeypatch.setattr(pieces.Codec, "_slot", lambda self, keys, salt: looked.append(keys.size) or slot(self, keys, salt))
    rng = random.Random(5)
    some = ["house", "water", "nation", "people", "through", "little", "school", "number"]
    codec.encode([" ".join(rng.choice(some) for _ in range(6000))])
    own = sum(looked)
    looked.clear()
    for w in some:
        codec.in_step(["▁" + w] * codec.variants, list(range(codec.variants)))
    assert own < sum(looked) * 2 / 3


@pytest.mark.parametrize("limits", [{}, {"MOST": 5}, {"HELD": 200, "BLOCK": 3}])
def test_merge_dropout_over_batches(monkeypatch, limits):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocabulary = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
    for name, value in limits.items():
        monkeypatch.setattr(pieces, name, value)
    rng, codec = random.Random(8), pieces.Codec(PIECES, 0.2, 5)
    some = ["house", "water,", "Interesting", "internationalisation", "été🙂", "1234", "the", "a▁b", "￹", "\n", "漢" * 50 + "🙂the" * 20]
    for _ in range(6):
        texts = [" ".join(rng.choice(some) for _ in range(rng.randrange(25))) for _ in range(3)]
        for t, ids in zip(texts * 2, codec.encode(texts) + codec.encode(texts), strict=True):
            assert ids.dtype == np.dtype("<i4") and ids.tolist() == slow_dropout(t, model, vocabulary, 0.2, 5, 256), t


def test_digest_of_texts_with_secrets(spark):
    rng = random.Random(9)
    parts = ["password: hunter22", "PassWD='abc'", "api_key = Ab12.cd-34", "Token=x", "secret:\"zzzzzz==\"", "AKIA" + "ABCDEFGH12345678", "AKIA" + "AB", "deadbeef" * 4, "deadbeef" * 2, "DEADBEEF" * 4, "éé", "plain words here", "sk_" + "aZ9bY8cX7dW6eV5fU4gT3hS2", "\n"]
    texts = [None, ""] + [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(80)]
    got = {r.doc_id: r for r in secrets.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    kinds = ["assign", "access", "hex"]
    total = Counter()
    for i, t in enumerate(texts):
        t = t or ""
        found = [(m.start(), 0, m.end()) for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        found.sort()
        text = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == n for _, k, _ in found) for n in range(3))
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        own = got[i].spans.split(",") if got[i].spans else []
        assert [s for s in own if not s.startswith("entropy")] == (text.split(",") if text else [])
        total.update(k for _, k, _ in found)
    assert min(total[k] for k in range(3)) > 20 and sum(r.n_entropy for r in got.values()) > 0


def test_texts_longer_than_a_slice(spark):
    rng = random.Random(1)
    long = "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(9)) for _ in range(50_000)) + "\nshared line"
    texts = [long, "shared line\nb", long.replace("\n", " "), "shared line"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert len(long) > 3 << 20
    by = lambda x: {r.doc_id: r for r in x.collect()}
    groups = by(exact.exact_groups(df))
    assert [groups[i].keep_id for i in range(4)] == [0, 1, 0, 3] and groups[0].group_size == 2
    cut = by(lines.line_digest(df, 3))
    assert (cut[0].n_lines, cut[0].n_dropped, cut[0].kept_sha256) == (50_001, 1, hashlib.sha256(long[: -len("\nshared line")].encode()).hexdigest())
    twice = spark.createDataFrame([(0, long + " " + long)], "doc_id long, text string")
    n = 450_002
    assert [tuple(x) for x in runs.find_runs(twice).first().runs] == [(0, 2 * n, n)]
    packed = packing.pack_documents(df.filter("doc_id = 0"), BYTES, 0, with_ids=False).collect()
    assert sum(r.length for r in packed) == packed[0].doc_tokens and sorted(r.start for r in packed)[1] == 1024
    assert secrets.digest(df.filter("doc_id = 0")).first().n_hex == 0
