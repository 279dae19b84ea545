"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every letter-only piece of a fixed public vocabulary. The probability of a word is
the sum over all its segmentations into pieces (forward algorithm); a text's log-probability is the sum over its words.
Expected piece counts for the fit come from the same lattice run forwards and backwards. A text without a letter, or
null, is `und` with score 0. Ties take the first language in order. Words of any length are summed whole (the sums are
scaled every 16 letters); only the fit cuts words, every FIT_LETTERS letters. Rows are scored alone, repeated ones each;
extra columns pass through; without training rows all is `und`, and an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, sampled, slices

#: The fit (not the scoring) reads words in parts of so many letters at most.
FIT_LETTERS = 40
#: Training reads about so many documents of each language, picked by a hash of the id.
DOCS_A_LANGUAGE = 400
_WORD = re.compile(r"[^\W\d_]+")
_FLOOR = 1e-7


class Model(NamedTuple):
    languages: list[str]
    keys: np.ndarray  # sorted hashes of the pieces
    probs: np.ndarray  # pieces + 1, languages; the last row is the floor for single letters outside the vocabulary
    longest: int  # letters of the longest piece


def vocabulary(path: str) -> list[str]:
    """Letter-only lower-case pieces of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i).replace("▁", "") for i in range(model.get_piece_size()))
    return sorted({p for p in pieces if p.isalpha() and p == p.lower()})


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, padded with 0, and their lengths."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.zeros((len(words), int(length.max(initial=0))), np.uint64)
    codes[np.arange(codes.shape[1]) < length[:, None]] = flat
    return codes, length


_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _add_letter(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    x = (h ^ code) * _PRIME
    return x ^ x >> np.uint64(29)


def piece_keys(pieces: list[str]) -> np.ndarray:
    """Sorted hashes; equal lengths are hashed together."""
    out = [np.zeros(0, np.uint64)]
    for k in range(1, 1 + max(map(len, pieces), default=0)):
        if group := [p for p in pieces if len(p) == k]:
            codes, _ = _codes(group)
            h = np.zeros(len(group), np.uint64)
            for i in range(k):
                h = _add_letter(h, codes[:, i])
            out.append(h)
    return np.sort(np.concatenate(out))


def pieces_from(codes: np.ndarray, start: int, keys: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(length, number of the piece of that length at `start` of each word, -1 for none); a single letter always has one (the floor's number if unknown)."""
    h = np.zeros(len(codes), np.uint64)
    for k in range(1, 1 + min(longest, codes.shape[1] - start)):
        h = _add_letter(h, codes[:, start + k - 1])
        i = np.full(len(h), -1)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            i = np.where(keys[at] == h, at, -1)
        yield k, np.where(i < 0, len(keys), i) if k == 1 else i


def word_logs(words: list[str], model: Model) -> np.ndarray:
    """Log-probabilities of words, shape (words, languages); words of about one length share the work."""
    out = np.zeros((len(words), len(model.languages)))
    length = np.fromiter(map(len, words), np.int64, len(words))
    # exact lengths up to 24, then classes that grow by a quarter; the sums are read where each word ends
    kind = np.where(length <= 24, length, 24 + np.ceil(np.log(np.maximum(length, 25) / 24) / np.log(1.25)).astype(np.int64))
    order = np.argsort(kind, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(kind[order], prepend=-1)), len(order))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        most = max(1, 480_000 // int(length[order[hi - 1]]))
        for a in range(lo, hi, most):
            at = order[a : min(hi, a + most)]
            out[at] = forward_logs(*_codes([words[i] for i in at]), model)
    return out


def forward_logs(codes: np.ndarray, length: np.ndarray, model: Model) -> np.ndarray:
    """Log of the sum over all segmentations of each word, by language; the forward sums are pushed from letter to letter and scaled."""
    n, width, langs, ring = len(length), codes.shape[1], model.probs.shape[1], model.longest + 1
    table = np.vstack([model.probs, np.zeros((1, langs))])  # -1 reads the last row: probability 0
    sums, scale, out = np.zeros((ring, n, langs)), np.zeros((n, langs)), np.zeros((n, langs))
    sums[0] = 1.0
    for start in range(width):
        here = sums[start % ring]
        if start % 16 == 15:
            some = np.where(here > 0, here, 1.0)
            scale += np.log(some)
            sums /= some
        for k, ids in pieces_from(codes, start, model.keys, model.longest):
            if k == 1:
                sums[(start + 1) % ring] += here * table[ids]
            elif (hit := np.flatnonzero(ids >= 0)).size:
                sums[(start + k) % ring, hit] += here[hit] * table[ids[hit]]
        here[:] = 0.0
        if (end := np.flatnonzero(length == start + 1)).size:
            out[end] = np.log(sums[(start + 1) % ring, end] + 1e-300) + scale[end]
    return out


def fit(counts: dict[str, Counter], pieces: list[str], rounds: int = 3) -> Model:
    """Expectation maximisation over word counts by language."""
    languages, longest = sorted(counts), max(map(len, pieces), default=1)
    keys = piece_keys(pieces)
    probs = np.full((len(keys) + 1, len(languages)), 1.0 / (len(keys) + 1))
    work = []
    for li, lang in enumerate(languages):
        by: dict[int, list] = {}
        for word, c in counts[lang].items():
            for i in range(0, len(word), FIT_LETTERS):
                part = word[i : i + FIT_LETTERS]
                by.setdefault(len(part), []).append((part, c))
        for width, items in by.items():
            codes, _ = _codes([w for w, _ in items])
            work.append((li, width, [list(pieces_from(codes, start, keys, longest)) for start in range(width)], np.array([c for _, c in items], float)))
    for _ in range(rounds):
        seen = np.zeros_like(probs)
        for li, width, found, count in work:
            flat = np.append(probs[:, li], 0.0)
            sums = [np.ones(len(count))] + [np.zeros(len(count)) for _ in range(width)]
            for start in range(width):
                for k, i in found[start]:
                    sums[start + k] += sums[start] * flat[i]
            back = [np.zeros(len(count)) for _ in range(width)] + [np.ones(len(count))]
            for start in range(width - 1, -1, -1):
                for k, i in found[start]:
                    through = flat[i] * back[start + k]
                    back[start] += through
                    some = np.flatnonzero(i >= 0)
                    np.add.at(seen[:, li], i[some], count[some] * sums[start][some] * through[some] / (sums[width][some] + 1e-300))
        probs = np.maximum((seen + 0.01) / (seen + 0.01).sum(axis=0), _FLOOR)
    return Model(languages, keys, probs, longest)


def words_of(text: str) -> list[str]:
    """Lower-case letter runs."""
    return _WORD.findall(text.lower())


def train(documents: DataFrame, vocabulary_path: str, docs_a_language: int = DOCS_A_LANGUAGE) -> Model:
    """Learns from text and lang of rows outside fold 2 of 4, about docs_a_language of each language."""
    rows = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros(0, np.uint64), np.zeros((1, 0)), 1)
    picked = F.lit(False)
    for lang, n in sizes.items():
        picked = F.when(F.col("lang") == lang, sampled(F.col("doc_id"), docs_a_language / n, 5)).otherwise(picked)
    sample = rows.select("lang", "text", "doc_id").filter(picked)
    counts: dict[str, Counter] = {lang: Counter() for lang in sizes}
    for r in sample.select("lang", "text").toLocalIterator():
        counts[r["lang"]].update(words_of(r["text"]))
    return fit({k: v for k, v in counts.items() if v} or {next(iter(sizes)): Counter(["a"])}, vocabulary(vocabulary_path))


def identify(text: Column, model: Model, spark) -> Column:
    """struct<lang_pred, score> of each text."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        known = Known(len(model.languages))
        for batch in batches:
            out: list = []
            for part in slices(batch, 8 << 20):
                if len(known.row) > 400_000:
                    known = Known(len(model.languages))
                out += judge(part.to_pylist(), model, known)
            yield pa.array([{"lang_pred": a, "score": b} for a, b in out], kind)

    return predicted(text)


class Known:
    """Log-probabilities of the words that a task has seen."""

    def __init__(self, languages: int):
        self.row: dict[str, int] = {}
        self.logs = np.zeros((0, languages), np.float32)

    def add(self, words: list[str], model: Model) -> None:
        if words:
            self.row.update(zip(words, range(len(self.row), len(self.row) + len(words)), strict=True))
            self.logs = np.concatenate([self.logs, word_logs(words, model).astype(np.float32)])


def judge(texts: list[str], model: Model, known: Known | None = None) -> list[tuple[str, float]]:
    """(language, probability) of each text; known keeps the log-probabilities of words already seen."""
    known = Known(len(model.languages)) if known is None else known
    split = [words_of(t) for t in texts]
    if not model.languages:
        return [("und", 0.0)] * len(texts)
    known.add(list({w for ws in split for w in ws if w not in known.row}), model)
    out = []
    for t, ws in zip(texts, split, strict=True):
        if not any(map(str.isalpha, t)):
            out.append(("und", 0.0))
            continue
        total = known.logs[np.fromiter(map(known.row.__getitem__, ws), np.int64, len(ws))].sum(axis=0, dtype=np.float64)
        odds = np.exp(total - total.max())
        best = int(np.argmax(odds))
        out.append((model.languages[best], float(odds[best] / odds.sum())))
    return out


def identify_documents(documents: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    got = documents.select("doc_id", identify(F.col("text"), model, documents.sparkSession).alias("r"))
    return got.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("r.lang_pred"), F.col("r.score"))
