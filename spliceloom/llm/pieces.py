"""SentencePiece encoding and decoding with seeded merge-dropout.

A text is encoded as a merge-type (BPE) SentencePiece model does: white space becomes U+2581, one is put in front, and
candidate merges leave an agenda best score first, leftmost first. A keyed hash of seed, variant, place and the two
symbols decides whether a candidate is skipped for good; other candidates still merge, so segmentations vary while their
pieces spell the same text. The variant of a chunk (a word with the space before it), one of `variants`, is a keyed hash of
the seed, the whole text and where in the text the chunk stands, so that repeats of a word differ inside a document and
between documents; with dropout 0 the ids are the model's own. A chunk in a variant that skips none of the merges that lead
to those ids has the same ids, so only the others run their agenda. Characters without a piece, and U+2581 itself, become byte pieces, so decoding
always gives the text back. Null texts encode to null; the digest counts them as empty, and an empty text has no ids.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices
from .words import mix

SPACE = "▁"
#: Chunks longer than this go through a heap one by one; shorter ones merge in step, by length.
LONG = 96
#: Segmentations that a chunk can have in a corpus.
VARIANTS = 256
#: Chunks that a worker keeps; beyond it learns them anew.
MOST = 400_000
#: Their characters, with the ids of those above LONG.
HELD = 20_000_000
#: Chunks that merge in step at a time.
BLOCK = 4096
_NONE = 1 << 62
_CHUNK = re.compile(r"▁*[^▁\n￹]+|▁+|\n|￹")
_HIDDEN = "￹"  # stands for U+2581 and for itself while a text is cut; both become byte pieces


class Decoder:
    """Decoder of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(self.size)]
        self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) or model.is_unknown(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids."""
        return b"".join(map(self.bytes.__getitem__, ids))[1:].decode("utf-8", "replace")


class _Numbers(dict):
    """A running number for each key, given when the key is first asked for."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


class _Rows:
    """Rows of numbers of any lengths, one behind the other in one array."""

    def __init__(self, dtype: type):
        self.data, self.start, self.size = np.zeros(0, dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, order: np.ndarray, sizes: np.ndarray, data: np.ndarray) -> None:
        """New rows; `order` says which new row each stretch of the data is."""
        start, size = np.zeros((2, len(order)), np.int64)
        start[order], size[order] = len(self.data) + np.cumsum(sizes) - sizes, sizes
        self.data = np.concatenate([self.data, data.astype(self.data.dtype)])
        self.start, self.size = np.append(self.start, start), np.append(self.size, size)


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (`size` of them) of each row, row after row."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Codec(Decoder):
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, dropout: float = 0.0, seed: int = 0, variants: int = VARIANTS):
        super().__init__(path)
        model, pieces = self.model, self.pieces
        self.variants = variants if dropout else 1
        self.seed = np.uint64(seed)
        self.skip = np.uint64(min(int(dropout * 2.0**64), (1 << 64) - 1))
        normal = [i for i in range(self.size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(pieces) if model.is_byte(i)}
        self.of_byte = np.array([self.byte.get(b, 0) for b in range(256)])
        self.id = {pieces[i]: i for i in normal}
        score = np.array([model.get_score(i) for i in range(self.size)])
        pairs = sorted((self.id[p[:k]] << 32 | self.id[p[k:]], i) for p, i in self.id.items() for k in range(1, len(p)) if p[:k] in self.id and p[k:] in self.id)
        self._tables(np.array([k for k, _ in pairs], np.int64), np.array([i for _, i in pairs], np.int64))
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int64)
        self.of_code = self.size + np.arange(0x110000, dtype=np.int32)
        for piece, i in self.id.items():
            if len(piece) == 1:
                self.of_code[ord(piece)] = i
        self.salts = self._salt(np.arange(self.variants)[:, None], np.arange(LONG))
        self._forget()

    def _forget(self) -> None:
        self.words, self.long, self.held = _Numbers(), {}, 0
        self.heaped: dict[tuple[int, int], np.ndarray] = {}
        #: Of each chunk: symbols, ids without dropout, and the merges that lead to them (places and pairs)
        self.symbol, self.plain, self.place, self.pair = _Rows(np.int32), _Rows(np.int32), _Rows(np.uint8), _Rows(np.int64)

    def _tables(self, keys: np.ndarray, ids: np.ndarray, bits: int = 20) -> None:
        """Two hashed tables; a pair is in the first or, where that place is taken, in the second."""
        self.shift = np.uint64(64 - bits)
        first = self._slot(keys, 0)
        won = np.zeros(len(keys), bool)
        won[np.unique(first, return_index=True)[1]] = True
        self.second = 1
        while len(np.unique(self._slot(keys[~won], self.second))) < int((~won).sum()):
            self.second += 1
        self.pair_key = np.full((2, 1 << bits), -1, np.int64)
        self.pair_id = np.zeros((2, 1 << bits), np.int32)
        for row, some, salt in ((0, won, 0), (1, ~won, self.second)):
            at = self._slot(keys[some], salt)
            self.pair_key[row, at], self.pair_id[row, at] = keys[some], ids[some]

    def _slot(self, keys: np.ndarray, salt: int) -> np.ndarray:
        x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * salt & (1 << 64) - 1 | 1)
        return ((x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> self.shift).astype(np.int64)

    def _salt(self, variant: np.ndarray, place: np.ndarray) -> np.ndarray:
        return mix(place.astype(np.uint64) + variant.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(int(self.seed) * 0x9E3779B97F4A7C15 % (1 << 64)))

    def _skipped(self, salt: np.ndarray, pair: np.ndarray) -> np.ndarray:
        return mix(salt ^ pair.astype(np.uint64)) < self.skip

    def _merged(self, pair: np.ndarray) -> np.ndarray:
        """Id of the merge of each pair (left << 32 | right), -1 for none."""
        at = self._slot(pair, 0)
        merged = np.where(self.pair_key[0][at] == pair, self.pair_id[0][at], -1)
        rest = np.flatnonzero(merged < 0)
        at = self._slot(pair[rest], self.second)
        merged[rest] = np.where(self.pair_key[1][at] == pair[rest], self.pair_id[1][at], -1)
        return merged

    def symbols(self, text: str) -> np.ndarray:
        """A piece id for each character; characters without one are size + code point."""
        return self.of_code[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int64)

    def _agenda(self, pair: np.ndarray, place: np.ndarray, variant: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Rank and place as one number (_NONE for no merge or a skipped one) and id of the merge of each pair."""
        merged = self._merged(pair)
        at = np.flatnonzero(merged >= 0)
        if variant is not None and self.skip:
            at = at[~self._skipped(self.salts.ravel()[variant[at] * LONG + place[at]], pair[at])]
        turn = np.full(len(pair), _NONE)
        turn[at] = self.rank[merged[at]] << 7 | place[at]
        return turn, merged

    def _steps(self, sym: np.ndarray, variant: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
        """Symbols after all merges of chunks of one length (a row each, LONG at most), how many each has, and the merges as row, place and pair.

        Symbols of a chunk are linked, so nothing moves. Chunks stand in columns here. Without variants nothing is skipped.
        """
        n, width = sym.shape
        done, own, sym = np.empty((width, n), np.int64), np.arange(n), sym.T.flatten()
        places = np.repeat(np.arange(width), n)
        after, before = places + 1, places - 1
        turn, merged = np.full(width * n, _NONE), np.zeros(width * n, np.int64)
        if width > 1:
            turn[:-n], merged[:-n] = self._agenda(sym[:-n] << 32 | sym[n:], places[:-n], None if variant is None else np.tile(variant, width - 1))
        path = []
        while True:
            best = turn.reshape(width, n).min(axis=0)
            go = np.flatnonzero(best < _NONE)
            if 4 * len(go) <= 3 * n:
                done[:, own] = sym.reshape(width, n)
                if not len(go):
                    break
                sym, after, before, turn, merged = (x.reshape(width, n)[:, go].ravel() for x in (sym, after, before, turn, merged))
                own, best, variant, n = own[go], best[go], None if variant is None else variant[go], len(go)
                go = np.arange(n)
            j = best[go] & 127
            at = j * n + go
            k = after[at] * n + go
            end, start = after[k], before[at]
            if variant is None:
                path.append((own[go], j, sym[at] << 32 | sym[k]))
            sym[at], sym[k] = merged[at], -1
            turn[at] = turn[k] = _NONE
            after[at] = end
            more, less = np.flatnonzero(end < width), np.flatnonzero(start >= 0)
            before[end[more] * n + go[more]] = j[more]
            col, left = np.concatenate([go[more], go[less]]), np.concatenate([j[more], start[less]])
            at, k = left * n + col, np.concatenate([end[more], j[less]]) * n + col
            turn[at], merged[at] = self._agenda(sym[at] << 32 | sym[k], left, None if variant is None else variant[col])
        done = done.T
        kept = done >= 0
        return done[kept], kept.sum(axis=1), tuple(map(np.concatenate, zip(*path, strict=True))) if path else (np.zeros(0, np.int64),) * 3

    def _spelled(self, sym: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of symbols and how many each row has; characters without a piece become byte pieces."""
        odd = sym >= self.size
        if not odd.any():
            return sym, sizes
        chars = "".join(map(chr, (sym[odd] - self.size).tolist()))
        width = np.ones(len(sym), np.int64)
        width[odd] = [len(c.encode()) for c in chars]
        ids, ends = np.repeat(sym, width), np.append(0, np.cumsum(width))[np.append(0, np.cumsum(sizes))]
        ids[np.repeat(odd, width)] = self.of_byte[np.frombuffer(chars.encode(), np.uint8)]
        return ids, np.diff(ends)

    def in_step(self, chunks: list[str], variants: list[int]) -> list[bytes]:
        """Ids after all merges, for chunks of one length (LONG at most) and their variants."""
        sym, sizes, _ = self._steps(self.symbols("".join(chunks)).reshape(len(chunks), -1), np.array(variants, np.int64))
        ids, sizes = self._spelled(sym, sizes)
        return [x.astype("<i4").tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])]

    def by_heap(self, chunk: str, variant: int) -> list[int]:
        """Symbols of one chunk by an agenda of candidates."""
        sym, n = self.symbols(chunk).tolist(), len(chunk)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def candidates(lefts: list[int]) -> list[tuple]:
            a, b = np.array([sym[i] for i in lefts], np.int64), np.array([sym[after[i]] for i in lefts], np.int64)
            pair = a << 32 | b
            merged = self._merged(pair)
            ok = merged >= 0
            if self.skip:
                ok &= ~self._skipped(self._salt(np.full(len(lefts), variant), np.array(lefts)), pair)
            return [(r, i, x, y, m) for r, i, x, y, m, good in zip(self.rank[merged].tolist(), lefts, a.tolist(), b.tolist(), merged.tolist(), ok.tolist(), strict=True) if good]

        agenda = candidates(list(range(n - 1))) if n > 1 else []
        heapq.heapify(agenda)
        while agenda:
            _, i, a, b, m = heapq.heappop(agenda)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = m, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for c in candidates([k for k in (before[i], i) if k >= 0 and after[k] < n]):
                heapq.heappush(agenda, c)
        return [s for s in sym if s >= 0]

    def _final(self, symbols: list[int]) -> bytes:
        return self._spelled(np.array(symbols, np.int64), np.array([len(symbols)]))[0].astype("<i4").tobytes()

    def learn(self, chunks: list[str]) -> None:
        """Symbols, ids without dropout and their merges, of chunks not known yet; chunks of one length merge together.

        Of chunks above LONG only the text is kept where there is dropout: they go through a heap for each variant.
        """
        by: dict[int, list[int]] = {}
        known = len(self.symbol.size)
        self.held += sum(map(len, chunks))
        for i, c in enumerate(chunks):
            by.setdefault(0 if c[0] == _HIDDEN else len(c), []).append(i)
        parts: list[tuple] = []
        for width, rows in by.items():
            for i in range(0, len(rows), BLOCK):
                some = rows[i : i + BLOCK]
                none, sizes = np.zeros(0, np.int64), np.full(len(some), width)
                if width and width <= LONG:
                    sym = self.symbols("".join([chunks[k] for k in some]))
                    ids, n_ids, (row, place, pair) = self._steps(sym.reshape(-1, width), None)
                    by_row = np.argsort(row, kind="stable")
                    ids, n_ids = self._spelled(ids, n_ids)
                    parts.append((some, sizes, sym, n_ids, ids, np.bincount(row, minlength=len(some)), place[by_row], pair[by_row]))
                    continue
                if not width:
                    each = [self.of_byte[np.frombuffer(chunks[k][1].encode(), np.uint8)] for k in some]
                elif self.skip:
                    each = [none for _ in some]
                    self.long |= {known + k: chunks[k] for k in some}
                else:
                    each = [np.frombuffer(self._final(self.by_heap(chunks[k], 0)), "<i4") for k in some]
                no = np.zeros(len(some), np.int64)
                parts.append((some, no, none, np.array(list(map(len, each))), np.concatenate(each), no, none, none))
        order, sizes, sym, n_ids, ids, n_path, place, pair = map(np.concatenate, zip(*parts, strict=True))
        for rows, size, data in ((self.symbol, sizes, sym), (self.plain, n_ids, ids), (self.place, n_path, place), (self.pair, n_path, pair)):
            rows.add(order, size, data)

    def _touched(self, word: np.ndarray, variant: np.ndarray) -> np.ndarray:
        """Where a merge that leads to the ids without dropout is skipped, and long chunks; all others keep those ids.

        The best candidate that is not skipped merges next, so while none of those merges is skipped they are the ones that happen.
        """
        touched = self.plain.size[word] == 0
        for i in range(0, len(word), 1 << 16):
            some, its = word[i : i + (1 << 16)], variant[i : i + (1 << 16)]
            size = self.pair.size[some]
            at, row = _places(self.pair.start[some], size), np.repeat(np.arange(len(some)), size)
            salt = self.salts.ravel()[(its * LONG)[row] + self.place.data[at]]
            touched[i + row[self._skipped(salt, self.pair.data[at])]] = True
        return touched

    def _heaped(self, word: int, variant: int) -> np.ndarray:
        if (ids := self.heaped.get((word, variant))) is None:
            ids = self.heaped[word, variant] = np.frombuffer(self._final(self.by_heap(self.long[word], variant)), "<i4")
            self.held += len(ids)
        return ids

    def _varied(self, word: np.ndarray, variant: np.ndarray) -> _Rows:
        """Ids of chunks in variants, with all that these skip."""
        out, parts, widths = _Rows(np.int32), [], self.symbol.size[word]
        for width in np.unique(widths).tolist():
            rows = np.flatnonzero(widths == width)
            for i in range(0, len(rows), BLOCK):
                some = rows[i : i + BLOCK]
                if width:
                    sym = self.symbol.data[self.symbol.start[word[some], None] + np.arange(width)].astype(np.int64)
                    ids, sizes = self._spelled(*self._steps(sym, variant[some])[:2])
                else:
                    each = list(map(self._heaped, word[some].tolist(), variant[some].tolist()))
                    ids, sizes = np.concatenate(each), np.array(list(map(len, each)))
                parts.append((some, sizes, ids))
        if parts:
            out.add(*map(np.concatenate, zip(*parts, strict=True)))
        return out

    def _kinds(self, text: str, n: int) -> list[int]:
        """Variant of each of the n chunks of a text."""
        if self.variants == 1:
            return [0] * n
        key = mix(np.array([zlib.crc32(text.encode()) | (int(self.seed) & 0xFFFFFFFF) << 32], np.uint64))
        return (mix(key + np.arange(n, dtype=np.uint64)) % np.uint64(self.variants)).tolist()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.words) > MOST or self.held > HELD:
            self._forget()
        cut: list[str] = []
        ends, kinds = [0], []
        for t in texts:
            chunks = _CHUNK.findall((" " + t).replace(SPACE, _HIDDEN).replace(" ", SPACE)) if t else []
            if SPACE in t or _HIDDEN in t:
                hidden = (c for c in t if c in (SPACE, _HIDDEN))
                chunks = [c + next(hidden) if c == _HIDDEN else c for c in chunks]
            cut += chunks
            ends.append(len(cut))
            kinds.append(np.array(self._kinds(t, len(chunks)), np.int64))
        known = len(self.words)
        word = np.fromiter(map(self.words.__getitem__, cut), np.int64, len(cut))
        if len(self.words) > known:
            self.learn(list(itertools.islice(self.words, known, None)))
        data, start, size = self.plain.data, self.plain.start[word], self.plain.size[word]
        if self.skip and len(cut):
            variant = np.concatenate(kinds)
            at = np.flatnonzero(self._touched(word, variant))
            pairs, which = np.unique(word[at] * self.variants + variant[at], return_inverse=True)
            varied = self._varied(pairs // self.variants, pairs % self.variants)
            start[at], size[at] = len(data) + varied.start[which], varied.size[which]
            data = np.concatenate([data, varied.data])
        ids = data[_places(start, size)].astype("<i4", copy=False)
        ends = np.append(0, np.cumsum(size))[ends].tolist()
        return [ids[a:b] for a, b in itertools.pairwise(ends)]


_codecs: dict[tuple, Codec] = {}


def codec(path: str, dropout: float, seed: int, variants: int) -> Codec:
    """This worker's codec of a model file and its settings."""
    key = (path, dropout, seed, variants)
    if key not in _codecs:
        _codecs[key] = Codec(*key)
    return _codecs[key]


@functools.cache
def decoder(path: str) -> Decoder:
    """This worker's decoder of a model file."""
    return Decoder(path)


def encode(text: Column, path: str, dropout: float = 0.1, seed: int = 0, variants: int = VARIANTS) -> Column:
    """Ids of each text as array<int>."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        own, nulls, out = codec(path, dropout, seed, variants), texts.is_null().to_pylist(), []
        for part in slices(texts):
            out += own.encode(part.to_pylist())
        return pa.array([None if n else x for x, n in zip(out, nulls, strict=True)], pa.list_(pa.int32()))

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """Text of each array of ids."""

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        own = decoder(path)
        return pa.array([own.decode(x.values.to_pylist()) if x.is_valid else None for x in lists], pa.string())

    return texts(ids)


def round_trip(df: DataFrame, path: str, dropout: float = 0.1, seed: int = 0, variants: int = VARIANTS) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_crc32 (ids as little-endian 32-bit numbers), decoded_sha256, lossless.

    Null texts count as empty, null ids stay null, every repeated row has a row of its own, an empty table gives none, and
    other columns of df are not looked at. Equal texts have equal ids, so nothing hangs on ties.
    """

    @F.arrow_udf("struct<n:long,crc:long,sha:string>")
    def digest(lists: pa.Array) -> pa.Array:
        own, out = decoder(path), []
        for x in lists:
            ids = x.values.to_numpy()
            out.append({"n": len(ids), "crc": zlib.crc32(ids.astype("<i4").tobytes()), "sha": hashlib.sha256(own.decode(ids.tolist()).encode()).hexdigest()})
        return pa.array(out, pa.struct([("n", pa.int64()), ("crc", pa.int64()), ("sha", pa.string())]))

    text = F.coalesce(F.col("text"), F.lit(""))
    done = df.select("doc_id", digest(encode(text, path, dropout, seed, variants)).alias("r"), F.sha2(text.cast("binary"), 256).alias("h"))
    return done.select("doc_id", F.col("r.n").alias("n_tokens"), F.col("r.crc").alias("ids_crc32"), F.col("r.sha").alias("decoded_sha256"), (F.col("r.sha") == F.col("h")).alias("lossless"))
