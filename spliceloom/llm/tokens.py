"""Token ids by the tokenizers library, each distinct chunk of text encoded once per worker.

A text is cut where the tokenizer's own pre-tokenizer always cuts (before a space that a visible character follows, or at
white space that the normaliser drops), so the ids of a text are the ids of its chunks in order. A chunk that is a Latin
word with or without ASCII punctuation after it is one or two pre-tokens and goes straight to the tokenizer's model;
any other chunk is encoded as a text. Texts with U+001C to U+001F, which Python and the tokenizer class differently, and
texts that hold the string of an added token, which the tokenizer turns into that token's id, are encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: Chunks kept in each of two generations by a worker.
MOST = 400_000
_BYTE_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: A Latin word (U+0130 lower-cases to two characters) and punctuation without the apostrophe.
_PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:-@\[-`{-~]*)\Z")

_TWO = [i.to_bytes(2, "little") for i in range(1 << 16)]


class Encoder(dict):
    """Chunk to its little-endian 16-bit ids; computes what it lacks. With `plain`, strings of added tokens are plain text."""

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits are not supported")
        self.tokenizer.encode_special_tokens = plain
        added = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join(["[\x1c-\x1f]", *map(re.escape, added)]), re.I)
        # a text without any of these (an added token's string up to its first letter) need not be searched
        self.signs = [*map(chr, range(0x1C, 0x20)), *{re.match("[^a-zA-Z\x80-\U0010ffff]*", a)[0] for a in added}]
        self.bytewise = self.tokenizer.normalizer is None
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # one visible character per byte, as the byte-level alphabet has it; bytes of two come as Latin-1 text
        self.visible = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(128)}
        self.visible |= {c: level.pre_tokenize_str(chr(0x80 | c & 63))[0][0][1] for c in range(128, 192)}
        self.visible |= {c: level.pre_tokenize_str(chr((c & 31) << 6))[0][0][0] for c in range(194, 224)}
        self.old: dict[str, bytes] = {}

    def word(self, pre_token: str) -> bytes:
        """Ids of one pre-token of code points below U+0800."""
        if not (pre_token.isascii() and pre_token.isalpha()):
            pre_token = pre_token.encode().decode("latin-1").translate(self.visible)
        return b"".join([_TWO[t.id] for t in self.model.tokenize(pre_token)])

    def whole(self, text: str) -> bytes:
        """Ids of a text encoded as a whole."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            plain = _PLAIN.match(chunk)
            if plain is None:
                ids = self.whole(chunk)
            elif plain[2]:
                ids = self[plain[1]] + self[plain[2]] if plain[1] != chunk else self.whole(chunk)
            else:
                ids = self.word(chunk if self.bytewise else chunk.lower())
        self[chunk] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        cut = _BYTE_CHUNK.findall if self.bytewise else str.split
        out, signs = [], self.signs
        for t in texts:
            if len(self) > MOST:
                self.old = dict(self)
                self.clear()
            rare = any(sign in t for sign in signs) and self.odd.search(t)
            out.append(self.whole(t) if rare else b"".join(map(self.__getitem__, cut(t))))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
