"""Token ids of whole texts by the tokenizers library, with each distinct piece encoded once.

Texts are cut where the tokenizer's own pre-tokenizer has a boundary whatever stands around
it, so that the ids of the pieces, joined, are the ids of the text. Texts for which this is not
certain (white space outside ASCII, strings of special tokens) are encoded whole.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache
from itertools import chain

import numpy as np

#: Pieces remembered by a task at most; beyond it the memory is emptied and filled anew.
MAX_PIECES = 1_000_000
#: Likewise of runs of marks.
MAX_MARKS = 10_000

#: Fixed: the special token that both vocabularies have.
SEPARATOR = "<|endoftext|>"

#: White space outside the six ASCII characters, and U+001C to U+001F, on which regular
#: expression libraries differ.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]|<\\|")
#: A run of white space goes with the word after it.
_LEADING = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_PACK = struct.Struct("<I").pack

#: Perhaps a line feed, one word token by either pre-tokenizer (letters of ASCII and Latin-1 alone,
#: which are normalised already), and a run of marks, which is a token of its own by either; an
#: apostrophe may go with the letters after it, and "<" may begin a special token.
_PLAIN = re.compile("(\n?)( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:;=-@\\[-`{-~]*)")
#: Before a piece that is to be taken as it stands; no text that is cut has it (_ODD_SPACE).
_AS_IS = "\x1d"


def _byte_chars() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others are
    numbered from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(others)}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes. ``spaced``: white space is part of the
    tokens (byte-level vocabularies); otherwise it only separates words."""

    def __init__(self, path: str, spaced: bool) -> None:
        self.tokenizer, self.spaced = _tokenizer(path), spaced
        self.model, self.byte_chars = self.tokenizer.model, _byte_chars()
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        # By key: a piece itself; where white space is part of it, see _piece.
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def _cut(self, text: str) -> list[str]:
        """Keys of the pieces of a text."""
        if _ODD_SPACE.search(text):
            return [_AS_IS + text] if self.spaced else [text]
        # split() would also split at other white space, but there is none left here.
        if not self.spaced:
            return text.split()
        keys = text.replace("\n", " \n").split(" ")
        if keys[0]:
            keys[0] = _AS_IS + keys[0]
        else:
            del keys[0]
        # White space of other kinds, or more than one character of it, is part of a piece.
        if "" in keys or "\n" in keys or "\t" in text or "\r" in text or "\x0b" in text or "\f" in text:
            return [_AS_IS + piece for piece in _LEADING.findall(text)]
        return keys

    def _piece(self, key: str) -> str:
        """The piece that a key stands for: a space before it is left out in the key."""
        if not self.spaced or key[0] == "\n":
            return key
        return key[1:] if key[0] == _AS_IS else " " + key

    def _mark(self, marks: str) -> bytes:
        if marks not in self.marks:
            if len(self.marks) > MAX_MARKS:
                self.marks = {"": b""}
            self.marks[marks] = np.array(self._ids(marks), "<u4").tobytes()
        return self.marks[marks]

    def _learn(self, keys: list[str]) -> None:
        """Encode unknown pieces. A run of letters goes to the vocabulary's merges at once, one time
        for all the marks that may follow it, and anything else through the whole pipeline:
        many pieces to a call, joined by a special token whose id marks their ends."""
        known, plain, rest = self.known, [], []
        for key in keys:
            piece = self._piece(key)
            found = _PLAIN.fullmatch(piece)
            if found is None:
                rest.append((key, piece))
                continue
            head, word, marks = found.groups()
            if not self.spaced:
                word = word.lower()
            else:
                word = word[1:] if word[0] == " " else _AS_IS + word
            plain.append((key, head, word, marks))
        words = list({word for _, _, word, _ in plain}.difference(known))
        tokens = "\n".join(map(self._piece, words)).encode().decode("latin-1").translate(self.byte_chars)
        merged = map(self.model.tokenize, tokens.split(self.byte_chars[10]) if words else ())
        known.update(zip(words, [b"".join([_PACK(t.id) for t in ids]) for ids in merged], strict=True))
        known.update([(key, self._mark(head) + known[word] + self._mark(marks)) for key, head, word, marks in plain if key != word])
        alone = [x for x in rest if "<|" in x[1]]
        joined = [x for x in rest if "<|" not in x[1]]
        for start in range(0, len(joined), 2000):
            some = joined[start : start + 2000]
            ids = np.array(self._ids(SEPARATOR.join([piece for _, piece in some])), "<u4")
            ends = np.append(np.flatnonzero(ids == self.separator), len(ids))
            begins = np.append(0, ends[:-1] + 1)
            raw = ids.tobytes()
            known.update(zip([key for key, _ in some], [raw[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], strict=True))
        for key, piece in alone:
            known[key] = np.array(self._ids(piece), "<u4").tobytes()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Texts are looked up in groups, so that unknown pieces of many
        texts are encoded together."""
        out: list[bytes] = []
        for start in range(0, len(texts), 500):
            cut = [self._cut(t) for t in texts[start : start + 500]]
            if len(self.known) > MAX_PIECES:
                self.known.clear()
            known, group, missing = self.known, [b""] * len(cut), []
            for i, keys in enumerate(cut):
                try:
                    group[i] = b"".join(map(known.__getitem__, keys))
                except KeyError:
                    missing.append(i)
            if missing:
                self._learn(list(set(chain.from_iterable([cut[i] for i in missing])).difference(known)))
                for i in missing:
                    group[i] = b"".join(map(known.__getitem__, cut[i]))
            out += group
            for text, keys in zip(texts[start : start + 500], cut, strict=True):
                if len(keys) == 1 and len(text) > 256:  # whole texts are not worth remembering
                    known.pop(keys[0], None)
        return out


@lru_cache(maxsize=4)
def encoder(path: str, spaced: bool) -> Encoder:
    """One per task process: workers live on between batches and tasks."""
    return Encoder(path, spaced)


def forget_pieces() -> None:
    """Give up the pieces that this process remembers, for a step that encodes nothing."""
    encoder.cache_clear()
