"""Character, word and line statistics of a batch of texts, by numpy over code points."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np

from shelfmark.llm.words import segment_ids, segment_sums, window_hashes, word_arrays

#: Fixed set of characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Classes of characters. Code points from 65536 on count as letters.
LETTER, UPPER, DIGIT, SYMBOL, SPACE, NEWLINE, STOP, PUNCT = range(8)


def _class_of(char: str) -> int:
    if char == "\n":
        return NEWLINE
    if char in " \t\v\f\r":
        return SPACE
    if char in SYMBOLS:
        return SYMBOL
    if char in ".!?":
        return STOP
    kind = unicodedata.category(char)
    return {"Lu": UPPER, "Lt": UPPER, "Nd": DIGIT}.get(kind, LETTER if kind[0] in "LM" else PUNCT)


_TABLE: list[np.ndarray] = []


def class_table() -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.array([_class_of(chr(c)) for c in range(65536)], np.uint8))
    return _TABLE[0]


@dataclass
class LineStats:
    """Arrays over the lines of a batch; ``line_offsets`` has the lines of each text."""

    line_offsets: np.ndarray
    classes: np.ndarray  # lines x 8 counts of characters
    words: np.ndarray
    capitals: np.ndarray  # words that begin with an upper-case letter
    doubled: np.ndarray  # "!!" or "??" and the like
    repeats: np.ndarray  # 1 where an earlier line of the text is the same

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return segment_sums(values, self.line_offsets)


def line_stats(texts: list[str]) -> LineStats:
    """Statistics of every line of every text. Lines are split at line feeds alone; each
    text has at least one line, and a line without a word is a line too."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = class_table()[np.minimum(points, 65535)]
    kind[points > 65535] = LETTER
    ends = np.flatnonzero(kind == NEWLINE)
    starts = np.concatenate([[0], ends[:-1] + 1])
    # Every segment holds at least its line feed, so reduceat has no empty segment.
    counts = np.stack([np.add.reduceat((kind == k).view(np.uint8), starts, dtype=np.int32) for k in range(8)], 1)
    blank = (kind == SPACE) | (kind == NEWLINE)
    begins = ~blank & np.concatenate([[True], blank[:-1]])
    words = np.add.reduceat(begins.view(np.uint8), starts, dtype=np.int32)
    capitals = np.add.reduceat((begins & (kind == UPPER)).view(np.uint8), starts, dtype=np.int32)
    stop = kind == STOP
    doubled = np.add.reduceat((stop & np.concatenate([[False], stop[:-1]])).view(np.uint8), starts, dtype=np.int32)
    offsets, repeats = np.zeros(len(texts) + 1, np.int64), []
    for i, text in enumerate(texts):
        seen: set[str] = set()
        lines = text.split("\n")
        for line in lines:
            repeats.append(line in seen)
            seen.add(line)
        offsets[i + 1] = offsets[i] + len(lines)
    return LineStats(offsets, counts, words, capitals, doubled, np.array(repeats, bool) & (words > 0))


def repeated_window_words(texts: list[str], width: int = 5, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: words, words in windows of ``width`` words that are found twice or more
    in the text, and distinct words."""
    ids, offsets, hashes = word_arrays(texts, lower)
    doc = segment_ids(offsets)
    pairs = np.unique(doc * np.int64(max(1, len(hashes))) + ids)
    distinct = np.bincount(pairs // max(1, len(hashes)), minlength=len(texts)) if len(ids) else np.zeros(len(texts), np.int64)
    n_words = np.diff(offsets)
    covered = np.zeros(len(ids) + 1, np.int32)
    n = len(ids) - width + 1
    if n > 0:
        inside = np.flatnonzero(doc[:n] == doc[width - 1 :])
        keys = window_hashes(ids.astype(np.uint64), width)[inside] * np.uint64(0x9E3779B97F4A7C15) + doc[inside].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        at = inside[counts[inverse] > 1]
        covered[at] += 1
        np.add.at(covered, at + width, -1)
    hit = np.cumsum(covered[:-1]) > 0
    return n_words, segment_sums(hit, offsets), distinct
