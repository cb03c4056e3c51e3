"""Periodic runs of words, found on a grammar of each text instead of the text itself.

Word ids are compressed by Re-Pair: pairs of neighbouring symbols that occur at least twice in a
text are replaced by nonterminals, the more frequent first. Many texts are compressed together in
numpy: their symbols are distinct, and in a round every occurrence goes that beats the pairs
overlapping it. What is left of a text is joined by a balanced tree of further nonterminals, so
that a text is one nonterminal in the end.

A run lies in a smallest nonterminal, and there it crosses the boundary of its two halves. So the
runs that cross the boundary are computed once for each nonterminal, at its first occurrence, and
then carried to all positions that the grammar derives it at; the pieces of a run that come from
several nonterminals are merged.

Across a boundary a run of at least four periods q holds a square of 2q words on one side. All q up
to a quarter of the nonterminal are asked, first whether the two words at the boundary recur at
distance q, then for the square, by hashes of ranges, then for how far the period goes. The runs so
found are compared word by word; should a hash ever have lied, the text is searched plainly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.words import documents, mix, per_batch, portions, segment_ids

#: A run has at least so many words, and so many periods.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Characters of texts that are compressed together (a longer text is on its own).
PORTION = 3_000_000
#: Pairs of nonterminal and period that are looked at together.
CANDIDATES = 2_000_000
#: Characters of a long text that are split into words at once.
PIECE = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


class Numbers(dict):
    """Numbers of words in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = new = len(self)
        return new


def text_words(text: str, known: Numbers) -> np.ndarray:
    """Ids of the words ``[^\\x20\\x09-\\x0D]+``; new words get the next ids."""
    parts, first = [], 0
    while first < len(text):
        last = first + PIECE
        while last < len(text) and text[last] not in " \t\n\v\f\r":
            last += 1
        words = text[first:last].encode("utf-8", "surrogatepass").split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        first = last
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


class Grammar:
    """Nonterminals number ``n_words`` and up; parts come before what they are part of.

    ``left``, ``right``, ``size`` (in words) and ``first`` (place of the first occurrence) are
    indexed by symbol; ``rounds`` are ranges of symbols made together; ``roots`` has the symbol of
    each text, -1 where it is empty.
    """

    def __init__(self, symbols: np.ndarray, offsets: np.ndarray) -> None:
        """``symbols`` of all texts, no symbol in two of them, dense from 0."""
        n = int(symbols.max()) + 1 if len(symbols) else 0
        self.n_words, self.n = n, n
        self._parts = [(np.full(n, -1), np.full(n, -1), np.ones(n, np.int64), np.zeros(n, np.int64))]
        self.rounds: list[tuple[int, int]] = []
        self._sizes = np.ones(n, np.int64)
        done = self._replace_pairs(symbols, np.arange(len(symbols)))
        self._join(*done, offsets)
        self.left, self.right, self.size, self.first = (np.concatenate(x) for x in zip(*self._parts, strict=True))

    def _add(self, left: np.ndarray, right: np.ndarray, first: np.ndarray) -> None:
        size = self._sizes[left] + self._sizes[right]
        self._sizes = np.concatenate([self._sizes, size])
        self._parts.append((left, right, size, first))
        self.rounds.append((self.n, self.n + len(left)))
        self.n += len(left)

    def _replace_pairs(self, seq: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and places of all texts when no pair occurs twice in one."""
        live = np.ones(max(0, len(seq) - 1), bool)  # pairs that may occur twice
        while live.any():
            at = np.flatnonzero(live)
            key = (seq[at] << 32) | seq[at + 1]
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
            counts = np.empty(len(at), np.int64)
            counts[order] = np.repeat(np.diff(edge), np.diff(edge))
            live[at[counts < 2]] = False
            at, key, counts = at[counts > 1], key[counts > 1], counts[counts > 1]
            if not len(at):
                break
            # Frequent pairs first; equally frequent ones in an order that has no direction.
            weight = np.zeros(len(live) + 2, np.uint64)
            weight[at + 1] = (np.minimum(counts, (1 << 31) - 1).astype(np.uint64) << np.uint64(32)) | (mix(key.astype(np.uint64)) >> np.uint64(32))
            pair = np.full(len(live) + 2, -1)
            pair[at + 1] = key
            # Of a stretch of equal pairs (a word repeated) every other one is taken.
            begins = pair[at + 1] != pair[at]
            stretch = np.cumsum(begins) - 1
            even = (np.arange(len(at)) - np.flatnonzero(begins)[stretch]) % 2 == 0
            beats = ((pair[at] == key) | (weight[at + 1] > weight[at])) & ((pair[at + 2] == key) | (weight[at + 1] > weight[at + 2]))
            chosen = even & beats
            if not chosen.any():
                break
            at, key = at[chosen], key[chosen]
            names, first, number = np.unique(key, return_index=True, return_inverse=True)
            n = self.n
            self._add(names >> 32, names & 0xFFFFFFFF, place[at[first]])
            seq = seq.copy()
            seq[at] = n + number
            stays = np.ones(len(seq), bool)
            stays[at + 1] = False
            # A pair lives on if it was alive, or has a new symbol.
            fresh = np.zeros(len(seq), bool)
            fresh[at] = True
            follows = np.append(live, False)
            seq, place, fresh, follows = seq[stays], place[stays], fresh[stays], follows[stays]
            live = (fresh[:-1] | fresh[1:]) | follows[:-1]
        return seq, place

    def _join(self, seq: np.ndarray, place: np.ndarray, offsets: np.ndarray) -> None:
        """Join what is left of each text, two and two."""
        text = np.searchsorted(offsets, place, "right") - 1
        while True:
            inner = text[1:] == text[:-1]
            if not inner.any():
                break
            first = np.concatenate([[True], ~inner])
            number = np.arange(len(text)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            at = np.flatnonzero((number[:-1] % 2 == 0) & inner)
            n = self.n
            self._add(seq[at], seq[at + 1], place[at])
            seq = seq.copy()
            seq[at] = n + np.arange(len(at))
            stays = np.ones(len(seq), bool)
            stays[at + 1] = False
            seq, place, text = seq[stays], place[stays], text[stays]
        self.roots = np.full(len(offsets) - 1, -1)
        self.roots[text] = seq


class Ranges:
    """Hashes of ranges of words: equal ranges have equal hashes."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self.power = np.ones(n + 1, np.uint64)
        self.power[1:] = _BASE
        self.power = np.cumprod(self.power, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(words.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=self.sums[1:])

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ranges of ``size`` words from ``a`` and from ``b`` >= a are alike."""
        return (self.sums[a + size] - self.sums[a]) * self.power[b - a] == self.sums[b + size] - self.sums[b]


def _search(size: np.ndarray, holds) -> np.ndarray:
    """For each entry the largest x from 0 to ``size`` with ``holds(entries, x)``, which holds up
    to some x and then no more."""
    low, high = np.zeros_like(size), size.copy()
    while True:
        at = np.flatnonzero(low < high)
        if not len(at):
            return low
        middle = (low[at] + high[at] + 1) // 2
        good = holds(at, middle)
        low[at[good]] = middle[good]
        high[at[~good]] = middle[~good] - 1


def boundary_runs(grammar: Grammar, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, start, end, period) of the runs that cross the boundary of a nonterminal, within
    its first occurrence; ordered by symbol."""
    ranges = Ranges(words)
    pair = np.append((words[:-1] << 32) | words[1:], -1) if len(words) else np.zeros(0, np.int64)
    symbols = np.flatnonzero((grammar.left >= 0) & (grammar.size >= MIN_WORDS))
    most = grammar.size[symbols] // MIN_PERIODS
    ends = np.cumsum(most)
    parts, i = [], 0
    while i < len(symbols):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + CANDIDATES, "right")))
        for q0 in range(0, int(most[i]), CANDIDATES) if j == i + 1 else (0,):
            parts.append(_crossing(grammar, ranges, pair, words, symbols[i:j], np.minimum(most[i:j] - q0, CANDIDATES), q0))
        i = j
    found = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 4
    symbol, start, end, period = found
    # Of several periods of the same words the smallest counts.
    order = np.lexsort([period, end, start, symbol])
    symbol, start, end, period = symbol[order], start[order], end[order], period[order]
    fresh = np.ones(len(symbol), bool)
    fresh[1:] = (symbol[1:] != symbol[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return symbol[fresh], start[fresh], end[fresh], period[fresh]


def _crossing(grammar: Grammar, ranges: Ranges, pair: np.ndarray, words: np.ndarray, symbols: np.ndarray, most: np.ndarray, q0: int):
    owner = np.repeat(symbols, most)
    q = q0 + 1 + np.arange(len(owner)) - np.repeat(np.cumsum(most) - most, most)
    low = grammar.first[owner]
    middle = low + grammar.size[grammar.left[owner]]
    high = low + grammar.size[owner]
    # The words on either side of the boundary come again q words on, or came q words before.
    here, top = pair[middle - 1], len(pair) - 1
    ahead = (middle + q < high) & (pair[np.minimum(middle - 1 + q, top)] == here)
    behind = (middle - 1 - q >= low) & (pair[np.maximum(middle - 1 - q, 0)] == here)
    some = ahead | behind
    owner, q, low, middle, high, ahead, behind = (x[some] for x in (owner, q, low, middle, high, ahead, behind))
    # Squares on the right and on the left: starts of ranges of q words that recur q words on.
    right = np.flatnonzero(ahead & (middle + 2 * q <= high))
    right = right[ranges.equal(middle[right], middle[right] + q[right], q[right])]
    left = np.flatnonzero(behind & (middle - 2 * q >= low))
    left = left[ranges.equal(middle[left] - 2 * q[left], middle[left] - q[left], q[left])]
    at = np.concatenate([right, left])
    seed = np.concatenate([middle[right], middle[left] - 2 * q[left]])
    owner, q, low, middle, high = (x[at] for x in (owner, q, low, middle, high))
    onward = _search(high - 2 * q - seed, lambda i, x: ranges.equal(seed[i] + q[i], seed[i] + 2 * q[i], x))
    back = _search(seed - low, lambda i, x: ranges.equal(seed[i] - x, seed[i] - x + q[i], x))
    start, end = seed - back, seed + 2 * q + onward
    good = (start < middle) & (end > middle) & (end - start >= np.maximum(MIN_WORDS, MIN_PERIODS * q))
    return owner[good], start[good], end[good], q[good]


def derived_runs(grammar: Grammar, roots: np.ndarray, places: np.ndarray, symbol: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """(start, end, period) of the runs at all places where the grammar derives their symbols,
    merged to maximal ones; by start, then period."""
    n_runs = np.bincount(symbol, minlength=grammar.n)
    first_run = np.cumsum(n_runs) - n_runs
    has = n_runs > 0
    for a, b in grammar.rounds:
        has[a:b] |= has[grammar.left[a:b]] | has[grammar.right[a:b]]
    found = []
    some = roots >= 0
    roots, places = roots[some], places[some]
    while len(roots):
        some = has[roots]
        roots, places = roots[some], places[some]
        own = n_runs[roots]
        at = np.repeat(first_run[roots] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        moved = np.repeat(places - grammar.first[roots], own)
        found.append((start[at] + moved, end[at] + moved, period[at]))
        inner = grammar.left[roots] >= 0
        roots, places = roots[inner], places[inner]
        left = grammar.left[roots]
        roots, places = np.concatenate([left, grammar.right[roots]]), np.concatenate([places, places + grammar.size[left]])
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    # A run is a range of places whose word recurs a period on: ranges that touch are one.
    order = np.lexsort([start, period])
    start, last, period = start[order], (end - period)[order], period[order]
    step = int(end.max(initial=0)) + 1
    number = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]])) if len(period) else period
    reach = np.maximum.accumulate(last + number * step)
    fresh = np.ones(len(start), bool)
    fresh[1:] = start[1:] + number[1:] * step > reach[:-1]
    at = np.flatnonzero(fresh)
    start, period = start[at], period[at]
    end = (reach - number * step)[np.append(at[1:], len(last)) - 1] + period if len(at) else start
    order = np.lexsort([period, start])
    return start[order], end[order], period[order]


def plain_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs, period by period: quadratic, for texts on which a hash
    was wrong."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // MIN_PERIODS + 1):
        same = np.concatenate([[False], words[q:] == words[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b + q - a >= max(MIN_WORDS, MIN_PERIODS * q):
                found.setdefault((a, b + q), q)
    return sorted((a, b, q) for (a, b), q in found.items())


def text_runs(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of the texts of ``words``, in one numbering of places."""
    text = segment_ids(offsets)
    n = int(words.max()) + 1 if len(words) else 1
    _, symbols = np.unique(text * n + words, return_inverse=True)
    grammar = Grammar(symbols.astype(np.int64), offsets)
    # Ids that are told apart by text: no range of one text is like one of another.
    symbol, start, end, period = boundary_runs(grammar, symbols.astype(np.int64))
    sizes = end - period - start
    wrong = np.zeros(len(offsets) - 1, bool)
    for i in np.flatnonzero(sizes > 0).tolist():
        a, m, q = int(start[i]), int(sizes[i]), int(period[i])
        if not np.array_equal(words[a : a + m], words[a + q : a + q + m]):
            wrong[text[a]] = True
    start, end, period = derived_runs(grammar, grammar.roots, offsets[:-1], symbol, start, end, period)
    if not wrong.any():
        return start, end, period
    right = ~wrong[text[start]]
    found = [np.stack([start[right], end[right], period[right]], 1)]
    for i in np.flatnonzero(wrong).tolist():
        a, b = offsets[i], offsets[i + 1]
        runs = np.array(plain_runs(words[a:b]), np.int64).reshape(-1, 3)
        found.append(runs + np.array([a, a, 0]))
    rows = np.concatenate(found)
    rows = rows[np.lexsort([rows[:, 2], rows[:, 0]])]
    return rows[:, 0], rows[:, 1], rows[:, 2]


def find_runs(texts: list[str]) -> tuple[list[int], list[list[dict]], list[str]]:
    """Of each text the number of words, the runs, and the words left when each run is cut down
    to its first period."""
    n_words, runs, collapsed = [], [], []
    for part in portions(texts, PORTION):
        known = Numbers()
        ids = [text_words(t, known) for t in part]
        offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
        words = np.concatenate(ids)
        start, end, period = text_runs(words, offsets)
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, start + period, 1)
        np.add.at(gone, end, -1)
        gone = np.cumsum(gone)[:-1] > 0
        spelled = list(known)
        bounds = np.searchsorted(start, offsets)
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            c, d = bounds[i], bounds[i + 1]
            n_words.append(b - a)
            runs.append([{"start": s - a, "length": e - s, "period": q} for s, e, q in zip(start[c:d].tolist(), end[c:d].tolist(), period[c:d].tolist(), strict=True)])
            left = words[a:b] if c == d else words[a:b][~gone[a:b]]
            collapsed.append(b" ".join(map(spelled.__getitem__, left.tolist())).decode("utf-8", "surrogatepass"))
    return n_words, runs, collapsed


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed (the
    words outside the repeats of runs, joined by a space) for every row of ``docs`` (doc_id, text).

    A run is a stretch of at least 6 words and 4 periods in which words a period apart are the
    same, with its smallest period, that cannot be made longer. Null and empty texts have no word
    and no run. Rows are looked at each on its own, so repeated rows give equal rows and a null
    doc_id stays null; other columns are not looked at. An Arrow batch is compressed in portions
    of some 3 million characters, a longer text alone and whole.
    """

    def search(batch):
        n_words, runs, collapsed = find_runs([t or "" for t in batch.column("text").to_pylist()])
        return {"doc_id": batch.column("doc_id"), "n_words": n_words, "runs": runs, "collapsed": collapsed}

    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return per_batch(docs.select(F.col("doc_id").cast("long"), "text"), search, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which the end of every tenth text, by hash of its id, repeats."""
    words = F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("w", F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), words))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    rows = rows.withColumn("a", F.when(n > 0, g % n)).withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (3 + g % 8)))
    moved = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(n > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def best_run() -> Column:
    """The run with the most periods, by exact comparison; ties go to the first."""
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.reduce(F.slice("runs", F.lit(2), F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a))


def op12_grammar_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(documents(spark, sf_dir)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.withColumn("best", best_run())
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
