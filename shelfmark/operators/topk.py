"""Scoring blocks of vectors inside a task, and keeping the k best per query."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Scores are compared at 6 decimals, then by id, so that ranks do not depend on
# how the rows were split over tasks.
SCORE_DIGITS = 6
_SLICE_CELLS = 4_000_000
# Queries of one block; rows are taken by as many as make a slice with them.
_BLOCK_QUERIES = 2_048
# Rows that may pass the bar, for each of the k wanted, before a block's own k-th is looked for.
_LOOSE = 4
# Components from which on a sum of products may leave the range of single precision.
_WIDE = 1e15
_SLACK = 2.5 * 10.0**-SCORE_DIGITS


def float_matrix(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows usable as vectors (right length, finite, not all zero) and their matrix."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dim)
    values = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    matrix = np.asarray(values, dtype=np.float32).reshape(len(rows), dim)
    usable = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
    return (rows, matrix) if usable.all() else (rows[usable], matrix[usable])


def pair_scores(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """Scores of aligned pairs in double precision, rounded; l2 is a distance."""
    left, right = left.astype(np.float64), right.astype(np.float64)
    if metric == "l2":
        gap = left - right
        score = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    else:
        score = np.einsum("ij,ij->i", left, right)
        if metric == "cosine":
            score /= np.sqrt(np.einsum("ij,ij->i", left, left)) * np.sqrt(np.einsum("ij,ij->i", right, right))
    return np.round(score, SCORE_DIGITS)


def _slices(rows: np.ndarray) -> list[slice]:
    """Rows by blocks whose copy in double precision is small."""
    step = max(1, _SLICE_CELLS // max(1, rows.shape[1]))
    return [slice(at, at + step) for at in range(0, len(rows), step)]


def slack_of(one: np.ndarray, two: np.ndarray, lengths: np.ndarray, longest: float) -> tuple[type, np.ndarray]:
    """The precision that squared distances of ``one`` from ``two`` are to be taken in, and for each row of ``one``
    what they may be off by, the rounding of scores included."""
    wide = max(float(np.abs(one).max(initial=0)), float(np.abs(two).max(initial=0))) > _WIDE
    kind = np.float64 if wide else np.float32
    return kind, 2 * (one.shape[1] + 8) * float(np.finfo(kind).eps) * (lengths + longest) ** 2 + _SLACK


def lengths_of(rows: np.ndarray) -> np.ndarray:
    """Euclidean lengths in double precision, whatever the size of the components."""
    out = np.empty(len(rows))
    for part in _slices(rows):
        wide = rows[part].astype(np.float64)
        out[part] = np.sqrt(np.einsum("ij,ij->i", wide, wide))
    return out


def unit_rows(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows scaled in double precision to length one, then in single."""
    out = np.empty(rows.shape, np.float32)
    for part in _slices(rows):
        out[part] = rows[part].astype(np.float64) / lengths[part, None]
    return out


@dataclass
class BestRows:
    """The k best rows seen so far for each of a set of queries.

    Queries and rows meet in blocks of bounded size, so that the work of a block does not grow with
    the number of queries: a block touches the state of its own queries alone.
    """

    queries: np.ndarray
    metric: str
    k: int

    def __post_init__(self) -> None:
        n = len(self.queries)
        # Of each query the rows held, best first; as wide as rows were offered, at most k.
        self._ids = np.zeros((n, 0), np.int64)
        self._scores = np.zeros((n, 0))
        self._held = np.zeros(n, np.int64)
        self._offered = 0
        self.norms = lengths_of(self.queries)
        self.bar = np.full(n, -np.inf)  # the k-th closeness so far
        self.left = unit_rows(self.queries, self.norms) if self.metric == "cosine" else self.queries
        self.largest = float(np.abs(self.queries).max(initial=0))

    @property
    def query(self) -> np.ndarray:
        """Positions of the queries of the rows held, in order."""
        return np.repeat(np.arange(len(self.queries)), self._held)

    @property
    def row_id(self) -> np.ndarray:
        return self._ids[self._filled(slice(None))]

    @property
    def score(self) -> np.ndarray:
        return self._scores[self._filled(slice(None))]

    def _filled(self, some) -> np.ndarray:
        return np.arange(self._ids.shape[1]) < self._held[some][:, None]

    def add(self, ids: np.ndarray, rows: np.ndarray, which: np.ndarray | None = None) -> None:
        """Offer rows to all queries, or to the queries at the positions ``which``."""
        which = np.arange(len(self.queries)) if which is None else which
        if not len(which) or not len(ids):
            return
        self._offered += len(ids)
        more = min(self.k, self._offered) - self._ids.shape[1]
        if more > 0:
            self._ids = np.pad(self._ids, ((0, 0), (0, more)))
            self._scores = np.pad(self._scores, ((0, 0), (0, more)))
        norms = lengths_of(rows)
        right = unit_rows(rows, norms) if self.metric == "cosine" else rows
        step = max(_BLOCK_QUERIES, _SLICE_CELLS // min(len(which), _BLOCK_QUERIES))
        for at in range(0, len(ids), step):
            part = slice(at, at + step)
            # Products that single precision could not hold are taken in double at once.
            wide = self.metric != "cosine" and max(self.largest, float(np.abs(rows[part]).max(initial=0))) > _WIDE
            kind = np.float64 if wide else np.float32
            for first in range(0, len(which), _BLOCK_QUERIES):
                self._offer(ids[part], rows[part], right[part], norms[part], which[first : first + _BLOCK_QUERIES], kind)

    def _offer(self, ids: np.ndarray, rows: np.ndarray, right: np.ndarray, norms: np.ndarray, which: np.ndarray, kind: type) -> None:
        # Single precision finds the candidates; the error bound widens the cut so that
        # none is missed, and the survivors are scored again in double precision.
        unit_error = (rows.shape[1] + 8) * float(np.finfo(kind).eps)
        left, lengths = self.left[which].astype(kind, copy=False), self.norms[which]
        right = right.astype(kind, copy=False)
        # For l2, what orders the rows of a query: its own squared length is taken off the cut.
        close, shift = left @ right.T, 0.0
        if self.metric == "l2":
            close *= 2
            close -= (norms**2).astype(kind)[None, :]
            shift = lengths**2

        def cut(bar: np.ndarray) -> np.ndarray:
            if self.metric == "l2":
                error = 2 * unit_error * (lengths + norms.max()) ** 2
                reach = np.sqrt(np.maximum(-bar, 0) + error) + _SLACK
                low = np.where(np.isfinite(bar), -(reach**2) - error, bar) + shift
            else:
                scale = 1.0 if self.metric == "cosine" else lengths * norms.max()
                low = bar - 2 * unit_error * scale - _SLACK
            return np.nextafter(low.astype(kind), kind(-np.inf))[:, None]

        bar = self.bar[which]
        near = close >= cut(bar)
        query, column = np.divmod(np.flatnonzero(near), close.shape[1])
        # Where the bar lets many rows pass, the k-th of this block is a better one.
        loose = np.flatnonzero(np.bincount(query) > _LOOSE * self.k)
        if len(loose) and close.shape[1] >= self.k:
            at = close.shape[1] - self.k
            kth = np.partition(close[loose], at, axis=1)[:, at] - (shift[loose] if self.metric == "l2" else 0.0)
            bar[loose] = np.maximum(bar[loose], kth)
            near[loose] = close[loose] >= cut(bar)[loose]
            query, column = np.divmod(np.flatnonzero(near), close.shape[1])
        if not len(query):
            return
        query = which[query]
        score = np.empty(len(query))
        block = max(1, _SLICE_CELLS // rows.shape[1])
        for at in range(0, len(query), block):
            q, c = query[at : at + block], column[at : at + block]
            score[at : at + block] = pair_scores(self.queries[q], rows[c], self.metric)
        self._merge(query, ids[column], score)

    def _merge(self, query: np.ndarray, row_id: np.ndarray, score: np.ndarray) -> None:
        """Take rows into the state of the queries that they are offered to, and no other."""
        some = np.unique(query)
        at, place = np.nonzero(self._filled(some))
        query = np.concatenate([some[at], query])
        row_id = np.concatenate([self._ids[some[at], place], row_id])
        score = np.concatenate([self._scores[some[at], place], score])
        order = np.lexsort((row_id, score if self.metric == "l2" else -score, query))
        query, row_id, score = query[order], row_id[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        kept = place < self.k
        query, row_id, score, place = query[kept], row_id[kept], score[kept], place[kept]
        self._ids[query, place], self._scores[query, place] = row_id, score
        last = np.flatnonzero(np.diff(query, append=-1))
        self._held[query[last]] = place[last] + 1
        full = last[place[last] == self.k - 1]
        self.bar[query[full]] = -(score[full] ** 2) if self.metric == "l2" else score[full]
