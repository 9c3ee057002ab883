"""Numpy helpers used inside tasks: unit vectors and running top-k per query."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SCORE_DIGITS = 6
QUERY_BLOCK = 1024
VECTOR_BLOCK = 4096
PENDING_ROWS = 1_000_000
CROWD = 4


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """List column as a double matrix; all lists must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if n == 0:
        return flat.reshape(0, 0)
    if len(flat) % n or not (np.diff(column.offsets.to_numpy()) == len(flat) // n).all():
        raise ValueError("vectors differ in dimension")
    return flat.reshape(n, -1)


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row stays zero and scores 0 with everything."""
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def ids_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False)


def _true_places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every true value (faster than ``nonzero`` on a sparse matrix)."""
    return np.divmod(np.flatnonzero(mask), mask.shape[1])


class TopK:
    """The best ``k`` vectors per query over all blocks added; ties go to the smaller id.

    Holds ``k`` entries per query plus a bounded list of pending ones, whatever the
    number of vectors that pass through, and takes a few times ``k`` per query from any
    block at most, also where a block is full of copies that tie. Single precision sorts out
    what cannot reach a query's floor; what may is scored in double precision. ``floor`` gives, per
    query, a score that ``k`` vectors elsewhere are known to have: what is below it is left out.
    """

    def __init__(
        self, query_ids: np.ndarray, queries: np.ndarray, k: int, skip_self: bool = False, floor: np.ndarray | None = None
    ):
        self.query_ids, self.queries, self.k, self.skip_self = query_ids, unit(queries), k, skip_self
        self.single = self.queries.astype(np.float32)
        # Largest error of a single-precision product of unit vectors, and of rounding.
        self.slack = np.float32(1e-6 + 1.5e-7 * queries.shape[1])
        self.floor = np.full(len(query_ids), -np.inf) if floor is None else np.array(floor, np.float64)
        self.kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Score the vectors against all queries, or against query ``rows`` only."""
        if len(ids) == 0 or len(self.query_ids) == 0:
            return
        rows = np.arange(len(self.query_ids)) if rows is None else rows
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], unit(vectors)[order]
        single = vectors.astype(np.float32)
        for v in range(0, len(ids), VECTOR_BLOCK):
            part = slice(v, v + VECTOR_BLOCK)
            for q in range(0, len(rows), QUERY_BLOCK):
                self._score(rows[q : q + QUERY_BLOCK], ids[part], vectors[part], single[part])

    def _score(self, rows: np.ndarray, ids: np.ndarray, block: np.ndarray, single: np.ndarray) -> None:
        rough = self.single[rows] @ single.T
        own = None
        if self.skip_self:
            _, *own = np.intersect1d(self.query_ids[rows], ids, return_indices=True)
            rough[tuple(own)] = -np.inf
        may = rough >= (self.floor[rows] - self.slack).astype(np.float32)[:, None]
        if own is not None:
            may[tuple(own)] = False
        if CROWD * np.count_nonzero(may) <= may.size:
            q, v = _true_places(may)
            crowded = np.bincount(q, minlength=len(rows)) > CROWD * self.k
            if crowded.any():
                apart = ~crowded[q]
                q, v = q[apart], v[apart]
        else:  # full: counted before the places are listed
            crowded = np.count_nonzero(may, axis=1) > CROWD * self.k
            q, v = _true_places(may & ~crowded[:, None] if crowded.any() else may)
        exact = np.round(np.einsum("ij,ij->i", self.queries[rows[q]], block[v]), SCORE_DIGITS) + 0.0
        high = exact >= self.floor[rows[q]]
        self._keep(rows[q[high]], ids[v[high]], exact[high])
        if crowded.any():
            self._score_crowded(rows[crowded], ids, block, may[crowded])

    def _score_crowded(self, rows: np.ndarray, ids: np.ndarray, block: np.ndarray, may: np.ndarray) -> None:
        """Rows with many candidates in a block, whose columns are in order of id."""
        scores = np.where(may, np.round(self.queries[rows] @ block.T, SCORE_DIGITS) + 0.0, -np.inf)
        cut = scores.shape[1] - self.k
        kth = np.partition(scores, cut, axis=1)[:, cut]
        above, level = scores > kth[:, None], scores == kth[:, None]
        room = self.k - np.count_nonzero(above, axis=1)
        keep = above | (level & (np.cumsum(level, axis=1, dtype=np.int32) <= room[:, None]))
        self.floor[rows] = np.maximum(self.floor[rows], kth)
        q, v = _true_places(keep)
        self._keep(rows[q], ids[v], scores[q, v])

    def _keep(self, row: np.ndarray, vid: np.ndarray, score: np.ndarray) -> None:
        self.kept.append((row, vid, score))
        self.pending += len(row)
        if self.pending > PENDING_ROWS:
            self._compact()

    def _compact(self) -> None:
        if not self.kept:
            return
        row, vid, score = (np.concatenate(p) for p in zip(*self.kept, strict=True))
        _, id_rank = np.unique(vid, return_inverse=True)
        order = np.lexsort((id_rank, -score, row))
        row, vid, score = row[order], vid[order], score[order]
        first = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
        start = np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
        place = np.arange(len(row)) - start
        best = place < self.k
        row, vid, score, place = row[best], vid[best], score[best], place[best]
        last = place == self.k - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], score[last])
        self.kept, self.pending = [(row, vid, score)], 0

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, vector id, score) of what is left, at most ``k`` per query."""
        self._compact()
        if not self.kept:
            return self.query_ids[:0], self.query_ids[:0], np.zeros(0)
        row, vid, score = self.kept[0]
        return self.query_ids[row], vid, score


def best_cells(vectors: np.ndarray, centroids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` nearest cells of each vector and their rounded scores, ties to the lower cell."""
    scores = np.round(unit(vectors) @ centroids.T, SCORE_DIGITS) + 0.0
    cells = np.argsort(-scores, axis=1, kind="stable")[:, :n]
    return cells, np.take_along_axis(scores, cells, axis=1)
