"""The best scores of a batch of queries, kept while blocks of candidates go by."""

from __future__ import annotations

import numpy as np

NO_ID = (1 << 63) - 1  # a null id comes after all others


class Best:
    """Per query the ``k`` entries (score, id) of highest score, equal scores by ascending id.

    Only entries better than (floor, floor_id) of their query are kept; places without an entry hold that
    floor, so the last place is always what a candidate must beat.
    """

    def __init__(self, n: int, k: int, floor, floor_id):
        self.floor = np.broadcast_to(np.asarray(floor, np.int64), n)
        self.floor_id = np.broadcast_to(np.asarray(floor_id, np.int64), n)
        self.score = np.repeat(self.floor[:, None], k, axis=1)
        self.id = np.repeat(self.floor_id[:, None], k, axis=1)

    @property
    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def offer(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` has a row for each of ``queries`` and a column for each of ``ids``."""
        last, last_id = self.score[queries, -1, None], self.id[queries, -1, None]
        better = (scores > last) | ((scores == last) & (ids < last_id))
        k = self.score.shape[1]
        for i in np.flatnonzero(better.any(axis=1)).tolist():
            q, at = queries[i], np.flatnonzero(better[i])
            s, d = np.append(self.score[q], scores[i, at]), np.append(self.id[q], ids[at])
            order = np.lexsort((d, -s))[:k]
            self.score[q], self.id[q] = s[order], d[order]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of all entries kept."""
        real = (self.score > self.floor[:, None]) | (self.id < self.floor_id[:, None])
        query = np.nonzero(real)[0]
        return query, self.id[real], self.score[real]
