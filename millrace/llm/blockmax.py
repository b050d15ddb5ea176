"""Exact nearest neighbours by cosine over an inverted index with block maxima."""

from __future__ import annotations

import numpy as np

BLOCK = 64
_AT_ONCE = 256
_RARE_AT_ONCE = 8
_POSTING = np.dtype([("row", np.int32), ("weight", np.float32)])
#: Terms in more than one of so many vectors are kept as full rows, the others as postings.
_COMMON = 16


class Rows:
    """Sparse rows: columns ``at`` and values ``data`` of row i from ends[i] to ends[i + 1]."""

    def __init__(self, ends: np.ndarray, at: np.ndarray, data: np.ndarray, width: int):
        self.ends, self.at, self.data, self.width = ends, at, data, width

    @classmethod
    def of(cls, dense) -> Rows:
        if isinstance(dense, Rows):
            return dense
        row, at = np.nonzero(dense)
        return cls(np.searchsorted(row, np.arange(len(dense) + 1)), at, dense[row, at].astype(np.float32), dense.shape[1])

    def __len__(self) -> int:
        return len(self.ends) - 1

    def take(self, which: np.ndarray) -> Rows:
        sizes = np.diff(self.ends)[which]
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        from_ = np.repeat(self.ends[:-1][which] - ends[:-1], sizes) + np.arange(ends[-1])
        return Rows(ends, self.at[from_], self.data[from_], self.width)

    def row_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.ends))

    def toarray(self) -> np.ndarray:
        out = np.zeros((len(self), self.width), np.float32)
        out[self.row_numbers(), self.at] = self.data
        return out


class BlockMaxIndex:
    """Unit vectors in blocks; per term its postings, and for common terms each block's largest weight.

    A query's rare terms are scored through their postings. Its upper bound for a
    block is the best of these scores in the block plus the sum of its weights of
    common terms times the block maxima. The best block by bound is scored first,
    then every block whose bound reaches the k-th best similarity found: the
    neighbours are exact. Vectors and queries are ``Rows`` or arrays.
    """

    def __init__(self, vectors, block: int = BLOCK):
        vectors = Rows.of(vectors)
        count, terms = len(vectors), vectors.width
        # Alike vectors side by side make the maxima tight.
        strongest = np.array([vectors.at[i + vectors.data[i:j].argmax()] if j > i else 0 for i, j in zip(vectors.ends, vectors.ends[1:])], int)
        self.order = np.lexsort((np.arange(count), strongest))
        self.count, self.terms, self.block = count, terms, block
        arranged = vectors.take(self.order)
        row = arranged.row_numbers()
        many = np.bincount(arranged.at, minlength=terms) * _COMMON > count
        self.common = np.full(terms, -1)
        self.common[many] = np.arange(many.sum())
        own = many[arranged.at]
        self.full = np.zeros((int(many.sum()), count), np.float32)
        self.full[self.common[arranged.at[own]], row[own]] = arranged.data[own]
        self.starts = np.arange(0, count, block)
        self.maxima = np.maximum.reduceat(self.full, self.starts, axis=1) if count else self.full
        by_term = np.argsort(arranged.at[~own], kind="stable")
        self.postings = np.empty(len(by_term), _POSTING)
        self.postings["row"], self.postings["weight"] = row[~own][by_term], arranged.data[~own][by_term]
        self.first = np.searchsorted(arranged.at[~own][by_term], np.arange(terms + 1))
        self.lengths = np.diff(self.first)

    def search(self, queries, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Similarities and positions of the k best for each query, the best first; ties by position."""
        queries = Rows.of(queries)
        k = min(k, self.count)
        best = np.full((len(queries), k), -1.0, np.float32)
        places = np.full((len(queries), k), self.count, np.int64)
        if k:
            for at in range(0, len(queries), _AT_ONCE):
                rows = np.arange(at, min(at + _AT_ONCE, len(queries)))
                best[rows], places[rows] = self._search(queries.take(rows), k)
        return best, places

    def _rare(self, queries: Rows) -> np.ndarray:
        """Similarities by rare terms. A few queries at a time, in the same buffers, stay in the processor's cache."""
        out = np.empty((len(queries), self.count), np.float32)
        held = np.flatnonzero(self.lengths[queries.at])
        terms, data = queries.at[held], queries.data[held]
        lengths = self.lengths[terms]
        before = self.first[terms]
        starts = np.arange(0, len(queries), _RARE_AT_ONCE)
        groups = np.searchsorted(held, queries.ends[np.append(starts, len(queries))])
        cells = (queries.row_numbers()[held] % _RARE_AT_ONCE) * self.count
        most = max((int(lengths[i:j].sum()) for i, j in zip(groups, groups[1:])), default=0)
        steps, places, taken, products = np.arange(most), np.empty(most, np.int64), np.empty(most, np.int64), np.empty(most)
        for start, i, j in zip(starts, groups, groups[1:]):
            n, rows = lengths[i:j], min(_RARE_AT_ONCE, len(queries) - start)
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            place, product = places[:total], products[:total]
            np.add(np.repeat(before[i:j] - ends + n, n), steps[:total], out=place)
            found = np.take(self.postings.view(np.int64), place, out=taken[:total], mode="clip").view(_POSTING)
            np.add(np.repeat(cells[i:j], n), found["row"], out=place)
            np.multiply(np.repeat(data[i:j], n), found["weight"], out=product)
            out[start:start + rows] = np.bincount(place, product, rows * self.count).reshape(rows, self.count)
        return out

    def _search(self, queries: Rows, k: int) -> tuple[np.ndarray, np.ndarray]:
        many, rare = len(queries), self._rare(queries)
        common = np.zeros((many, len(self.full)), np.float32)
        own = self.common[queries.at] >= 0
        common[queries.row_numbers()[own], self.common[queries.at[own]]] = queries.data[own]
        bounds = common @ self.maxima + np.maximum.reduceat(rare, self.starts, axis=1)
        found = np.full((many, self.count), -1.0, np.float32)

        def look(b: int, at: np.ndarray) -> None:
            part = slice(b * self.block, (b + 1) * self.block)
            found[at, part] = rare[at, part] + common[at] @ self.full[:, part]

        foremost = bounds.argmax(axis=1)
        for b in np.unique(foremost):
            look(b, np.flatnonzero(foremost == b))
        # What a block must promise: the k-th best so far, less than any block could hide behind rounding.
        least = np.partition(found, self.count - k, axis=1)[:, self.count - k]
        wanted = bounds + 2e-5 >= least[:, None]
        wanted[np.arange(many), foremost] = False
        for b in np.flatnonzero(wanted.any(axis=0)):
            look(b, np.flatnonzero(wanted[:, b]))
        rounded = np.round(found, 5)
        least = np.partition(rounded, self.count - k, axis=1)[:, self.count - k]
        row, col = np.nonzero(rounded >= least[:, None])
        names = self.order[col]
        pick = np.lexsort((names, -rounded[row, col], row))
        first = np.searchsorted(row, np.arange(many))
        pick = pick[first[:, None] + np.arange(k)]
        return found[row[pick], col[pick]], names[pick]
