"""Sparse matrices in compressed rows, by hand: transposition and Gustavson's row products."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from basketry.llm._text import ragged


@dataclass(frozen=True)
class Csr:
    """Row ``i`` has ``values[starts[i]:starts[i + 1]]`` in the ascending ``columns`` of the same range."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.height), np.diff(self.starts))


def from_entries(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, height: int, width: int) -> Csr:
    """Entries in any order; those of one place are added."""
    key = rows.astype(np.int64) * width + columns
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(values[order], first) if len(key) else values[:0]
    rows, columns = np.divmod(key[first], max(width, 1))
    starts = np.searchsorted(rows, np.arange(height + 1))
    return Csr(starts, columns, total, width)


def intervals(begin: np.ndarray, end: np.ndarray, width: int) -> Csr:
    """One row for each interval, with ones in the columns it covers."""
    lengths = end - begin
    starts = np.append(0, np.cumsum(lengths))
    return Csr(starts, ragged(begin, lengths), np.ones(int(starts[-1]), np.int64), width)


def units(column: np.ndarray, width: int) -> Csr:
    """One row for each entry of ``column``, with a one there."""
    return Csr(np.arange(len(column) + 1), np.asarray(column, np.int64), np.ones(len(column), np.int64), width)


def transpose(m: Csr) -> Csr:
    return from_entries(m.columns, m.rows(), m.values, m.width, m.height)


def multiply(a: Csr, b: Csr) -> Csr:
    """Gustavson's product: row ``i`` is the sum of ``b``'s rows ``k``, weighted by ``a[i, k]``; no zero is touched."""
    first, lengths = b.starts[a.columns], np.diff(b.starts)[a.columns]
    at = ragged(first, lengths)
    values = np.repeat(a.values, lengths) * b.values[at]
    return from_entries(np.repeat(a.rows(), lengths), b.columns[at], values, a.height, b.width)
