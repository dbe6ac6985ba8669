"""Periodic runs: maximal stretches of words that repeat with a period at least three times.

Two words ``q`` apart agree all along a run of period ``q``. Such a run of length
``3 q`` or more holds a multiple ``x`` of ``q`` from which on at least ``q + 1`` words
agree with those ``q`` later, so all runs are found at the points ``x = q, 2 q, ...`` of
every ``q``, a harmonic number of pairs. A pair whose probes agree is measured
by longest common extensions, forwards and, in the reversed text, backwards:

* Of each block of ``V`` positions the ones in a difference cover are sampled.
  Only sampled suffixes are sorted: by ``V`` words, then by doubled lengths.
* Any two positions reach samples within ``V`` words at equal distances: so many
  words are compared one by one.
* The rest is the least common prefix between the two in sorted order, from
  a sparse table.

The sort happens only in texts where a pair got that far. Multiples of a period
find the same stretch; the least period stays.

A text is worked on whole in one row of Arrow batches; memory grows with its
words only, as pairs are taken ``PAIRS`` at a time. Null and empty texts have no
words and no runs; texts shorter than the least length have no runs. Ties,
repeated rows, null ids: each row has its own result. An empty table gives an
empty one. Columns of the input named like the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import sliced
from .shipping import ship

ship(__name__)

# A perfect difference set; every distance modulo V is one between two of its members.
V, COVER = 31, (1, 5, 11, 24, 25, 27)
PAIRS = 1 << 20
ADDED = ("runs", "run_words", "collapsed")

_SLOT = np.full(V, -1)
_SLOT[list(COVER)] = np.arange(len(COVER))
_IN = _SLOT >= 0
#: Steps from residues (a, b) to the next two positions that are both sampled.
SYNC = np.array([[next(d for d in range(V) if _IN[(a + d) % V] and _IN[(b + d) % V]) for b in range(V)] for a in range(V)])


class Extensions:
    """Longest common extensions of pairs of suffixes of one sequence of numbers from 1 on."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.codes = np.concatenate([codes.astype(np.int64), np.zeros(2 * V, dtype=np.int64)])
        self.ready = False

    def _sort(self) -> None:
        self.at = np.flatnonzero(_IN[np.arange(self.n) % V])
        m, per = len(self.at), len(COVER)
        bits = int(self.codes.max()).bit_length()
        pack = max(1, 62 // bits)
        keys = []
        for k in range(0, V, pack):
            key = np.zeros(m, dtype=np.int64)
            for j in range(k, min(V, k + pack)):
                key = (key << bits) | self.codes[self.at + j]
            keys.append(key)
        rank, order = _ranked(keys)
        levels, shift = [rank], per
        while m and rank[order[-1]] < m - 1:
            after = np.zeros(m, dtype=np.int64)
            after[:max(m - shift, 0)] = rank[shift:] + 1
            rank, order = _ranked([rank, after])
            levels.append(rank)
            shift *= 2
        self.rank = rank
        common = np.zeros(max(m - 1, 0), dtype=np.int64)
        a, b = order[:-1].copy(), order[1:].copy()
        for k in reversed(range(len(levels) - 1)):
            inside = np.flatnonzero((a < m) & (b < m))
            same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
            common[same] += V << k
            a[same] += per << k
            b[same] += per << k
        where = np.append(self.at, self.n)
        common += self._compared(where[np.minimum(a, m)], where[np.minimum(b, m)], np.full(len(a), V))
        self.table = [common]
        while (width := 1 << len(self.table)) <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-(width // 2)], last[width // 2:]))
        self.ready = True

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words in common one by one, up to ``most``."""
        found = np.zeros(len(i), dtype=np.int64)
        open_ = np.arange(len(i))
        for step in range(int(most.max(initial=0))):
            open_ = open_[most[open_] > step]
            open_ = open_[self.codes[i[open_] + step] == self.codes[j[open_] + step]]
            if not len(open_):
                break
            found[open_] += 1
        return found

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each pair of different positions up to ``n``."""
        steps = SYNC[i % V, j % V]
        found = self._compared(i, j, steps)
        far = np.flatnonzero((found == steps) & (np.maximum(i, j) + steps < self.n))
        if not len(far):
            return found
        if not self.ready:
            self._sort()
        per = len(COVER)
        a, b = (self.rank[(p // V) * per + _SLOT[p % V]] for p in (i[far] + steps[far], j[far] + steps[far]))
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        more = np.empty(len(far), dtype=np.int64)
        for k in np.unique(level):
            of = level == k
            more[of] = np.minimum(self.table[k][low[of]], self.table[k][high[of] - (1 << int(k))])
        found[far] += more
        return found


def _ranked(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks by the keys, the first one foremost, and the order."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), dtype=bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new)
    return rank, order


def _grid(n: int, q_from: int, q_to: int) -> tuple[np.ndarray, np.ndarray]:
    """All (x, q) with x a multiple of q, from 0 on, and x + 2 q in the text."""
    q = np.arange(q_from, q_to)
    counts = (n - 1) // q - 1
    period = np.repeat(q, counts)
    return (np.arange(len(period)) - np.repeat(np.cumsum(counts) - counts, counts)) * period, period


def find_runs(codes: np.ndarray, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period; ``codes`` are word numbers from 1 on.

    A run has its least period, a length of at least ``least`` words and of ``times`` periods (3 or more), and is maximal.
    """
    if times < 3:
        raise ValueError("the grid finds runs of three periods or more")
    n = len(codes)
    if n < max(least, times):
        return []
    forward = Extensions(codes)
    backward: Extensions | None = None
    found = []
    sizes = np.cumsum((n - 1) // np.arange(1, n // times + 1) - 1)
    q = 1
    while q <= n // times:
        stop = max(q + 1, int(np.searchsorted(sizes, (sizes[q - 2] if q > 1 else 0) + PAIRS)) + 1)
        stop = min(stop, n // times + 1)
        x, period = _grid(n, q, stop)
        q = stop
        for probe in (lambda x, p: x, lambda x, p: x + p, lambda x, p: x + p // 2):
            at = probe(x, period)
            same = codes[at] == codes[at + period]
            x, period = x[same], period[same]
        ahead = forward.of(x, x + period)
        wide = ahead > period
        x, period, ahead = x[wide], period[wide], ahead[wide]
        if not len(x):
            continue
        backward = backward or Extensions(codes[::-1])
        behind = backward.of(n - x, n - x - period)
        length = behind + period + ahead
        long = length >= np.maximum(least, times * period)
        found.append(np.stack([x - behind, length, period])[:, long])
    if not found:
        return []
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    runs = zip(start[first].tolist(), length[first].tolist(), period[first].tolist(), strict=True)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    names: dict[bytes, int] = {}
    return np.array([names.setdefault(w, len(names) + 1) for w in words], dtype=np.int64)


def periodic_runs(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, least: int = 24, times: int = 3) -> DataFrame:
    """``keep`` (all columns), ``runs`` (start, length, period), ``run_words`` and ``collapsed``.

    ``collapsed`` are the words that no run holds behind its first period, joined by one space.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ADDED]
    own = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("__run_text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, texts, found = [], [], []
        for value in batch.column(len(kept)):
            words = value.as_py().split()
            runs = find_runs(numbered(words), least, times) if len(words) >= least else []
            sizes.append(len(words))
            found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
            if runs:
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                for s, n, p in runs:
                    edges[s + p] += 1
                    edges[s + n] -= 1
                words = [w for w, gone in zip(words, (np.cumsum(edges) > 0).tolist(), strict=False) if not gone]
            texts.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:len(kept)], pa.array(found, pa.list_(run)), pa.array(sizes, pa.int64()), pa.array(texts, pa.binary())], names=[*kept, *ADDED])
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields[:-1])
    done = own.mapInArrow(sliced("__run_text", lambda: rows),
                          f"{kinds}runs array<struct<start: long, length: long, period: long>>, run_words long, collapsed binary")
    return done.withColumn("collapsed", F.col("collapsed").cast("string"))
