"""Periodic runs of words, found by block convolution.

A run is a stretch of consecutive words with smallest period q and a length of at least max(12, 2 q) that no neighbouring word
extends with the same period. At each scale L = 2, 4, 8, ... the words of many documents are cut into blocks of L words.
A run of period 2 L <= q < 4 L (scale 2 also takes shorter periods) holds some whole block together with its copy q words
further on, so it shows as a zero of the sum of squared differences between that block and the stretch at distance q. These
sums are taken for all distances at once by a number-theoretic transform over the integers modulo a prime: sum x^2 + sum y^2 - 2 sum xy. Every zero is a
seed that is extended to both sides by comparing the words themselves, so a false zero modulo the prime costs a comparison
and nothing else, and a true one is never missed.

The transform is a matrix product in doubles over centred residues whose sums stay below 2^53, hence exact; longer ones are done in two
steps of a power of two each. Texts are worked on in slices of bounded size, a long text alone, and its blocks some at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import words
from parcelflow.llm.common import releasing, slices

# fixed values of the transform: prime = 7 * 2^20 + 1 and a generator of its units
PRIME, GENERATOR = 7_340_033, 3
LARGEST = 1 << 19  # words of the largest block; longer periods take more distances of such blocks
STEP = 128  # transforms up to this size are one matrix product
LEAST = 12  # words of the shortest run
CHUNK = 1 << 15  # words whose blocks are transformed at a time
SLICE_BYTES = 1 << 22
_HALF = PRIME // 2


def _reduced(x: np.ndarray) -> np.ndarray:
    """Residues near zero of whole numbers below 2^53 in doubles, in place."""
    x -= np.rint(x * (1.0 / PRIME)) * PRIME
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """Centred powers 0 to n - 1."""
    out = np.ones(1, np.int64)
    step = base
    while len(out) < n:
        out = np.concatenate((out, out * step % PRIME))
        step = step * step % PRIME
    out = out[:n]
    return np.where(out > _HALF, out - PRIME, out).astype(np.float64)


@lru_cache(maxsize=64)
def _matrix(n: int, inverse: bool) -> np.ndarray:
    root = pow(GENERATOR, (PRIME - 1) // n * (-1 if inverse else 1), PRIME)
    powers = _powers(root, n)
    return powers[np.outer(np.arange(n), np.arange(n)) % n]


@lru_cache(maxsize=64)
def _twiddles(a: int, b: int, inverse: bool) -> np.ndarray:
    n = a * b
    powers = _powers(pow(GENERATOR, (PRIME - 1) // n * (-1 if inverse else 1), PRIME), n)
    return powers[np.outer(np.arange(a), np.arange(b)) % n]


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two of residues near zero); the inverse lacks the division by the size."""
    rows, n = x.shape
    if n <= STEP:
        return _reduced(x @ _matrix(n, inverse))
    a = 1 << ((n.bit_length() - 1) // 2)
    b = n // a
    # index i = i1 b + i2, frequency k = k1 + k2 a: rows of i1 first, twiddles, then rows of i2
    y = transform(x.reshape(rows, a, b).transpose(0, 2, 1).reshape(rows * b, a), inverse).reshape(rows, b, a)
    y = _reduced(y * _twiddles(b, a, inverse))
    z = transform(y.transpose(0, 2, 1).reshape(rows * a, b), inverse).reshape(rows, a, b)
    return z.transpose(0, 2, 1).reshape(rows, n)


def zeros(codes: np.ndarray, size: int, offsets: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block, distance) where a block of codes equals the stretch that many words further on, modulo the prime.

    codes are residues near zero whose number is a multiple of size. Distances run from j * size to (j + 1) * size - 1 for each j in offsets.
    """
    blocks = len(codes) // size
    width, reach = 2 * size, max(offsets) + 2
    scale = pow(width, -1, PRIME)
    scale = float(scale - PRIME if scale > _HALF else scale)
    sign = np.where(np.arange(width) % 2, -1.0, 1.0)
    squares = np.concatenate(([0.0], np.cumsum(codes * codes % PRIME) % PRIME))
    step = max(8, CHUNK // size)
    for start in range(0, blocks, step):
        end = min(blocks, start + step)
        cut = np.zeros((end + reach - start, width))
        part = codes[start * size : (end + reach) * size].reshape(-1, size)
        cut[: len(part), :size] = part
        front = transform(cut)  # of each block alone
        n = end - start
        back = np.concatenate((front[:n, :1], front[:n, :0:-1]), 1)  # of the block read backwards
        back = _reduced(back * scale)
        own = squares[(np.arange(start, end) + 1) * size] - squares[np.arange(start, end) * size]
        for j in offsets:
            window = front[j : j + n] + sign * front[j + 1 : j + 1 + n]  # of two blocks side by side
            products = transform(_reduced(back * window), inverse=True)[:, :size]
            at = np.minimum(((np.arange(start, end) + j) * size)[:, None] + np.arange(size), len(codes))
            theirs = squares[np.minimum(at + size, len(codes))] - squares[at]
            block, shift = np.nonzero(_reduced(own[:, None] + theirs - 2 * products) == 0)
            inside = at[block, shift] + size <= len(codes)
            yield block[inside] + start, shift[inside] + j * size


def _extended(ids: np.ndarray, first: np.ndarray, last: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many words beyond `last` (step 1) or before `first` (step -1) go on with the period."""
    grown = np.zeros(len(period), np.int64)
    open_ = np.arange(len(period))
    width = 4
    n = len(ids)
    while len(open_):
        span = np.arange(width)
        i = (last[open_] + grown[open_])[:, None] + 1 + span if step > 0 else (first[open_] - grown[open_])[:, None] - 1 - span
        other = i - period[open_][:, None] if step > 0 else i + period[open_][:, None]
        fine = (i >= 0) & (i < n) & (other >= 0) & (other < n)
        same = fine & (ids[np.where(fine, i, 0)] == ids[np.where(fine, other, 0)])
        upto = np.where(same.all(1), width, np.argmin(same, 1))
        grown[open_] += upto
        open_ = open_[upto == width]
        width = min(2 * width, 1 << 12)
    return grown


def find(ids: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run in stretches of word numbers, ordered by start and period; starts count from the first word of all.

    Stretch k has the words offsets[k] to offsets[k + 1]. Runs do not reach over its ends.
    """
    sizes = np.diff(offsets)
    found: list[np.ndarray] = []  # rows of start, end, period
    size = 2
    draw = np.random.default_rng(0)
    residues = draw.integers(-_HALF, _HALF, int(ids.max()) + 1 if len(ids) else 1).astype(np.float64)
    while True:
        smallest = 1 if size == 2 else 2 * size
        taking = np.flatnonzero(sizes >= max(least, 2 * smallest))
        if not len(taking):
            break
        # the stretches that can hold such periods, each followed by a word that equals no other
        lengths = sizes[taking] + 1
        starts = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        padded = -(-total // size) * size
        ids_here, codes = np.empty(padded, np.int64), np.empty(padded)
        plain = np.ones(padded, bool)
        plain[starts + lengths - 1] = False
        plain[total:] = False
        source = words.gathered(offsets[:-1][taking], sizes[taking])
        ids_here[plain], codes[plain] = ids[source], residues[ids[source]]
        odd = np.flatnonzero(~plain)
        ids_here[odd], codes[odd] = -1 - np.arange(len(odd)), draw.integers(-_HALF, _HALF, len(odd))
        longest = int(sizes[taking].max()) // 2
        if size < LARGEST:
            distances = [0, 1, 2, 3] if size == 2 else [2, 3]
        else:
            distances = list(range(2, longest // size + 1))
        known = _known(found, size, starts, offsets[:-1][taking])
        rows = [_seeds(ids_here, block * size, shift, size, known) for block, shift in zeros(codes, size, distances)]
        here = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
        if len(here):
            here = np.unique(here, axis=0)
            which = np.searchsorted(starts, here[:, 0], "right") - 1
            here[:, :2] += (offsets[:-1][taking][which] - starts[which])[:, None]
            found.append(here)
        if size == LARGEST:
            break
        size *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    fresh = np.ones(len(every), bool)  # of equal stretches the smallest period
    fresh[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
    every = every[fresh]
    length = every[:, 1] - every[:, 0]
    good = length >= np.maximum(least, 2 * every[:, 2])
    every, length = every[good], length[good]
    order = np.lexsort((every[:, 2], every[:, 0]))
    return every[order, 0], length[order], every[order, 2]


def _known(found: list[np.ndarray], size: int, starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Runs of smaller scales that may explain seeds of this one, in its own counting, by start.

    Two of them share fewer words than their periods together, so a stretch of three blocks lies in one at most.
    """
    if not found:
        return np.zeros((0, 3), np.int64)
    every = np.concatenate(found)
    every = every[(every[:, 2] <= size) & (every[:, 1] - every[:, 0] >= 3 * size)]
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    first = np.ones(len(every), bool)
    first[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
    every = every[first]
    order = np.argsort(places)
    which = order[np.searchsorted(places[order], every[:, 0], "right") - 1]
    every[:, :2] += (starts[which] - places[which])[:, None]
    return every[np.argsort(every[:, 0], kind="stable")]


def _seeds(ids: np.ndarray, at: np.ndarray, period: np.ndarray, size: int, known: np.ndarray) -> np.ndarray:
    """(start, end, period) of the stretches that zeros of blocks at these places grow to."""
    real = period > 0
    at, period = at[real], period[real]
    if len(known) and len(at):
        k = np.maximum(np.searchsorted(known[:, 0], at, "right") - 1, 0)
        covered = (known[k, 0] <= at) & (at + size + period <= known[k, 1]) & (period % known[k, 2] == 0)
        at, period = at[~covered], period[~covered]
    if not len(at):
        return np.zeros((0, 3), np.int64)
    # neighbouring blocks with the same distance are one seed
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    begins = np.ones(len(at), bool)
    begins[1:] = (period[1:] != period[:-1]) | (at[1:] != at[:-1] + size)
    opening = np.flatnonzero(begins)
    first, period = at[opening], period[opening]
    last = at[np.append(opening[1:], len(at)) - 1] + size - 1
    true = ids[first] == ids[first + period]  # a false zero of a short block is told here; every word is compared below
    first, last, period = first[true], last[true], period[true]
    # words first .. last equal those `period` further on; check all of them, then go on to both sides
    whole = _matching(ids, first, last, period)
    first, last, period = first[whole], last[whole], period[whole]
    right = _extended(ids, first, last + period, period, 1)
    left = _extended(ids, first, last, period, -1)
    return np.stack((first - left, last + period + right + 1, period), 1).astype(np.int64)


def _matching(ids: np.ndarray, first: np.ndarray, last: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether all words from first to last equal those `period` further on."""
    out = np.ones(len(first), bool)
    lengths = last - first + 1
    start = 0
    while start < len(first):
        upto = np.cumsum(lengths[start:])
        end = start + max(1, int(np.searchsorted(upto, 1 << 21, "right")))
        i = words.gathered(first[start:end], lengths[start:end])
        same = ids[i] == ids[i + np.repeat(period[start:end], lengths[start:end])]
        out[start:end] = np.logical_and.reduceat(same, np.cumsum(lengths[start:end]) - lengths[start:end])
        start = end
    return out


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


SCHEMA = (
    "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
    "runs_sha256 string, collapsed string"
)


def _described(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "t", SLICE_BYTES):
        tokens, offsets = words.split(batch.column("t"))
        ids, distinct = words.numbered(tokens)
        start, length, period = find(ids, offsets, least)
        doc = np.searchsorted(offsets, start, "right") - 1
        # words dropped: those of a run after its first period
        change = np.zeros(len(ids) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        kept = np.cumsum(change[:-1]) == 0
        start = start - offsets[doc]
        per_doc = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))))
        structs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
        lines = [b"%d,%d,%d\n" % row for row in zip(start.tolist(), length.tolist(), period.tolist())]
        empty = _digest(b"")
        digests = [_digest(b"".join(lines[a:b])) if b > a else empty for a, b in zip(per_doc[:-1].tolist(), per_doc[1:].tolist())]
        counted = np.concatenate(([0], np.cumsum(kept)))[offsets]
        rest = pa.LargeListArray.from_arrays(pa.array(counted), distinct.take(pa.array(ids[kept])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(per_doc.astype(np.int32)), structs), pa.array(digests), _joined(rest)],
            ["doc_id", "n_words", "runs", "runs_sha256", "collapsed"])


def _joined(lists: pa.Array) -> pa.Array:
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string())


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, runs_sha256, collapsed) of every row of docs.

    runs are all runs by start and period. runs_sha256 digests a line `start,length,period` for each. collapsed is the text with one space between words
    and each run cut down to its first period: a word goes if any run holds it after the run's first `period` words.
    Null and empty texts have no words and no runs; repeated rows all come back; ids may be null; other columns are not read.
    One pass without a shuffle: a text's words lie in one task, a bounded number of texts at a time.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))

    def run(batches):
        yield from _described(batches, least)

    return rows.mapInArrow(releasing(run), SCHEMA)
