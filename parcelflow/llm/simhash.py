"""Near-duplicate groups by SimHash with bit-sliced comparison.

Fingerprints are made of hashed word shingles in one pass over the text. Only distinct fingerprints are compared. The 64
bits are cut into radius + 2 blocks; two fingerprints within the radius agree in at least two blocks whole, so each
fingerprint goes into one bucket per pair of blocks. A bucket that holds more than `most` fingerprints is split
again by pairs of sub-blocks of the bits that its key leaves open; what remains below two keys is bounded by the number of
values of the open bits (65,536 at radius 2), however many copies a group has.

Inside buckets fingerprints are stored as bit planes: one 64-bit word holds the same bit of 64 fingerprints. A lane compares
one fingerprint with one such block of 64; its differences are counted for all 64 at once by carry-save counters, and
lanes whose 64 counts all exceed the radius are abandoned. Buckets pass on spanning links only, never all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import byte_column, components, every_column, partitions, releasing, slices, text_batches, unused
from parcelflow.session import materialise

BITS = 64
LANES = 1 << 12
CHECK_EVERY = 8  # planes between two looks for lanes to abandon
ALL = np.uint64(2**64 - 1)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a UTF-8 text: A-Z lower-cased, words between white space, shingles with repeats; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    if len(words) <= shingle:
        pairs = [(0, len(line))]
    else:
        pairs = zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], seed) for a, b in pairs], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 8192):
        part = hashes[i : i + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist())


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long. Null and blank texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", 1 << 23):
            values, offsets = byte_column(batch.column("t"))
            data, cuts = values.tobytes(), offsets.tolist()
            found = np.fromiter((fingerprint(data[a:b], shingle, seed) for a, b in zip(cuts, cuts[1:])), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
    return source.mapInArrow(releasing(run), "doc_id bigint, fp bigint")


def _widths(bits: int, parts: int) -> list[int]:
    return [bits // parts + (i < bits % parts) for i in range(parts)]


def _keys(fp, open_bits: list[int], radius: int) -> list:
    """One key column per pair of blocks of the open bits: the pair's number and the bits of fp in it."""
    cut, at = [], 0
    for w in _widths(len(open_bits), radius + 2):
        cut.append(open_bits[at : at + w])
        at += w
    masks = [sum(1 << b for b in left + right) for left, right in combinations(cut, 2)]
    return [(m, fp.bitwiseAND(F.lit(m - 2**64 if m >= 2**63 else m).cast("bigint"))) for m in masks]


def _buckets(fps: DataFrame, radius: int, most: int) -> DataFrame:
    """(bucket, fp) of all buckets with two fingerprints or more; every pair within the radius shares one.

    The buckets of a level are counted first, so only rows that meet others are dealt out.
    """
    levels = [(_keys(F.col("fp"), list(range(BITS)), radius))]
    exploded = F.explode(F.array(*(F.struct(F.lit(i).alias("no"), k.alias("key")) for i, (_, k) in enumerate(levels[0]))))
    keyed = materialise(fps.select("fp", exploded.alias("b")).select("fp", "b.no", "b.key"), "keyed")
    met = materialise(keyed.groupBy("no", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "met")
    sized = keyed.join(met, ["no", "key"])
    small = sized.filter(F.col("n") <= most).select(F.xxhash64("no", "key").alias("bucket"), "fp")
    large = materialise(sized.filter(F.col("n") > most).select("no", "key", "fp"), "large")
    parts = [small]
    for i, (mask, _) in enumerate(levels[0]):
        free = [b for b in range(BITS) if not mask >> b & 1]
        inner = F.explode(F.array(*(F.struct(F.lit(j).alias("no2"), k.alias("key2")) for j, (_, k) in enumerate(_keys(F.col("fp"), free, radius)))))
        split = large.filter(F.col("no") == i).select("no", "key", "fp", inner.alias("b"))
        parts.append(split.select(F.xxhash64("no", "key", "b.no2", "b.key2").alias("bucket"), "fp"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _within(planes: np.ndarray, queries: np.ndarray, block: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(lane, mask) of lanes that have a fingerprint within the radius; bit j of mask stands for the block's j-th.

    planes[b, k]: bit b of the 64 fingerprints of block k. Counters are kept in `digits` carry-save words; `over`
    marks fingerprints whose count no longer fits.
    """
    digits = max(2, (radius + 1).bit_length())
    lane = np.arange(len(queries))
    counts = [np.zeros(len(queries), np.uint64) for _ in range(digits)]
    over = np.zeros(len(queries), np.uint64)
    for b in range(BITS):
        carry = planes[b, block] ^ (np.uint64(0) - ((queries >> np.uint64(b)) & np.uint64(1)))
        for d in range(digits):
            counts[d], carry = counts[d] ^ carry, counts[d] & carry
        over |= carry
        if b % CHECK_EVERY == CHECK_EVERY - 1:
            beyond = over.copy()
            for value in range(radius + 1, 1 << digits):
                equal = ALL
                for d in range(digits):
                    equal = equal & (counts[d] if value >> d & 1 else ~counts[d])
                beyond |= equal
            alive = np.flatnonzero(beyond != ALL)
            if len(alive) < len(lane):
                lane, queries, block, over, beyond = lane[alive], queries[alive], block[alive], over[alive], beyond[alive]
                counts = [c[alive] for c in counts]
            if not len(lane):
                break
    return lane, ~beyond[: len(lane)] if len(lane) else np.zeros(0, np.uint64)


def _merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked positions the least label of their set; labels are positions and point to roots."""
    while True:
        la, lb = labels[a], labels[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


def spanning_links(fps: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within the radius inside each bucket; buckets are the runs of fps beginning at starts."""
    sizes = np.diff(np.append(starts, len(fps)))
    blocks = (sizes + 63) // 64
    first_block = np.concatenate(([0], np.cumsum(blocks)))
    place = np.arange(len(fps)) - np.repeat(starts, sizes)
    own_block = np.repeat(first_block[:-1], sizes) + place // 64
    start_of = np.flatnonzero(place % 64 == 0)
    planes = np.zeros((BITS, first_block[-1]), np.uint64)
    for b in range(BITS):
        np.bitwise_or.at(planes[b], own_block, ((fps >> np.uint64(b)) & np.uint64(1)) << (place % 64).astype(np.uint64))
    filled = np.bincount(own_block, minlength=first_block[-1])
    last_block = np.repeat(first_block[1:], sizes)
    labels = np.arange(len(fps))
    lanes = last_block - own_block  # a fingerprint meets its own block and those after it
    done = np.concatenate(([0], np.cumsum(lanes)))
    row = 0
    while row < len(fps):
        end = max(row + 1, int(np.searchsorted(done, done[row] + LANES, "right")) - 1)
        who = np.repeat(np.arange(row, end), lanes[row:end])
        block = own_block[who] + np.arange(len(who)) - (done[who] - done[row])
        lane, mask = _within(planes, fps[who], block, radius)
        bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        hit, bit = np.nonzero(bits)
        real = bit < filled[block[lane[hit]]]
        a, b = who[lane[hit]][real], (start_of[block[lane[hit]]] + bit)[real]
        _merged(labels, a, b)
        row = end
    moved = np.flatnonzero(labels != np.arange(len(fps)))
    return fps[moved], fps[labels[moved]]


def links(fps: DataFrame, radius: int = 2, most: int = 2000) -> DataFrame:
    """Links (a, b) between the distinct fingerprints fps(fp) that connect all that are within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(batch_list):
            table = pa.Table.from_batches(batch_list)
            bucket = table.column("bucket").to_numpy()
            values = table.column("fp").to_numpy().view(np.uint64)
            starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            sizes = np.diff(np.append(starts, len(bucket)))
            met = np.repeat(sizes > 1, sizes)
            values, bucket = values[met], bucket[met]
            if not len(values):
                return None
            starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            a, b = spanning_links(values, starts, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("bucket").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last bucket may go on in the next batch
            if cut:
                out = flush([*held, batch.slice(0, cut)])
                held = [batch.slice(cut)]
                if out is not None:
                    yield out
            else:
                held.append(batch)
        if held:
            out = flush(held)
            if out is not None:
                yield out

    dealt = _buckets(fps, radius, most).repartition(partitions(fps), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def groups(prints: DataFrame, radius: int = 2, most: int = 2000) -> DataFrame:
    """(doc_id, fp, component_id) for prints(doc_id, fp): component_id is the least doc_id that links lead to.

    Rows without a doc_id take part; a group of such rows only has component_id null. Repeated rows all come back.
    """
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    found = materialise(components(links(classes.select("fp"), radius, most)), "roots")
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labelled = materialise(rooted.join(least, "root").select("fp", "component_id"), "labelled")
    return prints.join(labelled, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, most: int = 2000) -> DataFrame:
    """(doc_id, fp, component_id) of every row of docs(doc_id, text)."""
    return groups(_stored(fingerprints(docs, shingle)), radius, most)


def _stored(prints: DataFrame) -> DataFrame:
    with text_batches(prints.sparkSession):
        return materialise(prints, "prints")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, most: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each near-duplicate group: the one with the least id (null ids last), then the first in the table.

    All columns stay as they are. docs must be a stored table, since it is read twice and rows are told apart by their place.
    """
    row, place = unused(docs, "row"), F.monotonically_increasing_id()
    placed = docs.select(*every_column(docs), place.alias(row))
    prints = fingerprints(docs.select(place.alias("doc_id"), F.col(text_col).alias("text")), shingle)
    named = docs.select(place.alias("doc_id"), F.col(id_col).alias("_id"))
    groups_ = materialise(groups(_stored(prints), radius, most).select("doc_id", "component_id").join(named, "doc_id"), "groups")
    first = groups_.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "doc_id")).alias("first"))
    kept = first.select("component_id", F.col("first.doc_id").alias("doc_id"))
    gone = materialise(groups_.join(kept, ["component_id", "doc_id"], "left_anti").select(F.col("doc_id").alias(row)), "gone")
    return placed.join(gone, row, "left_anti").select(*every_column(docs))
