"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most one sequence; a piece that fills a sequence stands alone. The others are dealt into
districts of bounded size by hash. Each district is evolved on several islands at once, one task each: an individual is a
set of bins, crossover injects whole well-filled bins of one parent into the other, drops the bins that would repeat a piece and
puts the displaced pieces back by best fit. Between epochs the best individual of every island migrates to the next island
of its district. Bins that the winner leaves too empty are opened, and their pieces are dealt into fewer districts, until
one district is left or a deal fills no bin. Every piece is placed; nothing is gathered beyond a district.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import releasing, slices, text_batches
from parcelflow.llm.tokens import Encoder
from parcelflow.session import materialise

PIECES = "doc_id bigint, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = "district bigint, island int, row bigint, piece int, length bigint, bins array<int>, offset bigint, fill bigint, fitness double"


def pieces(docs: DataFrame, tokenizer: str, cut: str = "space", end_id: int = 0, size: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every document: its ids are the text's and the end id (null text: empty).

    Documents of more than `size` ids are cut into pieces of `size`, of which the first may be shorter. row tells rows of equal
    ids apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.kept(tokenizer, cut)
        for batch in slices(batches, "t", 1 << 22):
            docs_of, rows_of, numbers, starts, lengths, sums = [], [], [], [], [], []
            ids, offsets = encoder.closed(batch.column("t"), end_id)
            ends = offsets.tolist()
            for doc, row, begin, end in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), ends, ends[1:]):
                count = -(-(end - begin) // size)
                head = end - begin - size * (count - 1)
                for i in range(count):
                    a, b = (0, head) if i == 0 else (head + (i - 1) * size, head + i * size)
                    docs_of.append(doc), rows_of.append(row), numbers.append(i), starts.append(a), lengths.append(b - a)
                    sums.append(zlib.crc32(ids[begin + a : begin + b]))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip((docs_of, rows_of, numbers, starts, lengths, sums), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "piece", "start", "length", "ids_crc32"])

    named = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("t"))
    return named.mapInArrow(releasing(run), PIECES)


def best_fit(bins: list[list[int]], fills: list[int], items: list[int], lengths: list[int], size: int) -> None:
    """Put each item, in the given order, into the fullest bin that still holds it; a new bin if none does."""
    room = sorted((size - f, i) for i, f in enumerate(fills))
    for item in items:
        length = lengths[item]
        at = bisect_left(room, (length, -1))
        if at < len(room):
            left, i = room.pop(at)
            bins[i].append(item)
        else:
            left, i = size, len(bins)
            bins.append([item])
            fills.append(0)
        fills[i] += length
        if left > length:
            insort(room, (left - length, i))


def _fitness(fills: list[int], size: int) -> float:
    """Mean squared fill: fewer and fuller bins score higher."""
    return sum((f / size) ** 2 for f in fills) / max(1, len(fills))


def cross(a: list[list[int]], b: list[list[int]], lengths: list[int], size: int, rnd: random.Random) -> list[list[int]]:
    """A child of a with well-filled bins of b injected whole."""
    fills = [sum(map(lengths.__getitem__, g)) for g in b]
    bar = sorted(fills)[len(fills) // 2]
    injected = [g for g, f in zip(b, fills) if f >= bar and rnd.random() < 0.5]
    taken = {i for g in injected for i in g}
    kept = [g for g in a if taken.isdisjoint(g)]
    return _refilled(injected + kept, lengths, size)


def mutate(a: list[list[int]], lengths: list[int], size: int, rnd: random.Random) -> list[list[int]]:
    """A child of a whose emptiest bins and a few others are dissolved."""
    order = sorted(range(len(a)), key=lambda i: sum(map(lengths.__getitem__, a[i])))
    gone = set(order[: 1 + len(a) // 50]) | {rnd.randrange(len(a)) for _ in range(1 + len(a) // 50)}
    return _refilled([g for i, g in enumerate(a) if i not in gone], lengths, size)


def _refilled(groups: list[list[int]], lengths: list[int], size: int) -> list[list[int]]:
    held = np.zeros(len(lengths), bool)
    held[[i for g in groups for i in g]] = True
    displaced = sorted(np.flatnonzero(~held).tolist(), key=lambda i: -lengths[i])
    bins = [list(g) for g in groups]
    best_fit(bins, [sum(map(lengths.__getitem__, g)) for g in bins], displaced, lengths, size)
    return bins


def evolve(lengths: list[int], start: list[list[list[int]]], size: int, population: int, generations: int, rnd: random.Random) -> list[list[list[int]]]:
    """Individuals, the best first, after some generations from the given ones and fresh ones."""
    rate = lambda g: _fitness([sum(map(lengths.__getitem__, b)) for b in g], size)
    made = list(start)
    while len(made) < population:
        noise = [1.0 if not made else rnd.uniform(0.8, 1.2) for _ in lengths]
        bins: list[list[int]] = []
        best_fit(bins, [], sorted(range(len(lengths)), key=lambda i: -lengths[i] * noise[i]), lengths, size)
        made.append(bins)
    ranked = sorted(((rate(g), n, g) for n, g in enumerate(made)), reverse=True, key=lambda x: (x[0], -x[1]))
    number = len(ranked)
    for _ in range(generations):
        if ranked[0][0] > 0.9999:
            break
        for _ in range(population):
            (_, _, a), (_, _, b) = (min(rnd.sample(ranked, 2), key=lambda x: (-x[0], x[1])) for _ in "ab")
            child = cross(a, b, lengths, size, rnd) if a is not b else mutate(a, lengths, size, rnd)
            ranked.append((rate(child), number, child))
            number += 1
        ranked = sorted(ranked, key=lambda x: (-x[0], x[1]))[:population]
    return [g for _, _, g in ranked]


def _island(size: int, population: int, generations: int, seed: int):
    def run(key, table):
        district, island = (k.as_py() for k in key)
        order = np.lexsort((table.column("piece").to_numpy(), table.column("row").to_numpy()))
        table = table.take(pa.array(order))
        lengths = table.column("length").to_pylist()
        start = []
        given = table.column("bins").to_pylist()
        for s in range(len(given[0])):
            groups: dict[int, list[int]] = {}
            for i, bins in enumerate(given):
                groups.setdefault(bins[s], []).append(i)
            start.append(list(groups.values()))
        rnd = random.Random(f"{seed} {district} {island}")
        best = evolve(lengths, start, size, population, generations, rnd)[:2]
        numbers = np.zeros((len(best), len(lengths)), np.int32)
        offsets, fills = [0] * len(lengths), [0] * len(lengths)
        for s, groups in enumerate(best):
            for n, group in enumerate(groups):
                numbers[s, group] = n
        for group in best[0]:
            at = 0
            for i in sorted(group):
                offsets[i] = at
                at += lengths[i]
            for i in group:
                fills[i] = at
        worth = _fitness([sum(lengths[i] for i in g) for g in best[0]], size) - len(best[0])
        n = len(lengths)
        columns = [pa.array([district] * n, pa.int64()), pa.array([island] * n, pa.int32()), table.column("row"), table.column("piece"), table.column("length"),
                   pa.array(numbers.T.tolist(), pa.list_(pa.int32())), pa.array(offsets, pa.int64()), pa.array(fills, pa.int64()), pa.array([float(worth)] * n)]
        return pa.Table.from_arrays(columns, ["district", "island", "row", "piece", "length", "bins", "offset", "fill", "fitness"])

    return run


def _migrated(evolved: DataFrame, islands: int) -> DataFrame:
    """Each island's rows with its own individuals and the best one of the island before it."""
    mine = F.collect_list(F.struct("island", "bins"))
    by_piece = evolved.groupBy("district", "row", "piece", "length").agg(F.array_sort(mine).alias("all"))
    each = by_piece.select("district", "row", "piece", "length", "all", F.posexplode("all").alias("at", "own"))
    before = F.element_at("all", F.pmod(F.col("at") - 1, F.lit(islands)) + 1)["bins"]
    return each.select("district", F.col("own.island").alias("island"), "row", "piece", "length", F.concat("own.bins", F.slice(before, 1, 1)).alias("bins"))


def pack(found: DataFrame, size: int = 2048, district_rows: int = 4000, islands: int = 2, epochs: int = 2, population: int = 4, generations: int = 2,
         enough: float = 0.98, seed: int = 7) -> DataFrame:
    """pieces with sequence_id and offset. Sequences hold at most `size` ids, and places in them are gapless from 0."""
    with text_batches(found.sparkSession):
        stored = materialise(found, "pieces")
    alone = stored.filter(F.col("length") == size).select(*stored.columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    open_ = stored.filter(F.col("length") < size).select("row", "piece", "length")
    done = []
    turn = 0
    while True:
        n = open_.count()
        if not n:
            break
        districts = -(-n // district_rows)
        dealt = open_.withColumn("district", F.pmod(F.xxhash64("row", "piece", F.lit(turn)), F.lit(districts)))
        state = dealt.select("district", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "row", "piece", "length", F.array().cast("array<int>").alias("bins"))
        for epoch in range(epochs):
            run = _island(size, population, generations, seed + 1000 * turn + epoch)
            evolved = materialise(state.groupBy("district", "island").applyInArrow(run, PLACED), "evolved")
            state = _migrated(evolved, islands)
        worth = evolved.select("district", "island", "fitness").distinct()
        winner = materialise(worth.groupBy("district").agg(F.max_by("island", F.struct("fitness", -F.col("island"))).alias("island")), "winners")
        best = evolved.join(winner, ["district", "island"]).select("row", "piece", "length", "offset", "fill", (F.col("district") * (1 << 20) + F.element_at("bins", 1) + (turn << 52)).alias("sequence_id"))
        full = F.col("fill") >= enough * size
        rest = materialise(best.filter(~full).select("row", "piece", "length"), "open")
        if districts == 1 or rest.count() == n:  # one district is left, or no bin is full and the same pieces would be dealt into as many
            done.append(best.select("row", "piece", "sequence_id", "offset"))
            break
        done.append(best.filter(full).select("row", "piece", "sequence_id", "offset"))
        open_ = rest
        turn += 1
    placed = alone
    for part in done:
        placed = placed.unionByName(stored.join(part, ["row", "piece"]).select(*placed.columns))
    return placed.drop("row")
