"""Quality classifier: perplexity under an interpolated modified Kneser-Ney character n-gram model of trusted text.

Counts of all trusted text are gathered by one count per task and a sum per n-gram; lower orders count distinct left
neighbours. The probabilities of exactly those n-grams that the documents hold are worked out by joins, order by order, over
tables that are spread by n-gram: no task holds the model. Documents are scored in blocks: a block asks for its distinct
n-grams, gets their log-probabilities by a join, and meets them again in one task, which sums them per document.

An n-gram is one long. Every character of the counted text has a code of its own, by falling frequency, in as many bits as
they need; code 0 stands before the text, and code 1 is any other character: the model has seen none of these, so all have
the same probabilities and one code loses nothing. Only if the counted text has more characters than fit (65,534 at order
4), the rarest of them share code 1 as well. Thresholds are quantiles, per language and adjusted to the length, of the
perplexities of trusted documents that were kept out of the counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import byte_column, give_back, releasing, slices, unused
from parcelflow.session import materialise

OWN = 0x110000  # code points; each may have a code of its own
PIECE = 1 << 19
BLOCK_BYTES = 1 << 24
FILTER_BITS = 1 << 20  # size of the filter of trusted ids, whatever their number
BANDS = (128, 512)  # lengths in characters at which a new band of thresholds begins
STEPS = 1000  # steps of a threshold per bit
GRID = 200  # steps of a distance per factor of e, so that a language has a bounded number of different ones
ABOVE = 3  # rows that must lie above a rank for a quantile to be read there


def code_points(data: bytes) -> np.ndarray:
    return np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


class Alphabet:
    """Codes of characters: 2 and up for the given code points, most frequent first, and 1 for all others."""

    def __init__(self, points: np.ndarray, order: int):
        self.order = order
        self.bits = min((len(points) + 1).bit_length(), 64 // order)
        self.points = points[: (1 << self.bits) - 2]
        self._table = None

    def __getstate__(self):
        return self.__dict__ | {"_table": None}  # each task fills its own

    def codes(self, data: bytes) -> np.ndarray:
        if self._table is None:
            self._table = np.ones(OWN, np.int32)
            self._table[self.points] = np.arange(2, len(self.points) + 2)
        return self._table[code_points(data)].astype(np.int64)


def _cuts(data: np.ndarray, a: int, b: int) -> Iterator[tuple[int, int]]:
    """[a, b) in pieces that end between characters."""
    while a < b:
        c = min(b, a + PIECE)
        while c < b and data[c] & 0xC0 == 0x80:
            c += 1
        yield a, c
        a = c


def grams(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of each character, its n-gram) over all rows of a byte column, some pieces at a time."""
    row, order = 0, alphabet.order
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1)
        whole = offsets[end] - offsets[row] <= PIECE
        before = np.zeros(order - 1, np.int64)
        for a, b in [(offsets[row], offsets[end])] if whole else _cuts(data, offsets[row], offsets[end]):
            part = alphabet.codes(data[a:b].tobytes())
            if whole:
                starts = (data[a:b] & 0xC0) != 0x80
                counted = np.concatenate(([0], np.cumsum(starts)))
                lengths = np.diff(counted[offsets[row : end + 1] - a])
            else:
                lengths = np.array([len(part)])
            of = np.repeat(np.arange(len(lengths)), lengths)
            at = np.arange(len(part)) + (order - 1) * (of + 1)
            padded = np.zeros(len(part) + (order - 1) * len(lengths), np.int64)
            padded[: order - 1] = before
            padded[at] = part
            key = padded[at - order + 1]
            for i in range(order - 2, -1, -1):
                key = (key << alphabet.bits) | padded[at - i]
            if not whole:
                before = padded[len(padded) - order + 1 :]
            yield of + row, key
        row = end


def _distinct(batch: pa.RecordBatch, alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts) of a batch's texts."""
    keys, counts, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    held = 0

    def merged():
        every = np.concatenate([keys, *(k for k, _ in waiting)])
        weight = np.concatenate([counts, *(c for _, c in waiting)])
        found, place = np.unique(every, return_inverse=True)
        return found, np.bincount(place, weights=weight, minlength=len(found)).astype(np.int64)

    for _, key in grams(*byte_column(batch.column("t")), alphabet):
        found = np.unique(key, return_counts=True)
        waiting.append(found)
        held += len(found[0])
        if held > 1 << 20:
            keys, counts = merged()
            waiting, held = [], 0
    return merged()


def held_out(id_col: str):
    """True for trusted rows that set thresholds instead of counts."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def trusted_counts(docs: DataFrame, trusted: DataFrame, order: int) -> tuple[DataFrame, Alphabet]:
    """(key, n) over the texts of trusted rows, and the alphabet of the keys; docs(doc_id, t), trusted(doc_id).

    A bitmap of fixed size over hashes of the trusted ids first leaves out most other rows, and texts are compressed, so
    that little text moves to the join that decides.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    marks = trusted.select(place.alias("p")).groupBy(F.floor(F.col("p") / 32768).cast("int").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position((F.col("p") + 1).cast("bigint"))).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in marks.collect():  # FILTER_BITS / 32,768 rows of 4 KB
        bits[r["part"] * 4096 : (r["part"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)

    def pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            p = batch.column("p").to_numpy()
            batch = batch.filter(pa.array(((bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1).astype(bool)))
            for part in slices([batch], "t", 1 << 23):
                texts = [press(t) for t in part.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "z"])

    def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = pa.array([expand(z) for z in batch.column("z").to_pylist()], pa.large_binary())
            yield from slices([pa.RecordBatch.from_arrays([texts], ["t"])], "t", BLOCK_BYTES)

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses = np.zeros(OWN, np.int64)
        for part in expanded(batches):
            data, _ = byte_column(part.column("t"))
            for a, b in _cuts(data, 0, len(data)):
                found = np.bincount(code_points(data[a:b].tobytes()))
                uses[: len(found)] += found
        points = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(points), pa.array(uses[points])], ["point", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in expanded(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _distinct(part, alphabet)], ["key", "n"])

    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("t").isNotNull()).select("doc_id", place.alias("p"), "t")
    # always a shuffled join: compressing and counting then run in stages of their own, with one Python worker per core
    chosen = rows.mapInArrow(releasing(pressed), "doc_id bigint, z binary").join(trusted.hint("merge"), "doc_id")
    chosen = materialise(chosen.select("z"), "counted_texts")
    uses = chosen.mapInArrow(releasing(spelled), "point bigint, n bigint").groupBy("point").agg(F.sum("n").alias("n"))
    most = uses.orderBy(F.desc("n"), "point").select("point").collect()  # no more than there are characters
    alphabet = Alphabet(np.array([r["point"] for r in most], np.int64), order)
    return chosen.mapInArrow(releasing(counted), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")), alphabet


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the counts of counts."""
    c = table.agg(*(F.coalesce(F.sum((F.col("n") == i).cast("bigint")), F.lit(0)).alias(f"c{i}") for i in range(1, 5))).first()
    y = c["c1"] / (c["c1"] + 2 * c["c2"]) if c["c1"] else 0.5
    found = [i - (i + 1) * y * c[f"c{i + 1}"] / c[f"c{i}"] if c[f"c{i}"] else 0.5 * i for i in (1, 2, 3)]
    return tuple(min(float(i), max(0.05, d)) for i, d in zip((1, 2, 3), found))


def log_probabilities(counts: DataFrame, asked: DataFrame, alphabet: Alphabet) -> DataFrame:
    """(key, bits) for asked(key): minus the binary logarithm of the last character's probability after the others.

    counts(key, n) are n-grams of the highest order. Every table here is spread by n-gram or context.
    """
    order, bits = alphabet.order, alphabet.bits

    def shorter(k: int):
        return F.col("key").bitwiseAND(F.lit((1 << (bits * k)) - 1).cast("bigint"))

    context = F.shiftrightunsigned("key", bits)
    tables = {order: materialise(counts, "grams")}
    wanted = {order: materialise(asked.select("key").distinct(), "asked")}
    for k in range(order - 1, 0, -1):
        short = shorter(k)
        tables[k] = materialise(tables[k + 1].groupBy(short.alias("key")).agg(F.count(F.lit(1)).alias("n")), "grams")
        wanted[k] = materialise(wanted[k + 1].select(short.alias("key")).distinct(), "asked")
    known = None
    for k in range(1, order + 1):
        d1, d2, d3 = _discounts(tables[k])
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        sums = [F.sum("n").alias("total"), F.sum(discount).alias("left")]
        own = F.greatest(F.col("n") - discount, F.lit(0.0))
        rows = wanted[k].join(tables[k], "key", "left")
        if k == 1:
            s = tables[1].agg(*sums, F.count(F.lit(1)).alias("v")).first()
            total, left, v = float(s["total"] or 1), float(s["left"] or 1), s["v"] + 1
            p = F.coalesce(own, F.lit(0.0)) / total + left / total / v
            known = materialise(rows.select("key", p.alias("p")), "known")
            continue
        contexts = tables[k].groupBy(context.alias("ctx")).agg(*sums)
        rows = rows.withColumn("ctx", context).join(contexts, "ctx", "left")
        rows = rows.withColumn("short", shorter(k - 1)).join(known.select(F.col("key").alias("short"), F.col("p").alias("lower")), "short")
        p = F.coalesce(own / F.col("total"), F.lit(0.0)) + F.coalesce(F.col("left") / F.col("total"), F.lit(1.0)) * F.col("lower")
        known = materialise(rows.select("key", p.alias("p")), "known")
    return known.select("key", (-F.log2("p")).alias("bits"))


def score(docs: DataFrame, trusted: DataFrame, order: int = 4) -> DataFrame:
    """(doc_id, text_hash, lang, n_chars, bits) of every row of docs(doc_id, lang, t): bits is the sum over its characters.

    docs must be a stored table, since it is read once to ask and once to score and rows must come in the same order.
    """
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("t").alias("text_hash"), F.col("lang").cast("string").alias("lang"), "t")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
        for part in slices(batches, "t", BLOCK_BYTES):
            yield part.column("row")[0].as_py(), part

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in blocks(batches):
            keys = _distinct(part, alphabet)[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block)), pa.array(keys)], ["block", "key"])

    def packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))
        for block, part in blocks(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                out.write_batch(part)
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sink.getvalue().to_pybytes()])], ["block", "z"])

    def summing(block, texts, answers):
        keys, bits = answers.column("key").to_numpy(), answers.column("bits").to_numpy()
        order_of = np.argsort(keys)
        keys, bits = keys[order_of], bits[order_of]
        out = []
        for z in texts.column("z").to_pylist():
            for part in pa.ipc.open_stream(z):
                data, offsets = byte_column(part.column("t"))
                total, count = np.zeros(part.num_rows), np.zeros(part.num_rows, np.int64)
                for row, key in grams(data, offsets, alphabet):
                    at = np.searchsorted(keys, key)
                    if len(key) and (at[key.argmax()] >= len(keys) or not np.array_equal(keys[at], key)):
                        raise RuntimeError("the documents changed between asking and scoring")
                    first, last = (int(row[0]), int(row[-1]) + 1) if len(row) else (0, 0)
                    total[first:last] += np.bincount(row - first, weights=bits[at], minlength=last - first)
                    count[first:last] += np.bincount(row - first, minlength=last - first)
                columns = [part.column(c) for c in ("doc_id", "text_hash", "lang")] + [pa.array(count), pa.array(total)]
                out.append(pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "lang", "n_chars", "bits"]))
        kinds = [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("lang", pa.string()), ("n_chars", pa.int64()), ("bits", pa.float64())]
        give_back()
        return pa.Table.from_batches(out, pa.schema(kinds))

    train = trusted.filter(~held_out("doc_id"))
    counts, alphabet = trusted_counts(docs.select("doc_id", "t"), train, order)
    asked = materialise(keyed.mapInArrow(releasing(asking), "block bigint, key bigint"), "requests")
    answers = asked.join(log_probabilities(counts, asked, alphabet), "key")
    texts = keyed.mapInArrow(releasing(packing), "block bigint, z binary")
    both = texts.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(summing, "doc_id bigint, text_hash bigint, lang string, n_chars bigint, bits double")


def _quantile(counted: DataFrame, keys: list[str], value: str, share: float, name: str) -> DataFrame:
    """(keys, name, n): the value at a share of the rows of each group, from counted(keys, value, n).

    A rank that has fewer than ABOVE rows above it is set by single odd rows. The value is then read where that many lie above,
    and carried on from there by an exponential tail whose scale is its distance from the median. Groups of less than
    4 * ABOVE rows tell no tail: they have their largest value.
    """
    by = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    sums = counted.groupBy(*keys, value).agg(F.sum("n").alias("n"))
    ranked = sums.withColumn("upto", F.sum("n").over(by.orderBy(value))).withColumn("all", F.sum("n").over(by))

    def at(rank):
        return F.min(F.when(F.col("upto") >= rank, F.col(value)))

    whole = F.ceil(F.col("all") * share)
    read = F.greatest(F.ceil(F.col("all") / 2), F.least(whole, F.col("all") - ABOVE))
    found = ranked.groupBy(*keys).agg(at(whole).alias("_whole"), at(read).alias("_read"), at(F.ceil(F.col("all") / 2)).alias("_middle"), F.first("all").alias("n"))
    beyond = F.log(ABOVE / (F.col("n") * max(1 - share, 1e-9))) / F.log(F.greatest(F.col("n"), F.lit(4 * ABOVE)) / (2 * ABOVE))
    carried = F.ceil(F.col("_read") + (F.col("_read") - F.col("_middle")) * beyond).cast("bigint")
    tail = (F.col("n") >= 4 * ABOVE) & (F.col("n") < _defined(share))
    return found.select(*keys, F.when(tail, carried).otherwise(F.col("_whole")).alias(name), "n")


def _defined(share: float) -> int:
    """The least number of rows of which ABOVE lie above the quantile."""
    return math.ceil(round(ABOVE / max(1 - share, 1e-9), 6))


def _gridded(distance):
    """A distance rounded up to a grid whose steps are 1 near zero and grow in proportion."""
    size = F.abs(distance)
    at = F.log1p(size) * GRID
    up = F.when(distance >= 0, F.ceil(at)).otherwise(F.floor(at))  # up is away from zero above it, towards zero below
    return F.when(distance >= 0, F.ceil(F.expm1(up / GRID))).otherwise(-F.floor(F.expm1(up / GRID))).cast("bigint")


def _beside(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the other columns of found(keys, ...), whose keys are unique; null keys match."""
    renamed = materialise(found, "found").withColumnsRenamed({k: f"_{k}" for k in keys})
    return rows.join(renamed, [rows[k].eqNullSafe(renamed[f"_{k}"]) for k in keys], "left").drop(*(f"_{k}" for k in keys))


def thresholds(scored: DataFrame, trusted: DataFrame, quantile: float, least: int, alone: int | None = None) -> DataFrame:
    """(lang, band, limit, centre, rise): the largest step of bits per character that is still kept.

    It is `limit`, or without one centre + rise / sqrt(n_chars). A cell of at least `least` trusted rows that were not counted,
    and of enough for ABOVE of them to lie above the quantile, has the quantile of its steps. Otherwise a language with at least `alone` such rows (as many as `least` if not given) is
    judged by its own rows of all lengths: the spread of bits per character falls with the root of the length, so `centre` is
    the language's median step and `rise` the quantile of its rows' distances from it times that root, shrunk towards that
    of all languages' distances, each from its own centre, as if `least` such rows were added. Only other languages take
    the quantile over all languages of the band, or over all rows if the band has fewer than `least`.
    Steps and distances are counted on grids of bounded size before they are ranked: no group is gathered.
    """
    kept_out = scored.join(trusted.filter(held_out("doc_id")), "doc_id", "left_semi").filter("n_chars > 0")
    sample = materialise(kept_out.select("lang", "band", "step", "n_chars"), "sample")
    counted = materialise(sample.groupBy("lang", "band", "step").agg(F.count(F.lit(1)).alias("n")), "steps")
    places = materialise(scored.filter("n_chars > 0").select("lang", "band").distinct(), "places")
    centred = _beside(sample, _quantile(counted, ["lang"], "step", 0.5, "centre").drop("n"), ["lang"])
    distance = _gridded((F.col("step") - F.col("centre")) * F.sqrt("n_chars"))
    distances = materialise(centred.groupBy("lang", "centre", distance.alias("distance")).agg(F.count(F.lit(1)).alias("n")), "distances")
    every = _quantile(distances, [], "distance", quantile, "rise").first()
    weight = F.when(F.col("n") >= 4 * ABOVE, F.col("n")).otherwise(0)  # fewer rows tell a centre, but no tail
    shrunk = (weight * F.col("rise") + least * F.lit(every["rise"] if every else None)) / (weight + least)
    own = _quantile(distances, ["lang", "centre"], "distance", quantile, "rise").select("lang", "centre", shrunk.alias("rise"), F.col("n").alias("n_lang"))
    out = _beside(places, _quantile(counted, ["lang", "band"], "step", quantile, "s0").withColumnRenamed("n", "n0"), ["lang", "band"])
    out = _beside(out, own, ["lang"])
    out = _beside(out, _quantile(counted, ["band"], "step", quantile, "s1").withColumnRenamed("n", "n1"), ["band"])
    only = _quantile(counted, [], "step", quantile, "s2").first()
    by_lang = F.coalesce(F.col("n_lang") >= (least if alone is None else alone), F.lit(False))
    pooled = F.when(F.col("n1") >= least, F.col("s1")).otherwise(F.lit(only["s2"] if only else None).cast("bigint"))
    chosen = F.when(F.col("n0") >= max(least, _defined(quantile)), F.col("s0")).when(~by_lang, pooled)
    return out.select("lang", "band", chosen.alias("limit"), *(F.when(by_lang, F.col(c)).alias(c) for c in ("centre", "rise")))


def judge(docs: DataFrame, labels: DataFrame, order: int = 4, quantile: float = 0.999, least: int = 200, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, text_hash, lang, n_chars, perplexity, threshold, keep) of every row of docs.

    Trusted are rows that labels call quality 1 and not toxic. keep is false above the threshold of the row's language and
    length (see thresholds; languages are pooled only for one without any trusted row that was not counted), and for null or empty
    texts, whose perplexity is null. Without any trusted text all other rows are kept.
    Null languages are a language of their own; repeated rows are judged alike. docs must be a stored table.
    """
    trusted = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("bigint").alias("doc_id")).dropna().distinct()
    trusted = materialise(trusted, "trusted")
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("t"))
    band = sum((F.col("n_chars") >= b).cast("int") for b in BANDS)
    step = F.ceil(F.try_divide("bits", "n_chars") * STEPS).cast("bigint")
    scored = score(source, trusted, order).withColumn("band", band).withColumn("step", F.when(F.col("n_chars") > 0, step))
    scored = materialise(scored, "scored")
    limits = materialise(thresholds(scored, trusted, quantile, least, alone=1), "limits").withColumnsRenamed({"lang": "_lang", "band": "_band"})
    judged = scored.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("band") == F.col("_band")), "left")
    judged = judged.withColumn("limit", F.coalesce("limit", F.floor(F.col("centre") + F.try_divide("rise", F.sqrt("n_chars")))))
    return judged.select(
        "doc_id", "text_hash", "lang", "n_chars", F.when(F.col("n_chars") > 0, F.pow(F.lit(2.0), F.try_divide("bits", "n_chars"))).alias("perplexity"),
        F.pow(F.lit(2.0), F.col("limit") / STEPS).alias("threshold"), ((F.col("n_chars") > 0) & F.coalesce(F.col("step") <= F.col("limit"), F.lit(True))).alias("keep"),
    )


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """docs without the rows that judge rejects; all columns stay as they are."""
    d, t, of = (unused(docs, c) for c in ("rejected_id", "rejected_hash", "rejected_lang"))
    judged = judge(docs, labels, id_col=id_col, text_col=text_col, lang_col=lang_col, **how).filter(~F.col("keep"))
    gone = materialise(judged.select(F.col("doc_id").alias(d), F.col("text_hash").alias(t), F.col("lang").alias(of)).distinct(), "rejected")
    same = F.col(id_col).cast("bigint").eqNullSafe(F.col(d)) & (F.xxhash64(F.col(text_col).cast("binary")) == F.col(t)) & F.col(lang_col).cast("string").eqNullSafe(F.col(of))
    return docs.join(gone, same, "left_anti")
