"""Language-model scores by a probabilistic suffix tree of words.

Texts are sequences of words and one end. Words with at least `least` training occurrences, and the end, are symbols of their own; all other
words share one symbol, inside which each keeps its share of the unigram model, so every text has a proper probability. A context
is a sequence of up to `depth` symbols with at least `least` occurrences. It is retained if its next symbols diverge from those
of its longest proper suffix: the log-likelihood that its own counts gain on the training text, each occurrence judged by the
others, must be `gain` or more. A retained context keeps the next symbols it was followed by twice or more and leaves the
rest of its mass to its suffix (Witten-Bell). A symbol is scored in the state of the longest retained suffix of what stands before it in its text.

The tree is never in one place. Documents are cut into blocks of bounded size. A block sends its words, and then for each context
length its (context, symbol) pairs, with the counts it can add. They are dealt by hash into as many buckets as there are blocks, so a
bucket holds about as much as a block whatever the corpus; a block packs what it has for a bucket into one row. Buckets add
up and answer; a context's pairs share a bucket, in which it is judged, except those of a very frequent one, whose sums are added up by an
aggregate. What is asked and counted grows with the documents.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import words
from parcelflow.llm.common import give_back, releasing, slices, text_batches
from parcelflow.llm.tokens import _hashed
from parcelflow.session import drop, fresh_path, input_bytes, materialise, release

BLOCK_BYTES = 1 << 24
SEEN = 2  # occurrences from which a context keeps a next symbol
WAVES = 4  # most parts that the blocks of a large corpus are stepped in, so that less of them is on disk twice at a time
BUCKET = 1 << 22  # occurrences of a context whose next symbols are counted together
NATS = 256  # steps per nat of the suffix's log-probability when contexts are judged
SPREAD = np.uint32(1 << 31)  # marks a context whose pairs lie in several buckets
NUMBER_BITS = 20  # of a word's symbol that tell the task which numbered it
TEXTS = 2000  # rows of an Arrow batch of documents
WIDE = 100  # rows of an Arrow batch that hold what is asked and answered: some MB
RARE, END = 0, 1  # symbols; those of frequent words follow
BLOCK, ASK, CONTEXT = 0, 1, 2  # kinds of stored rows: a block's documents, what it asks or is answered, sums of a context or of words
WORDS = "kind tinyint, block bigint, slot int, bucket int, names binary, counts binary, n bigint, z binary"
NAMED = "kind tinyint, block bigint, slot int, counts binary, symbols binary, every bigint, kinds bigint, rare bigint, rare_count bigint, top bigint"
ASKS = "kind tinyint, block bigint, slot int, bucket int, contexts binary, sizes binary, symbols binary, counts binary, lns binary, context bigint, z binary"
COUNTED = "kind tinyint, block bigint, slot int, counts binary, children binary, scales binary, owns binary, context bigint, every bigint, kinds bigint, own bigint, once bigint, lift double"
SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_ln double, ln double"
PRESSED = 512  # bytes from which a value is compressed
LIMIT = 200_000  # rows of an Arrow batch that is handed over


def held_out(id_col: str = "doc_id"):
    """True for rows that the model does not learn from; rows without an id are among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(True))


def _planes(values: np.ndarray) -> np.ndarray:
    """All first bytes, then all second ones, and so on: the high bytes of small numbers then take next to nothing once compressed."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T)


def _whole(planes: np.ndarray, kind) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _packed(**arrays: np.ndarray) -> bytes:
    sink = io.BytesIO()
    np.savez(sink, **{f"{k}:{v.dtype.str}": _planes(v) for k, v in arrays.items()})
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def _unpacked(z: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(z))) as held:
        return {name: _whole(held[k], kind) for k in held.files for name, kind in [k.split(":")]}


_KINDS = {"tinyint": pa.int8(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _rows(schema: str, many: int, **columns) -> Iterator[pa.RecordBatch]:
    """Rows of a schema, at most LIMIT at a time; single values repeat, columns that are not given are null."""
    fields = [f.split() for f in schema.split(", ")]
    for start in range(0, many, LIMIT):
        end, cells = min(many, start + LIMIT), []
        for name, kind in fields:
            given = columns.get(name)
            if given is None:
                cells.append(pa.nulls(end - start, _KINDS[kind]))
            elif isinstance(given, int):
                cells.append(pa.array(np.full(end - start, given), _KINDS[kind]))
            elif isinstance(given, pa.Array):
                cells.append(given.slice(start, end - start).cast(_KINDS[kind]))
            else:
                cells.append(pa.array(given[start:end], _KINDS[kind]))
        yield pa.RecordBatch.from_arrays(cells, [name for name, _ in fields])


def _pressed(values: Iterable[bytes]) -> pa.Array:
    """Binary values, compressed where that pays; the first byte tells which."""
    press = zstandard.ZstdCompressor(level=3).compress
    return pa.array([b"\1" + press(v) if len(v) >= PRESSED else b"\0" + v for v in values], pa.large_binary())


def _expanded(column: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(v[1:]) if v[0] else v[1:] for v in column.to_pylist()]


def _stretches(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """One binary value for each of consecutive stretches of these sizes."""
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64).tolist()
    return _pressed(_planes(values[a:b]).tobytes() for a, b in zip(ends, ends[1:]))


def _values(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(all values, number in each row) of a column that _stretches made."""
    parts = _expanded(column)
    values = [_whole(np.frombuffer(p, np.uint8), kind) for p in parts]
    return np.concatenate([np.zeros(0, kind), *values]), np.array([len(v) for v in values], np.int64)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum over each of consecutive stretches of these sizes."""
    ends = np.cumsum(sizes)
    total = np.concatenate(([0], np.cumsum(values)))
    return total[ends] - total[ends - sizes]


def _dealt(values: np.ndarray, part: np.ndarray | int, buckets: int) -> np.ndarray:
    """Bucket of each 64-bit value and part."""
    h = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(part).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _read(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of documents as numbers of their own words, and a row for each bucket of these words with their training counts."""
    for part in slices(batches, "t", BLOCK_BYTES):
        block = part.column("row")[0].as_py()
        found, offsets = words.split(part.column("t"), lower=True)
        ids, distinct = words.numbered(found)
        sizes = np.diff(offsets) + 1
        tokens = np.full(int(sizes.sum()), len(distinct), np.int64)  # the end is the last of the own words
        plain = np.ones(len(tokens), bool)
        plain[np.cumsum(sizes) - 1] = False
        tokens[plain] = ids
        del found, ids, plain
        out = part.column("held_out").to_numpy(zero_copy_only=False)
        learned = np.bincount(tokens[np.repeat(~out, sizes)], minlength=len(distinct) + 1)[:-1]
        order = np.argsort(-np.bincount(tokens, minlength=len(distinct) + 1), kind="stable")  # frequent words get small numbers
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        bucket = _dealt(_hashed(distinct, 1)[0], 0, buckets)
        by_bucket = np.argsort(bucket, kind="stable")
        place = np.full(len(distinct) + 1, -1, np.int32)  # of each word among those asked
        place[by_bucket] = np.arange(len(distinct), dtype=np.int32)
        doc_id = part.column("doc_id")
        z = _packed(
            doc_id=doc_id.fill_null(0).to_numpy(), no_id=doc_id.is_null().to_numpy(zero_copy_only=False), held_out=out, sizes=sizes, tokens=rank[tokens], place=place[order])
        yield from _rows(WORDS, 1, kind=BLOCK, block=block, n=int((~out).sum()), z=[z])
        bucket = bucket[by_bucket]
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(starts, len(bucket)).astype(np.int64)), distinct.take(pa.array(by_bucket)))
        names = _pressed(pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).to_pylist())
        counts = _stretches(learned[by_bucket].astype(np.uint32), np.diff(np.append(starts, len(bucket))))
        yield from _rows(WORDS, len(starts), kind=ASK, block=block, slot=np.arange(len(starts)), bucket=bucket[starts], names=names, counts=counts)


def _whole_buckets(batches: Iterator[pa.RecordBatch], run) -> Iterator[pa.RecordBatch]:
    """run(rows) over rows that are sorted by bucket, one bucket at a time with all of its rows; memory is given back after each."""
    held: list[pa.RecordBatch] = []

    def whole() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        yield from run(table)

    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column("bucket").to_numpy()
        starts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
        for start, end in zip(starts, np.append(starts[1:], len(bucket))):
            if held and held[-1].column("bucket")[-1].as_py() != bucket[start]:
                yield from whole()
                give_back()
            held.append(batch.slice(start, end - start))  # the last one may go on in the next batch
    if held:
        yield from whole()


def _named(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Training counts of the words of each row, numbers of the frequent ones, and sums over all words."""
    numbered = 0

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal numbered
        found, offsets = words.split(pa.array(_expanded(table.column("names")), pa.large_binary()))
        ids, distinct = words.numbered(found)
        total = np.bincount(ids, weights=_values(table.column("counts"), np.uint32)[0], minlength=len(distinct)).astype(np.int64)
        large = total >= least
        symbol = np.zeros(len(distinct), np.int64)
        symbol[large] = ((numbered + np.arange(int(large.sum()))) << NUMBER_BITS | TaskContext.get().partitionId()) + END + 1
        numbered += int(large.sum())
        sizes = np.diff(offsets)
        shared = total[~large]
        yield from _rows(
            NAMED, table.num_rows, kind=ASK, block=table.column("block").to_numpy(), slot=table.column("slot").to_numpy(), counts=_stretches(total[ids].astype(np.uint64), sizes),
            symbols=_stretches(symbol[ids][large[ids]].astype(np.uint64), _sums(large[ids].astype(np.int64), sizes)))
        sums = {"every": total.sum(), "kinds": (total > 0).sum(), "rare": (shared[shared > 0] + 1).sum(), "rare_count": shared.sum(), "top": symbol.max(initial=0)}
        yield from _rows(NAMED, 1, kind=CONTEXT, **{k: int(v) for k, v in sums.items()})

    yield from _whole_buckets(batches, run)


def _asks(
    block: int, held: dict, key: np.ndarray, at: np.ndarray, contexts: np.ndarray, often: np.ndarray, ln: np.ndarray | None, buckets: int, kind,
) -> tuple[np.ndarray, list[pa.RecordBatch], dict]:
    """(number of the pair at each place, rows that ask, what a block has to remember).

    key is (own context number) * symbols + (own symbol number) at the places `at` of all tokens. contexts and often are the
    corpus's numbers and counts of own contexts; ln is the log-probability so far at these places. Pairs are numbered by
    bucket, context and symbol; the pairs of a context in a bucket are a run.
    """
    symbols = held["symbols"]
    pairs, first, slot = np.unique(key, return_index=True, return_inverse=True)
    del key
    own, symbol = np.divmod(pairs, len(symbols))
    bucket = _dealt(contexts[own], symbols[symbol] % (1 + often[own] // BUCKET), buckets)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    own, symbol, bucket, first = own[order], symbol[order], bucket[order], first[order]
    slot = rank[slot]
    learned = np.bincount(slot[~np.repeat(held["held_out"], held["sizes"])[at]], minlength=len(pairs))
    before = held["ln0"][symbol] if ln is None else ln[first].astype(np.float32)
    opens = (np.diff(own, prepend=-1) != 0) | (np.diff(bucket, prepend=-1) != 0)
    starts = np.flatnonzero(opens)
    sizes = np.diff(np.append(starts, len(own)))
    steps = np.diff(symbols[symbol], prepend=0)
    steps[starts] = symbols[symbol[starts]]
    run_bucket, run_context = bucket[starts], contexts[own[starts]]
    rows_at = np.flatnonzero(np.diff(run_bucket, prepend=-1))
    runs = np.diff(np.append(rows_at, len(starts)))
    per_row = np.diff(np.append(starts[rows_at], len(own)))
    spread = often[own[starts]] >= BUCKET
    rows = [*_rows(
        ASKS, len(rows_at), kind=ASK, block=block, slot=np.arange(len(rows_at)), bucket=run_bucket[rows_at], contexts=_stretches(run_context, runs),
        sizes=_stretches(sizes.astype(np.uint32) | SPREAD * spread.astype(np.uint32), runs), symbols=_stretches(steps.astype(kind), per_row),
        counts=_stretches(learned.astype(np.uint32), per_row), lns=_stretches(_steps_of(before), per_row))]
    apart = np.flatnonzero(spread)
    for row in _rows(ASKS, len(apart), kind=CONTEXT, block=block, slot=apart, context=run_context[apart]):
        rows.append(row)
    return slot, rows, {"before": before, "runs": sizes.astype(np.int32)}


def _steps_of(ln: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-ln.astype(np.float64) * NATS), 65_535).astype(np.uint16)


def _in_order(answers: pa.Table) -> tuple[pa.Table, pa.Table]:
    """(answers to the rows asked, in their order; answers on contexts)."""
    answers = answers.combine_chunks()
    answers = answers.take(pa.array(np.lexsort((answers.column("slot").to_numpy(), answers.column("kind").to_numpy()))))
    asked = int((answers.column("kind").to_numpy() == ASK).sum())
    return answers.slice(0, asked), answers.slice(asked)


def _opened(block: int, z: bytes, answers: pa.Table, sums: dict, least: int, buckets: int, kind) -> Iterator[pa.RecordBatch]:
    """Base scores of a block's documents and its pairs of neighbouring symbols."""
    held = _unpacked(z)
    answers, _ = _in_order(answers)
    got = _values(answers.column("counts"), np.uint64)[0].astype(np.int64)
    known = np.full(len(got), RARE, np.int64)
    known[got >= least] = _values(answers.column("symbols"), np.uint64)[0].astype(np.int64)
    place, tokens, sizes = held.pop("place"), held.pop("tokens"), held["sizes"]
    count, symbol = np.append(got, sums["ends"])[place], np.append(known, END)[place]  # place -1 is the end
    ln = np.log((count + 1) / sums["total"])
    held["n_known"] = _sums((count > 0)[tokens].astype(np.int64), sizes)
    held["base_ln"] = _sums(ln[tokens], sizes)
    held["ln"] = held["base_ln"].copy()
    held["symbols"], at, own = np.unique(symbol, return_index=True, return_inverse=True)
    shared = held["symbols"] == RARE
    held["ln0"] = np.where(shared, np.log(sums["rare"] / sums["total"]), ln[at]).astype(np.float32)
    held["often"] = np.where(shared, sums["rare_count"], count[at])
    held["own"] = own.astype(np.int32)[tokens]
    _, rows, _ = _asks(block, held, *_neighbours(held), held["symbols"], held["often"], None, buckets, kind)
    yield from _rows(ASKS, 1, kind=BLOCK, block=block, z=[_packed(**held)])
    yield from rows


def _neighbours(held: dict) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places) of all tokens that have another before them in their text."""
    inner = np.ones(len(held["own"]), bool)
    inner[np.cumsum(held["sizes"]) - held["sizes"]] = False
    at = np.flatnonzero(inner)
    return held["own"][at - 1].astype(np.int64) * len(held["symbols"]) + held["own"][at], at


def _stepped(block: int, z: bytes, answers: pa.Table, length: int, depth: int, least: int, buckets: int, kind) -> Iterator[pa.RecordBatch]:
    """What contexts of this length add to the scores, and the pairs of the next length unless this is the last."""
    held = _unpacked(z)
    sizes = held["sizes"]
    if length == 1:
        key, at = _neighbours(held)
        slot, _, more = _asks(block, held, key, at, held["symbols"], held["often"], None, buckets, kind)
        held |= more
    elif length == depth:
        slot, at = np.cumsum(held.pop("steps"), dtype=np.int64), None
    else:
        slot, at = held.pop("slot"), np.cumsum(held.pop("at"), dtype=np.int64)
    before, runs = held.pop("before").astype(np.float64), held.pop("runs")
    asked, contexts = _in_order(answers)
    count = _values(asked.column("counts"), np.uint32)[0].astype(np.int64)
    child = np.full(len(count), -1, np.int64)
    child[count >= least] = _values(asked.column("children"), np.int64)[0]
    scale = _values(asked.column("scales"), np.float64)[0]
    left = 1 - _values(asked.column("owns"), np.int64)[0] / np.maximum(scale, 1)
    at_run = contexts.column("slot").to_numpy()
    scale[at_run], left[at_run] = contexts.column("x").to_numpy(), contexts.column("left").to_numpy()
    del asked, contexts
    scale, left = np.repeat(scale, runs), np.repeat(left, runs)
    kept = scale > 0  # contexts that are not retained pass their suffix's distribution on
    gain = np.zeros(len(count))
    gain[kept] = np.log(np.where(count[kept] >= SEEN, count[kept], 0) / scale[kept] + left[kept] * np.exp(before[kept])) - before[kept]
    n_tokens = int(sizes.sum())
    if at is None:
        held["ln"] = held["ln"] + _sums(gain[slot], held.pop("many"))
    else:
        gained = np.zeros(n_tokens)
        gained[at] = gain[slot]
        held["ln"] = held["ln"] + _sums(gained, sizes)
        del gained
    if length == depth:
        doc_id = pa.array(held["doc_id"], mask=held["no_id"])
        columns = [doc_id, *(pa.array(held[c]) for c in ("held_out", "sizes", "n_known", "base_ln", "ln"))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "base_ln", "ln"])
        return
    after = np.full(n_tokens + 1, -1, np.int64)  # number of the pair that ends just before each token
    after[at + 1] = np.where(child[slot] >= 0, slot, -1)
    starts = np.cumsum(sizes) - sizes
    after[starts] = -1
    here = np.flatnonzero(after[:-1] >= 0)
    key = [after[here] * len(held["symbols"]) + held["own"][here]]
    del after
    now = np.zeros(n_tokens)
    now[at] = (before + gain)[slot]
    ln = [now[here]]
    del now, at, slot, before, gain, scale, left, kept
    slot, rows, more = _asks(block, held, key.pop(), here, child, count, ln.pop(), buckets, kind)
    if length + 1 == depth:  # all that is left is to add up: each document's pairs, in whatever order
        doc = np.searchsorted(np.cumsum(sizes), here, "right")
        sorted_slot = slot[np.lexsort((slot, doc))]
        held = {k: v for k, v in held.items() if k not in ("own", "symbols", "ln0", "often")}
        held |= more | {"steps": np.diff(sorted_slot, prepend=sorted_slot.dtype.type(0)), "many": np.bincount(doc, minlength=len(sizes))}
    else:
        held |= more | {"slot": slot, "at": np.diff(here, prepend=0).astype(np.int32 if n_tokens < 1 << 31 else np.int64)}
    yield from _rows(ASKS, 1, kind=BLOCK, block=block, z=[_packed(**held)])
    yield from rows


def _per_block(stored: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """run(block, z, answers) over every block and what came back for it."""
    names = schema.replace(",", "").split()[::2]

    def both(blocks: pa.Table, got: pa.Table) -> pa.Table:
        out = []
        for block, z in zip(blocks.column("part").to_pylist(), blocks.column("z").to_pylist()):
            out += run(block, z, got)
        table = pa.Table.from_batches(out).select(names)
        give_back()
        return table

    blocks = stored.filter(F.col("kind") == BLOCK).select(F.col("block").alias("part"), "z")
    return blocks.groupBy("part").cogroup(answers.groupBy("block")).applyInArrow(lambda a, b: both(a, b), schema)


def _judged(every, kinds, own, once, lift, least: int, gain: float) -> np.ndarray:
    """Scale of contexts from their sums; 0 for those that are not retained."""
    scale = (every + kinds).astype(np.float64)
    left = 1 - own / np.maximum(scale, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        diverges = lift - own * np.log(scale) + np.where(once > 0, once * np.log(left), 0.0) >= gain
    kept = (every >= least) & diverges
    return np.where(kept, scale, 0.0)


def _counted(batches: Iterator[pa.RecordBatch], least: int, gain: float, kind) -> Iterator[pa.RecordBatch]:
    """Counts of the pairs of each row, numbers of the contexts that frequent pairs form, and verdicts on contexts; sums of spread ones."""
    number = TaskContext.get().partitionId() << 40

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal number
        context, runs = _values(table.column("contexts"), np.int64)
        sizes = _values(table.column("sizes"), np.uint32)[0]
        spread, sizes = (sizes & SPREAD) > 0, (sizes & ~SPREAD).astype(np.int64)
        steps, per_row = _values(table.column("symbols"), kind)
        counts, lns = _values(table.column("counts"), np.uint32)[0], _values(table.column("lns"), np.uint16)[0]
        starts, upto = np.cumsum(sizes) - sizes, np.cumsum(steps, dtype=np.int64)
        symbol = upto - np.repeat(upto[starts] - steps[starts].astype(np.int64), sizes)
        del steps, upto
        if np.dtype(kind).itemsize > 4:
            symbol = np.unique(symbol, return_inverse=True)[1]
        contexts, place, which = np.unique(context, return_index=True, return_inverse=True)
        symbol |= np.repeat(which, sizes) << 32
        pair, first, at = np.unique(symbol, return_index=True, return_inverse=True)
        del symbol
        total = np.bincount(at, weights=counts, minlength=len(pair)).astype(np.int64)
        of = pair >> 32
        add = lambda values: np.bincount(of, weights=values, minlength=len(contexts))
        often = total >= SEEN
        lift = np.zeros(len(total))
        lift[often] = total[often] * (np.log(total[often] - 1) + lns[first[often]] / NATS)
        sums = [add(v).astype(np.int64) for v in (total, total > 0, np.where(often, total, 0), total == 1)] + [add(lift)]
        scale = _judged(*sums, least, gain)
        apart = spread[place]
        scale[apart] = 0.0
        child = np.full(len(pair), -1, np.int64)
        large = total >= least
        child[large] = number + np.arange(int(large.sum()))
        number += int(large.sum())
        yield from _rows(
            COUNTED, table.num_rows, kind=ASK, block=table.column("block").to_numpy(), slot=table.column("slot").to_numpy(), counts=_stretches(total[at].astype(np.uint32), per_row),
            children=_stretches(child[at][large[at]], _sums(large[at].astype(np.int64), per_row)), scales=_stretches(scale[which], runs),
            owns=_stretches(np.where(scale > 0, sums[2], 0)[which], runs))
        names = ("every", "kinds", "own", "once", "lift")
        yield from _rows(COUNTED, int(apart.sum()), kind=CONTEXT, context=contexts[apart], **{k: v[apart] for k, v in zip(names, sums)})

    yield from _whole_buckets(batches, run)


def _by_bucket(asked: DataFrame, run, schema: str) -> DataFrame:
    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(releasing(run), schema)


def _kept(df: DataFrame, label: str, rows: int = WIDE) -> tuple[str, DataFrame]:
    """(folder, table) of df as stored, with a folder for each kind of rows, which can be dropped on its own; shuffle files are freed."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    name = "spark.sql.maxConcurrentOutputFileWriters"  # a file for each kind is open at once; otherwise a task sorts its rows by kind
    before = spark.conf.get(name)
    spark.conf.set(name, "8")
    try:
        with text_batches(spark, rows):
            df.write.partitionBy("kind").parquet(path) if "kind" in df.columns else df.write.parquet(path)
    finally:
        spark.conf.set(name, before)
    release(spark)
    return path, spark.read.schema(df.schema).parquet(path)


def _answers(paths: list[str], stored: DataFrame, least: int, gain: float, kind) -> tuple[str, DataFrame]:
    """(folder of the counts, what goes back to the blocks): counts, new contexts and verdicts for each row asked; x (scale) and left for retained spread
    contexts. The rows asked, stored below paths, are dropped once they are counted.
    """
    asked = stored.filter(F.col("kind") == ASK).select("block", "slot", "bucket", "contexts", "sizes", "symbols", "counts", "lns")

    def run(batches):
        yield from _counted(batches, least, gain, kind)

    made, counted = _kept(_by_bucket(asked, run, COUNTED), "counted")
    drop(stored.sparkSession, [f"{path}/kind={ASK}" for path in paths])
    names = ("every", "kinds", "own", "once", "lift")
    sums = counted.filter(F.col("kind") == CONTEXT).groupBy("context").agg(*(F.sum(c).alias(c) for c in names))
    scale = (F.col("every") + F.col("kinds")).cast("double")
    sums = sums.filter(F.col("every") >= least).withColumn("left", 1 - F.col("own") / scale)
    diverges = F.col("lift") - F.col("own") * F.ln(scale) + F.when(F.col("once") > 0, F.col("once") * F.ln("left")).otherwise(0.0) >= gain
    kept = materialise(sums.filter(diverges).select("context", scale.alias("x"), "left"), "retained")
    contexts = stored.filter(F.col("kind") == CONTEXT).select("block", "slot", "context").join(kept, "context")
    binary = ("counts", "children", "scales", "owns")
    contexts = contexts.select("block", F.lit(CONTEXT).alias("kind"), "slot", *(F.lit(None).cast("binary").alias(c) for c in binary), "x", "left")
    none = F.lit(None).cast("double")
    return made, counted.filter(F.col("kind") == ASK).select("block", F.lit(ASK).alias("kind"), "slot", *binary, none.alias("x"), none.alias("left")).unionByName(contexts)


def scores(
    docs: DataFrame, depth: int = 2, least: int = 500, gain: float = 10.0, id_col: str = "doc_id", text_col: str = "text", held: object = None,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs.

    held is a boolean column that marks rows the model must not learn from (by default a seventh of the ids). n_tokens counts words and the end, n_known those that training
    text holds, train_tokens all training tokens. base_score and score are log10 probabilities of the text: of the unigram
    model (count + 1 over train_tokens + different tokens + 1), and of the tree.
    Null and empty texts are an end only. Rows without an id are scored and not learned from; repeated rows count and come back each time; without any training row every token has
    probability one. Other columns are not read.
    """
    if depth < 1 or least < SEEN:
        raise ValueError("contexts need a length of 1 or more and 2 or more occurrences")
    spark = docs.sparkSession
    marked = held_out(id_col) if held is None else F.coalesce(held, F.lit(True))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"), marked.alias("held_out"), F.col(text_col).cast("binary").alias("t"))

    buckets = max(64, -(-input_bytes(docs) // BLOCK_BYTES))

    def run(batches):
        yield from _read(batches, buckets)

    def name(batches):
        yield from _named(batches, least)

    path, stored = _kept(rows.mapInArrow(releasing(run), WORDS), "blocks", TEXTS)
    ends = stored.filter(F.col("kind") == BLOCK).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    asked = stored.filter(F.col("kind") == ASK).select("block", "slot", "bucket", "names", "counts")
    made, named = _kept(_by_bucket(asked, name, NAMED), "words")
    drop(spark, [f"{path}/kind={ASK}"])
    s = named.filter(F.col("kind") == CONTEXT).agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("every", "kinds", "rare", "rare_count")), F.coalesce(F.max("top"), F.lit(0)).alias("top")).first()
    train = s["every"] + ends
    sums = {"ends": ends, "total": float(train + s["kinds"] + (ends > 0) + 1), "rare": float(s["rare"] + 1), "rare_count": s["rare_count"]}
    kind = np.uint32 if s["top"] < 1 << 32 else np.uint64
    answers = named.filter(F.col("kind") == ASK).select("kind", "block", "slot", "counts", "symbols")
    before = path
    path, stored = _kept(_per_block(stored, answers, lambda block, z, got: _opened(block, z, got, sums, least, buckets, kind), ASKS), "blocks")
    drop(spark, [before, made])
    paths, waves = [path], min(WAVES, max(1, input_bytes(docs) // (8 * BLOCK_BYTES)))
    for length in range(1, depth + 1):
        before = paths
        made, answers = _answers(paths, stored, least, gain, kind)
        parts = []
        for wave in range(waves):
            own = lambda df: df.filter(F.pmod(F.xxhash64("block"), F.lit(waves)) == wave)  # noqa: B023, E731
            found = _per_block(own(stored), own(answers), lambda block, z, got, k=length: _stepped(block, z, got, k, depth, least, buckets, kind), SCORED if length == depth else ASKS)
            parts.append(_kept(found, "blocks"))
        drop(spark, [*before, made])
        del found, answers
        release(spark)
        paths, stored = [p for p, _ in parts], reduce(DataFrame.unionByName, (df for _, df in parts))
    ten = float(np.log(10))
    return stored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(train).cast("bigint").alias("train_tokens"), (F.col("base_ln") / ten).alias("base_score"), (F.col("ln") / ten).alias("score"))
