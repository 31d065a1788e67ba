"""Alignment of the tokens that two tokenizers give the same texts, with corpus-wide counts of linked id pairs.

Both tokenizers see the text behind one space. Anchors are verified ends that both share before tokens that begin with a space
on both sides (and the end of a text). They split a document into short windows of token ids; since ids determine their bytes,
a window's alignment follows from its ids alone and is remembered by them. Inside a window, byte offsets where both sides
end cut the tokens into groups, and the two tokens that end there are linked.

Documents are worked on in blocks of bounded size. A block is stored with its documents' links as places in the block's
own list of id pairs; that list, with counts, is summed by pair over the corpus, and each block gets its pairs' sums back.
"""

from __future__ import annotations

import hashlib
import os
import sys
import threading
import time
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import byte_column, give_back, releasing, slices, text_batches
from parcelflow.llm.tokens import Encoder
from parcelflow.llm.words import gathered
from parcelflow.session import materialise

BLOCK_BYTES = 1 << 24
SLICE_BYTES = 1 << 21
PIECES = 300_000  # pieces of text that a worker remembers for each tokenizer
WINDOWS = 300_000  # alignments that it remembers
CHUNK = 1 << 20  # tokens whose bytes are compared at a time
SPACE = "▁"  # stands for a space in the pieces of .model files


class _Found:
    def __init__(self, ids):
        self.ids = ids


class _Pieces:
    """A .model file behind the interface of a .json one; texts come with the space that the model adds by itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)

    def encode_batch_fast(self, texts: list[str], add_special_tokens: bool = False) -> list[_Found]:
        return [_Found(ids) for ids in self.model.encode([t[1:] for t in texts], num_threads=1)]

    def bytes_of(self) -> list[bytes]:
        m = self.model
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        return [bytes([int(t[3:5], 16)]) if m.is_byte(i) else t.replace(SPACE, " ").encode() for i, t in enumerate(names)]


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies use: printable Latin-1 stands for itself, other bytes count on from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Bytes:
    """A byte-level .json file; names of special tokens in texts are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True

    def encode_batch_fast(self, texts: list[str], add_special_tokens: bool = False):
        return self.model.encode_batch_fast(texts, add_special_tokens=False)

    def bytes_of(self) -> list[bytes]:
        letters, vocab = _byte_letters(), self.model.get_vocab()
        out = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        return out


class Spaced(Encoder):
    """Ids and bytes of texts that all begin with a space of their own (given without it)."""

    def __init__(self, path: str, most: int = PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.cut, self.most = (_Pieces if path.endswith(".model") else _Bytes)(path), "space", most
        self.lock, self.used, self.watched = threading.Lock(), time.monotonic(), False
        known = self.tokenizer.bytes_of()
        self.sizes = np.array([len(b) for b in known], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(known), np.uint8)
        self.marks = np.array([b.startswith(b" ") for b in known])
        self._forget()

    @classmethod
    def kept(cls, path: str) -> Spaced:
        held = sys.modules.setdefault("_kept_spaced_encoders", ModuleType("_kept_spaced_encoders")).__dict__
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def _numbers(self, pieces: pa.Array, lead: str) -> np.ndarray:
        return super()._numbers(pieces, lead) if lead else np.zeros(len(pieces), np.int64)  # nothing stands before the first space

    def spaced(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets, sound) of non-empty texts: sound where the bytes of the ids are the space and the text."""
        texts = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.cast(pa.large_string()), pa.scalar(" ", pa.large_string()))
        ids, offsets = self.columns(texts)
        data, places = byte_column(texts)
        lengths = np.concatenate(([0], np.cumsum(self.sizes[ids])))
        sound = np.diff(lengths[offsets]) == np.diff(places)
        of = np.repeat(np.arange(len(texts)), np.diff(offsets))  # the row of each token
        shift = places[:-1] - lengths[offsets[:-1]]
        for start in range(0, len(ids), CHUNK):
            part = ids[start : start + CHUNK]
            row = np.repeat(of[start : start + CHUNK], self.sizes[part])
            own = self.bytes[gathered(self.places[part], self.sizes[part])]
            at = shift[row] + np.arange(lengths[start], lengths[start] + len(row))
            same = own == data[np.minimum(at, len(data) - 1)]
            sound[row[~same]] = False
        return ids, offsets, sound


def _names(n: int) -> pa.Array:
    return pa.array(map(str, range(n)), pa.large_string())


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes)))), values)


class Windows:
    """Alignments of id windows met so far."""

    def __init__(self, a_sizes: np.ndarray, b_sizes: np.ndarray):
        self.sizes, self.names = (a_sizes, b_sizes), (_names(len(a_sizes)), _names(len(b_sizes)))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.texts = pa.array([], pa.large_string())
        self.links = np.zeros(0, np.int64)  # a << 32 | b of the tokens that end together, one for each group
        self.counts = np.zeros(0, np.int64)

    def _align(self, keys: pa.Array) -> None:
        """Add the alignments of new keys: what both sides hold is as long, so bytes can be counted through all of them."""
        data, offsets = byte_column(keys)
        data, starts = data.view(np.uint32).astype(np.int64), offsets // 4
        n_a = data[starts[:-1]]
        n_b = np.diff(starts) - 1 - n_a
        ids = data[gathered(starts[:-1] + 1, n_a)], data[gathered(starts[:-1] + 1 + n_a, n_b)]
        ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids)]
        cuts, parts = [], []
        for own, other, i, names in ((0, 1, ids[0], self.names[0]), (1, 0, ids[1], self.names[1])):
            shared = np.zeros(int(ends[own][-1]) + 1, bool)
            shared[ends[other]] = True
            cut = np.flatnonzero(shared[ends[own]])  # the last token of each group
            cuts.append(cut)
            parts.append(pc.binary_join(_lists(np.diff(cut, prepend=-1), names.take(pa.array(i))), pa.scalar(",", pa.large_string())))
        groups = pc.binary_join_element_wise(*parts, pa.scalar("|", pa.large_string()))
        upto = np.searchsorted(cuts[0], np.cumsum(n_a) - 1, "right")
        counts = np.diff(upto, prepend=0)
        self.texts = pa.concat_arrays([self.texts, pc.binary_join(_lists(counts, groups), pa.scalar(";", pa.large_string()))])
        self.links = np.concatenate((self.links, ids[0][cuts[0]] << 32 | ids[1][cuts[1]]))
        self.counts = np.concatenate((self.counts, counts))

    def numbers(self, keys: pa.Array) -> np.ndarray:
        """Number of the alignment of each key: the count of A ids, the A ids and the B ids as 32-bit integers."""
        coded = keys.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > WINDOWS and self.known:
            self._forget()
        numbers = np.array([self.known.get(key, -1) for key in distinct], np.int64)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = np.arange(len(self.counts), len(self.counts) + len(new))
            self.known.update(zip(map(distinct.__getitem__, new.tolist()), numbers[new].tolist()))
            self._align(coded.dictionary.take(pa.array(new)))
        return numbers[coded.indices.to_numpy()]


def _tokens(ids: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of some rows."""
    sizes = np.diff(offsets)[rows]
    return ids[gathered(offsets[:-1][rows], sizes)], np.concatenate(([0], np.cumsum(sizes)))


def align(texts: pa.Array, a: Spaced, b: Spaced, windows: Windows) -> dict[str, np.ndarray | pa.Array]:
    """Per text n_a, n_b, n_groups and the groups as text; links of all texts in a row, one for each group."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    rows = np.flatnonzero(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False))
    out = {"n_a": np.zeros(n, np.int64), "n_b": np.zeros(n, np.int64), "n_groups": np.zeros(n, np.int64)}
    links, strings = np.zeros(0, np.int64), [b""] * n
    if len(rows):
        chosen = texts.take(pa.array(rows))
        ids_a, at_a, fine_a = a.spaced(chosen)
        ids_b, at_b, fine_b = b.spaced(chosen)
        good = np.flatnonzero(fine_a & fine_b)
        ids_a, at_a = _tokens(ids_a, at_a, good)
        ids_b, at_b = _tokens(ids_b, at_b, good)
        rows = rows[good]
    if len(rows):
        ends_a, ends_b = np.cumsum(a.sizes[ids_a]), np.cumsum(b.sizes[ids_b])
        anchors = []
        for enc, ids, at, ends in ((a, ids_a, at_a, ends_a), (b, ids_b, at_b, ends_b)):
            before = np.ones(len(ids), bool)  # the next token begins with a space, or the text ends
            before[:-1] = enc.marks[ids[1:]]
            before[at[1:] - 1] = True
            here = np.zeros(int(ends_a[-1]) + 1, bool)
            here[ends[before]] = True
            anchors.append(here)
        anchor = anchors[0] & anchors[1]
        last_a, last_b = np.flatnonzero(anchor[ends_a]), np.flatnonzero(anchor[ends_b])
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        starts = np.cumsum(1 + size_a + size_b) - (1 + size_a + size_b)
        data = np.empty(int(starts[-1] + 1 + size_a[-1] + size_b[-1]), np.uint32)
        data[starts] = size_a
        data[gathered(starts + 1, size_a)] = ids_a
        data[gathered(starts + 1 + size_a, size_b)] = ids_b
        bounds = np.append(starts, len(data)) * 4
        keys = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
        which = windows.numbers(keys)
        counts = windows.counts
        first = np.cumsum(counts) - counts
        links = windows.links[gathered(first[which], counts[which])]
        doc_ends = np.searchsorted(last_a, at_a[1:] - 1, "right")  # windows up to the end of each text
        per_doc = np.concatenate(([0], doc_ends))
        joined = pc.binary_join(_lists(np.diff(per_doc), windows.texts.take(pa.array(which))), pa.scalar(";", pa.large_string())).cast(pa.large_binary())
        for row, text in zip(rows.tolist(), joined.to_pylist()):
            strings[row] = text
        out["n_a"][rows], out["n_b"][rows] = np.diff(at_a), np.diff(at_b)
        out["n_groups"][rows] = np.diff(np.concatenate(([0], np.cumsum(counts[which])))[per_doc])
    return out | {"links": links, "groups": strings}


FOUND = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"


def _blocks(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """For each block a row (block, z) with its documents, and a row (block, slot, a, b, n) for each of its id pairs."""
    a, b = Spaced.kept(path_a), Spaced.kept(path_b)
    windows = Windows(a.sizes, b.sizes)
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    for block in slices(batches, "t", BLOCK_BYTES):
        number = block.column("row")[0].as_py()
        links, counts, parts = [], [], []
        for part in slices([block], "t", SLICE_BYTES):
            found = align(part.column("t"), a, b, windows)
            links.append(found["links"])
            counts.append(found["n_groups"])
            digests = [hashlib.sha256(g).hexdigest() if g else "" for g in found["groups"]]
            parts.append(pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(found[c]) for c in ("n_a", "n_b", "n_groups")), pa.array(digests, pa.string())], ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]))
        pairs, place, times = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")  # frequent pairs get small numbers
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        held = pa.Table.from_batches(parts).combine_chunks()
        slots = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.concatenate(counts))))), pa.array(rank[place]))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held.append_column("slots", slots).schema, options=options) as out:
            out.write_table(held.append_column("slots", slots))
        names = ["block", "slot", "a", "b", "n", "z"]
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.nulls(1, pa.int32()), none, none, none, pa.array([sink.getvalue().to_pybytes()], pa.binary())], names)
        pairs, times = pairs[order], times[order]
        for start in range(0, len(pairs), 100_000):
            p = pairs[start : start + 100_000]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(p), number)), pa.array(np.arange(start, start + len(p), dtype=np.int32)), pa.array(p >> 32), pa.array(p & 0xFFFFFFFF),
                pa.array(times[start : start + 100_000].astype(np.int64)), pa.nulls(len(p), pa.binary())], names)


def _summed(docs: pa.Table, answers: pa.Table) -> pa.Table:
    slot = answers.column("slot").to_numpy()
    count, best = np.zeros(len(slot), np.int64), np.zeros(len(slot), bool)
    count[slot], best[slot] = answers.column("count").to_numpy(), answers.column("best").to_numpy()
    out = []
    for z in docs.column("z").to_pylist():
        for part in pa.ipc.open_stream(z):
            lists = part.column("slots")
            at, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            sums = [np.diff(np.concatenate(([0], np.cumsum(x[at].astype(np.int64))))[offsets]) for x in (best, count)]
            columns = [part.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_groups", "groups_sha256")] + [pa.array(x) for x in sums]
            out.append(pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]))
    give_back()
    kinds = [("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("n_best", pa.int64()), ("count_sum", pa.int64())]
    return pa.Table.from_batches(out, pa.schema(kinds))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row of docs, and
    (a, b, count, best) of every pair of ids that is linked anywhere.

    path_a is a byte-level .json file, path_b that or a .model file. A link joins the two tokens that end at one byte offset. count says how many links of the corpus
    join the pair; best is true where that is the most for its b, ties included. n_best and count_sum count a document's
    links with a best pair and sum their counts. groups_sha256 digests `a1,a2|b1;a3|b2,b3` (ids in order, groups by `;`).
    Null and empty texts, and texts that one tokenizer does not give back byte for byte, have no tokens: zeros and ''.
    Null ids and repeated rows all come back and count like others. Other columns are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("t"))

    def run(batches):
        yield from _blocks(batches, path_a, path_b)

    with text_batches(docs.sparkSession):
        stored = materialise(rows.mapInArrow(releasing(run), "block bigint, slot int, a bigint, b bigint, n bigint, z binary"), "aligned")
    asked = stored.filter("slot IS NOT NULL").select("block", "slot", "a", "b", "n")
    counts = materialise(asked.groupBy("a", "b").agg(F.sum("n").alias("count")), "pairs")
    most = materialise(counts.groupBy("b").agg(F.max("count").alias("most")), "most")
    pairs = materialise(counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "pairs")
    answers = asked.join(pairs, ["a", "b"]).select("block", "slot", "count", "best")
    held = stored.filter("z IS NOT NULL").select(F.col("block").alias("part"), "z")
    found = held.groupBy("part").cogroup(answers.groupBy("block")).applyInArrow(lambda docs, answers: _summed(docs, answers), FOUND)
    return found, pairs
