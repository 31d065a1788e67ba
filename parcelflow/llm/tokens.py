"""Token ids of whole texts from a tokenizer file, with each distinct piece of text encoded once per worker.

Pieces are cut where the tokenizer's own first split cuts in any case, so the ids equal those of the whole text:
`space` files (byte-level, a space belongs to the next word) between a character and a single space, `white` files
(white space dropped) at spaces and line feeds. Texts where that is not certain are encoded whole: texts that name a
special token and, for `space` files, texts with a space at either end or beside another white space. Cutting, looking up
and putting together are column operations; only new pieces go to the tokenizer.
"""

from __future__ import annotations

import gc
import os
import re
import sys
import threading
import time
from array import array
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from parcelflow.llm.common import byte_column, give_back

MOST = 800_000  # pieces that a worker remembers; beyond that it keeps those met most often
IDLE_SECONDS = 10  # after which it forgets them
LONGEST = 96  # bytes of a piece that is remembered; texts with longer ones are encoded whole
JOINED = 1000  # new pieces that go to the tokenizer as one text
WORDS = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)?([!-/:-@\[-`{-~]*)")  # pieces whose words are certain in `white` files


def _hashed(pieces: pa.Array, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes, lengths in bytes) of a string column; only the first LONGEST bytes are hashed."""
    data, offsets = byte_column(pieces)
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = offsets[:-1][order], np.minimum(lengths[order], LONGEST)
    h = np.full(len(order), salt * 0xD6E8FEB86659FD93 % 2**64, np.uint64)
    for k in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, "left"))  # pieces of more than k bytes
        h[:n] = (h[:n] ^ data[starts[:n] + k]) * np.uint64(0x9E3779B97F4A7C15)
        h[:n] ^= h[:n] >> np.uint64(32)
    h = (h ^ lengths[order].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    out = np.empty(len(order), np.uint64)
    out[order] = h
    return out, lengths


class Encoder:
    """Pieces met so far and their ids; piece 0 has none."""

    def __init__(self, path: str, cut: str, most: int = MOST):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer, self.cut, self.most = Tokenizer.from_file(path), cut, most
        vocab = self.tokenizer.get_vocab()
        self.lock, self.used, self.watched = threading.Lock(), time.monotonic(), False
        self.marks = np.zeros(max(vocab.values()) + 1, bool)  # ids that begin a piece (space) or end a word (white)
        self.marks[[i for t, i in vocab.items() if (t.startswith("\u0120") if cut == "space" else t.endswith("</w>"))]] = True
        self._forget()

    @classmethod
    def kept(cls, path: str, cut: str) -> Encoder:
        """The worker's encoder for a file: a reused Python worker goes on with what it knows.

        What is known is let go once no task has used it for a while, so it takes no memory from later stages.
        """
        held = sys.modules.setdefault("_kept_token_encoders", ModuleType("_kept_token_encoders")).__dict__
        if (path, cut) not in held:
            held[path, cut] = cls(path, cut)
        return held[path, cut]

    def _let_go(self) -> None:
        while True:
            time.sleep(1)
            with self.lock:
                if time.monotonic() - self.used > IDLE_SECONDS:
                    self._forget()
                    self.watched = False
                    break
        gc.collect()
        pa.default_memory_pool().release_unused()
        give_back()

    def _forget(self) -> None:
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes of known pieces, ascending
        self.values, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.met = np.zeros(1, np.int32)  # batches that held each piece, halved whenever pieces are dropped

    def _shrink(self) -> None:
        """Keep the pieces that were met most often, half of what may be remembered."""
        keep = np.sort(np.argsort(-self.met[1:], kind="stable")[: self.most // 2] + 1)
        keep = np.concatenate(([0], keep[self.met[keep] > 1]))
        renumbered = np.full(len(self.starts), -1, np.int32)
        renumbered[keep] = np.arange(len(keep))
        lengths = self.lengths[keep]
        ends = np.cumsum(lengths)
        self.values = self.values[np.repeat(self.starts[keep] - ends + lengths, lengths) + np.arange(ends[-1])]
        self.starts, self.lengths, self.met = ends - lengths, lengths, self.met[keep] // 2
        kept = renumbered[self.numbers] >= 0
        self.keys, self.numbers = self.keys[kept], renumbered[self.numbers[kept]]

    def _add(self, texts: list[str]) -> int:
        """Number of the first of these texts, whose ids are added in order."""
        number, ids, lengths = len(self.starts), array("I"), []
        for i in range(0, len(texts), 10_000):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + 10_000], add_special_tokens=False):
                found = e.ids
                ids.extend(found)
                lengths.append(len(found))
        new = np.array(lengths, np.int64)
        starts = len(self.values) + np.cumsum(new) - new
        self.values = np.concatenate((self.values, np.frombuffer(ids, np.uint32)))
        self.starts, self.lengths = np.concatenate((self.starts, starts)), np.concatenate((self.lengths, new))
        return number

    def _add_joined(self, pieces: list[str], words: np.ndarray) -> int | None:
        """Like _add, for many pieces in one text, told apart by the marks among the ids: one at the start of each piece
        (space) or one at the end of each of its words (white). None if the marks do not fit."""
        space = self.cut == "space"
        texts = [" " * space + " ".join(pieces[i : i + JOINED]) for i in range(0, len(pieces), JOINED)]
        found = []
        for i in range(0, len(texts), 16):  # an encoding holds far more than its ids
            found += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts[i : i + 16], add_special_tokens=False)]
        wanted = np.add.reduceat(words, np.arange(0, len(pieces), JOINED))
        edge = 0 if space else -1
        if any(not len(f) or self.marks[f].sum() != n or not self.marks[f[edge]] for f, n in zip(found, wanted)):
            return None
        ids = np.concatenate(found)
        marked = np.flatnonzero(self.marks[ids])
        starts = marked if space else np.concatenate(([0], marked[np.cumsum(words)[:-1] - 1] + 1))
        number = len(self.starts)
        self.starts = np.concatenate((self.starts, len(self.values) + starts))
        self.lengths = np.concatenate((self.lengths, np.diff(np.append(starts, len(ids)))))
        self.values = np.concatenate((self.values, ids))
        return number

    def _learn(self, new: list[str], lead: str) -> np.ndarray:
        """Numbers of pieces that are not known yet."""
        if self.cut == "white":
            matched = [WORDS.fullmatch(p) for p in new]
            words = np.array([bool(m[1]) + bool(m[2]) if m else 0 for m in matched], np.int64)
        else:
            words = np.full(len(new), int(bool(lead)), np.int64)
        numbers = np.full(len(new), -1, np.int64)
        joined = np.flatnonzero(words)
        at = self._add_joined([new[i] for i in joined], words[joined]) if len(joined) else None
        if at is not None:
            numbers[joined] = at + np.arange(len(joined))
        rest = np.flatnonzero(numbers < 0)
        if len(rest):
            numbers[rest] = self._add([lead + new[i] for i in rest]) + np.arange(len(rest))
        return numbers

    def _numbers(self, pieces: pa.Array, lead: str) -> np.ndarray:
        """Numbers of distinct pieces; -1 where a piece is uncertain."""
        hashes, lengths = _hashed(pieces, len(lead) + 1)
        at = np.minimum(np.searchsorted(self.keys, hashes), max(0, len(self.keys) - 1))
        known = self.keys[at] == hashes if len(self.keys) else np.zeros(len(hashes), bool)
        numbers = np.full(len(hashes), -1, np.int64)
        numbers[known] = self.numbers[at[known]]
        if self.cut == "white":
            numbers[lengths == 0] = 0
        unknown = np.flatnonzero((numbers < 0) & (lengths > 0) & (lengths <= LONGEST))
        texts = pieces.take(pa.array(unknown)).to_pylist()
        sure = [i for i, t in enumerate(texts) if not self._uncertain(t)]
        if sure:
            new = unknown[sure]
            numbers[new] = self._learn([texts[i] for i in sure], lead)
            order = np.argsort(hashes[new])
            place = np.searchsorted(self.keys, hashes[new][order])
            self.keys = np.insert(self.keys, place, hashes[new][order])
            self.numbers = np.insert(self.numbers, place, numbers[new][order].astype(np.int32))
        self.met = np.concatenate((self.met, np.zeros(len(self.starts) - len(self.met), np.int32)))
        self.met[numbers[numbers > 0]] += 1
        return numbers

    def _uncertain(self, piece: str) -> bool:
        return "<|" in piece or (self.cut == "space" and (not piece or piece[0].isspace() or piece[-1].isspace()))

    def columns(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of a string column; null counts as empty."""
        with self.lock:
            if not self.watched:
                self.watched = True
                threading.Thread(target=self._let_go, daemon=True).start()
            found = self._columns(texts)
            self.used = time.monotonic()
        return found

    def _columns(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if len(self.starts) > self.most:
            self._shrink()
        space = self.cut == "space"
        lists = pc.split_pattern(texts if space else pc.replace_substring(texts, "\n", " "), " ")
        cuts = lists.offsets.to_numpy().astype(np.int64)
        cuts -= cuts[0]
        coded = lists.flatten().dictionary_encode()
        place = coded.indices.to_numpy()
        which = self._numbers(coded.dictionary, " " if space else "")[place]
        if space:
            heads = lists.flatten().take(pa.array(cuts[:-1])).dictionary_encode()
            which[cuts[:-1]] = self._numbers(heads.dictionary, "")[heads.indices.to_numpy()]
        in_doubt = np.flatnonzero(which < 0)
        size = len(self.values), len(self.starts)
        if len(in_doubt):
            rows = np.unique(np.searchsorted(cuts, in_doubt, "right") - 1)
            for row, number in zip(rows, range(self._add(texts.take(pa.array(rows)).to_pylist()), len(self.starts))):
                which[cuts[row] : cuts[row + 1]] = 0
                which[cuts[row]] = number
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        kind = np.int32 if ends[-1] < 2**31 and len(self.values) < 2**31 else np.int64
        at = np.repeat((self.starts[which] - ends + lengths).astype(kind), lengths)
        at += np.arange(len(at), dtype=kind)
        ids, offsets = self.values[at], np.concatenate(([0], ends))[cuts]
        if len(in_doubt):  # whole texts are not remembered
            self.values, self.starts, self.lengths = self.values[: size[0]], self.starts[: size[1]], self.lengths[: size[1]]
        return ids, offsets

    def closed(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) with end_id after the ids of every text."""
        ids, offsets = self.columns(texts)
        n = len(offsets) - 1
        return np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(n + 1)
