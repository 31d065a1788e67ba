"""Chat formatting by columnar byte assembly.

A turn becomes header + escaped text + footer. Rows are range partitioned in the order of (conversation, turn), so a
conversation of any length is spread over tasks. Each batch is assembled at once: the length of every segment, cumulative
offsets, the place of every byte by index arithmetic, and one scatter into a preallocated buffer, which becomes the Arrow
column without a copy. Rows of one conversation that meet in a batch form one segment of the output.

Template: `<<SYS>>..<</SYS>>`, `[INST]..[/INST]`, `<s>..</s>` for system, user and assistant turns; any other role is
written out: `<<ROLE>>role<</ROLE>>..<</TURN>>`. In texts and roles a backslash is put before every control string and every
backslash; nothing else changes, and taking the backslashes out again restores the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import byte_column, partitions, slices
from parcelflow.session import materialise

MARKS = {"system": (b"<<SYS>>", b"<</SYS>>"), "user": (b"[INST]", b"[/INST]"), "assistant": (b"<s>", b"</s>")}
ROLE, ROLE_END, TURN_END = b"<<ROLE>>", b"<</ROLE>>", b"<</TURN>>"
CONTROLS = [m for pair in MARKS.values() for m in pair] + [ROLE, ROLE_END, TURN_END]
SLASH = ord("\\")
TOKEN = re.compile(rb"\\(?:\\|" + b"|".join(re.escape(c) for c in CONTROLS) + rb")|(" + b"|".join(re.escape(c) for c in CONTROLS) + rb")")
ESCAPED = re.compile(rb"\\(\\|" + b"|".join(re.escape(c) for c in CONTROLS) + rb")")
LEARNED = "assistant"
SEGMENT_BYTES = 1 << 23


def escape(text: bytes) -> bytes:
    return re.sub(rb"\\|" + b"|".join(re.escape(c) for c in CONTROLS), lambda m: b"\\" + m[0], text)


def unescape(text: bytes) -> bytes:
    return ESCAPED.sub(rb"\1", text)


def marks(role: bytes) -> tuple[bytes, bytes]:
    return MARKS.get(role.decode(), (ROLE + escape(role) + ROLE_END, TURN_END))


def escape_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ascending positions of bytes that need a backslash before them; a control string counts inside one row only."""
    found = [np.flatnonzero(data == SLASH)]
    for control in CONTROLS:
        at = np.flatnonzero(data[: max(0, len(data) - len(control) + 1)] == control[0])
        for i, byte in enumerate(control[1:], 1):
            at = at[data[at + i] == byte]
        row = np.searchsorted(offsets, at, "right") - 1
        found.append(at[at + len(control) <= offsets[row + 1]])
    return np.unique(np.concatenate(found))


def assemble(data: np.ndarray, offsets: np.ndarray, roles: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, ends of turns, starts and lengths of their escaped texts) of formatted turns, one after the other."""
    n = len(roles)
    names = {r: i for i, r in enumerate(dict.fromkeys(roles))}
    kind = np.fromiter((names[r] for r in roles), np.int64, n)
    heads, feet = zip(*(marks(r) for r in names)) if names else ((), ())
    head, foot = (np.array([len(x) for x in m], np.int64)[kind] if n else np.zeros(0, np.int64) for m in (heads, feet))
    extra = escape_places(data, offsets)
    before = np.searchsorted(extra, offsets)  # escapes before each row
    lengths = np.diff(offsets) + np.diff(before)
    ends = np.cumsum(head + lengths + foot)
    starts = ends - head - lengths - foot
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    row_shift = np.repeat(starts + head - offsets[:-1] - before[:-1], np.diff(offsets))
    added = np.zeros(len(data), np.int64)
    added[extra] = 1
    place = np.arange(len(data)) + row_shift + np.cumsum(added)
    out[place] = data
    out[place[extra] - 1] = SLASH
    for i, (a, b) in enumerate(zip(heads, feet)):
        mine = np.flatnonzero(kind == i)
        out[starts[mine][:, None] + np.arange(len(a))] = np.frombuffer(a, np.uint8)
        out[(ends[mine] - len(b))[:, None] + np.arange(len(b))] = np.frombuffer(b, np.uint8)
    return out, ends, starts + head, lengths


SEGMENTS = "conv_id bigint, n_turns bigint, formatted string, loss array<struct<start:int,length:int>>"


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, segment, n_turns, formatted, loss): the formatted conversations in segments.

    Segments of a conversation follow each other by `segment`; its formatted text is their concatenation. loss holds the byte
    ranges of the assistant texts in the segment's UTF-8. Turns are ordered by turn (null first), then role and text.
    Null texts and roles count as empty, rows without conv_id form one conversation, repeated rows are turns of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SEGMENT_BYTES):
            data, offsets = byte_column(batch.column("text"))
            roles = [r or b"" for r in batch.column("role").to_pylist()]
            out, ends, starts, lengths = assemble(data, offsets, roles)
            ids = batch.column("conv_id").to_pylist()
            first = [i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]]
            last = [*first[1:], len(ids)]
            cuts = np.concatenate(([0], ends))[[*first, len(ids)]]
            texts = pa.StringArray.from_buffers(len(first), pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(out))
            loss = []
            for a, b, base in zip(first, last, cuts.tolist()):
                loss.append([{"start": int(starts[i]) - base, "length": int(lengths[i])} for i in range(a, b) if roles[i] == LEARNED.encode()])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
            columns = [pa.array([ids[i] for i in first], pa.int64()), pa.array([b - a for a, b in zip(first, last)], pa.int64()), texts, pa.array(loss, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "n_turns", "formatted", "loss"])

    rows = turns.select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role), F.lit("")).cast("binary").alias("role"),
        F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("tie"), F.col(text).cast("binary").alias("text"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "hash", "tie")]
    placed = rows.repartitionByRange(partitions(turns), *order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    made = placed.mapInArrow(run, SEGMENTS).withColumn("segment", F.monotonically_increasing_id())
    return materialise(made, "chat").select("conv_id", "segment", "n_turns", "formatted", "loss")


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of every turn of a formatted text."""
    roles = {a: (r.encode(), b) for r, (a, b) in MARKS.items()}
    found, at, role, end = [], 0, None, None
    for m in TOKEN.finditer(formatted):
        mark = m[1]
        if mark is None:
            continue
        if end is None and mark in roles:
            role, end = roles[mark]
        elif end is None and mark == ROLE:
            role, end = None, ROLE_END
        elif mark == end == ROLE_END:
            role, end = unescape(formatted[at : m.start()]), TURN_END
        elif mark == end:
            found.append((role, unescape(formatted[at : m.start()])))
            end = None
        else:
            raise ValueError(f"{mark!r} at byte {m.start()} belongs to no turn")
        at = m.end()
    if end is not None or at != len(formatted):
        raise ValueError("the last turn is cut off")
    return found


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(segments: DataFrame) -> DataFrame:
    """What format_turns wrote, read back: one row per conversation. Hashes run on from segment to segment, so nothing is gathered."""

    def chars(data: bytes) -> int:
        return int(((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in DIGESTS.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        now = None
        done: list[tuple] = []

        def close():
            if now is not None:
                done.append((now["id"], now["n"], now["turns"].hexdigest(), now["loss_chars"], now["loss"].hexdigest(), now["chars"]))

        def table():
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], names)
            done.clear()
            return out

        for batch in batches:
            for conv, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
                if now is None or now["id"] != conv:
                    close()
                    now = {"id": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                for role, text in parse(formatted):
                    now["n"] += 1
                    for part in (role, b"\n", text, b"\n"):
                        now["turns"].update(part)
                for span in loss:
                    text = unescape(formatted[span["start"] : span["start"] + span["length"]])
                    now["loss"].update(text)
                    now["loss_chars"] += chars(text)
                now["chars"] += chars(formatted)
            if done:
                yield table()
        close()
        if done:
            yield table()

    rows = segments.select("conv_id", "segment", F.col("formatted").cast("binary").alias("formatted"), "loss")
    return rows.repartition(partitions(segments), "conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(run, DIGESTS)
