"""Suffix-tree scores against a plain model over dictionaries."""

import math
import os
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import queries, suffixtree, words

SF = "/root/testdata/sf0.001"
END = ""


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w] + [END]


class Plain:
    def __init__(self, texts, depth, least, gain):
        seqs = [tokens(t) for t in texts]
        self.depth, self.count = depth, Counter(w for s in seqs for w in s)
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.own = {w for w, c in self.count.items() if c >= least} | {END}
        total = self.n + self.v + 1
        self.rare = (sum(c + 1 for w, c in self.count.items() if w not in self.own) + 1) / total
        nexts = [defaultdict(Counter) for _ in range(depth + 1)]
        for s in seqs:
            sym = list(map(self.symbol, s))
            for i in range(len(sym)):
                for k in range(1, min(depth, i) + 1):
                    nexts[k][tuple(sym[i - k : i])][sym[i]] += 1
        self.tree = {}
        for k in range(1, depth + 1):
            for ctx, c in nexts[k].items():
                if k > 1 and nexts[k - 1][ctx[:-1]][ctx[-1]] < least or sum(c.values()) < least:
                    continue
                scale = sum(c.values()) + len(c)
                kept = {w: m for w, m in c.items() if m >= 2}
                left = 1 - sum(kept.values()) / scale
                lift = sum(m * (math.log(m - 1) + round(-math.log(self.p(ctx[1:], w)) * 256) / 256 - math.log(scale)) for w, m in kept.items())
                once = sum(m == 1 for m in c.values())
                if lift + (once * math.log(left) if once else 0) >= gain:
                    self.tree[ctx] = (kept, scale, left)

    def symbol(self, w):
        return w if w in self.own else None

    def unigram(self, w):
        return (self.count[w] + 1) / (self.n + self.v + 1)

    def p(self, ctx, symbol):
        """Probability of a symbol after a context, from the longest retained suffix down."""
        p = self.rare if symbol is None else self.unigram(symbol)
        for k in range(1, len(ctx) + 1):
            if ctx[-k:] in self.tree:
                kept, scale, left = self.tree[ctx[-k:]]
                p = kept.get(symbol, 0) / scale + left * p
        return p

    def score(self, text):
        seq = tokens(text)
        sym = list(map(self.symbol, seq))
        base = full = 0.0
        for i, w in enumerate(seq):
            inside = self.unigram(w) / self.rare if sym[i] is None else 1.0
            base += math.log10(self.unigram(w))
            full += math.log10(self.p(tuple(sym[max(0, i - self.depth) : i]), sym[i]) * inside)
        return len(seq), sum(self.count[w] > 0 for w in seq), base, full


def random_docs(draw, n):
    words = [f"w{i}" for i in range(12)] + [f"Rare{i}" for i in range(30)]
    docs = []
    for i in range(n):
        text, w = [], 0
        for _ in range(draw.choice([0, 1, 5, 40, 120])):
            w = (w * 2 + draw.choice([0, 0, 1])) % 12 if draw.random() < 0.8 else draw.randrange(len(words))
            text.append(words[w])
            w %= 12
        docs.append((i, "\n ".join(text) if i % 3 else " ".join(text).upper()))
    return docs


@pytest.mark.parametrize("depth, least, gain, block", [(1, 2, 0.0, 1 << 24), (2, 5, 1.0, 400), (3, 4, -50.0, 400), (2, 3, 1e9, 1 << 24)])
def test_scores_equal_the_plain_model(spark, docs, monkeypatch, depth, least, gain, block):
    draw = random.Random(depth)
    rows = random_docs(draw, 60) + [(None, "w1 w2 w3 w4"), (3, "w1 w2 w4 w8"), (900, None), (901, ""), (902, " \t "), (903, "never seen words é"), (904, "w1 w2 " * 5000)]
    monkeypatch.setattr(suffixtree, "BLOCK_BYTES", block)
    if block == 400:  # contexts in several buckets, rows in several batches
        monkeypatch.setattr(suffixtree, "BUCKET", 50)
        monkeypatch.setattr(suffixtree, "LIMIT", 7)
    table = docs(rows).withColumns({"row": F.lit(1), "t": F.lit("x"), "held_out": F.lit("z"), "block": F.lit(5), "slot": F.lit(6)})
    got = suffixtree.scores(table, depth, least, gain).collect()
    out = lambda d: d is None or zlib.crc32(str(d).encode()) % 7 == 2
    plain = Plain([t for d, t in rows if not out(d)], depth, least, gain)
    if gain == 1e9:
        assert all(math.isclose(r["score"], r["base_score"], rel_tol=1e-9) for r in got)
    else:
        assert max(map(len, plain.tree)) == depth
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    want = sorted(((d, out(d), *plain.score(t)) for d, t in rows), key=key)
    have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got), key=key)
    assert [r[:4] for r in have] == [r[:4] for r in want] and {r["train_tokens"] for r in got} == {plain.n}
    for a, b in zip(have, want):
        assert math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-12) and math.isclose(a[5], b[5], rel_tol=1e-5, abs_tol=1e-5)


def test_probabilities_sum_to_one():
    plain = Plain([t for _, t in random_docs(random.Random(1), 60)], 2, 4, 0.0)
    for ctx in [(), *plain.tree]:
        known = sum(plain.p(ctx, w) for w in plain.own) + plain.p(ctx, None)
        assert math.isclose(known, 1.0, rel_tol=1e-9)


def test_without_training_rows(spark, docs):
    got = suffixtree.scores(docs([(1, "a b"), (2, None)]), held=F.lit(True)).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got} == {(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)}
    assert suffixtree.scores(docs([])).collect() == []
    with pytest.raises(ValueError):
        suffixtree.scores(docs([]), depth=0)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    out = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    plain = Plain([r["text"] for r in rows if not out(r["doc_id"])], 2, suffixtree.SEEN, 10.0)
    got = {r["doc_id"]: r for r in queries.op13_lmscore(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        n, known, base, full = plain.score(r["text"])
        have = got[r["doc_id"]]
        assert (have["held_out"], have["n_tokens"], have["n_known"], have["train_tokens"]) == (out(r["doc_id"]), n, known, plain.n)
        assert math.isclose(have["base_score"], base, rel_tol=1e-9) and math.isclose(have["score"], full, rel_tol=1e-5, abs_tol=1e-5)


def test_query_learns_from_words_and_contexts_that_occur_twice(spark, docs, tmp_path):
    """A training text that occurs twice is likelier than its words alone; with a large least count every word of a small table is rare."""
    draw = random.Random(4)
    text = {i: " ".join(f"word{draw.randrange(10**6)}" for _ in range(40)) for i in range(60)}
    train = [i for i in text if zlib.crc32(str(i).encode()) % 7 != 2]
    text[train[1]] = text[train[0]]
    docs(list(text.items())).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["score"] - r["base_score"] for r in queries.op13_lmscore(spark, str(tmp_path)).collect()}
    assert min(got[train[0]], got[train[1]]) > 40 and max(got[i] for i in text if i not in train[:2]) < 10


def test_rows_asked_and_counts_are_dropped_as_soon_as_they_are_used(spark, docs, monkeypatch):
    """The rows asked lay beside the blocks, and the sums of words and counts of every length stayed to the end."""
    made, asked, plain = [], [], suffixtree.fresh_path

    def watched(spark, label):
        asked.append(sum(name == "blocks" and os.path.isdir(f"{p}/kind={suffixtree.ASK}") for name, p in made))
        made.append((label, plain(spark, label)))
        return made[-1][1]

    table, score = docs(random_docs(random.Random(2), 40)), lambda: {r["doc_id"]: r["score"] for r in suffixtree.scores(table, 2, 2, 0.0).collect()}
    whole = score()
    monkeypatch.setattr(suffixtree, "fresh_path", watched)
    monkeypatch.setattr(suffixtree, "input_bytes", lambda df: 40_000)
    monkeypatch.setattr(suffixtree, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(suffixtree, "WAVES", waves := 2)
    parts = score()
    assert parts.keys() == whole.keys() and all(math.isclose(parts[k], whole[k], rel_tol=1e-6) for k in whole)
    assert [label for label, _ in made] == ["blocks", "words", "blocks", "counted", *waves * ["blocks"], "counted", *waves * ["blocks"]]
    assert asked == [0, 1, 0, 1, *range(waves), waves, *waves * [0]]
    assert [name for name, p in made if os.path.isdir(p)] == waves * ["blocks"]


def test_small_numbers_take_little_once_packed():
    values = np.random.default_rng(0).integers(0, 200, 10_000)
    assert len(suffixtree._packed(a=values)) < 11_000 and np.array_equal(suffixtree._unpacked(suffixtree._packed(a=values, b=values[:0]))["a"], values)
    column = suffixtree._stretches(values.astype(np.int64), np.array([9000, 0, 1000]))
    back, sizes = suffixtree._values(column, np.int64)
    assert np.array_equal(back, values) and sizes.tolist() == [9000, 0, 1000] and sum(map(len, column.to_pylist())) < 11_000


def test_a_bucket_is_worked_on_alone():
    """All buckets of an Arrow batch but the last were held, expanded and counted together, whatever their size."""
    batches = [pa.RecordBatch.from_pydict({"bucket": pa.array(b, pa.int32()), "n": pa.array(n)}) for b, n in (([1, 1, 2, 3], [0, 1, 2, 3]), ([], []), ([3, 3], [4, 5]), ([5, 6], [6, 7]))]
    seen = []

    def run(table):
        seen.append((set(table.column("bucket").to_pylist()), table.column("n").to_pylist()))
        yield from table.to_batches()

    out = [n for batch in suffixtree._whole_buckets(iter(batches), run) for n in batch.column("n").to_pylist()]
    assert seen == [({1}, [0, 1]), ({2}, [2]), ({3}, [3, 4, 5]), ({5}, [6]), ({6}, [7])] and out == list(range(8))


def test_words_of_each_row_are_counted_without_a_number_per_byte():
    rows = pa.array([b"", b"a  bc", None, b" d", b"e", b"\t", b"f g "], pa.large_binary())
    found, offsets = words.split(rows)
    assert found.to_pylist() == [b"a", b"bc", b"d", b"e", b"f", b"g"] and offsets.tolist() == [0, 0, 2, 2, 3, 4, 4, 6]
    rows = pa.array([b"word " * 400_000], pa.large_binary())
    tracemalloc.start()
    words.split(rows)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 12 * 2_000_000
