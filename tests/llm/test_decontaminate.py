"""Containment search against SQL and brute force."""

import random
import re

from oracle import compare, duck
from parcelflow.llm import decontaminate, queries

SF = "/root/testdata/sf0.001"
ITEMS = "item_id bigint, text string"


def toks(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def shingles(w, k):
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items, t=0.8, k=5):
    out = []
    for d, text in set(docs):
        w = toks(text)
        for i, it in items:
            v = toks(it)
            if v and text is not None:
                mine = shingles(v, min(k, len(v)))
                hit = len(mine & shingles(w, min(k, len(v))))
                if hit >= t * len(mine) - 1e-9:
                    out.append((d, i, len(mine), hit))
    return sorted(out, key=str)


def found(docs_frame, items_frame):
    rows = decontaminate.containments(docs_frame, items_frame).collect()
    return sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["matched"]) for r in rows), key=str)


def test_query_equals_sql(spark):
    assert compare(queries.op6_decontaminate(spark, SF), duck(SF), queries.ORACLES["op6_decontaminate"]) == []


def test_random_texts_equal_brute_force(spark, docs):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 4, 5, 6, 9, 20, 60])))) for i in range(40)]
    rows = []
    for d in range(80):
        body = [rnd.choice(vocab) for _ in range(rnd.randrange(300))]
        piece = rnd.choice(items)[1].split()
        for _ in range(rnd.randrange(4)):
            piece[rnd.randrange(len(piece))] = rnd.choice(vocab)
        at = rnd.randrange(len(body) + 1)
        rows.append((d, " ".join(body[:at] + piece + body[at:])))
    want = brute(rows, items)
    assert len(want) > 50
    assert found(docs(rows), spark.createDataFrame(items, ITEMS)) == want


def test_case_marks_and_line_breaks_do_not_hide_an_item(spark, docs):
    items = spark.createDataFrame([(1, "What is the capital of France, and why?")], ITEMS)
    rows = [(1, "x WHAT is; the\ncapital (of) France -- and why not"), (2, "what is the capital city of france and why")]
    assert [r[0] for r in found(docs(rows), items)] == [1]


def test_signatures_hold_one_more_than_may_be_missing(spark):
    items = spark.createDataFrame([(n, " ".join(f"a{n}x{j}" for j in range(n + 4))) for n in (1, 2, 5, 8, 10, 63, 64, 65)], ITEMS)
    for r in decontaminate.signatures(items, 0.8, 5).collect():
        assert len(r["signature"]) == len(set(r["signature"])) >= min(r["n"], int(0.2 * r["n"] + 1e-9) + 1)


def test_main_path_is_native(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    for frame in (decontaminate.containments(docs, items), decontaminate.clean(docs, items)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_edge_rows(spark, docs):
    items = [(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (3, ""), (4, "!!"), (None, "one two three four five six"), (5, "solo"), (6, "red fish")]
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (1, "other words here"), (None, "zero one two three four five six"), (2, None), (3, ""),
            (4, "solo"), (5, "blue red fish"), (6, "one two three four five seven " + "filler " * 30000)]
    items_frame = spark.createDataFrame(items, ITEMS).withColumn("doc_id", decontaminate.F.lit(7))
    frame = docs(rows).withColumnRenamed("n_chars", "item_id")
    assert found(frame, items_frame) == brute(rows, items)
    left = decontaminate.clean(frame, items_frame)
    assert left.columns == frame.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == [1, 2, 3, 6]
    nothing = spark.createDataFrame([], ITEMS)
    assert found(frame, nothing) == [] and found(docs([]), items_frame) == [] and decontaminate.clean(frame, nothing).count() == len(rows)
