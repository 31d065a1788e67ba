"""SimHash groups against brute force."""

import random

import numpy as np
import xxhash

from parcelflow.llm import queries, simhash

SF = "/root/testdata/sf0.001"


def plain_print(text, k=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=2):
    """Least id of each row's component; rows are (id, fp)."""
    n = len(rows)
    seen, out = set(), [None] * n
    for i in range(n):
        if i in seen:
            continue
        seen.add(i)
        stack, group = [i], [i]
        while stack:
            a = stack.pop()
            for b in range(n):
                if b not in seen and (rows[a][1] ^ rows[b][1]).bit_count() <= radius:
                    seen.add(b)
                    stack.append(b)
                    group.append(b)
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        for j in group:
            out[j] = min(ids) if ids else None
    return out


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_fingerprints_equal_the_plain_rule():
    rnd = random.Random(1)
    texts = ["", " \t\n", "One", "one TWO", "a b c", "a  b\x0bc d\x0c\r\ne", "ÀÉ ñ É ñ É", "x y z w", "be " * 500]
    texts += [" ".join(rnd.choice(["the", "Of", "änd", "x"]) for _ in range(rnd.randrange(40))) for _ in range(60)]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == plain_print(t), t


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    prints = [(d["doc_id"], plain_print(d["text"])) for d in docs]
    want = sorted((i, f"{fp:016x}", c) for (i, fp), c in zip(prints, plain_groups(prints)))
    assert sorted(map(tuple, queries.op2_simhash(spark, SF).collect())) == want


def _clouds(seed, n_clouds, size, spread):
    rnd = random.Random(seed)
    out = []
    for _ in range(n_clouds):
        centre = rnd.getrandbits(64)
        for _ in range(size):
            fp = centre
            for _ in range(rnd.randrange(spread)):
                fp ^= 1 << rnd.randrange(64)
            out.append(fp)
    return [(i, fp) for i, fp in enumerate(out)]


def _check(spark, rows, **how):
    frame = spark.createDataFrame([(i, signed(fp)) for i, fp in rows], "doc_id bigint, fp bigint")
    got = sorted((r["doc_id"], r["component_id"]) for r in simhash.groups(frame, **how).collect())
    assert got == sorted((i, c) for (i, _), c in zip(rows, plain_groups(rows, how.get("radius", 2))))


def test_links_within_the_radius_are_all_found(spark):
    _check(spark, _clouds(2, 6, 60, 6))


def test_hot_buckets_are_split_without_losing_links(spark):
    _check(spark, _clouds(3, 2, 250, 5), most=8)


def test_chains_and_other_radii(spark):
    rows = [(1000 - i, (1 << i) - 1) for i in range(0, 64)]
    _check(spark, rows, radius=1)
    _check(spark, _clouds(4, 4, 40, 9), radius=3)


def test_lanes_count_like_popcount():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 2**63, 3, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rnd.choice(64, rnd.integers(0, 5), replace=False)) for _ in range(300)], np.uint64)
    fps = np.unique(base[rnd.integers(0, 3, 300)] ^ flips)
    a, b = simhash.spanning_links(fps, np.array([0]), 2)
    assert all((int(x) ^ int(y)).bit_count() >= 1 for x, y in zip(a, b))
    labels = plain_groups([(int(f), int(f)) for f in fps])
    for x, y in zip(a, b):
        assert labels[int(np.searchsorted(fps, x))] == labels[int(np.searchsorted(fps, y))]
    assert len(a) == len(fps) - len(set(labels))


def test_edge_rows(spark, docs):
    rows = [(5, None), (3, ""), (7, "  "), (None, "a b c d"), (9, "a b c d"), (9, "a b c d"), (None, "lonely words here now"), (1, "z " * 30000)]
    out = sorted(simhash.near_duplicates(docs(rows).withColumnRenamed("lang", "fp")).collect(), key=str)
    assert len(out) == len(rows)
    by = {(r["doc_id"], r["fp"]): r["component_id"] for r in out}
    assert by[5, 0] == by[3, 0] == by[7, 0] == 3
    assert {r["component_id"] for r in out if r["doc_id"] == 9} == {9}
    assert simhash.near_duplicates(docs([])).collect() == []
