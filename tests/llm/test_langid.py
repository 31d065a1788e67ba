"""Language identification: held-out accuracy, what may be learned from, and edge rows."""

import zlib

import numpy as np
import pytest

from parcelflow.llm import langid, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    return queries.op10_language(spark, SF).collect()


def test_held_out_accuracy(spark, rows):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    mine = [r for r in rows if r["held_out"]]
    assert len(mine) > 100
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in mine]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows} <= {"en", "de", "fr", "es", "und"}


def test_held_out_rule(rows):
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_scores_are_calibrated(spark, rows):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    mine = [r for r in rows if r["held_out"]]
    assert abs(np.mean([r["score"] for r in mine]) - np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in mine])) < 0.05


def test_held_out_rows_do_not_change_the_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = langid.train(docs)
    spoiled = docs.withColumn("lang", langid.F.when(langid.held_out(), "xx").otherwise(docs["lang"]))
    spoiled = spoiled.withColumn("text", langid.F.when(langid.held_out(), "zzz").otherwise(docs["text"]))
    b = langid.train(spoiled)
    assert a.labels == b.labels and np.array_equal(a.weights, b.weights) and a.temperature == b.temperature


def test_weights_are_sparse_and_counts_cover_all(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs)
    assert 0 < np.count_nonzero(model.weights) < 0.5 * model.weights.size
    known = [r["text"] for r in docs.filter(~langid.held_out() & docs["lang"].isNotNull()).collect()]
    df, n = langid.document_frequencies(docs.filter(~langid.held_out()))
    want = np.zeros(langid.COLUMNS, int)
    for t in known:
        want[langid.term_counts(t)[0]] += 1
    assert n == len(known) and np.array_equal(df, want)


def test_pieces_of_long_texts_count_like_the_whole():
    text = "abcde fghij " * 200_000
    columns, counts = langid.term_counts(text)
    assert counts.sum() == 3 * len(text) - 3
    assert len(columns) <= 3 * 12
    assert langid.term_counts("")[1].sum() == 0 and langid.term_counts("a")[1].sum() == 1 and langid.term_counts("ab")[1].sum() == 3


def test_edge_rows(spark, docs):
    rows = [(1, "the house is in the town", "en"), (2, "das haus ist in der stadt", "de"), (3, "the cat and the dog", "en"), (4, "der hund und die katze", "de")] * 3
    rows += [(None, "the", "en"), (7, None, "en"), (8, "", "de"), (9, "123 !!", None), (10, "ж" * 50_000, None)]
    frame = docs(rows).withColumnRenamed("n_chars", "score")
    out = langid.predict(frame, langid.train(frame)).collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: r["lang_pred"] for r in out}
    assert got[7] == got[8] == got[9] == "und" and got[10] in ("en", "de") and got[1] == "en" and got[2] == "de"
    empty = docs([])
    assert langid.predict(empty, langid.train(empty)).collect() == []
    assert langid.predict(frame, langid.train(empty)).first()["lang_pred"] == "und"


@pytest.mark.parametrize("text,letter", [("½ ² Ⅷ ① ٣", False), ("_ - ", False), ("½ª", True), ("ж", True), ("日", True), ("ʰ", True), ("\u0301", False)])
def test_letters_are_unicode_letters(text, letter):
    import unicodedata

    assert langid.has_letter(text) == letter == any(unicodedata.category(c).startswith("L") for c in text)


def plain_columns(text):
    """n-gram columns of a text, one gram after the other."""
    found = {}
    points = [ord(c) for c in text.lower()]
    for n in (1, 2, 3):
        for i in range(len(points) - n + 1):
            h = 0
            for k in range(1, n + 1):
                h = (h * 0x01000193 + points[i + k - 1] + k) % 2**32
            h = (h ^ (h >> 15)) * 0x85EBCA6B % 2**32
            found[h >> 17] = found.get(h >> 17, 0) + 1
    return found


def plain_model(rows, epochs=3, alpha=0.5, beta=1.0, l1=0.02, l2=0.05):
    """(labels, idf, weights, bias, temperature) from rows of (hash, label, text), coordinate by coordinate."""
    import math

    labels = sorted({y for _, y, _ in rows})
    df = {}
    for _, _, t in rows:
        for c in plain_columns(t):
            df[c] = df.get(c, 0) + 1
    idf = lambda c: math.log((1 + len(rows)) / (1 + df.get(c, 0))) + 1

    def vector(t):
        x = {c: n * idf(c) for c, n in plain_columns(t).items()}
        size = math.sqrt(sum(v * v for v in x.values()))
        return {c: float(np.float32(v / size)) for c, v in x.items()}

    z, n, zb, nb = {}, {}, [0.0] * len(labels), [0.0] * len(labels)

    def weight(c, k):
        a, b = z.get((c, k), 0.0), n.get((c, k), 0.0)
        return 0.0 if abs(a) <= l1 else -(a - math.copysign(l1, a)) / ((beta + math.sqrt(b)) / alpha + l2)

    def scores(x):
        return [sum(v * weight(c, k) for c, v in x.items()) - zb[k] / ((beta + math.sqrt(nb[k])) / alpha) for k in range(len(labels))]

    def softmax(s):
        e = [math.exp(v - max(s)) for v in s]
        return [v / sum(e) for v in e]

    rows = sorted(rows)
    fit, rest = [r for i, r in enumerate(rows) if i % 5], [r for i, r in enumerate(rows) if not i % 5]
    for _ in range(epochs):
        for _, y, t in fit:
            x = vector(t)
            p = softmax(scores(x))
            b = [-zb[k] / ((beta + math.sqrt(nb[k])) / alpha) for k in range(len(labels))]
            for k in range(len(labels)):
                e = p[k] - (labels[k] == y)
                for c, v in x.items():
                    w, g, old = weight(c, k), v * e, n.get((c, k), 0.0)
                    z[c, k] = z.get((c, k), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w
                    n[c, k] = old + g * g
                grown = nb[k] + e * e
                zb[k] += e - (math.sqrt(grown) - math.sqrt(nb[k])) / alpha * b[k]
                nb[k] = grown
    held = np.array([scores(vector(t)) for _, _, t in rest])
    temperature = langid.calibrated(held, np.array([labels.index(y) for _, y, _ in rest]))
    return labels, lambda t: softmax([s / temperature for s in scores(vector(t))])


def test_model_equals_plain_regression(spark, docs):
    """Training and prediction of a small table, n-gram by n-gram and coordinate by coordinate."""
    words = {"en": "the house and town of people is", "de": "das haus und die stadt von leuten ist", "fr": "la maison et ville des gens est"}
    rows = [(i, " ".join(w.split()[(i * k) % 6] for k in range(1, 8)) + "é" * (i % 2), y) for i, (y, w) in enumerate(sorted(words.items()) * 14)]
    table = docs(rows)
    model = langid.train(table)
    known = table.filter(~langid.held_out()).select(langid.F.xxhash64("doc_id", "text"), "lang", "text").collect()
    labels, p = plain_model([tuple(r) for r in known])
    assert labels == model.labels
    for r in langid.predict(table, model).collect():
        want = p(r["text"])
        assert r["lang_pred"] == labels[int(np.argmax(want))] and abs(r["score"] - max(want)) < 1e-6
