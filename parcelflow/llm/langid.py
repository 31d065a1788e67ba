"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of the lower-cased code points, hashed into a fixed number of columns. Document
frequencies cover all documents that may be learned from. Weights are fitted on a bounded sample of them by
follow-the-regularised-leader with an elastic net, which leaves most weights at zero, and probabilities are tempered on
sampled documents that the fit has not seen.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import give_back, releasing, slices

COLUMNS = 1 << 15
ORDERS = (1, 2, 3)


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray  # per column
    weights: np.ndarray  # columns x labels, already times idf
    bias: np.ndarray
    temperature: float


def held_out(id_col: str = "doc_id"):
    """True for rows kept away from learning: crc32 of the id as text divisible by 5. A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def has_letter(text: str) -> bool:
    """Whether any character is of one of Unicode's letter categories; numbers that look like letters are none."""
    return any(map(str.isalpha, text))


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(columns, counts) of the n-grams of a whole text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(COLUMNS, np.int64)
    for at in range(0, len(points), 1 << 20):  # long texts in overlapping pieces
        part = points[at : at + (1 << 20) + max(ORDERS) - 1]
        gram = np.zeros(len(part), np.uint32)
        for n in ORDERS:
            gram = gram[: len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1 :] + np.uint32(n)
            mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            starts = mixed[: min(len(gram), 1 << 20)]
            total += np.bincount(starts >> np.uint32(32 - 15), minlength=COLUMNS)
            if len(part) <= n:
                break
    columns = np.flatnonzero(total)
    return columns, total[columns]


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """How many documents hold each column, and how many there are. Counted per task, then added up per column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(COLUMNS + 1, np.int64), 0
        for batch in slices(batches, "t", 1 << 23):
            for text in batch.column("t").to_pylist():
                seen[term_counts(text)[0]] += 1
                n += 1
        seen[COLUMNS] = n
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(seen[some])], ["c", "n"])

    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("t"))
    summed = texts.mapInArrow(releasing(run), "c int, n bigint").groupBy("c").agg(F.sum("n").alias("n")).collect()  # COLUMNS + 1 rows at most
    df = np.zeros(COLUMNS + 1, np.int64)
    for r in summed:
        df[r["c"]] = r["n"]
    return df[:COLUMNS], int(df[COLUMNS])


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    columns, counts = term_counts(text)
    x = counts * idf[columns]
    return columns, x / max(1e-12, float(np.sqrt((x * x).sum())))


def follow_leader(rows: list, classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) after FTRL-proximal passes over rows of (label, columns, values)."""
    z, n = np.zeros((COLUMNS, classes)), np.zeros((COLUMNS, classes))
    zb, nb = np.zeros(classes), np.zeros(classes)

    def solved(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for label, columns, values in rows:
            w, b = solved(z[columns], n[columns]), -zb / ((beta + np.sqrt(nb)) / alpha)
            error = _softmax(values @ w + b)
            error[label] -= 1
            g = values[:, None] * error
            new = n[columns] + g * g
            z[columns] += g - (np.sqrt(new) - np.sqrt(n[columns])) / alpha * w
            n[columns] = new
            grown = nb + error * error
            zb += error - (np.sqrt(grown) - np.sqrt(nb)) / alpha * b
            nb = grown
    return solved(z, n), -zb / ((beta + np.sqrt(nb)) / alpha)


def calibrated(scores: np.ndarray, labels: np.ndarray) -> float:
    """Temperature that makes softmax(scores / t) most likely, from a grid that is refined twice."""
    if not len(scores):
        return 1.0
    grid = np.geomspace(0.02, 20, 40)
    for _ in range(3):
        loss = [-np.log(_softmax(scores / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
        best = int(np.argmin(loss))
        grid, found = np.linspace(grid[max(0, best - 1)], grid[min(len(grid) - 1, best + 1)], 20), float(grid[best])
    return found


def train(docs: DataFrame, per_label: int = 1500, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02,
          l2: float = 0.05, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model:
    """Fit on rows with text and label that are not held out.

    Document frequencies use all of them. The weights are fitted on about `per_label` rows of each label, those with the
    smallest hashes of id and text; every fifth sampled row serves the temperature only. A table without such rows
    gives a model without labels, which predicts `und`.
    """
    known = docs.filter(~held_out(id_col) & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(label_col).count().collect()}
    labels = sorted(sizes)
    df, n = document_frequencies(known, text_col)
    idf = np.log((1 + n) / (1 + df)) + 1
    if not labels:
        return Model([], idf, np.zeros((COLUMNS, 0)), np.zeros(0), 1.0)
    place = F.xxhash64(id_col, text_col)
    share = F.create_map(*(x for k, v in sizes.items() for x in (F.lit(k), F.lit(min(1.0, per_label / v)))))
    chosen = (F.shiftrightunsigned(place, 11) / float(1 << 53)) < share[F.col(label_col)]
    sample = known.filter(chosen).select(place.alias("h"), F.col(label_col).alias("y"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {y: i for i, y in enumerate(labels)}
        rows = []
        for batch in batches:
            for h, y, columns, values in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append((h, number[y], np.frombuffer(columns, np.int32), np.frombuffer(values, np.float32).astype(float)))
        rows.sort(key=lambda r: (r[0], r[1]))
        fit = [r[1:] for i, r in enumerate(rows) if i % 5]
        rest = [r[1:] for i, r in enumerate(rows) if not i % 5]
        weights, bias = follow_leader(fit, len(labels), epochs, alpha, beta, l1, l2)
        scores = np.array([v @ weights[c] + bias for _, c, v in rest]).reshape(-1, len(labels))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((weights, bias, calibrated(scores, np.array([r[0] for r in rest], int))))])], ["m"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", 1 << 23):
            made = [_vector(t, idf) for t in batch.column("t").to_pylist()]
            columns = [c.astype(np.int32).tobytes() for c, _ in made], [v.astype(np.float32).tobytes() for _, v in made]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("y"), *map(pa.array, columns)], ["h", "y", "c", "v"])

    fitted = sample.mapInArrow(releasing(vectors), "h bigint, y string, c binary, v binary").repartition(1).mapInArrow(run, "m binary").first()
    if fitted is None:
        return Model([], idf, np.zeros((COLUMNS, 0)), np.zeros(0), 1.0)
    weights, bias, temperature = pickle.loads(fitted["m"])
    return Model(labels, idf, weights, bias, temperature)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score, from the text alone; und with score 1 if the text is null or has no letter.

    Columns of docs with these names are replaced. Whole texts count, however long; the score is the probability of lang_pred.
    """

    @F.pandas_udf("lang_pred string, score double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        found = []
        for text in texts:
            if text is None or not model.labels or not has_letter(text):
                found.append(("und", 1.0))
                continue
            columns, values = _vector(text, model.idf)
            p = _softmax((values @ model.weights[columns] + model.bias) / model.temperature)
            found.append((model.labels[int(p.argmax())], float(p.max())))
        give_back()
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    out = docs.select(*kept, judged(F.col(text_col)).alias("_judged"))
    return out.select(*kept, "_judged.lang_pred", "_judged.score")
