"""Benchmark decontamination by size-partitioned MinHash containment search, verified by exact shingle containment.

Benchmark items are short, documents may be very long, so a document's own MinHash would say nothing about a short item
inside it. The items are signed instead. Items are partitioned by their number n of distinct shingles; a partition's items
lie within (u / 2, u], and keep their k(u) smallest shingle hashes as signature, with k(u) = floor((1 - t) u) + 1. An item
that is contained to the share t or more lacks at most floor((1 - t) n) < k(u) shingles, so at least one hash of its
signature is among the document's shingles: the search misses nothing. Documents that meet a signature are candidates, and
only for those the share of the item's shingles that the document holds is counted on the shingles themselves.

Everything is DataFrame functions. Words are runs of letters and digits of the lower-cased text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import unused
from parcelflow.session import materialise

WORD = r"[^\p{L}\p{N}]+"


def words(text):
    """Lower-cased runs of letters and digits; null and wordless texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD), lambda w: w != "")


def _hashes(tokens, size: int):
    """Hashes of the word shingles of one size, made of the words' hashes."""
    hashed = F.transform(tokens, lambda w: F.xxhash64(w))
    return _rolled(hashed, size)


def _rolled(hashed, size: int):
    places = F.sequence(F.lit(1), F.size(hashed) - size + 1)
    made = F.transform(places, lambda i: F.xxhash64(*(F.element_at(hashed, i + j) for j in range(size))))
    return F.when(F.size(hashed) >= size, made).otherwise(F.array().cast("array<bigint>"))


def _strings(tokens, size):
    places = F.sequence(F.lit(1), F.size(tokens) - size + 1)
    made = F.transform(places, lambda i: F.array_join(F.slice(tokens, i, size), " "))
    return F.when(F.size(tokens) >= size, made).otherwise(F.array().cast("array<string>"))


def signatures(items: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(item, size, n, shingles, signature) of the distinct texts of items that have words.

    Items of fewer words than a shingle are one shingle of their own size.
    """
    tokens = items.select(words(F.col("text")).alias("w")).filter(F.size("w") > 0).distinct()
    sized = tokens.withColumn("size", F.least(F.size("w"), F.lit(shingle)))
    branch = F.lit(None).cast("array<bigint>")
    for s in range(shingle, 0, -1):
        branch = F.when(F.col("size") == s, _hashes(F.col("w"), s)).otherwise(branch)
    # the slack takes up what rounding loses in (1 - threshold) * n
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("hashes").cast("double"))))
    k = (F.floor((1 - threshold) * upper + 1e-9) + 1).cast("int")
    return (
        sized.withColumn("shingles", F.array_distinct(_strings(F.col("w"), F.col("size"))))
        .withColumn("hashes", F.array_sort(F.array_distinct(branch)))
        .select(
            F.array_join("w", " ").alias("item"), "size", F.size("shingles").alias("n"), "shingles",
            F.slice("hashes", 1, F.least(k, F.size("hashes"))).alias("signature"),
        )
    )


def containments(docs: DataFrame, items: DataFrame, threshold: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, n_shingles, matched, containment) of all pairs with containment of the threshold or more.

    containment is the share of the item's distinct shingles that the document holds. Equal rows of docs are one row here
    (text_hash tells texts of one id apart); equal items each have their row. Null or wordless texts and items
    match nothing.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    texts = texts.filter(F.col("text").isNotNull())
    given = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    named = materialise(given.select("item_id", F.array_join(words(F.col("text")), " ").alias("item")).filter("item <> ''"), "named")
    signed = materialise(signatures(given, threshold, shingle), "signatures")
    wanted = materialise(signed.select("item", "size", F.explode("signature").alias("hash")), "wanted")
    sizes = sorted(r["size"] for r in wanted.select("size").distinct().collect())  # shingle sizes: at most `shingle` of them

    hashed = texts.select("doc_id", "text_hash", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    met = None
    for size in sizes:
        every = hashed.select("doc_id", "text_hash", F.explode(_rolled(F.col("h"), size)).alias("hash"))
        hit = every.join(wanted.filter(F.col("size") == size).select("item", "hash"), "hash").select("doc_id", "text_hash", "item")
        met = hit if met is None else met.unionByName(hit)
    if met is None:
        met = hashed.select("doc_id", "text_hash", F.lit("").alias("item")).limit(0)
    candidates = materialise(met.distinct(), "candidates")

    marked = materialise(candidates.select("doc_id", "text_hash").distinct(), "marked")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    suspects = texts.join(marked, same(texts, marked), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    suspects = suspects.select("doc_id", "text_hash", words(F.col("text")).alias("w"))
    held = None
    for size in sizes:
        own = suspects.select("doc_id", "text_hash", F.explode(F.array_distinct(_strings(F.col("w"), F.lit(size)))).alias("shingle"))
        asked = signed.filter(F.col("size") == size).select("item", F.explode("shingles").alias("shingle"))
        found = own.join(asked, "shingle").groupBy("doc_id", "text_hash", "item").agg(F.count(F.lit(1)).alias("matched"))
        held = found if held is None else held.unionByName(found)
    if held is None:
        held = candidates.withColumn("matched", F.lit(0).cast("bigint"))
    counted = held.join(candidates.withColumnRenamed("doc_id", "d").withColumnRenamed("text_hash", "t").withColumnRenamed("item", "i"),
                        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")) & (F.col("item") == F.col("i")), "left_semi")
    whole = counted.join(signed.select("item", F.col("n").alias("n_shingles")), "item")
    share = whole.withColumn("containment", F.col("matched") / F.col("n_shingles")).filter(F.col("matched") >= F.ceil(F.col("n_shingles") * threshold - 1e-9))
    return share.join(named, "item").select("doc_id", "text_hash", "item_id", "n_shingles", "matched", "containment")


def clean(docs: DataFrame, items: DataFrame, threshold: float = 0.8, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that contain an item; all other rows and all columns stay as they are."""
    d, t = unused(docs, "leak_id"), unused(docs, "leak_hash")
    found = containments(docs, items, threshold, shingle, id_col, text_col).select(F.col("doc_id").alias(d), F.col("text_hash").alias(t)).distinct()
    found = materialise(found, "leaks")
    return docs.join(found, F.col(id_col).eqNullSafe(F.col(d)) & (F.xxhash64(text_col) == F.col(t)), "left_anti")
