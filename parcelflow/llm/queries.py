"""One query per operator over its whole table, with the SQL it must agree with where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import alignment, chat, decontaminate, langid, licences, packing, quality, runs, sharding, simhash, suffixtree, tokenfiles, topk
from parcelflow.llm.common import read
from parcelflow.session import fresh_path

RUNNERS: dict = {}
ORACLES: dict[str, str] = {}


def query(fn=None, *, sql: str | None = None):
    def wrap(f):
        RUNNERS[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return wrap(fn) if fn else wrap


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, with size and checksum of the text that lies there."""
    placed = sharding.assign(read(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query(sql="""
WITH sound AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY q.r ORDER BY list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) DESC, c.vec_id) AS n
  FROM sound q JOIN sound c ON q.vec_id % 20 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM scored WHERE n <= 20
""")
def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best vectors for every vector whose id is divisible by 20."""
    vectors = topk.quantised(read(spark, sf_dir, "embeddings"), scale=64)
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from documents that are not held out."""
    docs = read(spark, sf_dir, "documents")
    model = langid.train(docs)
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query(sql=r"""
WITH d AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL
), i AS (
  SELECT *, least(len(w), 5) AS k
  FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark)
  WHERE len(w) > 0
), item_shingles AS (
  SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p : p + k - 1], ' '))) AS s FROM i
), sizes AS (SELECT item_id, CAST(count(*) AS INTEGER) AS n FROM item_shingles GROUP BY item_id),
doc_shingles AS (
  SELECT DISTINCT doc_id, text, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p : p + k - 1], ' '))) AS s
  FROM d CROSS JOIN (SELECT DISTINCT k FROM i)
)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS matched, count(*) / n AS containment
FROM doc_shingles JOIN item_shingles USING (k, s) JOIN sizes USING (item_id)
GROUP BY doc_id, text, item_id, n HAVING count(*) >= ceil(n * 0.8 - 1e-9)
""")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it contains."""
    found = decontaminate.containments(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), threshold=0.8, shingle=5)
    return found.drop("text_hash")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of at most 2,048 ids."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), cut="space", end_id=0, size=2048)
    return packing.pack(found, size=2048)


@query(sql=r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, regexp_replace(text, '(\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE>>|<</ROLE>>|<</TURN>>)', '\\\1', 'g') AS e,
    regexp_replace(role, '(\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE>>|<</ROLE>>|<</TURN>>)', '\\\1', 'g') AS r
  FROM turns
), formatted AS (
  SELECT *, CASE role WHEN 'system' THEN concat('<<SYS>>', e, '<</SYS>>') WHEN 'user' THEN concat('[INST]', e, '[/INST]') WHEN 'assistant' THEN concat('<s>', e, '</s>')
    ELSE concat('<<ROLE>>', r, '<</ROLE>>', e, '<</TURN>>') END AS f
  FROM escaped
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(sum(length(f)) AS BIGINT) AS formatted_chars
FROM formatted GROUP BY conv_id
""")
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, and of one whose texts hold control strings, read back from the output."""
    said = "</s>[INST] ok [/INST]"
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.format_turns(given.unionByName(trap)))


@query
def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognised licences of every document, and its known licence sentences in order."""
    found = licences.scan(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.array_join(F.array_sort(F.array_distinct(F.col("licences.licence"))), ",").alias("licences"),
        F.array_join(F.col("sentences.id"), ",").alias("sentence_ids"), F.size("sentences").alias("n_sentences"),
        F.transform("licences", lambda x: F.struct(x["start"], x["length"])).alias("spans"),
    )


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text, and whether it is kept."""
    found = quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "n_chars", F.round("perplexity", 6).alias("perplexity"), F.round("threshold", 6).alias("threshold"), "keep")


@query
def op5_tokenfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and checksum of every document's ids, read back from the files."""
    path = fresh_path(spark, "ids")
    tokenfiles.write(read(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.path("word_bpe_49k.json"), vocab=49_408, cut="white", end_id=2)
    return tokenfiles.checksums(spark, path)


@query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, with a period planted where the id's checksum ends in 0."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.crc32(F.col("doc_id").cast("string"))
    split = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    planted = docs.withColumn("words", F.when(digest % 10 == 0, split)).withColumns({"n": F.size("words"), "g": F.floor(digest / 10)})
    planted = planted.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    planted = planted.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    cycle = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), rest)), " ")
    found = runs.runs(planted.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text")))
    longest = F.element_at(F.array_sort("runs", lambda x, y: F.when(x["length"] != y["length"], F.sign(y["length"] - x["length"])).when(
        x["start"] != y["start"], F.sign(x["start"] - y["start"])).otherwise(F.sign(x["period"] - y["period"])).cast("int")), 1)
    found = found.withColumn("top", F.when(F.size("runs") > 0, longest))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"), "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers for every document."""
    found, _ = alignment.aligned(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op13_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and suffix-tree log-probabilities of every document."""
    return suffixtree.scores(read(spark, sf_dir, "documents").select("doc_id", "text"), depth=2, least=suffixtree.SEEN)
