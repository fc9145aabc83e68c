"""The operators applied to the given tables with production parameters, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.llm import alignment, chat, curves, exact_dedup, language, line_dedup, mixing, ngram_join, packing, repeats, secrets, token_counts, whitening
from motorlake.llm.common import ship

BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id bigint, turn bigint, role string, text string")
    return chat.conversation_digests(chat.format_turns(given.unionByName(added)), context_free=True)


@query("""
    WITH v AS (SELECT vec_id, embedding::double[] AS e FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
         d AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_prepend(0::double,
                      list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), lambda a, b: a + b)) AS score
               FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::int AS rank FROM d)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def op2_hilbert_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return curves.nearest(table(spark, folder, "embeddings"))


@query()
def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, folder, "documents"), width=3, num=90, den=100)


@query()
def op4_best_two_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, folder, "documents"), public_tokenizers.path(BPE), end_id=2, capacity=1024)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests, capacity=1024)


#: Shares of the tokens there are.
TARGETS = {"good": 0.95, "poor": 0.05, "toxic": 0.0}


@query()
def op5_soft_membership_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rated, domains = mixing.mix(docs, mixing.domain_marks(table(spark, folder, "labels")), TARGETS)
    shares = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(domains)]
    return rated.select("doc_id", "n_tokens", *shares, "rate")


@query("""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.mark_copies(table(spark, folder, "documents"))


@query()
def op7_string_kernel_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.learn_and_predict(table(spark, folder, "documents"))


@query()
def op8_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


@query()
def op9_prefix_free_repeats(spark: SparkSession, folder: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, folder, "documents"), size=400)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(BPE), limit=512)


@query("""
    WITH t AS (SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
         l AS (SELECT n, doc_id, unnest(lines) AS line, unnest(generate_series(1, len(lines))) AS pos FROM t),
         k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
         c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT n) >= 10)
    SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
    FROM k LEFT JOIN c ON k.key = c.key GROUP BY n
""")
def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    left = line_dedup.drop_common_lines(docs, documents=10, shortest=1)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op11_jacobi_davidson_whitening(spark: SparkSession, folder: str) -> DataFrame:
    white = whitening.whiten(table(spark, folder, "embeddings"), components=8)
    return white.withColumn("deviation", F.col("deviation").cast("bigint"))


@query()
def op13_merge_path_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"), public_tokenizers.path(BPE), public_tokenizers.path(PIECES))
