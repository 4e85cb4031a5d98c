"""The operators as registered queries over whole tables, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, decontamination, licences, mixing, near_dup, ngram_lm, periodic, pii, quality, token_files, topk, warc
from .shared import Scratch, fixed


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    field = pii.train(pii.labelled_table(spark))
    return pii.summary(pii.find_pii(_read(spark, folder, "documents"), field))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    scored = quality.score_docs(docs, quality.train(docs, _read(spark, folder, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_lm(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.score_corpus(_read(spark, folder, "documents"))


def op4_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(_read(spark, folder, "documents"), width=3, percent=85)


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    rows = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digests(chat.read_chats(chat.format_chats(rows.unionByName(more))))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_read(spark, folder, "documents"))


def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.summary(licences.scan_licences(_read(spark, folder, "documents")))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _read(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    kept = Scratch(spark)
    try:
        path = f"{kept.path}/archives"
        warc.write_warc(_read(spark, folder, "pages"), path, kept)
        back = warc.read_warc(spark, path)
        return fixed(back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    finally:
        kept.drop()


def op11_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    kept = Scratch(spark)
    try:
        path = f"{kept.path}/ids"
        token_files.write_token_ids(_read(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
        back = token_files.read_token_ids(spark, path, as_bytes=True)
        return fixed(back.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")))
    finally:
        kept.drop()


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    kept = Scratch(spark)
    try:
        a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
        rows, _ = alignment.align(_read(spark, folder, "documents"), a, b, kept)
        digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
        return fixed(rows.withColumn("groups_sha256", digest).drop("groups"))
    finally:
        kept.drop()


def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    # a tenth of the documents repeat part of their words, as the contract has it
    split = docs.withColumn("w", F.expr(r"if(h % 10 = 0, filter(split(text, '[\\x20\\x09-\\x0D]+', -1), x -> x <> ''), null)"))
    begin = split.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("if(n > 0, cast(g % n as int), 0)"))
    period = begin.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    text = F.expr("if(n > 0, array_join(transform(sequence(0, n - 1), i -> get(w, if(i < a, i, a + (i - a) % p))), ' '), text)")
    return periodic.digests(periodic.periodic_runs(period.select("doc_id", text.alias("text"))))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_pii, op2_quality, op3_lm, op4_neardup, op5_chat, op6_mixing, op7_licences, op8_decontamination, op9_topk, op10_warc, op11_token_ids, op12_alignment, op13_runs, pipeline)}

_ESCAPED = "replace(replace(replace(replace({}, chr(92), chr(92) || 's'), '<', chr(92) || 'l'), '|', chr(92) || 'p'), '#', chr(92) || 'h')"

SQL = {
    "op4_neardup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
        e AS (SELECT doc_id, unnest(s) AS g FROM s),
        n AS (SELECT doc_id, len(s) AS n FROM s),
        both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
        ends AS (SELECT a AS f, b AS t FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT doc_id AS f, doc_id AS t FROM n UNION SELECT r.f, ends.t FROM r JOIN ends ON r.t = ends.f)
        SELECT n.doc_id, n.n AS n_shingles, min(r.t) AS component_id, n.doc_id = min(r.t) AS kept FROM n JOIN r ON r.f = n.doc_id GROUP BY 1, 2""",
    "op5_chat": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'),
        o AS (SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) = role, false) AS joined FROM t)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            (sum(length({_ESCAPED.format("text")})) + sum(CASE WHEN joined THEN 5 ELSE length({_ESCAPED.format("role")}) + 14 END))::BIGINT AS formatted_chars
        FROM o GROUP BY conv_id""",
    "op9_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
