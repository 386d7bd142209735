"""One query per operator over its whole table, and the SQL for those that have it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import chat, infilling, jaccard, language, lexical, licenses, minhash, mixing, quality, records, sentencepieces, topk
from tallybrook.llm.counts import token_counts
from tallybrook.session import apply_settings, work_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers that start from now on import this package, where the session
    was not started with it on its path."""
    path = spark.sparkContext.environment
    if ROOT not in path.get("PYTHONPATH", "").split(":"):
        path["PYTHONPATH"] = f"{ROOT}:{path.get('PYTHONPATH', '')}".rstrip(":")
    return apply_settings(spark)


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(ready(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_pivot_top_k(spark, sf):
    """The ten best partners of every hundredth vector."""
    vectors = topk.quantised(table(spark, sf, "embeddings"))
    return topk.top_k(vectors, F.col("id") % 100 == 0, k=10)


@query
def op2_source_mix(spark, sf):
    return mixing.mix_sources(table(spark, sf, "documents"))


@query
def op3_piece_dropout(spark, sf):
    """Ids of every text under merge-dropout, and whether they decode to it."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    decoded = sentencepieces.decode_ids(sentencepieces.encode_texts(documents, rate=0.1, seed=17))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.col("text").eqNullSafe(F.col("decoded")).alias("lossless"),
        "ids",
    )


@query
def op4_chat_format(spark, sf):
    """All conversations, and one whose texts hold the template's own control strings."""
    said = "\\### Assistant: </turn> ok"
    planted = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.digests(chat.render(chat.fold(chat.log_of(rows))))


@query
def op5_ngram_jaccard(spark, sf):
    return jaccard.jaccard_components(table(spark, sf, "documents"), width=3, percent=90)


@query
def op6_fertility_quality(spark, sf):
    return quality.quality_rules(table(spark, sf, "documents"))


@query
def op7_binary_records(spark, sf):
    """Digests of records read back from the files."""
    out = work_folder(spark, "records")
    records.write_records(table(spark, sf, "documents"), out, end_id=0)
    return records.record_digests(spark, out)


@query
def op8_token_counts(spark, sf):
    return token_counts(table(spark, sf, "documents"), token_limit=512)


@query
def op9_license_scan(spark, sf):
    return licenses.scan_licenses(table(spark, sf, "documents"))


@query
def op10_language_id(spark, sf):
    documents = table(spark, sf, "documents")
    known = language.learn(documents, ~language.held_out())
    return language.identify(documents, known).select("*", language.held_out().alias("held_out"))


@query
def op11_minhash_tensor(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"), width=4, percent=80)


@query
def op12_infilling(spark, sf):
    """Digests of every text cut for infilling, and of the text rebuilt from that."""
    made = infilling.restored(infilling.fill_in_middle(table(spark, sf, "documents")))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query
def op13_lexical_rank(spark, sf):
    """The fifty best documents of every benchmark item."""
    return lexical.rank_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=50)


ORACLE = {
    "op1_pivot_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        ),
        ranked AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op4_chat_format": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        said AS (
            SELECT *,
                   length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t')) AS body,
                   CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN length(role)
                        ELSE 1 + length(replace(replace(role, '\', '\\'), chr(10), '\n')) END AS label
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
               CAST(sum(label + body + 14) AS BIGINT) AS formatted_chars
        FROM said GROUP BY conv_id
    """,
    "op12_infilling": r"""
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                   sha256('1:' || CAST(doc_id AS VARCHAR)) AS h
            FROM documents
        ),
        numbers AS (
            SELECT *, len(units) AS n,
                   CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                   CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
            FROM drawn
        ),
        parts AS (
            SELECT *,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                        THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
                   array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
                   array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
                   array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suffix
            FROM numbers
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    "op13_lexical_rank": r"""
        WITH said AS (
            SELECT doc_id, row_number() OVER () AS d,
                   regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ),
        sized AS (SELECT *, CAST(len(terms) AS BIGINT) AS n FROM said WHERE len(terms) > 0),
        totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized),
        tf AS (
            SELECT d, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
            FROM (SELECT d, doc_id, n, unnest(terms) AS term FROM sized) GROUP BY d, doc_id, n, term
        ),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        weighed AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals
        ),
        impact AS (
            SELECT tf.d, tf.doc_id, tf.term, w,
                   w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))) AS adds
            FROM tf JOIN weighed USING (term), totals
        ),
        scored AS (
            SELECT item_id, d, doc_id, CAST(sum(adds) AS BIGINT) AS score
            FROM asked JOIN impact USING (term) GROUP BY item_id, d, doc_id
        ),
        ranked AS (
            SELECT item_id, doc_id, score,
                   CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
}
