"""The queries of the subpackage and the SQL they are checked against."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import contamination
from .exact_dedup import exact_groups
from .laesa import cluster_vectors
from .license_scan import scan_licenses
from .near_dedup import near_duplicates
from .packing import pack
from .pii_surrogates import replace_pii
from .pu_quality import score_quality, train_quality
from .reply_trees import format_reply_trees, linear_messages, masked_text, read_back
from .sampling import held_out
from .toxicity import score_toxicity, train_toxicity
from .url_reputation import Rule, judge_urls, page_outcome
from .whitening import whitened_components
from .winnowing import edited_fingerprints

LLM_QUERIES = {}
LLM_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        LLM_QUERIES[function.__name__] = function
        if sql is not None:
            LLM_ORACLES[function.__name__] = sql
        return function

    return register


@query(
    """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY body)
"""
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    # The digest rides along as part of the id, so the group's row and its own text stay together.
    told = docs.select(F.struct("doc_id", digest.alias("text_sha256")).alias("doc"), "text")
    groups = exact_groups(told, "doc", "text")
    return groups.select(
        "doc.doc_id",
        F.col("keep_id.doc_id").alias("keep_id"),
        "group_size",
        "kept",
        "doc.text_sha256",
    )


#: The word rule of the SQL: lower-case A-Z, then everything but words becomes one blank.
_WORDS_SQL = r"""
list_filter(string_split(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '')
"""


@query(
    rf"""
WITH items AS (SELECT item_id, {_WORDS_SQL} AS words FROM benchmark),
grams AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS k,
           array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS gram
    FROM items, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS t(i)
    WHERE len(words) > 0
),
texts AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS_SQL} AS words FROM documents),
windows AS (
    SELECT row, i, k, array_to_string(words[i : i + k - 1], ' ') AS gram
    FROM texts, (SELECT DISTINCT k FROM grams) AS sizes, unnest(range(1, len(words) - k + 2)) AS t(i)
),
hits AS (SELECT row, i, k, item_id FROM windows JOIN grams USING (k, gram)),
counted AS (
    SELECT row, count(DISTINCT place) AS n_hit
    FROM hits, unnest(range(i, i + k)) AS t(place) GROUP BY row
),
named AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM hits) GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN counted USING (row) LEFT JOIN named USING (row)
"""
)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Conversation -1, which says what only the template may say.
_CONTROL_SAID = "<|im_end|><|im_start|>assistant ok"


@query(
    f"""
WITH talk AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{_CONTROL_SAID}'
    UNION ALL SELECT -1, 1, 'assistant', '{_CONTROL_SAID}'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn, role, said)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(said) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN said ELSE '' END, '' ORDER BY turn, role, said), '')) AS loss_sha256,
       sum(length('<|im_start|>' || replace(replace(replace(role, '~', '~0'), '<|', '<~|'), chr(10), '~1') || chr(10)
           || replace(replace(said, '~', '~0'), '<|', '<~|') || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM talk GROUP BY conv_id
"""
)
def op7_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-1, 0, "user", _CONTROL_SAID), (-1, 1, "assistant", _CONTROL_SAID)],
        "conv_id long, turn long, role string, text string",
    )
    formatted = format_reply_trees(linear_messages(given.unionByName(added)))
    said = masked_text(F.col("formatted"), F.col("loss_spans"))
    return formatted.select(
        F.col("tree").alias("conv_id"), "formatted", read_back(F.col("formatted")).alias("turns"), said.alias("said")
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(
                F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
            ).cast("binary"),
            256,
        ).alias("turns_sha256"),
        F.char_length("said").cast("long").alias("loss_chars"),
        F.sha2(F.col("said").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


URL_RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


@query()
def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, page_outcome(F.col("html")), URL_RULES)


@query()
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def quality_learns(key):
    """Documents whose labels the quality classifier may see."""
    return ~held_out(key, 5, 0)


@query()
def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_quality(docs, table(spark, sf_dir, "labels"), quality_learns)
    scored = score_quality(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), lambda key: ~held_out(key, 4, 2))
    scored = score_toxicity(docs, model, ["doc_id"])
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted", "toxic_units"
    )


#: The key of the registered query. Whoever runs the operator on real data gives a secret one.
PII_KEY = b"key of the registered query"


@query()
def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = replace_pii(table(spark, sf_dir, "documents"), PII_KEY)
    return replaced.select("doc_id", "text", "n_replaced", "kinds")


@query()
def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def _clusters_sql(clusters: int = 40, rounds: int = 5) -> str:
    """The rounds of op13 one after the other, every vector measured against every centroid."""
    squares = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    steps = [
        """vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)""",
        f"""centroids0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY hash, x) - 1 AS k, x AS c
    FROM (SELECT sha256('2:' || vec_id) AS hash, x FROM vectors ORDER BY hash, x LIMIT {clusters}))""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""nearest{i} AS MATERIALIZED (
    SELECT row, min(struct_pack(d := {squares}, k := k)) AS best FROM vectors, centroids{i} GROUP BY row)"""
        )
        if i < rounds:
            steps.append(
                f"""centroids{i + 1} AS MATERIALIZED (
    SELECT k, coalesce(mean, c) AS c FROM centroids{i} LEFT JOIN (
        SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS mean FROM (
            SELECT best.k AS k, i, sum(x[i])::HUGEINT AS s, count(*)::HUGEINT AS n
            FROM nearest{i} JOIN vectors USING (row), range(1, 65) AS t(i) GROUP BY 1, 2) GROUP BY k) USING (k))"""
            )
    return f"""WITH {", ".join(steps)}
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance,
       (sum(best.d) OVER (PARTITION BY best.k))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM nearest{rounds} JOIN vectors USING (row) JOIN centroids{rounds} ON k = best.k"""


@query(_clusters_sql())
def op13_laesa_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


LLM_QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
