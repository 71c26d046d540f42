"""The subpackage's registered queries, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import embedding_graph, html_text, language, link_graph, packing, piece_dropout, simhash, topk, toxicity, warc
from wattlake.llm.common import fold_of, table

QUERIES: dict = {}
EQUIVALENT_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            EQUIVALENT_SQL[name] = sql
        return build

    return register


def load_queries() -> tuple[dict, dict[str, str]]:
    import corpus_pipeline

    from wattlake.llm import audit_queries  # noqa: F401  registers its queries here

    sql = EQUIVALENT_SQL | ({} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL})
    return QUERIES | {"pipeline": corpus_pipeline.run}, sql


#: The 160 bits of a SHA-1 as 32 digits of five bits, eight from each ten hexadecimal digits.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"1 + ((('0x' || substr(sha, {1 + 10 * (i // 8)}, 10))::BIGINT >> {35 - 5 * (i % 8)}) & 31)::INTEGER, 1)"
    for i in range(32)
)

_ARCHIVED = f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha FROM pages
), kept AS (
    SELECT payload, max(page_id) AS page_id FROM payloads GROUP BY payload
)
SELECT p.page_id, strlen(payload)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN p.page_id = k.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> k.page_id THEN k.page_id END AS refers_to
FROM payloads p JOIN kept k USING (payload)
"""


@query("op1_warc", _ARCHIVED)
def warc_records(spark: SparkSession, folder: str) -> DataFrame:
    """A record for every page, written to archives and read back."""
    return warc.archive_and_read(spark, table(spark, folder, "pages"), least_bytes=0)


@query("op3_html_text")
def page_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract_text(table(spark, folder, "pages"))


#: The rules of the URL query.
RULES = [
    link_graph.Rule.parse("block", "net/"),
    link_graph.Rule.parse("allow", "example.net/en/"),
    link_graph.Rule.parse("block", "example.com/de/"),
    link_graph.Rule.parse("allow", "org/fr/"),
]


@query("op5_url_verdicts")
def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL."""
    return link_graph.judge_urls(table(spark, folder, "pages"), RULES)


@query("op2_simhash_groups")
def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of 4-word shingles and the groups within 4 bits."""
    return simhash.near_duplicates(table(spark, folder, "documents"), size=4, distance=4)


@query("op4_packed_sequences")
def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 1024 ids."""
    return packing.pack(table(spark, folder, "documents"), **byte_bpe()).drop("ids")


def byte_bpe() -> dict[str, str]:
    """The tokenizer file and the rank file of the same vocabulary."""
    return {
        "vocabulary": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


_NEAR_VECTORS = """
WITH RECURSIVE able AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), component AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), degree AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c USING (vec_id) LEFT JOIN degree d USING (vec_id)
"""


@query("op6_near_vectors", _NEAR_VECTORS)
def near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and groups of vectors of a label with a cosine of at least 0.93."""
    return embedding_graph.near_duplicate_vectors(table(spark, folder, "embeddings"), threshold=0.93)


@query("op7_language")
def document_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document; a row without an id is not learned from and counts as held out."""
    docs = table(spark, folder, "documents")
    fold = fold_of(F.col("doc_id"), 4)
    profiles = language.learn_profiles(docs.where(fold != 2))
    held_out = {"held_out": F.coalesce(fold == 2, F.lit(True))}
    return language.identify(docs, profiles, extra=held_out)


_TOP_20 = """
WITH fine AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, max(list_inner_product(q.v, c.v))::BIGINT AS score
    FROM fine q JOIN fine c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 20 = 0
    GROUP BY 1, 2
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY rank <= 20
"""


@query("op8_top_products", _TOP_20)
def top_products(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best inner products of every 20th vector with all others."""
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op9_toxicity")
def document_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document; a row without an id is not learned from and counts as held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.coalesce(fold_of(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out")
    found = toxicity.classify(docs, labels.where(fold_of(F.col("doc_id"), 5) != 0))
    return found.select("doc_id", held_out, "score", "predicted")


@query("op10_piece_dropout")
def piece_dropout_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's varied segmentation and whether it decodes to the very text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents")
    whole = lambda text: F.encode(F.coalesce(text, F.lit("")), "utf-8")
    sent = {"sent": F.struct(F.crc32(whole(F.col("text"))), F.octet_length(whole(F.col("text"))))}
    back = piece_dropout.decode(piece_dropout.encode(docs, model, dropout=0.1, seed=1, extra=sent), model)
    return back.select(
        "doc_id", F.size("ids").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
        F.octet_length("text").cast("long").alias("decoded_bytes"),
        (F.struct(F.crc32(whole(F.col("text"))), F.octet_length(whole(F.col("text")))) == F.col("sent")).alias("lossless"),
    )
