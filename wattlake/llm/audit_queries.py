"""Registered queries on how a corpus is tokenised, recounted and vouched for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import divergence, manifest, pair_index
from wattlake.llm.common import table
from wattlake.llm.queries import query

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_DIVERGENCE = rf"""
WITH own AS (
    SELECT row_number() OVER () AS nr, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text
    FROM documents
), found AS (
    SELECT nr, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM own
), kept AS (
    SELECT lang, term FROM found GROUP BY ALL HAVING count(DISTINCT nr) >= 3
), v AS (
    SELECT lang, count(*) AS v FROM kept GROUP BY ALL
), seen AS (
    SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(n, 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang, source FROM own) g LEFT JOIN v USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM seen GROUP BY ALL) s USING (lang, source)
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(s.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(s.n, 0) + 1)) // (g.total + g.v) AS p
    FROM groups g JOIN kept k USING (lang) LEFT JOIN seen s USING (lang, source, term)
), whole AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (any_value(total) + any_value(v)) AS q
    FROM shares JOIN (SELECT lang, sum(total) AS total, any_value(v) AS v FROM groups GROUP BY ALL) USING (lang)
    GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), scored AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // q
    FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM scored
QUALIFY part = 'pair' OR rank <= 200
"""


@query("op11_source_divergence", _DIVERGENCE)
def source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Each source beside the other sources of its language, and the terms it has more of than the language."""
    return divergence.divergence(table(spark, folder, "documents"), least=3, most=200)


#: Levels that the SQL of the manifest builds: enough for 16^6 nodes below a root.
_LEVELS = 6


def _leaf_sql(text: str) -> str:
    part = lambda x: f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"
    return "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _tree_sql(name: str) -> str:
    """Tables ``{name}1`` and up from ``{name}0(tree, pos, node)``, ``{name}x`` with the others of each node's run, ``{name}top``."""
    out = []
    for i in range(_LEVELS):
        size = f"count(*) OVER (PARTITION BY tree) AS size, count(*) OVER (PARTITION BY tree, pos // 16) AS wide"
        run = "PARTITION BY tree, pos // 16 ORDER BY pos"
        out.append(f"""{name}{i}x AS (
    SELECT *, {size},
           coalesce(string_agg(node, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(node, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind
    FROM {name}{i}
), {name}{i + 1} AS (
    SELECT tree, pos // 16 AS pos, CASE WHEN any_value(size) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node
    FROM {name}{i}x GROUP BY tree, pos // 16
)""")
    return ",\n".join(out)


def _fold_sql(name: str, rows: str, at: str, into: str) -> str:
    """``{into}``: ``rows`` with ``proof`` grown and ``node`` folded through all levels of the tree ``name``."""
    out, last = [], rows
    for i in range(_LEVELS):
        out.append(f"""{into}{i} AS (
    SELECT r.* REPLACE (
        r.proof || CASE WHEN x.size = 1 THEN '' ELSE x.before || x.behind END AS proof,
        CASE WHEN x.size = 1 THEN r.node ELSE sha256(x.before || r.node || x.behind) END AS node
    ) FROM {last} r JOIN {name}{i}x x ON x.tree = r.tree AND x.pos = r.{at} // {16**i}
)""")
        last = f"{into}{i}"
    return ",\n".join(out)


_CRC = """list_reduce(
    list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(
        list_prepend(xor(a, b), range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
    )
)"""

_MANIFEST = f"""
WITH hashed AS (
    SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
           CASE WHEN xor({_CRC}, 4294967295) % 5 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} END AS altered
    FROM documents
), trees AS (
    SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM hashed)
), placed AS (
    SELECT h.*, t.tree, row_number() OVER (PARTITION BY t.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM hashed h JOIN trees t ON h.source IS NOT DISTINCT FROM t.source
), a0 AS (SELECT tree, pos, leaf AS node FROM placed),
{_tree_sql("a")},
b0 AS (SELECT 0 AS tree, tree AS pos, node FROM a{_LEVELS}),
{_tree_sql("b")},
start AS (SELECT doc_id, leaf, tree, pos, '' AS proof, coalesce(altered, leaf) AS node FROM placed),
{_fold_sql("a", "start", "pos", "c")},
below AS (SELECT doc_id, leaf, tree AS own, 0 AS tree, tree AS pos, proof, node FROM c{_LEVELS - 1}),
{_fold_sql("b", "below", "pos", "d")}
SELECT d.doc_id, d.leaf, s.node AS subroot, r.node AS root, sha256(d.proof) AS proof_sha256,
       d.node AS folded_root, d.node = r.node AS verified
FROM d{_LEVELS - 1} d JOIN b0 s ON s.pos = d.own CROSS JOIN b{_LEVELS} r
"""


@query("op12_merkle_manifest", _MANIFEST)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's proof in the manifest, and whether a copy with altered texts is found out."""
    return manifest.manifest(
        table(spark, folder, "documents"),
        columns=["doc_id", "source", "lang", "n_chars", "text"],
        tampered={"text": F.translate("text", UPPER, LOWER)},
        touched=F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
    )


@query("op13_pair_index_bpe")
def pair_index_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's ids and of the text that they decode to."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoded = pair_index.encode(table(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN)
    return pair_index.decode(encoded, vocabulary).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
