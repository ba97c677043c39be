"""The registered queries of this subpackage: thin bindings of the operators to the corpus tables.

``QUERIES`` maps names to ``fn(spark, sf_dir)``; ``ORACLE`` has DuckDB SQL for
those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.llm import (
    decontaminate,
    language_id,
    line_dedup,
    merkle,
    near_dup,
    preference,
    quality,
    secret_scan,
    sentencepiece_bpe,
    sharding,
    simhash,
    warc,
    whiten,
)
from switchboard.llm.common import ship_package
from switchboard.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return add


def _tokenizer(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT html, max(page_id) AS first FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN d USING (html)
"""


@query("op1_warc", _WARC_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    folder = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.page_records(warc.read_archives(spark, folder, with_payload=False))


_PREFERENCE_SQL = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, text,
                  '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) AS rendered FROM conversations),
answers AS (SELECT conv_id, turn, text, rendered FROM c WHERE role = 'assistant'
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, sha256(rendered) DESC) = 1),
taken AS (SELECT conv_id, turn, rendered, CASE WHEN row_number() OVER w < count(*) OVER () THEN lead(text) OVER w
                 ELSE first_value(text) OVER w END AS other FROM answers WINDOW w AS (ORDER BY conv_id)),
halves AS (SELECT conv_id AS pair_id, 0 AS side, turn, role, rendered FROM c
         UNION ALL SELECT c.conv_id, 1, c.turn, role, CASE WHEN role = 'assistant' AND c.turn = t.turn AND c.rendered = t.rendered
                   THEN '<|assistant|>' || chr(10) || coalesce(other, '') || chr(10) ELSE c.rendered END
         FROM c JOIN taken t ON c.conv_id = t.conv_id),
t AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, sha256(rendered)) - 1 AS position FROM halves),
places AS (SELECT pair_id, position, count(DISTINCT side) = 2 AND min(rendered) = max(rendered) AS agree FROM t GROUP BY ALL),
prefix AS (SELECT pair_id, coalesce(min(position) FILTER (NOT agree), max(position) + 1) AS n FROM places GROUP BY ALL),
sides AS (SELECT pair_id, count(DISTINCT side) = 2 AS paired FROM t GROUP BY ALL)
SELECT pair_id, CASE WHEN position < n THEN 'prompt' WHEN side = 0 THEN 'chosen' ELSE 'rejected' END AS part, position, role,
       rendered, CASE WHEN position >= n AND role = 'assistant' THEN length(role) + 5 ELSE 0 END AS train_start,
       CASE WHEN position >= n AND role = 'assistant' THEN length(rendered) ELSE 0 END AS train_end, paired
FROM t JOIN prefix USING (pair_id) JOIN sides USING (pair_id) WHERE position >= n OR side = 0
"""


@query("op2_preference_pairs", _PREFERENCE_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with its last answer against that of the next one: prompts of all turns before it, and masked
    completions, one row per rendered turn."""
    return preference.format_pairs(preference.replaced_answers(table(spark, sf_dir, "conversations")))


@query("op3_sentencepiece")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of all documents, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_bpe.encode_documents(docs, _tokenizer("piece_bpe_32k.model")).select(
        "doc_id", F.col("_sp_n").alias("n_tokens"), F.col("_sp_ids_sha256").alias("ids_sha256"),
        F.col("_sp_text_sha256").alias("decoded_sha256"))


_LINE_SQL = r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, r, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM docs),
keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeated AS (SELECT k, max(doc_id) AS stays FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT r) >= 3),
judged AS (SELECT keyed.*, stays IS NOT NULL AND doc_id IS DISTINCT FROM stays AS dropped
           FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id, r
"""


@query("op4_line_dedup", _LINE_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents without those found in three or more documents."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_line_n").alias("n_lines"), F.col("_line_dropped").alias("n_dropped"),
        F.sha2(F.col("_line_text"), 256).alias("kept_sha256"))


@query("op5_feistel_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts are at most one apart."""
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=24)


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from those that are not held out."""
    return language_id.identify(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", F.round("score", 6).alias("score"), "ambiguous")


@query("op7_secret_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: fixed patterns and random tokens."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secret_scan.spans_text("base"), 256).alias("base_sha256"),
                        secret_scan.spans_text("spans").alias("spans"))


@query("op8_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item, one row per document and item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


@query("op9_minhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents at a similarity of 85 percent or more."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("key")


@query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and isolation-forest verdict of all documents."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("anomaly", 6).alias("anomaly"))


def _crc32(text: str) -> str:
    """CRC-32 of a short ASCII text, as DuckDB SQL."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), "
            "lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], "
            "lambda x, _: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)")


def _merkle_sql(levels: int = 12) -> str:
    """Trees of fan-out 8 level by level; a tree of one node stays as it is. 8 ** 12 leaves are room enough."""
    def field(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str) -> list[str]:
        steps = []
        for k in range(levels):
            steps.append(f"""{name}s{k} AS (SELECT *, coalesce(string_agg(d, '') OVER (PARTITION BY t, i // 8 ORDER BY i
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(d, '') OVER (PARTITION BY t, i // 8 ORDER BY i
  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
            steps.append(f"""{name}{k + 1} AS (SELECT t, i // 8 AS i, (any_value(n) + 7) // 8 AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d FROM {name}{k} GROUP BY t, i // 8)""")
        return steps

    def climb(name: str, source: str, first: str, place: str, group: str) -> list[str]:
        steps, before = [], source
        for k in range(levels):
            steps.append(f"""{first}{k} AS (SELECT w.* EXCLUDE (f, p), p || CASE WHEN s.n > 1 THEN s.l || s.r ELSE '' END AS p,
  CASE WHEN s.n > 1 THEN sha256(s.l || f || s.r) ELSE f END AS f
  FROM {before} w JOIN {name}s{k} s ON s.t = w.{group} AND s.i = w.{place} // {8 ** k})""")
            before = f"{first}{k}"
        return steps

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"leaves AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 "
        f"THEN {leaf(lowered)} END AS tampered FROM documents)",
        "langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM (SELECT DISTINCT lang FROM documents))",
        "placed AS (SELECT doc_id, leaf, t, 0 AS z, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, "
        "count(*) OVER (PARTITION BY t) AS n, coalesce(tampered, leaf) AS f, '' AS p "
        "FROM leaves JOIN langs ON leaves.lang IS NOT DISTINCT FROM langs.lang)",
        "a0 AS (SELECT t, i, n, leaf AS d FROM placed)", *tree("a"),
        f"b0 AS (SELECT 0 AS t, t AS i, count(*) OVER () AS n, d FROM a{levels})", *tree("b"),
        *climb("a", "placed", "up", "i", "t"), *climb("b", f"up{levels - 1}", "top", "t", "z")]
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, a.d AS subroot, b.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = b.d AS verified
FROM top{levels - 1} w JOIN a{levels} a ON a.t = w.t CROSS JOIN b{levels} b
"""


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, verified against tampered texts."""
    return merkle.verify(table(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight leading whitened components of all usable embeddings; a deviation past a long is null."""
    return whiten.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


@query("op13_simhash_near_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents, and the classes of those that differ in at most two bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
