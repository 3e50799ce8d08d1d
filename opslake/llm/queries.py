"""Queries of the operators for training data, each over its whole table, and the SQL that must give the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from opslake.llm import op1_chat, op2_decontaminate, op3_toxicity, op4_pii, op5_language, op6_repeats, op7_jaccard, op8_embeddings, op9_quality, op10_bpe, op11_merkle, op12_bytes, op13_negatives


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int):
    """crc32 of the document's id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_chat.render_maximal(table(spark, sf_dir, "conversations"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = docs.where(remainder(4) != 2).join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id")
    model = op3_toxicity.fit(docs, learned)
    scored = op3_toxicity.score(docs, model)
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_words")


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_pii.pseudonymize(table(spark, sf_dir, "documents")).select("doc_id", "n_entities", "text")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = op5_language.fit(docs.where(remainder(5) != 0))
    found = op5_language.identify(docs, model)
    return found.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_repeats.digest(op6_repeats.removed(table(spark, sf_dir, "documents")))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_jaccard.components(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = op9_quality.cotrain(docs.where(remainder(4) != 2), table(spark, sf_dir, "labels"))
    scored = op9_quality.score(docs, model)
    return scored.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_margin", "meta_margin")


def op10_bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.when(remainder(3) == 0, op11_merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    out = op11_merkle.manifest(docs, tampered={"text": lowered})
    siblings = F.array_join(F.zip_with("left", "right", lambda a, b: F.concat(a, b)), "")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", "verified", "lang")


def op12_byte_bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_bytes.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op13_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_decontamination, op3_toxicity_score, op4_pii_surrogates, op5_language_id,
    op6_repeated_passages, op7_jaccard_join, op8_embedding_dedup, op9_quality_score, op10_bpe_digests,
    op11_merkle_manifest, op12_byte_bpe_digests, op13_hard_negatives,
)} | {"pipeline": corpus_pipeline.run}

def merkle_sql(levels: int = 9) -> str:
    """The manifest level by level: n are nodes, f the fold and proof of each leaf; subroots are raised like leaves. Serves 8 ** levels leaves of a language."""
    crc = "xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::UBIGINT)), lambda a, c: list_reduce(list_prepend(xor(a, c), [0::UBIGINT for i in range(8)]), lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)))"
    leaf = lambda text: "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [f"l AS MATERIALIZED (SELECT *, row_number() OVER () AS uid, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS changed FROM documents))"]
    ctes += ["n0 AS (SELECT lang AS g, pos, leaf AS d FROM l)", "f0 AS (SELECT uid, lang AS g, pos, changed AS d, '' AS proof FROM l)"]
    for k in range(2 * levels):
        if k == levels:  # from subroots on all nodes are of one group
            ctes += [
                f"h AS MATERIALIZED (SELECT g AS lang, d, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM n{k})", f"n{k}h AS (SELECT '' AS g, pos, d FROM h)",
                f"f{k}h AS (SELECT uid, '' AS g, h.pos, f.d, proof FROM f{k} f JOIN h ON f.g IS NOT DISTINCT FROM h.lang)",
            ]
        at = f"{k}h" if k == levels else k
        ctes += [
            f"s{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY g) AS size FROM n{at})",
            f"n{k + 1} AS (SELECT g, pos // 8 AS pos, CASE WHEN max(size) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d FROM s{k} GROUP BY g, pos // 8)",
            f"""f{k + 1} AS MATERIALIZED (SELECT uid, any_value(f.g) AS g, any_value(f.pos // 8) AS pos, CASE WHEN max(size) = 1 THEN max(f.d) ELSE sha256(string_agg(CASE WHEN s.pos = f.pos THEN f.d ELSE s.d END, '' ORDER BY s.pos)) END AS d,
              any_value(proof) || coalesce(string_agg(s.d, '' ORDER BY s.pos) FILTER (s.pos <> f.pos), '') AS proof FROM f{at} f JOIN s{k} s ON f.g IS NOT DISTINCT FROM s.g AND f.pos // 8 = s.pos // 8 GROUP BY uid)""",
        ]
    return f"""WITH {", ".join(ctes)} SELECT doc_id, l.lang, leaf, h.d AS subroot, n.d AS root, sha256(proof) AS proof_sha256, f.d AS folded_root, f.d = n.d AS verified
        FROM l JOIN f{2 * levels} f USING (uid) JOIN h ON l.lang IS NOT DISTINCT FROM h.lang CROSS JOIN n{2 * levels} n"""


ORACLES = {
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
             p AS (SELECT * FROM (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same) WHERE k <= 5),
             n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
                   FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """,
    "op11_merkle_manifest": merkle_sql(),
    "op1_chat_formatting": """
        WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS pos,
                          coalesce(role, 'user') AS role, coalesce(text, '') AS text, coalesce(floor(turn / 256.0), -1e18) AS block,
                          (row_number() OVER (PARTITION BY conv_id, coalesce(floor(turn / 256.0), -1e18) ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) - 1) // 256 AS part FROM conversations),
             c AS (SELECT conv_id, count(*) AS n, list(struct_pack(r := role, t := text) ORDER BY pos) AS turns FROM t GROUP BY conv_id),
             k AS (SELECT min(conv_id) AS conv_id, n, turns, count(*) AS n_copies FROM c GROUP BY n, turns),
             m AS (SELECT k.* FROM k WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.turns[1] = k.turns[1] AND c.n > k.n AND c.turns[1:k.n] = k.turns)),
             s AS (SELECT m.conv_id, t.block, t.part, m.n, m.n_copies, string_agg('<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10), '' ORDER BY t.pos) AS rendered
                   FROM m JOIN t USING (conv_id) GROUP BY m.conv_id, t.block, t.part, m.n, m.n_copies)
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY block, part) - 1 AS segment, n AS n_turns, n_copies, rendered FROM s
    """,
}
