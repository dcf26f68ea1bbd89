"""One query for each operator, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import ann, fingerprints, langid, mixing, packing, secret_scan
from starmart.llm.collocations import collocations
from starmart.llm.common import table
from starmart.llm.hard_negatives import hard_negatives
from starmart.llm.licenses import scan_licenses
from starmart.llm.sharding import shuffle_shards
from starmart.llm.simhash import hex64, simhash_groups
from starmart.llm.suffix_dedup import remove_repeats
from starmart.llm.token_counts import count_tokens


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt uniformly into 16 shards of equal row counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shuffle_shards(docs, 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def word_tokenizer() -> str:
    """Where this machine has the public tokenizer the packing contract names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, word_tokenizer()))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and that of its edited text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sketched = fingerprints.with_sketch(docs, F.col("text"), "sketch")
    paired = fingerprints.with_next(sketched, "doc_id", F.xxhash64("text"), ["text", "sketch"], "next")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next.text", F.lit(1), half))
    x = fingerprints.with_sketch(paired.withColumn("edited", edited), F.col("edited"), "edited_sketch")
    return x.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.likeness(F.col("sketch"), F.col("next.sketch")).alias("near_next"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_groups(docs).select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a known license wording in the documents."""
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate secret in the documents, with the forest's verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan(docs, secret_scan.scanner_for(docs))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in a mix of the sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    out = mixing.mix(docs)
    return out.select("doc_id", "source", *[F.col(f"mix_{c}").alias(c) for c in ("block", "phase", "slot", "place", "weight")])


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every fiftieth one."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(rows, rows.where("vec_id % 50 = 0"), 5)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that repeat."""
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned off the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(langid.learnable(docs))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best phrases that occur 100 times or more."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"), least=100, best=2000)


def byte_tokenizer() -> str:
    """Where this machine has the public tokenizer the counting contract names."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, byte_tokenizer()).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 512).alias("over_limit"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the first 5 positives of every hundredth vector."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_packing": op2_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_simhash": op4_simhash,
    "op5_licenses": op5_licenses,
    "op6_secrets": op6_secrets,
    "op7_mixing": op7_mixing,
    "op8_ann": op8_ann,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_langid": op10_langid,
    "op11_collocations": op11_collocations,
    "op12_token_counts": op12_token_counts,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op11_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), lists AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces
        ), totals AS (
            SELECT lang, sum(len(ws))::BIGINT AS n FROM lists GROUP BY lang
        ), places AS (
            SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists
        ), counts AS (
            SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, k AS words, count(*) AS a
            FROM places, range(1, 6) AS ks(k) WHERE i + k - 1 <= len(ws)
            GROUP BY ALL HAVING count(*) >= 100
        ), cuts AS (
            SELECT c.lang, c.phrase, c.a, k, h.a AS l, t.a AS r, n,
                (1000::HUGEINT * c.a * n) // (h.a::HUGEINT * t.a) AS score
            FROM counts c JOIN range(1, 5) AS ks(k) ON k < c.words JOIN totals USING (lang)
            JOIN counts h ON h.lang = c.lang AND h.phrase = array_to_string(string_split(c.phrase, ' ')[:k], ' ')
            JOIN counts t ON t.lang = c.lang AND t.phrase = array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ')
        ), lowest AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), kept AS (
            SELECT * FROM lowest s WHERE NOT EXISTS (
                SELECT 1 FROM counts b WHERE b.lang = s.lang AND b.phrase <> s.phrase AND 100 * b.a >= 100 * s.a
                AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
            phrase, a, l, r, n, score::BIGINT AS score
        FROM kept QUALIFY rank <= 2000
    """,
    "op13_hard_negatives": """
        WITH fine AS (
            SELECT * FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), whole AS (
            SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM fine
        ), scores AS (
            SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same,
                list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM whole a JOIN whole b ON a.id % 100 = 0 AND len(a.v) = len(b.v)
        ), positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same AND id <> anchor_id
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT anchor_id, positive_id,
            row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
            id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5
    """,
}
