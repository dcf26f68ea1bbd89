"""The training-data pipeline: documents to packed training sequences.

Five stages, each over all that the one before it kept, written as Parquet to
the shared folder and read again:

language ID    documents without a letter (or text) go
near-dedup     one document of each SimHash group stays, the smallest doc_id
secret scans   found secrets are replaced in the text
mixing         sources are mixed to target shares (none above a third); the
               rows come in the order of the mix, all of them: the surplus of a source
               that is left alone at the end comes last
packing        pieces of at most 2048 tokens with their place in a sequence; pieces that
               are near in the mix are packed together, so sequences follow the mix

A null text has no language and goes in the first stage; other nulls are kept.
An empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.llm import langid, mixing, packing, secret_scan
from starmart.llm.common import fresh, table
from starmart.llm.queries import word_tokenizer
from starmart.llm.simhash import simhash_groups


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known to be one of those learned."""
    model = langid.train(langid.learnable(docs))
    pred, _ = fresh(docs, ["lang_pred", "lang_score"])
    return langid.identify(docs, model).where(F.col(pred) != langid.UNKNOWN).select(*docs.columns)


def row_key(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with two key columns, and their names: rows are equal if and (but
    for 128-bit accidents) only if their keys are. Keys are never null."""
    names = fresh(docs, ["_key", "_key2"])
    return docs.withColumns({n: F.xxhash64(F.lit(k), *docs.columns) for k, n in enumerate(names)}), names


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the one with the smallest id (nulls last; ties by
    a hash of the row). Only keys are grouped; texts move once, with the join."""
    keyed, key = row_key(docs)
    groups = simhash_groups(keyed, keep=tuple(key))
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), *key)
    kept = materialize(
        groups.groupBy("group_id").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
        .select(*[F.col(f"first.{k}").alias(k) for k in key], "n"), "pipeline-kept"
    )
    stay = keyed.join(kept.select(*key), key, "left_semi")
    # A group of one can't hold a repeated row; of the others few do.
    often = materialize(
        groups.join(kept.where("n > 1"), key, "left_semi").groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
        "pipeline-often",
    )
    if not often.isEmpty():
        once = stay.join(often, key, "left_semi").dropDuplicates(key)
        stay = stay.join(often, key, "left_anti").unionByName(once)
    return stay.select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced."""
    return secret_scan.redact(docs, secret_scan.scanner_for(docs), length="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mix. Only keys and sources are mixed; a
    repeated row has one place, which all its copies take."""
    keyed, key = row_key(docs)
    rows = keyed.select(*key, F.col("source").alias("source")).distinct()
    mixed = materialize(mixing.mix(rows, block_rows=1).select(*key, "mix_slot"), "pipeline-mix")
    (slot,) = fresh(keyed, ["mix_slot"])
    places = mixed.select(*key, F.col("mix_slot").alias(slot))
    return keyed.join(places, key).repartitionByRange(F.col(slot)).sortWithinPartitions(slot).select(*docs.columns)


#: Documents that stand next to each other in the mix and are packed together.
WINDOW = 8192


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``mix_slot``: a row's place (from 0, without gaps) in the order in which the stage
    before has written it, that is, by its part file's number and its row there. Rows
    that don't come from such files keep the order they have."""
    slot, part, row = fresh(docs, ["mix_slot", "_part", "_row"])
    try:
        file = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1)
        x = docs.select(*docs.columns, F.coalesce(file.try_cast("int"), F.lit(0)).alias(part), F.col("_metadata.row_index").alias(row))
    except AnalysisException:  # no files below: there is no such column
        at = F.monotonically_increasing_id()
        x = docs.withColumns({part: F.shiftright(at, 33).cast("int"), row: at.bitwiseAND(F.lit((1 << 33) - 1))})
    # One number for each part file.
    sizes = x.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    # Stored, so that the join knows how small it is and leaves the texts where they are.
    starts = materialize(sizes.select(F.col(part).alias("_p"), F.coalesce(before, F.lit(0)).alias("_start")), "pipeline-starts")
    return x.join(starts, F.col(part).eqNullSafe(F.col("_p"))).select(*docs.columns, (F.col("_start") + F.col(row)).cast("long").alias(slot))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces, window by window of the mix: sequences follow its order, so
    those read first hold the sources in their target shares."""
    in_order = placed(docs)
    slot = in_order.columns[-1]
    rows = in_order.select("doc_id", "text", F.col(slot).alias("mix_slot"))
    pieces = packing.pieces(rows, word_tokenizer(), keep=("mix_slot",))
    cut = pieces.withColumn("_window", F.floor(F.col("mix_slot") / WINDOW).cast("long"))
    out = packing.pack_windows(cut, "_window", ["mix_slot", "piece"])
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "mix_slot")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secrets),
    ("mixing", mix),
    ("packing", pack),
]

#: No stage but the first can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
