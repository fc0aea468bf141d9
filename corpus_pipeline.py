"""A corpus pipeline: language identification, line deduplication, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gablework.llm import cws, lines, mixing, packing, ppm
from gablework.llm.common import Scratch, read_table
from gablework.llm.tokens import public_path


#: Bits that a printable character drawn at random takes, and by how many bits an explanation must be better to count.
RANDOM_BITS, MARGIN_BITS = 6.57, 40.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learned languages go: those whose text is null, empty or without a letter, and those that printable
    characters drawn at random explain better than the best language's model, by MARGIN_BITS or more. lang becomes the predicted language
    where it is null, and where the language that it names takes MARGIN_BITS more than that. A short text takes too few bits for
    either, so it stays as it is.

    The languages are those that the documents themselves name; if they name none, only texts without a letter go. A lang that nothing was
    learned for stays. Repeated rows and null ids are judged like all others, ties go to the first language by name, and an empty
    table gives none."""
    model = ppm.train(docs, ppm.held_out())
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    known = ppm.classify(rows, model, ["row"], inside="row", named=F.col("row.lang")).where(F.col("lang_pred") != ppm.UNDECIDED)
    known = known.where((F.col("bits_per_byte") - RANDOM_BITS) * F.octet_length("row.text") < MARGIN_BITS)
    mended = F.when(F.col("row.lang").isNull() | (F.col("excess_bits") >= MARGIN_BITS), F.col("lang_pred")).otherwise(F.col("row.lang"))
    return known.select(*(mended.alias(c) if c == "lang" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document or line has, nearly or exactly, go; so do documents of which no line is left. n_chars follows the
    text. Blank lines and null texts stay as they are; documents are in order of doc_id, a null one first; an empty table gives none."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    reduced = lines.line_dedup(docs.select("doc_id", "text", row))
    emptied = (F.col("n_dropped") > 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return reduced.where(~emptied).select(*(own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one with the least doc_id, then the least hashes of its text, then of its other
    columns. Rows that share a doc_id are of one class only if their texts are near, so no text is lost with another one's class.

    Texts that are null or without words are alike to none, rows without a doc_id stay, and an empty table gives none."""
    classes = cws.near_duplicates(docs)
    place = ["doc_id", "h1", "h2"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", *(h.alias(f"h{k}") for k, h in enumerate(cws.text_hashes(), 1)))
    stays = rows.join(classes.where("not kept").select(*place).distinct(), place, "left_anti")
    # Rows are dealt out for equal ones only if there are any.
    repeated = classes.where("kept and h1 is not null").groupBy(*place).count().where("count > 1").select(*place)
    if repeated.limit(1).count():
        one = stays.join(repeated, place, "left_semi").groupBy(*place).agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
        stays = stays.join(repeated, place, "left_anti").select("row").union(one.select("row"))
    return stays.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, up to three times, with their columns as they are; those that it
    doesn't take go. A null source is a source of its own, null texts count as empty and are taken by the ranking alone, repeated
    rows are taken alike, and an empty table gives none. Reruns agree."""
    return mixing.repeated(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, a row for each piece. Null and empty texts are one end token,
    copies of a document are packed each, other columns are ignored, and an empty table gives none."""
    return packing.pack(docs, public_path("byte_bpe_50k.json"), 1)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Language identification, near duplicates and packing can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents. A stage's table is deleted when the next one is written."""
    docs, scratch = read_table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{name}")
        scratch.drop(docs)
    return docs
