"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Two texts are equal if they are identical once every gap is one space; a null
text is empty. A row whose length no other row has is settled by the length
alone; of the rest, a row whose prefix is alone in its length is settled by the
prefix; only the survivors get the full hash. What is shuffled is lengths and
hashes, never a text, and counts are combined before each shuffle.

Defined cases: of equal texts the smallest id stays, a null id is larger than
any other, and of rows with the same id the one stored first (by file and
position) stays. An empty table gives an empty result. Columns of any name are
returned with their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posloom.llm.common import GAP, KEY, Scratch, read_table, row_keyed, wrapped

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, row key, keep_id, group_size, kept, text_sha256.

    ``text_sha256`` is null where a shorter test settled the row, unless
    ``hash_all`` asks for the digest of every text.
    """
    scratch = Scratch(docs.sparkSession)
    keyed = row_keyed(docs.select(id_col, text_col), scratch)
    keys = scratch.stage(
        keyed.select(F.col(id_col).alias("id"), *KEY, normalised(F.col(text_col)).alias("norm")).select(
            "id", *KEY, F.length("norm").alias("len"), F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("prefix")
        )
    )
    shared_length = keys.groupBy("len").count().filter("count > 1").select("len")
    survivors = (
        keys.join(shared_length, "len", "left_semi")
        .groupBy("len", "prefix")
        .count()
        .filter("count > 1")
        .select("len", "prefix")
    )
    if hash_all:
        hashed = _full_hash(keyed, id_col, text_col)
    else:
        wanted = keys.join(survivors, ["len", "prefix"], "left_semi").select(*KEY)
        hashed = _full_hash(keyed.join(wanted, KEY, "left_semi"), id_col, text_col)
    hashed = scratch.stage(hashed)
    groups = (
        hashed.join(survivors, ["len", "prefix"], "left_semi")
        .groupBy("len", "prefix", "sha")
        .agg(F.min(_order()).alias("keep"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    rows = hashed if hash_all else keys.join(hashed.select(*KEY, "sha"), KEY, "left")
    out = rows.join(groups, ["len", "prefix", "sha"], "left")
    alone = F.col("n").isNull()
    return out.select(
        F.col("id").alias(id_col),
        *KEY,
        F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (_order() == F.col("keep"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _order() -> Column:
    return F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), *KEY)


def _full_hash(keyed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return keyed.select(F.col(id_col).alias("id"), *KEY, normalised(F.col(text_col)).alias("norm")).select(
        "id",
        *KEY,
        F.length("norm").alias("len"),
        F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("prefix"),
        F.sha2("norm", 256).alias("sha"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that repeat an earlier text; columns unchanged."""
    scratch = Scratch(docs.sparkSession)
    keyed = wrapped(docs, scratch, id=id_col, text=text_col)
    dropped = exact_groups(keyed.select("id", "text"), "id", "text").filter("NOT kept").select(*KEY)
    return keyed.join(dropped, KEY, "left_anti").select("doc.*")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(read_table(spark, sf_dir, "documents"), hash_all=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
