"""Exact dedup: 128-bit content hash, smallest id stays, bytes compared inside every group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import matching_rows, stage

#: Rows of one group that are compared with its first text in one join key.
ROWS_PER_SALT = 4096


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_groups(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fingerprint: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are grouped by `fingerprint`; every row of a group of two or more is then compared byte by byte with the
    text of the group's smallest id, and rows that only share the hash are grouped again by the text itself. The
    comparison is salted by group size, and groups are only ever partial aggregates, so a group with a third of all
    rows is spread over tasks.

    Null text counts as empty. Rows with a null id are grouped and never give the id that stays, unless all ids of
    the group are null: keep_id is then null and the rows are kept. Rows that repeat the smallest id are one document
    and are all kept. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    text = normalised(F.col(text_col))
    rows = documents.select(F.col(id_col).alias("doc_id"), text.alias("body"))
    prints = stage(
        rows.select("doc_id", fingerprint(F.col("body")).alias("fp"), F.sha2("body", 256).alias("text_sha256")), "prints"
    )
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    shared = stage(groups.where("group_size > 1"), "shared")

    salts = F.ceil(F.col("group_size") / ROWS_PER_SALT).cast("int")
    # rows without an id, or with the same one, are dealt out as any others: the salt is the row's, not the id's
    members = stage(
        rows.withColumn("fp", fingerprint(F.col("body")))
        .withColumn("row", F.monotonically_increasing_id())
        .join(shared, "fp")
        .withColumn("salt", F.pmod(F.xxhash64("row"), salts).cast("int"))
        .drop("row"),
        "members",
    )
    first = (
        members.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("fp")
        .agg(F.min("body").alias("first_body"), F.max("group_size").alias("group_size"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("group_size")
    )
    strays = stage(
        members.join(first, ["fp", "salt"]).where(F.col("body") != F.col("first_body")).select("doc_id", "fp", "body"),
        "strays",
    )

    # a class is a hash and the digest of the bytes that were compared
    stray_classes = (
        strays.groupBy("fp", "body")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("fp", F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    if strays.isEmpty():
        out = prints.join(shared, "fp", "left")
    else:
        whole = prints.join(stray_classes.select("fp", "text_sha256"), ["fp", "text_sha256"], "left_anti")
        main = whole.groupBy("fp", "text_sha256").agg(
            F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        classes = stage(main.unionByName(stray_classes), "classes")
        out = prints.join(classes, ["fp", "text_sha256"], "left")
    # a text of its own hash has no row in the groups
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def exact_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `documents` that stay, with all their columns."""
    kept = exact_groups(documents, id_col, text_col).where("kept").select("doc_id", "text_sha256")
    return matching_rows(
        documents, kept, doc_id=F.col(id_col), text_sha256=F.sha2(normalised(F.col(text_col)), 256)
    )
