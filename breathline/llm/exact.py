"""Exact dedup by content-defined chunk recipes.

A text, white space normalised, is cut after every word whose hash has ``MASK`` zero remainder, and no chunk
is longer than ``LONGEST`` characters: where a cut falls depends on the words before it in the chunk alone, so
equal texts have equal chunks. Distinct chunk texts are gathered once, to verify that each identifier (a digest)
stands for one text; documents are then compared by their lists of identifiers, a tenth of the texts' size.
Should an identifier stand for two texts, the documents that use it are compared by the texts as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from breathline.llm.base import documents, kept, normalised

MASK = 48
LONGEST = 8192


def sha(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def chunks(text: Column) -> Column:
    """The chunks of a text in order. A chunk keeps the mark at its end, so that one that was cut for its length
    differs from one that ends there. A cut takes the space after a mark and is made there alone, so a text that
    ends in a mark has no empty chunk after it, as one that ends in a mark and a space has: chunks up to a mark,
    joined by spaces, give the text back, and equal lists come from equal texts alone."""
    words = F.split(text, " ")
    # A chunk's words are joined by spaces; \n cannot occur in a normalised text, so it can mark the cuts.
    marked = F.array_join(
        F.transform(words, lambda w: F.when(F.pmod(F.xxhash64(w), F.lit(MASK)) == 0, F.concat(w, F.lit("\n")))
                    .otherwise(w)),
        " ",
    )
    cut = F.split(marked, "(?<=\n) ")
    pieces = F.transform(cut, lambda c: F.when(
        F.length(c) > LONGEST,
        F.transform(F.sequence(F.lit(0), F.floor((F.length(c) - 1) / LONGEST).cast("int")),
                    lambda i: F.substring(c, i * LONGEST + 1, F.lit(LONGEST))),
    ).otherwise(F.array(c)))
    return F.flatten(pieces)


def recipes(docs: DataFrame, identifier: Callable[[Column], Column] = sha) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest of the normalised text and the recipe, a list of chunk
    identifiers as one binary value, followed by the text itself where an identifier is not unique."""
    shaped = documents(docs).select("doc_id", normalised(F.col("text")).alias("text"))
    cut = shaped.select("doc_id", "text", chunks(F.col("text")).alias("chunks"))
    ambiguous = _ambiguous(cut, identifier)
    named = cut.select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.transform("chunks", identifier).alias("identifiers"), "text",
    )
    if not ambiguous.isEmpty():
        used = (
            named.select("text_sha256", F.explode("identifiers").alias("identifier"))
            .join(ambiguous, "identifier", "left_semi").select("text_sha256").distinct()
            .withColumn("by_text", F.lit(True))
        )
        named = named.join(used, "text_sha256", "left").withColumn(
            "identifiers", F.when(F.col("by_text"), F.array_append("identifiers", F.encode("text", "UTF-8")))
            .otherwise(F.col("identifiers")),
        )
    # Identifiers have one width, so the joined list is as good as the list.
    return named.select(
        "doc_id", "text_sha256", F.concat_ws("", F.transform("identifiers", lambda i: F.base64(i))).alias("recipe")
    )


def _ambiguous(cut: DataFrame, identifier: Callable[[Column], Column]) -> DataFrame:
    """Identifiers that stand for more than one chunk text. Every distinct chunk is moved once."""
    distinct = (
        # The outer form: the plain one would first filter on the size of the list, and so make it twice.
        cut.select(F.explode_outer("chunks").alias("chunk"))
        .select(identifier(F.col("chunk")).alias("identifier"), "chunk")
        .groupBy("identifier", "chunk").agg(F.count("*").alias("rows"))
    )
    many = distinct.groupBy("identifier").agg(F.count("*").alias("texts")).where("texts > 1").select("identifier")
    return kept(many, "ambiguous-chunks")


def exact_groups(docs: DataFrame, identifier: Callable[[Column], Column] = sha) -> DataFrame:
    """Every row with the group of its text: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; texts are equal when they are identical after white-space normalisation. The
    smallest doc_id of a group stays. A row that repeats a doc_id with the same text is a further copy: one of
    them stays. A null doc_id stays only in a group without any other. An empty table gives no rows.
    """
    rows = recipes(docs, identifier)
    copies = rows.groupBy("recipe", "text_sha256", "doc_id").agg(F.count("*").alias("times"))
    groups = copies.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.sum("times").alias("group_size"))
    several = groups.where("group_size > 1")
    marked = copies.join(several, "recipe", "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"), "text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"),
    )
    return marked.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay. Rows that are dropped are found by their doc_id; rows that
    repeat a kept doc_id are reduced to one. Those and rows without a doc_id, which stay where ``exact_groups``
    keeps them, are compared by their texts."""
    groups = kept(exact_groups(docs), "exact-groups")
    repeated = groups.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1 or doc_id is null").select("doc_id")
    dropped = groups.where("not kept").select("doc_id").distinct()
    if repeated.isEmpty():
        return docs.join(dropped.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)
    named, nameless = docs.where("doc_id is not null"), docs.where("doc_id is null")
    sole = named.join(repeated, "doc_id", "left_anti").join(dropped, "doc_id", "left_anti")
    again = named.join(repeated, "doc_id", "left_semi").select(*docs.columns).unionByName(nameless).select(
        "doc_id", F.sha2(normalised(F.coalesce(F.col("text"), F.lit(""))), 256).alias("text_sha256"),
        F.struct(*docs.columns).alias("whole"),
    )
    chosen = groups.where("kept").select("doc_id", "text_sha256").distinct()
    staying = again.alias("a").join(
        chosen.alias("c"), F.expr("a.doc_id <=> c.doc_id and a.text_sha256 = c.text_sha256"), "left_semi"
    ).dropDuplicates(["doc_id", "text_sha256"])
    return sole.select(*docs.columns).unionByName(staying.select("whole.*"))
