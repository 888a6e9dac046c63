import zlib

from pyspark.sql import functions as F

from breathline.llm import shards


def placed(points, dimensions, **how):
    return [row.asDict() for row in shards.kd_shards(points, dimensions, **how).collect()]


def balanced(rows, count, largest):
    sums = [sum(r["size"] for r in rows if r["shard"] == shard) for shard in range(count)]
    assert max(sums) - min(sums) <= 2 * largest + 0.02 * sum(sums) / count, sums
    for shard in range(count):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def test_documents(docs, corpus):
    rows = placed(shards.document_points(docs), ["lang", "source", "length"], shards=4)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str) == sorted(
        ((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in corpus), key=str
    )
    for shard in range(4):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_weighted_medians_balance_any_number_of_shards(spark):
    points = spark.range(20_000).select(
        F.col("id").alias("doc_id"), (F.pmod(F.xxhash64("id"), F.lit(90)) + 1).alias("size"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000))).alias("x"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 40)).alias("y"),
    )
    for count in (1, 2, 5, 16):
        rows = placed(points, ["x", "y"], shards=count)
        assert {r["shard"] for r in rows} == set(range(count))
        balanced(rows, count, 90)


def test_one_value_everywhere_is_split_by_id(spark):
    points = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(10).alias("size"), F.lit(None).cast("int").alias("x"))
    balanced(placed(points, ["x"], shards=8), 8, 10)


def test_rows_without_or_with_one_id_are_split(spark):
    """800 rows of no doc_id, of one, and a third of rows of one; clashing columns are replaced, others stay."""
    for doc_id in (F.lit(None).cast("long"), F.lit(7).cast("long"), F.when(F.col("id") % 3 > 0, F.col("id"))):
        points = spark.range(800).select(doc_id.alias("doc_id"), F.lit(10).cast("long").alias("size"), F.lit(1).alias("x"),
                                         F.lit("old").alias("slot"), F.lit("old").alias("shard"), F.lit("mine").alias("other"))
        for dimensions in (["x"], []):
            rows = placed(points.repartition(3), dimensions, shards=4)
            assert sorted((r["doc_id"] for r in rows), key=str) == sorted((r.doc_id for r in points.collect()), key=str)
            assert {r["other"] for r in rows} == {"mine"} and {r["shard"] for r in rows} == set(range(4))
            balanced(rows, 4, 10)


def test_ids_over_the_whole_long_range(spark):
    most = (1 << 63) - 1
    spread = F.xxhash64("id")
    ends = F.when(F.col("id") % 2 == 0, F.lit(most) - F.col("id")).otherwise(F.lit(-most - 1) + F.col("id"))
    upper = F.lit(most) - F.col("id")
    for doc_id in (spread, ends, upper):
        tied = spark.range(3001).select(doc_id.alias("doc_id"), F.lit(10).cast("long").alias("size"),
                                        (F.col("id") % 3).alias("x"), F.lit(0).alias("y"))
        for dimensions in (["x"], ["y"], []):
            for count in (2, 7):
                rows = placed(tied, dimensions, shards=count)
                assert len(rows) == 3001 and {r["shard"] for r in rows} == set(range(count))
                balanced(rows, count, 10)


def test_wide_coordinates_are_split(spark):
    points = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(5).cast("long").alias("size"),
                                      F.xxhash64("id").alias("x"))
    balanced(placed(points, ["x"], shards=6), 6, 5)


def test_target_bytes_and_boxes(spark):
    points = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(5).alias("size"), (F.col("id") * 7 % 4001).alias("x"))
    rows = placed(points, ["x"], target_bytes=5000)
    assert {r["shard"] for r in rows} == set(range(4))
    ranges = sorted((min(r["x"] for r in rows if r["shard"] == s), max(r["x"] for r in rows if r["shard"] == s)) for s in range(4))
    assert all(one[1] < two[0] for one, two in zip(ranges, ranges[1:]))


def test_fewer_rows_than_shards_and_none(spark, no_docs):
    few = spark.createDataFrame([(1, 5, 0), (2, 5, 0), (2, 5, 0)], "doc_id long, size long, x long")
    assert len(placed(few, ["x"], shards=16)) == 3
    assert placed(shards.document_points(no_docs), ["lang", "source", "length"], shards=16) == []
