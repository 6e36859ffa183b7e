"""What a task holds at a time does not follow the table."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from profilematch.operators.blocks import distance_kernel
from profilematch.operators.term_layout import slots_for
from profilematch.operators.tfidf import MAX_BROADCAST_TERMS, fit_index, term_counts
from profilematch.plans.neighbours import CELL_BOUNDS


def test_a_task_counts_few_texts(spark):
    texts = spark.range(20_000).select("id", F.array(F.lit("a"), F.concat(F.lit("b"), "id")).alias("tokens"))
    held = term_counts(texts).groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("id").alias("n"))
    sizes = [r.n for r in held.collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 3_000


def test_files_by_term_hold_many_postings():
    for entries in (10**6, 10**8, 10**9, 6 * 10**9):
        files = slots_for(entries, 200) * 200
        assert files <= 800 or entries / files >= 500_000


def test_distances_are_not_held_for_a_whole_cell():
    draw = np.random.default_rng(3)

    def table(n):
        points = pa.FixedSizeListArray.from_arrays(pa.array(draw.normal(size=n * 8)), 8).cast(pa.list_(pa.float64()))
        return pa.table({"id": pa.array(np.arange(n)), "vector": pa.chunked_array([points]), "label": pa.array(np.arange(n) % 3)})

    left, right = table(2_000), table(2_000)
    tracemalloc.start()
    distance_kernel(3)(left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2_000 * 2_000 * 8
    assert CELL_BOUNDS * 8 < 4_000_000


def test_a_bucket_holds_few_texts(spark):
    texts = spark.range(100_000).select("id", F.array(F.lit("a"), F.concat(F.lit("b"), F.col("id") % 7)).alias("tokens"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for most in (MAX_BROADCAST_TERMS, 2):  # all terms are broadcast, or rare ones are joined by a shuffle
        index = fit_index(texts, "id", "tokens", "smooth", max_broadcast_terms=most).stored()
        held = index.weights.groupBy("id").agg(F.sum(F.col("w") * F.col("w")).alias("n"))
        sizes = held.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
        assert index.buckets > least and index.buckets % least == 0
        assert sum(r.n for r in sizes) == 100_000 and max(r.n for r in sizes) < 9_000
        assert held.where("abs(n - 1) > 1e-9").isEmpty()
