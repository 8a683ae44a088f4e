"""Connected components: as few rounds as the links ask for, each round a few scratch tables."""

import numpy as np
from pyspark.sql import functions as F

from tillbook.llm import common, near_dup


def saved(monkeypatch, module):
    labels = []

    def save(frame, label):
        labels.append(label)
        return common_save(frame, label)

    common_save = common.save
    monkeypatch.setattr(module, "save", save)
    return labels


def of(frame):
    return {r.node: r.component for r in frame.collect()}


def test_stars_are_not_joined_again(spark, monkeypatch):
    labels = saved(monkeypatch, common)
    links = spark.createDataFrame([(1, 5), (1, 9), (9, 1), (2, 7), (3, 3)], "u long, v long")
    assert of(common.components(links)) == {1: 1, 5: 1, 9: 1, 2: 2, 7: 2}
    assert labels == ["edges"]


def test_paths_and_random_links(spark):
    dice = np.random.default_rng(5)
    pairs = [(k, k + 1) for k in range(1000, 1040)] + [tuple(map(int, p)) for p in dice.integers(0, 300, (200, 2))]
    least = {n: n for pair in pairs for n in pair if pair[0] != pair[1]}
    for _ in least:
        for u, v in pairs:
            if u != v:
                least[u] = least[v] = min(least[u], least[v])
    assert of(common.components(spark.createDataFrame(pairs, "u long, v long"))) == least
    assert of(common.components(spark.createDataFrame([], "u long, v long"))) == {}


def test_pointers_jump_to_the_roots(spark, monkeypatch):
    labels = saved(monkeypatch, near_dup)
    chain = spark.createDataFrame([(k, k + 1) for k in range(64)] + [(2, 100)], "u long, v long")
    assert of(near_dup._roots(chain)) == {k: 0 for k in [*range(1, 65), 100]}
    assert len(labels) <= 7
    assert of(near_dup._roots(chain.limit(0))) == {}


def test_batches_are_small_only_inside(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    with common.small_batches(spark):
        assert spark.conf.get(key) == "8m"
    assert spark.conf.get(key) == before


def test_near_dup_hands_small_batches_to_python(spark, monkeypatch):
    """All its Python work is behind a scratch table; a batch of 64 MB is held several times over by each task."""
    key, sizes, plain = "spark.sql.execution.arrow.maxBytesPerBatch", [], near_dup.save

    def save(frame, label):
        sizes.append(spark.conf.get(key))
        return plain(frame, label)

    monkeypatch.setattr(near_dup, "save", save)
    near_dup.near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")).collect()
    assert set(sizes) == {"8m"}


def test_near_dup_writes_few_scratch_tables(spark, monkeypatch):
    """Every scratch table is a job with a file a task; 22 were written for these texts before."""
    tables = saved(monkeypatch, near_dup), saved(monkeypatch, common)
    words = [f"w{k}" for k in range(80)]
    texts = [(k, " ".join([*words, f"x{k}"])) for k in range(40)] + [(100 + k, f"lone text {k} of some seven words") for k in range(20)]
    found = near_dup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {k: 0 if k < 40 else k for k, _ in texts}
    assert sum(map(len, tables)) <= 14


def test_two_partitions_share_a_file(spark):
    """However many partitions a shuffle starts with, two go into a file; a core is never left without one."""
    key, cores = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", spark.sparkContext.defaultParallelism
    before = spark.conf.get(key, None)
    try:
        for started in (2 * cores + 8, 2 * cores + 80):
            spark.conf.set(key, started)
            found = common.save(common.merged(spark.range(0, 10_000, 1, started).select("id")), "merged")
            assert len(found.inputFiles()) == started // 2
            assert found.count() == 10_000 and found.distinct().count() == 10_000
        spark.conf.set(key, 1)
        assert common.merged(spark.range(0, 100, 1, 3 * cores)).rdd.getNumPartitions() == cores
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_scratch_tables_of_near_dup_are_merged(spark, monkeypatch):
    """Those with a file for each task of a scan or shuffle of whole documents; joins split for hot keys are left alone."""
    seen, plain = [], near_dup.merged

    def merged(frame):
        seen.append(frame)
        return plain(frame)

    monkeypatch.setattr(near_dup, "merged", merged)
    near_dup.near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")).collect()
    assert len(seen) == 5


def test_near_duplicates_broadcast_no_table_by_an_estimate(spark, monkeypatch):
    """Estimates from files are far too low behind an explode; sizes that a shuffle has measured are broadcast as before."""
    plans, write = [], common.save

    def save(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return write(frame, label)

    for module in (common, near_dup):
        monkeypatch.setattr(module, "save", save)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(key, None) for key in keys]
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), " ".join([*words[:58], "x", "y"]), " ".join(reversed(words)), "", None]
    found = near_dup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 8 and not [plan for plan in plans if "Broadcast" in plan]
    assert [spark.conf.get(key, None) for key in keys] == before
    assert {r.doc_id: r.component_id for r in found.collect()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}


def test_measured_sizes_are_broadcast(spark):
    """What a shuffle shows to be small is still sent to all tasks."""
    many = spark.range(2000).select((F.col("id") % 50).alias("k"), "id")
    few = spark.range(50).groupBy((F.col("id") * 1).alias("k")).agg(F.count("*").alias("n"))
    with common.measured_broadcasts(spark):
        joined = many.repartition(4, "id").join(few, "k")
        planned = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2000 and joined.collect()
        ran = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in planned and "BroadcastHashJoin" in ran
