import random

import pytest
from pyspark.sql import functions as F

from clickfeat import LevelTable, Roles
from clickfeat.operators import encoding
from clickfeat.operators import levels as lv
from clickfeat.operators import lookup, summary
from clickfeat.operators.lookup import attach
from clickfeat.operators.ordering import number_rows, running_totals, store_in_order
from tests.conftest import rows_of


def test_summary(clicks):
    df, roles = clicks
    table = {r["col"]: r for r in summary.summarise(df, roles).collect()}
    assert table["n1"]["mean"] == 2.0 and table["n1"]["n"] == 4
    assert (table["n1"]["min"], table["n1"]["max"], table["n1"]["sum"]) == (0.0, 4.0, 8.0)
    assert table["empty"]["mean"] is None and table["empty"]["n"] == 0
    assert (table["c1"]["mode"], table["c1"]["levels"]) == (3, 2)  # tie: the smallest
    assert (table["c2"]["mode"], table["c2"]["levels"]) == (10, 3)  # a real -1 is a level
    assert (table["none"]["mode"], table["none"]["levels"]) == (None, 0)
    assert table["label"]["pos"] == 1 and table["none"]["pos"] == 7


def test_summary_with_id(clicks):
    df, roles = clicks
    modes = {r["col"]: r for r in summary.level_modes(df, roles, include_id=True).collect()}
    assert (modes["id"]["mode"], modes["id"]["mode_n"]) == (3, 2)


def test_empty_table(spark, clicks):
    df, roles = clicks
    nothing = df.limit(0)
    assert summary.numeric_summary(nothing, roles).filter("n <> 0").count() == 0
    assert lv.level_counts(nothing, roles).count() == 0
    kept = LevelTable.keep(lv.level_counts(nothing, roles))
    assert kept.rows == {} and kept.total == 0
    assert encoding.index_levels(df, roles, kept.numbered()).filter("c1 <> -1").count() == 0


def test_counts_by_label_and_pooling(clicks):
    df, roles = clicks
    counts = lv.level_counts(df, roles, by_label=True)
    picked = counts.filter("col = 'c1'").select("value", "n0", "n1")
    assert rows_of(picked) == [(None, 1, 0), (3, 1, 1), (7, 1, 1)]
    pooled = lv.pool_rare(counts, 2).filter("col = 'c2'").select("value", "n0", "n1")
    assert rows_of(pooled) == [(None, 1, 2), (10, 2, 0)]
    assert {tuple(r) for r in lv.class_totals(counts).select("n0", "n1").collect()} == {(3, 2)}


def test_missing_label_counts_as_zero(spark):
    df = spark.createDataFrame([(1, None, 4), (2, 1.0, 4)], "id bigint, y double, c bigint")
    rates = lv.target_rates(lv.level_counts(df, Roles("id", "y", (), ("c",)), by_label=True))
    assert rows_of(rates, "n", "label_sum", "rate") == [(2, 1, 0.5)]


@pytest.fixture(scope="module")
def wide(spark):
    """Two columns over the same values, one level holding a third of all rows."""
    random.seed(5)
    rows = [
        (i, float(i % 2), None if i % 9 == 0 else 42 if i % 3 == 0 else random.randrange(-500, 500),
         random.randrange(7))
        for i in range(3000)
    ]
    roles = Roles("id", "y", (), ("c1", "c2"))
    return spark.createDataFrame(rows, "id bigint, y double, c1 bigint, c2 bigint"), roles


@pytest.mark.parametrize("per_column", [False, True])
@pytest.mark.parametrize("buckets", [None, 1, 13])
def test_numbering_is_dense_whatever_the_partitioning(wide, buckets, per_column):
    df, roles = wide
    counts = lv.level_counts(df.repartition(3), roles)
    table = LevelTable.keep(counts, buckets).numbered(per_column=per_column)
    levels = rows_of(counts.filter("value IS NOT NULL"), "pos", "value")
    want, seen = {}, {}
    for i, (pos, value) in enumerate(levels):
        want[pos, value] = seen.get(pos, 0) if per_column else i
        seen[pos] = seen.get(pos, 0) + 1
    assert {(r["pos"], r["value"]): r["idx"] for r in table.frame.collect()} == want
    assert sum(table.rows.values()) == len(levels) and table.total == 3000


@pytest.mark.parametrize("budget", [0, 50, 10_000])
def test_lookup_is_the_same_for_every_join_choice(wide, budget):
    df, roles = wide
    table = LevelTable.keep(lv.level_counts(df, roles)).numbered()
    index = {(r["col"], r["value"]): r["idx"] for r in table.frame.collect()}
    extra = df.unionByName(df.limit(1).withColumn("c1", F.lit(123456789).cast("bigint")))
    found = encoding.index_levels(extra, roles, table, broadcast_levels=budget)
    want = sorted(
        (r["id"], index.get(("c1", r["c1"]), -1), index.get(("c2", r["c2"]), -1))
        for r in extra.collect()
    )
    assert sorted(tuple(r) for r in found.select("id", "c1", "c2").collect()) == want


def test_large_lookups_are_not_broadcast_whole(wide):
    df, roles = wide
    table = LevelTable.keep(lv.level_counts(df, roles))
    found = attach(df, table, {"c1": {"rows": "n"}}, broadcast_levels=10)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The hot levels: for the cells, and for the rows with and without unsettled cells.
    assert plan.count("strategy=broadcast") == 3
    assert "xxhash64" in plan
    hot = found.filter("c1 = 42").select("rows").distinct().collect()
    assert [r["rows"] for r in hot] == [df.filter("c1 = 42").count()]


def test_shuffled_lookup_spreads_hot_and_missing_levels(spark, wide):
    df, roles = wide
    third = F.pmod(F.xxhash64("id"), F.lit(3))
    level = F.when(third == 0, F.lit(42)).when(third == 1, F.lit(None)).otherwise(F.col("c1"))
    skewed = df.withColumn("c1", level.cast("bigint"))
    table = LevelTable.keep(lv.level_counts(skewed, roles))
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        found = attach(skewed, table, {"c1": {"rows": "n"}}, broadcast_levels=0)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key in off:
            spark.conf.unset(key)
    assert len(sizes) > 4 and sum(sizes) == 3000
    assert max(sizes) < 1000  # hashing the level alone would put two thirds into two tasks


def _columns(spark, n):
    roles = Roles("id", "y", (), tuple(f"c{i}" for i in range(n)))
    df = spark.range(400).select(
        "id",
        (F.col("id") % 2).cast("double").alias("y"),
        *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(3000)).alias(c) for i, c in enumerate(roles.categorical)],
    )
    return df, roles


def test_shuffles_do_not_grow_with_the_columns(spark):
    def shuffles(n):
        df, roles = _columns(spark, n)
        table = LevelTable.keep(lv.level_counts(df, roles)).numbered()
        found = attach(df, table, {c: {f"{c}_i": "idx"} for c in roles.categorical}, 0)
        plan = found._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning"), plan.count("Exchange rangepartitioning")

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(2) == shuffles(7) == (4, 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_each_column_gets_its_own_facts(spark):
    df, roles = _columns(spark, 3)
    table = LevelTable.keep(lv.level_counts(df, roles, by_label=True)).numbered()
    wanted = {"c0": {"a": "idx", "b": "n"}, "c2": {"d": "n1"}}
    shuffled = attach(df, table, wanted, 0)
    assert shuffled.columns == ["id", "y", "c0", "c1", "c2", "a", "b", "d"]
    assert rows_of(shuffled) == rows_of(attach(df, table, wanted))


def test_a_hot_level_that_the_table_lacks_stays_where_it_is(spark):
    """New data whose commonest level is unknown, and rows that are all alike, without skew-join splitting."""
    df, roles = _columns(spark, 2)
    table = LevelTable.keep(lv.level_counts(df, roles)).numbered()
    new = df.unionByName(df.withColumn("c0", F.lit(-77).cast("bigint")))
    alike = spark.range(900).select(F.lit(7).cast("bigint").alias("id"),
        F.lit(1.0).alias("y"), F.lit(-5).cast("bigint").alias("c0"),
        F.lit(None).cast("bigint").alias("c1"))
    new = new.unionByName(alike)
    hot = lookup.hot_levels(new, ["c0", "c1"], share=1 / 50)
    assert rows_of(hot) == [("c0", -77), ("c0", -5)]
    off = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        wanted = {c: {f"{c}_i": "idx"} for c in roles.categorical}
        found = attach(new, table, wanted, 0).cache()
        assert rows_of(found) == rows_of(attach(new, table, wanted))
        # Rows that are all alike are settled: spread as they came, not dealt by a key.
        alike = found.filter("c0 = -5").groupBy(F.spark_partition_id()).count().collect()
        assert len(alike) == spark.range(900).rdd.getNumPartitions()
        found.unpersist()
    finally:
        for key in off:
            spark.conf.unset(key)
    cold = {"c0": F.when(~F.col("c0").isin(-77, -5), F.col("c0")), "c1": F.col("c1")}
    keyed = new.select("*", F.lit(1).alias("__key_1"), F.lit(2).alias("__key_2"))
    cells = lookup.cold_cells(keyed, cold)
    assert cells.filter("value IN (-77, -5) OR value IS NULL").count() == 0
    assert cells.count() == 400 + 800


def test_sketch_finds_every_hot_level(spark):
    """Shares just above the bound, among as many levels as there are other rows."""
    rare = spark.range(60_000).select((F.col("id") + 10_000).alias("c"))
    hot = spark.range(80 * 110).select((F.col("id") % 110).alias("c"))
    found = {r["value"] for r in lookup.hot_levels(rare.union(hot).repartition(5), ["c"]).collect()}
    assert set(range(110)) <= found and len(found) <= 1000
    assert lookup.hot_levels(rare.limit(0), ["c"]).count() == 0


@pytest.mark.parametrize("buckets", [1, 7])
def test_running_totals(spark, buckets):
    df = spark.range(200).select((F.col("id") * 37 % 200).alias("k"), F.col("id").alias("v"))
    stored = store_in_order(df, ["k"], "test", buckets)
    totals = running_totals(stored, ["k"], {"run": F.col("v")})
    want, so_far = [], 0
    for k, v in rows_of(df, "k", "v"):
        so_far += v
        want.append((k, so_far))
    assert rows_of(totals, "k", "run") == want
    assert rows_of(number_rows(stored, ["k"], "i"), "k", "i") == [(i, i) for i in range(200)]


def test_rare_levels_and_encodings(clicks):
    df, roles = clicks
    counts = LevelTable.keep(lv.level_counts(df, roles))
    frequent = encoding.frequent_levels(counts, 1)
    dropped = encoding.drop_rare_levels(df, roles, frequent)
    assert rows_of(dropped, "id", "c1", "c2") == [
        (1, 7, None), (2, 7, 10), (3, 3, None), (3, 3, 10), (5, None, None),
    ]
    rates = encoding.fit_target_rates(df, roles)
    new = df.limit(1).withColumn("c1", F.lit(99).cast("bigint"))
    assert rows_of(encoding.target_encode(new, roles, rates), "c1") == [(99.0,)]
    assert rows_of(encoding.target_encode(new, roles, rates, "null"), "c1") == [(None,)]
    assert rows_of(encoding.target_encode(new, roles, rates, "prior", 0.4), "c1") == [(0.4,)]
    with pytest.raises(ValueError):
        encoding.target_encode(new, roles, rates, "guess")
    assert rows_of(encoding.target_encode(df, roles, rates), "c1") == [
        (None,), (0.5,), (0.5,), (0.5,), (0.5,),
    ]
