"""Steps whose time, shuffles or writes once grew faster than their input."""

import os
import time

import pytest
from pyspark.sql import functions as F

from claims import AS_OF, RAW
from claimworks import constants as C
from claimworks import fixture as fx
from claimworks.constants import RAW_COLUMNS
from claimworks.functions import amount_sum, beyond_cents, cents_sum
from claimworks.operators import tables
from claimworks.plans import batch
from claimworks import queries
from claimworks.queries import QUERIES
from claimworks.schemas import RAW as RAW_SCHEMA
from claimworks.session import session_conf, shared_folder, shuffles_freed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_interleaved_key_is_worked_out_once_a_row(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("part"), "id", (F.col("id") * 7 % 50).alias("b"))
    df = tables._sorted(rows, ["part"], ["id", "b"], first=tables.interleaved(rows, ["id", "b"]))
    sorts = [line for line in plan(df).splitlines() if "Sort [" in line or "rangepartitioning(" in line]
    assert sorts and not any("shiftleft" in line for line in sorts)
    assert df.columns == rows.columns and df.exceptAll(rows).isEmpty() and df.count() == 500


SF = "/root/testdata/sf0.001"


def test_line_items_meet_their_orders_in_the_shuffle_that_deals_them(spark):
    with session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(fx.claims_raw(spark, SF))
    assert text.count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_partkey" in text
    assert "REPARTITION_BY_NUM" not in text  # a fixed count would make partitions as large as the input


def rows_of(spark, ids, version):
    return tables.staged(spark.range(*ids).select("id", (F.col("id") % 2).alias("part"), F.lit(version).alias("version")))


def test_a_newer_batch_is_not_compared_row_by_row(spark, new_table, monkeypatch):
    name, location = new_table()
    tables.upsert(rows_of(spark, (0, 20), 1), name, ["id"], ["part"], location, newer_than="version")
    with monkeypatch.context() as m:
        m.setattr(tables, "_without_stale", None)  # not called: no source row is older
        tables.upsert(rows_of(spark, (10, 30), 2), name, ["id"], ["part"], newer_than="version")
    want = [(i, 1 if i < 10 else 2) for i in range(30)]
    assert sorted(tuple(r) for r in spark.table(name).select("id", "version").collect()) == want
    tables.upsert(rows_of(spark, (25, 35), 1), name, ["id"], ["part"], newer_than="version")
    want += [(i, 1) for i in range(30, 35)]
    assert sorted(tuple(r) for r in spark.table(name).select("id", "version").collect()) == want


def test_large_files_are_not_merged_again(spark, new_table, monkeypatch):
    name, location = new_table()
    tables.create(spark.range(0, 4_000, 1, 4).withColumn("part", F.lit(0)), name, ["part"], location, rebalance=False)
    assert tables.has_small_files(spark, name, {"part": 0})
    monkeypatch.setattr(tables, "SMALL_FILE", 1_000)
    assert not tables.has_small_files(spark, name, {"part": 0})
    monkeypatch.undo()
    tables.compact(spark, name)
    assert not tables.has_small_files(spark, name, {"part": 0})  # one file


def test_checks_work_out_the_claims_once(spark, monkeypatch):
    built = []
    raw = fx.claims_raw
    monkeypatch.setattr(fx, "claims_raw", lambda *given: built.append(given) or raw(*given))
    for query in ("audit_log", "check_gold_freshness"):
        QUERIES[query](spark, SF)
        assert len(built) == 1
        built.clear()


def test_a_refresh_reads_a_result_that_was_written(spark, monkeypatch):
    texts, write = [], tables.overwrite
    monkeypatch.setattr(tables, "overwrite", lambda df, *where: texts.append(plan(df)) or write(df, *where))
    assert QUERIES["overwrite_refresh"](spark, SF).count()
    assert len(texts) == 2 and not any("l_orderkey" in text for text in texts)


def sums_of(spark, amounts):
    df = spark.createDataFrame([(i % 7, a) for i, a in enumerate(amounts)], "g int, paid double").repartition(4)
    return df, df.groupBy("g").agg(amount_sum("paid").alias("exact"), cents_sum("paid").alias("cents"))


def test_a_sum_of_cents_is_the_exact_sum(spark):
    amounts = [None if i % 11 == 0 else (i * 7919 % 100_003 - 40_000) / 100 for i in range(3_000)]
    df, sums = sums_of(spark, [*amounts, 0.0, -0.0, 999_999.99, -999_999.99])
    assert df.filter(beyond_cents("paid")).isEmpty()
    assert all(r["exact"] == r["cents"] for r in sums.collect())
    nothing = sums_of(spark, [None])[1].first()
    assert nothing["exact"] is None and nothing["cents"] is None
    text = spark.range(95_000_000).agg(cents_sum(F.lit(999_999.99))).first()[0]  # past the whole numbers of doubles
    assert text == 94_999_999_050_000.0


def test_amounts_that_are_no_cents_are_found(spark):
    odd = [0.001, 1e6, -1e18, 1e300, float("inf"), float("nan"), 12.345]
    df, _ = sums_of(spark, [*odd, None, 1.0, 0.07, 999_999.99])
    assert df.filter(beyond_cents("paid")).count() == len(odd)


def gold_plans(spark, tmp_path, new_table, monkeypatch, paid):
    """The plans of the aggregate tables of a load, and its member table."""
    prefix, _ = new_table("cents")
    cfg = batch.BatchConfig(raw_root=str(tmp_path / "raw"), prefix=f"{prefix}_", root=str(tmp_path / prefix), as_of=AS_OF, layout=False)
    rows = [tuple({**dict(zip(RAW_COLUMNS, RAW[0])), "claim_id": f"C{i}", "paid_amount": paid}.values()) for i in range(30)]
    spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.mode("overwrite").csv(f"{cfg.raw_root}/2025-03-01", header=True)
    batch.load_bronze(spark, cfg, "2025-03-01")
    batch.load_silver(spark, cfg, "2025-03-01")
    texts, write = [], tables.create
    with monkeypatch.context() as m:
        m.setattr(tables, "create", lambda df, *where, **how: texts.append(plan(df)) or write(df, *where, **how))
        batch.load_gold(spark, cfg, "2025-03-01")
    return [t for t in texts if "Aggregate" in t], spark.table(cfg.name(C.MEMBER_360)).first()


def test_a_load_of_cents_sums_longs(spark, tmp_path, new_table, monkeypatch):
    texts, member = gold_plans(spark, tmp_path, new_table, monkeypatch, "1500.01")
    assert len(texts) == 4 and not any("decimal(28,10)" in t for t in texts)
    assert member["lifetime_paid"] == 45_000.3


def test_a_load_with_other_amounts_sums_decimals(spark, tmp_path, new_table, monkeypatch):
    texts, member = gold_plans(spark, tmp_path, new_table, monkeypatch, "0.001")
    assert len(texts) == 4 and all("decimal(28,10)" in t for t in texts)
    assert member["lifetime_paid"] == 0.03


def test_snapshots_of_all_days_sum_longs(spark, monkeypatch):
    texts, write = [], tables.staged
    monkeypatch.setattr(tables, "staged", lambda df: texts.append(plan(df)) or write(df))
    assert QUERIES["upsert_kpi_all_days"](spark, SF).count()
    kpi = [t for t in texts if "percentile_approx" in t]
    assert len(kpi) == 1 and "decimal(28,10)" not in kpi[0]


def test_writes_side_by_side_all_end_before_an_error_is_raised(spark):
    ended = []

    def fails():
        raise ValueError("first")

    with pytest.raises(ValueError, match="first"):
        batch._at_once(spark, fails, lambda: time.sleep(0.2) or ended.append(1))
    assert ended == [1]


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for top in blocks.localDirsString() for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark, new_table):
    rows = spark.range(2_000).select("id", (F.col("id") % 2).alias("part"), F.lit(1).alias("version"))
    name, location = new_table()
    before = shuffle_files(spark)
    dealt = [tables.staged(rows.repartition(3, "id").sortWithinPartitions("id"))]
    tables.create(rows, name, ["part"], location)
    tables.append(rows.withColumn("id", F.col("id") + 2_000), name, rebalance=True)
    tables.compact(spark, name)
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:  # they are deleted in the background
        time.sleep(0.2)
    assert not left and dealt[0].count() == 2_000
    assert sorted(r["id"] for r in spark.table(name).collect()) == list(range(4_000))


def test_the_setting_that_frees_shuffles_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with shuffles_freed(spark):
        with shuffles_freed(spark):
            pass
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) is None


def scratch(spark, label):
    folder = shared_folder(spark).removeprefix("file://").removeprefix("file:")
    return {f"{folder}/{f}" for f in os.listdir(folder) if f.startswith(f"{label}-")} if os.path.isdir(folder) else set()


def test_two_loads_leave_no_rows_behind(spark):
    before = scratch(spark, "stage")
    assert QUERIES["upsert_claims"](spark, SF).count()
    assert scratch(spark, "stage") == before


def test_files_of_a_load_go_when_it_is_loaded(spark, monkeypatch):
    before, seen = scratch(spark, "load"), []

    def load_bronze(spark, cfg, day):
        seen.append(len(os.listdir(cfg.raw_root.removeprefix("file://").removeprefix("file:"))))
        return batch.load_bronze(spark, cfg, day)

    monkeypatch.setattr(batch, "STAGES", ((load_bronze, ("SUCCESS",)),))
    results, cfg = queries._run(spark, SF)
    assert seen == [1, 1] and sum(r.metrics["records_ingested"] for r in results) == 6_000
    (root,) = scratch(spark, "load") - before
    assert os.listdir(f"{root}/raw") == [] and spark.table(cfg.name(C.BRONZE)).count() == 6_000


def test_the_scorecard_reads_claims_that_were_written(spark):
    text = plan(QUERIES["gold_provider_scorecard"](spark, SF))
    assert "l_orderkey" not in text and "hashpartitioning(claim_id" not in text


@pytest.mark.parametrize("query", ["silver_with_stream", "silver_late_stream"])
def test_a_bronze_table_of_one_or_two_days_is_not_shuffled_to_be_written(spark, monkeypatch, query):
    class Seen(Exception):
        pass

    def create(df, name, partition_by=(), location=None, mode="errorifexists", rebalance=True, **how):
        raise Seen(name, rebalance)

    monkeypatch.setattr(tables, "create", create)
    with pytest.raises(Seen) as seen:
        QUERIES[query](spark, SF)
    assert seen.value.args[0].endswith(C.BRONZE) and seen.value.args[1] is False


def test_rows_that_an_old_batch_may_still_bring_are_joined_once(spark, new_table, monkeypatch):
    name, location = new_table()
    before, texts = scratch(spark, "stage"), []
    for ids, version in (((0, 20), 1), ((10, 30), 2)):
        rows = rows_of(spark, ids, version)
        tables.upsert(rows, name, ["id"], ["part"], location, newer_than="version", key_buckets=2)
        tables.release(rows)
    index = tables._index_keys
    monkeypatch.setattr(tables, "_index_keys", lambda rows, *given: texts.append(plan(rows)) or index(rows, *given))
    old = rows_of(spark, (5, 35), 1)
    tables.upsert(old, name, ["id"], ["part"], newer_than="version", key_buckets=2)
    tables.release(old)
    assert len(texts) == 1 and "Join" not in texts[0]
    assert scratch(spark, "stage") == before
    want = [(i, 2 if 10 <= i < 30 else 1) for i in range(35)]
    assert sorted(tuple(r) for r in spark.table(name).select("id", "version").collect()) == want
