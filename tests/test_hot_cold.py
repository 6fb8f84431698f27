from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from paytide.functions.clock import latest
from paytide.operators import hot_cold, retention
from paytide.sources import HotStore, Source, has_rows, load_archive, read_or_empty
from paytide.sources.sample import moment
from paytide.model import FACT, STORED_FACT
from rows import at, fact, same, txn

NOW = at("2024-01-01 12:00:00")
CUTOFF = "2024-01-01 09:00:00"


def hourly(spark, first, last, start=0):
    return fact(spark, [txn(start + h, when=f"2024-01-0{1 + h // 24} {h % 24:02d}:00:00") for h in range(first, last)])


@pytest.fixture()
def store(spark, tmp_path):
    return HotStore(spark, str(tmp_path / "store"))


def ids(df):
    return sorted(r.transaction_id for r in df.select("transaction_id").collect())


def test_split_is_exact_and_keeps_the_boundary(spark):
    facts = fact(spark, [
        txn(1, when="2024-01-01 08:59:59"), txn(2, when="2024-01-01 09:00:00"), txn(3, when="junk"), txn(4, when=None),
    ])
    kept, gone = retention.retain_hot(facts, moment(CUTOFF)), retention.archive_expired(facts, moment(CUTOFF))
    assert ids(kept) == ["t2"]
    same(kept.unionAll(gone), facts)


def test_dedup_by_id_is_the_same_for_any_order_of_differing_copies(spark):
    a, b = fact(spark, [txn(1, amount=5.0)]), fact(spark, [txn(1, amount=3.0), txn(2)])
    once = hot_cold.dedup_by_id(hot_cold.hot_cold_union(a, b))
    assert sorted((r.transaction_id, r.transaction_amount) for r in once.collect()) == [("t1", 3.0), ("t2", 10.0)]
    same(once, hot_cold.dedup_by_id(hot_cold.hot_cold_union(b, a)))


def test_rows_without_id_are_copies_only_when_identical(spark):
    nameless = [(None, *txn(0, amount=amount)[1:]) for amount in (1.0, 1.0, 2.0)]
    once = hot_cold.dedup_by_id(fact(spark, nameless))
    assert sorted(r.transaction_amount for r in once.collect()) == [1.0, 2.0]


def test_union_fills_a_missing_column(spark):
    old = fact(spark, [txn(1)]).drop("status")
    both = hot_cold.hot_cold_union(fact(spark, [txn(2)]), old)
    assert {r.transaction_id: r.status for r in both.collect()} == {"t1": None, "t2": "Success"}


def test_union_with_either_side_empty(spark):
    some, none = fact(spark, [txn(1)]), fact(spark, [])
    assert ids(hot_cold.hot_cold_union(some, none)) == ids(hot_cold.hot_cold_union(none, some)) == ["t1"]


@pytest.mark.parametrize("snapshot", [False, True])
def test_runs_lose_and_repeat_nothing(spark, store, snapshot):
    everything = hourly(spark, 0, 40)
    store.ingest(everything.where(F.col("ts") < moment("2024-01-01 12:00:00")))
    assert retention.archive_run(store, NOW, snapshot=snapshot)
    store.ingest(everything.where(F.col("ts") >= moment("2024-01-01 12:00:00")))
    assert retention.archive_run(store, NOW + timedelta(hours=4), snapshot=snapshot)
    assert retention.archive_run(store, NOW + timedelta(hours=30), snapshot=snapshot)
    same(retention.archived_once(store), everything.select(*STORED_FACT.names))
    copies = store.archive().count() + store.current().count()
    assert (copies > everything.count()) == snapshot


def test_manifest_row(spark, store):
    store.ingest(hourly(spark, 0, 13))
    retention.archive_run(store, NOW)
    run = store.runs().first()
    assert (run.rows, run.kept, run.expired, run.generation) == (13, 4, 9, 1)
    assert run.batch_id == 1704110400 and run.cutoff == at("2024-01-01 09:00:00")
    assert (run.min_ts, run.max_ts) == (at("2024-01-01 00:00:00"), at("2024-01-01 08:00:00"))
    moved = retention.archive_expired(hourly(spark, 0, 13), moment(CUTOFF))
    assert run.checksum == retention.stored_facts(moved).first().checksum


def test_repeating_a_run_changes_nothing(spark, store):
    store.ingest(hourly(spark, 0, 13))
    assert retention.archive_run(store, NOW)
    assert not retention.archive_run(store, NOW)
    assert store.runs().count() == 1


def test_runs_that_move_nothing_or_everything(spark, store):
    store.ingest(hourly(spark, 10, 13))
    assert retention.archive_run(store, NOW)
    assert (store.current().count(), store.archive().count()) == (3, 0)
    assert retention.archive_run(store, NOW + timedelta(days=2))
    assert (store.current().count(), store.archive().count()) == (0, 3)
    assert not retention.archive_run(store, NOW + timedelta(days=3))
    assert [(r.kept, r.expired) for r in store.runs().orderBy("generation").collect()] == [(3, 0), (0, 3)]


def test_run_over_nothing(store):
    assert not retention.archive_run(store, NOW)
    assert not has_rows(store.current()) and not has_rows(store.archive())
    assert store.current().columns == STORED_FACT.names


def test_a_run_that_dies_before_its_commit_is_invisible(spark, store, monkeypatch):
    store.ingest(hourly(spark, 0, 13))
    before = ids(store.current())

    def die(_self, _run):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(HotStore, "commit", die)
        with pytest.raises(RuntimeError):
            retention.archive_run(store, NOW)
    assert ids(store.current()) == before and store.archive().count() == 0
    assert load_archive(spark, store.archive_root).count() == 9
    assert ids(retention.archived_once(store)) == before
    assert retention.archive_run(store, NOW)
    assert ids(retention.archived_once(store)) == before


def test_rows_without_time_are_archived_not_lost(spark, store):
    store.ingest(fact(spark, [txn(1, when="junk"), txn(2, when="2024-01-01 11:00:00")]))
    retention.archive_run(store, NOW)
    assert ids(store.archive()) == ["t1"] and ids(store.current()) == ["t2"]


def test_archive_folders_are_dates(spark, store):
    store.ingest(hourly(spark, 0, 30))
    retention.archive_run(store, at("2024-01-02 12:00:00"))
    plan = load_archive(spark, store.archive_root).where("txn_date = DATE'2024-01-02'")
    assert "PartitionFilters: [isnotnull(txn_date" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count() == 6


def test_cutoff_dedup_equals_dedup_by_id(spark):
    facts = hourly(spark, 0, 48)
    first = facts.where(F.col("ts") < moment("2024-01-01 12:00:00"))
    second = facts.where((F.col("ts") >= moment("2024-01-01 09:00:00")) & (F.col("ts") < moment("2024-01-02 00:00:00")))
    live = facts.where(F.col("ts") >= moment("2024-01-01 21:00:00"))
    once = hot_cold.dedup_by_cutoff(live, [(first, moment("2024-01-01 09:00:00")), (second, moment("2024-01-01 21:00:00"))])
    same(once, hot_cold.dedup_by_id(hot_cold.hot_cold_union(live, first, second)))


def test_size_budget_goes_on_within_the_hour(spark):
    facts = fact(spark, [txn(h, when=f"2024-01-01 {h:02d}:30:00") for h in range(10)])
    size = facts.select(retention.row_bytes()).first()[0]
    assert ids(retention.retain_by_size(facts, 3 * size + 1)) == ["t7", "t8", "t9"]
    assert ids(retention.retain_by_size(facts, size - 1)) == []
    assert retention.retain_by_size(facts).count() == 10
    busy = fact(spark, [txn(h, when=f"2024-01-01 09:{h // 4:02d}:{h % 2:02d}") for h in range(10)] + [txn(11, when=None)])
    for budget in range(11):
        kept, others, _ = retention.split_by_size(busy, budget * size + 1)
        newest = sorted(range(10), key=lambda h: (-(h // 4), -(h % 2), h))[:budget]
        assert ids(kept) == sorted(f"t{h}" for h in newest)
        same(kept.unionByName(others), busy)


def test_live_count_includes_the_moment_itself(spark):
    facts = fact(spark, [txn(1, when="2024-01-01 11:59:00"), txn(2, when="2024-01-01 12:00:00"), txn(3, when="2024-01-01 11:58:59")])
    since = latest(facts, back=F.make_dt_interval(secs=F.lit(60)))
    assert retention.live_count(facts, since).first()[0] == 2


def test_only_a_missing_path_reads_as_empty(spark, tmp_path):
    assert read_or_empty(spark, Source(str(tmp_path / "none")), FACT).columns == FACT.names
    with pytest.raises(Exception, match="(?i)data source|nonsense"):
        read_or_empty(spark, Source(str(tmp_path), format="nonsense"), FACT).count()
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "a.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, Source(str(broken)), FACT).count()


def test_live_table_kept_elsewhere(spark, tmp_path):
    live = hourly(spark, 0, 13)
    store = HotStore(spark, str(tmp_path), live)
    with pytest.raises(ValueError):
        store.ingest(live)
    assert retention.archive_run(store, NOW)
    assert store.current().count() == 4
    # New and late rows arrive in the live table, which still holds what was archived.
    more = live.unionByName(fact(spark, [txn(50, when="2024-01-01 12:30:00"), txn(51, when="2024-01-01 00:10:00"), txn(52, when=None)]))
    store = HotStore(spark, str(tmp_path), more)
    assert store.current().count() == 7
    same(retention.archived_once(store), more.select(*STORED_FACT.names))
    assert retention.archive_run(store, NOW + timedelta(hours=2))
    same(retention.archived_once(store), more.select(*STORED_FACT.names))
    assert ids(store.current()) == ["t11", "t12", "t50"]


@pytest.mark.parametrize("elsewhere", [False, True])
def test_a_run_with_a_byte_budget(spark, tmp_path, elsewhere):
    live = hourly(spark, 0, 13)
    size = live.where("transaction_id = 't12'").select(retention.row_bytes()).first()[0]
    store = HotStore(spark, str(tmp_path), live if elsewhere else None)
    if not elsewhere:
        store.ingest(live)
    assert retention.archive_run(store, NOW, budget=2 * size + 1)
    assert ids(store.current()) == ["t11", "t12"]
    same(retention.archived_once(store), live.select(*STORED_FACT.names))
    assert not retention.archive_run(store, NOW)
