"""Marts that are refreshed from changed days equal those built anew."""

from datetime import date

import pytest

from slotcast.operators import profiles, staging
from slotcast.plans import refresh
from slotcast.sources import events

LOG = "kind string, store_id string, item_id string, quantity int, price double, created_at timestamp_ntz"


def sale(day, store="s", item="a", quantity=1, at="10:05"):
    return ("sales", store, item, quantity, 1.0, None if day is None else f"2024-01-{day:02d} {at}:00")


def rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def same(spark, log, state):
    """Compare the refreshed marts with those of the whole log."""
    sales = staging.stage_sales(events.read_events(spark, log, "sales"))
    assert rows(refresh.refreshed_profile(spark, state)) == rows(profiles.time_of_day_profile(sales))
    slots = profiles.shared_slot_sales(sales)
    want = rows(profiles.store_traffic_ratio(slots))
    assert rows(refresh.refreshed_traffic_ratio(spark, state)) == want


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "log"), str(tmp_path / "state")


def test_only_changed_days_are_read(spark, make, paths):
    log, state = paths
    flushes = [
        [sale(d, s, i, d) for d in range(1, 9) for s in "st" for i in "ab"],
        [sale(9), sale(3, "s", "a", 5, "11:20"), sale(3, "u", "c", 2)],  # late events, a new store and item
        [sale(9, at="10:06"), sale(None)],
        [sale(10, "t", "b", 7)],
    ]
    for epoch, (flush, n) in enumerate(zip(flushes, (8, 2, 1, 1))):
        events.append_events(make(flush, LOG), epoch, log)
        assert refresh.refresh_profiles(spark, log, state) == n
        assert refresh.refresh_profiles(spark, log, state) == 0
        same(spark, log, state)


def test_a_refresh_that_failed_is_run_again(spark, make, paths, monkeypatch):
    log, state = paths
    events.append_events(make([sale(1), sale(2)], LOG), 0, log)
    refresh.refresh_profiles(spark, log, state)
    events.append_events(make([sale(2, quantity=9), sale(3)], LOG), 1, log)

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(refresh, "read_state", fail)  # after the days were written
        with pytest.raises(RuntimeError):
            refresh.refresh_profiles(spark, log, state)
    assert refresh.refresh_profiles(spark, log, state) == 2
    same(spark, log, state)


def test_compaction_between_refreshes(spark, make, paths):
    log, state = paths
    events.append_events(make([sale(1), sale(2)], LOG), 0, log)
    refresh.refresh_profiles(spark, log, state)
    events.append_events(make([sale(2, quantity=4)], LOG), 1, log)
    events.compact_events(spark, log, date(2024, 1, 3))
    assert refresh.refresh_profiles(spark, log, state) == 1  # the flush, not the compaction
    same(spark, log, state)
    events.append_events(make([sale(5)], LOG), 2, log)
    events.compact_events(spark, log, date(2024, 1, 6))
    events.remove_replaced(spark, log)  # the flush is known only from the snapshot now
    assert refresh.refresh_profiles(spark, log, state) == 3
    same(spark, log, state)
    assert refresh.refresh_profiles(spark, log, state) == 0


def test_an_empty_log(spark, make, paths):
    log, state = paths
    assert refresh.refresh_profiles(spark, log, state) == 0
    assert rows(refresh.refreshed_profile(spark, state)) == []
    events.append_events(make([sale(4)], LOG), 0, log)
    assert refresh.refresh_profiles(spark, log, state) == 1
    same(spark, log, state)
