import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import as_dicts

from slotcast.functions.prefix import units_before
from slotcast.operators import inventory

EVENTS = "store_id string, item_id string, id bigint, at timestamp_ntz, quantity int"
ITEMS = "item_id string, cook_time int, hold_time double"
STORES = "store_id string, hours string"
OPENING = "store_id string, item_id string, day date, quantity int"


def at(minute, day=1):
    return str(datetime(2024, 1, day) + timedelta(minutes=minute))


def simulate(requests, orders, opening, cook, hold, hours, day):
    """A store's day, one request at a time. Returns sold, wasted, missed units and what is left."""
    shelf = [[opening, hold * 60]] if opening else []
    cooking = []
    ticks, sold_all, wasted_all, missed_all = {}, 0, 0, 0
    for minute in range(0, 1440, 15):
        if hours == "5am-11pm" and not 5 <= minute // 60 < 23:
            continue
        for batch in [b for b in cooking if b[1] <= minute]:
            cooking.remove(batch)
            shelf.append([batch[0], batch[2]])
        for when, _, quantity in orders:
            if minute <= when < minute + 15:
                cooking.append((quantity, minute + cook, minute + cook + hold * 60))
        # Orders of one tick are one batch in the operator; the units are the same.
        sold = missed = 0
        for when, _, quantity in sorted(requests):
            if not minute <= when < minute + 15:
                continue
            got = 0
            while quantity > got and shelf:
                take = min(quantity - got, shelf[0][0])
                shelf[0][0] -= take
                got += take
                if not shelf[0][0]:
                    shelf.pop(0)
            sold += got
            if not got:
                missed += quantity
        wasted = sum(q for q, expires in shelf if expires <= minute)
        shelf = [b for b in shelf if b[1] > minute]
        sold_all, wasted_all, missed_all = sold_all + sold, wasted_all + wasted, missed_all + missed
        ticks[at(minute, day)] = (sold, wasted, missed)
    left = sum(q for q, _ in shelf) + sum(b[0] for b in cooking)
    return ticks, (sold_all, wasted_all, missed_all, left)


def test_first_in_first_out_edges(make):
    demand = make(
        [("s", "a", 1, at(0), 3), ("s", "a", 2, at(1), 1), ("s", "b", 3, at(60), 1)], EVENTS
    )
    cook = make([], EVENTS)
    items = make([("a", 5, 2.0), ("b", 5, 1.0)], ITEMS)
    stores = make([("s", "24/7")], STORES)
    # Two on hand: a request for 3 sells 2 and misses nothing, the next one misses 1.
    # Two of b expire at 60: one is sold in that tick, then the other is wasted.
    opening = make([("s", "a", "2024-01-01", 2), ("s", "b", "2024-01-01", 2)], OPENING)
    rows = as_dicts(inventory.inventory_replay(demand, cook, items, stores, opening), "item_id", "tick")
    active = [
        (r["item_id"], str(r["tick"])[11:16], r["sold"], r["wasted"], r["stockouts"])
        for r in rows
        if r["sold"] or r["wasted"] or r["stockouts"]
    ]
    assert active == [("a", "00:00", 2, 0, 1), ("b", "01:00", 1, 1, 0)]


@pytest.mark.parametrize("seed", range(3))
def test_replay_against_single_requests(make, seed):
    draw = random.Random(seed)
    items = {"a": (10, 1.5), "b": (15, 2.0), "c": (5, 4.0)}
    hours = {"s": "24/7", "t": "5am-11pm"}
    demand, cook, opening, expected = [], [], [], {}
    for store in hours:
        for item, (cook_time, hold) in items.items():
            for day in (1, 2):
                # One item takes most of the demand.
                n = 150 if (store, item) == ("s", "a") else 25
                minutes = [draw.uniform(0, 1439) for _ in range(n)]
                requests = [(m, draw.randrange(10**9), draw.choice((1, 1, 2, 3))) for m in minutes]
                orders = [(15 * draw.randrange(96), 0, draw.randrange(1, 9)) for _ in range(12)]
                orders = list({o[0]: o for o in orders}.values())
                start = draw.choice((0, 4)) if hours[store] == "24/7" else 0
                demand += [(store, item, i, at(m, day), q) for m, i, q in requests]
                cook += [(store, item, 0, at(m, day), q) for m, _, q in orders]
                if start:
                    opening.append((store, item, f"2024-01-{day:02d}", start))
                expected[store, item, day] = simulate(
                    requests, orders, start, cook_time, hold, hours[store], day
                ), start + sum(q for m, _, q in orders if hours[store] == "24/7" or 300 <= m < 1380)
    replay = inventory.inventory_replay(
        make(demand, EVENTS),
        make(cook, EVENTS),
        make([(i, *v) for i, v in items.items()], ITEMS),
        make(list(hours.items()), STORES),
        make(opening, OPENING),
    )
    rows = as_dicts(replay, "store_id", "item_id", "tick")
    for (store, item, day), ((ticks, totals), made) in expected.items():
        own = [r for r in rows if (r["store_id"], r["item_id"], r["day"].day) == (store, item, day)]
        seen = {str(r["tick"]): (r["sold"], r["wasted"], r["stockouts"]) for r in own}
        assert {t: v for t, v in seen.items() if any(v)} == {t: v for t, v in ticks.items() if any(v)}
        sold, wasted, _, left = totals
        assert made == sold + wasted + left
        if own:
            assert own[-1]["left_over"] + own[-1]["in_progress"] == left


def allocate(supply, demand):
    """FIFO, unit by unit."""
    units = Counter()
    for key in {r[:2] for r in supply}:
        ours = [[r[2], r[4]] for r in sorted((r for r in supply if r[:2] == key), key=lambda r: (r[3], r[2]))]
        for r in sorted((r for r in demand if r[:2] == key), key=lambda r: (r[3], r[2])):
            wanted = r[4]
            while wanted and ours:
                take = min(wanted, ours[0][1])
                if take:
                    units[(*key, ours[0][0], r[2])] += take
                wanted -= take
                ours[0][1] -= take
                if not ours[0][1]:
                    ours.pop(0)
    return dict(units)


@pytest.mark.parametrize("width", [1, 7, 1024])
def test_fifo_allocation(make, width):
    draw = random.Random(width)

    def side(n, largest):
        # A third and more of the rows belong to one store and item.
        return [
            (*draw.choice([("s", "a")] * 2 + [("s", "b"), ("t", "a")]), i, at(draw.randrange(0, 3000)), draw.randrange(0, largest))
            for i in range(n)
        ]

    supply, demand = side(60, 40), side(150, 9)
    made = inventory.fifo_allocate(make(supply, EVENTS), make(demand, EVENTS), width)
    assert {tuple(r)[:4]: r.units for r in made.collect()} == allocate(supply, demand)


def test_running_totals_over_buckets(make):
    draw = random.Random(5)
    rows = [("k" if i % 3 else "l", i // 40, i // 10, i, draw.randrange(5)) for i in range(200)]
    df = make(rows, "key string, coarse int, fine int, at int, units int")
    made = units_before(df, ["key"], ["at"], "units", ["coarse", "fine"], "before").collect()
    for r in made:
        assert r.before == sum(x[4] for x in rows if x[0] == r.key and x[3] < r.at)
    assert len(made) == 200
