import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from slotcast.functions import scoring as fx
from slotcast.operators import scoring
from slotcast.sources import results

COLUMNS = (
    "date date, arm string, units_sold bigint, stockouts bigint, units_wasted bigint, "
    "waste_cost double, sales_revenue double"
)

# Recorded results of 16 days, and the totals recorded with them.
RECORDED = [
    ("2026-08-07", "ml", 48495, 1371, 8822, 11925.60, 149640.77),
    ("2026-08-07", "baseline", 47590, 2133, 9106, 11959.45, 147298.46),
    ("2026-08-08", "ml", 27203, 1076, 6411, 8294.35, 83586.73),
    ("2026-08-08", "baseline", 27087, 1175, 8799, 11816.05, 83854.50),
    ("2026-08-09", "ml", 25361, 1046, 6091, 8476.95, 84616.24),
    ("2026-08-09", "baseline", 24868, 1459, 9588, 11736.10, 82848.85),
    ("2026-08-10", "ml", 36625, 925, 8259, 10593.95, 133109.19),
    ("2026-08-10", "baseline", 35965, 1444, 9205, 10422.65, 129831.30),
    ("2026-08-11", "ml", 37316, 1284, 7263, 9748.00, 119845.48),
    ("2026-08-11", "baseline", 35693, 2702, 11570, 14639.95, 115241.64),
    ("2026-08-12", "ml", 40257, 1130, 6518, 8835.05, 132869.69),
    ("2026-08-12", "baseline", 39644, 1645, 6980, 8586.10, 130493.05),
    ("2026-08-13", "ml", 48743, 1134, 7433, 10139.40, 150061.71),
    ("2026-08-13", "baseline", 48011, 1758, 7951, 10754.80, 148382.93),
    ("2026-08-14", "ml", 36770, 976, 7407, 9901.15, 117131.03),
    ("2026-08-14", "baseline", 36803, 993, 11695, 15397.50, 117214.98),
    ("2026-08-15", "ml", 26827, 980, 6284, 8305.80, 86513.77),
    ("2026-08-15", "baseline", 26621, 1165, 9697, 12430.30, 85834.99),
    ("2026-08-16", "ml", 26105, 1021, 5622, 7894.15, 87423.81),
    ("2026-08-16", "baseline", 25522, 1512, 9490, 11624.25, 85372.14),
    ("2026-08-17", "ml", 33971, 1091, 6970, 9462.45, 113526.15),
    ("2026-08-17", "baseline", 33525, 1463, 8116, 10718.20, 111904.47),
    ("2026-08-18", "ml", 31206, 1096, 6090, 8324.85, 99508.57),
    ("2026-08-18", "baseline", 31070, 1215, 11227, 14747.20, 99462.13),
    ("2026-08-19", "ml", 37861, 1247, 6985, 9238.65, 120068.91),
    ("2026-08-19", "baseline", 37328, 1682, 8469, 11012.85, 118605.14),
    ("2026-08-20", "ml", 44385, 1050, 8022, 10413.50, 142630.54),
    ("2026-08-20", "baseline", 43710, 1648, 10256, 13070.55, 140637.21),
    ("2026-08-21", "ml", 41030, 1112, 7574, 9884.50, 128665.62),
    ("2026-08-21", "baseline", 40631, 1459, 10538, 13538.05, 128027.50),
    ("2026-08-22", "ml", 29715, 919, 6333, 8383.95, 97088.06),
    ("2026-08-22", "baseline", 29411, 1157, 7638, 9600.20, 95734.78),
]
RECORDED_TOTALS = {
    "days_run": 16,
    "ml_avg_waste_pct": 8.28,
    "baseline_avg_waste_pct": 10.98,
    "ml_avg_service_level": 96.95,
    "base_avg_service_level": 95.75,
}


def test_recorded_totals(make):
    assert as_dicts(scoring.cumulative(make(RECORDED, COLUMNS)))[0] == RECORDED_TOTALS


def test_document_round_trip(spark, make, tmp_path):
    daily = make(RECORDED, COLUMNS)
    document = scoring.nest_results(daily).agg(
        F.collect_list(F.struct("date", "ml", "baseline")).alias("daily")
    )
    results.write_results_json(document, str(tmp_path / "out"))
    back = scoring.flatten_results(results.read_results_json(spark, str(tmp_path / "out")))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, daily.collect()))


def test_pretty_printed_document(spark, tmp_path):
    arm = '{"units_sold": 9, "stockouts": 1, "units_wasted": 2, "waste_cost": 1.5, "sales_revenue": 30.0}'
    (tmp_path / "r.json").write_text(
        '{\n  "cumulative": {"days_run": 1},\n  "daily": [\n'
        f'    {{"date": "2026-08-07",\n     "ml": {arm},\n     "baseline": {arm}}}\n  ]\n}}\n'
    )
    flat = scoring.flatten_results(results.read_results_json(spark, str(tmp_path / "r.json")))
    assert [(str(r.date), r.arm, r.units_sold) for r in flat.collect()] == [
        ("2026-08-07", "ml", 9), ("2026-08-07", "baseline", 9),
    ]


def test_ratios_without_denominator(make):
    df = make([(0, 0, 5.0, 0.0), (3, 1, 1.0, 4.0)], "sold bigint, out bigint, cost double, revenue double")
    rows = df.select(fx.service_level("sold", "out"), fx.waste_pct("cost", "revenue")).collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0), (75.0, 25.0)]


def test_weather_buckets_and_factors(make):
    days = make(
        [(55.0, False, "chicken"), (70.0, False, "side"), (70.1, False, "chicken"), (54.9, False, "side"),
         (90.0, True, "roller_grill"), (30.0, True, "roller_grill"), (90.0, False, "appetizer")],
        "temp_f double, precip boolean, category string",
    )
    rows = days.select(
        fx.classify_weather("temp_f", "precip"),
        fx.weather_multiplier("temp_f", "precip"),
        fx.weather_multiplier("temp_f", "precip", "category"),
    ).collect()
    assert [r[0] for r in rows] == [
        "neutral", "neutral", "extreme_heat", "extreme_cold", "precip", "precip", "extreme_heat",
    ]
    assert [r[1] for r in rows] == [1.0, 1.0, 1.0, 1.0, 0.7, 0.7, 1.0]
    assert [r[2] for r in rows] == pytest.approx([1.0, 1.0, 2.2, 1.9, 1.54, 0.28, 1.0])


def test_weather_impact_omits_empty_buckets(make):
    days = make(
        [("2024-01-01", "s", "ml", 9, 1, 0, 1.0, 10.0), ("2024-01-01", "s", "baseline", 8, 2, 0, 2.0, 10.0),
         ("2024-01-02", "s", "ml", 1, 0, 0, 0.0, 0.0), ("2024-01-02", "s", "baseline", 0, 0, 0, 0.0, 0.0)],
        "date date, store_id string, " + COLUMNS.removeprefix("date date, "),
    )
    stores = make([("s", "north")], "store_id string, region string")
    weather = make(
        [("north", "2024-01-01", 80.0, False), ("north", "2024-01-02", 80.0, True)],
        "region string, sale_date date, temp_f double, precip boolean",
    )
    rows = {r["bucket"]: r for r in as_dicts(scoring.weather_impact(days, stores, weather))}
    assert set(rows) == {"extreme_heat", "precip"}
    assert rows["extreme_heat"]["service_level_gap_pp"] == 10.0
    assert (rows["precip"]["ml_service_level"], rows["precip"]["baseline_service_level"]) == (100.0, 0.0)
    assert rows["precip"]["ml_waste_pct"] == 0.0


def test_stable_seed(make):
    import hashlib

    texts = ["", "2026-09-01|store_012", "ünï"]
    seeds = [r[0] for r in make([(t,) for t in texts], "t string").select(fx.stable_seed("t")).collect()]
    assert seeds == [int(hashlib.sha256(t.encode()).hexdigest(), 16) % 2**32 for t in texts]
