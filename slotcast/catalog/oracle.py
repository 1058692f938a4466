"""The registered queries as SQL, on the same tables, for a second engine to run."""

from __future__ import annotations

from slotcast.constants import AVAILABLE_HOURS, RUSH_CURVE

_KIND = """CASE WHEN event_type IN ('purchase', 'click', 'view') THEN 'sales'
       WHEN event_type = 'signup' THEN 'waste' WHEN event_type = 'error' THEN 'stockouts' END"""

_HOURS = ", ".join(f"('{name}', {start}, {end})" for name, (start, end) in AVAILABLE_HOURS.items())
_CURVE = ", ".join(f"({hour}, {value})" for hour, value in enumerate(RUSH_CURVE))
_SLOT = (
    "CAST((isodow(created_at) - 1) * 96 + hour(created_at) * 4 + minute(created_at) // 15 AS INTEGER)"
)

# Common tables; each may use the ones above it.
_TABLES = {
    "log": f"""
        SELECT {_KIND} AS kind, event_id AS id, CAST(user_id % 12 AS INTEGER) AS store_id,
               CAST(event_id % 10 AS INTEGER) AS item_id,
               CAST(1 + event_id % 3 AS INTEGER) AS quantity, value AS price, ts AS created_at,
               CASE WHEN (user_id // 12) % 2 = 0 THEN 'ml' ELSE 'baseline' END AS arm
        FROM events""",
    "sales": f"""
        SELECT store_id, item_id, quantity, price, created_at, id,
               CAST(created_at AS DATE) AS sale_date,
               CAST(hour(created_at) AS INTEGER) AS sale_hour,
               CAST(isodow(created_at) - 1 AS INTEGER) AS day_of_week,
               time_bucket(INTERVAL 15 MINUTE, created_at) AS sale_15min,
               CAST(minute(created_at) // 15 * 15 AS INTEGER) AS sale_minute,
               {_SLOT} AS slot_index
        FROM log WHERE kind = 'sales'""",
    "waste": """
        SELECT store_id, item_id, quantity, created_at, id, CAST(created_at AS DATE) AS waste_date,
               CAST(hour(created_at) AS INTEGER) AS waste_hour,
               CAST(isodow(created_at) - 1 AS INTEGER) AS day_of_week
        FROM log WHERE kind = 'waste'""",
    "stockouts": """
        SELECT store_id, item_id, quantity AS quantity_requested, created_at,
               CAST(created_at AS DATE) AS stockout_date,
               CAST(hour(created_at) AS INTEGER) AS stockout_hour,
               CAST(isodow(created_at) - 1 AS INTEGER) AS day_of_week
        FROM log WHERE kind = 'stockouts'""",
    "menu": """
        SELECT CAST(i AS INTEGER) AS item_id, 2.0::DOUBLE + i AS price,
               CASE WHEN i % 5 <> 4 THEN 1.0::DOUBLE + i END AS sale_price,
               [i % 7, (i + 3) % 7] AS sale_days, 0.5::DOUBLE + 0.25::DOUBLE * i AS cost,
               (['breakfast', 'lunch', 'all_day', 'chicken'])[1 + i % 4] AS time_of_day,
               (['sandwich', 'side', 'roller_grill', 'chicken', 'appetizer'])[1 + i % 5] AS category,
               1.5::DOUBLE + 0.5::DOUBLE * (i % 6) AS hold_time, 5 * (1 + i % 3) AS cook_time,
               i <> 8 AS active,
               CASE WHEN i = 7 THEN DATE '2024-02-15' ELSE DATE '2023-12-01' END AS added
        FROM range(10) AS r(i)""",
    "stores": """
        SELECT CAST(s AS INTEGER) AS store_id, CAST(s % 4 AS INTEGER) AS region,
               CASE WHEN s % 2 = 0 THEN '24/7' ELSE '5am-11pm' END AS hours
        FROM range(12) AS r(s)""",
    "weather": """
        SELECT CAST(g.r AS INTEGER) AS region, d.sale_date,
               10.0::DOUBLE + (day(d.sale_date) * 37 + g.r * 23) % 91 AS temp_f,
               (day(d.sale_date) + g.r) % 3 = 0 AS precip
        FROM range(4) AS g(r),
             (SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY))
                          AS DATE) AS sale_date FROM events) AS d""",
    "chain": "SELECT CAST(s_suppkey AS INTEGER) AS store_id FROM supplier",
    "hours_of": f"SELECT * FROM (VALUES {_HOURS}) AS h(time_of_day, first_hour, end_hour)",
    "slots": """
        SELECT store_id, item_id, sale_date, sale_hour, slot_index, day_of_week,
               CAST(sum(quantity) AS BIGINT) AS slot_quantity
        FROM sales GROUP BY ALL""",
    "dow_dates": """
        SELECT store_id, day_of_week, count(DISTINCT sale_date) AS total_dates
        FROM sales GROUP BY ALL""",
    "item_days": """
        SELECT store_id, item_id, count(DISTINCT sale_date) AS days_observed
        FROM sales GROUP BY ALL""",
    "profile": """
        SELECT f.store_id, f.item_id, f.day_of_week, f.sale_hour, f.slot_index,
               sum(f.slot_quantity) / t.total_dates::DOUBLE AS avg_slot_quantity,
               count(*) AS sample_size, d.days_observed
        FROM slots AS f JOIN dow_dates AS t USING (store_id, day_of_week)
        JOIN item_days AS d USING (store_id, item_id)
        GROUP BY f.store_id, f.item_id, f.day_of_week, f.sale_hour, f.slot_index,
                 t.total_dates, d.days_observed""",
    "traffic": """
        SELECT store_id, avg_daily_units,
               avg_daily_units / avg(avg_daily_units) OVER () AS traffic_ratio
        FROM (SELECT store_id, sum(quantity) / count(DISTINCT sale_date)::DOUBLE AS avg_daily_units
              FROM sales GROUP BY store_id)""",
    "clock": "SELECT max(created_at) AS now FROM sales",
    "clocks": "SELECT store_id, max(created_at) AS now FROM sales GROUP BY store_id",
    "missed": """
        SELECT e.store_id, e.item_id, CAST(sum(quantity_requested) AS BIGINT) AS missed_units
        FROM stockouts AS e JOIN clocks AS c USING (store_id)
        WHERE e.created_at >= date_trunc('day', c.now) GROUP BY ALL""",
    "sold_today": """
        SELECT e.store_id, e.item_id, CAST(sum(quantity) AS BIGINT) AS sale_quantity,
               sum(quantity * price) AS sale_revenue
        FROM sales AS e JOIN clocks AS c USING (store_id)
        WHERE e.created_at >= date_trunc('day', c.now) GROUP BY ALL""",
    "wasted_today": """
        SELECT e.store_id, e.item_id, CAST(sum(quantity) AS BIGINT) AS waste_quantity
        FROM waste AS e JOIN clocks AS c USING (store_id)
        WHERE e.created_at >= date_trunc('day', c.now) GROUP BY ALL""",
    "waste_today": """
        SELECT store_id, item_id, coalesce(sale_quantity, 0) AS sale_quantity,
               coalesce(sale_revenue, 0) AS sale_revenue,
               coalesce(waste_quantity, 0) AS waste_quantity, m.category, m.cost,
               coalesce(waste_quantity, 0) * m.cost AS waste_cost
        FROM sold_today FULL JOIN wasted_today USING (store_id, item_id)
        LEFT JOIN menu AS m USING (item_id)""",
    "ahead": """
        SELECT p.store_id, p.item_id, sum(p.avg_slot_quantity) AS predicted_units
        FROM profile AS p JOIN menu AS m USING (item_id)
        JOIN (SELECT store_id, (isodow(now) - 1) * 96 + hour(now) * 4 + minute(now) // 15 AS at
              FROM clocks) AS c USING (store_id)
        JOIN range(100) AS o(i) ON p.slot_index = (c.at + o.i) % 672
        WHERE o.i < CAST(floor(m.hold_time * 4) AS INTEGER) GROUP BY p.store_id, p.item_id""",
    "queue": """
        SELECT a.store_id, a.item_id,
               CAST(round_even(round(a.predicted_units, 9), 0) AS INTEGER) AS predicted_units,
               coalesce(x.missed_units, 0) AS missed_units, m.category,
               CASE WHEN m.category IN ('sandwich', 'roller_grill', 'side') THEN 'Kitchen'
                    WHEN m.category IN ('chicken', 'appetizer') THEN 'Chicken' END AS queue
        FROM ahead AS a LEFT JOIN missed AS x USING (store_id, item_id)
        LEFT JOIN menu AS m USING (item_id)""",
    "done": """
        SELECT DISTINCT w.store_id, w.item_id FROM waste AS w, clock
        WHERE w.created_at >= date_trunc('day', now)""",
    "grid": """
        SELECT s.store_id, m.item_id, m.category, CAST(g.i AS INTEGER) AS slot_index
        FROM stores AS s, menu AS m JOIN hours_of AS h USING (time_of_day), range(672) AS g(i), clock
        WHERE m.active AND m.added <= CAST(now AS DATE)
          AND (g.i % 96) // 4 >= h.first_hour AND (g.i % 96) // 4 < h.end_hour""",
    # Sales in which item 9 is new on 19 January.
    "l_sales": """
        SELECT * REPLACE (CASE WHEN item_id = 9 AND sale_date < DATE '2024-01-19' THEN 4
                               ELSE item_id END AS item_id) FROM sales""",
    "l_slots": """
        SELECT store_id, item_id, sale_date, sale_hour, slot_index, day_of_week,
               sum(quantity) AS slot_quantity FROM l_sales GROUP BY ALL""",
    "l_days": """
        SELECT store_id, item_id, count(DISTINCT sale_date) AS days_observed
        FROM l_sales GROUP BY ALL""",
    "l_profile": """
        SELECT f.store_id, f.item_id, f.day_of_week, f.sale_hour, f.slot_index,
               sum(f.slot_quantity) / t.total_dates::DOUBLE AS avg_slot_quantity,
               count(*) AS sample_size, d.days_observed
        FROM l_slots AS f JOIN dow_dates AS t USING (store_id, day_of_week)
        JOIN l_days AS d USING (store_id, item_id)
        GROUP BY f.store_id, f.item_id, f.day_of_week, f.sale_hour, f.slot_index,
                 t.total_dates, d.days_observed""",
    "l_cold": """
        SELECT m.category, p.slot_index, avg(p.avg_slot_quantity) AS category_avg
        FROM l_profile AS p JOIN menu AS m USING (item_id) GROUP BY ALL""",
    "completed": """
        SELECT g.store_id, g.item_id, g.category, g.slot_index,
               CAST(g.slot_index // 96 AS INTEGER) AS day_of_week,
               CAST(g.slot_index % 96 // 4 AS INTEGER) AS sale_hour,
               CAST(g.slot_index % 4 * 15 AS INTEGER) AS sale_minute,
               coalesce(p.avg_slot_quantity, 0) AS avg_slot_quantity,
               coalesce(p.sample_size, 0) AS sample_size,
               coalesce(max(p.days_observed) OVER (PARTITION BY g.store_id, g.item_id), 0)
                 AS days_observed
        FROM grid AS g LEFT JOIN l_profile AS p USING (store_id, item_id, slot_index)""",
    "routed": """
        SELECT *, CASE WHEN days_observed >= 14 AND sample_size > 0 THEN 'warm'
                       WHEN days_observed >= 14 THEN 'zero' ELSE 'cold' END AS route
        FROM completed""",
    "plan": """
        SELECT r.store_id, r.item_id, r.slot_index,
               CASE route WHEN 'warm' THEN r.avg_slot_quantity WHEN 'zero' THEN 0
                    ELSE coalesce(c.category_avg, 0) * t.traffic_ratio END AS predicted_units
        FROM routed AS r LEFT JOIN l_cold AS c USING (category, slot_index)
        LEFT JOIN traffic AS t USING (store_id)""",
    "features": """
        SELECT p.store_id, p.item_id, sd.sale_date, p.sale_hour,
               CAST(p.slot_index % 4 * 15 AS INTEGER) AS sale_minute, p.slot_index, p.day_of_week,
               coalesce(a.slot_quantity, 0) AS slot_quantity, p.avg_slot_quantity, p.sample_size,
               w.temp_f, w.precip
        FROM profile AS p
        JOIN (SELECT DISTINCT store_id, sale_date, day_of_week FROM sales) AS sd
          USING (store_id, day_of_week)
        JOIN stores AS st USING (store_id)
        LEFT JOIN slots AS a ON a.store_id = p.store_id AND a.item_id = p.item_id
          AND a.sale_date = sd.sale_date AND a.slot_index = p.slot_index
        LEFT JOIN weather AS w ON w.region = st.region AND w.sale_date = sd.sale_date""",
    "split": """
        SELECT *, CASE WHEN row_number() OVER (ORDER BY sale_date, store_id, item_id, slot_index)
                            <= floor(count(*) OVER () * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part
        FROM features""",
    "hold_out": "SELECT * FROM split WHERE part = 'test'",
    "store_days": """
        SELECT CAST(l.created_at AS DATE) AS date, l.store_id, l.arm,
               CAST(sum(CASE WHEN kind = 'sales' THEN quantity ELSE 0 END) AS BIGINT) AS units_sold,
               CAST(sum(CASE WHEN kind = 'stockouts' THEN quantity ELSE 0 END) AS BIGINT) AS stockouts,
               CAST(sum(CASE WHEN kind = 'waste' THEN quantity ELSE 0 END) AS BIGINT) AS units_wasted,
               sum(CASE WHEN kind = 'waste' THEN quantity * m.cost ELSE 0 END) AS waste_cost,
               sum(CASE WHEN kind = 'sales' THEN quantity * m.price ELSE 0 END) AS sales_revenue
        FROM log AS l JOIN menu AS m USING (item_id) GROUP BY ALL""",
    "day_totals": """
        SELECT date, arm, CAST(sum(units_sold) AS BIGINT) AS units_sold,
               CAST(sum(stockouts) AS BIGINT) AS stockouts,
               CAST(sum(units_wasted) AS BIGINT) AS units_wasted, sum(waste_cost) AS waste_cost,
               sum(sales_revenue) AS sales_revenue
        FROM store_days GROUP BY ALL""",
    "bucketed": """
        SELECT st.region, d.sale_date, w.temp_f, w.precip,
               CASE WHEN w.precip THEN 'precip' WHEN w.temp_f > 70 THEN 'extreme_heat'
                    WHEN w.temp_f < 55 THEN 'extreme_cold' ELSE 'neutral' END AS bucket, d.store_id
        FROM (SELECT DISTINCT store_id, sale_date FROM sales) AS d JOIN stores AS st USING (store_id)
        JOIN weather AS w ON w.region = st.region AND w.sale_date = d.sale_date""",
    "supply": "SELECT store_id, item_id, id, created_at, quantity * 2 AS quantity FROM waste",
    "waste_percent": """
        SELECT store_id, item_id, m.category,
        round(w.units * m.cost, 6) AS waste_cost, round(s.units * m.price, 6) AS sale_revenue,
        waste_date, CAST(s.units AS BIGINT) AS sale_quantity,
        round(w.units * m.cost / nullif(s.units * m.price, 0) * 100, 6) AS waste_percentage
        FROM (SELECT store_id, item_id, waste_date, sum(quantity) AS units FROM waste GROUP BY ALL) AS w
        JOIN (SELECT store_id, item_id, sale_date AS waste_date, sum(quantity) AS units
              FROM sales GROUP BY ALL) AS s USING (store_id, item_id, waste_date)
        JOIN menu AS m USING (item_id)""",
    "curve": f"SELECT * FROM (VALUES {_CURVE}) AS c(hour, level)",
}

_METRICS = """units_sold, stockouts, units_wasted, round(waste_cost, 6) AS waste_cost,
              round(sales_revenue, 6) AS sales_revenue"""
_DAY_TOTALS = f"SELECT date, arm, {_METRICS} FROM day_totals"
_FEATURES = """store_id, item_id, sale_date, sale_hour, sale_minute, slot_index, day_of_week,
               slot_quantity, round(avg_slot_quantity, 6) AS avg_slot_quantity, sample_size, temp_f"""
_PROFILE = """store_id, item_id, day_of_week, sale_hour, slot_index,
              round(avg_slot_quantity, 6) AS avg_slot_quantity, sample_size"""
_PLAN_ROW = "store_id, item_id, slot_index, round(predicted_units, 6) AS predicted_units"


def _impact(arm: str) -> dict[str, str]:
    def total(metric: str) -> str:
        return f"sum({metric}) FILTER (arm = '{arm}')"

    sold, missed = total("units_sold"), total("stockouts")
    cost, revenue = total("waste_cost"), total("sales_revenue")
    return {
        "service": f"coalesce(100.0 * {sold} / nullif({sold} + {missed}, 0), 0)",
        "waste": f"coalesce(100.0 * {cost} / nullif({revenue}, 0), 0)",
    }


_ML, _BASE = _impact("ml"), _impact("baseline")

_CUMULATIVE = """SELECT count(DISTINCT date) AS days_run,
    round_even(avg(100.0 * waste_cost / sales_revenue) FILTER (arm = 'ml'), 2) AS ml_avg_waste_pct,
    round_even(avg(100.0 * waste_cost / sales_revenue) FILTER (arm = 'baseline'), 2)
      AS baseline_avg_waste_pct,
    round_even(avg(100.0 * units_sold / (units_sold + stockouts)) FILTER (arm = 'ml'), 2)
      AS ml_avg_service_level,
    round_even(avg(100.0 * units_sold / (units_sold + stockouts)) FILTER (arm = 'baseline'), 2)
      AS base_avg_service_level
    FROM day_totals"""

_BODIES = {
    "stage_sales": """SELECT store_id, item_id, quantity, round(price, 6) AS price, created_at,
        sale_date, sale_hour, day_of_week, sale_15min, sale_minute FROM sales""",
    "stage_waste": "SELECT * EXCLUDE (id) FROM waste",
    "stage_stockouts": "SELECT * FROM stockouts",
    "slot_sales": "SELECT * FROM slots",
    "store_dow_dates": "SELECT * FROM dow_dates",
    "item_days_observed": "SELECT * FROM item_days",
    "time_of_day_profile": f"SELECT {_PROFILE}, days_observed FROM profile",
    "cold_start_profile": """SELECT m.category, p.day_of_week, p.sale_hour, p.slot_index,
        round(avg(p.avg_slot_quantity), 6) AS avg_slot_quantity
        FROM profile AS p JOIN menu AS m USING (item_id) GROUP BY ALL""",
    "store_traffic_ratio": """SELECT store_id, round(avg_daily_units, 6) AS avg_daily_units,
        round(traffic_ratio, 6) AS traffic_ratio FROM traffic""",
    "stockout_summary": """SELECT store_id, item_id, stockout_date, stockout_hour, day_of_week,
        CAST(sum(quantity_requested) AS BIGINT) AS total_missed_units, count(*) AS event_count
        FROM stockouts GROUP BY ALL""",
    "daily_item_sales": """SELECT store_id, item_id, sale_date,
        CAST(sum(quantity) AS BIGINT) AS sale_quantity FROM sales GROUP BY ALL""",
    "daily_item_waste": """SELECT store_id, item_id, waste_date,
        CAST(sum(quantity) AS BIGINT) AS waste_quantity FROM waste GROUP BY ALL""",
    "waste_percentage": "SELECT * FROM waste_percent",
    "store_dates": "SELECT DISTINCT store_id, sale_date, day_of_week FROM sales",
    "latest_slot_per_item": """SELECT r.store_id, r.item_id, r.sale_date, r.sale_hour, r.slot_index,
        r.day_of_week, r.slot_quantity, round(p.avg_slot_quantity, 6) AS avg_slot_quantity,
        p.sample_size
        FROM slots AS r LEFT JOIN profile AS p
          USING (store_id, item_id, day_of_week, sale_hour, slot_index)
        QUALIFY row_number() OVER (PARTITION BY r.store_id, r.item_id
          ORDER BY r.sale_date DESC, r.sale_hour DESC, r.slot_index DESC) = 1""",
    "rolling_slot_demand": """SELECT store_id, item_id, sale_date, slot_index, slot_quantity,
        CAST(sum(slot_quantity) OVER (w RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) AS BIGINT) AS units_last_4,
        CAST(sum(slot_quantity) OVER (w RANGE BETWEEN 7 PRECEDING AND CURRENT ROW) AS BIGINT) AS units_last_8
        FROM (SELECT *, (sale_date - DATE '1970-01-01') * 96 + slot_index % 96 AS running FROM slots)
        WINDOW w AS (PARTITION BY store_id, item_id ORDER BY running)""",
    "sim_now": "SELECT * FROM clock",
    "store_clocks": "SELECT * FROM clocks",
    "committed_clocks": "SELECT * FROM clocks",
    "missed_units_today": "SELECT * FROM missed",
    "waste_summary_today": """SELECT store_id, item_id, sale_quantity,
        round(sale_revenue, 6) AS sale_revenue, waste_quantity, category, cost,
        round(waste_cost, 6) AS waste_cost FROM waste_today""",
    "category_group_kpis": """
        SELECT s.store_id, g.category_group,
               CASE WHEN coalesce(sum(t.sale_revenue), 0) <> 0
                    THEN CAST(sum(t.sale_quantity) AS BIGINT) ELSE 0 END AS units,
               round(CASE WHEN sum(t.sale_revenue) <> 0 THEN sum(t.sale_revenue) END, 6) AS revenue,
               round(CASE WHEN sum(t.sale_revenue) <> 0
                          THEN sum(t.waste_cost) / sum(t.sale_revenue) * 100 END, 6) AS waste_pct
        FROM (SELECT DISTINCT store_id FROM waste_today) AS s,
             (VALUES ('hot_foods', ['sandwich', 'side']), ('roller_grill', ['roller_grill']),
                     ('chicken', ['chicken', 'appetizer'])) AS g(category_group, categories)
        LEFT JOIN waste_today AS t
          ON t.store_id = s.store_id AND list_contains(g.categories, t.category)
        GROUP BY s.store_id, g.category_group""",
    "lookahead_demand": """SELECT store_id, item_id, round(predicted_units, 6) AS predicted_units
        FROM ahead""",
    "published_lookahead": """SELECT store_id, item_id, round(predicted_units, 6) AS predicted_units
        FROM ahead""",
    "production_queue": "SELECT * FROM queue",
    "open_items": "SELECT queue.* FROM queue ANTI JOIN done USING (store_id, item_id)",
    "completed_items": "SELECT queue.* FROM queue SEMI JOIN done USING (store_id, item_id)",
    "replenishment": """
        SELECT a.store_id, a.item_id, round(a.predicted_units, 6) AS demand,
               coalesce(w.waste_quantity, 0) + coalesce(x.missed_units, 0) AS committed,
               CAST(CASE WHEN (v.level >= 0.6 OR minute(c.now) < 15)
                     AND a.predicted_units - coalesce(w.waste_quantity, 0) - coalesce(x.missed_units, 0) > 1
                    THEN ceil(a.predicted_units - coalesce(w.waste_quantity, 0)
                              - coalesce(x.missed_units, 0)) ELSE 0 END AS INTEGER) AS cook_qty
        FROM ahead AS a JOIN clocks AS c USING (store_id) JOIN curve AS v ON v.hour = hour(c.now)
        LEFT JOIN wasted_today AS w ON w.store_id = a.store_id AND w.item_id = a.item_id
        LEFT JOIN missed AS x ON x.store_id = a.store_id AND x.item_id = a.item_id""",
    "store_item_slot_grid": "SELECT c.store_id, g.* EXCLUDE (store_id) FROM chain AS c, grid AS g WHERE g.store_id = 0",
    "complete_features": """SELECT * REPLACE (round(avg_slot_quantity, 6) AS avg_slot_quantity)
        FROM completed""",
    "grid_features": """SELECT * REPLACE (round(avg_slot_quantity, 6) AS avg_slot_quantity)
        FROM completed""",
    "route_rows": """SELECT * REPLACE (round(avg_slot_quantity, 6) AS avg_slot_quantity)
        FROM routed""",
    "cold_prediction": f"""SELECT {_PLAN_ROW} FROM plan
        SEMI JOIN (SELECT * FROM routed WHERE route = 'cold') AS r USING (store_id, item_id, slot_index)""",
    "zero_prediction": """SELECT store_id, item_id, slot_index, 0.0::DOUBLE AS predicted_units
        FROM routed WHERE route = 'zero'""",
    "attach_weather": """SELECT f.store_id, f.item_id, f.sale_date, f.slot_index, w.temp_f,
        CAST(w.precip AS INTEGER) AS precip
        FROM slots AS f JOIN stores AS s USING (store_id) CROSS JOIN clock
        JOIN weather AS w ON w.region = s.region AND w.sale_date = CAST(now AS DATE)""",
    "production_plan": f"SELECT {_PLAN_ROW} FROM plan",
    "plan_summary": """SELECT count(*) AS predictions, count(DISTINCT store_id) AS stores,
        count(DISTINCT item_id) AS items, count(DISTINCT slot_index) AS slots,
        round(avg(predicted_units), 6) AS avg_units, round(max(predicted_units), 6) AS max_units
        FROM plan""",
    "top_items": """SELECT item_id, round(avg(predicted_units), 6) AS avg_units FROM plan
        GROUP BY item_id ORDER BY avg(predicted_units) DESC, item_id LIMIT 5""",
    "day_demand_totals": """SELECT arm, round(sum(target), 6) AS day_demand
        FROM (SELECT 'ml' AS arm, item_id, slot_index, predicted_units AS target FROM plan
              UNION ALL SELECT 'baseline', item_id, slot_index, avg_slot_quantity FROM profile)
        SEMI JOIN (SELECT * FROM menu WHERE active) AS m USING (item_id)
        WHERE slot_index BETWEEN 96 AND 191 GROUP BY arm""",
    "available_items": """SELECT i.store_id, i.item_id, CAST(hour(c.now) AS INTEGER) AS hour
        FROM (SELECT DISTINCT store_id, item_id FROM sales) AS i JOIN menu AS m USING (item_id)
        JOIN hours_of AS h USING (time_of_day) JOIN clocks AS c USING (store_id)
        WHERE m.active AND m.added <= CAST(c.now AS DATE)
          AND hour(c.now) >= h.first_hour AND hour(c.now) < h.end_hour""",
    "open_hours_filter": """SELECT slots.* FROM slots JOIN stores USING (store_id)
        WHERE hours <> '5am-11pm' OR (sale_hour >= 5 AND sale_hour < 23)""",
    "effective_price": """SELECT store_id, item_id, sale_date, effective_price,
        round(units * effective_price, 6) AS revenue
        FROM (SELECT d.*, CASE WHEN list_contains(m.sale_days, d.day_of_week)
                                AND m.sale_price IS NOT NULL
                               THEN m.sale_price ELSE m.price END AS effective_price
              FROM (SELECT store_id, item_id, sale_date, day_of_week, sum(quantity) AS units
                    FROM sales GROUP BY ALL) AS d JOIN menu AS m USING (item_id))""",
    "training_features": f"SELECT {_FEATURES}, precip FROM features",
    "model_features": f"""SELECT {_FEATURES}, CAST(precip AS INTEGER) AS precip,
        CAST(day_of_week >= 5 AS INTEGER) AS is_weekend FROM features""",
    "chronological_split": "SELECT part, store_id, item_id, sale_date, slot_index FROM split",
    "baseline_forecast": """SELECT store_id, item_id, slot_index,
        round(avg_slot_quantity, 6) AS predicted_units FROM profile""",
    "regression_metrics": """SELECT round(avg(abs(slot_quantity - avg_slot_quantity)), 6) AS mae,
        round(sqrt(avg((slot_quantity - avg_slot_quantity) ** 2)), 6) AS rmse FROM hold_out""",
    "boosted_trees": """SELECT count(*) AS test_rows,
        round(avg(abs(slot_quantity - avg_slot_quantity)), 6) AS base_mae,
        round(sqrt(avg((slot_quantity - avg_slot_quantity) ** 2)), 6) AS base_rmse, true AS finite,
        (SELECT count(*) FROM split WHERE part = 'train') AS train_rows FROM hold_out""",
    "production_plan_model": """SELECT p.store_id, p.item_id, p.slot_index, r.route,
        CASE WHEN r.route <> 'warm' THEN round(p.predicted_units, 6) END AS predicted_units,
        true AS finite FROM plan AS p JOIN routed AS r USING (store_id, item_id, slot_index)""",
    "improvement_pct": """SELECT round(base_mae, 6) AS base_mae, round(new_mae, 6) AS new_mae,
        round(base_rmse, 6) AS base_rmse, round(new_rmse, 6) AS new_rmse,
        round((base_mae - new_mae) / base_mae * 100, 6) AS mae_improvement_pct,
        round((base_rmse - new_rmse) / base_rmse * 100, 6) AS rmse_improvement_pct
        FROM (SELECT avg(abs(slot_quantity - 1.0::DOUBLE)) AS base_mae,
                     avg(abs(slot_quantity - avg_slot_quantity)) AS new_mae,
                     sqrt(avg((slot_quantity - 1.0::DOUBLE) ** 2)) AS base_rmse,
                     sqrt(avg((slot_quantity - avg_slot_quantity) ** 2)) AS new_rmse FROM hold_out)""",
    "urgency_report": """
        WITH flags AS (
          SELECT slot_quantity > avg_slot_quantity * 2 AS actual,
                 CASE WHEN avg_slot_quantity > 0.5 THEN 2.5 * avg_slot_quantity ELSE 0 END
                   > avg_slot_quantity * 2 AS guess FROM hold_out),
        classes AS (
          SELECT k.label, count(*) FILTER (actual = k.flag AND guess = k.flag) AS hit,
                 count(*) FILTER (guess = k.flag) AS guessed, count(*) FILTER (actual = k.flag) AS support
          FROM flags, (VALUES ('NORMAL', false), ('URGENT', true)) AS k(label, flag) GROUP BY k.label),
        scores AS (
          SELECT label, coalesce(hit / nullif(guessed, 0), 0) AS precision,
                 coalesce(hit / nullif(support, 0), 0) AS recall,
                 coalesce(2 * hit / nullif(guessed + support, 0), 0) AS f1, support, hit FROM classes)
        SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
               round(f1, 6) AS f1, support FROM scores
        UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / sum(support), 6),
                         CAST(sum(support) AS BIGINT) FROM scores
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6),
                         round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM scores
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                         round(sum(recall * support) / sum(support), 6),
                         round(sum(f1 * support) / sum(support), 6),
                         CAST(sum(support) AS BIGINT) FROM scores""",
    "encode_labels": """SELECT store_id, item_id,
        CAST(dense_rank() OVER (ORDER BY CAST(store_id AS VARCHAR)) - 1 AS DOUBLE) AS store_label,
        CAST(dense_rank() OVER (ORDER BY CAST(item_id AS VARCHAR)) - 1 AS DOUBLE) AS item_label,
        units FROM (SELECT store_id, item_id, CAST(sum(quantity) AS BIGINT) AS units
                    FROM sales GROUP BY ALL)""",
    "flatten_results": _DAY_TOTALS,
    "arm_totals": _DAY_TOTALS,
    "daily_results_table": _DAY_TOTALS,
    "service_level_and_waste": """SELECT date, store_id, arm,
        round(coalesce(100.0 * units_sold / nullif(units_sold + stockouts, 0), 0), 6) AS service_level,
        round(coalesce(100.0 * waste_cost / nullif(sales_revenue, 0), 0), 6) AS waste_pct
        FROM store_days""",
    "classify_weather_days": "SELECT bucket, count(*) AS store_days FROM bucketed GROUP BY bucket",
    "cumulative": _CUMULATIVE,
    "results_document_totals": _CUMULATIVE,
    "tree_predictions": """SELECT store_id, count(*) AS n_rows, TRUE AS same
        FROM hold_out GROUP BY store_id""",
    "weather_impact": f"""SELECT bucket, store_days, round_even(a, 2) AS ml_service_level,
        round_even(b, 2) AS baseline_service_level, round_even(a - b, 2) AS service_level_gap_pp,
        round_even(c, 2) AS ml_waste_pct, round_even(d, 2) AS baseline_waste_pct
        FROM (SELECT bucket, count(*) FILTER (arm = 'ml') AS store_days, {_ML['service']} AS a,
                     {_BASE['service']} AS b, {_ML['waste']} AS c, {_BASE['waste']} AS d
              FROM store_days AS s JOIN
                   (SELECT st.store_id, w.sale_date AS date,
                           CASE WHEN w.precip THEN 'precip' WHEN w.temp_f > 70 THEN 'extreme_heat'
                                WHEN w.temp_f < 55 THEN 'extreme_cold' ELSE 'neutral' END AS bucket
                    FROM stores AS st JOIN weather AS w USING (region)) AS x USING (store_id, date)
              GROUP BY bucket)""",
    "weather_multiplier_days": """
        SELECT s.region, w.sale_date, m.category, CAST(sum(d.quantity) AS BIGINT) AS units,
               first(CASE WHEN w.precip THEN 0.7::DOUBLE ELSE 1 END) AS day_factor,
               round(first(CASE WHEN w.precip THEN 0.7::DOUBLE ELSE 1 END
                 * CASE WHEN w.temp_f > 70 THEN coalesce(f.hot, 1)
                        WHEN w.temp_f < 55 THEN coalesce(f.cold, 1) ELSE 1 END), 6) AS category_factor
        FROM sales AS d JOIN menu AS m USING (item_id) JOIN stores AS s USING (store_id)
        JOIN weather AS w ON w.region = s.region AND w.sale_date = d.sale_date
        LEFT JOIN (VALUES ('chicken', 2.2::DOUBLE, 1.0::DOUBLE), ('roller_grill', 2.2, 0.4),
                          ('sandwich', 0.45, 1.9), ('side', 0.45, 1.9)) AS f(category, hot, cold)
          ON f.category = m.category
        GROUP BY s.region, w.sale_date, m.category""",
    "stable_seed_days": """SELECT DISTINCT store_id, sale_date,
        CAST(('0x' || right(sha256(CAST(sale_date AS VARCHAR) || '|' || CAST(store_id AS VARCHAR)), 8))
             AS BIGINT) AS seed FROM sales""",
    "fifo_allocate": """
        WITH s AS (SELECT *, sum(quantity) OVER (PARTITION BY store_id, item_id ORDER BY created_at, id) AS hi
                   FROM supply),
        d AS (SELECT *, sum(quantity) OVER (PARTITION BY store_id, item_id ORDER BY created_at, id) AS hi
              FROM sales)
        SELECT s.store_id, s.item_id, s.id AS supply_id, d.id AS demand_id,
               CAST(least(s.hi, d.hi) - greatest(s.hi - s.quantity, d.hi - d.quantity) AS BIGINT) AS units
        FROM s JOIN d ON s.store_id = d.store_id AND s.item_id = d.item_id
          AND s.hi - s.quantity < d.hi AND d.hi - d.quantity < s.hi""",
    # One recursion step per 15 minutes, for all store-item-days at once; batches are lists.
    "inventory_replay": """
        WITH RECURSIVE per_tick AS (
          SELECT store_id, item_id, CAST(created_at AS DATE) AS day,
                 hour(created_at) * 60 + minute(created_at) // 15 * 15 AS minute,
                 sum(CASE WHEN kind = 'sales' THEN quantity ELSE 0 END) AS requested,
                 sum(CASE WHEN kind = 'waste' THEN 2 * quantity ELSE 0 END) AS cooked
          FROM log WHERE kind IN ('sales', 'waste') GROUP BY ALL),
        days AS (
          SELECT t.store_id, t.item_id, t.day, m.cook_time, m.hold_time * 60 AS hold, s.hours,
                 CASE WHEN sum(t.requested) > 0 AND s.hours = '24/7' THEN 2 ELSE 0 END AS opening
          FROM per_tick AS t JOIN menu AS m USING (item_id) JOIN stores AS s USING (store_id)
          GROUP BY t.store_id, t.item_id, t.day, m.cook_time, m.hold_time, s.hours),
        state AS (
          SELECT store_id, item_id, day, cook_time, hold, hours, CAST(-15 AS BIGINT) AS minute,
                 CASE WHEN opening > 0 THEN [{'q': CAST(opening AS BIGINT), 'e': CAST(hold AS DOUBLE)}]
                      ELSE CAST([] AS STRUCT(q BIGINT, e DOUBLE)[]) END AS shelf,
                 CAST([] AS STRUCT(q BIGINT, r DOUBLE, e DOUBLE)[]) AS cooking,
                 false AS runs, CAST(0 AS BIGINT) AS requested, CAST(0 AS BIGINT) AS cooked,
                 CAST(0 AS BIGINT) AS on_hand, CAST(0 AS BIGINT) AS sold, CAST(0 AS BIGINT) AS wasted
          FROM days
          UNION ALL
          SELECT store_id, item_id, day, cook_time, hold, hours, minute,
                 CASE WHEN runs THEN list_filter(rest, lambda b: b.q > 0 AND b.e > minute) ELSE shelf END,
                 CASE WHEN runs THEN list_concat(list_filter(cooking, lambda b: b.r > minute),
                   CASE WHEN ordered > 0
                        THEN [{'q': ordered, 'r': CAST(minute + cook_time AS DOUBLE),
                               'e': CAST(minute + cook_time + hold AS DOUBLE)}]
                        ELSE CAST([] AS STRUCT(q BIGINT, r DOUBLE, e DOUBLE)[]) END) ELSE cooking END,
                 runs, wanted, ordered, stock, taken,
                 CAST(coalesce(list_sum(list_transform(
                   list_filter(rest, lambda b: b.e <= minute), lambda b: b.q)), 0) AS BIGINT)
          FROM (SELECT *, list_transform(ready, lambda b, i: {'q': CAST(b.q - least(b.q, greatest(0,
                         taken - coalesce(list_sum(list_transform(ready[1:i - 1], lambda x: x.q)), 0)))
                         AS BIGINT), 'e': b.e}) AS rest
                FROM (SELECT *, least(wanted, stock) AS taken
                      FROM (SELECT *, CAST(coalesce(list_sum(list_transform(ready, lambda b: b.q)), 0)
                                           AS BIGINT) AS stock
                            FROM (SELECT s.store_id, s.item_id, s.day, s.cook_time, s.hold, s.hours,
                                         s.minute + 15 AS minute, s.shelf, s.cooking,
                                         s.hours = '24/7' OR (s.minute + 15 >= 300 AND s.minute + 15 < 1380)
                                           AS runs,
                                         list_concat(s.shelf, list_transform(
                                           list_filter(s.cooking, lambda b: b.r <= s.minute + 15),
                                           lambda b: {'q': b.q, 'e': b.e})) AS ready,
                                         CAST(coalesce(t.requested, 0) AS BIGINT) AS wanted,
                                         CAST(coalesce(t.cooked, 0) AS BIGINT) AS ordered
                                  FROM state AS s LEFT JOIN per_tick AS t
                                    ON t.store_id = s.store_id AND t.item_id = s.item_id
                                    AND t.day = s.day AND t.minute = s.minute + 15
                                  WHERE s.minute < 1425))))),
        unserved AS (
          SELECT q.store_id, q.item_id, q.day, q.minute, sum(q.quantity) AS stockouts
          FROM (SELECT store_id, item_id, sale_date AS day,
                       sale_hour * 60 + sale_minute AS minute, quantity,
                       sum(quantity) OVER (PARTITION BY store_id, item_id, sale_date, slot_index
                         ORDER BY created_at, id) - quantity AS before FROM sales) AS q
          JOIN state AS s USING (store_id, item_id, day, minute)
          WHERE s.runs AND q.before >= s.on_hand GROUP BY ALL)
        SELECT store_id, item_id, day, CAST(day AS TIMESTAMP) + to_minutes(CAST(minute AS BIGINT)) AS tick,
               requested, cooked, on_hand, sold, wasted, on_hand - sold - wasted AS left_over,
               CAST(coalesce(list_sum(list_transform(cooking, lambda b: b.q)), 0) AS BIGINT) AS in_progress,
               CAST(coalesce(x.stockouts, 0) AS BIGINT) AS stockouts
        FROM state LEFT JOIN unserved AS x USING (store_id, item_id, day, minute)
        WHERE runs AND (requested > 0 OR cooked > 0 OR on_hand > 0)""",
    "not_null": """SELECT column_name, failures FROM
        (SELECT count(*) FILTER (store_id IS NULL) AS store_id,
                count(*) FILTER (item_id IS NULL) AS item_id,
                count(*) FILTER (quantity IS NULL) AS quantity, count(*) FILTER (price IS NULL) AS price,
                count(*) FILTER (created_at IS NULL) AS created_at FROM sales) AS t
        UNPIVOT (failures FOR column_name IN (store_id, item_id, quantity, price, created_at))""",
    "accepted_range": "SELECT count(*) FILTER (quantity < 1) AS failures FROM sales",
    "freshness": """SELECT newest, CAST(trunc(epoch(now - newest)) AS BIGINT) AS age_seconds,
        CASE WHEN now - newest > INTERVAL 30 MINUTE THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max(created_at) AS newest FROM stockouts), clock""",
    "row_count_invariant": """SELECT count(*) AS rows_in, count(*) AS rows_out, true AS holds
        FROM grid""",
    "read_events": """SELECT kind, CAST(created_at AS DATE) AS day,
        CAST(sum(quantity) AS BIGINT) AS units, count(*) AS n_events FROM log GROUP BY ALL""",
    "union_stores": """SELECT CAST(store_id AS VARCHAR) AS store_id, sale_date,
        CAST(sum(quantity) AS BIGINT) AS units FROM sales GROUP BY ALL""",
    "delete_from_cutoff": """SELECT kind, CAST(created_at AS DATE) AS day, count(*) AS n_events,
        max(created_at) AS newest FROM log WHERE created_at < TIMESTAMP '2024-01-20 10:30:00'
        GROUP BY ALL""",
    "csv_round_trip": """SELECT store_id, item_id, sale_date,
        CAST(sum(quantity) AS BIGINT) AS sale_quantity FROM sales GROUP BY ALL""",
    "waste_percentage_csv_dims": """SELECT * REPLACE (CAST(store_id AS VARCHAR) AS store_id,
        CAST(item_id AS VARCHAR) AS item_id) FROM waste_percent""",
    "cold_start_profile_yaml_dims": """SELECT m.category, p.day_of_week, p.sale_hour, p.slot_index,
        round(avg(p.avg_slot_quantity), 6) AS avg_slot_quantity
        FROM profile AS p JOIN menu AS m USING (item_id) GROUP BY ALL""",
    "store_predictions": """SELECT store_id, item_id, slot_index,
        round(avg_slot_quantity, 6) AS predicted_units FROM profile WHERE store_id = 5""",
    "marts": """
        SELECT 'slot_sales' AS mart, count(*) AS n_rows FROM slots
        UNION ALL SELECT 'baseline_profile', count(*) FROM profile
        UNION ALL SELECT 'cold_start_profile', count(*) FROM
          (SELECT DISTINCT category, slot_index FROM profile JOIN menu USING (item_id))
        UNION ALL SELECT 'traffic_ratio', count(*) FROM traffic
        UNION ALL SELECT 'store_sales_15min', count(*) FROM item_days
        UNION ALL SELECT 'waste_percentage', count(*) FROM
          (SELECT DISTINCT store_id, item_id, waste_date FROM waste) AS w
          SEMI JOIN sales AS s ON s.store_id = w.store_id AND s.item_id = w.item_id
            AND s.sale_date = w.waste_date
        UNION ALL SELECT 'stockout_summary', count(*) FROM
          (SELECT DISTINCT store_id, item_id, stockout_date, stockout_hour FROM stockouts)
        UNION ALL SELECT 'ml_training_features', count(*) FROM features""",
    "refreshed_profile": f"SELECT {_PROFILE}, days_observed FROM profile",
    "refreshed_cold_start": """SELECT m.category, p.day_of_week, p.sale_hour, p.slot_index,
        round(avg(p.avg_slot_quantity), 6) AS avg_slot_quantity
        FROM profile AS p JOIN menu AS m USING (item_id) GROUP BY ALL""",
    "refreshed_traffic_ratio": """SELECT store_id, round(avg_daily_units, 6) AS avg_daily_units,
        round(traffic_ratio, 6) AS traffic_ratio FROM traffic""",
    # The streams give out open windows too, so they equal the batch.
    "stream_slot_sales": """SELECT store_id, item_id, sale_15min, slot_index,
        CAST(sum(quantity) AS BIGINT) AS slot_quantity FROM sales GROUP BY ALL""",
    "stream_stockouts": """SELECT store_id, item_id, stockout_date, stockout_hour,
        CAST(sum(quantity_requested) AS BIGINT) AS total_missed_units, count(*) AS event_count
        FROM stockouts GROUP BY ALL""",
    "stream_waste_today": """SELECT coalesce(s.store_id, w.store_id) AS store_id,
        coalesce(s.item_id, w.item_id) AS item_id, coalesce(s.sale_date, w.waste_date) AS waste_date,
        CAST(coalesce(s.quantity, 0) AS BIGINT) AS sales_quantity,
        round(coalesce(s.revenue, 0), 6) AS sales_revenue,
        CAST(coalesce(w.quantity, 0) AS BIGINT) AS waste_quantity, m.category,
        round(coalesce(w.quantity, 0) * m.cost, 6) AS waste_cost
        FROM (SELECT store_id, item_id, sale_date, sum(quantity) AS quantity,
                     sum(quantity * price) AS revenue FROM sales GROUP BY ALL) AS s
        FULL JOIN (SELECT store_id, item_id, waste_date, sum(quantity) AS quantity
                   FROM waste GROUP BY ALL) AS w
          ON s.store_id = w.store_id AND s.item_id = w.item_id AND s.sale_date = w.waste_date
        JOIN menu AS m ON m.item_id = coalesce(s.item_id, w.item_id)""",
    "stream_inventory": """SELECT store_id, item_id,
        CAST(sum(CASE WHEN kind = 'sales' THEN quantity ELSE 0 END) AS BIGINT) AS requested,
        CAST(sum(CASE WHEN kind = 'waste' THEN 2 * quantity ELSE 0 END) AS BIGINT) AS cooked,
        CAST(0 AS BIGINT) AS unexplained
        FROM log JOIN stores USING (store_id),
             (SELECT max(created_at) AS newest FROM log WHERE kind IN ('sales', 'waste')) AS c
        WHERE kind IN ('sales', 'waste')
          AND (hours = '24/7' OR (hour(created_at) >= 5 AND hour(created_at) < 23))
          AND time_bucket(INTERVAL 15 MINUTE, created_at) + INTERVAL 15 MINUTE
              <= date_trunc('milliseconds', c.newest) - INTERVAL 15 MINUTE
        GROUP BY store_id, item_id""",
    "stream_append_logs": """SELECT kind, CAST(created_at AS DATE) AS day,
        CAST(sum(quantity) AS BIGINT) AS units, count(*) AS n_events FROM log GROUP BY ALL""",
    "stream_quality": """SELECT test, column_name, CAST(failures AS BIGINT) AS failures,
        (SELECT count(*) FROM sales) AS n_rows FROM
        (SELECT 'not_null' AS test, * FROM
            (SELECT count(*) FILTER (store_id IS NULL) AS store_id,
                    count(*) FILTER (item_id IS NULL) AS item_id,
                    count(*) FILTER (quantity IS NULL) AS quantity, count(*) FILTER (price IS NULL) AS price,
                    count(*) FILTER (created_at IS NULL) AS created_at FROM sales) AS t
            UNPIVOT (failures FOR column_name IN (store_id, item_id, quantity, price, created_at))
         UNION ALL SELECT 'accepted_range', 'quantity', count(*) FILTER (quantity < 1) FROM sales
         UNION ALL SELECT 'accepted_range', 'price', count(*) FILTER (price < 10) FROM sales
         UNION ALL SELECT 'freshness', 'created_at',
            CASE WHEN (SELECT max(created_at) FROM log) - max(created_at) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END
            FROM sales)""",
    "stream_append": """SELECT store_id, item_id, quantity, round(price, 6) AS price, created_at,
        sale_date AS event_date FROM sales""",
}


def _with_tables(body: str) -> str:
    tables = ",\n".join(f"{name} AS ({sql})" for name, sql in _TABLES.items())
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.lstrip().startswith(opening):
            return f"{opening}{tables},\n{body.lstrip().removeprefix(opening)}"
    return f"WITH {tables}\n{body}"


ORACLE = {name: _with_tables(body) for name, body in _BODIES.items()}
