"""The two weekly views as catalog views: SQL text over the mart tables.

The catalog stores the text; Spark plans it when a view is read, so a view
gives the rows of the tables as they are then, in every session.  Nothing is
computed when a view is created.

``inventory_weekly`` needs the lead of the fact over (item, date descending).
Inside one item and day the next record has the same date, so each record
covers its own day; only the *closing* record of an item and day (a top-1, reduced
before its shuffle) reaches back to the next older day of the item or, at an
item's oldest day, to the newest day of the next item.  The view therefore
adds up signed parts: one day per record, the days before a closing record,
and minus the day of the record that nothing precedes.  Items are put in order
by ranges between splitters, the items with the smallest hashes, so that no
task orders all items; an item's range is found in two steps, among every
32nd splitter and then among 32.  Equal parts are summed and the dimensions
joined to the sums before these are expanded to weeks; they are dealt by their item
columns, so the weekly rows are grouped where they are made.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

# Greatest number of splitters of the item order.
ITEM_RANGES = 1_000
_STEP = 32

_ITEM_COLUMNS = "sku, brandname, vendorid, categoryid, description, color, size, attribute3"
_RECORD = "itemuuid, sku, categoryid, source, locationid, qoh, backorder, cost"
_PIECE = "year, weekending, month, month_name, week_of_year"
_WEEK_END = "date_add(trunc({day}, 'week'), 6)"


def sales_weekly_sql(db: str) -> str:
    return f"""
WITH dated AS (
  -- a week's rows of an item and location meet once, for their sums and their orders
  SELECT {_WEEK_END.format(day="o.date")} AS weekending, year, month, month_name, week_of_year, itemuuid, locationid, source,
         orderuuid, qty_sold, price, discount
  FROM {db}.order_fact o JOIN {db}.date_dim d ON o.date = d.date
  DISTRIBUTE BY weekending, year, month, itemuuid, locationid, source
), sums AS (
  SELECT weekending, year, month, month_name, week_of_year, itemuuid, locationid, source,
         count(DISTINCT orderuuid) AS ordercount, sum(qty_sold) AS qty, sum(price) AS dollars, avg(discount) AS avgpercentdiscount
  FROM dated GROUP BY ALL
), items AS (
  SELECT uuid, {_ITEM_COLUMNS}, source AS item_source, count(*) AS n FROM {db}.item_dim
  GROUP BY uuid, {_ITEM_COLUMNS}, source
)
SELECT weekending, year, month, month_name, week_of_year, itemuuid, ordercount, qty * coalesce(n, 1) AS qtysold,
       CAST(dollars * coalesce(n, 1) AS DECIMAL(20,2)) AS salesdollars, avgpercentdiscount, source, sku, uuid, brandname,
       vendorid, categoryid, description, color, size, attribute3
FROM sums LEFT JOIN items ON itemuuid = uuid"""


def inventory_weekly_sql(db: str) -> str:
    # the record that closes an item's day is the last in (locationid, source, ..) order, nulls last
    last = ", ".join(f"{c} DESC NULLS FIRST" for c in ("locationid", "source", "sku", "categoryid", "qoh", "backorder", "cost"))
    return f"""
WITH spine AS (
  SELECT date AS day, year, {_WEEK_END.format(day="date")} AS weekending, month, month_name, week_of_year FROM {db}.date_dim
), closing AS (
  SELECT date, {_RECORD} FROM (
    SELECT *, row_number() OVER (PARTITION BY itemuuid, date ORDER BY {last}) AS place FROM {db}.inventory_fact
  ) WHERE place = 1
), heads AS (
  SELECT itemuuid, CASE WHEN count(date) = count(*) THEN max(date) END AS head FROM closing GROUP BY itemuuid
), ranged AS (
  SELECT itemuuid, head, CASE
           WHEN itemuuid IS NULL THEN {ITEM_RANGES + 1}
           ELSE steps * {_STEP} + size(filter(slice(splitters.every, steps * {_STEP} + 1, {_STEP}), s -> s <= itemuuid))
         END AS item_range
  FROM (
    SELECT itemuuid, head, splitters, size(filter(splitters.steps, s -> s <= itemuuid)) AS steps
    FROM (
      SELECT *, (
        SELECT named_struct('every', every, 'steps', filter(every, (s, i) -> i % {_STEP} = {_STEP - 1})) FROM (
          SELECT sort_array(collect_list(itemuuid)) AS every FROM (
            SELECT itemuuid FROM heads WHERE itemuuid IS NOT NULL ORDER BY xxhash64(itemuuid), itemuuid LIMIT {ITEM_RANGES}
          )
        )
      ) AS splitters FROM heads
    )
  )
), openings AS (
  SELECT item_range, lead(opening) OVER (ORDER BY item_range) AS next_opening FROM (
    SELECT item_range, min_by(named_struct('date', head), coalesce(itemuuid, '')) AS opening FROM ranged GROUP BY item_range
  )
), following AS (
  SELECT itemuuid, coalesce(next_head, next_opening) AS next_item FROM (
    SELECT *, lead(named_struct('date', head)) OVER (PARTITION BY item_range ORDER BY itemuuid) AS next_head FROM ranged
  -- every range has its opening; an inner join would look up the range of every record for a null check
  ) LEFT JOIN openings USING (item_range)
), closed AS (
  SELECT c.*, coalesce(older, next_item).date AS previous FROM (
    SELECT *, lead(named_struct('date', date)) OVER (PARTITION BY itemuuid ORDER BY date DESC NULLS FIRST) AS older FROM closing
  ) c LEFT JOIN following f ON c.itemuuid <=> f.itemuuid
), parts AS (
  SELECT date AS lo, date AS hi, 1 AS sign, {_RECORD} FROM {db}.inventory_fact
  UNION ALL SELECT date, date, -1, {_RECORD} FROM closed WHERE previous IS NULL
  UNION ALL SELECT date_add(previous, 1), date_sub(date, 1), 1, {_RECORD} FROM closed WHERE date_add(previous, 1) < date
), clipped AS (
  SELECT * FROM (
    SELECT sign, {_RECORD}, greatest(lo, (SELECT min(day) FROM spine)) AS lo, least(hi, (SELECT max(day) FROM spine)) AS hi
    FROM parts WHERE lo IS NOT NULL AND hi IS NOT NULL
  ) WHERE lo <= hi
), held AS (
  SELECT itemuuid, sku, categoryid, source, locationid, lo, hi, sum(sign) AS n,
         sum(sign * qoh) AS qoh, sum(CASE WHEN qoh IS NOT NULL THEN sign END) AS qoh_n,
         sum(sign * backorder) AS backorder, sum(CASE WHEN backorder IS NOT NULL THEN sign END) AS backorder_n,
         sum(sign * cost) AS cost, sum(CASE WHEN cost IS NOT NULL THEN sign END) AS cost_n
  FROM clipped GROUP BY ALL
), edges AS (
  SELECT day, sum(delta) AS delta FROM (
    SELECT inline(array(named_struct('day', lo, 'delta', n), named_struct('day', date_add(hi, 1), 'delta', -n))) FROM held
  ) GROUP BY day
), covered AS (
  SELECT day, sum(coalesce(delta, 0)) OVER (ORDER BY day) AS open FROM spine LEFT JOIN edges USING (day)
), dealt AS (
  SELECT * FROM (
    SELECT h.itemuuid, h.sku, h.categoryid, h.source, i.brandname, i.description, i.color, i.size, i.attribute3,
           l.category AS georegion, h.lo, h.hi, h.n, h.qoh, h.qoh_n, h.backorder, h.backorder_n, h.cost, h.cost_n
    FROM held h LEFT JOIN {db}.item_dim i ON h.itemuuid = i.uuid
    -- records without a location match nothing and are spread by their item
    LEFT JOIN {db}.location_dim l ON coalesce(h.locationid, h.itemuuid) = l.locationid AND h.locationid IS NOT NULL
    UNION ALL SELECT null, null, null, null, null, null, null, null, null, null, day, day, 1, null, null, null, null, null, null
    FROM covered WHERE open = 0
  ) DISTRIBUTE BY itemuuid, sku, categoryid, source
), pieces AS (
  SELECT {_PIECE}, min(day) AS first_day, max(day) AS last_day FROM spine GROUP BY {_PIECE}
), touched AS (
  SELECT /*+ BROADCAST(p) */ w.*, {_PIECE}, datediff(least(hi, last_day), greatest(lo, first_day)) + 1 AS days
  FROM (
    SELECT *, explode(sequence({_WEEK_END.format(day="lo")}, {_WEEK_END.format(day="hi")}, INTERVAL 7 DAYS)) AS week FROM dealt
  ) w JOIN pieces p ON week = p.weekending
  WHERE least(hi, last_day) >= greatest(lo, first_day)
), sums AS (
  SELECT {_PIECE}, itemuuid, sku, categoryid, source, brandname, description, color, size, attribute3, georegion,
         CASE WHEN sum(qoh_n * days) > 0 THEN sum(qoh * days) END AS qoh_sum, nullif(sum(qoh_n * days), 0) AS qoh_days,
         CASE WHEN sum(backorder_n * days) > 0 THEN sum(backorder * days) END AS backorder_sum,
         CASE WHEN sum(cost_n * days) > 0 THEN CAST(sum(cost * days) AS DECIMAL(16,2)) END AS cost_sum,
         nullif(sum(cost_n * days), 0) AS cost_days
  FROM touched GROUP BY ALL HAVING sum(n * days) > 0
)
SELECT weekending, year, month, month_name, week_of_year, sku, itemuuid, qoh_sum, backorder_sum,
       CAST(cost_sum / CAST(cost_days AS DECIMAL(20,0)) AS DECIMAL(10,6)) AS avg_cost,
       categoryid, source, brandname, description, color, size, attribute3, georegion,
       cost_sum * CAST(CAST(qoh_sum AS DECIMAL(30,0)) / CAST(qoh_days AS DECIMAL(20,0)) AS DECIMAL(24,4)) AS inventorydollars
FROM sums"""


VIEWS = {"sales_weekly": sales_weekly_sql, "inventory_weekly": inventory_weekly_sql}


# The mart tables that each view reads.
VIEW_TABLES = {
    "sales_weekly": ("date_dim", "item_dim", "order_fact"),
    "inventory_weekly": ("date_dim", "item_dim", "location_dim", "inventory_fact"),
}


def create_views(spark: SparkSession, database: str, names: Iterable[str] = tuple(VIEWS)) -> dict[str, str]:
    """``CREATE OR REPLACE VIEW`` of the weekly views in ``database``; returns their full names."""
    for name in names:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {VIEWS[name](database)}")
    return {name: f"{database}.{name}" for name in names}
