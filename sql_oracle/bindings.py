"""DuckDB text of the logical tables over the driver views (FIXTURES.md part 2).

Independent of the Spark bindings: written from the same rules, as plain
SQL, so a mistake on one side shows up as a mismatch.
"""

AS_OF = "DATE '2000-01-01'"
SITE = "'EUROPE'"

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, *deps: str):
    def register(body: str) -> str:
        CTES[name] = (deps, body)
        return body

    return register


cte("vendor_location")(f"""
SELECT {AS_OF} AS snapshot_date,
       r.r_name AS location_code,
       'V' || CAST(s.s_suppkey AS VARCHAR) AS vendor_number,
       s.s_name AS vendor_name,
       CASE s.s_suppkey % 5 WHEN 0 THEN 'Shipping Container' WHEN 1 THEN 'FTL (Full Truck Load)'
            WHEN 2 THEN 'LTL (Less Truck Load)' WHEN 3 THEN 'Small Parcel' ELSE 'Prepaid' END AS vendor_delivery_type,
       'B' || CAST(s.s_nationkey % 4 AS VARCHAR) AS vendor_purchaser_code,
       CASE s.s_suppkey % 7 WHEN 0 THEN 'HOUSE' WHEN 1 THEN 'HOUSE.COM' ELSE 'COLLECT' END AS vendor_shipment_method_code,
       CASE WHEN s.s_suppkey % 2 = 0 THEN 'DIRECT' ELSE 'DISTRIBUTOR' END AS vendor_distribution_method,
       CASE WHEN s.s_acctbal >= 0 THEN 'Enabled' ELSE 'Disabled' END AS vendor_status,
       CAST((s.s_suppkey * 3 + r.r_regionkey) % 23 AS INTEGER) AS vendor_lead_time_business_days,
       CASE WHEN s.s_suppkey % 8 = 0 THEN 0.4e0 * (1 + s.s_suppkey % 4) END AS vendor_planning_minimum_case,
       CASE WHEN s.s_suppkey % 8 = 1 THEN 5000.0e0 * (1 + s.s_suppkey % 4) END AS vendor_planning_minimum_cube,
       CASE WHEN s.s_suppkey % 8 = 2 THEN 1000.0e0 * (1 + s.s_suppkey % 4) END AS vendor_planning_minimum_dollar_amount,
       CASE WHEN s.s_suppkey % 8 = 3 THEN 0.04e0 * (1 + s.s_suppkey % 4) END AS vendor_planning_minimum_pallet,
       CASE WHEN s.s_suppkey % 40 = 14 THEN 0.0e0
            WHEN s.s_suppkey % 8 IN (4, 7) THEN 2.0e0 * (1 + s.s_suppkey % 4) END AS vendor_planning_minimum_units,
       CASE WHEN s.s_suppkey % 8 IN (5, 7) THEN 20.0e0 * (1 + s.s_suppkey % 4) END AS vendor_planning_minimum_weight
FROM supplier s CROSS JOIN region r
""")

cte("item_location_vendor")(f"""
SELECT DISTINCT {AS_OF} AS snapshot_date,
       p.p_partkey AS item,
       r.r_name AS location_code,
       'V' || CAST((p.p_partkey * 7 + r.r_regionkey * 13 + ks.k * ks.k * 11) % (SELECT count(*) FROM supplier) AS VARCHAR)
           AS vendor_number,
       CAST((p.p_partkey * 7 + r.r_regionkey * 13 + ks.k * ks.k * 11) % 9 AS INTEGER) AS vendor_lead_time_business_days,
       CASE WHEN p.p_partkey % 53 = 0 THEN 0.0e0 ELSE CAST(1 + p.p_size % 12 AS DOUBLE) END AS vendor_uom_qty,
       CASE WHEN p.p_partkey % 53 = 0 THEN 0.0e0 ELSE CAST(1 + p.p_size % 12 AS DOUBLE) END AS base_uom_qty,
       ks.k = 0 AS primary_vendor_flag,
       p.p_partkey % 47 = 0 AS product_discontinued_flag,
       p.p_partkey % 37 <> 0 AS product_published_flag,
       CASE WHEN p.p_partkey % 59 = 0 THEN 'X' END AS purchase_source_location
FROM part p CROSS JOIN region r CROSS JOIN (VALUES (0), (1), (2)) ks(k)
""")

cte("item_master")("""
SELECT p_partkey AS item,
       CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE p_size * 100.0e0 END AS unit_cube,
       p_retailprice * 0.6e0 AS unit_cost,
       CASE WHEN p_partkey % 97 = 0 THEN 0.0e0 ELSE CAST(20 + p_size AS DOUBLE) END AS pallet_qty,
       p_size * 0.5e0 AS unit_weight
FROM part
""")

cte("item_location")("""
SELECT p.p_partkey AS item, r.r_name AS location_code
FROM part p CROSS JOIN region r
WHERE (p.p_partkey + r.r_regionkey) % 11 <> 0
""")

cte("product_dims")("""
SELECT p_partkey AS item,
       CASE WHEN p_partkey % 83 = 0 THEN NULL ELSE p_size * 0.8e0 END AS height,
       p_size * 1.1e0 AS length,
       p_size * 0.9e0 AS width,
       p_size * 0.5e0 AS weight,
       'EA' AS unit_of_measure,
       'LB' AS weight_uom,
       p_partkey % 31 <> 0 AS setup_completed_flag,
       p_partkey % 61 = 0 AS discontinued_flag
FROM part
WHERE p_partkey % 29 <> 0
""")

cte("li_region")("""
SELECT l.*, r.r_name
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
""")

cte("forecast", "li_region")(f"""
SELECT {AS_OF} AS snapshot_date,
       l_partkey AS item,
       r_name AS area,
       CAST(l_shipdate AS DATE) AS forecast_date,
       l_quantity * (1.0e0 - l_discount) AS base_qty,
       l_quantity AS commercial_qty
FROM li_region
""")

cte("inventory_snapshot", "forecast")(f"""
SELECT {AS_OF} AS snapshot_date,
       item,
       area AS location_code,
       sum(commercial_qty) / 90.0e0 AS daily_forecast_qty,
       item % 41 <> 0 AS managed_flag,
       item % 43 = 0 AS location_discontinued_flag
FROM forecast
WHERE forecast_date BETWEEN {AS_OF} AND {AS_OF} + 89
GROUP BY item, area
""")

cte("receipt_log", "li_region")("""
SELECT r_name AS wh_id,
       'PO' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(year(l_shipdate) * 12 + month(l_shipdate) AS VARCHAR)
           AS control_number,
       CAST(l_partkey AS VARCHAR) AS item_number,
       CASE WHEN l_returnflag = 'R' THEN 951 ELSE 151 END AS tran_type,
       CASE WHEN l_linenumber = 7 THEN 0.0e0 ELSE l_quantity END AS tran_qty,
       CAST(l_shipdate AS DATE) AS tran_date
FROM li_region
""")

cte("docs_once")("""
SELECT DISTINCT
       'PO' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(year(l_shipdate) * 12 + month(l_shipdate) AS VARCHAR)
           AS document_number,
       l_suppkey AS vendor_key,
       CASE WHEN month(l_shipdate) = 12 THEN 'Transfer' ELSE 'Purchase' END AS document_type
FROM lineitem
""")

cte("procurement_docs", "docs_once")("""
SELECT * FROM docs_once
UNION ALL
SELECT * FROM docs_once WHERE vendor_key % 10 = 0
""")

cte("vendors")("""
SELECT s_suppkey AS vendor_key, 'V' || CAST(s_suppkey AS VARCHAR) AS vendor_number, s_name AS vendor_name
FROM supplier
""")

cte("vendor_override")("""
SELECT * FROM (
  SELECT 'V' || CAST(s_suppkey AS VARCHAR) AS vendor_number,
         CASE WHEN s_suppkey % 31 = 0 THEN
              CASE s_suppkey % 3 WHEN 0 THEN 'LTL (Less Truck Load)' WHEN 1 THEN 'Small Parcel'
                   ELSE 'Shipping Container' END END AS delivery_type,
         CASE WHEN s_suppkey % 16 = 6 THEN 25.0e0 END AS min_amount
  FROM supplier) x
WHERE delivery_type IS NOT NULL OR min_amount IS NOT NULL
""")

cte("plan_rows")("""
SELECT r.r_name AS location_code,
       'V' || CAST(s.s_suppkey AS VARCHAR) AS vendor_number,
       s.s_name AS vendor_name,
       CAST((s.s_suppkey * 3 + r.r_regionkey) % 23 AS INTEGER) AS vendor_lead_time_business_days,
       CAST((s.s_suppkey * 7919 + r.r_regionkey * 101) % 997 AS BIGINT) AS weekly_units,
       CAST((s.s_suppkey * 37 + r.r_regionkey * 11) % 5 + 1 AS INTEGER) AS orders
FROM supplier s CROSS JOIN region r
""")
