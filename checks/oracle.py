"""DuckDB statements giving the result expected of each query, in plain form.

Every statement is assembled from the named blocks below: the adapted source tables, then one block per
operator, written without any of the rewrites the Spark jobs use.
"""

from __future__ import annotations

import re

BLOCKS: dict[str, str] = {}


def lat(k: str) -> str:
    return f"(30 + (7 * ({k})) % 13)"


def lon(k: str) -> str:
    return f"(-(80 + (11 * ({k})) % 17))"


def sphere(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"2 * 6371010.0 * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def road(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return f"(1.2::DOUBLE * ({sphere(lon1, lat1, lon2, lat2)}) / 1.6::DOUBLE / 1000)"


def miles(a: str, b: str) -> str:
    return road(lon(a), lat(a), lon(b), lat(b))


def zip_code(k: str) -> str:
    return f"CAST(10000 + ({k}) AS VARCHAR)"


SEGMENT = "list_position(['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'], c_mktsegment) + 100"
PRIORITY = "CAST(left(o_orderpriority, 1) AS INTEGER) + 120"

# ------------------------------------------------------------------ source tables

BLOCKS["fx_lines"] = f"""
  SELECT l_orderkey || '-' || l_suppkey AS invoice_id,
         'STR' || c_nationkey AS o_id, 'STR' AS o_type,
         CASE WHEN c_nationkey = 7 AND l_linenumber = 1 THEN '99907' ELSE {zip_code('c_nationkey')} END AS o_zip,
         'DC' || (50 + s_nationkey) AS d_id,
         CASE s_nationkey % 3 WHEN 0 THEN 'FDC' WHEN 1 THEN 'BDC' ELSE 'FDC/BDC' END AS d_type,
         {zip_code('50 + s_nationkey')} AS d_zip,
         CASE WHEN s_nationkey % 5 <> 0
              THEN floor({miles('c_nationkey', '50 + s_nationkey')} * 4 + 0.5) / 4 + l_linenumber END AS mile_cnt,
         CASE WHEN l_linenumber <> 3 THEN CAST(l_shipdate AS DATE) END AS shp_dt,
         CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS arvl_ts,
         CAST(NULL AS TIMESTAMP) AS dprt_ts,
         CASE WHEN l_returnflag = 'R' THEN 25 ELSE 10 END AS ship_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey"""
BLOCKS["fx_invoices"] = """
  SELECT DISTINCT l_orderkey || '-' || l_suppkey AS invoice_id, 'DC' || (50 + s_nationkey) AS dc_nbr
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
BLOCKS["fx_calendar"] = """
  SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS DATE)
         AS cal_dt FROM lineitem"""
BLOCKS["fx_moves"] = "SELECT 'DC51' AS old_nbr, 'DC76' AS new_nbr"
BLOCKS["fx_dcs"] = "SELECT n_nationkey + 50 AS k FROM nation UNION ALL SELECT 76"
BLOCKS["fx_segments"] = f"SELECT DISTINCT {SEGMENT} AS k FROM customer"
BLOCKS["fx_priorities"] = f"SELECT DISTINCT {PRIORITY} AS k FROM orders"
BLOCKS["fx_nodes"] = """
  SELECT n_nationkey AS k, 'STR' || n_nationkey AS id FROM nation
  UNION ALL SELECT k, 'DC' || k FROM fx_dcs
  UNION ALL SELECT k, 'SRS_' || k FROM fx_segments
  UNION ALL SELECT k, 'SRS_' || k FROM fx_priorities"""
BLOCKS["fx_campus"] = """
  SELECT CAST(k AS BIGINT) AS campus, 'DC' || k || ' - City' || k AS campus_nbr_nm, 'DC' || k AS campus_name,
         unnest(CASE WHEN k % 5 = 0 THEN ['C' || k, 'X' || k] ELSE ['C' || k] END) AS scac
  FROM fx_dcs WHERE k % 6 <> 0
  UNION ALL SELECT 4, 'STR4 - City4', 'STR4', 'C4' FROM nation WHERE n_nationkey = 4"""
BLOCKS["fx_places"] = f"""
  SELECT id AS loc_nbr, 'City' || k AS city, 'S' || (k % 10) AS state, {zip_code('k')} AS zip FROM fx_nodes
  UNION ALL SELECT id, 'City3', 'S3', '99903' FROM fx_nodes WHERE k = 3"""
BLOCKS["fx_partner_counts"] = f"""
  SELECT {SEGMENT} AS ko, {PRIORITY} AS kd, count(*) AS volume
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
BLOCKS["fx_partner"] = f"""
  SELECT ko, kd, CAST(ko AS VARCHAR) AS origin_id,
         CASE WHEN ko = 104 AND kd = 121 THEN NULL ELSE CAST(kd AS VARCHAR) END AS dest_id,
         {zip_code('ko')} AS o_zip,
         CASE WHEN ko = 105 AND kd = 125 THEN 'V5K1A' ELSE {zip_code('kd')} END AS d_zip,
         'City' || ko AS o_city, 'S' || (ko % 10) AS o_state, 'City' || kd AS d_city, 'S' || (kd % 10) AS d_state,
         CASE WHEN ko <= 103 THEN least(volume, 40) ELSE volume END AS volume, {miles('ko', 'kd')} * CASE WHEN (ko + kd) % 2 = 0 THEN 1.6::DOUBLE ELSE 1.1::DOUBLE END AS distance
  FROM fx_partner_counts"""
BLOCKS["fx_distances"] = f"""
  SELECT {zip_code('a')} AS o_zip, {zip_code('b')} AS d_zip,
         CASE WHEN a = 2 AND b = 103 THEN -1.0::DOUBLE ELSE 1.05::DOUBLE * {miles('a', 'b')} END AS dist
  FROM (SELECT n_nationkey AS a, unnest(range(101, 106)) AS b FROM nation WHERE n_nationkey % 2 = 0)
  UNION ALL
  SELECT {zip_code('b')}, {zip_code('a')}, 1.05::DOUBLE * {miles('a', 'b')}
  FROM (SELECT k AS a, unnest(range(101, 106)) AS b FROM fx_dcs WHERE k % 2 = 0)"""
BLOCKS["fx_postal"] = f"""
  SELECT {zip_code('k')} AS postal_code, CAST({lon('k')} AS DOUBLE) AS longitude, CAST({lat('k')} AS DOUBLE) AS latitude
  FROM fx_nodes WHERE k <> 74
  UNION ALL SELECT '99907', CAST({lon('7')} AS DOUBLE), CAST({lat('7')} AS DOUBLE)"""
BLOCKS["fx_manual"] = f"""
  SELECT 'SRS_' || k AS o_id, 'DC74' AS d_id, {zip_code('k')} AS o_zip, {zip_code('74')} AS d_zip, 777.0::DOUBLE AS dist
  FROM fx_priorities"""
BLOCKS["fx_rates"] = """
  SELECT o_zip AS ozip, d_zip AS dzip, CASE WHEN NOT (ko = 101 AND kd = 122) THEN 3 * distance END AS rate
  FROM fx_partner WHERE dest_id IS NOT NULL AND ((ko + kd) % 3 = 0 OR (ko = 101 AND kd = 122))"""
BLOCKS["fx_dedicated"] = """
  SELECT 'DC' || k AS dc_nbr, (1.0::DOUBLE + 0.1::DOUBLE * (k % 5)) + unnest([-0.1::DOUBLE, 0.1::DOUBLE]) AS per_mile,
         50.0::DOUBLE + k AS per_stop, 40.0::DOUBLE + k % 7 AS per_hour
  FROM fx_dcs WHERE k % 11 <> 0"""

# ------------------------------------------------------------------ legs

FACILITY = "o_id, o_type, o_zip, o_city, o_state, d_id, d_type, d_zip, d_city, d_state"
OWNER = "region, campus_nbr_nm, dc_nbr, scac"

BLOCKS["empty_demand"] = """
  SELECT c.campus AS region, c.campus_nbr_nm, h.dc_nbr, c.scac,
         l.o_id, l.o_type, l.o_zip, po.city AS o_city, po.state AS o_state,
         coalesce(m.new_nbr, l.d_id) AS d_id, l.d_type, l.d_zip, pd.city AS d_city, pd.state AS d_state,
         'SO' AS leg, avg(l.mile_cnt) AS dist, CAST(count(*) AS BIGINT) AS loads, CAST(10000 AS BIGINT) AS ow_cost_per_load
  FROM fx_lines l
  JOIN fx_calendar k ON k.cal_dt = coalesce(l.shp_dt, CAST(l.arvl_ts AS DATE), CAST(l.dprt_ts AS DATE))
  LEFT JOIN fx_moves m ON m.old_nbr = l.d_id
  LEFT JOIN fx_invoices h ON h.invoice_id = l.invoice_id
  LEFT JOIN fx_campus c ON c.campus_name = h.dc_nbr
  LEFT JOIN (SELECT DISTINCT * FROM fx_places) po ON po.loc_nbr = l.o_id
  LEFT JOIN (SELECT DISTINCT * FROM fx_places) pd ON pd.loc_nbr = l.d_id
  WHERE k.cal_dt >= DATE '1998-01-01' AND l.ship_type = 25
    AND l.o_type || '-' || l.d_type IN ('STR-BDC', 'STR-FDC', 'STR-FDC/BDC')
  GROUP BY ALL HAVING count(*) >= $min_loads"""
BLOCKS["partner_ok"] = """
  SELECT * FROM fx_partner
  WHERE volume >= 20 AND origin_id IS NOT NULL AND dest_id IS NOT NULL
    AND NOT regexp_matches(o_zip, '[A-Za-z]') AND NOT regexp_matches(d_zip, '[A-Za-z]')"""
_PADDED = "CAST(NULL AS DOUBLE) AS dist, CAST(0 AS BIGINT) AS loads, CAST(10000 AS BIGINT) AS ow_cost_per_load"
BLOCKS["partner_legs_store"] = f"""
  SELECT DISTINCT CAST(NULL AS BIGINT) AS region, CAST(NULL AS VARCHAR) AS campus_nbr_nm, CAST(NULL AS VARCHAR) AS dc_nbr,
         e.scac, e.o_id, e.o_type, e.o_zip, e.o_city, e.o_state,
         'SRS_' || p.origin_id AS d_id, 'SRS1' AS d_type, p.o_zip AS d_zip, p.o_city AS d_city, p.o_state AS d_state,
         'SSRS1' AS leg, {_PADDED}
  FROM empty_demand e, partner_ok p"""
BLOCKS["partner_legs_dc"] = f"""
  SELECT DISTINCT e.region, e.campus_nbr_nm, e.dc_nbr, e.scac,
         e.d_id AS o_id, e.d_type AS o_type, e.d_zip AS o_zip, e.d_city AS o_city, e.d_state AS o_state,
         'SRS_' || p.origin_id AS d_id, 'SRS1' AS d_type, p.o_zip AS d_zip, p.o_city AS d_city, p.o_state AS d_state,
         'OSRS1' AS leg, {_PADDED}
  FROM empty_demand e, partner_ok p"""
BLOCKS["partner_legs_return"] = f"""
  SELECT DISTINCT e.region, e.campus_nbr_nm, e.dc_nbr, e.scac,
         'SRS_' || p.dest_id AS o_id, 'SRS2' AS o_type, p.d_zip AS o_zip, p.d_city AS o_city, p.d_state AS o_state,
         e.d_id, e.d_type, e.d_zip, e.d_city, e.d_state, 'SRS2O' AS leg, {_PADDED}
  FROM empty_demand e, partner_ok p"""
_EMPTY = f"SELECT DISTINCT {OWNER}, {FACILITY}, leg, dist, CAST(0 AS DOUBLE) AS loads, CAST(ow_cost_per_load AS DOUBLE) AS ow_cost_per_load, CAST(0 AS BIGINT) AS loaded_ind FROM"
BLOCKS["input_legs"] = f"""
  {_EMPTY} empty_demand
  UNION ALL
  SELECT DISTINCT {OWNER}, d_id, d_type, d_zip, d_city, d_state, o_id, o_type, o_zip, o_city, o_state, 'OS', dist,
         ceil(loads / 48), CAST(ow_cost_per_load AS DOUBLE), CAST(1 AS BIGINT)
  FROM empty_demand
  UNION ALL {_EMPTY} partner_legs_store
  UNION ALL {_EMPTY} partner_legs_dc
  UNION ALL {_EMPTY} partner_legs_return
  UNION ALL
  SELECT NULL, NULL, NULL, 'BSL', 'SRS_' || origin_id, 'SRS1', o_zip, o_city, o_state,
         'SRS_' || dest_id, 'SRS2', d_zip, d_city, d_state, 'SRS1-SRS2', avg(distance), ceil(max(volume) / 40),
         avg(2.5::DOUBLE * distance), CAST(1 AS BIGINT)
  FROM partner_ok GROUP BY origin_id, o_zip, o_city, o_state, dest_id, d_zip, d_city, d_state"""
BLOCKS["leg_labels"] = """
  SELECT *, o_type || '-' || d_type AS leg_dtl, CASE WHEN starts_with(leg, 'SRS') THEN 'SRS' ELSE 'THD' END AS side
  FROM input_legs"""
BLOCKS["zip_distances"] = "SELECT o_zip, d_zip, avg(dist) AS known FROM fx_distances GROUP BY o_zip, d_zip"
BLOCKS["distance_lookup"] = """
  SELECT l.* REPLACE (coalesce(l.dist, z.known) AS dist)
  FROM leg_labels l LEFT JOIN zip_distances z ON z.o_zip = l.o_zip AND z.d_zip = l.d_zip"""
BLOCKS["distance_reverse"] = """
  SELECT l.* REPLACE (coalesce(l.dist, z.known) AS dist)
  FROM distance_lookup l LEFT JOIN zip_distances z ON z.o_zip = l.d_zip AND z.d_zip = l.o_zip"""
BLOCKS["spots"] = "SELECT postal_code, max(longitude) AS x, max(latitude) AS y FROM fx_postal GROUP BY postal_code"
BLOCKS["distance_geo"] = f"""
  SELECT l.* REPLACE (coalesce(l.dist, CASE WHEN a.x IS NOT NULL AND b.x IS NOT NULL THEN {road('a.x', 'a.y', 'b.x', 'b.y')} END) AS dist)
  FROM distance_reverse l LEFT JOIN spots a ON a.postal_code = l.o_zip LEFT JOIN spots b ON b.postal_code = l.d_zip"""
BLOCKS["missing_distance"] = "SELECT DISTINCT * FROM distance_geo WHERE dist IS NULL OR dist < 0"
BLOCKS["distance_manual"] = """
  SELECT l.* REPLACE (coalesce(l.dist, m.kept) AS dist)
  FROM distance_geo l
  LEFT JOIN (SELECT o_id, d_id, o_zip, d_zip, avg(dist) AS kept FROM fx_manual GROUP BY ALL) m
    ON m.o_id = l.o_id AND m.d_id = l.d_id AND m.o_zip = l.o_zip AND m.d_zip = l.d_zip"""
BLOCKS["quality_gate"] = """
  SELECT CASE WHEN count(*) = 0 THEN CAST(0 AS BIGINT) ELSE CAST(error('missing distances') AS BIGINT) END AS missing
  FROM distance_manual WHERE dist IS NULL"""
BLOCKS["rate_overwrite"] = """
  SELECT l.* REPLACE (CASE WHEN r.ozip IS NULL THEN l.ow_cost_per_load ELSE r.rate END AS ow_cost_per_load)
  FROM distance_manual l LEFT JOIN fx_rates r ON r.ozip = l.o_zip AND r.dzip = l.d_zip"""
BLOCKS["purge_legs"] = """
  SELECT * FROM rate_overwrite
  WHERE NOT coalesce(dist < 0, FALSE) AND dist IS NOT NULL AND ow_cost_per_load IS NOT NULL"""
BLOCKS["edges"] = "SELECT DISTINCT o_id, o_type, o_zip, d_id, d_type, d_zip, leg, leg_dtl, loaded_ind, dist FROM purge_legs"
BLOCKS["lane_numbers"] = """
  SELECT o_id, d_id, o_zip, d_zip,
         CAST(row_number() OVER (ORDER BY o_id NULLS FIRST, d_id NULLS FIRST, o_zip NULLS FIRST, d_zip NULLS FIRST) AS BIGINT)
           AS pair_number
  FROM (SELECT DISTINCT o_id, d_id, o_zip, d_zip FROM edges)"""
BLOCKS["lane_demand"] = """
  SELECT l.side, l.o_id, l.o_type, l.o_zip, upper(l.o_city) AS o_city, l.o_state,
         l.d_id, l.d_type, l.d_zip, upper(l.d_city) AS d_city, l.d_state, n.pair_number,
         avg(l.ow_cost_per_load) AS ow_cost_per_load, l.leg, avg(l.dist) AS dist, floor(avg(l.loads)) AS loads,
         CASE WHEN starts_with(l.leg, 'SRS') THEN 'OW' ELSE 'DED' END AS majority_mode
  FROM purge_legs l
  LEFT JOIN lane_numbers n ON n.o_id = l.o_id AND n.d_id = l.d_id AND n.o_zip = l.o_zip AND n.d_zip = l.d_zip
  WHERE l.loaded_ind = 1 GROUP BY ALL"""

# ------------------------------------------------------------------ tours

LEG = ["origin", "dest", "leg", "dist", "leg_dtl", "ozip", "dzip", "loaded_ind"]
EDGE = dict(zip(LEG, ["o_id", "d_id", "leg", "dist", "leg_dtl", "o_zip", "d_zip", "loaded_ind"]))
TYPES = dict(zip(LEG, ["VARCHAR", "VARCHAR", "VARCHAR", "DOUBLE", "VARCHAR", "VARCHAR", "VARCHAR", "BIGINT"]))


def from_edge(alias: str, slot: str) -> str:
    return ", ".join(f"{alias}.{EDGE[c]} AS {slot}_{c}" for c in LEG)


def slots(*names: str) -> str:
    return ", ".join(f"{s}_{c}" for s in names for c in LEG)


def absent(*names: str) -> str:
    return ", ".join(f"CAST(NULL AS {TYPES[c]}) AS {s}_{c}" for s in names for c in LEG)


def empty_share(names: str) -> str:
    empty = " + ".join(f"CASE WHEN {s}_loaded_ind = 0 THEN {s}_dist ELSE 0 END" for s in names)
    return f"({empty}) / nullif({' + '.join(f'{s}_dist' for s in names)}, 0)"


def stops(names: str) -> str:
    return " + ".join(f"CAST(coalesce({s}_dest IN (SELECT dc FROM campuses), FALSE) AS BIGINT)" for s in names)


BLOCKS["campuses"] = "SELECT DISTINCT campus_name AS dc FROM fx_campus"
BLOCKS["chains2"] = f"""
  SELECT DISTINCT {from_edge('x', 'a')}, {from_edge('y', 'b')}
  FROM edges x JOIN edges y ON y.o_id = x.d_id
  WHERE x.loaded_ind + y.loaded_ind > 0 AND x.dist + y.dist <= 1200"""
BLOCKS["tours2"] = f"""
  SELECT {slots('a', 'b')}, {absent('c', 'd')}, CAST(1 AS BIGINT) AS dc_count, a_dist + b_dist AS total_dist
  FROM chains2 WHERE b_dest = a_origin AND a_origin IN (SELECT dc FROM campuses)"""
BLOCKS["chains3"] = f"""
  SELECT DISTINCT {slots('a', 'b')}, {from_edge('z', 'c')}
  FROM chains2 JOIN edges z ON z.o_id = b_dest
  WHERE a_origin <> b_dest AND b_loaded_ind + z.loaded_ind > 0
    AND z.o_id NOT IN (a_origin, b_origin, a_dest) AND z.d_id NOT IN (a_dest, b_dest, b_origin)
    AND a_dist + b_dist + z.dist <= 1200"""
BLOCKS["tours3"] = f"""
  SELECT {slots('a', 'b', 'c')}, {absent('d')}, 1 + {stops('ab')} AS dc_count, a_dist + b_dist + c_dist AS total_dist
  FROM chains3
  WHERE c_dest = a_origin AND a_origin IN (SELECT dc FROM campuses) AND {empty_share('abc')} < 0.5"""
BLOCKS["tours4"] = f"""
  SELECT * FROM (
    SELECT {slots('a', 'b', 'c')}, {from_edge('w', 'd')}, 1 + {stops('abc')} AS dc_count,
           a_dist + b_dist + c_dist + w.dist AS total_dist
    FROM chains3 JOIN edges w ON w.o_id = c_dest AND w.d_id = a_origin
    WHERE c_loaded_ind + w.loaded_ind > 0 AND a_origin <> c_dest AND a_origin IN (SELECT dc FROM campuses)
      AND w.o_id NOT IN (a_origin, b_origin, c_origin, a_dest, b_dest)
      AND w.d_id NOT IN (a_dest, b_dest, c_dest, b_origin, c_origin))
  WHERE total_dist <= 1200 AND contains(a_leg || b_leg || c_leg || d_leg, 'SRS')
    AND {empty_share('abcd')} < 0.5 AND {stops('abc')} < 3"""
BLOCKS["tours_all"] = """
  SELECT *, 'D' AS mode FROM tours2 UNION ALL BY NAME SELECT *, 'D' AS mode FROM tours3
  UNION ALL BY NAME SELECT *, 'D' AS mode FROM tours4"""
BLOCKS["tours_dc_homed"] = """
  SELECT * FROM tours_all
  WHERE a_leg_dtl IS NULL OR split_part(a_leg_dtl, '-', 1) IN ('FDC', 'BDC', 'FDC/BDC', 'BDC/FDC')"""
BLOCKS["home_rates"] = "SELECT dc_nbr, avg(per_mile) AS v, avg(per_stop) AS s, avg(per_hour) AS f FROM fx_dedicated GROUP BY dc_nbr"


def cost(d: str) -> str:
    hours = (
        f"CASE WHEN {d} > 100 THEN 2.667::DOUBLE + ({d} - 100) / 65 WHEN {d} > 50 THEN 1.667::DOUBLE + ({d} - 50) / 50"
        f" WHEN {d} IS NOT NULL THEN greatest(0.33::DOUBLE, {d} / 30) END"
    )
    return f"coalesce({d} * r.v + {d} * 0.4::DOUBLE + r.s + ({hours}) * r.f, 0)"


BLOCKS["tour_cost"] = f"""
  SELECT t.*, {' + '.join(cost(f't.{s}_dist') for s in 'abcd')} AS rf_cost
  FROM tours_dc_homed t LEFT JOIN home_rates r ON r.dc_nbr = t.a_origin"""
BLOCKS["tour_lanes"] = """
  SELECT t.*, """ + ", ".join(f"q{i}.pair_number AS pair_nbr{i}" for i in range(1, 5)) + """
  FROM tour_cost t """ + " ".join(
    f"LEFT JOIN lane_numbers q{i} ON q{i}.o_id = t.{s}_origin AND q{i}.d_id = t.{s}_dest" for i, s in enumerate("abcd", 1)
)
ORDER = ["a_origin"] + [f"{s}_{c}" for c in ("dest", "leg", "ozip", "dzip", "leg_dtl", "dist") for s in "abcd"] + [
    f"pair_nbr{i}" for i in range(1, 5)
]
BLOCKS["tours_final"] = f"""
  SELECT *, a_origin AS home_dc,
         CAST(row_number() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in ORDER)}) AS BIGINT) AS route_nbr
  FROM tour_lanes"""

# ------------------------------------------------------------------ matching

BLOCKS["model_lanes"] = "SELECT DISTINCT pair_number, loads, ow_cost_per_load AS ow_cpl FROM lane_demand"
BLOCKS["model_routes"] = "SELECT route_nbr, home_dc, " + ", ".join(
    f"CASE WHEN {s}_loaded_ind = 1 THEN pair_nbr{i} END AS lane_{i}" for i, s in enumerate("abcd", 1)
) + ", total_dist, rf_cost AS cost, mode FROM tours_final"
BLOCKS["must_cover"] = """
  SELECT DISTINCT pair_number FROM lane_demand
  WHERE d_type = 'STR' AND o_type IN ('BDC', 'FDC', 'FDC/BDC', 'BDC/FDC')"""
BLOCKS["partner_lanes"] = "SELECT DISTINCT pair_number FROM lane_demand WHERE starts_with(leg, 'SRS')"
BLOCKS["lane_model"] = """
  SELECT pair_number AS lane, CAST(loads AS BIGINT) AS demand, ow_cost_per_load AS ow_cpl,
         pair_number IN (SELECT pair_number FROM must_cover) AS must_cover,
         pair_number IN (SELECT pair_number FROM partner_lanes) AS partner
  FROM (SELECT *, row_number() OVER (PARTITION BY pair_number ORDER BY ow_cost_per_load, loads DESC) AS nth
        FROM lane_demand WHERE pair_number IS NOT NULL) WHERE nth = 1"""
BLOCKS["incidence"] = " UNION ".join(
    f"SELECT route_nbr, lane_{i} AS lane FROM model_routes WHERE lane_{i} IS NOT NULL" for i in range(1, 5)
)
BLOCKS["net_cost"] = """
  SELECT r.route_nbr, r.cost, r.cost - coalesce(sum(m.ow_cpl), 0) AS net
  FROM model_routes r LEFT JOIN incidence i ON i.route_nbr = r.route_nbr
  LEFT JOIN lane_model m ON m.lane = i.lane AND m.partner GROUP BY r.route_nbr, r.cost"""
BLOCKS["uncovered"] = """
  SELECT lane, demand FROM lane_model
  WHERE must_cover AND demand > 0 AND lane NOT IN (SELECT lane FROM incidence)"""
BLOCKS["lane_issues"] = """
  SELECT (SELECT count(*) FROM (SELECT pair_number FROM lane_demand WHERE pair_number IS NOT NULL
                                GROUP BY 1 HAVING count(*) > 1)) AS repeated_lanes,
         (SELECT count(*) FROM lane_demand WHERE pair_number IS NULL) AS unnumbered_rows,
         (SELECT count(DISTINCT lane) FROM incidence WHERE lane NOT IN (SELECT pair_number FROM lane_demand))
           AS lanes_without_demand"""
# the tours one by one in the order (gain, lowest number), then the fallback of each store lane
BLOCKS["fallback"] = """
  SELECT i.lane, arg_min(n.route_nbr, (n.net, n.route_nbr)) AS route_nbr, min(n.net) AS base
  FROM net_cost n JOIN incidence i USING (route_nbr) JOIN lane_model m ON m.lane = i.lane AND m.must_cover
  WHERE (SELECT count(*) FROM incidence j WHERE j.route_nbr = n.route_nbr) = 1 GROUP BY i.lane"""
BLOCKS["lane_value"] = """
  SELECT i.lane, coalesce(any_value(f.base), max(n.net)) AS value, CAST(any_value(f.base) IS NULL AS INTEGER) AS urgent
  FROM net_cost n JOIN incidence i USING (route_nbr) JOIN lane_model m ON m.lane = i.lane AND m.must_cover
  LEFT JOIN fallback f ON f.lane = i.lane GROUP BY i.lane"""
BLOCKS["ranked"] = """
  SELECT *, row_number() OVER (ORDER BY urgent DESC, gain DESC, route_nbr) AS nth FROM (
    SELECT n.route_nbr, coalesce(max(v.urgent), 0) AS urgent, coalesce(sum(v.value), 0) - n.net AS gain,
           list(m.lane ORDER BY m.lane) AS on_lanes
    FROM net_cost n JOIN incidence i USING (route_nbr) JOIN lane_model m ON m.lane = i.lane
    LEFT JOIN lane_value v ON v.lane = i.lane GROUP BY n.route_nbr, n.net)
  WHERE gain > 0 OR urgent = 1"""
BLOCKS["steps"] = """
  SELECT CAST(0 AS BIGINT) AS nth, CAST(NULL AS BIGINT) AS route_nbr, CAST(0 AS BIGINT) AS loads,
         (SELECT map_from_entries(list((lane, demand))) FROM lane_model) AS room
  UNION ALL
  SELECT nth, route_nbr, n,
         map_from_entries(list_transform(map_entries(room), lambda e:
             struct_pack(k := e.key, v := CASE WHEN list_contains(on_lanes, e.key) THEN e.value - n ELSE e.value END)))
  FROM (SELECT r.nth, r.route_nbr, s.room, r.on_lanes,
               list_min(list_transform(r.on_lanes, lambda l: s.room[l])) AS n
        FROM steps s JOIN ranked r ON r.nth = s.nth + 1)"""
BLOCKS["greedy"] = "SELECT route_nbr, loads FROM steps WHERE loads > 0"
BLOCKS["assignment"] = """
  SELECT route_nbr, loads FROM greedy
  UNION ALL
  SELECT f.route_nbr, m.demand - coalesce(c.covered, 0)
  FROM fallback f JOIN lane_model m ON m.lane = f.lane
  LEFT JOIN (SELECT lane, CAST(sum(loads) AS BIGINT) AS covered FROM greedy JOIN incidence USING (route_nbr) GROUP BY lane) c
    ON c.lane = f.lane
  WHERE m.demand > coalesce(c.covered, 0)"""
BLOCKS["lane_use"] = """
  SELECT m.lane, m.must_cover, m.demand, CAST(coalesce(sum(a.loads), 0) AS BIGINT) AS dedicated
  FROM lane_model m LEFT JOIN (incidence i JOIN assignment a USING (route_nbr)) ON i.lane = m.lane
  GROUP BY m.lane, m.must_cover, m.demand"""
BLOCKS["assignment_audit"] = """
  SELECT lane, must_cover, demand, dedicated, demand - dedicated AS one_way, dedicated > demand AS over,
         must_cover AND dedicated < demand AS short FROM lane_use"""
BLOCKS["audit_totals"] = """
  SELECT count(*) FILTER (over) AS lanes_over, count(*) FILTER (short) AS lanes_short,
         count(*) FILTER (short AND lane IN (SELECT lane FROM incidence)) AS coverable_short,
         CAST(coalesce(sum(one_way) FILTER (short), 0) AS BIGINT) AS loads_short,
         (SELECT sum(loads * net) FROM assignment JOIN net_cost USING (route_nbr)) AS objective,
         (SELECT count(*) FROM assignment WHERE loads < 0) AS bad_loads
  FROM assignment_audit"""
BLOCKS["tour_sides"] = """
  SELECT r.route_nbr, r.gain, max(m.lane) FILTER (m.must_cover) AS store, max(m.lane) FILTER (NOT m.must_cover) AS other
  FROM (SELECT route_nbr, gain, unnest(on_lanes) AS lane FROM ranked) r JOIN lane_model m ON m.lane = r.lane
  GROUP BY r.route_nbr, r.gain"""


def _price(wanted: str, given: str, prices: str | None) -> str:
    paid = f"LEFT JOIN {prices} q ON q.lane = t.{given}" if prices else ""
    rest = "t.gain - coalesce(q.price, 0)" if prices else "t.gain"
    return (
        f"SELECT t.{wanted} AS lane, greatest(max({rest}), 0) AS price FROM tour_sides t {paid}"
        f" WHERE t.{wanted} IS NOT NULL GROUP BY t.{wanted}"
    )


BLOCKS["other_first"] = _price("other", "store", None)
BLOCKS["store_second"] = _price("store", "other", "other_first")
BLOCKS["store_first"] = _price("store", "other", None)
BLOCKS["other_second"] = _price("other", "store", "store_first")
BLOCKS["taken"] = """
  SELECT t.store AS lane, greatest(min(t.gain), 0) AS price
  FROM tour_sides t JOIN greedy g ON g.route_nbr = t.route_nbr JOIN lane_model m ON m.lane = t.store
  GROUP BY t.store, m.demand HAVING sum(g.loads) = m.demand"""
BLOCKS["other_taken"] = _price("other", "store", "taken")
BLOCKS["store_taken"] = _price("store", "other", "other_taken")
BLOCKS["worths"] = " UNION ALL ".join(
    f"SELECT coalesce(sum(price * demand), 0) AS worth FROM"
    f" (SELECT * FROM {a} UNION ALL SELECT * FROM {b}) JOIN lane_model USING (lane)"
    for a, b in (("other_first", "store_second"), ("store_first", "other_second"), ("other_taken", "store_taken"))
)
BLOCKS["matching_gap"] = """
  SELECT objective, bound, (objective - bound) / abs(objective) AS gap, coverable_short,
         coverable_short = 0 AND objective - bound <= 0.01 * abs(objective) AS within_target
  FROM (SELECT (SELECT coverable_short FROM audit_totals) AS coverable_short, (SELECT sum(loads * net) FROM assignment JOIN net_cost USING (route_nbr)) AS objective,
               (SELECT sum(value * demand) FROM lane_value JOIN lane_model USING (lane)) - (SELECT min(worth) FROM worths) AS bound)"""
BLOCKS["oneway_remainder"] = """
  SELECT CAST(lane AS VARCHAR) AS pair_number, demand - dedicated AS loads, 'backhaul matching' AS description
  FROM lane_use WHERE demand <> dedicated"""
BLOCKS["cost_summary"] = """
  SELECT CAST(NULL AS VARCHAR) AS region,
         (SELECT sum(loads * cost) FROM assignment JOIN model_routes USING (route_nbr)) AS dedicated_cost,
         (SELECT sum((demand - dedicated) * ow_cpl) FROM lane_use JOIN lane_model USING (lane, demand)) AS ow_cost,
         (SELECT sum(loads * net) FROM assignment JOIN net_cost USING (route_nbr)) AS total_cost,
         'backhaul matching' AS description"""
BLOCKS["run_counts"] = """
  SELECT (SELECT count(*) FROM lane_model) AS demand_lanes, (SELECT count(*) FROM model_routes) AS route_choices,
         (SELECT count(*) FROM assignment) AS routes_chosen, (SELECT count(*) FROM oneway_remainder) AS one_way_lanes"""

# ------------------------------------------------------------------ reports

BLOCKS["chosen_tours"] = """
  SELECT a.route_nbr, a.loads, 'backhaul matching' AS description, r.home_dc, r.cost, r.total_dist AS dist, r.mode,
         '2024-05-01' AS run_date, '10:00' AS run_time
  FROM assignment a LEFT JOIN model_routes r ON r.route_nbr = a.route_nbr"""
# every tour with the most loads it could carry alone: all tour shapes reach the reports
BLOCKS["whatif_tours"] = """
  SELECT r.route_nbr, w.loads, 'backhaul matching' AS description, r.home_dc, r.cost, r.total_dist AS dist, r.mode,
         '2024-05-01' AS run_date, '10:00' AS run_time
  FROM model_routes r
  JOIN (SELECT i.route_nbr, min(m.demand) AS loads FROM incidence i JOIN lane_model m USING (lane) GROUP BY 1) w
    ON w.route_nbr = r.route_nbr AND w.loads <> 0"""
_TOUR = slots("a", "b", "c", "d")


def _report(plan: str, suffix: str) -> None:
    loaded = " + ".join(f"coalesce(t.{s}_loaded_ind * t.{s}_dist, 0)" for s in "abcd")
    places = ", ".join(
        f"n{i}.o_city AS {s}_ocity, n{i}.d_city AS {s}_dcity, n{i}.o_state AS {s}_ostate, n{i}.d_state AS {s}_dstate,"
        f" n{i}.ow_cost_per_load AS leg{i}_ow_cost"
        for i, s in enumerate("abcd", 1)
    )
    joins = " ".join(f"LEFT JOIN lane_demand n{i} ON n{i}.pair_number = t.pair_nbr{i}" for i in range(1, 5))
    BLOCKS[f"routes_lanes{suffix}"] = f"""
      SELECT p.*, t.* EXCLUDE (route_nbr, mode, home_dc), ({loaded}) / nullif(t.total_dist, 0) AS loaded_pct, {places}
      FROM {plan} p LEFT JOIN tours_final t ON t.route_nbr = p.route_nbr {joins}"""
    credit = " + ".join(f"CASE WHEN {s}_leg = 'SRS1-SRS2' THEN leg{i}_ow_cost ELSE 0 END" for i, s in enumerate("abcd", 1))
    BLOCKS[f"tour_baseline{suffix}"] = f"""
      SELECT *, CASE a_loaded_ind WHEN 1 THEN 2 * a_dist * cost / nullif(total_dist, 0) ELSE 0 END AS baseline_cost,
             {credit} AS partner_credit
      FROM routes_lanes{suffix}"""
    extra = ", ".join(
        f"{s}_ocity, {s}_dcity, {s}_ostate, {s}_dstate, leg{i}_ow_cost" for i, s in enumerate("abcd", 1)
    )
    BLOCKS[f"tour_savings{suffix}"] = f"""
      SELECT home_dc, c.campus_nbr_nm, c.scac, route_nbr, loads AS ded_loads, mode, total_dist, {_TOUR}, {extra},
             pair_nbr1, pair_nbr2, pair_nbr3, pair_nbr4, loaded_pct, baseline_cost, partner_credit, rf_cost,
             baseline_cost - (rf_cost - partner_credit) AS savings_per_load,
             (baseline_cost - (rf_cost - partner_credit)) * loads AS total_savings_per_week,
             rf_cost - partner_credit AS effective_rt_cost, total_dist - 2 * a_dist AS oor_dist
      FROM tour_baseline{suffix} LEFT JOIN fx_campus c ON c.campus_name = home_dc"""
    text = " || ".join(
        f"CASE {s}_loaded_ind WHEN 1 THEN '->' WHEN 0 THEN '-' ELSE '' END || coalesce({s}_dest, '')" for s in "abcd"
    )
    BLOCKS[f"tour_text{suffix}"] = f"""
      SELECT *, coalesce(a_origin, '') || {text} AS route_dtl, savings_per_load / nullif(baseline_cost, 0) AS savings_pct
      FROM tour_savings{suffix}"""
    measures = "route_nbr, ded_loads, savings_per_load, effective_rt_cost, loaded_pct, savings_pct, oor_dist"
    BLOCKS[f"lane_tour_unpivot{suffix}"] = " UNION ALL ".join(
        f"SELECT pair_nbr{i} AS pair_nbr1, {measures} FROM tour_text{suffix}"
        f" WHERE {s}_loaded_ind = 1 AND pair_nbr{i} IS NOT NULL"
        for i, s in enumerate("abcd", 1)
    )
    BLOCKS[f"lane_rollup{suffix}"] = f"""
      SELECT pair_nbr1, string_agg(CAST(route_nbr AS VARCHAR), ', ' ORDER BY route_nbr) AS route_nbrs,
             CAST(sum(ded_loads) AS BIGINT) AS model_ded_loads,
             sum(oor_dist * ded_loads) / nullif(sum(ded_loads), 0) AS avg_oor_miles,
             avg(effective_rt_cost) AS avg_effective_rt_cost, avg(savings_per_load) AS avg_savings_per_load,
             avg(loaded_pct) AS avg_loaded_pct,
             sum(ded_loads * savings_pct) / nullif(sum(ded_loads), 0) AS avg_savings_pct
      FROM lane_tour_unpivot{suffix} GROUP BY pair_nbr1"""
    BLOCKS[f"lane_report{suffix}"] = f"""
      SELECT d.side, d.pair_number, {', '.join('d.' + c.strip() for c in FACILITY.split(','))}, d.leg, d.dist,
             d.loads AS model_loads, coalesce(r.model_ded_loads, 0) AS model_ded_loads,
             d.loads - coalesce(r.model_ded_loads, 0) AS model_ow_loads, d.ow_cost_per_load, r.route_nbrs,
             r.avg_effective_rt_cost, r.avg_savings_per_load, r.avg_loaded_pct, r.avg_savings_pct
      FROM lane_demand d LEFT JOIN lane_rollup{suffix} r ON r.pair_nbr1 = d.pair_number"""


_report("chosen_tours", "")
_report("whatif_tours", "_whatif")

_LEGS = ["dist", "ow_cost_per_load"]
_TOURS = ["a_dist", "b_dist", "c_dist", "d_dist", "total_dist"]
_WIDE = [*_TOURS, *(f"leg{i}_ow_cost" for i in range(1, 5)), "rf_cost", "loaded_pct"]
_CREDIT = [*_WIDE, "baseline_cost", "partner_credit"]
_SAVED = [*_CREDIT, "savings_per_load", "total_savings_per_week", "effective_rt_cost", "oor_dist"]
_MEANS = ["avg_effective_rt_cost", "avg_savings_per_load", "avg_loaded_pct", "avg_savings_pct"]

# doubles of each query's result, compared at six digits
DOUBLES: dict[str, list[str]] = {
    "empty_demand": ["dist"],
    **dict.fromkeys(["partner_legs_store", "partner_legs_dc", "partner_legs_return", "edges"], ["dist"]),
    **dict.fromkeys(
        ["input_legs", "leg_labels", "distance_lookup", "distance_reverse", "distance_geo", "missing_distance",
         "distance_manual", "rate_overwrite", "purge_legs", "lane_demand"], _LEGS,
    ),
    "chains2": _TOURS[:2],
    "chains3": _TOURS[:3],
    **dict.fromkeys(["tours2", "tours3", "tours4", "tours_all", "tours_dc_homed"], _TOURS),
    **dict.fromkeys(["tour_cost", "tour_lanes", "tours_final"], [*_TOURS, "rf_cost"]),
    "model_lanes": ["ow_cpl"],
    "model_routes": ["total_dist", "cost"],
    "lane_model": ["ow_cpl"],
    "net_cost": ["cost", "net"],
    "audit_totals": ["objective"],
    "matching_gap": ["objective", "bound", "gap"],
    "cost_summary": ["dedicated_cost", "ow_cost", "total_cost"],
    "chosen_tours": ["cost", "dist"],
}
for _suffix in ("", "_whatif"):
    DOUBLES |= {
        f"routes_lanes{_suffix}": [*_WIDE, "cost", "dist"],
        f"tour_baseline{_suffix}": [*_CREDIT, "cost", "dist"],
        f"tour_savings{_suffix}": _SAVED,
        f"tour_text{_suffix}": [*_SAVED, "savings_pct"],
        f"lane_tour_unpivot{_suffix}": ["savings_per_load", "effective_rt_cost", "loaded_pct", "savings_pct", "oor_dist"],
        f"lane_rollup{_suffix}": ["avg_oor_miles", *_MEANS],
        f"lane_report{_suffix}": [*_LEGS, *_MEANS],
    }


def _needed(name: str, given: tuple[str, ...]) -> list[str]:
    seen: set[str] = set()

    def visit(block: str) -> None:
        if block in seen or block in given:
            return
        seen.add(block)
        for word in set(re.findall(r"[a-z_0-9]+", BLOCKS[block])):
            if word in BLOCKS:
                visit(word)

    visit(name)
    return [b for b in BLOCKS if b in seen]


def statement(name: str, given: tuple[str, ...] = (), min_loads: int = 10) -> str:
    """The whole statement for one query; doubles are compared at six digits.

    Blocks in ``given`` are taken to exist as tables.
    """
    parts = ",\n".join(
        f"{b} AS ({BLOCKS[b]})" if b == "steps" else f"{b} AS MATERIALIZED ({BLOCKS[b]})" for b in _needed(name, given)
    )
    rounded = ", ".join(f"CASE WHEN abs({c}) < 5e-7 THEN 0 ELSE round({c}, 6) END AS {c}" for c in DOUBLES.get(name, []))
    columns = f"* REPLACE ({rounded})" if rounded else "*"
    return f"WITH RECURSIVE {parts}\nSELECT {columns} FROM {name}".replace("$min_loads", str(min_loads))
