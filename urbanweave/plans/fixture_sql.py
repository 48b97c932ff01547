"""The derived map tables as SQL common table expressions, for the side-by-side checks."""

from __future__ import annotations

_CTES = {
    "w": "SELECT CAST(ceil(sqrt(12.0 * count(*))) AS BIGINT) AS w FROM orders",
    "n": "SELECT CAST(ceil(sqrt(count(*))) AS BIGINT) AS n FROM events",
    "items": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
          row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS k
        FROM lineitem""",
    "starts": """
        SELECT o_orderkey AS way_id, k,
          (o_orderkey * 31 + o_custkey * 17) % w AS sx, (o_custkey * 13 + o_orderkey // 7) % w AS sy,
          CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 2 THEN -1 ELSE 0 END AS dx,
          CASE o_orderkey % 4 WHEN 1 THEN 1 WHEN 3 THEN -1 ELSE 0 END AS dy
        FROM items JOIN orders ON l_orderkey = o_orderkey, w""",
    "way_nodes": """
        SELECT way_id, k AS seq,
          50 * CASE WHEN way_id % 3 <> 0 OR k <= 2 THEN sx + k * dx ELSE sx + 2 * dx - (k - 2) * dy END AS x,
          50 * CASE WHEN way_id % 3 <> 0 OR k <= 2 THEN sy + k * dy ELSE sy + 2 * dy + (k - 2) * dx END AS y
        FROM starts""",
    "sizes": "SELECT way_id, count(*) AS n_vertices FROM way_nodes GROUP BY way_id HAVING count(*) >= 2",
    "way_tags": """
        SELECT o_orderkey AS way_id,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'motorway' WHEN '2-HIGH' THEN 'primary'
            WHEN '3-MEDIUM' THEN 'secondary' WHEN '4-NOT SPECIFIED' THEN 'residential' ELSE 'footway' END AS highway,
          CASE o_orderkey % 5 WHEN 0 THEN '2' WHEN 1 THEN '2;3' END AS lanes,
          CASE o_orderkey % 7 WHEN 0 THEN '7.5 m' WHEN 1 THEN 'wide' END AS width_tag,
          CASE WHEN o_orderstatus = 'F' THEN 'yes' END AS oneway,
          CASE WHEN o_orderkey % 2 = 0 THEN '復興路' || CAST(o_custkey % 97 AS VARCHAR) END AS name,
          CASE WHEN o_orderkey % 211 = 0 THEN 'roundabout' END AS junction
        FROM orders""",
    "roads": """
        SELECT t.*, n_vertices, 50.0e0 * (n_vertices - 1) AS len,
          CAST(CASE WHEN width_tag = '7.5 m' THEN 7.5 WHEN lanes = '2' THEN 7.0
            ELSE CASE highway WHEN 'motorway' THEN 22 WHEN 'primary' THEN 12 WHEN 'secondary' THEN 9
              WHEN 'residential' THEN 6 ELSE 2 END END AS DOUBLE) AS width,
          CASE highway WHEN 'motorway' THEN 0 WHEN 'primary' THEN 2 WHEN 'secondary' THEN 3
            WHEN 'residential' THEN 5 ELSE 7 END AS road_rank,
          highway <> 'footway' AS motor,
          highway IN ('motorway', 'primary', 'secondary') AS major
        FROM way_tags t JOIN sizes USING (way_id)""",
    "segs": """
        SELECT way_id, seq, x AS xa, y AS ya,
          lead(x) OVER (PARTITION BY way_id ORDER BY seq) AS xb, lead(y) OVER (PARTITION BY way_id ORDER BY seq) AS yb
        FROM way_nodes QUALIFY lead(x) OVER (PARTITION BY way_id ORDER BY seq) IS NOT NULL""",
    "degree": """
        SELECT x, y, count(*) AS degree FROM (
          SELECT xa AS x, ya AS y FROM segs UNION ALL SELECT xb, yb FROM segs) GROUP BY x, y""",
    "boxes": """
        SELECT l_orderkey * 64 + k AS osm_id, l_orderkey, l_linenumber, l_partkey, l_suppkey,
          50 * ((l_partkey * 37 + l_orderkey * 11) % w) + 5 + l_suppkey % 40 AS cx,
          50 * ((l_partkey * 53 + l_orderkey * 29 + k * 7) % w) + 5 + 6 * l_linenumber AS cy,
          3 + CAST(trunc(l_quantity) AS BIGINT) % 12 AS hw, 3 + l_linenumber AS hd
        FROM items, w""",
    "buildings": """
        SELECT osm_id, cx - hw AS x0, cx + hw AS x1, cy - hd AS y0, cy + hd AS y1,
          CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_partkey % 25 AS VARCHAR) END AS levels,
          CASE WHEN l_linenumber = 3 THEN '18.4 m' END AS height_tag, l_suppkey % 9 = 0 AS shop,
          CAST(CASE WHEN l_linenumber % 3 <> 0 THEN greatest(1, l_partkey % 25)
            WHEN l_linenumber = 3 THEN 6 ELSE 3 END AS INTEGER) AS floors
        FROM boxes""",
    "areas": """
        SELECT p_partkey AS osm_id, 50 * ((p_partkey * 37) % w) + 25 - p_size AS x0,
          50 * ((p_partkey * 37) % w) + 25 + p_size AS x1, 50 * ((p_partkey * 53) % w) + 25 - p_size AS y0,
          50 * ((p_partkey * 53) % w) + 25 + p_size AS y1,
          CASE WHEN p_size % 3 = 0 THEN 'water' END AS natural_tag,
          CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_type LIKE '%SMALL%' THEN 'forest' WHEN p_type LIKE '%LARGE%' THEN 'grass'
            WHEN p_type LIKE '%MEDIUM%' THEN 'meadow' END AS landuse
        FROM part, w""",
    "trees": """
        SELECT event_id AS osm_id, event_type, (event_id * 13) % (50 * w) AS x, (event_id * 29 + user_id) % (50 * w) AS y
        FROM events, w""",
    "px": """
        SELECT event_id // n AS "row", event_id % n AS col,
          CAST(CASE WHEN (event_id // n // 6 + event_id % n // 9) % 3 <> 0 AND event_id % 97 <> 0 THEN 254
            WHEN event_type = 'purchase' THEN 205 ELSE 0 END AS INTEGER) AS v,
          100.0e0 + 0.8e0 * (value - 10.0e0 * floor(value / 10.0e0)) AS z
        FROM events, n""",
    "assets": """
        SELECT page_id, 'asset_' || CAST(page_id - CASE WHEN page_id % 50 = 1 THEN 1 ELSE 0 END AS VARCHAR) AS id,
          (['shop', 'office', 'church', 'apartment', 'restaurant', 'shutter', 'factory', 'building_front',
            'windows', 'dock', 'garage', 'house'])[page_id % 12 + 1] || '_' || CAST(page_id % 10 AS VARCHAR) || '.JPG' AS file,
          (['CC0', 'CC BY 4.0', 'CC BY-SA 4.0', 'Public domain'])[page_id % 4 + 1] AS license,
          (['east_asia', 'generic', 'low_rise', 'sheets', 'signage', 'details', 'attic'])[page_id // 2 % 7 + 1] AS bucket,
          (['facade', 'roof', 'decal', 'facade', 'floor'])[page_id // 3 % 5 + 1] AS part,
          (['shop', 'vertical', 'overlay', 'window', 'office', 'full', NULL])[page_id % 7 + 1] AS role,
          (['low', 'mid', 'high', 'tower', NULL, 'sky'])[page_id % 6 + 1] AS suggested_band,
          (['glass curtain', 'brick wall', 'metal sheet', 'balcony tiles', 'shutter door', 'plain',
            'corrugated'])[page_id // 5 % 7 + 1] AS notes,
          page_id * 37 % 1500 AS bytes, 400 + page_id * 37 % 1200 AS width, 400 + page_id * 53 % 1200 AS height,
          'File:' || CASE WHEN page_id % 29 = 0 THEN 'Habs ' ELSE '' END || CAST(page_id // 3 AS VARCHAR) AS title,
          CASE WHEN page_id % 2 = 0 THEN 'vertical shop sign' ELSE 'building facade' END AS query, html
        FROM pages""",
    "files": """
        SELECT CAST(c_nationkey AS BIGINT) AS scene, CAST(abs(round_even(c_acctbal * 100, 0)) AS BIGINT) AS length,
          (['osm/a', 'osm/b', 'c', 'd', 'dem/e', 'dem/sub/f', 'imagery/g', 'imagery/h', 'i', 'readme'])[c_custkey % 10 + 1]
          || CAST(c_custkey AS VARCHAR)
          || (['.osm.pbf', '.osm', '.osm.pbf', '.osm', '.tif', '.TIFF', '.png', '.tif', '.tif', '.txt'])[c_custkey % 10 + 1]
          AS path
        FROM customer""",
    "scenes": """
        SELECT c_custkey AS c,
          121.5e0 + (c % 5) * 0.01e0 AS ow, 25.0e0 + (c % 3) * 0.01e0 AS os,
          ow + (1 + c % 4) * 0.01e0 AS oe, os + (1 + c % 3) * 0.01e0 AS "on", c % 13 <> 0 AS has_osm,
          121.5e0 + (c % 6) * 0.01e0 AS dw, 25.0e0 + (c % 4) * 0.01e0 AS ds,
          dw + (1 + c % 5) * 0.01e0 AS de, ds + (1 + c % 4) * 0.01e0 AS dn, c % 11 <> 0 AS has_dem,
          121.5e0 + (c % 7) * 0.01e0 AS iw, 25.0e0 + (c % 2) * 0.01e0 AS "is",
          iw + (1 + c % 6) * 0.01e0 AS ie, "is" + (1 + c % 5) * 0.01e0 AS "in", c % 4 = 0 AS has_ortho,
          121.5e0 + (c % 2) * 0.01e0 AS ew, 25.0e0 + (c % 2) * 0.01e0 AS es,
          ew + (1 + c % 2) * 0.01e0 AS ee, es + (1 + c % 2) * 0.01e0 AS en,
          CASE c % 7 WHEN 0 THEN 'osm_bbox' WHEN 1 THEN 'dem_bounds' WHEN 2 THEN 'explicit' ELSE 'auto' END AS mode,
          CASE WHEN c % 3 = 0 THEN 0.01e0 ELSE 0.0e0 END AS pad,
          c % 2 = 0 AS fail_disjoint, c % 5 = 0 AS fail_partial, c % 10 = 3 AS allow
        FROM customer""",
    "points": """
        SELECT event_id AS point_id, -179.5e0 + (event_id * 7919 % 35900) * 0.01e0 AS lon,
          -79.0e0 + ((event_id * 104729 + user_id) % 15800) * 0.01e0 AS lat FROM events""",
}
_NEEDS = {
    "items": [], "starts": ["items", "w"], "way_nodes": ["starts"], "sizes": ["way_nodes"], "way_tags": [],
    "roads": ["way_tags", "sizes"], "segs": ["way_nodes"], "degree": ["segs"], "boxes": ["items", "w"],
    "buildings": ["boxes"], "areas": ["w"], "trees": ["w"], "px": ["n"],
}


def with_tables(names: str, body: str) -> str:
    """SQL ``body`` behind the named derived tables and what they build on; ``body`` may go on with more of them."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{name} AS ({_CTES[name]})" for name in ordered)
    body = body.strip()
    joint = ",\n" if body.startswith("AND ") else "\n"
    return f"WITH {ctes}{joint}{body.removeprefix('AND ')}"
