"""The same results as ``queries``, in SQL over the raw tables."""

from __future__ import annotations

from workloads.views import PAIRS

VIEWS = {
    "place": """
        SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) AS nation_id, n_name AS nation_name,
               CAST(r_regionkey AS VARCHAR) AS region_id, r_name AS region_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "cust": """
        SELECT o_orderkey AS unit_id, nation_id, nation_name, region_id, region_name, c_mktsegment AS segment,
               c_custkey AS atom_id, o_orderpriority AS category, o_orderstatus AS status,
               CAST(o_totalprice AS DECIMAL(18,2)) AS price
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN place ON c_nationkey = n_nationkey""",
    "supp": """
        SELECT l.unit_id, nation_id, nation_name, region_id, region_name, o_orderpriority AS category
        FROM (SELECT l_orderkey AS unit_id, min(l_suppkey) AS s FROM lineitem GROUP BY 1) l
        JOIN orders ON o_orderkey = l.unit_id
        JOIN supplier ON s_suppkey = l.s JOIN place ON s_nationkey = n_nationkey""",
    "part_tag": """
        SELECT l.unit_id, CAST(p_partkey AS VARCHAR) AS part_id, p_name AS part_name,
               p_brand AS brand_id, p_type AS type_id
        FROM (SELECT l_orderkey AS unit_id, min(l_partkey) AS p FROM lineitem GROUP BY 1) l
        JOIN part ON p_partkey = l.p""",
    "indicator": """
        SELECT 'nation' AS bdy, nation_id AS region_id, CAST(sum(price) AS DOUBLE) AS value FROM cust GROUP BY 2
        UNION ALL SELECT 'region', region_id, CAST(sum(price) AS DOUBLE) FROM cust GROUP BY 2
        UNION ALL SELECT 'segment', segment, CAST(sum(price) AS DOUBLE) FROM cust
                  WHERE segment <> 'BUILDING' GROUP BY 2""",
    "atom": """
        SELECT c_custkey AS atom_id, (c_custkey * 37 % 1000) / 10.0::DOUBLE AS px,
               (c_custkey * 91 % 1000) / 10.0::DOUBLE AS py, CAST(c_acctbal AS DECIMAL(18,2)) AS balance
        FROM customer""",
    "cell": "SELECT atom_id, floor(px) AS qx, floor(py) AS qy FROM atom",
    "square": """
        SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region,
               20.0::DOUBLE * (n_nationkey % 5) AS x, 20.0::DOUBLE * (n_nationkey // 5) AS y FROM nation""",
    "depot": """
        SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, (s_suppkey * 13 % 90)::DOUBLE AS x,
               (s_suppkey * 29 % 90)::DOUBLE AS y FROM supplier""",
}
_NEEDS = {"cust": ["place"], "supp": ["place"], "indicator": ["place", "cust"], "cell": ["atom"]}


def _with(body: str, *views: str, **extra: str) -> str:
    names: list[str] = []
    for v in views:
        names += [n for n in [*_NEEDS.get(v, []), v] if n not in names]
    parts = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


TABLE = {"cust": "cust", "supp": "supp", "part": "part_tag"}
FIELDS = {
    ("cust", "nation"): ("{t}.nation_id", "{t}.nation_name"),
    ("cust", "region"): ("{t}.region_id", "{t}.region_name"),
    ("cust", "segment"): ("nullif({t}.segment, 'BUILDING')",
                          "concat(nullif({t}.segment, ''), ' ', {t}.region_name)"),
    ("supp", "nation"): ("{t}.nation_id", "{t}.nation_name"),
    ("supp", "region"): ("{t}.region_id", "{t}.region_name"),
    ("part", "part"): ("{t}.part_id", "{t}.part_name"),
    ("part", "brand"): ("{t}.brand_id", "{t}.brand_id"),
    ("part", "type"): ("{t}.type_id", "{t}.type_id"),
}
HOME = "('1-URGENT', '2-HIGH', '3-MEDIUM')"


def _pair(p, where: str | None = None, joins: str = "", rounded: bool = True, positive: bool = True) -> str:
    same = p.from_source == p.to_source
    t = "f" if same else "t"
    fid, fname = (x.format(t="f") for x in FIELDS[p.from_source, p.from_bdy])
    tid, tname = (x.format(t=t) for x in FIELDS[p.to_source, p.to_bdy])
    source = f"{TABLE[p.from_source]} f"
    if not same:
        source += f" JOIN {TABLE[p.to_source]} t ON t.unit_id = f.unit_id"
    if where is None:
        where = ""
        if p.from_source == "supp":
            where = f"AND f.category IN {HOME}"
        elif p.to_source == "supp":
            where = f"AND t.category IN {HOME}"
    percent = "CAST(percent AS DECIMAL(4,1)) AS address_percent" if rounded else "round(percent, 6) AS percent"
    return f"""
        SELECT '{p.from_source}' AS from_source, '{p.from_bdy}' AS from_bdy, from_id, from_name,
               '{p.to_source}' AS to_source, '{p.to_bdy}' AS to_bdy, to_id, to_name, address_count, {percent}
        FROM (SELECT *, address_count::DOUBLE / CAST(sum(address_count) OVER (PARTITION BY from_id) AS DOUBLE)
                        * 100.0 AS percent
              FROM (SELECT {fid} AS from_id, {fname} AS from_name, {tid} AS to_id, {tname} AS to_name,
                           count(*) AS address_count
                    FROM {source} {joins} WHERE {fid} IS NOT NULL AND {tid} IS NOT NULL {where}
                    GROUP BY ALL) agg) final
        {"WHERE percent > 0" if positive else ""}"""


ALL = " UNION ALL ".join(_pair(p) for p in PAIRS)
NESTED = """
    SELECT 'cust' AS from_source, '{a}' AS from_bdy, {aid} AS from_id, {aname} AS from_name,
           'cust' AS to_source, '{b}' AS to_bdy, {bid} AS to_id, {bname} AS to_name,
           count(*) AS address_count, CAST(100.0 AS DECIMAL(4,1)) AS address_percent
    FROM customer JOIN place ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY ALL"""
_LEVEL = {"atom": ("CAST(c_custkey AS VARCHAR)", "c_name"), "nation": ("nation_id", "nation_name"),
          "region": ("region_id", "region_name")}


def _nested(a: str, b: str) -> str:
    return NESTED.format(a=a, b=b, aid=_LEVEL[a][0], aname=_LEVEL[a][1], bid=_LEVEL[b][0], bname=_LEVEL[b][1])


PAIR = "from_source, from_bdy, to_source, to_bdy"
SCORE = f"""
    SELECT {PAIR}, CAST(CAST(sum(CAST(address_count AS DECIMAL(18,0)) * address_percent) AS DOUBLE)
                        / CAST(sum(address_count) AS DOUBLE) AS SMALLINT) AS concordance_percent
    FROM cw GROUP BY ALL"""
# Nested pairs have no error of their own; the rest go out, come back and are compared.
ERROR = f"""
    SELECT {PAIR}, CAST(sum(abs(e.value - estimate)) / sum(e.value) * 100.0 AS DECIMAL(5,1)) AS error_percent
    FROM (SELECT {PAIR}, to_id, to_name,
                 CAST(sum(value * CAST(address_percent AS DOUBLE) / 100.0) AS BIGINT) AS estimate
          FROM cw JOIN indicator i ON i.bdy = from_bdy AND i.region_id = from_id
          WHERE from_source = 'cust' AND to_source = 'cust'
            AND NOT (from_bdy IN ('atom', 'nation', 'region') AND to_bdy IN ('atom', 'nation', 'region'))
          GROUP BY ALL) pc
    JOIN indicator e ON e.bdy = to_bdy AND e.region_id = to_id GROUP BY {PAIR}"""

LEGACY = """
    SELECT '{st}' AS source_type, source_id, source_name, source_state, '{tt}' AS target_type, target_id,
           target_name, target_state, address_count, CAST(total AS BIGINT) AS total_source_addresses,
           CAST(address_count::DOUBLE / total::DOUBLE * 100.0 AS SMALLINT) AS percent_source_addresses
    FROM (SELECT *, sum(address_count) OVER (PARTITION BY source_id) AS total
          FROM (SELECT source_id, source_name, source_state, target_id, target_name, target_state,
                       count(*) AS address_count FROM tagged GROUP BY ALL) agg) f
    WHERE CAST(address_count::DOUBLE / total::DOUBLE * 100.0 AS SMALLINT) > 0"""

# Point in an L of the given side at (x, y), edges included.
ELL = "px BETWEEN x AND x + {s} AND py BETWEEN y AND y + {s} AND NOT (px > x + {h} AND py > y + {h})"
DEPOT_ELL = ELL.format(s=10, h=5)
NATION_ELL = ELL.format(s=20, h=10)


def _frame(x: str, y: str, side: int, inset: int, hole: int) -> str:
    """Point in a square with a square hole, edges of both included."""
    return (f"px BETWEEN {x} AND {x} + {side} AND py BETWEEN {y} AND {y} + {side} AND NOT "
            f"(px > {x} + {inset} AND px < {x} + {inset + hole} AND py > {y} + {inset} AND py < {y} + {inset + hole})")


def _cut(ax: str, ay: str, aw: float, ah: float, bx: str, by: str, bw: float, bh: float) -> tuple[str, str, str]:
    """Area and centre of the overlap of two rectangles."""
    w = f"greatest(0, least({ax} + {aw}, {bx} + {bw}) - greatest({ax}, {bx}))"
    h = f"greatest(0, least({ay} + {ah}, {by} + {bh}) - greatest({ay}, {by}))"
    return (f"({w} * {h})", f"((least({ax} + {aw}, {bx} + {bw}) + greatest({ax}, {bx})) / 2)",
            f"((least({ay} + {ah}, {by} + {bh}) + greatest({ay}, {by})) / 2)")


_ELL_PARTS = (_cut("qx", "qy", 1, 1, "x", "y", 10, 5), _cut("qx", "qy", 1, 1, "x", "y + 5", 5, 5))
_AREA = " + ".join(a for a, _, _ in _ELL_PARTS)
_MX = " + ".join(f"{a} * {x}" for a, x, _ in _ELL_PARTS)
_MY = " + ".join(f"{a} * {y}" for a, _, y in _ELL_PARTS)


def _touches(x: str, y: str, w: float, h: float) -> str:
    return f"(qx <= {x} + {w} AND {x} <= qx + 1 AND qy <= {y} + {h} AND {y} <= qy + 1)"


def _frames(ax: str, ay: str, a: tuple, bx: str, by: str, b: tuple) -> str:
    """Overlap area of two squares with holes, each (side, inset, hole)."""
    def rects(x, y, f):
        return ((x, y, f[0], 1), (f"{x} + {f[1]}", f"{y} + {f[1]}", f[2], -1))
    return " + ".join(f"{s * t} * {_cut(p, q, u, u, r, v, w, w)[0]}"
                      for p, q, u, s in rects(ax, ay, a) for r, v, w, t in rects(bx, by, b))


# Square nation against framed nation: the whole square less what meets the hole.
_SOURCE_FRAME = (_cut("s.x", "s.y", 20, 20, "t.x + 7", "t.y + 7", 20, 20),
                 _cut("s.x", "s.y", 20, 20, "t.x + 14", "t.y + 14", 6, 6))
_SF_AREA = f"({_SOURCE_FRAME[0][0]} - {_SOURCE_FRAME[1][0]})"
_SF_X = f"({_SOURCE_FRAME[0][0]} * {_SOURCE_FRAME[0][1]} - {_SOURCE_FRAME[1][0]} * {_SOURCE_FRAME[1][1]})"
_SF_Y = f"({_SOURCE_FRAME[0][0]} * {_SOURCE_FRAME[0][2]} - {_SOURCE_FRAME[1][0]} * {_SOURCE_FRAME[1][2]})"

ZONE = """CASE p_type WHEN 'ECONOMY' THEN 'Low Density Residential' WHEN 'STANDARD' THEN NULL
          WHEN 'PROMO' THEN 'Mixed Use' WHEN 'LARGE' THEN 'Rural' ELSE 'Industrial' END"""
FLAGGED = f"""
    SELECT o_orderkey AS gnaf_pid, o_orderstatus AS state, planning_zone,
           CASE WHEN planning_zone LIKE '%residential%' THEN true
                WHEN coalesce(building_count, 0) > 0 AND planning_zone <> 'unknown' THEN false
                WHEN category = 'residential' THEN true WHEN category <> 'residential' THEN false END AS is_residential,
           coalesce(building_count, 0) AS building_count,
           o_orderpriority AS mb_2016_code, category AS mb_category_2016,
           o_orderpriority AS mb_2021_code, category AS mb_category_2021
    FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'residential' WHEN '5-LOW' THEN NULL
                    ELSE 'commercial' END AS category FROM orders) o
    LEFT JOIN (SELECT l_orderkey, count(*) AS building_count,
                      string_agg(DISTINCT coalesce(lower({ZONE}), 'unknown'), ' - '
                                 ORDER BY coalesce(lower({ZONE}), 'unknown')) AS planning_zone
               FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1) b ON l_orderkey = o_orderkey"""

RATE_TESTS = """SELECT segment, CAST(trunc(sum(price) * 2) AS BIGINT) AS tests FROM cust
                GROUP BY 1"""
CARRIED = """
    SELECT to_id, to_name, CAST(sum(CAST(cases AS DOUBLE) * CAST(address_percent AS DOUBLE) / 100.0) AS BIGINT) AS cases,
           CAST(sum(cases) AS DECIMAL(38,2)) AS cases_qa_count, count(*) AS from_count
    FROM (SELECT nation_id, sum(price) AS cases FROM cust GROUP BY 1) i JOIN cw ON from_id = nation_id GROUP BY ALL"""

WHOLE = _pair(PAIRS[0]).replace("concat(nullif(f.segment, ''), ' ', f.region_name)", "concat(f.segment, ' all')")
OFFICIAL = """
    SELECT nation_id AS from_id, segment AS to_id,
           n::DOUBLE / CAST(sum(n) OVER (PARTITION BY nation_id) AS DOUBLE) AS ratio
    FROM (SELECT nation_id, segment, sum(CASE WHEN status = 'F' THEN 2 ELSE 1 END) AS n FROM cust
          GROUP BY ALL) a"""
COMPARE = """
    SELECT count(*) AS bdy_pair_count, CAST(sqrt(avg(power(d, 2))) AS SMALLINT) AS rmse,
           CAST(avg(d) AS SMALLINT) AS mean_delta, CAST(min(d) AS SMALLINT) AS min_delta,
           CAST(max(d) AS SMALLINT) AS max_delta,
           CAST(sum(abs(d) * address_count) / 100.0 AS BIGINT) AS address_count, {t} AS threshold
    FROM (SELECT ratio * 100.0 - CAST(address_percent AS DOUBLE) AS d, address_count
          FROM cw JOIN official o ON o.from_id = cw.from_id AND o.to_id = cw.to_id) x WHERE {w}"""

# The projection's constants, from the published formulas.
ALBERS = """
    SELECT id, n, (CASE WHEN hole THEN -1 ELSE 1 END) * k AS turn, east, north FROM (
      SELECT id, hole, k, n, rho * sin(theta) AS east, rho0 - rho * cos(theta) AS north FROM (
        SELECT *, a * sqrt(c - cone * ((1 - e2) * (s / (1 - e2 * s * s)
                  - ln((1 - e * s) / (1 + e * s)) / (2 * e)))) / cone AS rho, cone * radians(lon - 132) AS theta
        FROM (SELECT *, sin(radians(lat)) AS s FROM corner) c1, constants) c2) c3"""
CONSTANTS = """
    SELECT *, a * sqrt(c) / cone AS rho0 FROM (
      SELECT *, m1 * m1 + cone * q1 AS c FROM (
        SELECT *, (m1 * m1 - m2 * m2) / (q2 - q1) AS cone FROM (
          SELECT *, cos(radians(-18)) / sqrt(1 - e2 * s1 * s1) AS m1, cos(radians(-36)) / sqrt(1 - e2 * s2 * s2) AS m2,
                 (1 - e2) * (s1 / (1 - e2 * s1 * s1) - ln((1 - e * s1) / (1 + e * s1)) / (2 * e)) AS q1,
                 (1 - e2) * (s2 / (1 - e2 * s2 * s2) - ln((1 - e * s2) / (1 + e * s2)) / (2 * e)) AS q2
          FROM (SELECT *, sqrt(e2) AS e, sin(radians(-18)) AS s1, sin(radians(-36)) AS s2
                FROM (SELECT 6378137.0::DOUBLE AS a,
                             (2 - 1 / 298.257222101::DOUBLE) / 298.257222101::DOUBLE AS e2)))))"""
CORNER = """
    SELECT id, hole, 1 AS k, n, 112 + cx * 0.4::DOUBLE AS lon, -44 + cy * 0.34::DOUBLE AS lat FROM (
      SELECT id, false AS hole, n, x + CASE WHEN n IN (1, 2) THEN 10 ELSE 0 END AS cx,
             y + CASE WHEN n IN (2, 3) THEN 10 ELSE 0 END AS cy FROM depot, (SELECT unnest([0, 1, 2, 3]) AS n)
      UNION ALL
      SELECT id, true, n, x + 3 + CASE WHEN n IN (1, 2) THEN 5 ELSE 0 END,
             y + 3 + CASE WHEN n IN (2, 3) THEN 5 ELSE 0 END FROM depot, (SELECT unnest([0, 1, 2, 3]) AS n))"""

_UNIT_SEGMENT = "SELECT *, nullif(segment, 'BUILDING') AS segment_id FROM cust"
_RELEASE = """strftime({d}, '%Y') || CASE quarter({d}) WHEN 1 THEN '02' WHEN 2 THEN '05' WHEN 3 THEN '08' ELSE '11' END"""
_BACK = "(date_trunc('month', o_orderdate) - INTERVAL {n} MONTH)"

# One boundary per point: the smallest id.  Middles of cells lie on no boundary.
TIED = f"""
    SELECT o_orderkey, CAST(c_custkey AS VARCHAR) AS atom_id, c_mktsegment, square_id, square_name, ell_id, ell_name
    FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN (SELECT atom_id, min(CAST(id AS VARCHAR)) AS square_id,
                 arg_min(concat(name, ' (C)'), CAST(id AS VARCHAR)) AS square_name
          FROM atom JOIN square ON px BETWEEN x AND x + 20 AND py BETWEEN y AND y + 20 GROUP BY 1) s
      ON s.atom_id = c_custkey
    LEFT JOIN (SELECT atom_id, min(CAST(id AS VARCHAR)) AS ell_id, arg_min(name, CAST(id AS VARCHAR)) AS ell_name
               FROM atom JOIN square ON {NATION_ELL} GROUP BY 1) e ON e.atom_id = c_custkey"""

ORACLES: dict[str, str] = {
    "build_pair": _with(_pair(PAIRS[0]), "cust"),
    "build_pair_cross_source": _with(_pair(PAIRS[2]), "cust", "supp"),
    "build_pair_by_flag": _with(_pair(PAIRS[2], "AND r.o_orderstatus = 'O'",
                                      "JOIN orders r ON r.o_orderkey = f.unit_id"), "cust", "supp"),
    "build_pair_two_sided_filter": _with(
        _pair(PAIRS[2], f"AND f.category IN {HOME} AND t.category IN ('1-URGENT', '2-HIGH') "
              "AND f.nation_id IN ('3', '8')", rounded=False, positive=False), "cust", "supp"),
    "build_all": _with(ALL, "cust", "supp", "part_tag"),
    "build_all_from_atoms": _with(ALL, "cust", "supp", "part_tag"),
    "nested_pairs": _with(" UNION ALL ".join(_nested(a, b) for a, b in (
        ("atom", "nation"), ("atom", "region"), ("nation", "region"))), "place"),
    "same_table_pair": _with("""
        SELECT 'cust segment' AS from_bdy, from_id, from_name, 'cust nation' AS to_bdy, to_id, to_name, address_count,
               round(address_count::DOUBLE / CAST(sum(address_count) OVER (PARTITION BY from_id) AS DOUBLE) * 100.0, 6)
                 AS percent_from_addresses
        FROM (SELECT segment_id AS from_id, segment_id AS from_name, nation_id AS to_id, nation_name AS to_name,
                     count(*) AS address_count FROM u GROUP BY ALL) agg""", "cust", u=_UNIT_SEGMENT),
    "legacy_pair_overrides": _with(LEGACY.format(st="cust segment", tt="cust nation"), "cust", tagged="""
        SELECT segment AS source_id, concat(region_name, ' ', segment) AS source_name, region_name AS source_state,
               region_name AS target_state,
               CASE WHEN region_name = 'ASIA' THEN 'T-ASIA' WHEN CAST(nation_id AS INT) % 4 <> 3 THEN nation_id
                    WHEN nation_id = '3' THEN 'T-3' WHEN nation_id = '7' THEN 'T-7'
                    WHEN nation_id = '11' THEN 'T-11' END AS target_id,
               CASE WHEN region_name = 'ASIA' THEN 'Unincorporated - ASIA'
                    WHEN CAST(nation_id AS INT) % 4 <> 3 THEN nation_name
                    WHEN nation_id = '3' THEN 'Fix three' WHEN nation_id = '7' THEN 'Fix seven'
                    WHEN nation_id = '11' THEN 'Fix eleven' END AS target_name
        FROM cust WHERE region_name = 'ASIA' OR CAST(nation_id AS INT) % 4 <> 3
                     OR nation_id IN ('3', '7', '11')"""),
    "score": _with(SCORE, "cust", "supp", "part_tag", cw=ALL),
    "error_rate": _with(ERROR, "cust", "supp", "part_tag", "indicator", cw=ALL),
    "score_with_error": _with(f"""
        SELECT s.*, CASE WHEN s.from_source = 'cust' AND s.to_source = 'cust' AND s.from_bdy IN ('atom', 'nation', 'region')
                          AND s.to_bdy IN ('atom', 'nation', 'region') THEN CAST(0.0 AS DECIMAL(5,1))
                         ELSE error_percent END AS error_percent
        FROM ({SCORE}) s LEFT JOIN ({ERROR}) e USING ({PAIR})""", "cust", "supp", "part_tag", "indicator",
        cw=" UNION ALL ".join([ALL, _nested("atom", "nation"), _nested("atom", "region"), _nested("nation", "region")])),
    "weighted_percent_by_id": _with("""
        SELECT from_id, CAST(sum(CAST(address_count AS DECIMAL(18,0)) * address_percent) AS DOUBLE)
                 AS weighted_address_count, CAST(sum(address_count) AS BIGINT) AS address_count,
               round(CAST(sum(CAST(address_count AS DECIMAL(18,0)) * address_percent) AS DOUBLE)
                     / CAST(sum(address_count) AS DOUBLE), 6) AS weighted_percent
        FROM cw GROUP BY 1""", "cust", cw=_pair(PAIRS[0])),
    "apportion": _with(CARRIED, "cust", cw=_pair(PAIRS[0])),
    "rate": _with("""
        SELECT to_id, to_name, tests, cases,
               CAST(cases::DOUBLE / nullif(tests, 0)::DOUBLE * 100.0 AS DECIMAL(4,1)) AS infection_rate_percent,
               CAST(cases::DOUBLE / CAST(cases_qa_count AS DOUBLE) * 100.0 AS SMALLINT) AS concordance_percent,
               from_count
        FROM carried JOIN tests ON segment = to_id""", "cust", cw=_pair(PAIRS[0]), carried=CARRIED, tests=RATE_TESTS),
    "slice_pair": _with(_pair(PAIRS[0]), "cust"),
    "lookup": _with("""
        SELECT from_id, to_bdy, to_id, to_name, address_count, address_percent FROM cw
        WHERE from_bdy = 'nation' AND from_id IN ('3', '11') AND address_percent < 30""",
        "cust", "supp", "part_tag", cw=ALL),
    "compare_official": _with(f"""
        {COMPARE.format(t=0, w="true")} UNION ALL {COMPARE.format(t=2, w="abs(d) > 2.0")}""",
        "cust", cw=WHOLE, official=OFFICIAL),
    "rollup_indicator": """
        SELECT concat('EVT', event_type) AS event_type, CAST(sum(n) AS BIGINT) AS cases
        FROM (SELECT CAST(ts AS DATE) AS d, event_type, count(*) AS n FROM events GROUP BY ALL) raw GROUP BY 1""",
    "residential_flags": FLAGGED,
    "reconcile": """
        SELECT is_residential, CAST(sum(building_count) AS BIGINT) AS building_count,
               CAST(sum(CASE WHEN u IS NOT NULL AND b IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS match_count,
               CAST(sum(CASE WHEN u IS NOT NULL AND b IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unit_only_count,
               CAST(sum(CASE WHEN u IS NULL AND b IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS building_only_count
        FROM (SELECT o_orderkey AS u FROM orders) un
        FULL OUTER JOIN (SELECT l_orderkey AS b, coalesce(flag, 'unknown') AS is_residential, count(*) AS building_count
                         FROM (SELECT CASE WHEN l_linenumber = 7 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey,
                                      CASE l_returnflag WHEN 'A' THEN 'Yes' WHEN 'R' THEN 'No' END AS flag
                               FROM lineitem) x GROUP BY l_orderkey, flag) blg ON u = b
        GROUP BY 1""",
    "category_disagreement": """
        SELECT count(*) AS address_count, count(DISTINCT o_custkey) AS mb_count
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderpriority < '3' AND c_mktsegment <> 'HOUSEHOLD'""",
    "unit_profile": f"""
        SELECT is_residential, mb_category_2021, state, count(*) AS address_count FROM ({FLAGGED}) f GROUP BY ALL""",
    "unit_profile_topk": _with("""
        SELECT region_name, nation_name, segment_id, status, count(*) AS address_count FROM u
        WHERE category IN ('1-URGENT', '2-HIGH') GROUP BY ALL
        ORDER BY region_name NULLS LAST, nation_name NULLS LAST, segment_id NULLS LAST, status NULLS LAST LIMIT 50""",
        "cust", u=_UNIT_SEGMENT),
    "release_version": f"""
        SELECT {_RELEASE.format(d=_BACK.format(n=1))} AS current_release,
               {_RELEASE.format(d=_BACK.format(n=4))} AS previous_release, count(*) AS order_count
        FROM orders GROUP BY ALL""",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_names": _with("""
        SELECT from_source, from_bdy, from_id, to_source, to_bdy, to_id, count(*) AS row_count FROM cw
        GROUP BY ALL HAVING count(*) > 1""", "cust", "supp", "part_tag", cw=ALL),
    "null_violations": _with("""
        SELECT 'unit_id' AS column_name, count(*) - count(unit_id) AS null_count FROM u
        UNION ALL SELECT 'nation_id', count(*) - count(nation_id) FROM u
        UNION ALL SELECT 'segment_id', count(*) - count(segment_id) FROM u""", "cust", u=_UNIT_SEGMENT),
    "dropped_units": _with("""
        SELECT unit_id, status FROM cust WHERE unit_id NOT IN (SELECT unit_id FROM supp)""", "cust", "supp"),
    "row_parity": _with("""
        SELECT (SELECT count(*) FROM cust) AS unit_count, (SELECT count(*) FROM supp) AS tagged_count,
               (SELECT count(*) FROM cust WHERE unit_id NOT IN (SELECT unit_id FROM supp)) AS dropped_count""",
        "cust", "supp"),
    "percent_totals": _with("""
        SELECT from_bdy, to_bdy, from_id, from_name, count(*) AS target_count, sum(address_percent) AS percent_total
        FROM cw GROUP BY ALL""", "cust", "supp", "part_tag", cw=ALL),
    "pip_join": _with(f"""
        SELECT atom_id, 'depot' AS layer, CAST(id AS VARCHAR) AS bdy_id, name AS bdy_name
        FROM atom JOIN depot ON {DEPOT_ELL}""", "atom", "depot"),
    "pip_join_parts_and_holes": _with(f"""
        SELECT DISTINCT atom_id, 'block' AS layer, CAST(region AS VARCHAR) AS bdy_id
        FROM atom JOIN square ON px BETWEEN x AND x + 20 AND py BETWEEN y AND y + 20
        UNION ALL SELECT atom_id, 'yard', CAST(id AS VARCHAR) FROM atom JOIN depot ON {_frame("x", "y", 10, 3, 5)}
        UNION ALL SELECT atom_id, 'frame', CAST(id AS VARCHAR) FROM atom JOIN square
                  ON {_frame("(x + 7)", "(y + 7)", 20, 7, 6)}""", "atom", "square", "depot"),
    "tag_units": _with(f"""
        SELECT o_orderkey, CAST(c_custkey AS VARCHAR) AS atom_id, c_mktsegment,
               CAST(s.id AS VARCHAR) AS square_id, concat(s.name, ' (C)') AS square_name,
               b.id AS block_id, b.name AS block_name, e.id AS ell_id, e.name AS ell_name
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN atom a ON a.atom_id = c_custkey
        JOIN square s ON px BETWEEN s.x AND s.x + 20 AND py BETWEEN s.y AND s.y + 20
        JOIN (SELECT DISTINCT atom_id, CAST(region AS VARCHAR) AS id, r_name AS name
              FROM atom JOIN square ON px BETWEEN x AND x + 20 AND py BETWEEN y AND y + 20
              JOIN region ON r_regionkey = region) b ON b.atom_id = a.atom_id
        LEFT JOIN (SELECT atom_id, CAST(id AS VARCHAR) AS id, name FROM atom JOIN square ON {NATION_ELL}) e
          ON e.atom_id = a.atom_id""", "atom", "square"),
    "tag_units_tie_break": _with(TIED, "atom", "square"),
    "tag_units_from_shapes": _with(TIED.replace("FROM atom", "FROM mid"), "cell", "square",
                                   mid="SELECT atom_id, qx + 0.5 AS px, qy + 0.5 AS py FROM cell"),
    "zonal_sum": _with(f"""
        SELECT CAST(id AS VARCHAR) AS bdy_id, name AS bdy_name, sum(balance) AS balance
        FROM atom JOIN depot ON {DEPOT_ELL} GROUP BY ALL""", "atom", "depot"),
    "point_on_surface_inside": """
        SELECT 'yard' AS layer, CAST(s_suppkey AS VARCHAR) AS bdy_id FROM supplier
        UNION ALL SELECT 'depot', CAST(s_suppkey AS VARCHAR) FROM supplier
        UNION ALL SELECT 'block', CAST(r_regionkey AS VARCHAR) FROM region
                  WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
        UNION ALL SELECT 'frame', CAST(n_nationkey AS VARCHAR) FROM nation""",
    # The widest stretch halfway up an L's upper half is its left arm.
    "two_way_match": _with(f"""
        SELECT a_id, a_name, b_id, b_name, count(*) AS match_count FROM (
          SELECT CAST(id AS VARCHAR) AS a_id, name AS a_name, CAST(atom_id AS VARCHAR) AS b_id,
                 concat('Atom ', atom_id) AS b_name
          FROM (SELECT atom_id, qx + 0.5 AS px, qy + 0.5 AS py FROM cell) c JOIN depot ON {DEPOT_ELL}
          UNION ALL
          SELECT CAST(id AS VARCHAR), name, CAST(atom_id AS VARCHAR), concat('Atom ', atom_id)
          FROM depot JOIN cell ON x + 2.5 BETWEEN qx AND qx + 1 AND y + 7.5 BETWEEN qy AND qy + 1) m
        GROUP BY ALL""", "cell", "depot"),
    "name_mismatches": _with("""
        SELECT a_id, a_name, b_id, b_name, count(*) AS match_count FROM (
          SELECT CAST(id AS VARCHAR) AS a_id, concat(name, ' (C)') AS a_name, CAST(atom_id AS VARCHAR) AS b_id,
                 concat('Atom ', atom_id) AS b_name
          FROM cell JOIN square ON qx + 0.5 BETWEEN x AND x + 20 AND qy + 0.5 BETWEEN y AND y + 20
          UNION ALL
          SELECT CAST(id AS VARCHAR), concat(name, ' (C)'), CAST(atom_id AS VARCHAR), concat('Atom ', atom_id)
          FROM square JOIN cell ON x + 10 BETWEEN qx AND qx + 1 AND y + 10 BETWEEN qy AND qy + 1) m
        GROUP BY ALL HAVING count(*) < 2""", "cell", "square"),
    "area_by_key": """
        SELECT CAST(s_nationkey AS VARCHAR) AS nation_id, round(CAST(sum(100 - 25) AS DOUBLE), 6) AS area
        FROM supplier GROUP BY 1""",
    "area_from_vertices": """
        SELECT CAST(s_suppkey AS VARCHAR) AS bdy_id, 100.0::DOUBLE AS area FROM supplier""",
    "strip_code_prefix": "SELECT c_custkey, substr(c_name, 10) AS code FROM customer",
    "albers_area": _with("""
        SELECT CAST(p.id AS VARCHAR) AS bdy_id,
               round(sum(p.turn * (p.east * q.north - q.east * p.north)) / 2 / 1e6, 3) AS area_sqkm
        FROM projected p JOIN projected q ON q.id = p.id AND q.turn = p.turn AND q.n = (p.n + 1) % 4 GROUP BY 1""",
        "depot", constants=CONSTANTS, corner=CORNER, projected=ALBERS),
    "centroids": _with("""
        SELECT CAST(id AS VARCHAR) AS bdy_id, round(x + (50 * 5 + 25 * 2.5) / 75, 6) AS cx,
               round(y + (50 * 2.5 + 25 * 7.5) / 75, 6) AS cy FROM depot""", "depot"),
    "overlap_report": _with(f"""
        SELECT CAST(atom_id AS VARCHAR) AS a_id, CAST(id AS VARCHAR) AS b_id, round(area, 6) AS area,
               CASE WHEN area > 0 THEN round(mx / area, 6) END AS cx,
               CASE WHEN area > 0 THEN round(my / area, 6) END AS cy
        FROM (SELECT atom_id, id, {_AREA} AS area, {_MX} AS mx, {_MY} AS my
              FROM cell JOIN depot ON {_touches("x", "y", 10, 5)} OR {_touches("x", "y", 5, 10)}) o""",
        "cell", "depot"),
    "percent_overlap": _with(f"""
        SELECT CAST(d.id AS VARCHAR) AS a_id, CAST(s.id AS VARCHAR) AS b_id, round(area / 75 * 100.0, 6) AS percent_area
        FROM (SELECT d.id AS did, s.id AS sid,
                     {_frames("d.x", "d.y", (10, 3, 5), "s.x + 7", "s.y + 7", (20, 7, 6))} AS area
              FROM depot d, square s) o JOIN depot d ON d.id = did JOIN square s ON s.id = sid
        WHERE area > 0""", "depot", "square"),
    "atoms_touching": _with(f"""
        SELECT CAST(atom_id AS VARCHAR) AS atom_id, CAST(id AS VARCHAR) AS bdy_id FROM cell JOIN square
          ON id IN (6, 18) AND ({_touches("x", "y", 20, 10)} OR {_touches("x", "y", 10, 20)})""", "cell", "square"),
    "geometry_diff": """
        SELECT CAST(s_suppkey AS VARCHAR) AS bdy_id, 100.0::DOUBLE AS a_area, 75.0::DOUBLE AS b_area,
               75.0::DOUBLE AS overlap_area FROM supplier WHERE s_suppkey % 2 = 1""",
    "geometry_diff_islet": """
        SELECT CAST(s_suppkey AS VARCHAR) AS bdy_id, 100.0::DOUBLE AS a_area, 100.00000001::DOUBLE AS b_area,
               100.0::DOUBLE AS overlap_area FROM supplier WHERE s_suppkey % 2 = 1""",
    "overlap_slanted": _with(f"""
        SELECT CAST(atom_id AS VARCHAR) AS a_id, concat('Atom ', atom_id, ' (A)') AS a_name, CAST(id AS VARCHAR) AS b_id,
               name AS b_name, round(area, 6) AS area, round((mx + 2 * my) / area, 6) AS cx, round((mx + 3 * my) / area, 6) AS cy
        FROM (SELECT atom_id, id, name, {_AREA} AS area, {_MX} AS mx, {_MY} AS my
              FROM cell JOIN depot ON {_touches("x", "y", 10, 5)} OR {_touches("x", "y", 5, 10)}) o WHERE area > 0""",
        "cell", "depot"),
    "overlap_at_corners": """
        SELECT CAST(s_suppkey AS VARCHAR) AS a_id, round(17.25 / 7 / 2, 6)::DOUBLE AS area FROM supplier
        WHERE s_suppkey % 2 = 1""",
    "atoms_touching_slanted": _with(f"""
        SELECT CAST(atom_id AS VARCHAR) AS atom_id, CAST(id AS VARCHAR) AS bdy_id FROM cell JOIN square
          ON id IN (6, 18) AND ({_touches("x", "y", 20, 10)} OR {_touches("x", "y", 10, 20)})""", "cell", "square"),
    "pip_slanted": _with(f"""
        SELECT atom_id, 'depot' AS layer, CAST(id AS VARCHAR) AS bdy_id, name AS bdy_name
        FROM atom JOIN depot ON {DEPOT_ELL}""", "atom", "depot"),
    "collected_features": _with("""
        SELECT CAST(nation AS VARCHAR) AS bdy_id, count(*) AS part_count, count(*) AS feature_count,
               CAST(count(*) * 100 AS DOUBLE) AS area,
               (SELECT nullif(count(DISTINCT atom_id), 0) FROM atom JOIN depot e ON px BETWEEN e.x AND e.x + 10
                  AND py BETWEEN e.y AND e.y + 10 WHERE e.nation = d.nation) AS atom_count
        FROM depot d GROUP BY nation""", "atom", "depot"),
    "unmatched_shapes": """
        SELECT CAST(s_suppkey AS VARCHAR) AS bdy_id FROM supplier
        WHERE s_suppkey NOT IN (SELECT n_nationkey FROM nation)""",
    "overlap_legacy_pair": _with(f"""
        SELECT f.*, round({_SF_AREA}, 6) AS overlap_area,
               CASE WHEN {_SF_AREA} > 0 THEN round({_SF_X} / {_SF_AREA}, 6) END AS overlap_x,
               CASE WHEN {_SF_AREA} > 0 THEN round({_SF_Y} / {_SF_AREA}, 6) END AS overlap_y
        FROM ({LEGACY.format(st="square", tt="frame")}) f
        JOIN square s ON s.id = CAST(source_id AS INT) JOIN square t ON t.id = CAST(target_id AS INT)""",
        "cust", "atom", "square", tagged="""
        SELECT CAST(id AS VARCHAR) AS source_id, name AS source_name, segment AS source_state,
               nation_id AS target_id, nation_name AS target_name, region_name AS target_state
        FROM cust JOIN atom USING (atom_id) JOIN square ON px BETWEEN x AND x + 20 AND py BETWEEN y AND y + 20"""),
    "project_population": """
        SELECT c_custkey AS mb_code, CAST(floor(c_acctbal) AS BIGINT) AS person, coalesce(o, 0) AS old_count,
               coalesce(n, 0) AS new_count,
               CASE WHEN coalesce(o, 0) > 0 THEN CAST(floor(c_acctbal) / o::DOUBLE * n AS BIGINT) ELSE 0 END AS projected
        FROM customer
        LEFT JOIN (SELECT o_custkey, count(*) AS o FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) old
          ON old.o_custkey = c_custkey
        LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) new ON new.o_custkey = c_custkey""",
}
