"""DuckDB SQL for the queries of the gap-filling engine. One text a query; the grids come from the same common parts."""

from __future__ import annotations

TIMES = "(SELECT greatest(1, CAST(floor(sqrt(count(*) / 60000)) AS BIGINT)) FROM lineitem)"
OBS = f"""items AS MATERIALIZED (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_partkey % (30 * {TIMES}) AS INTEGER) AS y, CAST(l_suppkey % (24 * {TIMES}) AS INTEGER) AS x, l_quantity AS q FROM lineitem
), obs AS MATERIALIZED (
  SELECT year, y, x, floor(avg(q) * 1000 + 0.3) / 1000 AS value FROM items
  WHERE NOT (year <= 1997 AND x BETWEEN 8 AND 14 AND y BETWEEN 10 AND 18) AND NOT (x % 11 = 5 AND y % 7 = 3) AND (y * 7 + x * 5 + year * 3 + y * x) % 6 <> 0
  GROUP BY year, y, x)"""
GRID = f"""{OBS}, cells AS MATERIALIZED (
  SELECT CAST(a.y AS INTEGER) AS y, CAST(b.x AS INTEGER) AS x FROM range(0, 30 * {TIMES}) a(y), range(0, 24 * {TIMES}) b(x)
), grid AS (
  SELECT d.year, c.y, c.x, o.value FROM (SELECT DISTINCT year FROM obs) d CROSS JOIN cells c
  LEFT JOIN obs o ON o.year = d.year AND o.y = c.y AND o.x = c.x)"""
def marked(extreme: float = 1.8, speckle: float = 1.0) -> str:
    return f"""{GRID}, stats AS (
  SELECT y, x, CASE WHEN (x * 5 + y) % 41 <> 0 THEN floor(avg(value) * 1000 + 0.3) / 1000 END AS mean, floor(stddev_samp(value) * 1000 + 0.3) / 1000 AS sd FROM obs GROUP BY y, x
), joined AS (
  SELECT g.*, s.mean, s.sd, CASE WHEN s.sd > 0 THEN s.sd END AS sp, CASE WHEN (g.x * 7 + g.y * 3) % 17 = 0 THEN 0 ELSE 1 END AS land
  FROM grid g LEFT JOIN stats s USING (y, x)
), tested AS (
  SELECT *, coalesce(value < mean - {extreme} * sp, FALSE) OR coalesce(value > mean + {extreme} * sp, FALSE) OR coalesce(value < 2 OR value > 48, FALSE) AS extreme,
    coalesce(value < mean - {speckle} * sp OR value > mean + {speckle} * sp, FALSE) AS suspect FROM joined
), marked AS (
  SELECT year, y, x, mean, sd, sp,
    CAST(CASE WHEN land = 0 THEN 1 WHEN mean IS NULL THEN 2 WHEN value IS NULL THEN 0 WHEN extreme THEN 4 WHEN suspect THEN 8 ELSE 0 END AS INTEGER) AS flags,
    CASE WHEN land <> 0 AND mean IS NOT NULL AND NOT extreme THEN value END AS value FROM tested
), zed AS (SELECT *, (value - mean) / sp AS z FROM marked)"""


MARKED = marked()


def spiral(n: int, reach: int = 8) -> str:
    return f"""spiral AS (SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY a.d * a.d + b.d * b.d, a.d, b.d) AS INTEGER) AS k, CAST(a.d AS INTEGER) AS dx, CAST(b.d AS INTEGER) AS dy, sqrt(CAST(a.d * a.d + b.d * b.d AS DOUBLE)) AS dist
  FROM range({-reach}, {reach + 1}) a(d), range({-reach}, {reach + 1}) b(d) WHERE a.d <> 0 OR b.d <> 0) WHERE k <= {n})"""


def _around(cells: str, others: str, on: str, c: str, search: int) -> str:
    """Cells `c` with those around them, `n`, and their place `s` in the spiral; by cells first where the spiral is long."""
    if search < 200:
        return f"{cells} CROSS JOIN spiral s JOIN {others} ON {on} AND n.y = {c}.y + s.dy AND n.x = {c}.x + s.dx"
    return f"{cells} JOIN {others} ON {on} JOIN spiral s ON s.dy = n.y - {c}.y AND s.dx = n.x - {c}.x"


def cleaned(before: str = MARKED, search: int = 24, least: int = 4, most: int = 12, tolerance: float = 0.4) -> str:
    return f"""{before}, {spiral(search, 8 if search < 200 else 33)}, asked AS (
  SELECT m.year, m.y, m.x, m.z, n.z AS nz, row_number() OVER (PARTITION BY m.year, m.y, m.x ORDER BY s.k) AS rn
  FROM {_around("zed m", "zed n", "n.year = m.year AND n.z IS NOT NULL", "m", search)} WHERE m.flags = 8
), alike AS (
  SELECT year, y, x FROM asked WHERE rn <= {most} GROUP BY year, y, x HAVING count(*) >= {least} AND abs(avg(nz) - any_value(z)) < {tolerance}
), clean AS (
  SELECT m.year, m.y, m.x, CASE WHEN m.flags <> 8 OR a.year IS NOT NULL THEN m.value END AS value,
    CASE WHEN m.flags = 8 AND a.year IS NOT NULL THEN 0 ELSE m.flags END AS flags
  FROM zed m LEFT JOIN alike a USING (year, y, x))"""


CLEAN = cleaned()


def pairs(search: int, most: int, ratio: bool = False, target: str = "TRUE") -> str:
    """Ranked pairs of the plain stack, `used`."""
    zero = -10 if ratio else 0
    if ratio:
        diff = "CASE WHEN nbr_alt = 0 THEN 2.0 ELSE greatest(0.5, least(2.0, nbr / nbr_alt)) END"
        fill = "alt * diff + -10"
    else:
        diff, fill = "nbr - nbr_alt", "alt + diff"
    return f"""{GRID}, {spiral(search, 8 if search < 200 else 33)}, pos AS (SELECT year, dense_rank() OVER (ORDER BY year) AS pos FROM (SELECT DISTINCT year FROM grid)),
stack AS (SELECT g.*, p.pos, g.value - ({zero}) AS v, max(g.value) OVER (PARTITION BY g.y, g.x) IS NOT NULL AS known FROM grid g JOIN pos p USING (year)),
found AS (
  SELECT g.year, g.y, g.x, a.pos - g.pos AS dz, s.k, s.dist, a.v AS alt, n.v AS nbr, na.v AS nbr_alt
  FROM {_around("stack g", "stack n", "n.pos = g.pos AND n.v IS NOT NULL", "g", search)}
  JOIN stack a ON a.y = g.y AND a.x = g.x AND a.pos <> g.pos AND a.v IS NOT NULL
  JOIN stack na ON na.pos = a.pos AND na.y = n.y AND na.x = n.x AND na.v IS NOT NULL
  WHERE g.value IS NULL AND g.known AND ({target})
), d AS (SELECT *, {diff} AS diff FROM found),
f AS (SELECT *, {fill} AS fill, (1.0 / abs(dz)) * (1.0 / dist) AS weight, row_number() OVER (PARTITION BY year, y, x ORDER BY abs(dz), dz DESC, k) AS rn FROM d),
used AS (SELECT * FROM f WHERE rn <= {most})"""


def filled(search: int, least: int, most: int, trim: bool = False, ratio: bool = False, target: str = "TRUE") -> str:
    """`got` (sums of the pairs) and `done` (year, y, x, value, dist, flags, n)."""
    t = "n > 2" if trim else "FALSE"
    return f"""{pairs(search, most, ratio, target)}, got AS (
  SELECT year, y, x, count(*) AS n, sum(weight * fill) AS swf, sum(weight) AS sw, sum(dist) AS sd,
    list({{'f': weight * fill, 'w': weight, 'd': dist}} ORDER BY diff, rn)[1] AS lo, list({{'f': weight * fill, 'w': weight, 'd': dist}} ORDER BY diff DESC, rn)[1] AS hi
  FROM used GROUP BY year, y, x
), done AS (
  SELECT s.year, s.y, s.x, s.known, coalesce(g.n, 0) AS n, s.value IS NULL AND s.known AND ({target.replace("g.", "s.")}) AS gap,
    CASE WHEN g.n >= {least} THEN (swf - CASE WHEN {t} THEN lo.f + hi.f ELSE 0 END) / (sw - CASE WHEN {t} THEN lo.w + hi.w ELSE 0 END) ELSE s.value END AS value,
    CASE WHEN g.n >= {least} THEN (g.sd - CASE WHEN {t} THEN lo.d + hi.d ELSE 0 END) / (n - CASE WHEN {t} THEN 2 ELSE 0 END) END AS dist,
    CAST(CASE WHEN s.value IS NOT NULL OR NOT ({target.replace("g.", "s.")}) THEN 0 WHEN NOT s.known THEN 2 WHEN g.n >= {least} THEN 16 + CASE WHEN g.n = {most} THEN 32 ELSE 0 END ELSE 2 END AS INTEGER) AS flags
  FROM stack s LEFT JOIN got g USING (year, y, x))"""


OUT = "SELECT year, y, x, (round(value, 8) + 0.0) AS value, (round(dist, 8) + 0.0) AS dist, flags FROM"
STATS = "stats AS (SELECT y, x, CASE WHEN (x * 5 + y) % 41 <> 0 THEN floor(avg(value) * 1000 + 0.3) / 1000 END AS mean, floor(stddev_samp(value) * 1000 + 0.3) / 1000 AS sd FROM obs GROUP BY y, x)"


def clipped(flag: str, bit: int) -> str:
    """`cut` from `done`: rows whose flags hold `bit` are held within mean +- 0.9 sd and 2..48."""
    return f"""{filled(8, 2, 8)}, {STATS}, lim AS (
  SELECT d.year, d.y, d.x, d.value, d.dist, {flag} AS flags, greatest(mean - 0.9 * sd, 2) AS lo, least(mean + 0.9 * sd, 48) AS hi FROM done d LEFT JOIN stats USING (y, x)
), cut AS (
  SELECT year, y, x, dist, CASE WHEN flags & {bit} <> 0 AND value < lo THEN lo WHEN flags & {bit} <> 0 AND value > hi THEN hi ELSE value END AS value,
    CASE WHEN flags & {bit} <> 0 AND (value < lo OR value > hi) THEN flags | 128 ELSE flags END AS flags FROM lim)"""


def left(search: int, least: int, most: int, trim: bool = False, target: str = "TRUE") -> str:
    """`left0`: what A1 makes of the masked and cleaned stack (year, y, x, value, mean, sd, flags, dist)."""
    t, own = ("n > 2" if trim else "FALSE"), target.replace("g.", "s.")
    gap = "value IS NULL AND {0}.flags & 3 = 0 AND {0}.known"
    return f"""{CLEAN}, pos AS (SELECT year, dense_rank() OVER (ORDER BY year) AS pos FROM (SELECT DISTINCT year FROM clean)),
stack AS MATERIALIZED (
  SELECT c.year, c.y, c.x, c.value, c.flags, p.pos, m.mean, m.sd, max(c.value) OVER (PARTITION BY c.y, c.x) IS NOT NULL AS known
  FROM clean c JOIN pos p USING (year) JOIN marked m ON m.year = c.year AND m.y = c.y AND m.x = c.x
), found AS (
  SELECT g.year, g.y, g.x, a.pos - g.pos AS dz, s.k, s.dist, a.value AS alt, n.value - na.value AS diff
  FROM stack g CROSS JOIN (SELECT * FROM spiral WHERE k <= {search}) s
  JOIN stack n ON n.pos = g.pos AND n.y = g.y + s.dy AND n.x = g.x + s.dx AND n.value IS NOT NULL
  JOIN stack a ON a.y = g.y AND a.x = g.x AND a.pos <> g.pos AND a.value IS NOT NULL
  JOIN stack na ON na.pos = a.pos AND na.y = n.y AND na.x = n.x AND na.value IS NOT NULL
  WHERE g.{gap.format("g")} AND ({target})
), f AS (SELECT *, alt + diff AS fill, (1.0 / abs(dz)) * (1.0 / dist) AS weight, row_number() OVER (PARTITION BY year, y, x ORDER BY abs(dz), dz DESC, k) AS rn FROM found),
got AS (
  SELECT year, y, x, count(*) AS n, sum(weight * fill) AS swf, sum(weight) AS sw, sum(dist) AS sdist,
    list({{'f': weight * fill, 'w': weight, 'd': dist}} ORDER BY diff, rn)[1] AS lo, list({{'f': weight * fill, 'w': weight, 'd': dist}} ORDER BY diff DESC, rn)[1] AS hi
  FROM f WHERE rn <= {most} GROUP BY year, y, x
), left0 AS MATERIALIZED (
  SELECT s.year, s.y, s.x, s.mean, s.sd,
    CASE WHEN g.n >= {least} THEN (swf - CASE WHEN {t} THEN lo.f + hi.f ELSE 0 END) / (sw - CASE WHEN {t} THEN lo.w + hi.w ELSE 0 END) ELSE s.value END AS value,
    CASE WHEN g.n >= {least} THEN (g.sdist - CASE WHEN {t} THEN lo.d + hi.d ELSE 0 END) / (n - CASE WHEN {t} THEN 2 ELSE 0 END) END AS dist,
    CAST(CASE WHEN g.n >= {least} THEN s.flags | 16 | CASE WHEN g.n = {most} THEN 32 ELSE 0 END WHEN s.{gap.format("s")} AND ({own}) THEN s.flags | 2
      WHEN s.value IS NULL AND s.flags & 3 = 0 AND NOT s.known AND ({own}) THEN 2 ELSE s.flags END AS INTEGER) AS flags
  FROM stack s LEFT JOIN got g USING (year, y, x))"""


def held(source: str, bit: int, name: str) -> str:
    """`name`: `source` with rows whose flags hold `bit` within mean +- 0.9 sd and 2..48."""
    return f"""{name}_lim AS (SELECT *, greatest(mean - 0.9 * sd, 2) AS lo, least(mean + 0.9 * sd, 48) AS hi FROM {source}
), {name} AS MATERIALIZED (
  SELECT year, y, x, mean, sd, dist, CASE WHEN flags & {bit} <> 0 AND value < lo THEN lo WHEN flags & {bit} <> 0 AND value > hi THEN hi ELSE value END AS value,
    CAST(CASE WHEN flags & {bit} <> 0 AND (value < lo OR value > hi) THEN flags | 128 ELSE flags END AS INTEGER) AS flags FROM {name}_lim)"""


def smeared(source: str) -> str:
    """`passes` and `after`: eight scans, each a recursion over the gaps in the order of the scan. `place` is a cell's place
    in it, `d` the anomalies by place; a gap takes the mean of what is around it and gives it on."""
    return f"""ways(pass, by_x, up, over) AS (VALUES (0, 1, 1, 1), (1, 1, -1, 1), (2, 1, 1, -1), (3, 1, -1, -1), (4, 0, 1, 1), (5, 0, 1, -1), (6, 0, -1, 1), (7, 0, -1, -1)),
size AS (SELECT max(y) + 1 AS h, max(x) + 1 AS w FROM cells), turned AS MATERIALIZED (
  SELECT w.pass, s.*, CASE WHEN by_x = 1 THEN x ELSE y END AS o0, CASE WHEN by_x = 1 THEN y ELSE x END AS i0, CASE WHEN by_x = 1 THEN z.w ELSE z.h END AS os, CASE WHEN by_x = 1 THEN z.h ELSE z.w END AS ins, up, over,
    s.flags & 2 <> 0 AND s.flags & 1 = 0 AND s.mean IS NOT NULL AS gap, CASE WHEN s.flags & 1 = 0 THEN s.value - s.mean END AS diff, coalesce(s.dist, 0) AS far
  FROM {source} s CROSS JOIN ways w CROSS JOIN size z
), placed AS MATERIALIZED (
  SELECT *, CASE WHEN up = 1 THEN o0 ELSE os - 1 - o0 END * ins + CASE WHEN over = 1 THEN i0 ELSE ins - 1 - i0 END + 1 AS place FROM turned
), around AS (
  SELECT g.year, g.pass, g.place, list({{'at': n.place, 'far': n.far + sqrt(CAST((n.x - g.x) * (n.x - g.x) + (n.y - g.y) * (n.y - g.y) AS DOUBLE))}}) AS near
  FROM placed g JOIN placed n ON n.year = g.year AND n.pass = g.pass AND abs(n.y - g.y) <= 1 AND abs(n.x - g.x) <= 1 AND n.place <> g.place WHERE g.gap GROUP BY g.year, g.pass, g.place
), turns AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY year, pass ORDER BY place) AS j FROM around
), scan AS (
  SELECT year, pass, CAST(0 AS BIGINT) AS j, list(diff ORDER BY place) AS d, CAST([] AS DOUBLE[]) AS reach FROM placed GROUP BY year, pass
  UNION ALL
  SELECT s.year, s.pass, s.j + 1, CASE WHEN len(k.hit) = 0 THEN s.d ELSE list_concat(list_append(s.d[1 : k.place - 1], list_avg(list_transform(k.hit, lambda e: s.d[e.at]))), s.d[k.place + 1 :]) END,
    list_append(s.reach, list_avg(list_transform(k.hit, lambda e: e.far)))
  FROM scan s JOIN LATERAL (SELECT t.place, list_filter(t.near, lambda e: s.d[e.at] IS NOT NULL) AS hit FROM turns t WHERE t.year = s.year AND t.pass = s.pass AND t.j = s.j + 1) k ON TRUE
), ends AS (
  SELECT * FROM scan QUALIFY j = max(j) OVER (PARTITION BY year, pass)
), passes AS MATERIALIZED (
  SELECT p.year, p.y, p.x, CAST(p.pass AS INTEGER) AS pass, e.d[t.place] + p.mean AS pass_value, e.reach[t.j] AS pass_dist
  FROM turns t JOIN placed p ON p.year = t.year AND p.pass = t.pass AND p.place = t.place JOIN ends e ON e.year = t.year AND e.pass = t.pass WHERE e.d[t.place] IS NOT NULL
), joined8 AS (SELECT year, y, x, avg(pass_value) AS a2_value, avg(pass_dist) AS a2_dist FROM passes GROUP BY year, y, x
), after AS MATERIALIZED (
  SELECT s.year, s.y, s.x, s.mean, s.sd, coalesce(a2_value, s.value) AS value, CASE WHEN a2_value IS NOT NULL THEN a2_dist ELSE s.dist END AS dist,
    CAST(CASE WHEN a2_value IS NOT NULL THEN (s.flags & 253) | 64 ELSE s.flags END AS INTEGER) AS flags FROM {source} s LEFT JOIN joined8 USING (year, y, x))"""


def pipeline() -> str:
    start = left(24, 4, 12, True, "g.year >= 1996")
    return f"{start}, chosen AS (SELECT * FROM left0 WHERE year >= 1996), {held('chosen', 16, 'a1')}, {smeared('a1')}, {held('after', 64, 'whole')}"


SWAPPED = "CASE WHEN d.flags & 16 <> 0 AND d.x % 2 = 0 THEN (d.flags - 16) + 64 ELSE d.flags END"
COMPOSITES = f"""comps AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(1 + 8 * ((dayofyear(l_shipdate) - 1) // 8) AS INTEGER) AS doy, CAST(l_partkey % (6 * {TIMES}) AS INTEGER) AS y, CAST(l_suppkey % (5 * {TIMES}) AS INTEGER) AS x,
    floor(avg(l_quantity) * 1000 + 0.3) / 1000 AS value, max(CASE l_returnflag WHEN 'R' THEN 16 WHEN 'A' THEN 1 ELSE 0 END) AS flags FROM lineitem GROUP BY 1, 2, 3, 4
), months AS (SELECT *, CAST(month(DATE '2001-01-01' + to_days(doy - 1)) AS INTEGER) AS month FROM comps)"""
PERCENT = "(round(100 * avg(CASE WHEN flags & 112 <> 0 THEN 1.0 ELSE 0.0 END), 8) + 0.0) AS filled_percent"
BANDS = f"""items AS (
  SELECT CAST(month(l_shipdate) AS INTEGER) AS month, CAST(l_partkey % (12 * {TIMES}) AS INTEGER) AS y, CAST(l_suppkey % (10 * {TIMES}) AS INTEGER) AS x, l_quantity AS value FROM lineitem
), bands AS (
  SELECT band, y, x, floor(avg(value) * 1000 + 0.3) / 1000 AS mean, floor(stddev_samp(value) * 1000 + 0.3) / 1000 AS sd, count(*) AS n
  FROM (SELECT month AS band, y, x, value FROM items UNION ALL SELECT 13, y, x, value FROM items) GROUP BY band, y, x)"""
SHADE = f"""shade AS (
  SELECT CAST(l_partkey % (12 * {TIMES}) AS INTEGER) AS y, CAST(l_suppkey % (10 * {TIMES}) AS INTEGER) AS x, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) % 256 AS north,
    CAST(sum(CAST(l_quantity AS BIGINT) + 37 * l_linenumber) AS BIGINT) % 256 AS south FROM lineitem GROUP BY 1, 2)"""


def occluded(threshold: int) -> str:
    return f"{SHADE}, dark AS (SELECT y, x, CAST(CASE WHEN y < 4 * {TIMES} THEN north < {threshold} WHEN y >= 8 * {TIMES} THEN south < {threshold} ELSE FALSE END AS INTEGER) AS occluded FROM shade)"


GRAND = """SELECT m.y, m.x, CASE WHEN sum(n) > 0 THEN any_value(gm) END AS mean,
  CASE WHEN sum(n) > 1 THEN sqrt((sum(CASE WHEN n > 1 THEN sd * sd * (n - 1) ELSE 0 END) + sum(n * (mean - gm) * (mean - gm))) / (sum(n) - 1)) END AS sd, CAST(sum(n) AS BIGINT) AS n
FROM {t} m JOIN (SELECT y, x, sum(n * mean) / sum(n) AS gm FROM {t} GROUP BY y, x) USING (y, x) GROUP BY m.y, m.x"""


def _threshold(a: int, b: int) -> str:
    return f"""SELECT y, x, CASE WHEN am IS NULL AND bm IS NULL THEN 0 WHEN bm IS NULL OR am < bm THEN am WHEN am IS NULL OR bm < am THEN bm ELSE am END AS tm,
    CASE WHEN am IS NULL AND bm IS NULL THEN 0 WHEN bm IS NULL OR am < bm THEN asd WHEN am IS NULL OR bm < am THEN bsd ELSE asd END AS ts,
    CASE WHEN am IS NULL AND bm IS NULL THEN 0 WHEN bm IS NULL OR am < bm THEN an WHEN am IS NULL OR bm < am THEN bn ELSE an END AS tn,
    CASE WHEN am IS NULL AND bm IS NULL THEN -13 WHEN bm IS NULL OR am < bm THEN {a} WHEN am IS NULL OR bm < am THEN {b} ELSE 13 END AS src
  FROM (SELECT y, x, max(CASE WHEN band = {a} THEN mean END) AS am, max(CASE WHEN band = {a} THEN sd END) AS asd, max(CASE WHEN band = {a} THEN n END) AS an,
    max(CASE WHEN band = {b} THEN mean END) AS bm, max(CASE WHEN band = {b} THEN sd END) AS bsd, max(CASE WHEN band = {b} THEN n END) AS bn FROM bands GROUP BY y, x)"""


WINTER = f"""WITH {BANDS}, {occluded(200)}, nt AS ({_threshold(4, 9)}), st AS ({_threshold(10, 3)}), rule AS (
  SELECT b.*, d.occluded = 1 AND ((b.y <= 4 * {TIMES} AND band IN (1, 2, 3, 10, 11, 12)) OR (b.y >= 8 * {TIMES} AND band IN (4, 5, 6, 7, 8, 9))) AS winter,
    CASE WHEN b.y <= 4 * {TIMES} THEN nt.tm ELSE st.tm END AS tm, CASE WHEN b.y <= 4 * {TIMES} THEN nt.ts ELSE st.ts END AS ts, CASE WHEN b.y <= 4 * {TIMES} THEN nt.tn ELSE st.tn END AS tn, CASE WHEN b.y <= 4 * {TIMES} THEN nt.src ELSE st.src END AS src
  FROM bands b JOIN nt USING (y, x) JOIN st USING (y, x) LEFT JOIN dark d USING (y, x)
), cut AS (
  SELECT band, y, x, CASE WHEN winter AND mean > tm THEN tm ELSE mean END AS mean, CASE WHEN winter AND mean > tm THEN ts ELSE sd END AS sd,
    CASE WHEN winter AND mean > tm THEN tn ELSE n END AS n, CAST(CASE WHEN winter AND mean > tm THEN src ELSE 0 END AS INTEGER) AS source FROM rule
), changed AS (
  SELECT * FROM cut WHERE band <= 12 AND (y, x) IN (SELECT (y, x) FROM cut WHERE source <> 0)
), again AS ({GRAND.format(t="changed")})
SELECT c.band, c.y, c.x, (round(CASE WHEN band = 13 AND a.y IS NOT NULL THEN a.mean ELSE c.mean END, 8) + 0.0) AS mean, (round(CASE WHEN band = 13 AND a.y IS NOT NULL THEN a.sd ELSE c.sd END, 8) + 0.0) AS sd,
  CASE WHEN band = 13 AND a.y IS NOT NULL THEN a.n ELSE c.n END AS n, source FROM cut c LEFT JOIN again a USING (y, x)"""

PASSES = f"passes AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_partkey % (30 * {TIMES}) AS INTEGER) AS y, CAST(l_suppkey % (24 * {TIMES}) AS INTEGER) AS x, CASE WHEN l_tax > 0.01 THEN l_quantity END AS pass_value, l_discount AS pass_dist FROM lineitem)"

SQL = {
    "grid_complete": f"WITH {GRID} SELECT * FROM grid",
    "aoi_filter": f"WITH {GRID} SELECT * FROM grid WHERE y >= 8 AND y < 28 AND x >= 4 AND x < 24",
    "start_filter": f"WITH {COMPOSITES} SELECT year, doy, y, x, value FROM comps WHERE doy IN (1, 9, 121) AND year * 1000 + doy >= 1998009",
    "stack_positions": f"WITH {OBS} SELECT year, CAST(dense_rank() OVER (ORDER BY year) AS INTEGER) AS pos, cells FROM (SELECT year, count(*) AS cells FROM obs WHERE year <> 1998 GROUP BY year)",
    "synoptic_stats": f"WITH {OBS} SELECT y, x, (round(avg(value), 8) + 0.0) AS mean, (round(stddev_samp(value), 8) + 0.0) AS sd, count(value) AS n FROM obs GROUP BY y, x",
    "monthly_stats": f"""WITH {BANDS} SELECT CAST(m.month AS INTEGER) AS month, a.y, a.x, coalesce(b.mean, a.mean) AS mean, coalesce(b.sd, a.sd) AS sd
FROM (SELECT * FROM bands WHERE band = 13) a CROSS JOIN range(1, 13) m(month) LEFT JOIN (SELECT * FROM bands WHERE band <= 12 AND n > 2) b ON b.band = m.month AND b.y = a.y AND b.x = a.x""",
    "limits_lookup": """WITH n AS (SELECT 'MOD_' || ['LST', 'evi', 'tcb', 'TCW', 'lst_evi'][r_regionkey + 1] || '_Day.tif' AS name FROM region),
l(variable, ceiling, floor) AS (VALUES ('LST', 100e0, -100e0), ('EVI', 1e0, 0e0), ('TCW', 2e0, -1e0), ('TCB', 2e0, -1e0))
SELECT name, any_value(variable) AS variable, any_value(ceiling) AS ceiling, any_value(floor) AS floor FROM n JOIN l ON contains(upper(name), variable) GROUP BY name HAVING count(*) = 1""",
    "filename_parse": """WITH n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'A' || year(o_orderdate) || lpad(CAST(dayofyear(o_orderdate) AS VARCHAR), 3, '0') || '_Filled_Data.tif'
  ELSE 'LST.' || year(o_orderdate) || '.' || lpad(CAST(dayofyear(o_orderdate) AS VARCHAR), 3, '0') || '.mean.1km.mean.tif' END AS name FROM orders)
SELECT o_orderkey, replace(name, 'Day', 'Night') AS name, CAST(CASE WHEN len(string_split(name, '.')) >= 6 THEN string_split(name, '.')[2] ELSE substr(name, 2, 4) END AS INTEGER) AS year,
  CAST(CASE WHEN len(string_split(name, '.')) >= 6 THEN string_split(name, '.')[3] ELSE substr(name, 6, 3) END AS INTEGER) AS doy FROM n""",
    "doy_month_dim": """WITH o AS (SELECT CAST(1 + 8 * ((dayofyear(o_orderdate) - 1) // 8) AS INTEGER) AS doy, count(*) AS orders FROM orders GROUP BY 1)
SELECT doy, CAST(month(DATE '2001-01-01' + to_days(doy - 1)) AS INTEGER) AS month, orders FROM o""",
    "ndv_to_null": "SELECT l_linenumber, count(*) AS cells, count(CASE WHEN l_quantity <= 40 THEN 1 END) AS present FROM lineitem GROUP BY l_linenumber",
    "ocean_neverdata_flags": f"WITH {MARKED} SELECT year, y, x, flags & 1 <> 0 AS ocean, flags & 2 <> 0 AS never, value IS NOT NULL AS present FROM marked",
    "extreme_flags": f"WITH {MARKED} SELECT year, y, x, flags, value FROM marked WHERE flags & 12 <> 0",
    "extreme_offset": f"""WITH {MARKED.replace("SELECT g.*, s.mean, s.sd", "SELECT g.year, g.y, g.x, g.value + 1.5 AS value, s.mean + 1.5 AS mean, s.sd")}
SELECT year, y, x, flags, (round(value, 8) + 0.0) AS value, (round(mean, 8) + 0.0) AS mean, (round(z, 8) + 0.0) AS z FROM zed""",
    "zscore": f"WITH {MARKED} SELECT year, y, x, (round(z, 8) + 0.0) AS z FROM zed WHERE z IS NOT NULL",
    "spiral_offsets": f"WITH {spiral(60)} SELECT k, dx, dy, (round(dist, 8) + 0.0) AS dist, items FROM spiral JOIN (SELECT CAST(l_partkey % 60 + 1 AS INTEGER) AS k, count(*) AS items FROM lineitem GROUP BY 1) USING (k)",
    "despeckle_stack": f"WITH {CLEAN} SELECT year, y, x, value, flags FROM clean",
    "despeckle_counts": f"""WITH {CLEAN} SELECT year, count(*) AS cells, count(*) FILTER (flags & 1 <> 0) AS ocean, count(*) FILTER (flags & 2 <> 0) AS never, count(*) FILTER (flags & 4 <> 0) AS extreme,
count(*) FILTER (flags & 8 <> 0) AS speckle, count(value) AS good, count(*) FILTER (value IS NULL AND flags & 3 = 0) AS gaps FROM clean GROUP BY year""",
    "known_unfillable": f"WITH {GRID} SELECT y, x FROM grid GROUP BY y, x HAVING max(value) IS NULL",
    "a1_pairs": f"WITH {pairs(8, 8)} SELECT year, y, x, CAST(rn AS INTEGER) AS rn, CAST(dz AS INTEGER) AS dz, k, (round(dist, 8) + 0.0) AS dist, (round(diff, 8) + 0.0) AS diff, (round(fill, 8) + 0.0) AS fill, (round(weight, 8) + 0.0) AS weight FROM used",
    "a1_fill_diff": f"WITH {filled(8, 2, 8)} {OUT} done",
    "a1_fill_trim": f"WITH {filled(24, 4, 12, True)} {OUT} done",
    "a1_fill_ratio": f"WITH {filled(8, 2, 8, False, True)} {OUT} done",
    "a1_start_year": f"WITH {filled(8, 2, 8, target='g.year >= 1998')} {OUT} done WHERE year >= 1998",
    "a1_fill_tiles": f"WITH {filled(24, 4, 12, True)} {OUT} done",
    "a1_fill_default": f"WITH {filled(3142, 480, 960, True)} {OUT} done",
    "despeckle_default": f"WITH {cleaned(marked(2.58, 1.64), 3142, 320, 640, 0.2)} SELECT year, y, x, value, flags FROM clean",
    "a1_counts": f"""WITH {filled(24, 4, 12, True)} SELECT year, count(*) AS cells, count(*) FILTER (gap) AS gaps, count(*) FILTER (flags & 32 <> 0) AS "full", count(*) FILTER (flags & 48 = 16) AS partial,
count(*) FILTER (gap AND n > 0 AND flags & 16 = 0) AS insufficient, count(*) FILTER (gap AND n = 0) AS none, CAST(sum(CASE WHEN gap THEN n END) AS BIGINT) AS pairs FROM done GROUP BY year""",
    "clip_a1": f"WITH {clipped('d.flags', 16)} {OUT} cut",
    "clip_a2": f"WITH {clipped(SWAPPED, 64)} {OUT} cut",
    "a2_anomaly": f"WITH {MARKED} SELECT year, y, x, (round(value - mean, 8) + 0.0) AS anomaly FROM marked WHERE flags & 1 = 0 AND value IS NOT NULL AND mean IS NOT NULL",
    "a2_pass": f"WITH RECURSIVE {left(8, 2, 8)}, {smeared('left0')} SELECT year, y, x, pass, (round(pass_value, 8) + 0.0) AS pass_value, (round(pass_dist, 8) + 0.0) AS pass_dist FROM passes",
    "a2_fill": f"WITH RECURSIVE {left(8, 2, 8)}, {smeared('left0')} {OUT} after",
    "fill_pipeline": f"WITH RECURSIVE {pipeline()} {OUT} whole",
    "fill_counts": f"""WITH RECURSIVE {pipeline()} SELECT year, count(*) FILTER (flags & 64 <> 0) AS filled, count(*) FILTER (flags & 2 <> 0) AS "left", count(*) FILTER (flags & 128 <> 0) AS clipped FROM whole GROUP BY year""",
    "a2_combine": f"WITH {PASSES} SELECT year, y, x, count(pass_value) AS n_passes, (round(avg(pass_value), 8) + 0.0) AS a2_value, (round(avg(pass_dist), 8) + 0.0) AS a2_dist FROM passes GROUP BY year, y, x",
    "a2_combine_median": f"WITH {PASSES} SELECT year, y, x, count(pass_value) AS n_passes, (round(median(pass_value), 8) + 0.0) AS a2_value, (round(avg(pass_dist), 8) + 0.0) AS a2_dist FROM passes GROUP BY year, y, x",
    "monthly_mean": f"WITH {COMPOSITES} SELECT year, month, y, x, (round(avg(value), 8) + 0.0) AS value FROM months GROUP BY year, month, y, x",
    "annual_mean": f"WITH {COMPOSITES} SELECT year, y, x, (round(avg(value), 8) + 0.0) AS value FROM comps GROUP BY year, y, x",
    "fill_proportion": f"WITH {COMPOSITES} SELECT year, month, y, x, (round(avg(value), 8) + 0.0) AS value, {PERCENT} FROM months GROUP BY year, month, y, x",
    "month_and_year": f"WITH {COMPOSITES} SELECT year, coalesce(month, 0) AS month, y, x, (round(avg(value), 8) + 0.0) AS value, {PERCENT} FROM months GROUP BY GROUPING SETS ((year, month, y, x), (year, y, x))",
    "diurnal_difference": """WITH i AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS doy, CAST(l_partkey % 6 AS INTEGER) AS y, CAST(l_suppkey % 5 AS INTEGER) AS x, l_linestatus AS s, floor(avg(l_quantity) * 1000 + 0.3) / 1000 AS value
FROM lineitem GROUP BY 1, 2, 3, 4, 5) SELECT d.year, d.doy, d.y, d.x, (round(d.value - n.value, 8) + 0.0) AS value FROM i d JOIN i n ON n.year = d.year AND n.doy = d.doy AND n.y = d.y AND n.x = d.x WHERE d.s = 'O' AND n.s = 'F'""",
    "occlusion_mask": f"WITH {occluded(120)} SELECT y, x, occluded FROM dark",
    "dilate8": f"WITH {occluded(40)} SELECT a.y, a.x, max(b.occluded) AS occluded FROM dark a JOIN dark b ON abs(a.y - b.y) <= 2 AND abs(a.x - b.x) <= 2 GROUP BY a.y, a.x",
    "dilate_far": f"""WITH m AS (
  SELECT y, x, CASE WHEN (y * 7 + x) % 13 = 0 THEN o ELSE 0 END AS occluded FROM (
    SELECT CAST(l_partkey % (40 * {TIMES}) AS INTEGER) AS y, CAST(l_orderkey % (200 * {TIMES}) AS INTEGER) AS x, max(CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END) AS o FROM lineitem GROUP BY 1, 2)
), grown AS (
  SELECT DISTINCT y + dy AS y, x + dx AS x FROM m, range(-10, 11) a(dy), range(-10, 11) b(dx) WHERE occluded = 1
) SELECT m.y, m.x, CAST(g.y IS NOT NULL AS INTEGER) AS occluded FROM m LEFT JOIN grown g USING (y, x)""",
    "period_state": f"WITH {COMPOSITES} SELECT year, coalesce(month, 0) AS month, y, x, (round(avg(value), 8) + 0.0) AS value, {PERCENT} FROM months GROUP BY GROUPING SETS ((year, month, y, x), (year, y, x))",
    "winter_min_cut": WINTER,
    "grand_stats": f"WITH {BANDS}, months AS (SELECT * FROM bands WHERE band <= 12), g AS ({GRAND.format(t='months')}) SELECT y, x, (round(mean, 8) + 0.0) AS mean, (round(sd, 8) + 0.0) AS sd, n FROM g",
    "raster_window": f"""WITH i AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_linenumber * 8 + 1 AS INTEGER) AS doy, CAST(l_partkey % (30 * {TIMES}) AS INTEGER) AS y, CAST(l_suppkey % (24 * {TIMES}) AS INTEGER) AS x, l_quantity FROM lineitem)
SELECT year, doy, y, x, floor(avg(l_quantity) * 1000 + 0.3) / 1000 AS value FROM i WHERE doy IN (9, 25) AND y >= 5 AND y < 21 AND x BETWEEN 3 AND 11 GROUP BY year, doy, y, x""",
    "raster_bands": f"""WITH i AS (SELECT CAST(month(l_shipdate) AS INTEGER) AS month, CAST(l_partkey % (30 * {TIMES}) AS INTEGER) AS y, CAST(l_suppkey % (24 * {TIMES}) AS INTEGER) AS x, l_quantity AS value FROM lineitem)
SELECT CAST(band AS INTEGER) AS band, y, x, floor(avg(value) * 1000 + 0.3) / 1000 AS mean FROM (SELECT month AS band, y, x, value FROM i UNION ALL SELECT 13, y, x, value FROM i) WHERE band IN (7, 13) AND x >= 4 AND x < 9 GROUP BY band, y, x""",
    "flag_decode": f"WITH {clipped('d.flags', 16)} SELECT year, "
    + ", ".join(f"count(*) FILTER (flags & {bit} <> 0) AS {name}" for name, bit in (("ocean", 1), ("failure", 2), ("extreme", 4), ("speckle", 8), ("a1_filled", 16), ("a1_full", 32), ("a2_filled", 64), ("clipped", 128)))
    + " FROM cut GROUP BY year",
}
