"""The complete density hierarchy of the customers in recursive SQL, for comparison.

A spanning tree grows by one place per step, its edges are put in one by one from short to long, and
the clusters are read off the components that exist at every length.
"""

from __future__ import annotations

TREE = """
raw AS (
  SELECT c_custkey AS id, c_acctbal / 100.0::DOUBLE AS x, c_nationkey::DOUBLE * 2 AS y FROM customer
),
spots AS (SELECT x, y, min(id) AS first, count(*) AS n, row_number() OVER (ORDER BY min(id)) AS node FROM raw GROUP BY x, y),
far AS MATERIALIZED (
  SELECT a.node, b.n, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM spots a, spots b
),
near AS (SELECT node, d, sum(n) OVER (PARTITION BY node ORDER BY d RANGE UNBOUNDED PRECEDING) AS met FROM far),
places AS MATERIALIZED (
  SELECT s.*, m.core FROM spots s JOIN (SELECT node, min(d) AS core FROM near WHERE met >= 5 GROUP BY node) m USING (node)
),
prim(step, node, parent, w, taken) AS (
  SELECT 0, b.node, a.node,
    greatest(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), a.core, b.core), false
  FROM places a JOIN places b ON a.node = 1 AND b.node <> 1
  UNION ALL
  SELECT step + 1, node, CASE WHEN node <> next AND reach < w THEN next ELSE parent END,
    CASE WHEN node <> next AND reach < w THEN reach ELSE w END, node = next
  FROM (
    SELECT p.step, p.node, p.parent, p.w, t.node AS next,
      greatest(sqrt((t.x - m.x) * (t.x - m.x) + (t.y - m.y) * (t.y - m.y)), t.core, m.core) AS reach
    FROM (SELECT node AS next FROM prim WHERE NOT taken ORDER BY w, node LIMIT 1) n
    JOIN places t ON t.node = n.next JOIN prim p ON NOT p.taken JOIN places m ON m.node = p.node
  )
),
lengths AS (SELECT w, row_number() OVER (ORDER BY w) AS l FROM (SELECT DISTINCT w FROM prim WHERE taken)),
edges AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY w, node) AS i, l, node AS a, parent AS b FROM prim JOIN lengths USING (w) WHERE taken
),
comp(i, node, c) AS (
  SELECT 0, node, node FROM places
  UNION ALL
  SELECT e.i, k.node, CASE WHEN k.c IN (x.c, y.c) THEN least(x.c, y.c) ELSE k.c END
  FROM comp k JOIN edges e ON e.i = k.i + 1 JOIN comp x ON x.node = e.a JOIN comp y ON y.node = e.b
),
at_l AS MATERIALIZED (
  SELECT 0 AS l, node, node AS c FROM places
  UNION ALL
  SELECT l, node, c FROM comp JOIN (SELECT l, max(i) AS i FROM edges GROUP BY l) USING (i)
),
large AS MATERIALIZED (SELECT l, c FROM at_l JOIN places USING (node) GROUP BY l, c HAVING sum(n) >= 5),
parts AS (
  SELECT l, c, count(DISTINCT below) AS parts FROM (
    SELECT a.l, a.c, b.c AS below FROM at_l a JOIN at_l b ON b.l = a.l - 1 AND b.node = a.node
    JOIN large x ON x.l = a.l AND x.c = a.c JOIN large y ON y.l = b.l AND y.c = b.c
  ) GROUP BY l, c
),
starts AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY l, c) AS k, l, c, coalesce(parts, 0) AS parts
  FROM large LEFT JOIN parts USING (l, c) WHERE coalesce(parts, 0) <> 1
),
lines AS MATERIALIZED (
  SELECT t.l, t.c, max(s.k) AS k FROM starts s JOIN at_l t ON t.node = s.c AND t.l >= s.l GROUP BY t.l, t.c
),
inside AS MATERIALIZED (SELECT node, k, min(l) AS l FROM at_l JOIN lines USING (l, c) GROUP BY node, k),
weights AS (SELECT l, w, 1 / w AS density FROM lengths UNION ALL SELECT 0, 0.0, 1 / min(w) FROM lengths),
sums AS (SELECT k, sum(n) AS size, sum(n * density) AS mass FROM inside JOIN places USING (node) JOIN weights USING (l) GROUP BY k),
ends AS (
  SELECT s.k, min(p.k) AS parent FROM starts s JOIN at_l t ON t.node = s.c AND t.l > s.l
  JOIN starts p ON p.l = t.l AND p.c = t.c GROUP BY s.k
),
tree AS MATERIALIZED (
  SELECT k, parent, CASE WHEN parent IS NOT NULL THEN weights.w END AS radius,
    mass - size * coalesce(1 / CASE WHEN parent IS NOT NULL THEN weights.w END, 0) AS stability
  FROM sums LEFT JOIN ends USING (k) LEFT JOIN starts p ON p.k = parent LEFT JOIN weights ON weights.l = p.l
),
walk(k, height) AS (
  SELECT k, 0 FROM tree
  UNION
  SELECT t.parent, w.height + 1 FROM walk w JOIN tree t ON t.k = w.k WHERE t.parent IS NOT NULL
),
heights AS MATERIALIZED (SELECT k, max(height) AS height FROM walk GROUP BY k),
best(h, k, best, picked) AS (
  SELECT 0, k, greatest(stability, 0), stability >= 0 AND parent IS NOT NULL FROM tree JOIN heights USING (k) WHERE height = 0
  UNION ALL
  SELECT now.h + 1, t.k, coalesce(d.best, CASE WHEN t.parent IS NULL THEN u.under ELSE greatest(t.stability, u.under) END),
    coalesce(d.picked, t.stability >= u.under AND t.parent IS NOT NULL)
  FROM (SELECT max(h) AS h FROM best) now
  JOIN heights s ON s.height <= now.h + 1 JOIN tree t ON t.k = s.k LEFT JOIN best d ON d.k = t.k
  LEFT JOIN (SELECT x.parent AS k, sum(b.best) AS under FROM best b JOIN tree x ON x.k = b.k GROUP BY x.parent) u ON u.k = t.k
  WHERE now.h < (SELECT max(height) FROM heights)
),
picked AS (SELECT k FROM best WHERE picked AND h = (SELECT max(height) FROM heights)),
above(k, up) AS (
  SELECT k, parent FROM tree WHERE parent IS NOT NULL
  UNION
  SELECT a.k, t.parent FROM above a JOIN tree t ON t.k = a.up WHERE t.parent IS NOT NULL
),
tops AS (SELECT k FROM picked WHERE k NOT IN (SELECT a.k FROM above a JOIN picked p ON p.k = a.up)),
named AS (
  SELECT k, row_number() OVER (ORDER BY min(first)) - 1 AS label
  FROM tops JOIN inside USING (k) JOIN places USING (node) GROUP BY k
),
members AS (
  SELECT x, y, label, radius FROM named JOIN inside USING (k) JOIN places USING (node) JOIN tree USING (k)
)
"""

LABELS = f"""WITH RECURSIVE {TREE}
SELECT raw.id, coalesce(label, -1) AS cluster FROM raw LEFT JOIN members USING (x, y)"""

PREDICTED = f"""WITH RECURSIVE {TREE},
asked AS (SELECT s_suppkey AS id, s_acctbal / 100.0::DOUBLE AS x, s_nationkey::DOUBLE * 2 AS y FROM supplier),
met AS (
  SELECT a.id, m.label, m.radius, sqrt((a.x - m.x) * (a.x - m.x) + (a.y - m.y) * (a.y - m.y)) AS d FROM asked a, members m
),
nearest AS (
  SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY d, label) AS place FROM met WHERE d < radius
)
SELECT a.id, coalesce(label, -1) AS cluster FROM asked a LEFT JOIN nearest n ON n.id = a.id AND place = 1"""
