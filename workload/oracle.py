"""The same results in plain SQL, for checking against another engine."""

from __future__ import annotations

_CUSTOMERS = """
customers AS (
  SELECT c_custkey,
         CAST(1 + r_regionkey AS BIGINT) AS region_node,
         CAST(100 + n_nationkey AS BIGINT) AS nation_node,
         CAST(1000 + c_custkey AS BIGINT) AS customer_node,
         r_name, n_name,
         CASE c_mktsegment WHEN 'MACHINERY' THEN 'MPI_' WHEN 'BUILDING' THEN '!$omp ' ELSE '' END
           || c_name AS customer_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey),
placed AS (
  SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS BIGINT) AS experiment_id,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) - 1 AS process,
         CASE o_orderstatus WHEN 'P' THEN region_node WHEN 'O' THEN nation_node
              ELSE customer_node END AS cnode_id
  FROM orders JOIN customers ON o_custkey = c_custkey),
experiments AS (SELECT DISTINCT experiment_id FROM placed)"""

_FACTS = """
cells AS (
  SELECT experiment_id, cnode_id, 7 * process + l_linenumber - 1 AS thread_id,
         sum(l_extendedprice * (1 - l_discount)) AS t_time,
         CAST(count(*) AS DOUBLE) AS t_visits, sum(l_quantity) AS t_bytes
  FROM lineitem JOIN placed ON l_orderkey = o_orderkey
  GROUP BY ALL),
facts AS (
  SELECT experiment_id, 'time' AS metric, cnode_id, thread_id, t_time AS value FROM cells
  UNION ALL SELECT experiment_id, 'visits', cnode_id, thread_id, t_visits FROM cells
  UNION ALL SELECT experiment_id, 'bytes', cnode_id, thread_id, t_bytes FROM cells)"""

_TREE = """
visited AS (
  SELECT DISTINCT experiment_id, customers.*
  FROM placed JOIN customers ON o_custkey = c_custkey),
cnodes AS (
  SELECT DISTINCT experiment_id, CAST(0 AS BIGINT) AS cnode_id, 'main' AS region_name,
         CAST(NULL AS BIGINT) AS parent_id FROM visited
  UNION SELECT experiment_id, region_node, r_name, 0 FROM visited
  UNION SELECT experiment_id, nation_node, n_name, region_node FROM visited
  UNION SELECT experiment_id, customer_node, customer_name, nation_node FROM visited),
tree AS (
  SELECT experiment_id, cnode_id, region_name, parent_id, CAST(0 AS BIGINT) AS depth,
         [cnode_id] AS ids, region_name AS path
  FROM cnodes WHERE parent_id IS NULL
  UNION ALL
  SELECT c.experiment_id, c.cnode_id, c.region_name, c.parent_id, t.depth + 1,
         list_append(t.ids, c.cnode_id), t.path || '/' || c.region_name
  FROM cnodes c JOIN tree t ON c.experiment_id = t.experiment_id AND c.parent_id = t.cnode_id),
classed AS (
  SELECT *, CASE WHEN starts_with(region_name, 'MPI_') THEN 'MPI'
                 WHEN starts_with(region_name, '!$omp') THEN 'OMP' ELSE 'USR' END AS path_class
  FROM tree)"""

_LOCATIONS = """
locations AS (
  SELECT experiment_id, id AS thread_id, 'machine 0' AS machine,
         'node ' || (id // 14) AS node, 'rank ' || (id // 7) AS process,
         'thread ' || (id % 7) AS thread
  FROM experiments, (SELECT unnest(range(35)) AS id) ids)"""

_INCL = """
own AS (
  SELECT experiment_id, metric, cnode_id, sum(value) AS value FROM facts GROUP BY ALL),
totals AS (SELECT experiment_id, metric, sum(value) AS total FROM own GROUP BY ALL),
charged AS (
  SELECT t.experiment_id, t.cnode_id AS below, unnest(t.ids) AS cnode_id FROM tree t),
incl AS (
  SELECT c.experiment_id, o.metric, c.cnode_id, sum(o.value) AS value
  FROM charged c JOIN own o ON o.experiment_id = c.experiment_id AND o.cnode_id = c.below
  GROUP BY ALL)"""

_STATS = """
per_thread AS (
  SELECT f.experiment_id, f.metric, f.thread_id, c.cnode_id AS region_id, true AS inclusive,
         sum(f.value) AS value
  FROM facts f JOIN charged c ON f.experiment_id = c.experiment_id AND f.cnode_id = c.below
  GROUP BY ALL
  UNION ALL
  SELECT experiment_id, metric, thread_id, cnode_id, false, sum(value) FROM facts GROUP BY ALL),
labels_wanted AS (
  SELECT experiment_id, cnode_id AS region_id, region_name, metric, inclusive,
         CASE WHEN inclusive THEN 'INCL(' ELSE 'EXCL(' END || region_name || ')' AS routine
  FROM cnodes, (SELECT unnest([{metrics}]) AS metric), (SELECT unnest([true, false]) AS inclusive)),
dense AS (
  SELECT w.*, l.thread_id, coalesce(p.value, 0) AS value
  FROM labels_wanted w JOIN locations l ON w.experiment_id = l.experiment_id
  LEFT JOIN per_thread p ON p.experiment_id = w.experiment_id AND p.metric = w.metric
       AND p.region_id = w.region_id AND p.inclusive = w.inclusive
       AND p.thread_id = l.thread_id)"""

_NAMED = """
named AS (
  SELECT f.experiment_id, f.metric, t.path, 'rank ' || (f.thread_id // 7) AS process,
         'thread ' || (f.thread_id % 7) AS thread, f.value
  FROM facts f JOIN tree t ON f.experiment_id = t.experiment_id AND f.cnode_id = t.cnode_id)"""

_PAIRS = """
pairs AS (
  SELECT a.experiment_id AS result_id, b.experiment_id AS other_id
  FROM experiments a JOIN experiments b ON b.experiment_id = a.experiment_id + 1)"""

_DELTA = """
signed AS (
  SELECT result_id, metric, path, process, thread, value
  FROM named JOIN pairs ON experiment_id = result_id
  UNION ALL
  SELECT result_id, metric, path, process, thread, -value
  FROM named JOIN pairs ON experiment_id = other_id)"""

_DELTA_TREE = """
delta_nodes AS (
  SELECT result_id, path, any_value(region_name) AS name, any_value(depth) AS depth,
         any_value(path_class) AS path_class
  FROM classed JOIN pairs ON experiment_id IN (result_id, other_id)
  GROUP BY result_id, path),
delta_incl AS (
  SELECT n.result_id, n.path, n.name, n.depth, n.path_class, coalesce(sum(s.value), 0) AS value
  FROM delta_nodes n
  LEFT JOIN (
    SELECT result_id, array_to_string(list_slice(string_split(path, '/'), 1, k), '/') AS path,
           sum(value) AS value
    FROM signed, (SELECT unnest([1, 2, 3, 4]) AS k)
    WHERE metric = 'time' AND k <= len(string_split(path, '/'))
    GROUP BY ALL) s ON s.result_id = n.result_id AND s.path = n.path
  GROUP BY ALL)"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE" + ",".join(parts)


def _calltree(metric: str, source: str, where: str = "", columns: str = "") -> str:
    wanted = columns or (
        "experiment_id, cnode_id, region_name AS name,"
        " path_class || ':/' || path AS callpath, path_class, value, pct, depth"
    )
    return f"""{_with(_CUSTOMERS, _FACTS, _TREE, _INCL)},
shown AS (
  SELECT c.*, round(coalesce(v.value, 0), 4) + 0.0 AS value,
         round(CASE WHEN s.total <> 0 THEN coalesce(v.value, 0) / s.total * 100 ELSE 0 END, 6)
           AS pct,
         CASE WHEN s.total <> 0 THEN coalesce(v.value, 0) / s.total * 100 ELSE 0 END AS raw_pct
  FROM classed c
  JOIN totals s ON s.experiment_id = c.experiment_id AND s.metric = '{metric}'
  LEFT JOIN {source} v ON v.experiment_id = c.experiment_id AND v.cnode_id = c.cnode_id
       AND v.metric = '{metric}')
SELECT {wanted} FROM shown {where}"""


def _stat(metrics: str, where: str, variance: str) -> str:
    return f"""{_with(_CUSTOMERS, _FACTS, _TREE, _LOCATIONS, _INCL, _STATS.format(metrics=metrics))}
SELECT experiment_id, metric, routine, region_id, count(*) AS count, round(sum(value), 4) AS sum,
       round(avg(value), 6) AS mean, round({variance}(value), 0) AS variance,
       round(min(value), 4) AS minimum, round(max(value), 4) AS maximum
FROM dense {where}
GROUP BY experiment_id, metric, routine, region_id"""


_FLAT = f"""{_with(_CUSTOMERS, _FACTS, _TREE, _INCL)},
flat AS (
  SELECT c.experiment_id, c.region_name AS routine, c.cnode_id AS region_id,
         coalesce(sum(o.value) FILTER (o.metric = 'visits'), 0) AS calls,
         coalesce(sum(o.value) FILTER (o.metric = 'time'), 0) AS time
  FROM cnodes c LEFT JOIN own o ON o.experiment_id = c.experiment_id AND o.cnode_id = c.cnode_id
  GROUP BY ALL)
SELECT experiment_id, 'time' AS metric, routine,{{region}} CAST(calls AS BIGINT) AS count,
       round(time, 4) AS sum, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS variance,
       CAST(NULL AS DOUBLE) AS minimum, CAST(NULL AS DOUBLE) AS maximum
FROM flat {{first}}"""

_FIRST = "QUALIFY row_number() OVER (PARTITION BY experiment_id ORDER BY time DESC, region_id) <= 25"

_INFO_BASIC = f"""{_with(_CUSTOMERS, _FACTS, _LOCATIONS)},
per_location AS (
  SELECT experiment_id, thread_id, sum(value) AS value FROM facts WHERE metric = 'time'
  GROUP BY ALL)
SELECT l.experiment_id, count(DISTINCT node) AS nodes, count(DISTINCT process) AS processes,
       round(max(p.value), 4) AS wallclock_time
FROM locations l
LEFT JOIN per_location p ON p.experiment_id = l.experiment_id AND p.thread_id = l.thread_id
GROUP BY l.experiment_id"""

_DUMP_INCL = f"""{_with(_CUSTOMERS, _FACTS, _TREE, _INCL)}
SELECT c.experiment_id, c.cnode_id, f.thread_id, f.metric, round(sum(f.value), 4) AS value
FROM facts f JOIN charged c ON f.experiment_id = c.experiment_id AND f.cnode_id = c.below
WHERE {{where}}
GROUP BY c.experiment_id, c.cnode_id, f.thread_id, f.metric"""

_DIFF_KEEP = f"""{_with(_CUSTOMERS, _FACTS, _TREE, _NAMED, _PAIRS, _DELTA)}
SELECT result_id AS experiment_id, metric, path, {{place}}, round(sum(value), 4) + 0.0 AS value
FROM signed GROUP BY result_id, metric, path{{group}}"""

_HOT = """
ranked AS (
  SELECT experiment_id, cnode_id,
         row_number() OVER (PARTITION BY experiment_id ORDER BY value DESC, cnode_id) AS rank
  FROM own WHERE metric = 'time'),
hot AS (
  SELECT f.experiment_id, f.cnode_id, f.thread_id, c.region_name AS name, f.value
  FROM facts f JOIN ranked r ON f.experiment_id = r.experiment_id AND f.cnode_id = r.cnode_id
  JOIN cnodes c ON f.experiment_id = c.experiment_id AND f.cnode_id = c.cnode_id
  WHERE f.metric = 'time' AND r.rank <= {k})"""


def all_oracles() -> dict[str, str]:
    base = _with(_CUSTOMERS, _FACTS)
    nodes = _with(_CUSTOMERS, _TREE)
    calltree_incl = _calltree("time", "incl")
    numbered = (
        "row_number() OVER (PARTITION BY experiment_id ORDER BY ids) - 1 AS cnode_id"
    )
    return {
        "metric_dim": f"""WITH {_CUSTOMERS}
SELECT experiment_id, m.* FROM experiments, (VALUES
  ('time', 'Time', 'DOUBLE', 'sec', 'discounted price'),
  ('visits', 'Visits', 'UINT64', 'occ', 'order lines'),
  ('bytes', 'Bytes', 'DOUBLE', 'bytes', 'quantity'))
  m(name, display_name, dtype, uom, description)""",
        "system_dim": f"""WITH {_CUSTOMERS}, {_LOCATIONS} SELECT * FROM locations""",
        "cnode_dim": f"""{nodes}
SELECT experiment_id, cnode_id, region_name, '' AS file, CAST(0 AS BIGINT) AS line, parent_id,
       depth FROM tree""",
        "metric_values": f"""{base}
SELECT experiment_id, cnode_id, thread_id, round(value, 4) AS value
FROM facts WHERE metric = 'time'""",
        "tree_size": f"""{nodes}
SELECT experiment_id, count(*) AS nodes, max(depth) AS max_depth FROM tree GROUP BY 1""",
        "layout_summary": f"""WITH {_CUSTOMERS}, {_LOCATIONS}
SELECT experiment_id, machine, node, count(DISTINCT process) AS processes,
       count(DISTINCT thread) AS threads FROM locations GROUP BY 1, 2, 3""",
        "preorder_rows": f"""{nodes}
SELECT experiment_id, row_number() OVER (PARTITION BY experiment_id ORDER BY ids) - 1 AS row_no,
       cnode_id, array_to_string(ids, '/') AS id_path FROM tree""",
        "calltree_incl": calltree_incl,
        "calltree_excl": _calltree("time", "own"),
        "calltree_threshold": _calltree("bytes", "incl", "WHERE abs(raw_pct) >= 1.5"),
        "info_tree": _calltree(
            "visits",
            "incl",
            columns="experiment_id, 'visits' AS metric, value, cnode_id, region_name AS name, depth",
        ),
        "tree_view": _calltree(
            "time",
            "incl",
            columns="experiment_id, cnode_id, value, pct,"
            " repeat('  ', depth) || region_name AS label",
        ),
        "info_basic": _INFO_BASIC,
        "dump_aggr": f"""{base}
SELECT experiment_id, cnode_id, CAST(-1 AS BIGINT) AS thread_id, metric,
       round(sum(value), 4) AS value
FROM facts WHERE metric IN ('time', 'bytes') GROUP BY experiment_id, cnode_id, metric""",
        "dump_thread": f"""{base}
SELECT experiment_id, cnode_id, thread_id, metric, round(value, 4) AS value
FROM facts WHERE metric IN ('time', 'visits')""",
        "dump_incl": _DUMP_INCL.format(where="f.metric = 'time'"),
        "dump_selection": _DUMP_INCL.format(
            where="f.metric IN ('time', 'visits') AND (f.thread_id <= 7 OR f.thread_id = 21)"
            " AND (c.cnode_id IN (0, 1, 3, 4, 5) OR c.cnode_id BETWEEN 100 AND 124)"
        ),
        "exclusive_from_inclusive": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _INCL)},
touched AS (
  SELECT DISTINCT f.experiment_id, f.metric, c.cnode_id, f.thread_id
  FROM facts f JOIN charged c ON f.experiment_id = c.experiment_id AND f.cnode_id = c.below
  WHERE f.metric = 'time')
SELECT t.experiment_id, t.metric, t.cnode_id, t.thread_id,
       round(coalesce(f.value, 0), 4) + 0.0 AS value
FROM touched t LEFT JOIN facts f USING (experiment_id, metric, cnode_id, thread_id)""",
        "stat_routines": _stat("'time', 'visits'", "", "var_samp"),
        "stat_filtered": _stat(
            "'time'",
            "WHERE region_name IN ('main', 'ASIA', 'EUROPE', 'NATION_7', 'NATION_12')",
            "var_pop",
        ),
        "stat_quartiles": _with(
            _CUSTOMERS, _FACTS, _TREE, _LOCATIONS, _INCL, _STATS.format(metrics="'time'")
        )
        + """
SELECT experiment_id, metric, region_id, routine,
       round(quantile_cont(value, 0.25), 6) AS quartile_25,
       round(quantile_cont(value, 0.5), 6) AS median,
       round(quantile_cont(value, 0.75), 6) AS quartile_75
FROM dense GROUP BY experiment_id, metric, region_id, routine""",
        "stat_top_n": _FLAT.format(region=" region_id,", first=_FIRST),
        "diff_keep": _DIFF_KEEP.format(place="process, thread", group=", process, thread"),
        "diff_collapse": _DIFF_KEEP.format(
            place="'all' AS process, 'all' AS thread", group=""
        ),
        "diff_reduce": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _NAMED)}
SELECT experiment_id, metric, path, process, 'all' AS thread,
       round(coalesce(sum(value) FILTER (thread IN ('thread 4', 'thread 5', 'thread 6')), 0), 4)
         AS value
FROM named GROUP BY experiment_id, metric, path, process""",
        "merge": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _NAMED, _PAIRS)},
kept AS (
  SELECT * FROM named
  WHERE metric = 'visits' OR (metric = 'time') = (experiment_id % 2 = 1))
SELECT result_id AS experiment_id, metric, path, process, thread, round(value, 4) AS value
FROM kept JOIN pairs ON experiment_id = result_id
UNION ALL
SELECT result_id, metric, path, process, thread, round(value, 4)
FROM kept JOIN pairs ON experiment_id = other_id WHERE metric <> 'visits'""",
        "mean": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _NAMED)}
SELECT CAST(0 AS BIGINT) AS experiment_id, metric, path, process, thread,
       round(sum(value) / (SELECT count(*) FROM experiments), 5) AS value
FROM named GROUP BY metric, path, process, thread""",
        "cmp_summary": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _NAMED, _PAIRS)},
sides AS (
  SELECT result_id, metric, path, process, thread,
         coalesce(sum(value) FILTER (experiment_id = result_id), 0) AS l,
         coalesce(sum(value) FILTER (experiment_id = other_id), 0) AS r
  FROM named JOIN pairs ON experiment_id IN (result_id, other_id)
  GROUP BY ALL),
found AS (
  SELECT result_id FROM sides WHERE l <> r
  UNION ALL
  SELECT result_id FROM (
    SELECT result_id, path FROM tree JOIN pairs ON experiment_id IN (result_id, other_id)
    GROUP BY ALL HAVING count(*) = 1))
SELECT p.result_id AS experiment_id, count(f.result_id) = 0 AS equal,
       count(f.result_id) AS n_diff
FROM pairs p LEFT JOIN found f ON f.result_id = p.result_id GROUP BY p.result_id""",
        "cmp_details": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _NAMED, _LOCATIONS)}
SELECT experiment_id, 'value' AS kind,
       metric || ' @ ' || path || ' @ machine 0/node '
         || (CAST(substr(process, 6) AS BIGINT) // 2) || '/' || process || '/' || thread AS item,
       round(value, 4) AS left, CAST(0 AS DOUBLE) AS right
FROM named WHERE thread IN ('thread 4', 'thread 5', 'thread 6')
UNION ALL
SELECT experiment_id, 'location', machine || '/' || node || '/' || process || '/' || thread,
       1.0, 0.0
FROM locations WHERE thread IN ('thread 4', 'thread 5', 'thread 6')""",
        "diff_calltree": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _NAMED, _PAIRS, _DELTA, _DELTA_TREE)}
SELECT result_id AS experiment_id, name, path_class || ':/' || path AS callpath,
       round(value, 4) + 0.0 AS value, depth FROM delta_incl""",
        "diff_top15": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _NAMED, _PAIRS, _DELTA, _DELTA_TREE)}
SELECT result_id AS experiment_id, name, path_class || ':/' || path AS callpath,
       round(value, 4) + 0.0 AS value, depth
FROM delta_incl WHERE path_class IN ('USR', 'MPI')
QUALIFY row_number() OVER (PARTITION BY result_id
  ORDER BY abs(value) DESC, path_class || ':/' || path) <= 15""",
        "top_self_time": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _INCL)}
SELECT c.experiment_id, c.cnode_id, c.region_name AS name, round(coalesce(o.value, 0), 4) AS value,
       CASE path_class WHEN 'USR' THEN 'user code' ELSE 'MPI' END AS label
FROM classed c LEFT JOIN own o
  ON o.experiment_id = c.experiment_id AND o.cnode_id = c.cnode_id AND o.metric = 'time'
WHERE path_class IN ('USR', 'MPI')
QUALIFY row_number() OVER (PARTITION BY c.experiment_id
  ORDER BY coalesce(o.value, 0) DESC, c.cnode_id) <= 15""",
        "stat_incl_errorbars": _with(
            _CUSTOMERS, _FACTS, _TREE, _LOCATIONS, _INCL, _STATS.format(metrics="'time', 'bytes'")
        )
        + """
SELECT experiment_id, metric, region_id, region_name AS routine, round(avg(value), 6) AS mean,
       round(avg(value) - min(value), 5) AS err_low, round(max(value) - avg(value), 5) AS err_high
FROM dense WHERE inclusive GROUP BY experiment_id, metric, region_id, region_name""",
        "hottest_cnode_threads": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _INCL, _HOT.format(k=1))}
SELECT experiment_id, cnode_id, thread_id, name, round(value, 4) AS value FROM hot""",
        "imbalance_top10": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _INCL, _HOT.format(k=10))}
SELECT experiment_id, cnode_id, thread_id, name, round(value, 4) AS value,
       count(*) OVER w AS values, round(sum(value) OVER w, 4) AS total,
       round(max(value) OVER w / avg(value) OVER w, 6) AS imbalance
FROM hot WINDOW w AS (PARTITION BY experiment_id, cnode_id)""",
        "load_stat": f"""SELECT * EXCLUDE (region_id)
FROM ({_stat("'time', 'visits'", "", "var_samp")})""",
        "load_flat": _FLAT.format(region="", first=""),
        "load_basic": _INFO_BASIC,
        "load_tree": _calltree(
            "time",
            "incl",
            columns=f"experiment_id, 'Time' AS metric, value, {numbered}, region_name AS name, depth",
        ),
        "load_calltree": _calltree(
            "time",
            "incl",
            columns=f"experiment_id, {numbered}, region_name AS name,"
            " path_class || ':/' || path AS callpath, value, pct, depth",
        ),
        "load_dump": f"""{base}
SELECT experiment_id, cnode_id, thread_id, metric, round(value, 4) AS value FROM facts""",
        "load_rejects": f"""WITH {_CUSTOMERS}
SELECT loader, experiment_id, reason FROM experiments, (VALUES
  ('dump', 'missing required ''Cnode ID'' column'),
  ('stat', 'missing columns: cube::Metric, Routine, Count, Sum, Mean, Variance, Minimum, Maximum'),
  ('tree', 'unexpected header: cube::Region,Number of Calls,Exclusive Time')) r(loader, reason)""",
        "calltree_derived": calltree_incl,
        "profile_from_reports": calltree_incl,
        "profile_rejects": f"""{base}
SELECT experiment_id, 'unknown thread' AS reason, count(*) AS values FROM facts
WHERE thread_id >= 28 GROUP BY experiment_id
UNION ALL
SELECT experiment_id, 'summary has 5 processes, the locations have 4', 0 FROM experiments""",
        "calltree_combined": _calltree(
            "visits",
            "incl",
            columns="experiment_id, cnode_id, region_name AS name, cls || ':/' || path AS callpath,"
            " cls AS path_class, value, pct, depth FROM (SELECT *, CASE WHEN path_class = 'USR' AND"
            " EXISTS (SELECT 1 FROM classed b WHERE b.experiment_id = shown.experiment_id"
            " AND list_contains(b.ids, shown.cnode_id) AND b.path_class IN ('MPI', 'OMP'))"
            " THEN 'COM' ELSE path_class END AS cls",
            where=") named",
        ),
        "dump_incl_intervals": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _INCL)},
groups AS (SELECT DISTINCT experiment_id, metric FROM facts)
SELECT t.experiment_id, g.metric, t.cnode_id, round(coalesce(i.value, 0), 4) AS value
FROM tree t JOIN groups g USING (experiment_id)
LEFT JOIN incl i ON i.experiment_id = t.experiment_id AND i.cnode_id = t.cnode_id
     AND i.metric = g.metric""",
        "layout_sketched": f"""WITH {_CUSTOMERS}, {_LOCATIONS}
SELECT machine, node, count(DISTINCT process) AS processes, count(DISTINCT thread) AS threads
FROM locations GROUP BY machine, node""",
        "stat_quartiles_sketched": _with(
            _CUSTOMERS, _FACTS, _TREE, _LOCATIONS, _INCL, _STATS.format(metrics="'time'")
        )
        + """,
sorted AS (
  SELECT experiment_id, metric, region_id, routine, list_sort(list(value)) AS v
  FROM dense GROUP BY ALL)
SELECT experiment_id, metric, region_id, routine,
       round(v[CAST(floor((len(v) - 1) * 0.25) AS BIGINT) + 1], 4) AS quartile_25,
       round(v[CAST(floor((len(v) - 1) * 0.5) AS BIGINT) + 1], 4) AS median,
       round(v[CAST(floor((len(v) - 1) * 0.75) AS BIGINT) + 1], 4) AS quartile_75
FROM sorted""",
        "stat_per_thread": f"""{_with(_CUSTOMERS, _FACTS, _TREE, _INCL)},
routines AS (
  SELECT t.experiment_id, t.cnode_id,
         CASE WHEN t.cnode_id < 1000 THEN t.cnode_id ELSE -1 - ascii(c_mktsegment) END AS region_id,
         CASE WHEN t.cnode_id < 1000 THEN t.region_name ELSE c_mktsegment END AS region_name
  FROM tree t LEFT JOIN customer ON t.cnode_id = 1000 + c_custkey),
values_ AS (
  SELECT f.experiment_id, f.metric, f.thread_id, c.cnode_id, true AS inclusive, sum(f.value) AS value
  FROM facts f JOIN charged c ON f.experiment_id = c.experiment_id AND f.cnode_id = c.below
  WHERE f.metric IN ('time', 'visits') GROUP BY ALL
  UNION ALL
  SELECT experiment_id, metric, thread_id, cnode_id, false, value FROM facts
  WHERE metric IN ('time', 'visits')),
used AS (
  SELECT DISTINCT v.experiment_id, v.metric, v.thread_id, v.inclusive, r.region_id
  FROM values_ v JOIN routines r USING (experiment_id, cnode_id)),
samples AS (
  SELECT u.*, r.region_name, r.cnode_id, coalesce(v.value, 0) AS value
  FROM used u JOIN routines r USING (experiment_id, region_id)
  LEFT JOIN values_ v ON v.experiment_id = u.experiment_id AND v.metric = u.metric
    AND v.thread_id = u.thread_id AND v.inclusive = u.inclusive AND v.cnode_id = r.cnode_id)
SELECT experiment_id, metric,
       CASE WHEN inclusive THEN 'INCL(' ELSE 'EXCL(' END || region_name || ')' AS routine,
       CAST(region_id AS BIGINT) AS region_id, thread_id, count(*) AS count,
       round(sum(value), 4) AS sum, round(avg(value), 6) AS mean,
       round(var_samp(value), 0) AS variance, round(min(value), 4) AS minimum,
       round(max(value), 4) AS maximum
FROM samples GROUP BY experiment_id, metric, inclusive, region_name, region_id, thread_id""",
        "cmp_slashed_names": f"""{_with(_CUSTOMERS, _FACTS, _TREE)},
moved AS (
  SELECT experiment_id, 2 * count(*) AS n FROM tree WHERE cnode_id >= 100 GROUP BY 1
  UNION ALL
  SELECT experiment_id, 2 * count(*) FROM facts WHERE cnode_id >= 100 AND value <> 0 GROUP BY 1)
SELECT experiment_id, false AS equal, CAST(sum(n) AS BIGINT) AS n_diff
FROM moved GROUP BY experiment_id""",
    }
