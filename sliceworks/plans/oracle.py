"""The queries as SQL."""

from __future__ import annotations

from ..functions.labels import SPINE_A, SPINE_B, TISSUES, VERTEBRAE
from ..sources.synthetic import MIN_VOXELS, SQL

KEY = "case_no, x, y, z"
AREAS = [f"mm2_{n.lower()}" for n in TISSUES.values()]


def _case(column: str, mapping: dict, other: str) -> str:
    q = lambda v: f"'{v}'" if isinstance(v, str) else v
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN {q(v)}" for k, v in mapping.items()) + f" ELSE {other} END"


MASK = """CASE WHEN tissue IN (3, 4) AND hu BETWEEN -190 AND -30 THEN 5 WHEN tissue IN (3, 4) AND hu NOT BETWEEN -29 AND 150 THEN 0
 WHEN tissue IN (1, 2) AND hu NOT BETWEEN -190 AND -30 THEN 0 ELSE tissue END"""
VERT = "vh AS (SELECT case_no, z, vert AS label, count(*) AS n FROM voxels GROUP BY ALL)"
SCORE = f"max((CASE WHEN label = 19 THEN 1 WHEN label = 0 OR n < {MIN_VOXELS} THEN 0 ELSE n END) * 256 + 255 - label)"
WIN = f"CAST(255 - ({SCORE}) % 256 AS INT)"
DOM = f"dom AS (SELECT case_no, z, {WIN} AS level FROM vh GROUP BY ALL)"
CSA = f"csa AS (SELECT case_no, z, {', '.join(f'CAST(round_even(count(*) FILTER (t = {k}) * CAST(2.25 AS DOUBLE), 0) AS BIGINT) AS {c}' for k, c in zip(TISSUES, AREAS))} FROM (SELECT *, {MASK} AS t FROM voxels) GROUP BY ALL)"
SPAN = "span AS (SELECT case_no, min(z) AS z0, max(z) AS z1 FROM dom WHERE level <> 0 GROUP BY ALL)"
# labels that dominate the windows of 0 to 20 slices about every slice of the span
CAND = f"""cand AS (SELECT case_no, pos, w, {WIN} AS level FROM (
  SELECT h.case_no, s.pos, w.w, h.label, sum(h.n) AS n
  FROM vh h JOIN (SELECT case_no, z0, z1, unnest(range(z0, z1 + 1)) AS pos FROM span) s ON h.case_no = s.case_no AND h.z BETWEEN s.z0 AND s.z1
  JOIN range(1, 21) w(w) ON abs(h.z - s.pos) <= w.w GROUP BY ALL) GROUP BY ALL)"""
FILLED = """filled AS (SELECT d.case_no, d.z, CASE WHEN d.level = 0 THEN coalesce(f.level, 0) ELSE d.level END AS level
  FROM dom d JOIN span s ON d.case_no = s.case_no AND d.z BETWEEN s.z0 AND s.z1
  LEFT JOIN (SELECT case_no, pos, arg_min(level, w) AS level FROM cand WHERE level <> 0 GROUP BY ALL) f ON f.case_no = d.case_no AND f.pos = d.z)"""


def _rounds() -> str:
    out, before = [], "filled"
    for w in range(1, 11):
        out.append(f"""flag{w} AS (SELECT case_no, z FROM (SELECT *, lag(level) OVER (PARTITION BY case_no ORDER BY z) AS b FROM {before}) WHERE level > b),
round{w} AS (SELECT l.case_no, l.z, CASE WHEN EXISTS (SELECT 1 FROM flag{w} f WHERE f.case_no = l.case_no AND abs(f.z - l.z) <= {w})
  THEN c.level ELSE l.level END AS level FROM {before} l JOIN cand c ON c.case_no = l.case_no AND c.pos = l.z AND c.w = {w})""")
        before = f"round{w}"
    return ",\n".join(out)


FIXED = _rounds()
LEVELS = "lv AS (SELECT d.case_no, d.z, coalesce(r.level, 0) AS level FROM dom d LEFT JOIN round10 r ON r.case_no = d.case_no AND r.z = d.z)"


def _center(levels: str) -> str:
    return f"""center AS (SELECT m.case_no, m.z, m.label AS center FROM (SELECT case_no, label, min(z) AS z FROM (
  SELECT *, sum(n) OVER (PARTITION BY case_no, label ORDER BY z) AS c, sum(n) OVER (PARTITION BY case_no, label) AS t FROM vh WHERE label <> 0)
  WHERE c * 2 >= t GROUP BY ALL) m JOIN {levels} l ON l.case_no = m.case_no AND l.z = m.z AND l.level = m.label),
centroid AS (SELECT m.case_no, m.z, m.label AS centroid FROM (SELECT case_no, label, CAST(round_even(CAST(sum(z * n) AS DOUBLE) / sum(n), 0) AS INT) AS z
  FROM vh WHERE label <> 0 GROUP BY ALL) m JOIN {levels} l ON l.case_no = m.case_no AND l.z = m.z AND l.level = m.label)"""


TABLE = """tab AS (SELECT l.case_no, l.z, l.level, coalesce(c.center, 0) AS center, coalesce(d.centroid, 0) AS centroid
  FROM lv l LEFT JOIN center c ON c.case_no = l.case_no AND c.z = l.z LEFT JOIN centroid d ON d.case_no = l.case_no AND d.z = l.z)"""
NAMED = f"named AS (SELECT case_no, z, {', '.join(f'{_case(c, VERTEBRAE, chr(39) + chr(48) + chr(39))} AS {c}' for c in ('level', 'center', 'centroid'))} FROM tab)"
FRAME = f"frame AS (SELECT n.case_no, n.z AS slice, n.level, n.center, n.centroid, CAST(NULL AS VARCHAR) AS tag, {', '.join(AREAS)} FROM named n JOIN csa c ON c.case_no = n.case_no AND c.z = n.z)"
BASE = f"WITH {SQL}"
HIST = f"{BASE}, {VERT}, {DOM}"
FILL = f"{HIST}, {SPAN}, {CAND}, {FILLED}"
FULL = f"{FILL},\n{FIXED},\n{LEVELS}, {_center('lv')}, {TABLE}, {NAMED}"
WHOLE = f"{FULL}, {CSA}, {FRAME}"
CM = ", ".join(f"CAST({c} AS DOUBLE) / CAST(100 AS DOUBLE) AS {c.replace('mm2', 'csa')}" for c in AREAS)
META = "(SELECT CAST(c_custkey AS INT) AS case_no, c_mktsegment AS pat_sex, c_acctbal AS pat_weight FROM customer)"


def _aggregated(method: str, ref: str | None, source: str = "frame", drop: str = "tag") -> str:
    value = {"mean": "CAST(sum({0}) AS DOUBLE) / count({0})", "median": "median(CAST({0} AS DOUBLE))", "sum": "CAST(sum({0}) AS DOUBLE)"}[method]
    cols = [f"round_even({value.format(c)}, 0) / CAST(100 AS DOUBLE) AS {c.replace('mm2', 'csa')}" for c in AREAS]
    kept = [f"CASE WHEN min({c}) = max({c}) THEN min({c}) END AS {c}" for c in ("slice", "level", "center", "centroid", "tag") if c not in (ref, drop)]
    keys = "case_no" + (f", {ref}" if ref else "")
    return f"SELECT {keys}, {', '.join(cols + kept)} FROM {source}" + (f" WHERE {ref} IS NOT NULL" if ref else "") + f" GROUP BY {keys}"


def _reach(mask: str, near: str, by_slice: bool = False) -> str:
    """comp: for every voxel of the mask the smallest place that neighbours of neighbours lead to."""
    return f"""m AS (SELECT {KEY}, x * 200 + y * 20 + z AS p FROM voxels WHERE {mask}),
e AS (SELECT a.case_no, a.p AS a, b.p AS b FROM m a JOIN m b ON a.case_no = b.case_no AND {near}),
reach AS (SELECT case_no, p AS a, p AS b FROM m UNION SELECT r.case_no, r.a, e.b FROM reach r JOIN e ON e.case_no = r.case_no AND e.a = r.b),
comp AS MATERIALIZED (SELECT case_no, a AS p, min(b) AS c FROM reach GROUP BY ALL)"""


NEAR2 = "a.z = b.z AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1"
NEAR3 = "abs(a.z - b.z) <= 1 AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1"
FACES = "abs(a.z - b.z) + abs(a.x - b.x) + abs(a.y - b.y) <= 1"
PLACE = "CAST(p // 200 AS INT) AS x, CAST((p % 200) // 20 AS INT) AS y, CAST(p % 20 AS INT) AS z"
RECURSIVE = f"WITH RECURSIVE {SQL}"


def _sized(mask: str, near: str, least: int) -> str:
    return f"{RECURSIVE}, {_reach(mask, near)} SELECT case_no, {PLACE} FROM (SELECT *, count(*) OVER (PARTITION BY case_no, c) AS n FROM comp) WHERE n >= {least}"


BOX = f"""box AS (SELECT case_no, CASE WHEN min(z) FILTER (vert = 15) IS NULL THEN 0 ELSE greatest(0, least(5, min(x) FILTER (vert = 15))) END AS x0,
  CASE WHEN min(z) FILTER (vert = 15) IS NULL THEN 5 ELSE greatest(0, least(5, max(x) FILTER (vert = 15))) END AS x1,
  CASE WHEN min(z) FILTER (vert = 15) IS NULL THEN 0 ELSE greatest(0, least(10, min(y) FILTER (vert = 15) - 2)) END AS y0,
  CASE WHEN min(z) FILTER (vert = 15) IS NULL THEN 10 ELSE greatest(0, least(10, max(y) FILTER (vert = 15) + 2)) END AS y1,
  CASE WHEN min(z) FILTER (vert = 15) IS NULL THEN 0 ELSE greatest(0, least(20, min(z) FILTER (vert = 15) - 2)) END AS z0,
  CASE WHEN min(z) FILTER (vert = 15) IS NULL THEN 20 ELSE greatest(0, least(20, max(z) FILTER (vert = 15) + 2)) END AS z1 FROM voxels GROUP BY case_no)"""
#: What the frame of one voxel about a volume reaches through the background; ``body`` stops it.
FLOOD = """flood AS (SELECT DISTINCT case_no, -1 AS x, -1 AS y, -1 AS z FROM voxels UNION
  SELECT f.case_no, f.x + d.dx, f.y + d.dy, f.z + d.dz FROM flood f JOIN (VALUES (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) d(dx, dy, dz) ON true
  LEFT JOIN body b ON b.case_no = f.case_no AND b.x = f.x + d.dx AND b.y = f.y + d.dy AND b.z = f.z + d.dz
  WHERE b.case_no IS NULL AND f.x + d.dx BETWEEN -1 AND 5 AND f.y + d.dy BETWEEN -1 AND 10 AND f.z + d.dz BETWEEN -1 AND 20)"""
LARGEST = f"SELECT case_no, {PLACE} FROM (SELECT *, max(n * 1000 - c) OVER (PARTITION BY case_no) AS best FROM (SELECT *, count(*) OVER (PARTITION BY case_no, c) AS n FROM comp)) WHERE n * 1000 - c = best"
TRUNK = f"{_reach('trunk = 1', FACES)}, body AS MATERIALIZED ({LARGEST}), {FLOOD}"
INSIDE = "NOT EXISTS (SELECT 1 FROM flood f WHERE f.case_no = v.case_no AND f.x = v.x AND f.y = v.y AND f.z = v.z)"


def _method(vert: str, trunk: bool, tissue: str = "tissue", l3: bool = False) -> str:
    """A whole method: vertebrae and tissue as given, the trunk's inside or the box of L2 to L4."""
    base = SQL.replace("voxels AS", "every AS", 1)
    same = f"voxels AS MATERIALIZED (SELECT * REPLACE ({vert} AS vert, {tissue} AS tissue) FROM every)"
    if trunk:
        parts = f"WITH RECURSIVE {base}, {same}, {TRUNK}, inside AS MATERIALIZED (SELECT v.*, f.case_no IS NULL AS within FROM voxels v LEFT JOIN flood f ON f.case_no = v.case_no AND f.x = v.x AND f.y = v.y AND f.z = v.z)"
        csa = CSA.replace(f"SELECT *, {MASK} AS t FROM voxels", f"SELECT *, CASE WHEN within THEN {MASK} ELSE 0 END AS t FROM inside")
    else:
        parts = f"""WITH {base}, own AS (SELECT * REPLACE ({vert} AS vert, {tissue} AS tissue) FROM every),
b AS (SELECT case_no, coalesce(min(z) FILTER (vert IN (14, 15, 16)), 0) AS b0, coalesce(max(z) FILTER (vert IN (14, 15, 16)), 20) AS b1 FROM own GROUP BY 1),
voxels AS MATERIALIZED (SELECT own.* FROM own JOIN b ON b.case_no = own.case_no AND z >= b0 AND z < b1)"""
        csa = CSA
    whole = f"{parts}, {VERT}, {DOM}, {SPAN}, {CAND}, {FILLED},\n{FIXED},\n{LEVELS}, {_center('lv')}, {TABLE}, {NAMED}, {csa}, {FRAME}, levelled AS (SELECT * FROM frame WHERE case_no IN (SELECT case_no FROM span))"
    if l3:
        return f"{whole}, l3 AS (SELECT * FROM levelled WHERE level = 'L3') {_aggregated('mean', 'level', 'l3')}"
    return f"{whole} SELECT * EXCLUDE (tag) FROM levelled"


SUBSET = "SELECT case_no, slice, level, center, centroid, " + CM + " FROM frame"
HAVE = "(SELECT o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 2)"


def oracle_sql() -> dict[str, str]:
    names = "', '".join(VERTEBRAE.values())
    lumbar = "', '".join(n for n in VERTEBRAE.values() if n[0] == "L")
    simple = f"{HIST}, {CSA}, fl AS (SELECT d.case_no, {_case('d.level', VERTEBRAE, chr(39) + '0' + chr(39))} AS level, {', '.join(AREAS)} FROM dom d JOIN csa c ON c.case_no = d.case_no AND c.z = d.z)"
    mean = ", ".join(f"round_even(CAST(sum({c}) AS DOUBLE) / count(*), 0) / CAST(100 AS DOUBLE) AS {c.replace('mm2', 'csa')}" for c in AREAS)
    base_name = "regexp_extract(url, '[^/]*$')"
    return {
        "flagship_l3_mean": f"{simple} SELECT case_no, level, {mean} FROM fl WHERE level = 'L3' GROUP BY ALL",
        "remap_labels": f"{BASE} SELECT {KEY}, {_case('tissue', {1: 7, 2: 7, 4: 3}, '0')} AS label FROM voxels",
        "remap_spine_a": f"{BASE} SELECT {KEY}, {_case('event_id % 50', SPINE_A, '0')} AS label FROM voxels",
        "remap_spine_b": f"{BASE} SELECT {KEY}, {_case('event_id % 30', SPINE_B, '0')} AS label FROM voxels",
        "hu_filter": f"{BASE} SELECT {KEY}, hu FROM voxels WHERE hu BETWEEN -29 AND 150",
        "hu_clip": f"{BASE} SELECT {KEY}, greatest(-100, least(120, hu)) AS hu FROM voxels",
        "hu_median_filter": f"""{BASE} SELECT v.case_no, v.x, v.y, v.z, list_sort(list(n.hu))[5] AS hu_median
FROM voxels v, range(-1, 2) dx(dx), range(-1, 2) dy(dy), voxels n
WHERE n.case_no = v.case_no AND n.z = v.z AND n.x = CASE WHEN v.x + dx < 0 THEN -(v.x + dx) - 1 WHEN v.x + dx >= 5 THEN 9 - (v.x + dx) ELSE v.x + dx END
AND n.y = CASE WHEN v.y + dy < 0 THEN -(v.y + dy) - 1 WHEN v.y + dy >= 10 THEN 19 - (v.y + dy) ELSE v.y + dy END GROUP BY ALL""",
        "overlay_psoas": f"{BASE} SELECT {KEY}, CASE WHEN iliopsoas IN (88, 89) THEN 4 ELSE tissue END AS tissue FROM voxels",
        "tissue_mask": f"{BASE} SELECT {KEY}, {MASK} AS tissue FROM voxels",
        "reduce_to_vb": f"{BASE} SELECT {KEY}, CASE WHEN vb = 1 OR vert = 19 THEN vert ELSE 0 END AS vert FROM voxels",
        "csa": f"{BASE}, {CSA} SELECT case_no, z, {CM} FROM csa",
        "dominant_level": f"{HIST} SELECT * FROM dom",
        "windowed_counts": f"{BASE}, {VERT} SELECT case_no, z, label, CAST(sum(n) OVER (PARTITION BY case_no, label ORDER BY z RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS BIGINT) AS n_window FROM vh",
        "level_span": f"{HIST}, {SPAN} SELECT * FROM span",
        "fill_levels": f"{FILL} SELECT * FROM filled",
        "non_monotonic": f"{FILL} SELECT * FROM (SELECT *, lag(level) OVER (PARTITION BY case_no ORDER BY z) AS before FROM filled) WHERE level > before",
        "correct_monotonic": f"{FILL},\n{FIXED} SELECT * FROM round10",
        "center_slice": f"{HIST}, {_center('dom')} SELECT * FROM center",
        "centroid_slice": f"{HIST}, {_center('dom')} SELECT * FROM centroid",
        "level_names": f"{FULL} SELECT * FROM named",
        "combine": f"{WHOLE} SELECT case_no, slice, level, center, centroid, tag, {CM}, CAST(row_number() OVER (PARTITION BY case_no ORDER BY slice DESC) AS INT) AS rn FROM frame",
        "export_with_metadata": f"{WHOLE} SELECT f.*, pat_sex, pat_weight FROM ({SUBSET}) f LEFT JOIN {META} m ON m.case_no = f.case_no",
        "subset_l3": f"{WHOLE} {SUBSET} WHERE level = 'L3'",
        "subset_all": f"{WHOLE} {SUBSET} WHERE level IN ('{names}')",
        "subset_lumbar": f"{WHOLE} {SUBSET} WHERE level IN ('{lumbar}')",
        **{f"aggregate_{m}": f"{WHOLE} {_aggregated(m, 'level')}" for m in ("mean", "median", "sum")},
        "aggregate_by_center": f"{WHOLE} {_aggregated('mean', 'center')}",
        "aggregate_by_centroid": f"{WHOLE} {_aggregated('mean', 'centroid')}",
        "aggregate_case": f"{WHOLE} {_aggregated('mean', None)}",
        "aggregate_tag": f"{WHOLE}, tagged AS (SELECT * REPLACE (CASE level WHEN 'L3' THEN 'mid' WHEN 'L2' THEN 'near' WHEN 'L4' THEN 'near' END AS tag) FROM frame) {_aggregated('mean', 'tag', 'tagged', 'slice')}",
        "bbox_create": f"{BASE}, {BOX} SELECT * FROM box",
        "bbox_apply": f"""{BASE}, b AS (SELECT case_no, coalesce(min(z) FILTER (vert IN (14, 15, 16)), 0) AS z0, coalesce(max(z) FILTER (vert IN (14, 15, 16)), 20) AS z1 FROM voxels GROUP BY 1)
SELECT v.case_no, x, y, z - z0 AS z, hu FROM voxels v JOIN b ON b.case_no = v.case_no AND z >= z0 AND z < z1""",
        "bbox_affine": f"{BASE}, {BOX} SELECT case_no, CAST(10 - 1.5 * x0 AS DOUBLE) AS t0, CAST(-20 + 1.5 * y0 AS DOUBLE) AS t1, CAST(30 + 5 * z0 AS DOUBLE) AS t2 FROM box",
        "reorient": f"{BASE} SELECT case_no, y AS x, 4 - x AS y, 19 - z AS z, hu FROM voxels",
        "size_filter_2d": _sized("tissue = 4", NEAR2, 3),
        "size_filter_3d": _sized("tissue = 4", NEAR3, 5),
        "keep_largest": f"{RECURSIVE}, {_reach('tissue = 3', FACES)} SELECT case_no, {PLACE} FROM (SELECT *, max(n * 1000 - c) OVER (PARTITION BY case_no) AS best FROM (SELECT *, count(*) OVER (PARTITION BY case_no, c) AS n FROM comp)) WHERE n * 1000 - c = best",
        "fill_holes": f"{RECURSIVE}, body AS (SELECT {KEY} FROM voxels WHERE hu > -170), {FLOOD} SELECT {KEY} FROM voxels v WHERE {INSIDE}",
        "trunk_restrict": f"{RECURSIVE}, {TRUNK} SELECT {KEY}, CASE WHEN {INSIDE} THEN tissue ELSE 0 END AS tissue FROM voxels v",
        "bbox_spine": f"""{BASE}, e AS (SELECT case_no, greatest(0, least(20, min(z) FILTER (vert > 0) + 4)) AS lo, greatest(0, least(20, max(z) FILTER (vert > 0) - 4)) AS hi, min(z) FILTER (vert > 0) AS hit FROM voxels GROUP BY 1)
SELECT case_no, 0 AS x0, 5 AS x1, 0 AS y0, 10 AS y1, CASE WHEN hit IS NULL THEN 0 ELSE lo END AS z0, CASE WHEN hit IS NULL THEN 20 ELSE hi END AS z1,
 CASE WHEN hit IS NOT NULL AND hi <= lo THEN 'the box holds no voxel' END AS error FROM e""",
        **dict.fromkeys(("model_slabs", "model_scores"), f"{BASE} SELECT {KEY}, CASE WHEN sum(hu) OVER (PARTITION BY case_no, x, y ORDER BY z RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) > -300 THEN 1 ELSE 0 END AS label FROM voxels"),
        "method_lumbar_quick": _method("vert", False, l3=True),
        "method_whole_trunk": _method("vert", True),
        "method_muscle_a": _method("CASE WHEN vert NOT IN (18, 20, 21) AND (vb = 1 OR vert = 19) THEN vert ELSE 0 END", True, "CASE WHEN iliopsoas IN (88, 89) THEN 4 ELSE tissue END"),
        "method_muscle_a_quick": _method("CASE WHEN vert IN (18, 20, 21) THEN 0 ELSE vert END", False, l3=True),
        "method_muscle_b": _method("CASE WHEN vert <= 17 AND vb = 1 THEN vert ELSE 0 END", True),
        "case_filter": f"SELECT page_id, split_part({base_name}, '.', 1) AS case_id, regexp_replace(url, '[^A-Za-z0-9_]+', '', 'g') AS slug FROM pages WHERE regexp_matches({base_name}, '^(?:[0-9]*[02468])') AND NOT starts_with({base_name}, '.')",
        "require_inputs": f"SELECT c_custkey AS case_id FROM customer WHERE c_custkey IN {HAVE}",
        "skip_completed": f"SELECT c_custkey AS case_id FROM customer WHERE c_custkey NOT IN {HAVE}",
        "case_funnel": f"""WITH h AS (SELECT c_custkey FROM customer WHERE left(CAST(c_custkey AS VARCHAR), 1) IN ('1', '2') AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))
SELECT 'all' AS step, count(*) AS n FROM customer UNION ALL SELECT 'matching', count(*) FROM customer WHERE left(CAST(c_custkey AS VARCHAR), 1) IN ('1', '2')
UNION ALL SELECT 'inputs', count(*) FROM h UNION ALL SELECT 'open', count(*) FROM h WHERE c_custkey NOT IN {HAVE}""",
        "metadata_left_join": f"SELECT e.case_no, pat_sex, pat_weight FROM (SELECT DISTINCT CAST(floor(event_id / 1000.0) AS INT) AS case_no FROM events) e LEFT JOIN {META} m ON m.case_no = e.case_no",
        "metadata_pivot": "SELECT o_custkey AS case_id, " + ", ".join(f"arg_max(o_orderpriority, o_orderkey) FILTER (o_orderstatus = '{k}') AS \"{k}\"" for k in "FOP") + " FROM orders GROUP BY 1",
        "metadata_merge": "SELECT c_custkey AS case_id, CASE WHEN o AND c_custkey % 4 <> 0 THEN 'new ' || c_name ELSE c_name END AS sex, CASE WHEN o THEN coalesce(nullif(c_mktsegment, ''), 'old') ELSE 'old' END AS size FROM (SELECT *, c_custkey IN (SELECT o_custkey FROM orders) AS o FROM customer)",
        "patient_id_parse": """SELECT c_custkey, case_id, CASE WHEN m THEN nullif(regexp_extract(case_id, r, 1), '') ELSE '' END AS pat_prefix,
CASE WHEN m THEN nullif(regexp_extract(case_id, r, 2), '') ELSE case_id END AS pat_id, CASE WHEN m THEN nullif(regexp_extract(case_id, r, 3), '') ELSE '' END AS pat_suffix
FROM (SELECT *, regexp_matches(case_id, r) AS m FROM (SELECT c_custkey, '^([a-zA-Z0-9]+)-([a-zA-Z0-9]+)?-?([a-zA-Z0-9]+)?' AS r,
CASE c_custkey % 4 WHEN 0 THEN 'AB-' || c_custkey || '-x' WHEN 1 THEN 'AB--x' WHEN 2 THEN 'AB-' ELSE CAST(c_custkey AS VARCHAR) END AS case_id FROM customer))""".replace("regexp_extract(case_id, r,", "regexp_extract(case_id, '^([a-zA-Z0-9]+)-([a-zA-Z0-9]+)?-?([a-zA-Z0-9]+)?',"),
        "date_reformat": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS scan_date FROM orders",
        "dicom_select": """WITH c AS (SELECT l_suppkey AS dir, count(*) FILTER (p AND a) AS pa, count(*) FILTER (a) AS ax, count(*) FILTER (p) AS pr, count(*) AS total
 FROM (SELECT *, l_linenumber % 2 <> 0 AS p, l_suppkey % 7 <> 0 AS a FROM lineitem) GROUP BY 1),
k AS (SELECT dir, CASE WHEN pa > 0 THEN 'primary axial' WHEN ax > 0 THEN 'axial' WHEN pr > 0 THEN 'primary' ELSE 'all' END AS kind,
 CASE WHEN pa > 0 THEN pa WHEN ax > 0 THEN ax WHEN pr > 0 THEN pr ELSE total END AS n FROM c)
SELECT *, CASE WHEN n < 290 THEN 'too few slices' ELSE 'ok' END AS status FROM k""",
    }
