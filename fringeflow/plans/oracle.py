"""DuckDB SQL for the named queries, put together from shared common table expressions."""

from __future__ import annotations

import math

import numpy as np

from fringeflow.functions.phase import glrt_threshold
from fringeflow.operators.similarity import ks_probability
from fringeflow.plans import scene as S

_T = range(S.EPOCHS)
TAU = repr(2 * math.pi)
PI = repr(math.pi)

CTE = {
    "samples": f"""SELECT l_partkey AS point_id, CAST(l_partkey // {S.WIDTH} AS INT) AS r, CAST(l_partkey % {S.WIDTH} AS INT) AS c, CAST(year(l_shipdate) - {S.FIRST_YEAR} AS INT) AS t, sum(l_quantity) AS amp FROM lineitem GROUP BY ALL""",
    "z": f"""SELECT *, (amp % {S.TURN}) * {2 * math.pi / S.TURN!r}::DOUBLE AS phase, amp * cos((amp % {S.TURN}) * {2 * math.pi / S.TURN!r}::DOUBLE) AS re, amp * sin((amp % {S.TURN}) * {2 * math.pi / S.TURN!r}::DOUBLE) AS im FROM samples""",
    "stats": f"""SELECT point_id, r, c, count(*) AS n, avg(amp) AS mean_amp, var_pop(amp) AS var_amp, (var_pop(amp) + avg(amp) * avg(amp)) / 2 AS scale2, stddev_pop(amp) / avg(amp) AS adi FROM samples GROUP BY ALL HAVING count(*) = {S.EPOCHS}""",
    "flagged": f"""SELECT *, adi <= {S.ADI_MAX} AS ps FROM stats""",
    "usable": """SELECT * FROM flagged WHERE NOT ps""",
    "support": f"""SELECT a.point_id AS center_id, b.point_id AS neighbor_id, (b.r - a.r + {S.HALF_ROWS}) * {2 * S.HALF_COLS + 1} + (b.c - a.c + {S.HALF_COLS}) AS bit, {S.EPOCHS} * (2 * ln((a.scale2 + b.scale2) / 2) - ln(a.scale2) - ln(b.scale2)) AS stat
FROM usable a JOIN usable b ON abs(a.r - b.r) <= {S.HALF_ROWS} AND abs(a.c - b.c) <= {S.HALF_COLS} AND a.point_id <> b.point_id
WHERE {S.EPOCHS} * (2 * ln((a.scale2 + b.scale2) / 2) - ln(a.scale2) - ln(b.scale2)) < {glrt_threshold(S.ALPHA)!r}::DOUBLE""",
    "counts": """SELECT u.point_id AS center_id, count(s.center_id) AS k FROM usable u LEFT JOIN support s ON s.center_id = u.point_id GROUP BY 1""",
    "full_z": """SELECT z.* FROM z JOIN stats USING (point_id, r, c)""",
    "coh": """SELECT s.center_id, a.t AS i, b.t AS j, sum(a.re * b.re + a.im * b.im) / sqrt(sum(a.re * a.re + a.im * a.im) * sum(b.re * b.re + b.im * b.im)) AS cre, sum(a.im * b.re - a.re * b.im) / sqrt(sum(a.re * a.re + a.im * a.im) * sum(b.re * b.re + b.im * b.im)) AS cim
FROM support s JOIN full_z a ON a.point_id = s.neighbor_id JOIN full_z b ON b.point_id = s.neighbor_id AND a.t < b.t GROUP BY ALL""",
    "median_coh": """SELECT center_id, median(sqrt(cre * cre + cim * cim)) AS median_coh FROM coh GROUP BY 1""",
    "tc": """SELECT center_id, sqrt(pow(avg(cos(off)), 2) + pow(avg(sin(off)), 2)) AS tc FROM (SELECT center_id, atan2(cim, cre) - (a.phase - b.phase) AS off FROM coh JOIN full_z a ON a.point_id = center_id AND a.t = i JOIN full_z b ON b.point_id = center_id AND b.t = j) GROUP BY 1""",
    "ds": """SELECT f.point_id, f.r, f.c, tc, median_coh FROM flagged f JOIN tc ON tc.center_id = f.point_id JOIN median_coh m ON m.center_id = f.point_id WHERE NOT ps AND tc >= 0.2 AND median_coh >= 0.3""",
    "acq": f"""SELECT CAST(date_diff('month', DATE '{S.FIRST_YEAR}-01-01', CAST(date_trunc('month', o_orderdate) AS DATE)) AS INT) AS idx, CAST(date_trunc('month', o_orderdate) AS DATE) AS day, avg(o_totalprice) / 100 AS bperp FROM orders GROUP BY ALL""",
    "cand": f"""SELECT a.idx AS i, b.idx AS j, CAST(b.day - a.day AS INT) AS dt_days, b.bperp - a.bperp AS dbperp, sqrt(pow((b.day - a.day) / {float(S.MOST_DAYS)}, 2) + pow((b.bperp - a.bperp) / {S.MOST_METRES}, 2)) AS score
FROM acq a JOIN acq b ON a.idx < b.idx AND b.day - a.day <= {S.MOST_DAYS} AND abs(b.bperp - a.bperp) <= {S.MOST_METRES}""",
    "net": """SELECT DISTINCT i, j, dt_days, dbperp, score FROM (SELECT *, row_number() OVER (PARTITION BY own, side ORDER BY score, dt_days, abs(dbperp), other) AS rank FROM (SELECT *, i AS own, j AS other, 'right' AS side FROM cand UNION ALL SELECT *, j, i, 'left' FROM cand)) WHERE rank <= 3""",
    "net1": """SELECT DISTINCT i, j, dt_days, dbperp, score FROM (SELECT *, row_number() OVER (PARTITION BY own, side ORDER BY score, dt_days, abs(dbperp), other) AS rank FROM (SELECT *, i AS own, j AS other, 'right' AS side FROM cand UNION ALL SELECT *, j, i, 'left' FROM cand)) WHERE rank <= 1""",
    "twoway": """SELECT i, j FROM net UNION ALL SELECT j, i FROM net""",
    "pairs": "SELECT * FROM (VALUES " + ", ".join(f"({k}, {i}, {j})" for k, (i, j) in enumerate([(i, j) for i in _T for j in (i + 1, i + 2) if j < S.EPOCHS])) + ") v(pair_id, i, j)",
    "ifg": f"""SELECT pair_id, a.point_id, a.r, a.c, atan2(sin(b.phase - a.phase), cos(b.phase - a.phase)) AS phase FROM pairs JOIN full_z a ON a.t = i JOIN full_z b ON b.t = j AND b.point_id = a.point_id""",
    "knn_all": f"""SELECT a.point_id AS own, b.point_id AS other, sqrt(pow((b.r - a.r) * {S.AZIMUTH_M}, 2) + pow((b.c - a.c) * {S.RANGE_M}, 2)) AS dist, greatest(abs(b.r - a.r), abs(b.c - a.c)) AS cheb, b.r - a.r AS dr, b.c - a.c AS dc FROM stats a JOIN stats b ON abs(a.r - b.r) <= 4 AND abs(a.c - b.c) <= 4 AND a.point_id <> b.point_id""",
    "knn": """SELECT least(own, other) AS u, greatest(own, other) AS v, min(dist) AS dist FROM (SELECT *, row_number() OVER (PARTITION BY own ORDER BY dist, cheb, dr, dc) AS rank FROM knn_all) WHERE rank <= 8 GROUP BY 1, 2""",
    "grad": """SELECT a.pair_id, u, v, dist, atan2(sin(b.phase - a.phase), cos(b.phase - a.phase)) AS g FROM knn JOIN ifg a ON a.point_id = u JOIN ifg b ON b.point_id = v AND a.pair_id = b.pair_id""",
    "tri": "SELECT * FROM (VALUES " + ", ".join(f"({k}, {k}, {k + 1}, {k + 2})" for k in range(S.EPOCHS - 2)) + ") v(triangle_id, a, b, c)",
    "closure": """SELECT triangle_id, x.point_id, x.phase + y.phase - w.phase AS closure FROM tri JOIN pairs p ON p.i = tri.a AND p.j = tri.b JOIN pairs q ON q.i = tri.b AND q.j = tri.c JOIN pairs s ON s.i = tri.a AND s.j = tri.c JOIN ifg x ON x.pair_id = p.pair_id JOIN ifg y ON y.pair_id = q.pair_id AND y.point_id = x.point_id JOIN ifg w ON w.pair_id = s.pair_id AND w.point_id = x.point_id""",
    "ints": f"""SELECT triangle_id, point_id, CAST(round_even(closure / {TAU}::DOUBLE, 0) AS INT) AS k FROM closure""",
    "modes": """SELECT triangle_id, k AS modal_k, total - n AS bad_points FROM (SELECT triangle_id, k, count(*) AS n, sum(count(*)) OVER (PARTITION BY triangle_id) AS total, row_number() OVER (PARTITION BY triangle_id ORDER BY count(*) DESC, k) AS rank FROM ints GROUP BY triangle_id, k) WHERE rank = 1""",
    "chosen": f"""SELECT * FROM stats WHERE adi <= {S.POINT_ADI}""",
    "touch": """SELECT a.point_id AS u, b.point_id AS v FROM chosen a JOIN chosen b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1""",
    "reach": """SELECT u AS node, u AS root FROM touch UNION SELECT t.v, reach.root FROM reach JOIN touch t ON t.u = reach.node""",
    "comp": """SELECT node AS point_id, min(root) AS component FROM reach GROUP BY node""",
    "main": """SELECT component AS main FROM comp GROUP BY component ORDER BY count(*) DESC, component LIMIT 1""",
    "crossing": """SELECT c.component, x.point_id AS p, y.point_id AS q, (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) AS radius2 FROM comp c JOIN chosen x USING (point_id) JOIN comp d ON d.component = (SELECT main FROM main) JOIN chosen y ON y.point_id = d.point_id WHERE c.component <> (SELECT main FROM main) AND (x.r - y.r) * (x.r - y.r) + (x.c - y.c) * (x.c - y.c) <= 900""",
    "anchor": """SELECT component, rank, p, q, radius2, CASE WHEN radius2 > 400 THEN 3 WHEN radius2 > 144 THEN 2 ELSE 1 END AS class FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY radius2, p, q) AS rank FROM (SELECT component, q, min(struct_pack(radius2 := radius2, p := p)).radius2 AS radius2, min(struct_pack(radius2 := radius2, p := p)).p AS p FROM crossing GROUP BY component, q)) WHERE rank <= 2""",
}

_NEEDS = {
    "z": "samples", "stats": "samples", "flagged": "stats", "usable": "flagged", "support": "usable", "counts": "usable support", "full_z": "z stats", "coh": "support full_z", "median_coh": "coh", "tc": "coh full_z",
    "ds": "flagged tc median_coh", "cand": "acq", "net": "cand", "net1": "cand", "twoway": "net", "ifg": "pairs full_z", "knn_all": "stats", "knn": "knn_all", "grad": "knn ifg", "closure": "tri pairs ifg", "ints": "closure", "modes": "ints",
    "chosen": "stats", "touch": "chosen", "reach": "touch", "comp": "reach", "main": "comp", "crossing": "comp chosen main", "anchor": "crossing",
}


def build(select: str, *names: str) -> str:
    """``select`` after the named expressions and all that they need."""
    order: list[str] = []

    def need(name: str) -> None:
        if name not in order:
            for other in _NEEDS.get(name, "").split():
                need(other)
            order.append(name)

    for n in names:
        need(n)
    heads = ",\n".join(f"{n} AS ({CTE[n]})" for n in order)
    return f"WITH {'RECURSIVE ' if 'reach' in order else ''}{heads}\n{select}"


def x6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


def state_core_sql(rounds: int = 14) -> str:
    """The removal of points that fall short, written out for that many rounds; rounds after the last removal change nothing."""
    steps = [f"s0 AS (SELECT center_id AS point_id, k AS effective_k FROM counts WHERE k >= {S.STATE_K})"]
    for n in range(1, rounds + 1):
        steps.append(f"s{n} AS (SELECT e.center_id AS point_id, count(*) AS effective_k FROM support e JOIN s{n - 1} a ON a.point_id = e.center_id JOIN s{n - 1} b ON b.point_id = e.neighbor_id GROUP BY 1 HAVING count(*) >= {S.STATE_K})")
    return build("", "counts").rstrip() + ",\n" + ",\n".join(steps)


def cycle_sql(k: int) -> str:
    """Simple cycles of k nodes as in the operator, one row a cycle."""
    joins = " ".join(f"JOIN twoway e{s} ON e{s}.i = {'e0.j' if s == 1 else f'e{s - 1}.j'}" for s in range(1, k - 1))
    node = ["e0.i", "e0.j", *[f"e{s}.j" for s in range(1, k - 1)]]
    tests = [f"{node[q]} > {node[0]}" for q in range(2, k)] + [f"{node[a]} <> {node[b]}" for a in range(1, k) for b in range(a + 1, k)] + [f"{node[1]} < {node[-1]}"]
    return f"SELECT {', '.join(f'{n} AS n{q}' for q, n in enumerate(node))} FROM net e0 {joins} JOIN net last ON last.i = e0.i AND last.j = {node[-1]} WHERE {' AND '.join(tests)}"


def cycle_counts_sql() -> str:
    parts = []
    for k in (3, 4, 5):
        for q in range(k):
            parts.append(f"SELECT {k} AS k, least(n{q}, n{(q + 1) % k}) AS i, greatest(n{q}, n{(q + 1) % k}) AS j FROM cy{k}")
    ctes = ", ".join(f"cy{k} AS ({cycle_sql(k)})" for k in (3, 4, 5))
    return build("", "twoway").rstrip() + f", {ctes}, told AS ({' UNION ALL '.join(parts)})\nSELECT net.i, net.j, count(*) FILTER (k = 3) AS c3, count(*) FILTER (k = 4) AS c4, count(*) FILTER (k = 5) AS c5, min(k) AS shortest FROM net LEFT JOIN told ON told.i = net.i AND told.j = net.j GROUP BY ALL"


def inversion_sql(weights: np.ndarray) -> str:
    rows = ", ".join(f"({e}, {t}, {float(weights[t, e])!r}::DOUBLE)" for e in range(weights.shape[1]) for t in range(weights.shape[0]))
    return build(f"SELECT point_id, t, {x6('sum(w * phase)')} AS phase FROM ifg JOIN (VALUES {rows}) v(pair_id, t, w) USING (pair_id) GROUP BY ALL", "ifg")


def prior_sql(samples: str, epochs: int, rows: int, cols: int, p_max: float = 0.05) -> str:
    """Neighbours by the largest gap of two counts over all values of both histories; gaps whose probability is small are told by number."""
    hits = ", ".join(str(k) for k in range(epochs + 1) if ks_probability(k / epochs, epochs) < p_max) or "-1"
    below = lambda h: f"len(list_filter({h}.h, lambda y: y <= x))"
    return f"""hist AS MATERIALIZED (SELECT point_id, r, c, list(CAST(amp AS FLOAT)) AS h FROM {samples} GROUP BY ALL HAVING count(*) = {epochs}),
gap AS (SELECT a.point_id, list_max(list_transform(list_concat(a.h, b.h), lambda x: abs({below('a')} - {below('b')}))) AS gap FROM hist a JOIN hist b ON abs(a.r - b.r) <= {rows} AND abs(a.c - b.c) <= {cols})
SELECT point_id, count(*) FILTER (gap IN ({hits})) AS selected, count(*) AS available FROM gap GROUP BY 1"""
