"""DuckDB twin of the isolation forest (M4, M5, M6, M7): the same trees, grown level by level in SQL."""

from __future__ import annotations

from flowsift.operators.iforest import EULER, PATH_UNIT, POOL

CTE = tuple[str, str]


def _uniform(text: str, place: int) -> str:
    return f"('0x' || substr(md5({text}), {place}, 13))::BIGINT / {float(1 << 52)!r}"


def _path(n: str) -> str:
    return (f"CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 "
            f"ELSE 2.0 * (ln({n} - 1.0) + {EULER!r}) - 2.0 * ({n} - 1.0) / {n} END")


def forest_ctes(train: str, width: int, n_trees: int = 200, max_samples: int = 256, seed: int = 42) -> list[CTE]:
    """``nodes(t, k, f, thr, size, depth)`` of the forest fitted on ``train(id, x)``, and ``par(psi, deepest)``."""
    deepest = (max_samples - 1).bit_length()
    out = [
        ("par", f"""SELECT psi, ceil(log2(greatest(psi, 2)))::INT AS deepest
FROM (SELECT least({max_samples}, count(*)) AS psi FROM {train})"""),
        ("pool", f"SELECT id, x FROM {train} ORDER BY md5(id || '|{seed}'), id, x LIMIT {max(POOL, max_samples)}"),
        ("a0", f"""SELECT t, 1::BIGINT AS k, x FROM (SELECT t, x, row_number() OVER (
    PARTITION BY t ORDER BY md5(id || '|' || t || '|{seed}'), id, x) AS r FROM pool, range({n_trees}) g(t)), par WHERE r <= psi"""),
    ]
    for d in range(deepest + 1):
        out.append((f"r{d}", f"""SELECT t, k, any_value(n) AS n, coalesce(list({{'f': i, 'lo': lo, 'hi': hi}} ORDER BY i)
    FILTER (WHERE hi > lo AND n > 1 AND {d} < (SELECT deepest FROM par)), []) AS c
FROM (SELECT t, k, i, count(*) AS n, min(x[i]) AS lo, max(x[i]) AS hi FROM a{d}, range(1, {width + 1}) g(i) GROUP BY t, k, i)
GROUP BY t, k"""))
        key = f"t || '|' || k || '|{seed}'"
        out.append((f"n{d}", f"""SELECT t, k, coalesce(s.f, 0) AS f,
  coalesce(s.lo + u * (s.hi - s.lo), 0.0) AS thr, n AS size, {d} AS depth
FROM (SELECT t, k, n, c[floor({_uniform(key, 1)} * len(c))::INT + 1] AS s, {_uniform(key, 14)} AS u FROM r{d})"""))
        if d < deepest:
            out.append((f"a{d + 1}", f"""SELECT a.t, 2 * a.k + (a.x[f] > thr)::INT AS k, a.x
FROM a{d} a JOIN n{d} n ON a.t = n.t AND a.k = n.k WHERE f > 0"""))
    out.append(("nodes", "\nUNION ALL ".join(f"SELECT * FROM n{d}" for d in range(deepest + 1))))
    return [(f"{name}", text) for name, text in out]


def score_ctes(rows: str, name: str, n_trees: int = 200, max_samples: int = 256) -> list[CTE]:
    """``name(id, raw)``: the paper score of each row of ``rows(id, x)``."""
    deepest = (max_samples - 1).bit_length()
    out = [(f"{name}_w0", f"SELECT id, x, t, 1::BIGINT AS k FROM {rows}, range({n_trees}) g(t)")]
    for d in range(deepest):
        out.append((f"{name}_w{d + 1}", f"""SELECT w.id, w.x, w.t, CASE WHEN f > 0 THEN 2 * w.k + (w.x[f] > thr)::INT ELSE w.k END AS k
FROM {name}_w{d} w JOIN nodes n ON w.t = n.t AND w.k = n.k"""))
    out.append((name, f"""SELECT id, pow(2.0, -(sum(round((depth + {_path('size')}) * {PATH_UNIT})::BIGINT)::DOUBLE
  / {float(n_trees * PATH_UNIT)!r}) / (SELECT CASE WHEN psi <= 1 THEN 1.0 ELSE {_path('psi')} END FROM par)) AS raw
FROM {name}_w{deepest} w JOIN nodes n ON w.t = n.t AND w.k = n.k GROUP BY id"""))
    return out


def calibrated_ctes(raw: str, train: str, name: str, q: float = 0.995) -> list[CTE]:
    """``name(id, raw, score)``: scores of ``raw`` calibrated by the scores of ``train``."""
    bounds = f"""SELECT v[1] AS lo, v[k + 1] + frac * (v[least(k + 2, len(v))] - v[k + 1]) AS hi
FROM (SELECT v, floor({q} * (len(v) - 1))::INT AS k, {q} * (len(v) - 1) - floor({q} * (len(v) - 1)) AS frac
      FROM (SELECT list(raw ORDER BY raw) AS v FROM {train}))"""
    return [("forest_bounds", bounds), (name, f"""SELECT id, raw, CASE WHEN hi - lo < 1e-12 THEN 0.0
  ELSE greatest(0.0, least(1.0, (raw - lo) / (hi - lo))) END AS score FROM {raw}, forest_bounds""")]
