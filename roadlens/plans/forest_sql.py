"""The isolation forest in DuckDB SQL: the rows of each tree, its nodes level by
level, and the walk of every row through every tree (the check of M1-M4)."""

from __future__ import annotations

from roadlens.ml.iforest import MAX_SAMPLES, N_TREES, PRIME, SCORE_DIGITS, SEED, SPARE, STAT_DIGITS, UNIT
from roadlens.plans.oracle import rnd

EULER = 0.5772156649015329


def _hex(text: str, start: int, length: int) -> str:
    return f"CAST('0x' || substr(md5({text}), {start}, {length}) AS BIGINT)"


def _c(n: str) -> str:
    return (f"CASE WHEN {n} > 2 THEN 2.0::DOUBLE * (ln({n} - 1.0::DOUBLE) + {EULER}::DOUBLE) - 2.0::DOUBLE * ({n} - 1.0::DOUBLE) / {n} "
            f"WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")


def forest_ctes(k: int, trees: int = N_TREES, sample: int = MAX_SAMPLES, seed: int = SEED,
                spare: int = SPARE) -> dict[str, str]:
    """CTEs over ``forest_input`` (event_id, v: list of ``k`` features):
    forest_rows, forest_nodes, forest_scores and forest_cut."""
    dims = range(1, k + 1)
    top = (sample - 1).bit_length()
    ctes = {
        "fstats": "SELECT count(*) AS n, " + ", ".join(
            f"{rnd(f'avg(v[{i}])', STAT_DIGITS)} AS m{i}, {rnd(f'stddev_pop(v[{i}])', STAT_DIGITS)} AS s{i}" for i in dims)
        + " FROM forest_input",
        "fsize": f"SELECT n, least({sample}, n) AS psi, CAST(ceil(log2(greatest(least({sample}, n), 2))) AS INT) AS top, "
                 f"least({trees}, ({spare * trees} * least({sample}, n) + n - 1) // n) AS offers FROM fstats",
        "fx": "SELECT event_id, [" + ", ".join(
            f"(v[{i}] - m{i}) / CASE WHEN s{i} = 0 THEN 1.0::DOUBLE ELSE s{i} END" for i in dims)
        + f"] AS x, {_hex(f"'{seed}:' || event_id", 1, 15)} AS h FROM forest_input, fstats",
        "ftrees": f"SELECT t, {_hex(f"'{seed}:' || t", 1, 7)} + 1 AS a, {_hex(f"'{seed}:' || t", 8, 7)} + 1 AS b "
                  f"FROM (SELECT unnest(range({trees})) AS t) u",
        "foffers": f"SELECT event_id, x, h, (h // {trees}) % {PRIME} AS mixed, (h + unnest(range(offers))) % {trees} AS t "
                   f"FROM fx, fsize WHERE offers > 1 OR (h // {trees}) % {PRIME} < "
                   f"({PRIME} * least(n, {spare * trees} * psi) + n - 1) // n",
        "forest_rows": "SELECT t, event_id, x FROM (SELECT t, event_id, x, psi, row_number() OVER (PARTITION BY t "
                       f"ORDER BY (mixed * a + b) % {PRIME}, h, event_id) AS r FROM foffers JOIN ftrees USING (t), fsize) o "
                       "WHERE r <= psi",
        "fin0": "SELECT t, 1 AS node, x FROM forest_rows",
    }
    lo, hi = (", ".join(f"{f}(x[{i}])" for i in dims) for f in ("min", "max"))
    for d in range(top + 1):
        ctes[f"fbox{d}"] = f"SELECT t, node, count(*) AS n, [{lo}] AS lo, [{hi}] AS hi FROM fin{d} GROUP BY t, node"
        draw = f"'{seed}:' || t || ':' || node"
        ctes[f"fopen{d}"] = (f"SELECT *, CASE WHEN {d} >= top THEN [] ELSE list_filter(range(1, {k + 1}), lambda i: hi[i] > lo[i]) END AS can, "
                             f"{_hex(draw, 1, 7)} AS pick, {_hex(draw, 8, 13)} / {2**52}::DOUBLE AS u FROM fbox{d}, (SELECT top FROM fsize) z")
        ctes[f"fpick{d}"] = f"SELECT t, node, n, lo, hi, u, CASE WHEN len(can) > 0 THEN can[pick % len(can) + 1] END AS f FROM fopen{d}"
        ctes[f"fnode{d}"] = ("SELECT t, node, n, f, CASE WHEN lo[f] + u * (hi[f] - lo[f]) < hi[f] THEN lo[f] + u * (hi[f] - lo[f]) "
                             f"ELSE lo[f] END AS cut FROM fpick{d}")
        if d < top:
            ctes[f"fin{d + 1}"] = (f"SELECT t, node * 2 + CAST(x[f] > cut AS INT) AS node, x FROM fin{d} JOIN fnode{d} USING (t, node) "
                                   "WHERE f IS NOT NULL")
    ctes["forest_nodes"] = " UNION ALL ".join(
        f"SELECT t AS tree_id, node AS node_id, coalesce(f - 1, -1) AS feature, coalesce(cut, 0.0::DOUBLE) AS threshold, n AS size, "
        f"CASE WHEN f IS NULL THEN CAST(round(({d} + {_c('n')}) * {UNIT}) AS BIGINT) ELSE 0 END AS length FROM fnode{d}"
        for d in range(top + 1))
    ctes["fwalk0"] = "SELECT event_id, x, t, 1 AS node FROM fx, ftrees"
    for d in range(top):
        ctes[f"fwalk{d + 1}"] = ("SELECT event_id, x, t, CASE WHEN feature < 0 THEN node ELSE node * 2 + CAST(x[feature + 1] > threshold AS INT) END "
                                 f"AS node FROM fwalk{d} JOIN forest_nodes ON tree_id = t AND node_id = node")
    total = f"SELECT event_id, CAST(sum(length) AS BIGINT) AS total FROM fwalk{top} JOIN forest_nodes ON tree_id = t AND node_id = node GROUP BY event_id"
    whole = f"CASE WHEN psi > 1 THEN {_c('psi')} ELSE 1.0::DOUBLE END"
    score = f"-pow(2.0::DOUBLE, -(total / {trees}::DOUBLE / {UNIT}::DOUBLE) / ({whole}))"
    ctes["forest_scores"] = f"SELECT event_id, {rnd(score, SCORE_DIGITS)} AS anomaly_score FROM ({total}) s, fsize"
    ctes["forest_cut"] = ("SELECT anomaly_score AS cut FROM (SELECT anomaly_score, row_number() OVER (ORDER BY anomaly_score) AS r "
                          "FROM forest_scores) o, fsize WHERE r = greatest(1, (n * 5 + 99) // 100)")
    return ctes


def with_forest(sql: str, ctes: dict[str, str], before: str = "WITH ") -> str:
    return before + ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in ctes.items()) + "\n" + sql
