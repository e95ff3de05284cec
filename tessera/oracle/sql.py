"""DuckDB SQL that recomputes each registered query independently.

Iterative operators are unrolled into MATERIALIZED CTEs, one per round, with
the same tie rules as the Spark operators (largest distance then smallest id,
smallest key then id, lowest centre index). Used only as a test oracle.
"""

from __future__ import annotations

# fixed values: the seeded uniform divides 48 md5 bits by 2^48
TWO_48 = "281474976710656.0"

EMB = "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
PART = "SELECT p_partkey AS id, [CAST(p_size AS DOUBLE), p_retailprice] AS v FROM part"
LINEITEM = ("SELECT ('0x' || substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
            "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_quantity AS VARCHAR), "
            "CAST(l_extendedprice AS VARCHAR), CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR))), 1, 15))::BIGINT "
            "AS id, [l_quantity, l_extendedprice, l_discount, l_tax] AS v FROM lineitem")
LINES = ("SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no, "
         "unnest(string_split(text, chr(10))) AS text FROM documents")
PAIR_LINES = "SELECT concat_ws(' ', CAST(event_id AS VARCHAR), event_type) AS line FROM events"


def dist(a: str, b: str, metric: str = "euclidean") -> str:
    if metric == "euclidean":
        return f"list_distance({a}, {b})"
    if metric == "sq_drop_last":
        return f"list_sum(list_transform(range(1, len({a})), lambda i: ({a}[i] - {b}[i]) ^ 2))"
    if metric == "euclidean_2d":
        return f"sqrt(({a}[1] - {b}[1]) ^ 2 + ({a}[2] - {b}[2]) ^ 2)"
    raise ValueError(metric)


def shard_expr(L: int | None, col: str = "id") -> str:
    return f"((({col} % {L}) + {L}) % {L})" if L else "0"


def uniform(seed: int, r: int, col: str = "id") -> str:
    return (f"((('0x' || substr(md5('{seed}:{r}:' || CAST({col} AS VARCHAR)), 1, 12))::BIGINT + 0.5)"
            f" / {TWO_48})")


def first_key(seed: int, col: str = "id") -> str:
    return f"md5('{seed}:' || CAST({col} AS VARCHAR))"


def _m(name: str, body: str) -> str:
    return f"{name} AS MATERIALIZED ({body})"


def center_rounds_ctes(pfx: str, pts_cte: str, k: int, mode: str, seed: int = 42) -> tuple[list[str], list[str]]:
    """CTEs for k rounds of centre picking over ``pts_cte(id, v, shard, w)``.

    Returns (ctes, centre CTE names c0..c{k-1}) with columns (shard, id, v).
    mode 'farthest' or 'seed'.
    """
    ctes = [_m(f"{pfx}d0", f"SELECT id, v, shard, w, CAST('inf' AS DOUBLE) AS d FROM {pts_cte}")]
    if mode == "farthest":
        order0 = "id"
    else:
        order0 = f"{first_key(seed)}, id"
    ctes.append(_m(f"{pfx}c0", f"SELECT shard, id, v FROM (SELECT shard, id, v, row_number() OVER "
                               f"(PARTITION BY shard ORDER BY {order0}) AS rn FROM {pts_cte}) WHERE rn = 1"))
    names = [f"{pfx}c0"]
    for r in range(1, k):
        ctes.append(_m(f"{pfx}d{r}",
                       f"SELECT p.id, p.v, p.shard, p.w, least(p.d, coalesce({dist('p.v', 'c.v')}, p.d)) AS d "
                       f"FROM {pfx}d{r-1} p LEFT JOIN {pfx}c{r-1} c ON p.shard = c.shard"))
        if mode == "farthest":
            where, order = "d > 0", "d DESC, id"
        else:
            where, order = "d > 0 AND w > 0", f"-ln({uniform(seed, r)}) / (w * d), id"
        ctes.append(_m(f"{pfx}c{r}",
                       f"SELECT shard, id, v FROM (SELECT shard, id, v, row_number() OVER "
                       f"(PARTITION BY shard ORDER BY {order}) AS rn FROM {pfx}d{r} WHERE {where}) WHERE rn = 1"))
        names.append(f"{pfx}c{r}")
    return ctes, names


def centers_union(names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT shard, {r} AS rank, id, v FROM {n}" for r, n in enumerate(names))


def points_cte(name: str, points_sql: str, L: int | None = None, w: str = "1.0") -> str:
    return _m(name, f"SELECT id, v, {shard_expr(L)} AS shard, CAST({w} AS DOUBLE) AS w FROM ({points_sql})")


def assign_ctes(pfx: str, pts: str, cen: str) -> list[str]:
    """``{pfx}a(id, shard, v, w, cid, d)``: nearest centre of the same shard."""
    return [_m(f"{pfx}a", f"SELECT id, shard, v, w, cid, d FROM (SELECT p.id, p.shard, p.v, p.w, c.cid, "
                          f"{dist('p.v', 'c.v')} AS d, row_number() OVER (PARTITION BY p.id ORDER BY "
                          f"{dist('p.v', 'c.v')}, c.cid) AS rn FROM {pts} p JOIN {cen} c ON p.shard = c.shard) "
                          f"WHERE rn = 1")]


def lloyd_ctes(pfx: str, pts: str, cen0: str, iters: int) -> tuple[list[str], str]:
    """``iters`` Lloyd rounds; centre CTEs have (shard, cid, v). Returns (ctes, last)."""
    ctes, cen = [], cen0
    for t in range(iters):
        q = f"{pfx}{t}"
        ctes += assign_ctes(q, pts, cen)
        ctes.append(_m(f"{q}x", f"SELECT shard, cid, w, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM {q}a"))
        ctes.append(_m(f"{q}m", f"SELECT shard, cid, i, sum(w * x) AS s FROM {q}x GROUP BY shard, cid, i"))
        ctes.append(_m(f"{q}g", f"SELECT shard, cid, sum(w) AS sw FROM {q}a GROUP BY shard, cid"))
        ctes.append(_m(f"{q}mv", f"SELECT m.shard, m.cid, list(m.s / g.sw ORDER BY m.i) AS v FROM {q}m m "
                                 f"JOIN {q}g g ON m.shard = g.shard AND m.cid = g.cid WHERE g.sw > 0 "
                                 f"GROUP BY m.shard, m.cid"))
        ctes.append(_m(f"{q}c", f"SELECT c.shard, c.cid, coalesce(mv.v, c.v) AS v FROM {cen} c LEFT JOIN {q}mv mv "
                                f"ON c.shard = mv.shard AND c.cid = mv.cid"))
        cen = f"{q}c"
    return ctes, cen


def with_(ctes: list[str], final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def explode_centers(cen: str, shard: bool = False) -> str:
    s = "shard, " if shard else ""
    return (f"SELECT {s}cid, j, round(x, 6) AS x FROM (SELECT {s}cid, generate_subscripts(v, 1) - 1 AS j, "
            f"unnest(v) AS x FROM {cen})")


# --- the k-center family -------------------------------------------------

def k_center(points_sql: str, k: int, L: int | None = None) -> tuple[list[str], list[str]]:
    ctes = [points_cte("kp", points_sql, L)]
    more, names = center_rounds_ctes("kf", "kp", k, "farthest")
    return ctes + more, names


def greedy_ctes(pfx: str, pts: str, k: int, metric: str = "euclidean") -> tuple[list[str], str]:
    """Rounds of the farthest unused pair; returns (ctes, select of (round, id))."""
    ctes = [_m(f"{pfx}g0", f"SELECT id, v FROM {pts}")]
    sel = []
    for r in range(k // 2):
        ctes.append(_m(f"{pfx}m{r}", f"SELECT a.id AS ia, b.id AS ib FROM {pfx}g{r} a JOIN {pfx}g{r} b "
                                     f"ON a.id < b.id ORDER BY {dist('a.v', 'b.v', metric)} DESC, a.id, b.id LIMIT 1"))
        ctes.append(_m(f"{pfx}g{r+1}", f"SELECT id, v FROM {pfx}g{r} WHERE id NOT IN "
                                       f"(SELECT ia FROM {pfx}m{r} UNION ALL SELECT ib FROM {pfx}m{r})"))
        sel.append(f"SELECT {r} AS round, ia AS id FROM {pfx}m{r} UNION ALL SELECT {r} AS round, ib AS id FROM {pfx}m{r}")
    if k % 2:
        sel.append(f"SELECT {k // 2} AS round, min(id) AS id FROM {pfx}g{k // 2} HAVING count(*) > 0")
    return ctes, " UNION ALL ".join(sel)


# --- the k-median family -------------------------------------------------

def seeds(pfx: str, pts: str, k: int, seed: int) -> tuple[list[str], str]:
    """Seeding CTEs; returns (ctes, centre CTE with (shard, cid, id, v))."""
    ctes, names = center_rounds_ctes(pfx, pts, k, "seed", seed)
    ctes.append(_m(f"{pfx}s", "SELECT shard, rank AS cid, id, v FROM (" + centers_union(names) + ")"))
    return ctes, f"{pfx}s"


def kmedian_cluster(pfx: str, pts: str, k: int, iters: int, seed: int) -> tuple[list[str], str]:
    ctes, s = seeds(pfx + "s", pts, k, seed)
    ctes.append(_m(f"{pfx}c0", f"SELECT shard, cid, v FROM {s}"))
    more, last = lloyd_ctes(pfx + "l", pts, f"{pfx}c0", iters)
    return ctes + more, last


def kmedian_coreset(points_sql: str, k: int, L: int, iters: int, seed: int) -> tuple[list[str], str]:
    """Round 1: (shard, cid, v, w) with w = points nearest each final centre."""
    ctes = [points_cte("mp", points_sql, L)]
    more, cen = kmedian_cluster("r1", "mp", k, iters, seed)
    ctes += more
    ctes += assign_ctes("r1w", "mp", cen)
    ctes.append(_m("r1n", "SELECT shard, cid, count(*) AS n FROM r1wa GROUP BY shard, cid"))
    ctes.append(_m("core", f"SELECT c.shard, c.cid, c.v, CAST(coalesce(n.n, 0) AS BIGINT) AS w FROM {cen} c "
                           f"LEFT JOIN r1n n ON c.shard = n.shard AND c.cid = n.cid"))
    return ctes, "core"


def mr_kmedian(points_sql: str, k: int, L: int, iters: int, seed: int) -> str:
    ctes, core = kmedian_coreset(points_sql, k, L, iters, seed)
    ctes.append(_m("mq", f"SELECT CAST(shard AS BIGINT) * {k} + cid AS id, v, 0 AS shard, "
                         f"CAST(w AS DOUBLE) AS w FROM {core}"))
    more, cen = kmedian_cluster("r2", "mq", k, iters, seed)
    ctes += more
    ctes.append(_m("ap", "SELECT id, v, 0 AS shard, 1.0 AS w FROM (" + points_sql + ")"))
    ctes += assign_ctes("r3", "ap", cen)
    return with_(ctes, "SELECT round(avg(d), 6) AS objective FROM r3a")


def pruned_mpd(points_sql: str, dim: int) -> str:
    """Exact MPD with the centroid-pivot pruning, then all pairs of the survivors."""
    cen = ", ".join(f"avg(v[{i + 1}])" for i in range(dim))
    return (f"WITH p AS MATERIALIZED ({points_sql}), c AS (SELECT [{cen}] AS c FROM p), "
            f"r AS MATERIALIZED (SELECT p.id, p.v, list_distance(p.v, c.c) AS r FROM p, c), "
            f"far AS (SELECT v, r FROM r ORDER BY r DESC, id LIMIT 1), "
            f"lb AS (SELECT coalesce(max(list_distance(r.v, far.v)), 0) AS lb FROM r, far), "
            f"s AS MATERIALIZED (SELECT r.id, r.v FROM r, far, lb WHERE r.r + far.r >= lb.lb - 1e-9 * greatest(lb.lb, 1.0)) "
            f"SELECT round(coalesce(max(list_distance(a.v, b.v)), 0), 6) AS mpd FROM s a JOIN s b ON a.id < b.id")
