"""

Every query reads whole driver tables (``sf_dir/<table>.parquet``). Doubles
are rounded to 6 places on both sides; vectors are reported exploded as
``(cid, j, x)`` rows so both engines compare plain scalars.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import classes as C
from tessera.operators import distance as D
from tessera.operators import kcenter as KC
from tessera.operators import kmedian as KM
from tessera.operators import text as T
from tessera.oracle import sql as O
from tessera.session import ensure_checkpoint_dir
from tessera.sources import tables
from tessera.sources.sinks import write_parquet
from tessera.sources.text import line_documents, parse_pairs, parse_points, read_lines, read_points

# fixed parameters of the registered queries
K_SHARDS = 4          # class-count shards on events
K_LINEITEM = 7        # shard count for the largest-shard statistic on lineitem
SEED = 42
SAMPLE_K = 10
CENTERS_K = 4
LAZY_K = 12           # centres that are picked by lazily opened blocks of part
CORESET_L = 4
MATCH_K = 5
LLOYD_ITERS = 2
CARRIED_ITERS = 6     # Lloyd rounds with carried bounds
MR_ITERS = 1
PART_K = 5


def _r(c, name):
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name)


# --- sources and class counts (events) ------------------------------------

def q_parse_pairs_rest(spark, sf):
    return parse_pairs(tables.event_pair_lines(spark, sf), mode="rest")


def q_parse_pairs_token(spark, sf):
    return parse_pairs(tables.event_pair_lines(spark, sf), mode="token")


def _point_query(sep):
    """Points of ``part`` written as text lines and parsed back."""
    def query(spark, sf):
        lines = _part(spark, sf).select(F.array_join(F.transform("v", lambda x: x.cast("string")), sep).alias("value"))
        return parse_points(lines, sep).select(F.col("v")[0].alias("x"), F.col("v")[1].alias("y"))
    return query


def _written(spark, kind, write):
    """A new path in the shared folder, written by ``write(path)``."""
    path = f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    write(path)
    return path


def q_read_lines(spark, sf):
    """Pair lines written as text files and read back in at least K splits."""
    path = _written(spark, "lines", lambda p: tables.event_pair_lines(spark, sf).write.text(p))
    return parse_pairs(read_lines(spark, path, K_SHARDS), mode="rest")


def _point_file_query(sep):
    """Points of ``part`` written as text files and read back with ids by place."""
    def query(spark, sf):
        lines = _part(spark, sf).select(F.array_join(F.transform("v", lambda x: x.cast("string")), sep).alias("value"))
        points = read_points(spark, _written(spark, "points", lambda p: lines.write.text(p)), sep)
        return points.select(F.col("v")[0].alias("x"), F.col("v")[1].alias("y"), F.col("id")).groupBy("x", "y").agg(F.count_distinct("id").alias("n"))
    return query


def q_sink_round_trip(spark, sf):
    counts = C.class_count_by_shard(_pairs(spark, sf), K_SHARDS)
    path = _written(spark, "counts", lambda p: write_parquet(counts, p, partition_by=["shard"]))
    return spark.read.parquet(path).select("shard", "class", "n")


def _pairs(spark, sf):
    return parse_pairs(tables.event_pair_lines(spark, sf), mode="rest")


def q_class_count_by_shard(spark, sf):
    return C.class_count_by_shard(_pairs(spark, sf), K_SHARDS)


def q_class_count(spark, sf):
    return C.class_count(_pairs(spark, sf), K_SHARDS)


def q_class_count_direct(spark, sf):
    return C.class_count_direct(_pairs(spark, sf))


def q_max_partition_size(spark, sf):
    return C.max_partition_size(tables.lineitem_pairs(spark, sf), K_LINEITEM)


def q_class_count_with_max(spark, sf):
    return C.class_count_with_max(_pairs(spark, sf), K_SHARDS)


def q_most_frequent_class(spark, sf):
    return C.most_frequent_class(C.class_count(_pairs(spark, sf), K_SHARDS))


def q_class_count_sorted(spark, sf):
    return C.class_count_sorted(_pairs(spark, sf), K_SHARDS)


def q_pair_count(spark, sf):
    return C.pair_count(_pairs(spark, sf))


def q_class_count_line(spark, sf):
    return C.class_count_line(C.class_count(_pairs(spark, sf), K_SHARDS))


# --- text (documents split into line documents) ---------------------------

def _lines(spark, sf):
    return line_documents(tables.documents(spark, sf))


def q_line_documents(spark, sf):
    return _lines(spark, sf)


def q_tokens(spark, sf):
    return T.tokens(_lines(spark, sf))


def q_doc_term_count(spark, sf):
    return T.doc_term_count(_lines(spark, sf))


def q_word_count(spark, sf):
    return T.word_count(_lines(spark, sf))


def q_word_count_salted(spark, sf):
    return T.word_count(_lines(spark, sf), strategy="salted", K=K_SHARDS)


def q_word_count_partition(spark, sf):
    return T.word_count(_lines(spark, sf), strategy="partial")


def q_distinct_words(spark, sf):
    return T.distinct_words(_lines(spark, sf))


def q_avg_word_length(spark, sf):
    return T.avg_word_length(_lines(spark, sf)).select(_r("avg_len", "avg_len"))


def q_doc_count(spark, sf):
    return T.doc_count(_lines(spark, sf))


# --- distances ------------------------------------------------------------

def _emb(spark, sf):
    return tables.embedding_points(spark, sf)


def _part(spark, sf):
    return tables.part_points(spark, sf)


def q_pair_distance(spark, sf):
    pts = _emb(spark, sf)
    out = D.pair_distance(pts, D.successor_pairs(pts))
    return out.select("id_a", "id_b", _r("d", "d"))


def q_pair_distance_2d(spark, sf):
    pts = _part(spark, sf)
    out = D.pair_distance(pts, D.successor_pairs(pts), metric="euclidean_2d")
    return out.select("id_a", "id_b", _r("d", "d"))


def q_pair_distance_drop_last(spark, sf):
    pts = _part(spark, sf)
    out = D.pair_distance(pts, D.successor_pairs(pts), metric="sq_drop_last", dim=2)
    return out.select("id_a", "id_b", _r("d", "d"))


def q_exact_mpd(spark, sf):
    return D.exact_mpd(_emb(spark, sf)).select(_r("mpd", "mpd"))


def q_exact_mpd_pruned(spark, sf):
    return D.exact_mpd_pruned(_part(spark, sf)).select(_r("mpd", "mpd"))


def q_two_approx_mpd(spark, sf):
    return D.two_approx_mpd(_emb(spark, sf), SAMPLE_K, SEED).select(_r("mpd_lb", "mpd_lb"))


def q_exact_mpd_pruned_lineitem(spark, sf):
    return D.exact_mpd_pruned(tables.lineitem_points(spark, sf)).select(_r("mpd", "mpd"))


def q_sample_k(spark, sf):
    return D.sample_k(_emb(spark, sf), SAMPLE_K, SEED).select("id")


def q_avg_pairwise_distance(spark, sf):
    return D.avg_pairwise_distance(_emb(spark, sf)).select(_r("avg_d", "avg_d"))


def q_distinct_points(spark, sf):
    return D.distinct_points(_part(spark, sf)).select("id")


def q_point_count(spark, sf):
    return D.point_count(_part(spark, sf))


# --- k-center and diversity -------------------------------------------------

def q_k_center(spark, sf):
    return KC.k_center(_emb(spark, sf), CENTERS_K).select("rank", "id")


def q_k_center_lazy(spark, sf):
    return KC.k_center_lazy(_part(spark, sf), LAZY_K).select("rank", "id")


def q_k_center_lazy_lineitem(spark, sf):
    return KC.k_center_lazy(tables.lineitem_points(spark, sf), CENTERS_K).select("rank", "id")


def q_k_center_distances(spark, sf):
    return KC.k_center_distances(_emb(spark, sf), CENTERS_K).select("id", _r("d", "d"))


def q_k_center_mpd(spark, sf):
    return KC.k_center_mpd(_emb(spark, sf), CENTERS_K).select(_r("mpd", "mpd"))


def q_k_center_coreset(spark, sf):
    return KC.k_center_coreset(_emb(spark, sf), CENTERS_K, CORESET_L).select("shard", "rank", "id")


def q_k_center_coreset_lineitem(spark, sf):
    pts = tables.lineitem_points(spark, sf)
    return KC.k_center_coreset(pts, CENTERS_K, CORESET_L).select("shard", "rank", "id")


def q_greedy_matching(spark, sf):
    return KC.greedy_matching(_emb(spark, sf), MATCH_K).select("round", "id")


def q_diversity_max(spark, sf):
    return KC.diversity_max(_emb(spark, sf), CENTERS_K, CORESET_L).select("round", "id")


def q_diversity_score(spark, sf):
    return KC.diversity_score(_emb(spark, sf), CENTERS_K, CORESET_L).select(_r("avg_d", "avg_d"))


# --- k-median -------------------------------------------------------------

def _centers_rows(spark, centers, with_shard=False):
    rows = [(s, c, j, float(x)) for s, vs in sorted(centers.items())
            for c, v in enumerate(vs) for j, x in enumerate(v)]
    df = spark.createDataFrame(rows, "shard int, cid int, j int, x double")
    cols = (["shard"] if with_shard else []) + ["cid", "j", _r("x", "x")]
    return df.select(*cols)


def _seeds(spark, sf):
    pts = _emb(spark, sf)
    chosen = KM.kmedian_seed(pts, CENTERS_K, SEED)
    return pts, {s: [v for _, v in lst] for s, lst in chosen.items()}, chosen


def q_kmedian_seed(spark, sf):
    chosen = KM.kmedian_seed(_emb(spark, sf), CENTERS_K, SEED)
    rows = [(r, i) for _s, lst in chosen.items() for r, (i, _v) in enumerate(lst)]
    return spark.createDataFrame(rows, "rank int, id long")


def q_assign_nearest(spark, sf):
    pts, centers, _ = _seeds(spark, sf)
    return KM.assign_nearest(pts, centers).select("id", "cid", _r("d", "d"))


def q_lloyd_step(spark, sf):
    pts, centers, _ = _seeds(spark, sf)
    new = KM.lloyd(KM.prepare(pts), centers, None, 1)
    return _centers_rows(spark, new)


def q_lloyd(spark, sf):
    pts, centers, _ = _seeds(spark, sf)
    new = KM.lloyd(KM.prepare(pts), centers, None, LLOYD_ITERS)
    return _centers_rows(spark, new)


def q_kmedian_cluster(spark, sf):
    centers = KM.kmedian_cluster(_part(spark, sf), PART_K, LLOYD_ITERS, SEED)
    return _centers_rows(spark, centers)


def q_kmedian_cluster_carried(spark, sf):
    centers = KM.kmedian_cluster(_part(spark, sf), PART_K, CARRIED_ITERS, SEED, carry=True)
    return _centers_rows(spark, centers)


def q_kmedian_objective(spark, sf):
    pts = _emb(spark, sf)
    centers = KM.kmedian_cluster(pts, CENTERS_K, LLOYD_ITERS, SEED)
    return KM.kmedian_objective(pts, centers).select(_r("objective", "objective"))


def q_center_weights(spark, sf):
    pts, centers, _ = _seeds(spark, sf)
    return KM.center_weights(pts, centers).select("cid", "n")


def q_kmedian_coreset(spark, sf):
    core = KM.kmedian_coreset(_emb(spark, sf), CENTERS_K, CORESET_L, MR_ITERS, SEED)
    return core.select("shard", "cid", "w", F.posexplode("v").alias("j", "x")).select(
        "shard", "cid", "w", "j", _r("x", "x"))


def q_mr_kmedian(spark, sf):
    obj, _ = KM.mr_kmedian(_emb(spark, sf), CENTERS_K, CORESET_L, MR_ITERS, SEED)
    return obj.select(_r("objective", "objective"))


def q_mr_kmedian_lineitem(spark, sf):
    obj, _ = KM.mr_kmedian(tables.lineitem_points(spark, sf), CENTERS_K, CORESET_L, MR_ITERS, SEED)
    return obj.select(_r("objective", "objective"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_pairs_rest": q_parse_pairs_rest,
    "parse_pairs_token": q_parse_pairs_token,
    "parse_points_comma": _point_query(","),
    "parse_points_space": _point_query(" "),
    "read_lines": q_read_lines,
    "read_points_comma": _point_file_query(","),
    "read_points_space": _point_file_query(" "),
    "sink_round_trip": q_sink_round_trip,
    "class_count_by_shard": q_class_count_by_shard,
    "class_count": q_class_count,
    "class_count_direct": q_class_count_direct,
    "max_partition_size": q_max_partition_size,
    "class_count_with_max": q_class_count_with_max,
    "most_frequent_class": q_most_frequent_class,
    "class_count_sorted": q_class_count_sorted,
    "pair_count": q_pair_count,
    "class_count_line": q_class_count_line,
    "line_documents": q_line_documents,
    "tokens": q_tokens,
    "doc_term_count": q_doc_term_count,
    "word_count": q_word_count,
    "word_count_salted": q_word_count_salted,
    "word_count_partition": q_word_count_partition,
    "distinct_words": q_distinct_words,
    "avg_word_length": q_avg_word_length,
    "doc_count": q_doc_count,
    "pair_distance": q_pair_distance,
    "pair_distance_2d": q_pair_distance_2d,
    "pair_distance_drop_last": q_pair_distance_drop_last,
    "exact_mpd": q_exact_mpd,
    "exact_mpd_pruned": q_exact_mpd_pruned,
    "exact_mpd_pruned_lineitem": q_exact_mpd_pruned_lineitem,
    "two_approx_mpd": q_two_approx_mpd,
    "sample_k": q_sample_k,
    "avg_pairwise_distance": q_avg_pairwise_distance,
    "distinct_points": q_distinct_points,
    "point_count": q_point_count,
    "k_center": q_k_center,
    "k_center_lazy": q_k_center_lazy,
    "k_center_lazy_lineitem": q_k_center_lazy_lineitem,
    "k_center_distances": q_k_center_distances,
    "k_center_mpd": q_k_center_mpd,
    "k_center_coreset": q_k_center_coreset,
    "k_center_coreset_lineitem": q_k_center_coreset_lineitem,
    "greedy_matching": q_greedy_matching,
    "diversity_max": q_diversity_max,
    "diversity_score": q_diversity_score,
    "kmedian_seed": q_kmedian_seed,
    "assign_nearest": q_assign_nearest,
    "lloyd_step": q_lloyd_step,
    "lloyd": q_lloyd,
    "kmedian_cluster": q_kmedian_cluster,
    "kmedian_cluster_carried": q_kmedian_cluster_carried,
    "kmedian_objective": q_kmedian_objective,
    "center_weights": q_center_weights,
    "kmedian_coreset": q_kmedian_coreset,
    "mr_kmedian": q_mr_kmedian,
    "mr_kmedian_lineitem": q_mr_kmedian_lineitem,
}


_ORACLES: dict[str, str] = {}

# The training-data operators and their pipeline are a part that can be taken out.
try:
    from tessera.llm import queries as _llm
except ImportError:
    _llm = None
if _llm:
    _QUERIES.update(_llm.QUERIES)
    _ORACLES.update(_llm.ORACLE_SQL)
    try:
        import corpus_pipeline as _pipeline
    except ImportError:
        _pipeline = None
    if _pipeline:
        _QUERIES["pipeline"] = _pipeline.run
        if _pipeline.ORACLE_SQL:
            _ORACLES["pipeline"] = _pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: class counts plus the largest deterministic shard, events sf0.001."""
    return q_class_count_with_max(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


# --- oracle SQL -------------------------------------------------------------

def _parsed_pairs_sql() -> str:
    return (f"SELECT CAST(split_part(line, ' ', 1) AS BIGINT) AS id, "
            f"substr(line, strpos(line, ' ') + 1) AS class FROM ({O.PAIR_LINES})")


def _oracle() -> dict[str, str]:
    pairs = _parsed_pairs_sql()
    cc = f"SELECT class, count(*) AS n FROM ({pairs}) GROUP BY class"
    words = f"SELECT unnest(string_split(text, ' ')) AS word FROM ({O.LINES})"
    succ = lambda pts, metric: (
        f"WITH p AS ({pts}) SELECT a.id AS id_a, b.id AS id_b, round({O.dist('a.v', 'b.v', metric)}, 6) AS d "
        f"FROM p a JOIN p b ON b.id = a.id + 1")
    allpairs = lambda pts, agg, name: (
        f"WITH p AS ({pts}) SELECT round({agg}({O.dist('a.v', 'b.v')}), 6) AS {name} FROM p a JOIN p b ON a.id < b.id")
    sample = f"SELECT id, v FROM ({O.EMB}) ORDER BY {O.first_key(SEED)}, id LIMIT {SAMPLE_K}"
    q: dict[str, str] = {
        "parse_pairs_rest": pairs,
        "parse_pairs_token": (f"SELECT CAST(string_split(line, ' ')[1] AS BIGINT) AS id, "
                              f"string_split(line, ' ')[2] AS class FROM ({O.PAIR_LINES})"),
        "parse_points_comma": "SELECT CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part",
        "parse_points_space": "SELECT CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part",
        "read_lines": pairs,
        "read_points_comma": "SELECT CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, count(*) AS n FROM part GROUP BY 1, 2",
        "read_points_space": "SELECT CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, count(*) AS n FROM part GROUP BY 1, 2",
        "sink_round_trip": (f"SELECT CAST({O.shard_expr(K_SHARDS)} AS INTEGER) AS shard, class, count(*) AS n "
                            f"FROM ({pairs}) GROUP BY 1, 2"),
        "class_count_by_shard": (f"SELECT CAST({O.shard_expr(K_SHARDS)} AS INTEGER) AS shard, class, count(*) AS n "
                                 f"FROM ({pairs}) GROUP BY 1, 2"),
        "class_count": cc,
        "class_count_direct": cc,
        "max_partition_size": (f"SELECT coalesce(max(n), 0) AS max_partition_size FROM (SELECT "
                               f"{O.shard_expr(K_LINEITEM, 'l_orderkey')} AS s, count(*) AS n FROM lineitem GROUP BY 1)"),
        "class_count_with_max": (f"SELECT 'class' AS kind, class, n FROM ({cc}) UNION ALL "
                                 f"SELECT 'max_partition_size' AS kind, NULL AS class, coalesce(max(n), 0) AS n FROM "
                                 f"(SELECT {O.shard_expr(K_SHARDS)} AS s, count(*) AS n FROM ({pairs}) GROUP BY 1)"),
        "most_frequent_class": f"SELECT class, n FROM ({cc}) ORDER BY n DESC, class LIMIT 1",
        "class_count_sorted": f"{cc} ORDER BY class",
        "pair_count": f"SELECT count(*) AS n_pairs FROM ({pairs})",
        "class_count_line": (f"SELECT coalesce(string_agg('(''' || class || ''', ' || CAST(n AS VARCHAR) || ')', ' ' "
                             f"ORDER BY class), '') AS line FROM ({cc})"),
        "line_documents": O.LINES,
        "tokens": f"SELECT doc_id, line_no, unnest(string_split(text, ' ')) AS word FROM ({O.LINES})",
        "doc_term_count": (f"SELECT doc_id, line_no, word, count(*) AS n FROM (SELECT doc_id, line_no, "
                           f"unnest(string_split(text, ' ')) AS word FROM ({O.LINES})) GROUP BY 1, 2, 3"),
        "word_count": f"SELECT word, count(*) AS n FROM ({words}) GROUP BY word",
        "word_count_salted": f"SELECT word, count(*) AS n FROM ({words}) GROUP BY word",
        "word_count_partition": f"SELECT word, count(*) AS n FROM ({words}) GROUP BY word",
        "distinct_words": f"SELECT count(DISTINCT word) AS n_distinct FROM ({words})",
        "avg_word_length": f"SELECT round(avg(length(word)), 6) AS avg_len FROM (SELECT DISTINCT word FROM ({words}))",
        "doc_count": f"SELECT count(*) AS n_docs FROM ({O.LINES})",
        "pair_distance": succ(O.EMB, "euclidean"),
        "pair_distance_2d": succ(O.PART, "euclidean_2d"),
        "pair_distance_drop_last": succ(O.PART, "sq_drop_last"),
        "exact_mpd": allpairs(O.EMB, "max", "mpd"),
        "exact_mpd_pruned": allpairs(O.PART, "max", "mpd"),
        "two_approx_mpd": (f"WITH p AS ({O.EMB}), s AS ({sample}) SELECT round(max({O.dist('p.v', 's.v')}), 6) "
                           f"AS mpd_lb FROM p, s"),
        "sample_k": f"SELECT id FROM ({sample})",
        "avg_pairwise_distance": allpairs(O.EMB, "avg", "avg_d"),
        "distinct_points": f"SELECT min(id) AS id FROM ({O.PART}) GROUP BY v",
        "point_count": f"SELECT count(*) AS n_points FROM ({O.PART})",
    }
    # k-center
    ctes, names = O.k_center(O.EMB, CENTERS_K)
    kc = O.centers_union(names)
    q["k_center"] = O.with_(ctes, f"SELECT rank, id FROM ({kc})")
    for name, points, k in (("k_center_lazy", O.PART, LAZY_K), ("k_center_lazy_lineitem", O.LINEITEM, CENTERS_K)):
        zctes, znames = O.k_center(points, k)
        q[name] = O.with_(zctes, f"SELECT rank, id FROM ({O.centers_union(znames)})")
    last = f"kfd{CENTERS_K - 1}"
    q["k_center_distances"] = O.with_(
        ctes, f"SELECT p.id, round(least(p.d, coalesce({O.dist('p.v', 'c.v')}, p.d)), 6) AS d FROM {last} p "
              f"LEFT JOIN {names[-1]} c ON p.shard = c.shard")
    q["k_center_mpd"] = O.with_(
        ctes + [f"kc AS MATERIALIZED ({kc})"],
        f"SELECT round(coalesce(max({O.dist('a.v', 'b.v')}), 0), 6) AS mpd FROM kc a JOIN kc b ON a.id < b.id")
    cctes, cnames = O.k_center(O.EMB, CENTERS_K, CORESET_L)
    core = O.centers_union(cnames)
    q["k_center_coreset"] = O.with_(cctes, f"SELECT CAST(shard AS INTEGER) AS shard, rank, id FROM ({core})")
    gctes, gsel = O.greedy_ctes("gm", "gp", MATCH_K)
    q["greedy_matching"] = O.with_([f"gp AS MATERIALIZED ({O.EMB})"] + gctes, gsel)
    dctes, dsel = O.greedy_ctes("dv", "dcore", CENTERS_K)
    div_ctes = cctes + [f"dcore AS MATERIALIZED (SELECT id, v FROM ({core}))"] + dctes
    q["diversity_max"] = O.with_(div_ctes, dsel)
    q["diversity_score"] = O.with_(
        div_ctes + [f"sol AS MATERIALIZED (SELECT s.id, c.v FROM ({dsel}) s JOIN dcore c ON s.id = c.id)"],
        f"SELECT round(avg({O.dist('a.v', 'b.v')}), 6) AS avg_d FROM sol a JOIN sol b ON a.id < b.id")
    # k-median
    base = [O.points_cte("np", O.EMB)]
    sctes, scen = O.seeds("ns", "np", CENTERS_K, SEED)
    seed_ctes = base + sctes
    q["kmedian_seed"] = O.with_(seed_ctes, f"SELECT cid AS rank, id FROM {scen}")
    q["assign_nearest"] = O.with_(seed_ctes + O.assign_ctes("na", "np", scen),
                                  "SELECT id, cid, round(d, 6) AS d FROM naa")
    l1, c1 = O.lloyd_ctes("nl", "np", scen, 1)
    q["lloyd_step"] = O.with_(seed_ctes + l1, O.explode_centers(c1))
    l2, c2 = O.lloyd_ctes("nl", "np", scen, LLOYD_ITERS)
    q["lloyd"] = O.with_(seed_ctes + l2, O.explode_centers(c2))
    pk, pc = O.kmedian_cluster("pk", "pp", PART_K, LLOYD_ITERS, SEED)
    q["kmedian_cluster"] = O.with_([O.points_cte("pp", O.PART)] + pk, O.explode_centers(pc))
    ck, cc = O.kmedian_cluster("pk", "pp", PART_K, CARRIED_ITERS, SEED)
    q["kmedian_cluster_carried"] = O.with_([O.points_cte("pp", O.PART)] + ck, O.explode_centers(cc))
    q["kmedian_objective"] = O.with_(seed_ctes + l2 + O.assign_ctes("no", "np", c2),
                                     "SELECT round(avg(d), 6) AS objective FROM noa")
    q["center_weights"] = O.with_(
        seed_ctes + O.assign_ctes("nw", "np", scen),
        f"SELECT s.cid, coalesce(n.n, 0) AS n FROM {scen} s LEFT JOIN "
        f"(SELECT cid, count(*) AS n FROM nwa GROUP BY cid) n ON s.cid = n.cid")
    kctes, kcore = O.kmedian_coreset(O.EMB, CENTERS_K, CORESET_L, MR_ITERS, SEED)
    q["kmedian_coreset"] = O.with_(
        kctes, f"SELECT CAST(shard AS INTEGER) AS shard, cid, w, j, round(x, 6) AS x FROM (SELECT shard, cid, w, "
               f"generate_subscripts(v, 1) - 1 AS j, unnest(v) AS x FROM {kcore})")
    q["mr_kmedian"] = O.mr_kmedian(O.EMB, CENTERS_K, CORESET_L, MR_ITERS, SEED)
    q["exact_mpd_pruned_lineitem"] = O.pruned_mpd(O.LINEITEM, 4)
    lctes, lnames = O.k_center(O.LINEITEM, CENTERS_K, CORESET_L)
    q["k_center_coreset_lineitem"] = O.with_(
        lctes, f"SELECT CAST(shard AS INTEGER) AS shard, rank, id FROM ({O.centers_union(lnames)})")
    q["mr_kmedian_lineitem"] = O.mr_kmedian(O.LINEITEM, CENTERS_K, CORESET_L, MR_ITERS, SEED)
    return q


def oracle_sql() -> dict[str, str]:
    sql = _oracle() | _ORACLES
    return {k: v for k, v in sql.items() if k in _QUERIES}
