"""Queries over dense points: the clustering operators on ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.scalar import planned_rounds_column, squared_distance, squared_norm
from cellwise.functions.uniform import keyed_uniform
from cellwise.operators import means, nearest, validation
from cellwise.operators.joins import join_checked
from cellwise.operators.sampling import sample_by_probability, seed_point
from cellwise.operators.weights import candidate_weights, nearest_frequencies
from cellwise.plans.config import FitConfig, SeedConfig, centers_frame, log_frame
from cellwise.plans.estimator import ParallelKMeans
from cellwise.plans.grid import grid
from cellwise.plans.lloyd import fit_centers
from cellwise.plans.reduce import REDUCE_ITERATIONS, reduce_candidates
from cellwise.plans.seeding import append_candidates, sample_round, seed_candidates
from cellwise.plans.sweep import SweepConfig, spread, sweep
from cellwise.sources.synthetic import add_blobs
from cellwise.sources.tabular import load_points

SEED, OVERSAMPLING, K, DIM = 42, 20, 10, 64


def points(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    return load_points(spark, f"{sf}/embeddings.parquet", "vec_id", "embedding", *keep)


def fixed_centers(spark: SparkSession, sf: str) -> DataFrame:
    """Per label, the vector with the smallest id: ``(cluster, center)``."""
    labelled = points(spark, sf, "label")
    return labelled.groupBy(F.col("label").cast("int").alias("cluster")).agg(
        F.min_by("features", "point_id").alias("center")
    )


def nearest_fixed(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    return nearest.nearest_center(
        points(spark, sf, *keep), fixed_centers(spark, sf), index_col="cluster"
    )


def first_seed(spark: SparkSession, sf: str) -> DataFrame:
    return seed_point(points(spark, sf), "point_id", SEED, "md5")


def seed_state(spark: SparkSession, sf: str) -> DataFrame:
    first = first_seed(spark, sf).select(F.lit(0).alias("idx"), F.col("features").alias("center"))
    return nearest.nearest_center(points(spark, sf), first)


def seeded(spark: SparkSession, sf: str, rounds: int):
    config = SeedConfig(OVERSAMPLING, rounds, seed=SEED, rng="md5")
    return seed_candidates(points(spark, sf), config)


def _long(centers: DataFrame, value: str = "value") -> DataFrame:
    """Centres as ``(cluster, dim, value)`` rows, rounded."""
    entries = centers.select("cluster", F.posexplode("center").alias("dim", "v"))
    return entries.select("cluster", "dim", (F.round("v", 6) + F.lit(0.0)).alias(value))


def q_load_points(spark, sf):
    return points(spark, sf).select(
        "point_id",
        F.size("features").alias("dimension"),
        F.round(F.sqrt(squared_norm(F.col("features"))), 6).alias("norm"),
    )


def q_repartition_points(spark, sf):
    placed = spread(spread(points(spark, sf), 20), 5, contiguous=True)
    return placed.select("point_id", F.round(F.sqrt(squared_norm(F.col("features"))), 6).alias("norm"))


def q_seed_point(spark, sf):
    u = keyed_uniform("point_id", SEED, 0, "md5")
    return first_seed(spark, sf).select("point_id", F.round(u, 9).alias("u"))


def q_squared_distance(spark, sf):
    own = fixed_centers(spark, sf).withColumnRenamed("cluster", "label")
    return join_checked(points(spark, sf, "label"), own, "label", 8 * DIM).select(
        "point_id", "label", F.round(squared_distance("features", "center"), 6).alias("d2")
    )


def q_all_distances(spark, sf):
    centers = fixed_centers(spark, sf).withColumnRenamed("cluster", "idx")
    table = nearest.all_distances(points(spark, sf), centers)
    return table.select(
        "point_id", *[F.round(F.get("distances", F.lit(i)), 6).alias(f"d{i}") for i in range(K)]
    )


def q_min_distances(spark, sf):
    return nearest_fixed(spark, sf).select("point_id", F.round("d2", 6).alias("d2"))


def q_argmin_center(spark, sf):
    # K centres: they become literals of the plan, whatever the size of a block
    chosen = fixed_centers(spark, sf).orderBy("cluster").select("center").collect()
    found = nearest.nearest_center_sql(points(spark, sf), nearest.as_matrix(r[0] for r in chosen))
    return found.select("point_id", F.col("idx").alias("cluster"), F.round("d2", 6).alias("d2"))


def q_nearest_center(spark, sf):
    return nearest_fixed(spark, sf).select(
        "point_id", F.col("idx").alias("cluster"), F.round("d2", 6).alias("d2")
    )


def q_classify(spark, sf):
    near = nearest.nearest_center(points(spark, sf), fixed_centers(spark, sf), index_col="cluster")
    return near.select("point_id", F.col("idx").alias("cluster"))


def _cost(state: DataFrame) -> DataFrame:
    return state.agg(F.round(F.sum("d2"), 6).alias("cost"))


def q_initial_cost(spark, sf):
    return _cost(seed_state(spark, sf))


def q_round_cost(spark, sf):
    return _cost(seeded(spark, sf, 1).state)


def q_inertia(spark, sf):
    return _cost(nearest_fixed(spark, sf))


def q_sampling_probability(spark, sf):
    state = nearest.probabilities(seed_state(spark, sf), OVERSAMPLING)
    return state.select("point_id", F.round("p", 6).alias("p"))


def q_sample_by_probability(spark, sf):
    with_p = nearest.probabilities(nearest_fixed(spark, sf), OVERSAMPLING)
    drawn = sample_by_probability(with_p, "point_id", "p", SEED, 1, "md5")
    return drawn.select("point_id", F.round("p", 6).alias("p"))


def q_planned_rounds(spark, sf):
    own = fixed_centers(spark, sf).withColumnRenamed("cluster", "label")
    costs = join_checked(points(spark, sf, "label"), own, "label", 8 * DIM).groupBy("label").agg(
        F.sum(squared_distance("features", "center")).alias("psi")
    )
    alphas = F.explode(F.array(F.lit(0.5), F.lit(1.0), F.lit(2.0), F.lit(5.0)))
    return costs.withColumn("alpha", alphas).select(
        "label", "alpha", F.round("psi", 6).alias("psi"),
        planned_rounds_column("psi", F.col("alpha")).alias("rounds"),
    )


def q_attach_state(spark, sf):
    state = nearest_fixed(spark, sf).select("point_id", "d2", "idx")
    return points(spark, sf).join(state, "point_id").select(
        "point_id", F.round(F.sqrt(squared_norm(F.col("features"))), 6).alias("norm"),
        F.round("d2", 6).alias("d2"), "idx",
    )


def q_state_update(spark, sf):
    centers = fixed_centers(spark, sf)
    old = nearest.nearest_center(points(spark, sf), centers.where("cluster = 0"), index_col="cluster")
    newer = nearest.CenterSearch(spark, centers.where("cluster between 1 and 3"), "cluster")
    state = newer.update(old)
    return state.select("point_id", F.round("d2", 6).alias("d2"), "idx")


def q_append_candidates(spark, sf):
    state = seed_state(spark, sf)
    cost = nearest.total_cost(state)
    config = SeedConfig(OVERSAMPLING, 1, seed=SEED, rng="md5")
    candidates = first_seed(spark, sf).select(
        F.lit(0).alias("idx"), "point_id", F.lit(0).alias("round"), F.col("features").alias("center")
    )
    grown = append_candidates(candidates, sample_round(state, config, 1, cost), 1)
    return grown.select("idx", "point_id", "round")


def q_nearest_frequencies(spark, sf):
    return nearest_frequencies(seeded(spark, sf, 1).state)


def q_candidate_weights(spark, sf):
    seeding = seeded(spark, sf, 1)
    found = candidate_weights(seeding.candidates.drop("weight"), seeding.state)
    return found.select("idx", "point_id", "weight")


def q_kmeans_seed_candidates(spark, sf):
    seeding = seeded(spark, sf, 2)
    seeding.release()
    return seeding.candidates.select("idx", "point_id", "round", "weight")


def q_reduce_candidates(spark, sf):
    seeding = seeded(spark, sf, 2)
    seeding.release()
    centers = reduce_candidates(seeding.candidates, K, SEED, "md5")
    return _long(centers_frame(spark, centers))


def q_cluster_means(spark, sf):
    found = means.cluster_means(nearest_fixed(spark, sf), DIM, cluster="idx", d2="d2")
    return _long(found, "mean")


def q_cluster_means_sql(spark, sf):
    found = means.cluster_means_sql(nearest_fixed(spark, sf), cluster="idx")
    return found.select("cluster", "dim", (F.round("mean", 6) + F.lit(0.0)).alias("mean"))


def _lloyd(spark, sf, iterations: int, extra: DataFrame | None = None):
    start = fixed_centers(spark, sf)
    if extra is not None:
        start = start.unionByName(extra)
    return fit_centers(points(spark, sf), start, FitConfig(iterations, 0.0))


def q_lloyd_step_empty_cluster(spark, sf):
    far = spark.range(1).select(F.lit(K).alias("cluster"), F.array_repeat(F.lit(100.0), DIM).alias("center"))
    return _long(_lloyd(spark, sf, 1, far).centers_frame(spark))


def q_lloyd_1(spark, sf):
    return _long(_lloyd(spark, sf, 1).centers_frame(spark))


def q_lloyd_3(spark, sf):
    return _long(_lloyd(spark, sf, 3).centers_frame(spark))


def q_center_shift(spark, sf):
    log = log_frame(spark, _lloyd(spark, sf, 3).log)
    return log.select(F.col("round").alias("iteration"), F.round("shift", 6).alias("shift"))


def _table(spark, sf) -> DataFrame:
    return validation.contingency(nearest_fixed(spark, sf, "label"), "idx", "label")


def q_contingency(spark, sf):
    return _table(spark, sf)


def q_purity(spark, sf):
    return validation.purity(_table(spark, sf)).select(F.round("purity", 6).alias("purity"))


def q_nmi(spark, sf):
    return validation.nmi(_table(spark, sf)).select(F.round("nmi", 6).alias("nmi"))


def q_ari(spark, sf):
    return validation.ari(_table(spark, sf)).select(F.round("ari", 6).alias("ari"))


def q_cluster_overlay(spark, sf):
    near = nearest_fixed(spark, sf, "label").withColumnRenamed("idx", "cluster")
    both = validation.cluster_overlay(near, fixed_centers(spark, sf))
    # a centre has no label of its own
    return both.select("kind", "id", "cluster", F.coalesce("label", F.lit(-1)).cast("int").alias("label"))


def q_blobs(spark, sf):
    made = add_blobs(points(spark, sf), "point_id", 2, 4, SEED, 1.0, 10.0, "md5")
    return made.select(
        "point_id", "label",
        F.round(F.get("features", F.lit(0)), 6).alias("x"),
        F.round(F.get("features", F.lit(1)), 6).alias("y"),
    )


# Partitions, oversampling factor and rounds of the published grid.
GRID = [(5, 2, 5), (20, 2, 5), (100, 2, 5), (20, 5, 2), (20, 1, 1), (20, 2, 15)]
SWEEP = tuple(SweepConfig(parts=parts, l=l, r=r, rng="md5") for parts, l, r in GRID)


def q_sweep(spark, sf):
    """What the grid gives, without the times; too few candidates for ``k`` leave no cost."""
    found = sweep(points(spark, sf), SWEEP)
    return found.select("run_id", "parts", "k", "l", "r", "n_candidates", "distance_passes", F.round("cost", 6).alias("cost"), F.col("error").isNotNull().alias("failed"))


def q_sweep_grid(spark, sf):
    """The same grid in shared passes, without the partitioning."""
    found = grid(points(spark, sf), SWEEP)
    return found.select("run_id", "k", "l", "r", "n_candidates", "distance_passes", F.round("cost", 6).alias("cost"), F.col("error").isNotNull().alias("failed"))


def q_iteration_log(spark, sf):
    data = points(spark, sf)
    clusterer = ParallelKMeans(K, OVERSAMPLING, 2).seed(data, seed=SEED, rng="md5")
    clusterer.fit(data, max_iter=5)
    log = clusterer.iteration_log(data)
    clusterer.release()
    return log.select("phase", "round", F.round("cost", 6).alias("cost"), "n_sampled", "n_candidates", F.round("shift", 6).alias("shift"))


# --- the same in SQL -------------------------------------------------------------

E = "e as (select vec_id as point_id, embedding::double[] as features, label from embeddings)"
C = "c as (select label::int as cluster, min_by(features, point_id) as center from e group by label)"


def d2_sql(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1]-z[2])*(z[1]-z[2])))"


def norm_sql(a: str) -> str:
    return f"round(sqrt(list_sum(list_transform({a}, lambda x: x*x))), 6)"


def u_sql(stream: int | str, key: str) -> str:
    return f"(('0x'||substr(md5('{SEED}:{stream}:'||{key}),1,13))::bigint/4503599627370496.0)"


def near_sql(name: str, centers: str = "c") -> str:
    """CTEs ``<name>_all`` (every pair) and ``<name>`` (nearest, lowest index on ties)."""
    return (
        f"{name}_all as (select e.point_id, e.label, cluster as idx, {d2_sql('features', 'center')} as d2"
        f" from e, {centers}), {name} as (select * exclude (rn) from (select *, row_number() over"
        f" (partition by point_id order by d2, idx) as rn from {name}_all) where rn = 1)"
    )


def seeding_sql(rounds: int, oversampling: float = OVERSAMPLING) -> str:
    """CTEs ``st0..stN`` (state), ``cand`` (all candidates) for N unrolled rounds."""
    ctes = [
        f"s0 as (select point_id, features from e order by {u_sql(0, 'point_id')}, point_id limit 1)",
        "cand0 as (select 0::int as idx, point_id, 0::int as round, features as center from s0)",
        f"st0 as (select e.point_id, e.features, {d2_sql('e.features', 's0.features')} as d2,"
        " 0::int as idx from e, s0)",
    ]
    for t in range(1, rounds + 1):
        p = t - 1
        ctes += [
            f"cost{t} as (select sum(d2) as cost from st{p})",
            f"smp{t} as (select point_id, features from st{p}, cost{t} where"
            f" {u_sql(t, 'point_id')} < least(1.0, d2*{oversampling}/cost))",
            f"new{t} as (select ((select count(*) from cand{p}) - 1 + row_number() over"
            f" (order by point_id))::int as idx, point_id, {t}::int as round, features as center from smp{t})",
            f"cand{t} as (select * from cand{p} union all select * from new{t})",
            f"near{t} as (select point_id, min(d2) as d2, arg_min(idx, (d2, idx)) as idx from"
            f" (select st{p}.point_id, n.idx, {d2_sql('features', 'center')} as d2 from st{p}, new{t} n)"
            " group by point_id)",
            f"st{t} as (select s.point_id, s.features, case when n.d2 < s.d2 then n.d2 else s.d2 end as d2,"
            f" case when n.d2 < s.d2 then n.idx else s.idx end as idx from st{p} s left join near{t} n using (point_id))",
        ]
    return ", ".join(ctes)


def weights_sql(rounds: int) -> str:
    return (
        f"w as (select c.idx, c.point_id, c.round, coalesce(n, 0)::double as weight from cand{rounds} c"
        f" left join (select idx, count(*) as n from st{rounds} group by idx) using (idx))"
    )


def reduce_sql(k: int, iterations: int, rounds: int = 2) -> str:
    """CTEs ``r0`` (weighted candidates), ``pick1..pickK`` (draws) and ``start`` (centres) from ``w`` and ``candN``."""
    ctes = [f"r0 as materialized (select w.idx, w.weight, c.center, 1.0::double as d2 from w join cand{rounds} c using (idx) where weight > 0)"]
    for j in range(k):
        u = u_sql("reduce", f"idx||':{j}'")
        ctes += [
            f"pick{j} as materialized (select {j} as cluster, idx, center from r{j} where weight*d2 > 0 order by -ln(1 - {u})/(weight*d2), idx limit 1)",
            f"r{j + 1} as materialized (select r.idx, r.weight, r.center, {'' if j == 0 else 'least(r.d2, '}{d2_sql('r.center', 'p.center')}{'' if j == 0 else ')'} as d2 from r{j} r, pick{j} p)",
        ]
    ctes.append("g0 as materialized (" + " union all ".join(f"select cluster, center from pick{j}" for j in range(k)) + ")")
    for i in range(iterations):
        ctes += [
            f"h{i} as (select r.idx, any_value(r.center) as center, any_value(weight) as weight, arg_min(cluster, ({d2_sql('r.center', 'g.center')}, cluster)) as cluster from r0 r, g{i} g group by r.idx)",
            f"g{i + 1} as materialized (select g.cluster, coalesce(n.center, g.center) as center from g{i} g left join (select cluster, list(v order by dim) as center from"
            f" (select cluster, dim, sum(weight*v)/sum(weight) as v from (select cluster, weight, unnest(center) as v, generate_subscripts(center, 1) as dim from h{i}) group by cluster, dim) group by cluster) n using (cluster))",
        ]
    ctes.append(f"start as (select cluster::int as cluster, center from g{iterations})")
    return ", ".join(ctes)


def lloyd_sql(iterations: int, start: str = "c") -> str:
    """CTEs ``k0..kN`` (centres after each iteration) and ``shift1..shiftN``."""
    ctes = [f"k0 as (select cluster, center from {start})"]
    for t in range(1, iterations + 1):
        p = t - 1
        ctes += [
            near_sql(f"a{t}", f"k{p}"),
            f"m{t} as (select idx, dim, avg(v) as v from (select idx, unnest(features) as v,"
            f" generate_subscripts(features, 1) as dim from a{t} join e using (point_id)) group by all)",
            f"k{t} as (select k{p}.cluster, coalesce(n.center, k{p}.center) as center from k{p} left join"
            f" (select idx, list(v order by dim) as center from m{t} group by idx) n on n.idx = k{p}.cluster)",
            f"shift{t} as (select {t}::int as iteration, sqrt(sum({d2_sql('o.center', 'n.center')})) as shift"
            f" from k{p} o join k{t} n using (cluster))",
        ]
    return ", ".join(ctes)


def long_sql(centers: str, value: str = "value") -> str:
    return (
        f"select cluster, (dim - 1)::int as dim, round(v, 6) + 0.0::double as {value} from (select cluster,"
        f" unnest(center) as v, generate_subscripts(center, 1) as dim from {centers})"
    )


def log_sql(rounds: int, iterations: int) -> str:
    """Rows of the log, from CTEs of :func:`seeding_sql` and :func:`lloyd_sql`."""
    rows = [f"select 'seed' as phase, 0::int as round, (select sum(d2) from st0) as cost, 1::bigint as n_sampled, 1::bigint as n_candidates, null::double as shift"]
    rows += [
        f"select 'seed', {t}::int, (select sum(d2) from st{t}), (select count(*) from new{t}), (select count(*) from cand{t}), null" for t in range(1, rounds + 1)
    ]
    rows += [f"select 'lloyd', {t}::int, (select sum(d2) from a{t}), null, null, (select shift from shift{t})" for t in range(1, iterations + 1)]
    return "select phase, round, round(cost, 6) as cost, n_sampled, n_candidates, round(shift, 6) as shift from (" + " union all ".join(rows) + ")"


def sweep_sql() -> str:
    """One row a configuration: candidates, passes, cost of the last centres, whether candidates were too few."""
    rows = []
    for run_id, c in enumerate(SWEEP):
        passes = " + ".join(["1", *[f"(select count(*) > 0 from new{t})::int" for t in range(1, c.r + 1)]])
        rows.append(
            f"(with {E}, {seeding_sql(c.r, c.l)}, {weights_sql(c.r)}, {reduce_sql(c.k, REDUCE_ITERATIONS, c.r)}, {lloyd_sql(c.max_iter, 'start')}, {near_sql('fin', f'k{c.max_iter}')},"
            f" enough as (select count(*) >= {c.k} as ok from r0) select {run_id}::int as run_id, {c.parts}::int as parts, {c.k}::int as k, {float(c.l)}::double as l, {c.r}::int as r,"
            f" (select count(*) from cand{c.r}) as n_candidates, ({passes})::int as distance_passes, case when ok then round((select sum(d2) from fin), 6) end as cost, not ok as failed from enough)"
        )
    return " union all ".join(rows)


SEEDED_SQL = f"with {E}, {seeding_sql(2)}, {weights_sql(2)}, {reduce_sql(K, REDUCE_ITERATIONS)}"
MEANS_SQL = f"with {E}, {C}, {lloyd_sql(1)} " + long_sql("k1", "mean")
TABLE = f"{E}, {C}, {near_sql('a')}, t as (select idx as cluster, label, count(*) as n from a group by all)"
STATE0 = f"{E}, {seeding_sql(0)}"


def _entropy(shares: str) -> str:
    return f"(select -sum(n/t*ln(n/t)) from (select {shares}), (select sum(n)::double as t from t))"


def _pairs(counts: str) -> str:
    return f"(select sum(n::double*(n-1)/2) from (select {counts}))"


ORACLE = {
    "load_points": f"with {E} select point_id, len(features)::int as dimension, {norm_sql('features')} as norm from e",
    "repartition_points": f"with {E} select point_id, {norm_sql('features')} as norm from e",
    "seed_point": f"with {E} select point_id, round({u_sql(0, 'point_id')}, 9) as u from e"
    f" order by {u_sql(0, 'point_id')}, point_id limit 1",
    "squared_distance": f"with {E}, {C} select point_id, label, round({d2_sql('features', 'center')}, 6) as d2"
    " from e join c on label = cluster",
    "all_distances": f"with {E}, {C}, {near_sql('a')} select point_id, "
    + ", ".join(f"round(max(d2) filter (where idx = {i}), 6) as d{i}" for i in range(K))
    + " from a_all group by point_id",
    "min_distances": f"with {E}, {C}, {near_sql('a')} select point_id, round(d2, 6) as d2 from a",
    "argmin_center": f"with {E}, {C}, {near_sql('a')} select point_id, idx as cluster, round(d2, 6) as d2 from a",
    "nearest_center": f"with {E}, {C}, {near_sql('a')} select point_id, idx as cluster, round(d2, 6) as d2 from a",
    "classify": f"with {E}, {C}, {near_sql('a')} select point_id, idx as cluster from a",
    "initial_cost": f"with {STATE0} select round(sum(d2), 6) as cost from st0",
    "round_cost": f"with {E}, {seeding_sql(1)} select round(sum(d2), 6) as cost from st1",
    "inertia": f"with {E}, {C}, {near_sql('a')} select round(sum(d2), 6) as cost from a",
    "sampling_probability": f"with {STATE0}, q as (select sum(d2) as cost from st0) select point_id,"
    f" round(least(1.0, d2*{OVERSAMPLING}/cost), 6) as p from st0, q",
    "sample_by_probability": f"with {E}, {C}, {near_sql('a')}, q as (select sum(d2) as cost from a),"
    f" r as (select point_id, least(1.0, d2*{OVERSAMPLING}/cost) as p from a, q)"
    f" select point_id, round(p, 6) as p from r where {u_sql(1, 'point_id')} < p",
    "planned_rounds": f"with {E}, {C}, q as (select label, sum({d2_sql('features', 'center')}) as psi from e"
    " join c on label = cluster group by label) select label, alpha, round(psi, 6) as psi,"
    " (case when psi > 0 then greatest(0, round_even(alpha*ln(psi), 0)) else 0 end)::int as rounds"
    " from q, (select unnest([0.5, 1.0, 2.0, 5.0])::double as alpha)",
    "attach_state": f"with {E}, {C}, {near_sql('a')} select point_id, {norm_sql('features')} as norm,"
    " round(d2, 6) as d2, idx from e join a using (point_id)",
    "state_update": f"with {E}, {C}, c3 as (select * from c where cluster <= 3), {near_sql('a', 'c3')}"
    " select point_id, round(d2, 6) as d2, idx from a",
    "append_candidates": f"with {E}, {seeding_sql(1)} select idx, point_id, round from cand1",
    "nearest_frequencies": f"with {E}, {seeding_sql(1)} select idx, count(*) as n from st1 group by idx",
    "candidate_weights": f"with {E}, {seeding_sql(1)}, {weights_sql(1)} select idx, point_id, weight from w",
    "kmeans_seed_candidates": f"with {E}, {seeding_sql(2)}, {weights_sql(2)} select * from w",
    "reduce_candidates": f"{SEEDED_SQL} " + long_sql("start"),
    "sweep": sweep_sql(),
    "sweep_grid": f"select * exclude (parts) from ({sweep_sql()})",
    "iteration_log": f"{SEEDED_SQL}, {lloyd_sql(5, 'start')} " + log_sql(2, 5),
    "cluster_means": MEANS_SQL,
    "cluster_means_sql": MEANS_SQL,
    "lloyd_step_empty_cluster": f"with {E}, {C}, far as (select * from c union all select {K}::int,"
    f" list_transform(range({DIM}), lambda i: 100.0::double)), {lloyd_sql(1, 'far')} " + long_sql("k1"),
    "lloyd_1": f"with {E}, {C}, {lloyd_sql(1)} " + long_sql("k1"),
    "lloyd_3": f"with {E}, {C}, {lloyd_sql(3)} " + long_sql("k3"),
    "center_shift": f"with {E}, {C}, {lloyd_sql(3)} select iteration, round(shift, 6) as shift from"
    " (select * from shift1 union all select * from shift2 union all select * from shift3)",
    "contingency": f"with {TABLE} select cluster, label, n from t",
    "purity": f"with {TABLE} select round(sum(top)/sum(size), 6) as purity from"
    " (select max(n)::double as top, sum(n)::double as size from t group by cluster)",
    "nmi": f"with {TABLE}, h as (select {_entropy('sum(n)::double as n from t group by cluster')} as c,"
    f" {_entropy('sum(n)::double as n from t group by label')} as l, {_entropy('n::double as n from t')} as j)"
    " select round(greatest(0.0, c + l - j)/((c + l)/2), 6) as nmi from h",
    "ari": f"with {TABLE}, s as (select {_pairs('n from t')} as j,"
    f" {_pairs('sum(n) as n from t group by cluster')} as c, {_pairs('sum(n) as n from t group by label')} as l,"
    f" {_pairs('sum(n) as n from t')} as a)"
    " select round((j - c*l/a)/((c + l)/2 - c*l/a), 6) as ari from s",
    "cluster_overlay": f"with {E}, {C}, {near_sql('a')} select 'point' as kind, point_id as id, idx as cluster,"
    " label::int as label from a union all select 'center', cluster::bigint, cluster, -1 from c",
    "blobs": f"with {E}, b as (select point_id, (point_id % 4)::int as label from e), g as (select point_id, label, "
    + ", ".join(
        f"({u_sql(f'center/{d}', 'label')}*2 - 1)*10"
        f" + sqrt(-2*ln(1 - {u_sql(f'noise/{d}/radius', 'point_id')}))"
        f"*cos(6.283185307179586*{u_sql(f'noise/{d}/angle', 'point_id')}) as {axis}"
        for d, axis in enumerate("xy")
    )
    + " from b) select point_id, label, round(x, 6) as x, round(y, 6) as y from g",
}

QUERIES = {
    name[2:]: function for name, function in list(globals().items()) if name.startswith("q_")
}
