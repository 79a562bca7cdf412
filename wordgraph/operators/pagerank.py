"""Fixed-round PageRank in the reference's two exact forms.

``missing='keep'`` (vertex-update form): every vertex seen in the edge list starts
at 1.0; each round a vertex that receives contributions takes
``0.15 + 0.85 * Σ rank(src) / outdeg(src)``, one that receives none keeps its
rank. Parallel edges count each.

``missing='drop'`` (pair-RDD form): edges are de-duplicated; only sources
start with a rank, and after each round only vertices that received a
contribution have one — after k rounds just the ends of walks of length k.

Plan per round (one Spark job, lineage cut by a written table):

* The weighted edge table is built once: ``1 / outdeg`` per edge, written
  below ``spark.checkpoint.dir`` as a table bucketed and sorted on the join key
  ``(src, salt)``, so a round shuffles only the ranks, never the edges, and no
  executor holds the only copy. The ranks of a part are hashed for the join. Every
  placement of the reference is a vertex cut on this table: it decides how
  many salts a source's edges spread over (grid: the grid's columns; pair:
  up to one per edge), and each rank is copied once per salt.
* Skew: a source with more than ``salt_edges`` out-edges has its edges
  spread over ``ceil(deg / salt_edges)`` salt values (by a hash of the
  target) and its rank is replicated to each; the join key is
  ``(src, salt)``. A source holding a third of all edges is so split over
  many tasks. Contributions are summed per target with a partial
  (map-side) aggregate, so a hot target adds one row per task.
* Ranks are written below ``spark.checkpoint.dir`` every round (no
  ``localCheckpoint``): a lost executor recomputes at most one round. A run
  with a ``name`` that ended, or whose driver was lost, goes on from its last complete
  round when it is started again.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgraph.functions.columns import DAMPING, INITIAL_RANK, RESET, grid_shape
from wordgraph.session import TableCuts, is_complete

DEFAULT_SALT_EDGES = 1 << 20


def _salt_rule(placement: str | None, n: int, salt_edges: int):
    """Salts per source (from its out-degree) and the salt of each edge, per placement.

    Every placement is expressed as a vertex cut: the out-edges of a source
    are spread over ``salts`` keys and its rank is copied to each key, so the
    edges stay where they were placed and only ranks move.

    * ``None`` / ``'src'`` / ``'mod'`` (by source): one key, more only for a
      source with over ``salt_edges`` out-edges (skew).
    * ``'grid'`` (2-D cut): ``cols`` keys per source (the columns of the
      rows x cols grid of ``n`` parts), times the skew split, at most one per edge.
    * ``'pair'`` (hash of both ends): up to ``n`` keys, at most one per edge.
    """
    skew = F.greatest(F.lit(1), F.ceil(F.col("deg") / F.lit(salt_edges)))
    if placement in (None, "src", "mod"):
        salts = skew
        key = F.xxhash64("dst")
    elif placement == "grid":
        _, cols = grid_shape(n)
        # Never more copies of a rank than the source has edges.
        salts = F.greatest(F.lit(1), F.least(F.lit(cols) * skew, F.col("deg")))
        key = F.xxhash64("dst")
    elif placement == "pair":
        salts = F.greatest(F.lit(1), F.least(F.lit(n), F.col("deg")))
        key = F.xxhash64("src", "dst")
    else:
        raise ValueError(f"unknown placement {placement!r}")
    return salts.cast("int"), key


def weighted_edges(edges: DataFrame, dedupe: bool, salt_edges: int = DEFAULT_SALT_EDGES,
                   self_rows: bool = False, placement: str | None = None, n: int = 1) -> DataFrame:
    """``src, dst, weight, salt, src_salts, dst_salts, is_self``.

    ``salt`` spreads the out-edges of a source over ``src_salts`` keys (see
    ``_salt_rule``); ``dst_salts`` is that count for the target (1 without
    out-edges). With ``self_rows`` every vertex also gets one row
    ``(v, v, 0.0, salt 0, is_self)`` that carries its old rank through the
    round, so the keep form needs no second join with the ranks.
    """
    e = edges.select("src", "dst")
    if dedupe:
        e = e.distinct()
    salts_of, key = _salt_rule(placement, n, salt_edges)
    deg = e.groupBy("src").agg(F.count(F.lit(1)).alias("deg")).withColumn("salts", salts_of)
    w = (
        e.join(deg, "src")
        .join(deg.select(F.col("src").alias("dst"), F.col("salts").alias("dst_salts")), "dst", "left")
        .select(
            "src",
            "dst",
            (F.lit(1.0) / F.col("deg")).alias("weight"),
            F.pmod(key, F.col("salts")).cast("int").alias("salt"),
            F.col("salts").alias("src_salts"),
            F.coalesce(F.col("dst_salts"), F.lit(1)).alias("dst_salts"),
            F.lit(False).alias("is_self"),
        )
    )
    if not self_rows:
        return w
    ends = e.select(F.col("src").alias("id")).union(e.select(F.col("dst").alias("id"))).distinct()
    selfs = ends.join(deg.select(F.col("src").alias("id"), "salts"), "id", "left").select(
        F.col("id").alias("src"),
        F.col("id").alias("dst"),
        F.lit(0.0).alias("weight"),
        F.lit(0).alias("salt"),
        F.coalesce(F.col("salts"), F.lit(1)).alias("src_salts"),
        F.coalesce(F.col("salts"), F.lit(1)).alias("dst_salts"),
        F.lit(True).alias("is_self"),
    )
    return w.unionByName(selfs)


def pagerank(edges: DataFrame, iterations: int = 10, missing: str = "keep", dedupe: bool | None = None,
             placement: str | None = None, num_partitions: int | None = None,
             salt_edges: int = DEFAULT_SALT_EDGES, reset: float = RESET, damping: float = DAMPING,
             checkpoint_every: int = 1, name: str | None = None) -> DataFrame:
    """``id, rank`` after ``iterations`` rounds (no tolerance, no normalisation).

    placement: ``None`` / ``'src'`` (by source), ``'grid'`` (2-D cut: each
    source's edges over the ``cols`` columns of the grid of ``n`` parts),
    ``'pair'`` (hash of both ends), ``'mod'`` (by source, drop form). Each is
    a vertex cut on the bucketed edges (see ``_salt_rule``); placement
    changes the order of floating-point sums only, never a rank beyond
    rounding.
    ``checkpoint_every``: rounds between two written rank tables (the plan
    of a round reads the ranks once, so it grows linearly in between).
    ``name``: names the run's tables (with its settings, not ``iterations``): a second run under the same name takes
    up the edges and the last complete round that the first one wrote, so the edges given must be the same.
    """
    if missing not in ("keep", "drop"):
        raise ValueError("missing must be 'keep' or 'drop'")
    if dedupe is None:
        dedupe = missing == "drop"
    spark = edges.sparkSession
    n = int(num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    keep = missing == "keep"

    if name is not None:
        settings = repr((missing, dedupe, placement, n, salt_edges, reset, damping))
        name = f"{name}-{hashlib.sha256(settings.encode()).hexdigest()[:12]}"
    cuts = TableCuts(spark, "pagerank", name)
    table = f"wordgraph_edges_{uuid.uuid4().hex}"
    try:
        weights = bucketed_edges(
            spark, cuts, table, n, lambda: weighted_edges(edges, dedupe, salt_edges, self_rows=keep, placement=placement, n=n))
        return _rounds(cuts, weights, iterations, keep, reset, damping, checkpoint_every)
    finally:
        # Only the catalog entry: the files stay for a run of the same name.
        spark.sql(f"drop table if exists {table}")


def bucketed_edges(spark: SparkSession, cuts: TableCuts, table: str, n: int, make) -> DataFrame:
    """The weighted edges as a table of ``n`` buckets sorted on ``(src, salt)``, written if the folder has none yet.

    Dealt like its buckets before it is written, so that every bucket is one file.
    """
    path = f"{cuts.root}/edges"
    if not is_complete(spark, path):
        made = make()
        made.repartition(n, "src", "salt").write.mode("overwrite").option("path", path).format("parquet").bucketBy(
            n, "src", "salt").sortBy("src", "salt").saveAsTable(table)
    else:
        fields = spark.read.parquet(path).schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"create table {table} ({columns}) using parquet clustered by (src, salt) sorted by (src, salt) "
                  f"into {n} buckets location '{path}'")
    return spark.table(table)


def _rounds(cuts: TableCuts, weights: DataFrame, iterations: int, keep: bool, reset: float, damping: float,
            checkpoint_every: int) -> DataFrame:
    # Start ranks from the written weight table, so the edge input is
    # evaluated once: every vertex (keep) or every source (drop) at 1.0.
    if keep:
        start = weights.where("is_self").select(F.col("src").alias("id"), F.col("dst_salts").alias("salts"))
    else:
        start = weights.select(F.col("src").alias("id"), F.col("src_salts").alias("salts")).distinct()
    ranks = start.select("id", F.lit(INITIAL_RANK).alias("rank"), "salts")

    # The start ranks are derived from the written edges (cheap to redo),
    # so round 1 reads them directly; every later round reads a written table.
    kind = {f.name: f.dataType.simpleString() for f in weights.schema.fields}
    done = max((i for i in range(1, iterations + 1) if is_complete(cuts.spark, f"{cuts.root}/ranks-{i}")), default=0)
    if done:
        ranks = cuts.spark.read.schema(f"id {kind['src']}, rank double, salts int").parquet(f"{cuts.root}/ranks-{done}")
        cuts.paths.append(f"{cuts.root}/ranks-{done}")
    for i in range(done + 1, iterations + 1):
        sent = ranks.select("id", "rank", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        # The ranks of a part are hashed: neither they nor its edges, which are many more, are sorted each round.
        joined = weights.join(sent.hint("shuffle_hash"), (weights.src == sent.id) & (weights.salt == sent.salt))
        msg = F.when(~F.col("is_self"), F.col("rank") * F.col("weight"))
        upd = F.lit(reset) + F.lit(damping) * F.col("c")
        if keep:
            nxt = joined.groupBy("dst").agg(
                F.sum(msg).alias("c"),
                F.max(F.when(F.col("is_self"), F.col("rank"))).alias("old"),
                F.max("dst_salts").alias("salts"),
            ).select(F.col("dst").alias("id"), F.coalesce(upd, F.col("old")).alias("rank"), "salts")
        else:
            nxt = joined.groupBy("dst").agg(F.sum(msg).alias("c"), F.max("dst_salts").alias("salts")).select(
                F.col("dst").alias("id"), upd.alias("rank"), "salts"
            )
        if i % checkpoint_every == 0 or i == iterations:
            ranks = cuts.cut(nxt, f"ranks-{i}")
            cuts.drop_all_but_last()
        else:
            ranks = nxt
    return ranks.select("id", "rank")
