"""Approximate nearest neighbours by NN-descent (Dong, Moses, Li, 2011).

Every vector keeps its K best neighbours so far. A round joins each vector's
neighbours, forward and backward, with their vectors and compares them with each
other: neighbours of a vector are likely neighbours of one another. New neighbours
are compared, old pairs were before. Queries then search the graph greedily: the best
unexpanded vectors of a query's pool are expanded to their neighbours, round after
round, until every vector of nearly every pool is expanded; the best of the pool are
scored exactly. Each query scores only what its own pool leads to, so its work is bounded by
pool and links, however large the table. Vectors stay in cells, to which the queries
send what they reach; scores that cannot enter a pool are not sent back.

Nearness is the inner product. The graph lives in the space where each vector has one
coordinate more, so that all have the same length and the nearest by inner product is
the nearest by distance. The coordinate is worked out in double precision where it is
needed, so one vector much longer than the others does not blur these. Equal vectors
are one node; a node brings its smallest ids.

Each round is a table in the shared folder. A round's joins shuffle a bounded number of
rows per vector; a vector that very many others have as neighbour gets a sample of them,
which is drawn before rows are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowgate.llm.frames import drop_written, joined, read, written
from rowgate.llm.shingles import mixed

NEIGHBOURS = 30
# Neighbours of each kind (new or old, forward or backward) that a round compares.
SAMPLE = 8
# Rounds at most; fewer when a round changes less than this part of all neighbours.
ROUNDS, CHANGED = 5, 0.01
# Vectors around which the starting blocks are drawn, one for so many vectors and at
# most MOST_PIVOTS: a bounded sample of the table. So many times blocks are drawn.
PER_PIVOT, MOST_PIVOTS = 1024, 4096
STARTS = 6
# Vectors of a starting block that are compared with each other.
BLOCK = 2048
# Best unexpanded vectors of a pool expanded in the first search round, when most are drawn
# ones, and in later rounds; rounds at most, fewer when less than ``CHANGED`` of the pools have
# vectors left to expand; pool size.
FIRST, EXPANDED = 30, 240
SEARCHES = 12
POOL = 400
# Vectors of a cell, about, that are scored together for all queries that reach them.
CELL = 2048
# Vectors every query starts from besides its own: drawn ones, and the longest, which
# have large inner products with whatever points their way.
DRAWN, LONGEST = 768, 256
# Best of a pool that are scored exactly: three times what is returned.
SCORED = 60
TOP = 20
EVERY = 20

EDGES = "node long, other long, near float"


def runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Batches cut at changes of ``key``, of rows that are sorted by it."""
    rest = None
    for batch in batches:
        rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        ends = np.flatnonzero(np.diff(rest[key].to_numpy())) + 1
        if len(ends):
            yield rest.iloc[: ends[-1]]
            rest = rest.iloc[ends[-1] :]
    if rest is not None and len(rest):
        yield rest


def slices(frame: pd.DataFrame, key: str) -> Iterator[pd.DataFrame]:
    values = frame[key].to_numpy()
    bounds = [0, *(np.flatnonzero(np.diff(values)) + 1), len(values)]
    for i, j in zip(bounds[:-1], bounds[1:], strict=True):
        yield frame.iloc[i:j]


def matrix(column: pd.Series) -> np.ndarray:
    """The vectors of a column of single-precision bytes, all of one width, as doubles."""
    numbers = np.frombuffer(b"".join(column), np.float32)
    return numbers.reshape(len(column), -1 if len(column) else 0).astype(np.float64)


def nearness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minus the squared distances of lifted vectors; the longest has about length 1."""
    squares = [(x * x).sum(axis=1) for x in (a, b)]
    lifts = [np.sqrt(np.maximum(1.0 - x, 0.0)) for x in squares]
    apart = squares[0][:, None] + squares[1][None, :] - 2.0 * (a @ b.T)
    return -(np.maximum(apart, 0.0) + (lifts[0][:, None] - lifts[1][None, :]) ** 2)


def valid_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, values) without null, zero and non-finite vectors, one row per id.

    Of rows that share an id the smallest vector counts; a null id takes no part.
    """
    value = F.col(f"`{column}`").cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col(key).isNotNull() & value.isNotNull() & ~bad & F.exists(value, lambda x: x != 0)
    rows = vectors.filter(sound).select(F.col(key).cast("long").alias("vec_id"), value.alias("values"))
    return rows.groupBy("vec_id").agg(F.min("values").alias("values"))


def distinct_nodes(rows: DataFrame, most: int) -> DataFrame:
    """(node, vec, length, members): one row per distinct vector, with its ``most`` smallest ids.

    ``vec`` is in single precision, scaled so that the longest has length 1: it guides
    graph and search, while final scores come from the original vectors.
    """
    # Divided by the largest component first, so that no square is infinite.
    size = rows.agg(F.max(F.aggregate("values", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x))))).first()[0]
    square = F.aggregate("values", F.lit(0.0), lambda s, x: s + (x / size) * (x / size))
    top, width = rows.agg(F.max(square), F.max(F.size("values"))).first()

    def scaled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [np.pad(v / size / np.sqrt(top), (0, width - len(v))) for v in batch["values"]]
            yield batch[["node", "members"]].assign(
                vec=[v.astype(np.float32).tobytes() for v in out],
                length=[float(np.linalg.norm(v)) for v in out],
            )

    rank = F.row_number().over(W.partitionBy("values").orderBy("vec_id"))
    # The group limit keeps a vector shared by very many ids from being gathered.
    first = rows.withColumn("rank", rank).filter(F.col("rank") <= most)
    groups = first.groupBy("values").agg(
        F.min("vec_id").alias("node"), F.array_sort(F.collect_list("vec_id")).alias("members")
    )
    return groups.mapInPandas(scaled, "node long, members array<long>, vec binary, length double")


def best(edges: DataFrame, count: int = NEIGHBOURS) -> DataFrame:
    order = W.partitionBy("node").orderBy(F.desc("near"), "other")
    return edges.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= count
    ).drop("rank")


def top_edges(node: np.ndarray, other: np.ndarray, near: np.ndarray, count: int) -> pd.DataFrame:
    """The ``count`` nearest distinct others of each node."""
    order = np.lexsort((other, -near, node))
    node, other, near = node[order], other[order], near[order]
    fresh = np.ones(len(node), bool)
    fresh[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
    node, other, near = node[fresh], other[fresh], near[fresh]
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else node
    rank = np.arange(len(node)) - np.repeat(starts, np.diff([*starts, len(node)])) if len(node) else node
    kept = rank < count
    return pd.DataFrame({"node": node[kept], "other": other[kept], "near": near[kept].astype(np.float32)})


def starting_edges(nodes: DataFrame, total: int) -> DataFrame:
    """Nearest neighbours inside blocks of vectors that share the nearest pivot.

    A pivot's vectors are dealt by hash to blocks of about ``BLOCK``. The first time
    all vectors share one pivot, so blocks are random and link all regions.
    """
    usual = min(max(total // PER_PIVOT, 1), MOST_PIVOTS)
    counts = [1] + [usual] * (STARTS - 1)
    order = F.xxhash64("node", F.lit("pivot"))
    drawn = nodes.select("node", "vec").orderBy(order, "node").limit(sum(counts)).toPandas()
    pool = matrix(drawn["vec"])
    ends = np.cumsum(counts)
    centres = [
        pool[np.arange(end - count, end) % len(pool)] for count, end in zip(counts, ends, strict=True)
    ]

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = matrix(batch["vec"])
            for start, own in enumerate(centres):
                cell = start * MOST_PIVOTS + nearness(vectors, own).argmax(axis=1)
                yield batch.assign(cell=cell.astype(np.int32))

    cells = nodes.select("node", "vec").mapInPandas(placed, "node long, vec binary, cell int")
    sizes = written(cells.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("parts")), "cells")
    part = F.pmod(F.xxhash64("node", "cell"), F.col("parts"))
    cells = joined(cells, sizes, "cell").withColumn("block", F.xxhash64("cell", part))

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches, "block"):
            out = []
            for group in slices(run, "block"):
                ids, vectors = group["node"].to_numpy(), matrix(group["vec"])
                if len(ids) < 2:
                    continue
                near = nearness(vectors, vectors)
                np.fill_diagonal(near, -np.inf)
                count = min(NEIGHBOURS, len(ids) - 1)
                at = np.argpartition(-near, count - 1, axis=1)[:, :count]
                out.append(
                    pd.DataFrame(
                        {
                            "node": np.repeat(ids, count),
                            "other": ids[at.ravel()],
                            "near": np.take_along_axis(near, at, axis=1).ravel(),
                        }
                    )
                )
            if out:
                yield pd.concat(out)

    dealt = cells.select("node", "vec", "block").repartition("block").sortWithinPartitions("block")
    return dealt.mapInPandas(compared, EDGES)


def sampled(graph: DataFrame, round_no: int) -> DataFrame:
    """(node, other, fresh, forward) of the neighbours that a round compares; written."""
    both = graph.select("node", "other", "fresh", F.lit(True).alias("forward")).union(
        graph.select(F.col("other"), F.col("node"), "fresh", F.lit(False))
    )
    drawn = W.partitionBy("node", "fresh", "forward").orderBy(
        F.xxhash64("node", "other", F.lit(round_no))
    )
    ranked = both.withColumn("rank", F.row_number().over(drawn)).filter(F.col("rank") <= SAMPLE)
    return written(ranked.drop("rank"), "sample")


def local_join(graph: DataFrame, nodes: DataFrame, sample: DataFrame) -> DataFrame:
    """Better neighbours (node, other, near) found among neighbours of neighbours."""
    members = sample.groupBy("node", "other").agg(F.max("fresh").alias("fresh"))
    floors = graph.groupBy("node").agg(
        F.when(F.count("*") >= NEIGHBOURS, F.min("near")).otherwise(F.lit(-3.4e38)).alias("floor")
    )
    known = nodes.join(floors, "node", "left").select(
        F.col("node").alias("other"), "vec", F.coalesce("floor", F.lit(-3.4e38)).alias("floor")
    )
    rows = members.join(known, "other").repartition("node").sortWithinPartitions("node")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in runs(batches, "node"):
            found = []
            for group in slices(run, "node"):
                fresh = group["fresh"].to_numpy(bool)
                if not fresh.any() or len(group) < 2:
                    continue
                ids, floor = group["other"].to_numpy(), group["floor"].to_numpy()
                vectors = matrix(group["vec"])
                near = nearness(vectors, vectors)
                pairs = fresh[:, None] | fresh[None, :]
                pairs &= near > floor[:, None]
                pairs &= ids[:, None] != ids[None, :]
                a, b = np.nonzero(pairs)
                found.append((ids[a], ids[b], near[a, b]))
            if found:
                yield top_edges(*(np.concatenate(x) for x in zip(*found, strict=True)), NEIGHBOURS)

    return rows.select("node", "other", "fresh", "vec", "floor").mapInPandas(compared, EDGES)


def neighbour_graph(nodes: DataFrame) -> DataFrame:
    """(node, other, near, fresh): each node's nearest others, found by NN-descent."""
    total = nodes.count()
    once = starting_edges(nodes, total).groupBy("node", "other").agg(F.max("near").alias("near"))
    graph = written(best(once).withColumn("fresh", F.lit(True)), "graph")
    for round_no in range(ROUNDS):
        sample = sampled(graph, round_no)
        found = local_join(graph, nodes, sample).select("node", "other", "near", F.lit(True).alias("fresh"))
        # Only new neighbours that were compared are old from now on; those that the
        # sample left out stay new for the next rounds.
        used = sample.filter("fresh and forward").select("node", "other", F.lit(True).alias("used"))
        kept = graph.join(used, ["node", "other"], "left")
        kept = kept.select("node", "other", "near", (F.col("fresh") & F.col("used").isNull()).alias("fresh"), F.lit(False).alias("found"))
        both = kept.union(found.withColumn("found", F.lit(True))).groupBy("node", "other").agg(
            F.max("near").alias("near"), F.min("fresh").alias("fresh"), F.min("found").alias("found")
        )
        step = written(best(both), "graph")
        graph = step.drop("found")
        changes = step.agg(F.count_if("found"), F.count("*")).first()
        if changes[0] < CHANGED * changes[1]:
            break
    return graph


def cell_of(ids: np.ndarray, cells: int) -> np.ndarray:
    return (mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(cells)).astype(np.int32)


POOLS = "query long, vec binary, nodes array<long>, near array<double>, expanded array<boolean>, chosen array<long>"
ASKED = "cell int, query long, floor double, vec binary, nodes array<long>"
SCORES = "query long, nodes array<long>, near array<double>"


def pooled(node: np.ndarray, near: np.ndarray, expanded: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """The best ``POOL`` of a query's nodes, which are expanded, and at most ``most`` to expand now."""
    kept = np.lexsort((node, -near))[:POOL]
    node, near, expanded = node[kept], near[kept], expanded[kept]
    now = np.flatnonzero(~expanded)[:most]
    expanded[now] = True
    return node, near, expanded, node[now]


def first_pools(nodes: DataFrame, queries: DataFrame) -> DataFrame:
    """Pools of (query, home, vec) from ``home``, drawn and long vectors; written."""
    drawn = nodes.select("node", "vec").orderBy(F.xxhash64("node", F.lit("start")), "node").limit(DRAWN)
    longest = nodes.orderBy(F.desc("length"), "node").select("node", "vec").limit(LONGEST)
    starts = drawn.union(longest).toPandas().drop_duplicates("node")
    ids, vectors = starts["node"].to_numpy(np.int64), matrix(starts["vec"])

    def begun(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            own = matrix(batch["vec"])
            for query, home, vector, near in zip(batch["query"], batch["home"], own, own @ vectors.T, strict=True):
                others = ids != home
                node = np.append(ids[others], home)
                near = np.append(near[others], vector @ vector)
                out.append((query, *pooled(node, near, np.zeros(len(node), bool), FIRST)))
            found = pd.DataFrame(out, columns=["query", "nodes", "near", "expanded", "chosen"])
            found.insert(1, "vec", batch["vec"].to_numpy())
            yield found

    return written(queries.mapInPandas(begun, POOLS), "pool", "none")


def asked_of(pool: DataFrame, links: DataFrame, cells: int) -> DataFrame:
    """(cell, query, floor, vec, nodes): what each query reaches by its chosen nodes, a row
    per cell; ``floor`` is what a node needs to get into its pool."""
    chosen = pool.select("query", F.explode("chosen").alias("node"))
    reached = chosen.join(links.hint("merge"), "node").groupBy("query").agg(
        F.array_distinct(F.flatten(F.collect_list("others"))).alias("others")
    )
    floor = F.when(F.size("near") >= POOL, F.array_min("near")).otherwise(F.lit(float("-inf")))
    reached = pool.join(reached.hint("merge"), "query").select(
        "query", floor.alias("floor"), "vec", F.array_except("others", "nodes").alias("nodes")
    )

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for query, floor, vec, nodes in batch.itertuples(index=False):
                nodes = np.asarray(nodes, np.int64)
                cell = cell_of(nodes, cells)
                order = np.argsort(cell, kind="stable")
                cell, nodes = cell[order], nodes[order]
                bounds = np.flatnonzero(np.diff(cell)) + 1
                for own, part in zip(np.split(cell, bounds), np.split(nodes, bounds), strict=True):
                    if len(own):
                        out.append((own[0], query, floor, vec, part))
            yield pd.DataFrame(out, columns=["cell", "query", "floor", "vec", "nodes"])

    return reached.mapInPandas(dealt, ASKED)


def scored(asked: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query, nodes, near) of the asked nodes that reach the floor. A cell's vectors meet
    all that ask for them: vectors travel once a round, queries once a cell."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, ids, held, place, table = None, [], [], None, None
        for batch in batches:
            out = []
            for cell, query, floor, vec, nodes in batch.itertuples(index=False):
                if cell != at:
                    at, ids, held, table = cell, [], [], None
                if pd.isna(query):
                    ids.append(nodes[0])
                    held.append(vec)
                    continue
                if table is None:
                    place = np.argsort(ids)
                    ids, table = np.array(ids, np.int64)[place], matrix(pd.Series(held))[place]
                near = table[np.searchsorted(ids, nodes)] @ np.frombuffer(vec, np.float32).astype(np.float64)
                good = near >= floor
                if good.any():
                    out.append((int(query), nodes[good], near[good]))
            yield pd.DataFrame(out, columns=["query", "nodes", "near"])

    rows = vectors.union(asked).repartition("cell").sortWithinPartitions("cell", F.col("query").asc_nulls_first())
    return rows.mapInPandas(score, SCORES)


def advanced(pool: DataFrame, scores: DataFrame) -> DataFrame:
    """The pools after new nodes are scored; written."""
    new = scores.groupBy("query").agg(F.collect_list(F.struct("nodes", "near")).alias("new"))
    new = new.select("query", F.flatten("new.nodes").alias("new_nodes"), F.flatten("new.near").alias("new_near"))

    def advance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for nodes, near, expanded, more, its in zip(
                batch["nodes"], batch["near"], batch["expanded"], batch["new_nodes"], batch["new_near"], strict=True
            ):
                if more is not None:
                    nodes, near = np.append(nodes, more), np.append(near, its)
                    expanded = np.append(expanded, np.zeros(len(more), bool))
                out.append(pooled(np.array(nodes, np.int64), np.array(near), np.array(expanded, bool), EXPANDED))
            found = pd.DataFrame(out, columns=["nodes", "near", "expanded", "chosen"])
            yield pd.concat([batch[["query", "vec"]].reset_index(drop=True), found], axis=1)

    rows = pool.drop("chosen").join(new.hint("merge"), "query", "left")
    return written(rows.mapInPandas(advance, POOLS), "pool", "none")


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, node) of (query, home, vec): the best nodes found by each query's search."""
    backward = best(
        graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "near")
    )
    links = graph.select("node", "other").union(backward.select("node", "other"))
    links = written(links.groupBy("node").agg(F.collect_set("other").alias("others")), "adjacent")
    cells = nodes.count() // CELL + 1

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["node"].to_numpy(np.int64)
            yield pd.DataFrame({"cell": cell_of(ids, cells), "query": None, "floor": 0.0, "vec": batch["vec"], "nodes": [[i] for i in ids]})

    vectors = written(nodes.select("node", "vec").mapInPandas(placed, ASKED), "cells", "none")
    pool = first_pools(nodes, queries)
    for _ in range(SEARCHES):
        left = pool.agg(F.count_if(F.size("chosen") > 0), F.count("*")).first()
        if not left[0] or left[0] < CHANGED * left[1]:
            break
        step = advanced(pool, scored(asked_of(pool, links, cells), vectors))
        drop_written(pool)
        pool = step
    return pool.select("query", F.explode(F.slice("nodes", 1, SCORED)).alias("node"))


def nearest(
    vectors: DataFrame, is_query, top: int = TOP, key: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the vectors for which ``is_query`` holds.

    Null, zero and non-finite vectors, and null ids, take no part; a shorter vector is
    taken as filled up with zeros; ties go to the smaller id. Without two vectors there
    are no rows.
    """
    rows = written(valid_vectors(vectors, key, column), "vectors")
    spark = rows.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    if rows.limit(2).count() < 2:
        return spark.createDataFrame([], result)
    nodes = written(distinct_nodes(rows, top + 1), "nodes", "none")
    graph = neighbour_graph(nodes)
    members = nodes.select("node", F.explode("members").alias("vec_id"))
    homes = rows.filter(is_query).join(node_of(rows, nodes), "vec_id")
    asked = homes.select(F.col("vec_id").alias("query"), F.col("node").alias("home"))
    asked = asked.join(nodes.select(F.col("node").alias("home"), "vec"), "home").select("query", "home", "vec")
    asked = written(asked, "queries", "none")
    pools = search(graph, nodes, asked)
    found = pools.join(members, "node").filter("vec_id <> query").select("query", "vec_id")
    scored = found.join(rows, "vec_id").join(
        rows.select(F.col("vec_id").alias("query"), F.col("values").alias("asked")), "query"
    )
    product = F.aggregate(
        F.zip_with("values", "asked", lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x
    )
    scored = scored.select(F.col("query").alias("query_id"), "vec_id", product.alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def node_of(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(vec_id, node) of every id, also of those beyond a node's listed members."""
    first = nodes.select("node").join(rows.withColumnRenamed("vec_id", "node"), "node")
    return rows.join(first, "values").select("vec_id", "node")


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


QUERIES = {"op8_nn_descent": op8_nn_descent}
# A graph search is not expressible in SQL; tests measure recall against brute force.
SQL: dict[str, str] = {}
