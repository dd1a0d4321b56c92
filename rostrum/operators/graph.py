"""Graphs: components, weighted edges, PageRank, betweenness, ancestors."""

from __future__ import annotations

from collections import deque
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import cut


def components(nodes: DataFrame, edges: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(key..., node, component): the connected component of each node, named by its smallest node.

    nodes(key..., node), edges(key..., a, b). Large star and small star alternate (Kiryati, Vassilvitskii and others, "Connected components in MapReduce and beyond"), so that the number of rounds grows with the logarithm of the diameter; each round is written to the shared folder. Nodes without edges are their own component. Edges with a null end, and loops, connect nothing.
    """
    key = key or []

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(*key, F.col("u"), F.col("v")).unionByName(e.select(*key, F.col("v").alias("u"), F.col("u").alias("v"))) if large else e.select(*key, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy(*key, "u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = both.join(least, [*key, "u"])
        if large:
            out = joined.where(F.col("v") > F.col("u")).select(*key, F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(*key, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select(*key, "u", F.col("m").alias("v")))
        return out.where(F.col("u") != F.col("v")).distinct()

    e = cut(edges.where(F.col("a") != F.col("b")).select(*key, F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        e = cut(star(cut(star(e, True)), False))
        now = e.agg(F.count("*"), F.sum(F.xxhash64(*key, "u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return nodes.select(*key, "node").distinct().join(e.withColumnRenamed("u", "node"), [*key, "node"], "left").select(*key, "node", F.coalesce("v", "node").alias("component"))


def ranked_components(found: DataFrame, key: list[str]) -> DataFrame:
    """(key..., node, bloc_index): components by size, the largest first; among equal ones that with the smallest node."""
    sizes = found.groupBy(*key, "component").agg(F.count("*").alias("n"))
    order = W.partitionBy(*key).orderBy(F.col("n").desc(), F.col("component"))
    return found.join(sizes.withColumn("bloc_index", F.row_number().over(order) - 1), [*key, "component"]).select(*key, "node", "bloc_index")


def edge_weights(pairs: DataFrame, key: list[str], least: int = 1) -> DataFrame:
    """(key..., a, b, weight): how often each pair comes, where that is `least` times or more."""
    return pairs.groupBy(*key, "a", "b").agg(F.count("*").alias("weight")).where(F.col("weight") >= least)


def pagerank_rounds(edges: DataFrame, key: list[str], rounds: int = 20, damping: float = 0.85) -> DataFrame:
    """(key..., node, rank): weighted PageRank of undirected edges(key..., a, b, weight) after a fixed number of rounds, as joins; for graphs of any size. Every node has an edge here, so no rank is lost."""
    both = cut(edges.select(*key, F.col("a").alias("u"), F.col("b").alias("v"), "weight").unionByName(edges.select(*key, F.col("b").alias("u"), F.col("a").alias("v"), "weight")))
    degree = both.groupBy(*key, "u").agg(F.sum("weight").alias("out"))
    share = cut(both.join(degree, [*key, "u"]).select(*key, "u", "v", (F.col("weight") / F.col("out")).alias("p")))
    rank = degree.select(*key, F.col("u").alias("node"))
    n = cut(rank.groupBy(*key).agg(F.count("*").alias("n")))
    rank = cut(rank.join(n, key).select(*key, "node", "n", (1 / F.col("n")).alias("rank")))
    for k in range(rounds):
        flow = share.join(rank.select(*key, F.col("node").alias("u"), "rank", "n"), [*key, "u"])
        rank = flow.groupBy(*key, F.col("v").alias("node")).agg(F.first("n").alias("n"), F.sum(F.col("p") * F.col("rank")).alias("in")).select(*key, "node", "n", ((1 - damping) / F.col("n") + damping * F.col("in")).alias("rank"))
        if k % 5 == 4:
            rank = cut(rank)
    return rank.select(*key, "node", "rank")


def _pagerank(nodes: list, weight: dict, damping: float, tolerance: float, most: int) -> np.ndarray:
    n = len(nodes)
    at = {x: k for k, x in enumerate(nodes)}
    m = np.zeros((n, n))
    for (a, b), w in weight.items():
        m[at[b], at[a]] += w
        m[at[a], at[b]] += w
    out = m.sum(axis=0)
    dangling = out == 0
    m = m / np.where(dangling, 1.0, out)
    r = np.full(n, 1.0 / n)
    for _ in range(most):
        new = (1 - damping) / n + damping * (m @ r + r[dangling].sum() / n)
        if np.abs(new - r).sum() < tolerance:
            return new
        r = new
    return r


def _betweenness(nodes: list, neighbours: dict) -> dict:
    """Share of the shortest paths of all pairs that pass a node; edges count one."""
    n = len(nodes)
    total = dict.fromkeys(nodes, 0.0)
    for source in nodes:
        level, paths, order = {source: 0}, {source: 1.0}, []
        waiting = deque([source])
        while waiting:
            v = waiting.popleft()
            order.append(v)
            for w in neighbours.get(v, ()):
                if w not in level:
                    level[w] = level[v] + 1
                    paths[w] = 0.0
                    waiting.append(w)
                if level[w] == level[v] + 1:
                    paths[w] += paths[v]
        owed = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for v in neighbours.get(w, ()):
                if level.get(v) == level[w] - 1:
                    owed[v] += paths[v] / paths[w] * (1 + owed[w])
            if w != source:
                total[w] += owed[w]
    scale = 1 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    return {v: x * scale for v, x in total.items()}


def network_stats(edges: DataFrame, nodes: DataFrame | None = None, period: str = "yr", damping: float = 0.85, tolerance: float = 1e-7, most: int = 200) -> DataFrame:
    """(period, node, pagerank, betweenness, n_edges) of each period's graph of states. edges(period, a, b, weight), nodes(period, node) adds isolated ones. One task holds one period's graph, whose nodes are states (about 200). Periods with fewer than two nodes or without edges give nothing."""
    kind = edges.schema["a"].dataType.simpleString()
    when = edges.schema[period].dataType.simpleString()
    rows = edges.select(period, "a", "b", F.col("weight").cast("double"))
    if nodes is not None:
        rows = rows.unionByName(nodes.select(period, F.col("node").alias("a"), F.lit(None).cast(kind).alias("b"), F.lit(0.0).alias("weight")))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        linked = pdf[pdf["b"].notna()]
        members = sorted({*pdf["a"].tolist(), *linked["b"].tolist()})
        if len(members) < 2 or linked.empty:
            return pd.DataFrame({period: [], "node": [], "pagerank": [], "betweenness": [], "n_edges": []}).astype({"n_edges": "int64"})
        weight = {(a, b): w for a, b, w in zip(linked["a"], linked["b"], linked["weight"])}
        neighbours: dict = {}
        for a, b in weight:
            neighbours.setdefault(a, set()).add(b)
            neighbours.setdefault(b, set()).add(a)
        between = _betweenness(members, neighbours)
        return pd.DataFrame({period: pdf[period].iloc[0], "node": members, "pagerank": _pagerank(members, weight, damping, tolerance, most), "betweenness": [between[v] for v in members], "n_edges": [len(neighbours.get(v, ())) for v in members]})

    return rows.groupBy(period).applyInPandas(one, f"{period} {when}, node {kind}, pagerank double, betweenness double, n_edges long")


def climb(triples: DataFrame, schemes: DataFrame, most: int = 20) -> DataFrame:
    """(concept, scheme, steps): the scheme that each concept is in, or that its nearest ancestor is in. triples(concept, broader), schemes(concept, scheme). Cycles end after `most` steps."""
    start = triples.select("concept").unionByName(schemes.select("concept")).distinct()
    at = start.select("concept", F.col("concept").alias("place"), F.lit(0).alias("steps"))
    found = []
    for k in range(most + 1):
        hit = at.join(schemes.select(F.col("concept").alias("place"), "scheme"), "place").groupBy("concept", "steps").agg(F.min("scheme").alias("scheme"))
        found.append(cut(hit.select("concept", "scheme", "steps")))
        rest = at.join(found[-1].select("concept").distinct(), "concept", "left_anti")
        at = cut(rest.join(triples.select(F.col("concept").alias("place"), "broader"), "place").select("concept", F.col("broader").alias("place"), F.lit(k + 1).alias("steps")).distinct())
        if at.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)
