"""Shortest paths with their nodes and edges, searched from both ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.sources.scratch import kept


def shortest_routes(edges: DataFrame, pairs: DataFrame, depth: int = 6, excluded: tuple[str, ...] = ()) -> DataFrame:
    """edges(src, dst, kind), pairs(src, dst): (src, dst, hops, nodes, kinds) of one shortest path per pair within depth, edges taken either way; of several the one whose nodes come first. kinds
    has the smallest kind between each two nodes; excluded kinds take no part. Pairs without a path are left out.

    Both ends grow in turn, and a level is a table: (pair, node) with its distance from that end. A pair whose ends meet grows no further, so a search reaches half the depth from each end
    instead of the whole from one. The path is put together by joins with these tables, level by level: from where the ends met back to the source, which leaves the nodes on shortest
    paths only, and then forward, by the first node of each next level.
    """
    used = edges.filter(~F.col("kind").isin(*excluded)) if excluded else edges
    both = used.select("src", "dst", "kind").unionByName(used.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "kind"))
    both = kept(both.filter("src <> dst").groupBy(F.col("src").alias("near"), F.col("dst").alias("far")).agg(F.min("kind").alias("kind")), "edges")
    wanted = pairs.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL").distinct()
    start = kept(wanted.select("src", "dst", F.col("src").alias("node"), F.lit(0).alias("level")), "forward")
    end = kept(wanted.select("src", "dst", F.col("dst").alias("node"), F.lit(0).alias("level")), "backward")
    key = ["src", "dst"]
    levels = {True: [start], False: [end]}
    met = kept(wanted.filter("src = dst").select("src", "dst", F.col("src").alias("node"), F.lit(0).alias("hops"), F.lit(0).alias("at")), "met")
    waiting = wanted.filter("src <> dst")
    for hop in range(1, depth + 1):
        forward = hop % 2 == 1
        side, other = levels[forward], levels[not forward]
        step = side[-1].join(waiting, key, "left_semi").join(both, F.col("node") == F.col("near")).select(*key, F.col("far").alias("node")).distinct()
        for past in side[-2:]:  # a neighbour of a level is on it, the one before or the one behind
            step = step.join(past.select(*key, "node"), [*key, "node"], "left_anti")
        side.append(kept(step.withColumn("level", F.lit(len(side))), "level"))
        touching = side[-1].join(other[-1].select(*key, "node"), [*key, "node"], "left_semi")
        now = kept(touching.select(*key, "node", F.lit(hop).alias("hops"), F.lit(len(levels[True]) - 1).alias("at")), "met")
        met = met.unionByName(now)
        waiting = kept(waiting.join(now.select(*key).distinct(), key, "left_anti"), "waiting")
        if waiting.isEmpty():
            break
    # Back from where the ends met: the nodes at each place of the source's half that lie on a shortest path.
    reach = len(levels[True]) - 1
    on_path = {}
    for at in range(reach, -1, -1):
        here = met.filter(F.col("at") == at).select(*key, "node", "hops")
        if at + 1 in on_path:
            before = on_path[at + 1].join(both, F.col("node") == F.col("near")).select(*key, F.col("far").alias("node"), "hops").join(levels[True][at].select(*key, "node"), [*key, "node"], "left_semi")
            here = here.unionByName(before)
        on_path[at] = kept(here.distinct(), "on-path")
    walk = on_path[0].select(*key, "hops", "node", F.array("node").alias("nodes"), F.array().cast("array<string>").alias("kinds"))
    for place in range(1, depth + 1):
        going = walk.filter(F.col("hops") >= place)
        # The source's half by what lies on a path; the other half by the distance that is left.
        ahead = on_path[place].select(*key, F.col("node").alias("far")) if place <= reach else None
        for left, level in enumerate(levels[False]):
            part = level.join(met.filter(F.col("hops") == place + left).filter(F.col("at") < place).select(*key).distinct(), key, "left_semi").select(*key, F.col("node").alias("far"))
            ahead = part if ahead is None else ahead.unionByName(part)
        steps = going.join(both, F.col("node") == F.col("near")).join(ahead.distinct(), [*key, "far"], "left_semi")
        best = steps.groupBy(*key).agg(F.min(F.struct("far", "kind", "hops", "nodes", "kinds")).alias("b"))
        moved = best.select(*key, "b.hops", F.col("b.far").alias("node"), F.concat("b.nodes", F.array("b.far")).alias("nodes"), F.concat("b.kinds", F.array("b.kind")).alias("kinds"))
        walk = kept(walk.filter(F.col("hops") < place).unionByName(moved), "walk")
        if place >= reach + len(levels[False]) - 1:
            break
    return walk.select(*key, "hops", "nodes", "kinds")
