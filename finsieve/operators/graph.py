"""The payment graph as tables: components by contraction, hubs by power iteration, short cycles in time.

Every round is written to the shared folder and read back, so lineage stays short and a lost executor costs a
re-read. A busy account is never gathered: its edges are aggregated map-side before they move, joins on it
are sort-merge joins that Spark may split, and where pairs of neighbours are formed the account with fewer
neighbours forms them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from finsieve.operators.rolling import HOUR
from finsieve.session import stage, stage_counted


def edges(df: DataFrame, source: str = "account", target: str = "counterparty") -> DataFrame:
    """(s, t, n): distinct payment edges with their numbers of payments; rows without either account are no edge."""
    return df.select(F.col(source).alias("s"), F.col(target).alias("t")).dropna().groupBy("s", "t").agg(F.count(F.lit(1)).alias("n"))


def _rank(node: str, turn: int) -> Column:
    """An order of nodes that differs from round to round, so that no numbering of accounts is a bad one."""
    return F.struct(F.xxhash64(F.lit(turn), F.col(node)).alias("h"), F.col(node).alias("x"))


def _hooked(pairs: DataFrame, turn: int) -> DataFrame:
    """(x, up) for every node of ``pairs``(a, b): the root of the tree that comes of hooking each node to its lowest neighbour, if lower."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min(_rank("b", turn)).alias("low"))
    up = F.when(F.col("low") < _rank("a", turn), F.col("low.x")).otherwise(F.col("a"))
    tree = stage(low.select(F.col("a").alias("x"), up.alias("up")), "hooks")
    while True:
        above = tree.select(F.col("x").alias("up"), F.col("up").alias("top"))
        step = stage(tree.join(above.hint("merge"), "up").select("x", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "hooks")
        tree = step.select("x", "up")
        if not step.filter("moved").limit(1).count():
            return tree


def contract(pairs: DataFrame) -> tuple[DataFrame, int]:
    """((x, root), rounds) for every node of ``pairs``(a, b), with one root for each connected component.

    Each round hooks nodes to lower neighbours by a fresh order, merges every tree into its root, and keeps the
    edges between different roots. At least about half of the nodes go, so rounds are logarithmic in number.
    The rounds' maps shrink likewise and are composed from the last one back.
    """
    left, n = stage_counted(pairs.filter("a <> b").distinct(), "edges")
    maps = []
    while n:
        tree = _hooked(left, len(maps))
        maps.append(tree)
        for end in ("a", "b"):
            at = tree.select(F.col("x").alias(end), F.col("up").alias("_up")).hint("merge")
            left = left.join(at, end).drop(end).withColumnRenamed("_up", end)
        left = left.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        left, n = stage_counted(left, "edges")
    if not maps:
        return left.select(F.col("a").alias("x"), F.col("b").alias("root")), 0
    roots = maps[-1].withColumnRenamed("up", "root")
    for tree in reversed(maps[:-1]):
        above = roots.withColumnRenamed("x", "up")
        # What became a root without neighbours in other trees has no row above.
        roots = stage(tree.join(above.hint("merge"), "up", "left").select("x", F.coalesce("root", "up").alias("root")), "roots")
    return roots, len(maps)


def components(graph: DataFrame) -> DataFrame:
    """(account, component, n_accounts) for every account of ``edges``; a component's name is its smallest account."""
    roots, _ = contract(graph.select(F.col("s").alias("a"), F.col("t").alias("b")))
    nodes = graph.select(F.explode(F.array("s", "t")).alias("account")).distinct()
    named = stage(
        nodes.join(roots.withColumnRenamed("x", "account").hint("merge"), "account", "left")
        .select("account", F.coalesce("root", "account").alias("root")), "named",
    )
    names = named.groupBy("root").agg(F.min("account").alias("component"), F.count(F.lit(1)).alias("n_accounts"))
    return named.join(names.hint("merge"), "root").select("account", "component", "n_accounts")


class NotConvergedError(ArithmeticError):
    """A power iteration did not reach its tolerance within the rounds it was given."""


def hubs(graph: DataFrame, damping: float = 0.85, tolerance: float = 1e-9, most_rounds: int = 500) -> DataFrame:
    """(account, hub_score): the stationary share of a walk along payments that restarts anywhere with 1 - ``damping``.

    A payment is as likely as any other of its sender; the mass of accounts that pay nobody is spread over all. It
    stops when the scores of a round differ from those before by ``tolerance`` in sum.
    """
    out = graph.groupBy("s").agg(F.sum("n").alias("out"))
    shares = stage(graph.join(out.hint("merge"), "s").select("s", "t", (F.col("n") / F.col("out")).alias("p")), "shares")
    nodes = graph.select(F.explode(F.array("s", "t")).alias("account")).distinct()
    nodes, many = stage_counted(
        nodes.join(out.select(F.col("s").alias("account"), F.lit(False).alias("sink")).hint("merge"), "account", "left")
        .select("account", F.coalesce("sink", F.lit(True)).alias("sink")), "nodes",
    )
    if not many:
        return nodes.select("account", F.lit(0.0).alias("hub_score"))
    scores, lost = nodes.withColumn("r", F.lit(1.0 / many)), None
    for _ in range(most_rounds):
        if lost is None:
            lost = scores.agg(F.sum(F.when(F.col("sink"), F.col("r")).otherwise(0.0))).first()[0]
        given = shares.join(scores.select(F.col("account").alias("s"), "r"), "s").groupBy(F.col("t").alias("account")).agg(
            F.sum(F.col("p") * F.col("r")).alias("g")
        )
        base = (1.0 - damping) / many + damping * lost / many
        new = F.lit(base) + F.lit(damping) * F.coalesce("g", F.lit(0.0))
        scores = stage(scores.join(given, "account", "left").select("account", "sink", new.alias("r"), F.abs(new - F.col("r")).alias("moved")), "scores")
        moved, lost = scores.agg(F.sum("moved"), F.sum(F.when(F.col("sink"), F.col("r")).otherwise(0.0))).first()
        if moved <= tolerance:
            return scores.select("account", F.col("r").alias("hub_score"))
        scores = scores.drop("moved")
    raise NotConvergedError(f"scores still move by {moved} after {most_rounds} rounds")


def _rings2(pairs: DataFrame) -> DataFrame:
    """Directed rings of two as (p0, p1), one for each account that may start."""
    back = pairs.select(F.col("s").alias("t"), F.col("t").alias("s"))
    return pairs.join(back.hint("merge"), ["s", "t"]).select(F.col("s").alias("p0"), F.col("t").alias("p1"))


def _rings3(pairs: DataFrame) -> DataFrame:
    """Directed rings of three as (p0, p1, p2), one for each account that may start.

    The account with fewest neighbours of the three joins the other two, so however many neighbours a hub
    has, at most the square root of all edges are paired at one account.
    """
    lo, hi = F.least("s", "t"), F.greatest("s", "t")
    lines = stage(pairs.groupBy(lo.alias("lo"), hi.alias("hi")).agg(
        F.bool_or(F.col("s") < F.col("t")).alias("up"), F.bool_or(F.col("s") > F.col("t")).alias("down")), "lines")
    degree = lines.select(F.explode(F.array("lo", "hi")).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("d"))
    both = lines.join(degree.select(F.col("x").alias("lo"), F.col("d").alias("dl")).hint("merge"), "lo").join(
        degree.select(F.col("x").alias("hi"), F.col("d").alias("dh")).hint("merge"), "hi")
    first = F.struct("dl", "lo") < F.struct("dh", "hi")
    turned = stage(both.select(
        F.when(first, F.col("lo")).otherwise(F.col("hi")).alias("u"), F.when(first, F.col("hi")).otherwise(F.col("lo")).alias("v"),
        F.when(first, F.col("up")).otherwise(F.col("down")).alias("uv"), F.when(first, F.col("down")).otherwise(F.col("up")).alias("vu"),
    ), "turned")
    other = turned.select("u", F.col("v").alias("w"), F.col("uv").alias("uw"), F.col("vu").alias("wu"))
    wedges = turned.join(other.hint("merge"), "u").filter("v < w and ((uv and wu) or (uw and vu))")
    closed = wedges.join(lines.select(F.col("lo").alias("v"), F.col("hi").alias("w"), "up", "down").hint("merge"), ["v", "w"])
    ring = lambda ok, a, b, c: F.when(ok, F.array(*[
        F.struct(F.col(x).alias("p0"), F.col(y).alias("p1"), F.col(z).alias("p2")) for x, y, z in ((a, b, c), (b, c, a), (c, a, b))]))
    rings = F.array(ring(F.expr("uv and up and wu"), "u", "v", "w"), ring(F.expr("uw and down and vu"), "u", "w", "v"))
    return closed.select(F.explode(F.flatten(F.filter(rings, lambda r: r.isNotNull()))).alias("r")).select("r.*")


def cycles(df: DataFrame, hops: int, within: int = 168 * HOUR, source: str = "account", target: str = "counterparty") -> DataFrame:
    """(p0, p1[, p2], n_cycles, first_ts, fastest_us): rings of payments in time order, one row for each ring and starting account.

    A payment p0 to p1 starts a cycle when the earliest later payment p1 to p2, and so on, comes back to p0
    within ``within`` microseconds after it; payments of one instant do not follow each other. ``n_cycles``
    counts starting payments, ``fastest_us`` is the shortest time from start to return. Payments are reduced to one
    row per edge and instant first. Rows go to (ring, time slice), each also to the slice before, so
    a ring is spread over its time and a task holds the distinct instants of three edges in two slices.
    """
    if hops not in (2, 3):
        raise ValueError("rings have 2 or 3 hops")
    paid = df.select(F.col(source).alias("s"), F.col(target).alias("t"), F.unix_micros("ts").alias("at")).dropna().filter("s <> t")
    instants = stage(paid.groupBy("s", "t", "at").agg(F.count(F.lit(1)).alias("n")), "instants")
    pairs = instants.select("s", "t").distinct()
    # An account on a ring both pays and is paid.
    pairs = pairs.join(pairs.select(F.col("t").alias("s")).distinct().hint("merge"), "s", "left_semi").join(
        pairs.select(F.col("s").alias("t")).distinct().hint("merge"), "t", "left_semi")
    rings = stage((_rings2 if hops == 2 else _rings3)(stage(pairs, "pairs")), "rings")
    names = [f"p{i}" for i in range(hops)]
    steps = F.array(*[F.struct(F.lit(i).alias("hop"), F.col(names[i]).alias("s"), F.col(names[(i + 1) % hops]).alias("t")) for i in range(hops)])
    legs = rings.select(*names, F.explode(steps).alias("e")).select(*names, "e.*")
    rows = legs.join(instants.hint("merge"), ["s", "t"]).withColumn("home", F.floor(F.col("at") / within))
    # A later leg is also seen by starts of the slice before.
    seen = F.when(F.col("hop") == 0, F.array("home")).otherwise(F.array("home", F.col("home") - 1))
    rows = rows.withColumn("slice", F.explode(seen))
    # In falling time, what lies strictly later is a running frame.
    later = Window.partitionBy(*names, "slice").orderBy(F.col("back")).rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("back", -F.col("at")).withColumn("end", F.when(F.col("hop") == hops - 1, F.col("at")))
    for hop in range(hops - 2, -1, -1):
        rows = rows.withColumn("end", F.when(F.col("hop") == hop, F.min(F.when(F.col("hop") == hop + 1, F.col("end"))).over(later)).otherwise(F.col("end")))
    done = rows.filter(f"hop = 0 and end - at <= {within}")
    return done.groupBy(*names).agg(
        F.sum("n").alias("n_cycles"), F.timestamp_micros(F.min("at")).alias("first_ts"), F.min(F.col("end") - F.col("at")).alias("fastest_us")
    )
