"""Components, hubs and cycles against plain walks over small graphs."""

import random

import numpy as np
import pytest

from finsieve.operators import graph as gr


def ledger(spark, rows):
    return spark.createDataFrame(rows, "account string, counterparty string, ts timestamp")


def graph(spark, pairs):
    return gr.edges(spark.createDataFrame(pairs, "account string, counterparty string"))


def plain_components(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(up)}


def test_random_components(spark):
    rng = random.Random(2)
    pairs = [(f"n{rng.randrange(400)}", f"n{rng.randrange(400)}") for _ in range(230)] + [("self", "self"), ("n1", "n1"), (None, "n2")]
    got = gr.components(graph(spark, pairs)).collect()
    want = plain_components([p for p in pairs if None not in p])
    assert {r.account: r.component for r in got} == want and len(got) == len(want)
    sizes = list(want.values())
    assert all(r.n_accounts == sizes.count(r.component) for r in got)
    assert gr.components(graph(spark, []).limit(0)).count() == 0


def test_path_takes_few_rounds(spark):
    """10,000 accounts in a row, numbered along it; the order of a round is not the accounts' own."""
    pairs = spark.range(9_999).selectExpr("format_string('%05d', id) as a", "format_string('%05d', id + 1) as b")
    roots, rounds = gr.contract(pairs)
    assert rounds <= 14
    assert roots.select("root").distinct().count() == 1 and roots.count() == 10_000


def test_hub_with_a_third_of_all_edges(spark):
    rng = random.Random(3)
    pairs = [("hub", f"l{k}") for k in range(500)] + [(f"x{rng.randrange(3000)}", f"x{rng.randrange(3000)}") for _ in range(1000)]
    got = {r.account: r.component for r in gr.components(graph(spark, pairs)).collect()}
    assert got == plain_components(pairs)


def test_hub_scores(spark):
    """The dense solution, with accounts that pay nobody, several payments on an edge, and one to itself."""
    rng = random.Random(5)
    pairs = [(f"a{rng.randrange(20)}", f"a{rng.randrange(30)}") for _ in range(90)] + [("a3", "a3"), ("hub", "a1")] + [(f"a{k}", "hub") for k in range(18)]
    names = sorted({x for p in pairs for x in p})
    at = {x: i for i, x in enumerate(names)}
    m = np.zeros((len(names),) * 2)
    for a, b in pairs:
        m[at[b], at[a]] += 1
    out = m.sum(0)
    m = np.where(out > 0, m / np.where(out > 0, out, 1), 1 / len(names))
    want = np.linalg.solve(np.eye(len(names)) - 0.85 * m, np.full(len(names), 0.15 / len(names)))
    got = {r.account: r.hub_score for r in gr.hubs(graph(spark, pairs), tolerance=1e-10).collect()}
    assert np.allclose([got[x] for x in names], want, atol=1e-9) and abs(sum(got.values()) - 1) < 1e-9
    with pytest.raises(gr.NotConvergedError):
        gr.hubs(graph(spark, pairs), most_rounds=2)
    assert gr.hubs(graph(spark, pairs).limit(0)).count() == 0


def plain_cycles(rows, hops, within):
    at = {}
    for a, b, t in rows:
        if a != b:
            at.setdefault((a, b), []).append(t)
    out = {}
    for (a, b), times in at.items():
        others = [(a, b)] if hops == 2 else [(a, b, c) for (x, c) in at if x == b and c != a]
        for ring in others:
            for t in times:
                now = t
                for i in range(1, hops):
                    later = [u for u in at.get((ring[i], ring[(i + 1) % hops]), []) if u > now]
                    now = min(later) if later else None
                    if now is None:
                        break
                if now is not None and now - t <= within:
                    n, first, fast = out.get(ring, (0, t, now - t))
                    out[ring] = (n + 1, min(first, t), min(fast, now - t))
    return out


@pytest.mark.parametrize("hops", [2, 3])
def test_cycles(spark, hops):
    """A hub that pays and is paid by everybody, ties in time, payments to oneself, and a window that parts slices."""
    rng = random.Random(hops)
    names = [f"a{k}" for k in range(9)] + ["hub"] * 5
    rows = [(rng.choice(names), rng.choice(names), 1_700_000_000 + 3600 * rng.randrange(400)) for _ in range(500)]
    within = 20 * 3600
    frame = spark.createDataFrame(rows, "account string, counterparty string, s long").selectExpr("account", "counterparty", "timestamp_seconds(s) as ts")
    got = gr.cycles(frame, hops, within * 1_000_000).selectExpr("*", "unix_seconds(first_ts) as f", "fastest_us div 1000000 as q").collect()
    assert {tuple(r[f"p{i}"] for i in range(hops)): (r.n_cycles, r.f, r.q) for r in got} == plain_cycles(rows, hops, within)
    assert len(got) > 5
    with pytest.raises(ValueError):
        gr.cycles(frame, 4)


def test_pairs_are_formed_at_the_quiet_account(spark):
    """Two hubs that share all neighbours: wedges stay linear in the edges, not square in a hub's neighbours."""
    n = 400
    pairs = spark.createDataFrame([(f"q{k}", "h1") for k in range(n)] + [("h2", f"q{k}") for k in range(n)] + [("h1", "h2")], "s string, t string")
    assert gr._rings3(pairs).count() == 3 * n
