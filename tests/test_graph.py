"""Identity graph on the shipped identity-chain fixture (chain mode) and small cases."""

from conftest import rows
from plover.operators import graph as G

LINES = [("13866778899", "刘德华", "wx_hz", "2000"), ("13877669988", "华仔", "wx_hz", "3000"),
         ("", "刘德华", "wx_ldh", "5000"), ("13912344321", "马德华", "wx_mdh", "12000"),
         ("13912344321", "二师兄", "wx_bj", "3500"), ("13912664321", "猪八戒", "wx_bj", "5600")]
COLS = ("phone", "name", "wechat", "amount")


def test_chain_mode_groups_lines(spark):
    df = spark.createDataFrame([(i + 1, *r) for i, r in enumerate(LINES)],
                               "line int, phone string, name string, wechat string, amount string")
    v = G.identity_vertices(df, COLS)
    e = G.identity_edges(df, COLS, mode="chain")
    comp = G.connected_components(v, e)
    labelled = dict(rows(G.label_rows(df, comp, COLS), "line", "guid"))
    assert labelled[1] == labelled[2] == labelled[3]
    assert labelled[4] == labelled[5] == labelled[6]
    assert labelled[1] != labelled[4]
    # the component label is the smallest id of the component
    assert labelled[4] == "12000"


def test_pairs_threshold_and_isolated(spark):
    df = spark.createDataFrame([("a", "d1")] * 3 + [("b", "d1")] * 2 + [("c", " ")], "account string, deviceid string")
    e = G.identity_edges(df, ("account", "deviceid"), "pairs", 2)
    assert rows(e) == [("a", "d1")]
    comp = dict(rows(G.connected_components(G.identity_vertices(df, ("account", "deviceid")), e)))
    assert comp == {"a": "a", "d1": "a", "b": "b", "c": "c"}


def test_long_path_converges(spark):
    n = 40
    e = spark.createDataFrame([(f"v{i:03d}", f"v{i + 1:03d}") for i in range(n)], "src string, dst string")
    v = spark.createDataFrame([(f"v{i:03d}",) for i in range(n + 1)], "id string")
    comp = rows(G.connected_components(v, e), "component")
    assert set(comp) == {("v000",)} and len(comp) == n + 1


def test_carry_over(spark):
    today = spark.createDataFrame([("x", "x"), ("y", "x"), ("z", "z")], "id string, guid string")
    prev = spark.createDataFrame([("y", "old2"), ("x", "old1")], "id string, guid string")
    assert rows(G.carry_over_guid(today, prev)) == [("x", "old1"), ("y", "old1"), ("z", "z")]


def test_components_match_union_find(spark):
    import random
    rnd = random.Random(3)
    n = 300
    ids = [f"n{i:04d}" for i in range(n)]
    edges = [(rnd.choice(ids), rnd.choice(ids)) for _ in range(220)]
    # a hub touching many vertices, as a shared device would
    edges += [("n0150", ids[i]) for i in range(0, n, 7)]
    parent = {x: x for x in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp_min = {}
    for x in ids:
        r = find(x)
        comp_min[r] = min(comp_min.get(r, x), x)
    expect = {x: comp_min[find(x)] for x in ids}
    v = spark.createDataFrame([(x,) for x in ids], "id string")
    e = spark.createDataFrame(edges, "src string, dst string")
    assert dict(rows(G.connected_components(v, e))) == expect


def _classes(vertices, edges):
    """Smallest member of every vertex's class, by plain propagation."""
    label = {x: x for x in vertices} | {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            for x in (a, b):
                if label[x] != low:
                    label[x], changed = low, True
    return label


def test_incremental_equals_components_of_everything(spark):
    import random
    for seed in range(3):
        rnd = random.Random(seed)
        ids = [f"n{i:03d}" for i in range(120)]
        old = [(rnd.choice(ids[:90]), rnd.choice(ids[:90])) for _ in range(50)]
        new = [(rnd.choice(ids[40:]), rnd.choice(ids[40:])) for _ in range(40)] + [("n050", "n050")]
        new_v = [x for e in new for x in e] + ["n118", "n119"]
        prev = _classes(ids[:90], old)
        got = dict(rows(G.incremental_components(
            spark.createDataFrame([(x,) for x in new_v], "id string"), spark.createDataFrame(new, "src string, dst string"),
            spark.createDataFrame(list(prev.items()), "id string, guid string"))))
        assert got == _classes([*ids[:90], *new_v], old + new)


def test_incremental_without_edges_or_labels(spark):
    v, none = spark.createDataFrame([("b",), ("z",)], "id string"), spark.createDataFrame([], "src string, dst string")
    prev = spark.createDataFrame([("b", "a"), ("a", "a")], "id string, guid string")
    assert rows(G.incremental_components(v, none, prev)) == [("a", "a"), ("b", "a"), ("z", "z")]
    e = spark.createDataFrame([("z", "b")], "src string, dst string")
    assert rows(G.incremental_components(v, e, prev.limit(0))) == [("b", "b"), ("z", "b")]


def test_a_round_is_one_write_and_rounds_are_few(spark, monkeypatch):
    n, written = 600, []
    real = G._written
    monkeypatch.setattr(G, "_written", lambda df, path: written.append(path) or real(df, path))
    e = spark.createDataFrame([(i, i + 1) for i in range(n)], "src long, dst long")
    got = G._stars(e)
    assert got.count() == n and {r["component"] for r in got.distinct().collect()} == {0}
    assert len(written) <= 10 + 2  # log2(600) rounds, one without change
