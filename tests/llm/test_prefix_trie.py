import random
import zlib
from collections import defaultdict

import pytest

from plover.llm import prefix_trie as P
from plover.llm import queries
from plover.llm.common import stage
from tests.llm import brute

COLUMNS = [x.split()[0] for x in P.NODE.split(", ")]


def trie(sequences):
    """Rows of the trie over {conv_id: ((role, text), ...)}."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[:d - 1]].add(s[:d])
        ends[s].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node],
                   saved[node], brute.sha(",".join(map(str, sorted(ends[node]))))) for node, m in members.items())


def ordered(rows):
    """{conv_id: turns} in the operator's order."""
    def digest(role, text):
        import hashlib
        return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            out[c].append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    return {c: tuple(x for _, x in sorted(s)) for c, s in out.items()}


def made(seed, n=60):
    rnd = random.Random(seed)
    rows, texts = [], ["a", "bb", "ccc", "", "é🙂"]
    for c in range(n):
        k = rnd.choice((1, 2, 3, 5, 9, 14))
        same = rnd.random() < 0.4
        rows += [(c * 3 - 20, t, "user" if t % 2 else "assistant", "x" if same else rnd.choice(texts)) for t in range(k)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def got(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("segment, container", [(1024, 1 << 14), (3, 1 << 14), (4, 9), (1, 1)])
def test_nodes_equal_brute_force(spark, segment, container):
    rows = made(segment * 100 + container)
    rows += [(500, None, None, None), (500, None, "user", "b"), (500, 1, "user", "a"), (500, 1, "user", "a"), (None, 1, "user", "a")]
    assert got(P.conversation_trie(frame(spark, rows), segment, container)) == trie(ordered(rows))


def test_equal_long_conversations_and_a_wide_root(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(30) for t in range(40)] + [(100 + c, 0, "user", f"own {c}") for c in range(80)]
    assert got(P.conversation_trie(frame(spark, rows), 16, 50)) == trie(ordered(rows))


def test_conversations_without_turns(spark):
    turns = stage(P.turn_rows(frame(spark, [(1, 0, "user", "a"), (2, 0, "user", "a")])), "test")
    lengths = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, 0)], "conv_id long, n long")
    assert got(P.build_trie(turns, lengths)) == trie({1: (("user", "a"),), 2: (("user", "a"),), 3: (), 4: ()})


def test_no_rows_and_further_columns(spark):
    assert P.conversation_trie(frame(spark, [])).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "a" * 100_000, 5, "x")],
                                 "conv_id long, turn long, role string, text string, pos int, head string")
    assert got(P.conversation_trie(rows)) == trie({1: (("user", "a" * 100_000),)})


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    own = ordered([tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()])
    rebuilt = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, ())[:h] + s[h:]
    assert got(queries.op11_prefix_trie(spark, sf)) == trie(rebuilt)
