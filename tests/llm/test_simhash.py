import random

import numpy as np

from plover.llm import queries
from plover.llm.simhash import drop_near_duplicates, fingerprint_of, near_duplicate_classes, fingerprint_links
from tests.llm import brute


def test_fingerprints_match_brute_force():
    rnd = random.Random(3)
    for n in (0, 1, 2, 3, 4, 50, 400):
        w = rnd.choices("the of and é x1 日本".split(), k=n)
        assert fingerprint_of([x.encode() for x in w]) == brute.simhash(" ".join(w))


def linked(spark, values):
    signed = [(int(np.uint64(v).view(np.int64)),) for v in set(values)]
    pairs = fingerprint_links(spark.createDataFrame(signed, "fp long")).collect()
    label = {v: v for v in set(values)}
    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for s, d in pairs:
        s, d = (int(np.int64(x).view(np.uint64)) for x in (s, d))
        assert (s ^ d).bit_count() <= 16
        label[root(s)] = root(d)
    out = {}
    for v in set(values):
        out.setdefault(root(v), set()).add(v)
    return sorted(map(sorted, out.values()))


def grouped(values):
    values = sorted(set(values))
    label = brute.components(values, values)
    return sorted(sorted(v for v, l in zip(values, label) if l == k) for k in set(label))


def test_links_connect_exactly_the_close_fingerprints(spark):
    rnd = random.Random(5)
    seeds = [rnd.getrandbits(64) for _ in range(40)] + [0, 2 ** 64 - 1]
    values = set(seeds)
    for s in seeds:
        for _ in range(6):  # walks of 1 to 3 flipped bits
            for b in rnd.sample(range(64), rnd.choice((1, 2, 3))):
                s ^= 1 << b
            values.add(s)
    values |= {1 << b for b in range(64)} | {3 << b for b in range(62)}
    low = rnd.sample(range(1 << 16), 300)  # many fingerprints that share six blocks
    values |= {(7 << 40) | x for x in low}
    assert linked(spark, values) == grouped(values)


def test_edges(spark):
    rows = [(5, None), (4, ""), (9, " \n"), (2, "one"), (3, "One"), (3, "One"), (7, "a b c d e f g"), (6, "A B C D E F G"),
            (None, "a b c d e f g")]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, fp string, component int")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["component"]) for r in near_duplicate_classes(docs).collect())
    assert got == [(-1, 6), (2, 2), (3, 2), (3, 2), (4, 4), (5, 4), (6, 6), (7, 6), (9, 4)]
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 6]
    assert near_duplicate_classes(docs.limit(0)).count() == 0


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [brute.simhash(r["text"]) for r in docs]
    comp = brute.components([r["doc_id"] for r in docs], fps)
    got = sorted(tuple(r) for r in queries.op4_simhash_dedup(spark, sf).select("doc_id", "fingerprint", "component_id").collect())
    assert got == [(r["doc_id"], f"{f:016x}", c) for r, f, c in zip(docs, fps, comp)]
