import tiktoken

import corpus_pipeline as P
from plover.llm import byte_bpe, decontaminate, pii, quality, queries, simhash
from plover.llm.common import stage
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = [], docs.columns
    for k, (name, f) in enumerate(P.STAGES):
        docs = stage(f(spark, docs, SF), f"test-{k}")
        assert k == 4 or docs.columns == columns, name
        kept.append({r["doc_id"]: r for r in docs.collect()})
    first, second, third, fourth, last = kept
    scored = quality.score_documents(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert set(first) == {r["doc_id"] for r in scored.collect() if r["accepted"]}
    ids = sorted(first)
    comp = brute.components(ids, [brute.simhash(first[i]["text"]) for i in ids])
    assert set(second) == set(comp) and len(second) < len(first)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(t in r["text"] for r in third.values() for t in items)
    assert len(third) <= len(second) and set(fourth) == set(third) == set(last)
    path, pattern = queries.tokenizer_files()
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(path)) if t}
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for i, r in fourth.items():
        assert r["n_chars"] == len(r["text"]) and last[i]["text"] == r["text"]
        assert last[i]["ids"] == enc.encode_ordinary(r["text"]) and last[i]["n_tokens"] == len(last[i]["ids"])


def test_stages_on_odd_rows(spark, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "word " * 30000, "en", "s", 9), (3, "ok", None, "s", 2)]
    for part in (rows, []):
        docs = spark.createDataFrame(part, "doc_id long, text string, lang string, source string, n_chars long")
        for k, (_, f) in enumerate(P.STAGES):
            docs = stage(f(spark, docs, str(tmp_path)), f"odd-{k}")
        assert docs.count() <= len(part)


def test_columns_with_the_operators_own_names_stay(spark):
    names = "row ids n_tokens pii cards matches decoded starts ends id t a w x s size item label score p_text _row _bad_id fp component".split()
    docs = spark.createDataFrame([(i, f"word{i} " * 40, "en", "s", 9, *names) for i in range(5)],
                                 "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{n} string" for n in names))
    for k, (name, f) in enumerate(P.STAGES):
        out = stage(f(spark, docs, SF), f"names-{k}")
        assert out.columns[:len(docs.columns)] == docs.columns, name
        got = out.collect()
        assert all(r[n] == n for r in got for n in names), name
        docs = docs if k == 0 else out
    assert {"ids_", "n_tokens_"} <= set(docs.columns) and docs.count() == 5


def test_a_run_leaves_one_table(spark, monkeypatch):
    import os
    from plover.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).removeprefix("file://")

    def ours():
        return {d for d in os.listdir(base) if d.startswith("plover-") and not d.startswith("plover-edges")}
    before = ours()
    monkeypatch.setattr(P, "STAGES", P.STAGES[1:3] + P.STAGES[4:])
    out = P.run(spark, SF)
    left = ours() - before
    assert len(left) == 1 and "pipeline-2" in left.pop() and out.count() > 0
