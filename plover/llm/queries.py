"""The registered queries: each applies one operator, with production
parameters, to its whole table, and derives the asked-for columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plover.llm import (byte_bpe, chat, decontaminate, hard_negatives, pii, prefix_trie, quality, secret_scan, simhash,
                        sketch, substring_dedup, token_counts, url_filter)
from plover.llm.common import stage, table, text_key
from plover.operators.joins import rekeyed

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
KEY_SETTING = "spark.plover.pii.key"  # a deployment sets its own secret


def tokenizer_files(name: str = RANK_FILE) -> tuple[str, str]:
    """Path of a public rank file and its splitting pattern."""
    import public_tokenizers
    return public_tokenizers.path(name), public_tokenizers.PATTERN


def pii_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, "synthetic-tables-only")


def _md5_int(c, first: int, digits: int):
    return F.conv(F.substring(F.md5(c), first, digits), 16, 10).cast("int")


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day in 2024, from the page id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(
        F.col("page_id") * 37, F.lit(366)).cast("int")).alias("fetched"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the pages' own hosts: hosts of two joined words are
    added, taken off and added again; of other hosts one in eight has its
    first path segment listed for a while, and one in 32 its parent domain."""
    host, part = url_filter.host_of("url"), F.regexp_extract(url_filter.path_of("url"), "^/([^/]+)", 1)
    seen = pages.select(host.alias("host"), part.alias("part")).filter("host <> ''").distinct()
    day = F.date_add(F.lit("2023-10-01").cast("date"), _md5_int("host", 1, 4) % 400)
    pairs = F.col("host").contains("-")
    draw = _md5_int("host", 9, 2)
    start = F.col("start")

    def entry(pattern, category, action, when):
        return F.struct(pattern.alias("pattern"), F.lit(category).alias("category"), F.lit(action).alias("action"),
                        when.alias("day"))

    segment, domain = F.concat("host", F.lit("/"), "part"), F.regexp_replace("host", r"^[^.]+\.", "")
    dated = F.when(pairs, F.array(
        entry(F.col("host"), "spam", "add", start), entry(F.col("host"), "spam", "remove", F.date_add(start, 45)),
        entry(F.col("host"), "spam", "add", F.date_add(start, 90)))) \
        .when((draw % 8 == 0) & (F.col("part") != ""), F.array(
            entry(segment, "path", "add", start), entry(segment, "path", "remove", F.date_add(start, 120)))) \
        .when(draw % 32 == 1, F.array(
            entry(domain, "domain", "add", start), entry(domain, "domain", "remove", F.date_add(start, 7))))
    return seen.withColumn("start", day).select(F.explode(dated).alias("e")).select("e.*").distinct()


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_captures(captures(pages), list_entries(pages))


def conversation_records(conversations: DataFrame) -> DataFrame:
    """One JSON record per conversation, in the layout that its turns fit: a
    question and its answer (with a system text) as one pair, else a list of
    messages, with other field names for odd ids."""
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    c = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("m"))
    roles = F.transform("m", lambda x: x["role"])

    def text(i):
        return F.col("m")[i]["text"]

    def messages(name, role, body):
        return F.to_json(F.struct(F.transform("m", lambda x: F.struct(
            x["role"].alias(role), x["text"].alias(body))).alias(name)))

    plain = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    payload = F.when(roles == F.array(F.lit("user"), F.lit("assistant")),
                     F.when(F.col("conv_id") % 2 == 0, F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
                     .otherwise(F.to_json(F.struct(text(0).alias("instruction"), text(1).alias("output"))))) \
        .when(roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")),
              F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("completion")))) \
        .when(plain & (F.col("conv_id") % 2 == 1), messages("conversations", "from", "value")) \
        .otherwise(messages("messages", "role", "content"))
    return c.select("conv_id", payload.alias("payload"))


PROBE = "\\### Assistant: </turn> ok"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    done = chat.read_back(chat.format_records(conversation_records(c.unionByName(probe))))
    turns = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))), "")
    return done.select("conv_id", F.size("roles").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_duplicate_spans(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicate_classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


RANGE_ROWS = 256  # rows of a range
MOST_RANGES = 1 << 20  # borders of 16 bytes that tasks get; with more rows, ranges have more of them


def _ranges(keys: DataFrame, rows: int):
    """Ids and text hashes of the first row of each range of about ``rows`` rows
    of ``keys`` (id, t), in order: two arrays."""
    import numpy as np
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # in its partition
    in_order = keys.repartitionByRange("id", "t").sortWithinPartitions("id", "t").withColumn("place", place)
    first = stage(in_order.filter(F.col("place") % rows == 0).select("id", "t"), "sketch-borders").distinct().toPandas()
    first = first.sort_values(["id", "t"])
    return first["id"].to_numpy(np.int64), first["t"].to_numpy(np.int64)


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text and next_text, that of the row with the next id (null ids first;
    of equal ids, the next text hash), after the last one the first. Rows are
    cut into ranges of (id, text hash), as many as the rows ask for; each
    range's first row is listed at the end of the range before as well, so
    no task sees more than a range. Ids are whole numbers."""
    lowest = -(1 << 63)
    d = docs.select(F.col(id_col).alias("own"), F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("id"),
                    text_key(text_col).alias("t"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ids, hashes = _ranges(d.select("id", "t"), max(RANGE_ROWS, -(-d.count() // MOST_RANGES)))

    @F.pandas_udf("range int, before int")
    def place(i, t):
        """The row's range, and the range before if it is the range's first row."""
        import numpy as np
        import pandas as pd
        i, t = i.to_numpy(np.int64), t.to_numpy(np.int64)
        k = np.searchsorted(ids, i, "right") - 1
        for r in np.flatnonzero(ids[np.maximum(k, 0)] == i):  # a border has this id: its hash decides
            lo = np.searchsorted(ids, i[r], "left")
            k[r] = lo + np.searchsorted(hashes[lo:k[r] + 1], t[r], "right") - 1
        k = np.maximum(k, 0)
        first = (ids[k] == i) & (hashes[k] == t)
        return pd.DataFrame({"range": k.astype(np.int32), "before": pd.Series(
            np.where(first, (k - 1) % len(ids), -1).astype(np.int32))})

    d = d.withColumn("at", place("id", "t"))
    d = d.select("own", "id", "t", "text", F.explode(F.filter(F.array(
        F.struct(F.lit(False).alias("extra"), F.col("at.range").alias("range")),
        F.struct(F.lit(True).alias("extra"), F.col("at.before").alias("range"))),
        lambda x: x["range"] >= 0)).alias("x")).select("own", "id", "t", "text", "x.extra", "x.range")
    w = Window.partitionBy("range").orderBy("extra", "id", "t")
    return (d.withColumn("next_text", F.lead("text").over(w)).filter(~F.col("extra"))
            .select(F.col("own").alias(id_col), F.col("text").alias(text_col), "next_text"))


def op5_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = with_next_text(table(spark, sf_dir, "documents"))
    n, k = F.char_length("text"), F.floor(F.char_length("text") / 4).cast("int")
    d = d.withColumn("edited_text", F.expr("concat(substr(text, 1, char_length(text) - char_length(text) div 4), "
                                           "substr(next_text, 1, cast(char_length(text) div 4 as int)))"))
    d = d.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
                 "text", "edited_text", "next_text")
    d = sketch.with_sketches(d, {"text": "own", "edited_text": "edited", "next_text": "next"}, drop=True)
    return d.select("doc_id", "n_chars", "edited_sha256", sketch.as_text("own").alias("fingerprint"),
                    sketch.as_text("edited").alias("edited_fingerprint"),
                    sketch.resemblance("own", "edited").alias("near_edited"),
                    sketch.resemblance("own", "next").alias("near_next"),
                    F.round(sketch.containment("edited", "own"), 6).alias("edited_in_own"),
                    F.round(sketch.distinct_shingles("own"), 3).alias("distinct_shingles"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer_files()
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), path, pattern, offsets=False)
    out = byte_bpe.decode(ids, path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(table(spark, sf_dir, "documents"), pii_key(spark))
    changed = F.filter("pii", lambda x: x["changed"])
    return out.select("doc_id", "text", F.size(changed).cast("long").alias("n_values"),
                      F.transform(changed, lambda x: x["kind"]).alias("kinds"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("n").cast("long").alias("n"), "start", "value",
                      F.round("score", 6).alias("score"), "is_secret")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.col("item").alias("item_id"), "n_windows", "n_verbatim")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", F.round("p_text", 6).alias("p_text"), F.round("p_meta", 6).alias("p_meta"),
                      F.round("score", 6).alias("score"), F.col("accepted"))


MOST_SHARED = 5  # turns that a conversation may take over from another one


def shared_openings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns and lengths of conversations that open with up to MOST_SHARED
    turns of the first conversation of their hundred (by a checksum of the id)
    and go on with their own turns after as many."""
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    c = lengths.select(F.col("conv_id").alias("c"), "own", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"),
                       (F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)).alias("h"))
    of_base = lengths.select(F.col("conv_id").alias("b"), F.col("own").alias("n_base"))
    c = c.join(of_base, F.col("base") == F.col("b"), "left").select(
        "c", "base", "h", "own", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken"))
    c = stage(c, "trie-openings")
    rest = ("turn_id", "size")
    own = (turns.join(rekeyed(c, "c"), F.col("conv_id") == F.col("c")).filter("pos > h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), *rest))
    first = (turns.filter(F.col("pos") <= MOST_SHARED).withColumnRenamed("conv_id", "of")
             .join(c, F.col("of") == F.col("base")).filter("pos <= h").select(F.col("c").alias("conv_id"), "pos", *rest))
    return own.unionByName(first), c.select(F.col("c").alias("conv_id"),
                                            (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stage(prefix_trie.turn_rows(table(spark, sf_dir, "conversations")), "trie-positions")
    return prefix_trie.build_trie(*shared_openings(turns))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", label, "embedding")
    return hard_negatives.mine(rows, F.col("id") % 100 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


WORD_FILE = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.prefix_counts(table(spark, sf_dir, "documents"), tokenizer_files(WORD_FILE)[0],
                                     limits={"fit_chars": TOKEN_LIMIT}, stored=False)
    return (token_counts.with_budget(out, TOKEN_LIMIT)
            .select("doc_id", "n_bytes", "n_tokens", "over_limit", "n_chars", "fit_chars"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_chat_format, op3_substring_dedup, op4_simhash_dedup, op5_sketch,
                                   op6_byte_bpe, op7_pii, op8_secret_scan, op9_decontaminate, op10_quality,
                                   op11_prefix_trie, op12_hard_negatives, op13_token_counts)}
