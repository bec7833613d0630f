"""Secret scans: candidates by pattern, false positives removed by a random
forest. DataFrame and SQL functions only.

A candidate is a run of at least ``SHORTEST`` key characters with a digit in
it, or of ``SHORTEST_ASSIGNED`` after an assignment to a credential word; ``=``
belongs to it as padding at its end only. Its features are length, character classes and the transitions between
them, dictionary coverage, path marks, and the neighbouring words. The
forest is fitted on a bounded sample of labelled findings.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plover.llm.common import stage

SHORTEST = 16
SHORTEST_ASSIGNED = 4
NEIGHBOURS = 40  # characters on either side
SAMPLE_ROWS = 10_000  # labelled findings of each class that the forest is fitted on
TREES, DEPTH, SEED = 20, 6, 7
CREDENTIAL = r"(?i)(?:token|secret|passwd|password|passphrase|pwd|credential|bearer|auth|api[ _-]?key|access[ _-]?key|private[ _-]?key)"
NAMED = CREDENTIAL + r"[A-Za-z0-9_-]{0,20}[\"']?\s{0,3}"
ASSIGNED = NAMED + r"(?::=|=>|[:=]|\s)\s{0,3}[\"'`]?$"
RUN = "[A-Za-z0-9_+/~-]"
CANDIDATE = (rf"(?<!{RUN})(?:(?=[A-Za-z_+/~-]*[0-9]){RUN}{{{SHORTEST},}}"
             rf"|(?<=[:=>]\s{{0,3}}[\"'`]?)(?<={NAMED}(?::=|=>|[:=])\s{{0,3}}[\"'`]?){RUN}{{{SHORTEST_ASSIGNED},}})"
             rf"(?:={{1,2}}(?!{RUN}|=))?")
ISSUED = (r"(?:^|/)(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}"
          r"|AIza[A-Za-z0-9_-]{35})(?:$|[/=])")
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your|xxxx|test|0123456789|1234567890"
#: A placeholder word, whole and outside addresses, directly before the value or its assignment.
HINT = (r"(?i)(?<![A-Za-z0-9@._-])(?:example|sample|dummy|placeholder|changeme|your|test)(?:[ _-][A-Za-z0-9_-]{1,30}){0,2}"
        r"[\"']?\s{0,3}(?::=|=>|[:=]|\s)\s{0,3}[\"'`]?$")
DICTIONARY = ("access account admin alpha app auth base beta build cache class client cloud code config content count "
              "data date debug default demo device doc document download email error event example field file folder "
              "group hash header home html http image index info item json key label language level license line link "
              "list local login main media message mode model module name node number object option order page param "
              "pass path place plugin post private product profile project public query record ref release report "
              "request response result root sample script search secret section server service session sha site size "
              "source start state status string style table tag target template test text theme time title token "
              "type update url user value version video view web window word world").split()
FEATURES = ("length", "digits", "lower", "upper", "hex", "runs", "variety", "vowels", "dictionary", "separators",
            "in_path", "credential", "assigned", "quoted", "address", "issued", "placeholder", "hint")


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    path_col: str | None = "source") -> DataFrame:
    """id, n (ordinal in the text), start (code points before it), value,
    before, after (neighbouring characters), path. Null and empty texts have
    none; repeated rows have theirs each. Very long texts: the work grows with
    the text, but for the places, which grow with the 1.5th power of the
    number of candidates (about a second for 100,000)."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col in docs.columns else F.lit("")
    d = docs.select(F.col(id_col).alias("id"), path.alias("path"), t.alias("text"))
    d = d.withColumn("values", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).filter(F.size("values") > 0)
    d = d.withColumn("pieces", F.split("text", CANDIDATE, -1)).drop("text")
    each = d.select("id", "path", F.posexplode(F.arrays_zip(
        F.col("values").alias("value"), _lefts(F.col("pieces"), F.col("values")).alias("left"),
        F.slice("pieces", 2, F.size("values")).alias("right"),
        _starts(F.col("pieces"), F.col("values")).alias("start"))).alias("n", "x"))
    return each.select("id", "n", F.col("x.start").alias("start"), F.col("x.value").alias("value"),
                       F.expr(f"right(x.left, {NEIGHBOURS})").alias("before"),
                       F.expr(f"left(x.right, {NEIGHBOURS})").alias("after"), "path")


def _lefts(pieces: Column, values: Column) -> Column:
    """Text before each value back to the value before; that one too if it is
    the name to which this one is assigned."""
    return F.transform(F.slice(pieces, 1, F.size(values)), lambda p, i: F.when(
        (i > 0) & p.rlike("^\\s{0,3}(?::=|=>|[:=])"), F.concat(F.get(values, i - 1), p)).otherwise(p))


def _starts(pieces: Column, values: Column) -> Column:
    """Code points before each value: sums within blocks of about the square
    root of all, plus the sums of the blocks before, as an array grows by copying."""
    nothing = F.expr("cast(array() as array<bigint>)")
    zero = F.lit(0).cast("long")
    both = F.zip_with(F.slice(pieces, 1, F.size(values)), values,
                      lambda p, v: F.struct(F.length(p).cast("long").alias("p"), F.length(v).cast("long").alias("v")))
    n = F.greatest(F.size(values), F.lit(1))
    block = F.ceil(F.sqrt(n)).cast("int")

    def sums(parts):
        """Total and running starts of an array of lengths."""
        return F.aggregate(parts, F.struct(zero.alias("at"), nothing.alias("out")), lambda a, x: F.struct(
            (a["at"] + x["p"] + x["v"]).alias("at"), F.concat(a["out"], F.array(a["at"] + x["p"])).alias("out")))

    def joined(blocks):
        before = F.aggregate(blocks, F.struct(zero.alias("at"), nothing.alias("out")), lambda a, x: F.struct(
            (a["at"] + x["at"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
        return F.flatten(F.zip_with(blocks, before, lambda x, at: F.transform(x["out"], lambda s: s + at)))

    # an array of one element binds its value, so that it is worked out once
    blocks = F.transform(F.array(both), lambda x: F.transform(
        F.sequence(F.lit(0), F.ceil(n / block).cast("int") - 1), lambda k: sums(F.slice(x, k * block + 1, block))))
    return F.transform(blocks, joined)[0]


def with_features(candidates: DataFrame) -> DataFrame:
    """Adds the columns of ``FEATURES`` (doubles)."""
    v, n = F.col("value"), F.length("value").cast("double")

    def share(pattern):
        return F.regexp_count(v, F.lit(pattern)).cast("double") / n

    words = "(?i)" + "|".join(sorted(DICTIONARY, key=len, reverse=True))
    made = {
        "length": n,
        "digits": share("[0-9]"), "lower": share("[a-z]"), "upper": share("[A-Z]"),
        "hex": v.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "runs": share("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+"),
        "variety": F.size(F.array_distinct(F.split(v, ""))).cast("double") / n,
        "vowels": share("[aeiouAEIOU]"),
        "dictionary": F.lit(1.0) - F.length(F.regexp_replace(v, words, "")) / n,
        "separators": share("[/=+_~-]"),
        "in_path": F.col("path").rlike(r"(?i)test|example|sample|doc|fixture") | v.rlike("^/|//|/.*/"),
        "credential": F.col("before").rlike(CREDENTIAL),
        "assigned": F.col("before").rlike(ASSIGNED),
        "quoted": F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]"),
        "address": F.col("before").rlike("[@.]$") | F.col("after").rlike(r"^(?:@|\.[A-Za-z])"),
        "issued": v.rlike(ISSUED),
        "placeholder": v.rlike(PLACEHOLDER),
        "hint": F.col("before").rlike(HINT),
    }
    return candidates.withColumns({k: F.coalesce(made[k].cast("double"), F.lit(0.0)) for k in FEATURES})


def rule_labels(features: DataFrame) -> DataFrame:
    """Findings labelled by rules that need no model: 1 for an issuer's format or
    a mixed value assigned to a credential, 0 for plain numbers, parts of
    addresses and paths, words, hexadecimal digests that no credential word
    stands before, and placeholders: by a word in the value itself, or by one
    directly before it unless the value is a mixed one assigned to a
    credential. Others have no label."""
    yes = (F.col("issued") == 1) | (F.col("assigned") == 1) & (F.col("digits").between(0.05, 0.95)) \
        & (F.col("variety") * F.col("length") >= 8)
    no = (F.col("digits") == 1) | (F.col("address") == 1) | (F.col("in_path") == 1) | (F.col("dictionary") > 0.5) \
        | (F.col("credential") == 0) & ((F.col("lower") + F.col("upper") > 0.9) | (F.col("hex") == 1))
    return features.withColumn("label", F.when((F.col("placeholder") == 1) & (F.col("issued") == 0), 0.0)
                               .when(yes, 1.0).when(no | (F.col("hint") == 1), 0.0))


def fit_forest(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH):
    """Random forest on at most ``sample_rows`` labelled findings of each class,
    those with the smallest hashes. None if a class is missing."""
    some = labelled.filter("label is not null").select("label", *FEATURES,
                                                       F.xxhash64("value", "before", "id", "n").alias("draw"))
    picked = [some.filter(F.col("label") == y).orderBy("draw", *FEATURES).limit(sample_rows) for y in (0.0, 1.0)]
    sample = stage(picked[0].unionByName(picked[1]).drop("draw"), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(labelCol="label", featuresCol="vector", numTrees=trees, maxDepth=depth, seed=SEED,
                                    probabilityCol="probability", rawPredictionCol="raw", predictionCol="predicted")
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="vector"), forest]).fit(sample)


def score_findings(features: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """Adds score (0 to 1) and is_secret. Without a model (no labelled findings
    of both kinds) every candidate stays a finding with a null score."""
    if model is None:
        return features.withColumn("score", F.lit(None).cast("double")).withColumn("is_secret", F.lit(True))
    out = model.transform(features).withColumn("score", vector_to_array("probability")[1])
    return out.withColumn("is_secret", F.col("score") >= threshold).drop("vector", "raw", "probability", "predicted")


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                 path_col: str | None = "source", threshold: float = 0.5) -> DataFrame:
    """Every candidate of the documents, scored: id, n, start, value, before,
    after, path, the features, score, is_secret. ``labelled``: findings with
    the same columns and label 0 or 1; without it, ``rule_labels`` of the
    documents' own candidates. An empty table has no findings."""
    found = stage(with_features(find_candidates(docs, id_col, text_col, path_col)), "secret-candidates")
    model = fit_forest(rule_labels(found) if labelled is None else labelled)
    return score_findings(found, model, threshold).withColumnRenamed("id", id_col)
