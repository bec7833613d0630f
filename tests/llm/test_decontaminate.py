import random
import re

from plover.llm import decontaminate as DC
from plover.llm import queries

ITEM = ("Anna has 12 apples and buys 30 more at the market where she pays 4 dollars for each bag, "
        "so how much money does she spend on the way home today?")


def found(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(docs)], "doc_id long, text string, w int, item string")
    b = spark.createDataFrame(list(enumerate(items, 100)), "item_id long, text string")
    return {r["doc_id"]: (r["item"], r["n_verbatim"] == r["n_windows"]) for r in DC.contaminated_documents(d, b, **kw).collect()}


def test_verbatim_and_reparameterised(spark):
    filler = "Some other words stand here. "
    docs = [filler + ITEM + " " + filler, filler + ITEM.replace("12", "77").replace("30", "51").replace("Anna", "Maria Lopez"),
            ITEM.upper(), ITEM.replace(" ", "\n"), " ".join(ITEM.split()[:12]), "", None, filler * 20,
            ITEM.replace(",", " ;").replace("?", "!!"), "%%% ".join(ITEM.split())]
    got = found(spark, docs, [ITEM, None, "", "too short"])
    assert set(got) == {0, 1, 2, 3, 8, 9}
    assert got[0] == (100, True) and got[1][0] == 100 and not got[1][1]


def test_names_that_begin_sentences(spark):
    item = "Tom has 12 apples. Tom buys 30 more apples. How many apples does Tom have now?"
    other = item.replace("Tom", "Anna").replace("12", "5")
    mixed = item.replace("Tom buys", "Anna buys")  # one of three equal names differs
    got = found(spark, ["So it goes. " + other, "please solve " + item, "Question " + item, item.replace(" Tom", "\nTom"),
                        item.replace("does Tom", "does\nTom"), mixed, "Tom has many apples now."], [item])
    assert set(got) == {0, 1, 2, 3, 4} and not got[0][1] and got[2][1]
    short = "Maria walks 5 km every day to school"
    got = found(spark, ["I know that " + short.replace("Maria", "Peter"), short.replace("Maria", "Peter Pan"), short.lower(),
                        "the teacher " + short], [short])
    assert set(got) == {0, 1, 2, 3} and got[2][1] and got[3][1]


def test_slots_must_be_consistent(spark):
    item = "start with 5 then add 5 to the sum and take 7 from it before you say 5 again"
    same = item.replace("5", "8").replace("7", "3")
    mixed = item.replace("5", "8", 1)  # one of three equal values differs
    swapped = item.replace("7", "5")  # two values became one
    got = found(spark, [item, same, mixed, swapped], [item], window=17)
    assert set(got) == {0, 1}


def test_short_items_match_as_a_whole(spark):
    got = found(spark, ["he said one two three four five six today", "one two three four five", "three four five six seven"],
                ["one two three four five six"])
    assert set(got) == {0}


def test_number_series_match_by_their_values(spark):
    numbers = " ".join(str(k) for k in range(60))
    assert found(spark, [numbers, " ".join(str(k * 7) for k in range(60))], [numbers]) == {0: (100, True)}
    series = "3 1 4 1 5 9 2 6 5 3 5 8 9 7"
    docs = ["clean words " + series + " and more", series.replace("9", "8"), "x " + series[2:]]
    assert found(spark, docs, [series]) == {0: (100, True), 2: (100, True)}


def test_items_of_few_words_match_exactly(spark):
    items = ["the capital is Paris", "42", "7 9", "Who is Anna", ""]
    docs = ["I say the capital is paris now", "the capital is Rome", "a 42 b", "a 43 b", "x 7 9", "x 7 8", "who is anna?", "who is Bob", "", None]
    assert found(spark, docs, items) == {0: (100, True), 2: (101, True), 4: (102, True), 6: (103, True)}


def test_slot_heavy_items_match_verbatim(spark):
    items = ["Compute 12 + 7 * 3 - 4 / 2", "row " + " ".join(str(k * k) for k in range(12)) + " row 5 6 7",
             "guests: Anna, Bob, Carl, Dora, Emil, Fritz, Gus"]
    docs = [f"Please say: {t} (and so on)" for t in items] + [
        items[0].replace("12", "13"), items[1].replace("16", "17"), items[2].replace("Dora", "Doris")]
    assert found(spark, docs, items) == {0: (100, True), 1: (101, True), 2: (102, True)}


def test_empty_tables(spark):
    assert found(spark, [], [ITEM]) == {} == found(spark, [ITEM], [])


def test_ties_repeated_rows_and_dropping(spark):
    docs = spark.createDataFrame([(1, ITEM), (1, ITEM), (1, "clean words"), (None, ITEM), (None, "clean"), (2, None)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(9, ITEM), (3, ITEM), (3, ITEM)], "item_id long, text string")
    got = DC.contaminated_documents(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item"]) for r in got) == [(0, 3), (1, 3)]
    left = DC.drop_contaminated(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left) == [(0, "clean"), (1, "clean words"), (2, "")]


def plain(text):
    """Lower-case words of texts without digits and inner capitals."""
    return re.findall(r"[a-z0-9À-￿]+", (text or "").lower())


def test_random_windows_match_brute_force(spark):
    rnd = random.Random(8)
    words = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    items = [" ".join(rnd.choices(words, k=rnd.choice((3, 6, 9, 13, 40)))) for _ in range(20)]
    docs = []
    for _ in range(60):
        w = rnd.choices(words, k=30)
        p = rnd.choice(items).split()
        a = rnd.randrange(len(p))
        docs.append(" ".join(w + p[a:a + rnd.randrange(1, 41)] + rnd.choices(words, k=9)))
    index = set()
    for t in items:
        w = plain(t)
        n = min(len(w), 13)
        if n:
            index |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
    want = {i for i, t in enumerate(docs) if any(tuple(plain(t)[k:k + n]) in index for n in range(1, 14)
                                                for k in range(len(plain(t)) - n + 1))}
    assert set(found(spark, docs, items)) == want and want


def test_query_finds_the_tables_passages(spark):
    sf = "/root/testdata/sf0.01"
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    whole = {r["doc_id"] for r in docs if any(t in r["text"] for t in items.values())}
    got = {r["doc_id"] for r in queries.op9_decontaminate(spark, sf).collect()}
    assert whole <= got
    grams = {tuple(plain(t)[k:k + 13]) for t in items.values() for k in range(len(plain(t)) - 12)}
    assert got - whole <= {r["doc_id"] for r in docs if any(
        tuple(plain(r["text"])[k:k + 13]) in grams for k in range(len(plain(r["text"])) - 12))}
