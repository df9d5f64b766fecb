from random import Random

import pyarrow as pa
from llm_rows import LONG, ODD, documents

from anchorline.llm import decontamination
from conftest import SMALL

ITEM = (
    "A train leaves Boston at 7 and travels 120 km north before Maria boards. The same train "
    "then travels 45 km with Maria, who pays 12 dollars for her seat. How far did she go?"
)


def benchmark(spark, rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def found(spark, staging, docs, items):
    got = decontamination.contaminated(
        documents(spark, docs, extra=True), benchmark(spark, items), staging
    )
    return {(r.doc_id, r.item_id): (r.n_matched, r.n_windows) for r in got.collect()}


def test_copies_and_new_parameters_are_caught(spark, staging):
    other = ITEM.replace("7", "9").replace("120 km", "300 km").replace("Maria", "Tomas")
    other = other.replace("45", "80").replace("12 dollars", "31 dollars").replace("Boston", "Lyon")
    mixed = ITEM.replace("120", "80").replace("45", "80").replace("north before Maria", "north before Tomas")
    docs = [
        (1, f"Some words come before it. {ITEM} Other words come after it."),
        (2, f"Here is a question.\n{other}\nAnd here is none."),
        (3, "A train leaves every hour and nobody counts how far it travels in a day."),
        (4, mixed),
        (5, ITEM.upper()),
    ]
    got = found(spark, staging, docs, [(7, ITEM)])
    assert {(1, 7), (2, 7)} <= set(got)
    assert (3, 7) not in got
    # Two values of the item for one of the document, and two of the document for one.
    assert (4, 7) not in got or got[4, 7][0] < got[1, 7][0]


def test_driver_rows_match_brute_force(spark, staging):
    """Whole items in texts are all found; texts that share few of an item's words are not."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = {
        (r.doc_id, r.item_id)
        for r in decontamination.contaminated(docs, items, staging).collect()
    }
    texts = {r.doc_id: " ".join(r.text.split()) for r in docs.collect()}
    items = {r.item_id: " ".join(r.text.split()) for r in items.collect()}
    whole = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert whole and whole <= got

    def grams(text):
        words = text.lower().split()
        return set(zip(*[words[k:] for k in range(5)]))

    for d, i in got - whole:
        assert len(grams(texts[d]) & grams(items[i])) >= 0.3 * len(grams(items[i]))


def test_slots_have_to_correspond(spark, staging):
    item = "the box holds 3 apples and the bag holds 5 apples so the box and bag hold 8 apples in all"
    same = item.replace("3", "10").replace("5", "20").replace("8", "30")
    item2 = "first take 4 away from the sum and then add 4 to the rest of what is left over in it"
    bad = "first take 4 away from the sum and then add 9 to the rest of what is left over in it"
    got = found(spark, staging, [(1, same), (2, bad), (3, item2)], [(1, item), (2, item2)])
    assert got[1, 1][0] == got[1, 1][1]
    assert got[3, 2][0] == got[3, 2][1]
    assert (2, 2) not in got or got[2, 2][0] < got[3, 2][0]


def test_odd_rows_and_empty_tables(spark, staging):
    items = [(1, None), (2, ""), (3, "too few words"), (None, "a text without an id and a few more words"),
             (4, "along the quiet river until evening falls again wander"), (4, ITEM)]
    got = found(spark, staging, ODD, items)
    assert set(got) == {(None, None), (6, 4)}
    assert found(spark, staging, [], items) == {}
    assert found(spark, staging, ODD, []) == {}
    docs = documents(spark, ODD, extra=True)
    stage = decontamination.without_contaminated(docs, benchmark(spark, items), staging)
    assert stage.columns == docs.columns
    assert stage.count() == len(ODD) - 2
    assert stage.where("doc_id = 6").count() == 0
    assert LONG


def test_literal_copies_of_numeric_short_and_capital_items(spark, staging):
    numeric, short = "What is 17 * 23 + 45?", "Who wrote Hamlet?"
    docs = [
        (1, f"A question comes here. {numeric} It is followed by more text of another kind."),
        (2, "who wrote hamlet"),
        (3, f"Before it some words. {ITEM.title()} After it some words."),
        (4, "What is 18 * 29 + 46? Nobody who wrote of Hamlet knows."),
    ]
    got = found(spark, staging, docs, [(1, numeric), (2, short), (3, ITEM)])
    # The arithmetic has the skeleton of the item; the name alone is no copy of the question.
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 1)}


def test_short_items_are_found_as_sentences_of_longer_texts(spark, staging):
    items = [(1, "What is 17 * 23 + 45?"), (2, "Who wrote Hamlet?"), (3, "Add 5 to 5."), (4, "Why?")]
    docs = [
        (1, "Question: Who wrote Hamlet? Answer: someone."),
        (2, "Then: what is 18 * 29 + 46 ? Nobody said."),
        (3, "What is 18 - 29 / 46?"),  # other signs
        (4, "What is 18 * 18 + 46?"),  # one value for two of the item
        (5, "We asked who wrote Hamlet and why. What is 17 * 23 + 45 in words?"),
        (6, "Who wrote hamlet ? Add 6 to 7. Why? Why?"),
        (7, "Add 6 to 6."),
        (8, "Why?"),
        (None, "Who wrote Hamlet?"),
    ]
    got = found(spark, staging, docs, items)
    assert set(got) == {(1, 2), (2, 1), (6, 2), (7, 3), (8, 4), (None, 2), (5, 1)}
    assert got[2, 1] == (1, 1)
    texts = [(k, f"filler number {k} of a text. " * 40 + "Who wrote Hamlet? " + "more of it. " * 9) for k in range(50)]
    assert set(found(spark, staging, texts, items)) == {(k, 2) for k in range(50)}


def test_sentences_by_hand(spark):
    """Hashes of sentences are equal exactly where words, or skeletons, spelt out are."""
    from anchorline.llm.common import Known

    words = ["who", "wrote", "the", "sum", "3", "40", "kg", "is", "of", "+", "-"]
    draw = Random(6)
    made = [
        " ".join(draw.choice(words) for _ in range(draw.randint(1, 8))) + draw.choice([".", "?", " ?"]) for _ in range(500)
    ]
    texts = [" ".join(made[i : i + 5]) for i in range(0, 500, 5)]
    rows = decontamination.sentence_rows(
        pa.array(texts), Known(decontamination.word_values), Known(decontamination.sign_values), None
    )
    keys = {}
    for family, a, b in zip(rows["family"], rows["hash_a"], rows["hash_b"], strict=True):
        keys.setdefault(int(family), set()).add((int(a), int(b)))

    def types(text):
        out, before = [], ""
        for w in (w.strip(".?") for w in text.split()):
            if w:
                out.append("#" if w in ("3", "40") else "U" if w == "kg" and before in ("3", "40") else w)
                before = w if w not in "+-" else before
        return out

    plain = {tuple(w for w in (x.strip(".?+-") for x in s.split()) if w) for s in made}
    assert len(keys[0]) == len({s for s in plain if len(s) in (3, 4)})
    skeletons = set()
    for s in made:
        kinds = types(s)
        if sum(k in "#U" for k in kinds) >= 2 and sum(k not in "#U+-" for k in kinds) >= 2:
            skeletons.add(tuple(kinds))
    assert len(keys[1]) == len(skeletons)


def test_runs_pass_over_places_without_a_template_window(spark, staging):
    item = (
        "the small boat sails past every green island 3 4 5 6 until a quiet harbour opens wide before it "
        + " ".join(f"tail{k}" for k in range(60))
    )
    start = " ".join(item.split()[:20]).replace("3 4 5 6", "7 8 9 11")
    got = found(spark, staging, [(1, f"{start} and then another story begins")], [(1, item)])
    assert set(got) == {(1, 1)}
