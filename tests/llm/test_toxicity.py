import random
import zlib
from collections import Counter
from itertools import product

from llm_rows import LONG, ODD, documents

from anchorline.llm import toxicity
from anchorline.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_is_edit_distance():
    rng = random.Random(5)
    terms = ["idiot$", "moron$", "worthless$", "disgusting$", "scum$", "lowei", "idol$", "worth$"]
    automaton = toxicity.Automaton(terms)
    words = [t.strip("$") for t in terms]
    for _ in range(4000):
        word = list(rng.choice(words))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randrange(2)] = rng.choice(["", "a", "o", "ts", "i"])
        word = "".join(word)
        wanted = []
        for i, t in enumerate(terms):
            if t.endswith("$"):
                edits = distance(word, t[:-1])
                if edits <= toxicity.Automaton.edits(t) and word[:1] == t[0]:
                    wanted.append((edits, i))
            elif word.startswith(t):
                wanted.append((0, i))
        found = automaton.find(word)
        # The first letter has to stay where it is, which some alignments break.
        if found:
            assert found[1] == min(wanted)[0]
        else:
            assert not wanted or min(wanted)[0] > 0


def test_misspellings_and_signs():
    automaton = toxicity.Automaton(["idiot$", "loser$"], frozenset(["lower"]))
    for word, edits in [("idiot", 0), ("IDIOT!!", 0), ("1diot", 0), ("id1ot", 0), ("idi0t,", 0), ("idiott", 1), ("idot", 1), ("lozer", 1)]:
        assert automaton.find(toxicity.bare(word))[1] == edits
    for word in ("lower", "idea", "123", "$$$", "", "patriot"):
        assert automaton.find(toxicity.bare(word)) is None


def test_windows_tell_quotation_from_abuse():
    def quoted(text, word):
        words = text.split()
        return toxicity.window_score(words, next(i for i, w in enumerate(words) if word in w))

    assert quoted("you are such an idiot and so", "idiot") == (1.5, False)
    assert quoted('he shouted "what an idiot" at it', "idiot") == (1.0, True)
    assert quoted("the word idiot is old", "idiot") == (1.0, True)
    assert quoted("what an idiot that was", "idiot") == (1.0, False)


def labelled(spark, rows):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def corpus():
    rng = random.Random(9)
    plain = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lan", "mir", "sot", "ver")]
    docs, labels = [], []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(30, 120))]
        toxic = i % 4 == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["grobnix", "stulpner", "vexum" + rng.choice("aeiou") + "n"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_documents_are_told_apart(spark, staging):
    docs, labels = corpus()
    labels = [x for x in labels if x[0] % 3] + [(5, 1, None), (7, 1, 5), (9999, 1, 1), (None, 1, 1), (1, 0, 1), (1, 0, 0)]
    got = {
        r.doc_id: r
        for r in toxicity.toxicity(documents(spark, docs, extra=True), labelled(spark, labels), staging).collect()
    }
    assert all(got[i].predicted == int(i % 4 == 0) for i in range(600))
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(600))
    typo = [(1, "befan grobnnix lan"), (2, "befan lan"), (3, ""), (4, None), (5, LONG), (6, "x " * 50 + "grobnix")]
    model = toxicity.train(documents(spark, docs), labelled(spark, labels), staging)
    scores = {r.doc_id: r.score for r in toxicity.score(documents(spark, typo), model).collect()}
    assert scores[1] > 0.5 and scores[6] > 0.5
    assert max(scores[i] for i in (2, 3, 4, 5)) < 0.5


def test_held_out_labels_teach_nothing(spark, staging):
    docs, labels = corpus()
    kept = [(i, q, t) for i, q, t in labels if zlib.crc32(str(i).encode()) % 5]
    flipped = kept + [(i, q, 1 - t) for i, q, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]

    def scores(rows):
        return sorted(map(tuple, toxicity.toxicity(documents(spark, docs), labelled(spark, rows), staging).collect()))

    assert scores(kept) == scores(flipped)


def test_odd_rows_and_empty_tables(spark, staging):
    docs, labels = corpus()
    frame = documents(spark, docs + [(i and i + 1000, t) for i, t in ODD])
    got = toxicity.toxicity(frame, labelled(spark, labels), staging).collect()
    assert Counter(r.doc_id for r in got) == Counter([i for i, _ in docs] + [i and i + 1000 for i, _ in ODD])
    assert all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    none = toxicity.toxicity(documents(spark, ODD), labelled(spark, []), staging).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert toxicity.toxicity(documents(spark, []), labelled(spark, labels), staging).count() == 0


def test_held_out_accuracy_on_driver_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic IS NOT NULL")
    rows = QUERIES["op2_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_frequent_entries_do_not_crowd_out_a_rare_term(spark):
    """More than 20,000 entries are in every text; the term is in fewer."""
    letters = "bcdfghklmnprstvz"
    plain = ["".join(x) for x in product(letters, "aeiou", letters, "ou", ("lanto", "mirka", "sotel"))][:6000]
    text = " ".join(plain)
    assert len({e for w in plain for e in toxicity.entries(w)}) > 20_000
    clean = spark.createDataFrame([(f"{i} {text}",) for i in range(40)], "text string")
    rows = [(f"{i} {text}" + (f" x{chr(97 + i)}a grobnix" if i < 16 else ""),) for i in range(40)]
    toxic, _ = toxicity.telling_entries(spark.createDataFrame(rows, "text string"), clean, 40, 40)
    assert "grobnix$" in toxic and set(toxic) <= set(toxicity.entries("grobnix"))


def test_rows_of_the_sample_are_bounded(spark, staging, monkeypatch):
    docs, labels = corpus()
    monkeypatch.setattr(toxicity, "SAMPLE", 50)
    many = documents(spark, docs + [(4, f"row {i} of one id") for i in range(700)] + [docs[1]] * 300)
    found = toxicity.sample(many, labelled(spark, labels), staging)
    counts = {r.toxic: r["count"] for r in found.groupBy("toxic").count().collect()}
    assert counts == {0: 50, 1: 50}
