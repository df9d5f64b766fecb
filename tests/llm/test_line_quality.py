from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ODD, documents, table

from anchorline.llm import line_quality as lines
from anchorline.llm.common import table as read

SF = "/root/testdata/sf0.1"


def test_marginals_are_those_of_all_labellings():
    random = np.random.default_rng(2)
    bounds = np.array([0, 4, 4, 5, 11])  # one chain is empty
    unary, change = random.normal(size=11) * 2, random.normal(size=(2, 2))
    p, pairs = lines.Chains(bounds).marginals(unary, change)
    wanted, wanted_pairs = np.zeros(11), np.zeros((2, 2))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        weights, each = [], list(product((0, 1), repeat=int(b - a)))
        for ys in each:
            steps = sum(change[x, y] for x, y in zip(ys, ys[1:]))
            weights.append(np.exp(unary[a:b] @ np.array(ys, float) + steps))
        weights = np.array(weights) / sum(weights)
        for ys, w in zip(each, weights, strict=True):
            wanted[a:b] += w * np.array(ys)
            for x, y in zip(ys, ys[1:]):
                wanted_pairs[x, y] += w
    assert np.allclose(p, wanted)
    assert np.allclose(pairs, wanted_pairs)


def test_no_chain():
    p, pairs = lines.Chains(np.array([0])).marginals(np.zeros(0), np.zeros((2, 2)))
    assert len(p) == 0 and pairs.sum() == 0


def test_features_of_lines():
    bounds, found = lines.lines_of(pa.array(["Ab cd.\n\n \nAb cd.\n## !! 12", "", "é é é"]))
    assert bounds.tolist() == [0, 3, 3, 4]
    rows, size = lines.line_features(bounds, found)
    value = {f: rows[:, i].round(3).tolist() for i, f in enumerate(lines.FEATURES)}
    assert size.tolist() == [6, 6, 8, 5]
    assert value["seen"] == [0, 1, 0, 0]
    assert value["upper"] == [0.25, 0.25, 0, 0]
    assert value["symbol"] == [0, 0, 0.25, 0]
    assert value["shout"] == [0, 0, 0.25, 0]
    assert value["distinct"] == [1, 1, 1, np.float32(1 / 3).round(3)]
    assert value["adjacent"] == [0, 0, 0, np.float32(2 / 3).round(3)]
    assert value["ended"] == [1, 1, 0, 0]
    assert value["marked"] == [0, 0, np.float32(2 / 3).round(3), 0]
    assert value["foreign"] == [0, 0, 0, np.float32(0.6)]
    all_ = lines.with_neighbours(rows, bounds)
    k = len(lines.NEIGHBOURS)
    assert (all_[1, len(lines.FEATURES) : -2 - k] == rows[0, lines.NEIGHBOURS]).all()
    assert (all_[2, len(lines.FEATURES) + k : -2] == 0).all()  # the last line of its document
    assert all_[:, -2:].tolist() == [[1, 0], [0, 0], [0, 1], [1, 1]]


def test_held_out_rows_are_told_apart(spark, staging):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    got = lines.line_quality(docs, labels, staging)
    found = got.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    bad = [r.score for r in found if r.quality == 0]
    good = [r.score for r in found if r.quality == 1]
    assert len(bad) > 100 and len(good) > 600
    assert sum(r.predicted == r.quality for r in found) >= 0.98 * len(found)
    ahead = sum(g > b for g in good for b in bad) / (len(good) * len(bad))
    assert ahead > 0.99


def test_lines_of_one_document_are_labelled_apart(spark, staging):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    field = lines.fit(lines.sample(docs, labels, staging))
    good = "The quiet river runs along an old road and nobody asked where it had come from."
    bad = "BUY!! NOW!! BUY!! NOW!! BUY!! NOW!! BUY!! NOW!! BUY!! NOW!! BUY!! NOW!! BUY!! NOW!!"
    text = pa.array(["\n".join([good] * 1 + [bad] * 3), "\n".join([good, good.replace("river", "stream"), good[4:]])])
    bounds, found = lines.lines_of(text)
    rows, size = lines.line_features(bounds, found)
    p = field.marginals(rows, bounds)
    assert (p[1:4] < 0.5).all() and (p[4:] > 0.5).all()
    scores = field.scores(p, size, bounds)
    assert scores[0] < 0.3 < scores[1]


@pytest.fixture(scope="module")
def taught(spark):
    """A few labelled documents, ids that are not held out among them."""
    good = "Some plain words of line {} that nobody would call bad at all."
    rows = [(100 + i, "\n".join(good.format(i + j) for j in range(4))) for i in range(40)]
    rows += [(200 + i, "\n".join(f"$$ {i} ## $$ !! ## $$" for _ in range(4))) for i in range(40)]
    labels = [(i, int(i < 200), 0) for i, _ in rows]
    return rows, labels


def test_odd_rows(spark, staging, taught):
    rows, labels = taught
    labels = spark.createDataFrame(
        [*labels, (None, 1, 0), (7, None, 0), (6, 5, 0), (5, 0, 0), (5, 1, 0), (99999, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    docs = documents(spark, ODD + rows, extra=True)
    got = table(lines.line_quality(docs, labels, staging))
    assert len(got) == len(ODD) + len(rows)
    assert [r for r in got if r[0] == 1][0] == [r for r in got if r[0] == 1][1]
    for doc_id in (2, 3, 4):  # null, empty and blank
        (r,) = [r for r in got if r[0] == doc_id]
        assert r[2:] == (0.0, 0, 0, 0)
    assert all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.3) for r in got)
    assert all(r[2] > 0.5 for r in got if r[0] and 100 <= r[0] < 140)
    assert all(r[2] < 0.3 for r in got if r[0] and 200 <= r[0] < 240)
    # Other rows do not change a row's score.
    alone = table(lines.line_quality(docs.where("doc_id >= 100 OR doc_id = 5"), labels, staging))
    assert set(alone) <= set(got)


def test_nothing_to_learn_from(spark, staging, taught):
    rows, labels = taught
    docs = documents(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([x for x in labels if x[1]], none.schema)
    for found in (none, one):
        assert {r[2] for r in table(lines.line_quality(docs, found, staging))} == {0.0}
    assert lines.line_quality(documents(spark, []), one, staging).count() == 0


def test_repeated_rows_of_one_id_stay_within_the_sample(spark, staging, taught, monkeypatch):
    rows, labels = taught
    monkeypatch.setattr(lines, "SAMPLE", 30)
    docs = documents(spark, rows + [rows[0]] * 500 + [rows[-1]] * 500)
    found = lines.sample(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), staging)
    assert len(found) <= 60


def test_many_lines_of_one_document():
    text = pa.array(["\n".join(f"line {i} of many" for i in range(100_000))])
    bounds, found = lines.lines_of(text)
    rows, _ = lines.line_features(bounds, found)
    field = lines.Field(np.zeros(lines.WIDTH, np.float32), np.zeros((2, 2)))
    assert np.allclose(field.marginals(rows, bounds), 0.5)
