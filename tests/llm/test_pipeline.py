import public_tokenizers
from llm_rows import documents
from test_near_dedup import brute_classes
from test_quality import PROSE

import __spark_entry__
import corpus_pipeline
from anchorline.llm import packing, quality
from anchorline.llm.queries import QUERIES
from conftest import SMALL


def test_everything_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert len(corpus_pipeline.STAGES) == 5


BLANKS = " \t\r\x0b\x0c"


def brute_lines(rows):
    """Three-line windows by a dictionary, documents by id, lines in order."""
    first, out = {}, []
    full = {i: [(k, x.strip(BLANKS)) for k, x in enumerate(t.split("\n")) if x.strip(BLANKS)] for i, t in rows}
    windows = {
        i: [tuple(x for _, x in lines[a : a + 3]) for a in range(len(lines) - 2)]
        for i, lines in full.items()
    }
    for i in sorted(windows):
        for at, w in enumerate(windows[i]):
            first.setdefault(w, (i, at))
    for i, text in rows:
        gone = set()
        for at, w in enumerate(windows[i]):
            if first[w] != (i, at):
                start = max(at, first[w][1] + 3) if first[w][0] == i else at
                gone |= {full[i][n][0] for n in range(start, at + 3)}
        kept = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        if not gone or kept.strip(" "):
            out.append((i, kept))
    return out


def test_run_matches_brute_force(spark, staging):
    """Every stage by plain Python on its predecessor's rows, then the pieces' documents."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    verdicts = {r.doc_id: r.kept for r in quality.quality(docs).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if verdicts[r.doc_id]]
    rows = brute_lines(rows)
    classes = brute_classes(rows)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = [(i, t) for i, t in rows if not any(x in " ".join(t.split()) for x in items)]
    words = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    import pyarrow as pa

    sizes = {i: len(x) + 1 for (i, _), x in zip(rows, words.encode(pa.array([t for _, t in rows])), strict=True)}
    got = {r.doc_id: r.doc_tokens for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) <= {i for i, _ in clean}
    assert len(got) >= 0.98 * len(clean)  # parts of items go as well
    assert all(n == sizes[i] for i, n in got.items())


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    passage = "\n".join(f"line {k} of a passage that many texts share {k * 7}" for k in range(5))

    def prose(i):
        return " ".join(f"{w} x{chr(97 + (i * k * k + 3 * k) % 26)}y{i % 7}z" for k, w in enumerate(PROSE.split())) + "."

    rows = [(i, prose(i)) for i in range(30)]
    rows += [(100, f"{prose(40)}\n{passage}"), (101, f"{prose(41)}\n{passage}"), (102, prose(3))]
    rows += [(103, prose(5) + " $$$ ### %%% ***" * 40), (104, "short"), (105, None), (None, prose(50))]
    item = "what is the smallest number of green boats that carry nine quiet people over both wide rivers today"
    rows += [(106, f"{prose(60)} {item}")]
    docs = documents(spark, rows, extra=True)
    folder = str(tmp_path)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.dtypes == docs.dtypes
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    by_quality, by_lines, by_class, by_item, packed = seen
    assert {103, 104, 105} & by_quality == set() and {100, 101, 102, 106, None} <= by_quality
    assert by_lines >= {100, 101} and 102 not in by_class and 3 in by_class
    assert by_class - by_item == {106} and packed == by_item


def test_empty_documents(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
