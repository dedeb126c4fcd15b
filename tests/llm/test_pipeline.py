"""Each stage on what its predecessor kept, against a plain version."""

import re

import corpus_pipeline
from eodlake.llm import mixing, quality
from tests.llm.fixtures import SCHEMA, WORD, frame, key, rows
from tests.llm.test_minhash import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = (before, docs.collect())
        if name != "pack":
            assert docs.columns == columns

    before, after = kept["quality"]
    scores = {r.doc_id: r.predicted for r in quality.op4_quality(spark, FOLDER).collect()}
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if scores[r.doc_id])

    before, after = kept["exact"]
    first = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values())

    before, after = kept["near"]
    assert sorted(r.doc_id for r in after) == sorted(d for d, _, _, stays in brute([(r.doc_id, r.text) for r in before], 5) if stays)

    before, after = kept["mix"]
    size = lambda rows, s: sum(len(WORD.findall(r.text.encode())) for r in rows if r.source == s)
    targets = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame([(r.source, len(WORD.findall(r.text.encode()))) for r in before], "source string, size long")).collect()}
    longest = max(len(WORD.findall(r.text.encode())) for r in before)
    for s, target in targets.items():
        assert abs(size(after, s) - target) <= longest / 2 + 1

    before, after = kept["pack"]
    texts = {r.doc_id: r.text for r in before}
    single = [d for d in texts if sum(r.doc_id == d for r in before) == 1]
    assert {r.doc_id for r in after} == set(texts) and sum(r.length for r in after) == sum(r.doc_tokens for r in after if r.start == 0)
    assert len(single) > 0


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_stages_on_awkward_rows(spark):
    """Nulls, empty and very long texts, repeated rows, clashing names: what each stage keeps are rows of its input, whole."""
    docs = frame(spark)
    whole = [(r.doc_id, r.text) for r in docs.collect()]
    out = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns
        out[name] = [(r.doc_id, r.text) for r in kept.collect()]
        assert set(out[name]) <= set(whole), name
    # equal texts stay or go together
    assert not {t or "" for _, t in out["quality"]} & {t or "" for _, t in set(whole) - set(out["quality"])}
    first = {}
    for d, t in sorted(whole, key=lambda x: key(x[0])):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), d)
    assert sorted((key(d), re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in out["exact"]) == sorted((key(d), t) for t, d in first.items())
    assert {d for d, t in whole if not (t or "").strip(" \t\n")} <= {d for d, _ in out["near"]}
    packed = corpus_pipeline.packing(spark, docs, FOLDER).toPandas()
    assert sum(packed.doc_tokens[packed.start == 0]) == packed.length.sum() and (packed.start == 0).sum() == len(rows())


def test_stages_on_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0, name


def test_workers_give_memory_back(spark, monkeypatch):
    """Whatever a stage's tasks do in Python, they give freed memory back at their end: a worker waits with it beside an executor's heap otherwise."""
    from eodlake.llm import common

    done = []
    monkeypatch.setattr(common, "give_back", lambda: done.append(1))
    assert list(common.frugal(lambda rows: (r + 1 for r in rows))([1, 2])) == [2, 3] and done == [1]
    taken = common.frugal(lambda rows: iter(rows))([1, 2])
    next(taken)
    taken.close()  # a limit, say, takes no more rows
    assert done == [1, 1]
    monkeypatch.undo()

    run = []
    plain = type(spark.range(0)).mapInArrow
    monkeypatch.setattr(type(spark.range(0)), "mapInArrow", lambda self, f, *a, **b: run.append(f.__qualname__) or plain(self, f, *a, **b))
    docs = frame(spark)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).count()
    assert len(run) > 8 and set(run) == {"frugal.<locals>.rows"}
