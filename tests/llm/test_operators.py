import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest

from eodlake.llm import exact, mixing, packing, quality, registry
from tests.compare import connect, same
from tests.llm.fixtures import SCHEMA, frame, key, rows

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, name):
    same(registry.QUERIES[name](spark, FOLDER), connect(FOLDER), registry.ORACLES[name])


def normalised(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("each", [exact.PART_BYTES, 500])
def test_exact(spark, monkeypatch, each):
    monkeypatch.setattr(exact, "PART_BYTES", each)  # few bytes: groups lie across the edges of many ranges
    groups = defaultdict(list)
    for d, t, *_ in rows():
        groups[normalised(t)].append(d)
    want = []
    for t, ids in groups.items():
        ids = sorted(ids, key=key)
        want += [(d, ids[0], len(ids), i == 0, hashlib.sha256(t.encode()).hexdigest()) for i, d in enumerate(ids)]
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.exact_dedup(frame(spark)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    kept = exact.exact_filter(frame(spark))
    assert sorted(normalised(r.text) for r in kept.collect()) == sorted(groups)
    assert exact.exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("each", [exact.PART_BYTES, 100])
def test_one_group_over_many_partitions(spark, monkeypatch, each):
    monkeypatch.setattr(exact, "PART_BYTES", each)
    data = [(i, "the same text", "en", "s", 1) for i in range(500)] + [(1000 + i, f"other {i}", "en", "s", 1) for i in range(20)]
    got = exact.exact_dedup(frame(spark, data)).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id < 500} == {(0, 500)} and [r.doc_id for r in got if r.kept and r.doc_id < 500] == [0]


def test_exact_with_one_beginning(spark, monkeypatch):
    monkeypatch.setattr(exact, "PART_BYTES", 2000)
    data = [(i, "the same beginning of them all, and then " + "x" * (i % 40), "en", "s", 1) for i in range(200)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.exact_dedup(frame(spark, data)).collect()}
    assert got == {i: (i % 40, 5, i < 40) for i in range(200)}


def test_mix(spark):
    got = mixing.mix(frame(spark), rows_per_range=7).toPandas()
    assert len(got) == len(rows()) and (got.taken <= 2 * got["size"]).all()
    for _, g in got.groupby(got.source.fillna("~")):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1
        assert g.target.iloc[0] <= 2 * g.source_size.iloc[0] + 1e-6
    assert got.groupby(got.source.fillna("~")).target.first().sum() == pytest.approx(1.5 * got["size"].sum())
    again = mixing.mix(frame(spark), rows_per_range=7).toPandas()
    order = ["doc_id", "source", "size", "taken"]
    pd.testing.assert_frame_equal(got[order].sort_values(order, ignore_index=True), again[order].sort_values(order, ignore_index=True))
    # ranges only divide the work
    other = mixing.mix(frame(spark)).toPandas()
    assert other.taken.sum() == got.taken.sum()
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_longer_documents_have_better_odds(spark):
    data = [(i, "word " * (5 if i % 2 else 50), "en", "s", 1) for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(data, SCHEMA), most=2.0, budget=1.3).toPandas()
    assert abs(got.taken.sum() - got.target.iloc[0]) <= 1 and (got.taken >= got["size"]).all()
    short, long = ((got.taken > got["size"])[got["size"] == n].mean() for n in (5, 50))
    # odds 0.25 and 50 / 27.5 times a common factor; the quota fixes the words
    odds = lambda p: p / (1 - p)
    assert odds(long) / odds(short) == pytest.approx((50 / 27.5) / 0.25, rel=0.25)


def test_mixed_repeats_whole_documents(spark):
    docs = frame(spark)
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    have, take = Counter((r.doc_id, r.text) for r in docs.collect()), Counter((r.doc_id, r.text) for r in got.collect())
    assert set(take) <= set(have) and all(n <= 2 * have[k] for k, n in take.items())
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).collect() == []


def check_packed(got, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.public_tokenizer()["tokenizer"])
    ids = {d: [*whole.encode(t, add_special_tokens=False).ids, 1] for d, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.doc_tokens == len(ids[r.doc_id])
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length and r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in piece))
    for d, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[d])
    assert set(by_doc) == set(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_packing(spark):
    data, seen = [], set()
    for r in rows() + [(900, "a<|endoftext|>b", None, None, 0), (901, "日本 語 x\n\ny  z", None, None, 0), (902, "\nlead", None, None, 0)]:
        if r[0] not in seen:
            seen.add(r[0])
            data.append(r)
    got = packing.pack(frame(spark, data), **packing.public_tokenizer()).collect()
    check_packed(got, {d: t or "" for d, t, *_ in data})
    assert packing.pack(spark.createDataFrame([], SCHEMA), **packing.public_tokenizer()).collect() == []


def test_packing_given_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    check_packed(packing.op8_lexical_packing(spark, FOLDER).collect(), {r.doc_id: r.text for r in docs.collect()})


def test_repeated_rows_are_packed_each(spark):
    got = packing.pack(frame(spark), **packing.public_tokenizer()).toPandas()
    assert got[got.start == 0].shape[0] == len(rows())


def test_quality_on_held_out_rows(spark):
    got = registry.QUERIES["op4_quality"](spark, "/root/testdata/sf0.01").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    x = got.merge(labels, on="doc_id")
    assert (x.held_out == x.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    x = x[x.held_out]
    assert (x.predicted == x.quality).mean() > 0.95
    assert ((got.score >= 0) & (got.score <= 1)).all()


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (7, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.quality_scores(frame(spark), labels).count() == len(rows())
    none = labels.where("doc_id = -1")
    assert {r.score for r in quality.quality_scores(frame(spark), none).collect()} == {0.5}
    assert quality.quality_scores(spark.createDataFrame([], SCHEMA), labels).collect() == []
    kept = quality.quality_filter(frame(spark), none)
    assert kept.count() == len(rows()) and kept.columns == frame(spark).columns


def test_features_read_whole_texts():
    a, b = quality.features([b"word " * 5000, b"word " * 4999 + b"!!!!!"])
    assert a[quality.NAMES.index("bangs")] == 0 < b[quality.NAMES.index("bangs")]
