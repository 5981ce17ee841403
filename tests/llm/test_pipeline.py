"""The pipeline, stage by stage, against brute-force versions."""

import os
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_operators import WORD, brute_components
from tidemark.llm import jaccard_join
from tidemark.llm.chunk_dedup import dedup_substrings
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.jaccard_join import one_of_each
from tidemark.llm.queries import QUERIES
from tidemark.session import free_shuffles, scratch_folder, shared_folder, staged

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(staged(stage(spark, found[-1], sf_dir)))
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(results):
    assert [r.columns for r in results[:-1]] == [COLUMNS] * 5
    assert [r.schema.simpleString() for r in results[1:-1]] == [results[0].schema.simpleString()] * 4
    assert all(r.count() for r in results)


def test_only_good_documents_stay(spark, sf_dir, results):
    good = {r["doc_id"] for r in QUERIES["op3_quality_knn"](spark, sf_dir).filter("predicted = 1").collect()}
    assert set(texts(results[1])) == good and texts(results[1]).items() <= texts(results[0]).items()


def test_one_document_of_each_group_stays(results):
    before, after = texts(results[1]), texts(results[2])
    ids = sorted(before)
    sets, group = brute_components([before[i] for i in ids], 5, 80, 100)
    assert set(after) == {ids[k] for k in range(len(ids)) if group[k] == k or not sets[k]} and after.items() <= before.items()


def test_no_long_passage_stays_twice(results):
    before, after = texts(results[2]), texts(results[3])
    lengths = {r["doc_id"]: r["n_chars"] for r in results[3].collect()}
    where = {}
    for i in sorted(after):
        words = (after[i] or "").split()
        assert lengths[i] == len(after[i] or "") or after[i] == before[i]
        for k in range(len(words) - 60):
            assert where.setdefault(tuple(words[k : k + 61]), i) == i
    left = iter(())
    for i in after:  # what is left of a text is the text less some spans
        left = iter(before[i] or "")
        assert all(c in left for c in after[i] or "")
    assert set(after) <= set(before) and len(after) > 0.8 * len(before)


def test_no_benchmark_window_stays(spark, sf_dir, results):
    windows = set()
    for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        words = ALNUM.findall((row["text"] or "").lower())
        windows |= {tuple(words[k : k + 10]) for k in range(max(1, len(words) - 9))}

    def hit(text):
        words = ALNUM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return any(tuple(words[k : k + n]) in windows for n in {len(w) for w in windows} for k in range(len(words) - n + 1))

    before = texts(results[3])
    assert set(texts(results[4])) == {i for i, t in before.items() if not hit(t)}


def test_mix_takes_whole_documents(results):
    sizes = {i: len(WORD.findall(t or "")) for i, t in texts(results[4]).items()}
    rows = results[5].collect()
    assert {r["doc_id"]: r["size"] for r in rows} == sizes
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)


def test_run_is_the_stages_in_order(spark, sf_dir, results):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, results[-1].collect()))


def own_documents(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    texts = [f"{shared} first end", f"{shared} first end", f"begin {shared} " + " ".join(f"x{i}" for i in range(200)), "short text", None]
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_remove_the_tables_of_those_before(spark):
    folder = f"{shared_folder(spark)}/pipeline-{spark.sparkContext.applicationId}"
    left = []
    docs = own_documents(spark)
    for stage in (corpus_pipeline.one_of_each_group, corpus_pipeline.without_repeats, corpus_pipeline.mixed_sources):
        docs = staged(stage(spark, docs, ""))
        left.append(set(os.listdir(folder.removeprefix("file:"))))
    assert [len(x) for x in left] == [1, 1, 1] and len(set.union(*left)) == 3
    assert sorted(r["doc_id"] for r in docs.collect()) == [0, 2, 3, 4]


def test_a_stage_keeps_tables_that_its_documents_still_read(spark):
    rows = corpus_pipeline.one_of_each_group(spark, own_documents(spark), "")
    found = corpus_pipeline.without_repeats(spark, rows, "")
    assert sorted(r["doc_id"] for r in found.collect()) == [0, 2, 3, 4]


def test_a_join_leaves_no_tables_but_its_result(spark, tmp_path):
    with scratch_folder(str(tmp_path)):
        rows = one_of_each(own_documents(spark))
    assert len(os.listdir(tmp_path)) == 2
    assert sorted(r["doc_id"] for r in rows.collect()) == [0, 2, 3, 4]


def shuffle_files(spark):
    """Sizes of the shuffle files of a local session."""
    tops = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    found = [f"{folder}/{name}" for top in tops for folder, _, names in os.walk(top) for name in names if name.startswith("shuffle_") and name.endswith(".data")]
    return {name: os.path.getsize(name) for name in found if os.path.exists(name)}


def test_texts_without_a_window_are_not_shuffled(spark):
    rng = random.Random(5)
    fresh = lambda n: " ".join(f"{rng.getrandbits(40):x}" for _ in range(n))
    items = [fresh(10) for _ in range(3)]
    texts = [fresh(1000) for _ in range(200)]
    texts[7] += f" {items[1]} end"
    docs = staged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        free_shuffles(spark)
        judged = decontaminate(docs, benchmark, keep=docs.columns)
        before = shuffle_files(spark)
        rows = judged.collect()
        written = sum(size for name, size in shuffle_files(spark).items() if name not in before)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert {r["doc"].doc_id: r["doc"].text for r in rows} == dict(enumerate(texts))
    assert [(r["doc"].doc_id, r["n_hit"], r["items"]) for r in rows if r["n_hit"]] == [(7, 10, ["1"])]
    assert all(r["n_words"] == 1000 for r in rows if r["doc"].doc_id != 7)
    assert 0 < written < 0.2 * sum(map(len, texts))


def python_passes(df, capsys):
    capsys.readouterr()
    df.explain()
    plan = capsys.readouterr().out
    return plan.count("MapInArrow")


def test_passages_are_not_dealt_with_the_texts(spark, capsys):
    found = dedup_substrings(own_documents(spark), keep=["doc_id"])
    assert python_passes(found, capsys) == 1
    assert {r["doc"].doc_id: r["n_removed"] for r in found.collect()} == {0: 0, 1: 62, 2: 60, 3: 0, 4: 0}


def test_special_rows_are_told_in_one_pass(spark, capsys):
    docs = own_documents(spark).union(own_documents(spark).where("doc_id IN (2, 3)"))
    found = one_of_each(docs)
    assert python_passes(found, capsys) == 2
    assert sorted(r["doc_id"] for r in found.collect()) == [0, 2, 3, 4]


def test_links_are_counted_with_few_tables_left(spark, tmp_path, monkeypatch):
    left = []
    find = jaccard_join.components

    def counted(links):
        left.append(sum(len(names) for _, names, _ in os.walk(tmp_path)))
        return find(links)

    monkeypatch.setattr(jaccard_join, "components", counted)
    with monkeypatch.context() as m:
        m.setattr("tidemark.session.shared_folder", lambda spark: str(tmp_path))
        assert sorted(r["doc_id"] for r in one_of_each(own_documents(spark)).collect()) == [0, 2, 3, 4]
    # folders of the three nested groups of tables, those of the nodes, members, elements, parts and links; then roots, open members, late links
    assert len(left) == 2 and left[0] <= 8


def test_sketches_of_linked_sets_agree_in_bytes():
    bands = jaccard_join._bands(80, 100)
    rng = np.random.default_rng(2)
    one = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    other = np.unique(np.append(one[20:], rng.integers(0, 1 << 63, 20, dtype=np.uint64)))
    apart = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    band = bands.of(1000)[0]
    sketches = [jaccard_join._sketch(x, bands, band) for x in (one, other, apart)]
    assert sketches[0].itemsize == 1
    agree = [int((sketches[0] == x).sum()) for x in sketches[1:]]
    assert agree[0] >= len(sketches[0]) - 40 and agree[1] < 0.1 * len(sketches[0])
