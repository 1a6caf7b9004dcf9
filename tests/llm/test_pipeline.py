"""The pipeline against its stages' brute-force versions, on a small corpus with planted cases."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from flowloom.llm import byte_bpe, decontaminate, toxicity
from flowloom.llm.common import read
from tests.llm import test_decontaminate, test_jaccard_join, test_line_dedup, test_toxicity
from tests.llm.helpers import words

LINE = "A line of licence text, longer than forty characters, in many documents"


def corpus(spark, folder):
    rows, labels = test_toxicity.corpus(200)
    rows = [(i, f"{t}\n{LINE}" if i % 7 == 0 else t) for i, t in rows]
    rows += [(500 + i, t) for i, t in enumerate(test_jaccard_join.near_copies(9, 30, 120, 1))]
    rows += [(600, "start " + words(0, 14) + " end of it all here"), (601, None), (602, ""), (603, words(0, 9)), (604, LINE),
             (605, rows[7][1]), (606, rows[7][1])]
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3) \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame([(1, words(0, 12)), (2, "short item")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return rows


def test_run_equals_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    rows = corpus(spark, folder)
    docs = read(spark, folder, "documents")
    model = toxicity.fit(docs, toxicity.toxic_labels(read(spark, folder, "labels")))
    scores = model.scores([t for _, t in rows])
    kept = [row for row, s in zip(rows, scores) if s < 0.5]
    assert 30 < len(rows) - len(kept) < 50  # a fifth of the labelled ones is toxic
    kept = [(i, t) for i, t, _, _ in test_line_dedup.brute_force(kept)]
    assert sum((t or "").count(LINE) for _, t in kept) == 1
    # Copies of one line lose it and go on as empty documents, which have no set and are all kept.
    emptied = sum(500 <= i < 530 and not t for i, t in kept)
    assert emptied > 0
    kept = [(i, dict(kept)[i]) for i, _, c in test_jaccard_join.brute_force(kept) if c == i]
    assert sum(500 <= i < 530 for i, _ in kept) == emptied + 1
    clean = {i for i, n, hit, items in test_decontaminate.brute_force(kept, [(1, words(0, 12)), (2, "short item")]) if not items}
    assert {i for i, _ in kept} - clean == {600}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY)))
    want = []
    for i, t in kept:
        if i in clean:
            ids = np.array(library.encode_ordinary(t or ""), "<u4")
            want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    corpus(spark, str(tmp_path))
    docs = read(spark, str(tmp_path), "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "jaccard_join", "benchmark_decontamination", "byte_bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(40), str(tmp_path))
        assert out.columns == docs.columns, name


def test_filters_give_back_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "some words here", 0.25, "own", 7), (2, words(0, 12), 0.5, "too", 8)],
                                 "doc_id long, text string, score double, items string, n_words int")
    labels = spark.createDataFrame([], "doc_id long, label int")
    benchmark = spark.createDataFrame([(1, words(0, 12))], "item_id long, text string")
    assert [tuple(r) for r in toxicity.drop_toxic(docs, labels).orderBy("doc_id").collect()] == [
        (1, "some words here", 0.25, "own", 7), (2, words(0, 12), 0.5, "too", 8)]
    assert [tuple(r) for r in decontaminate.drop_contaminated(docs, benchmark).collect()] == [(1, "some words here", 0.25, "own", 7)]


def test_empty_tables_and_extra_columns(spark, tmp_path):
    corpus(spark, str(tmp_path / "full"))
    for name, columns in (("documents", "doc_id long, text string, lang string, source string, n_chars long, score double, kept string"),
                          ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
    docs = read(spark, str(tmp_path / "full"), "documents").limit(60).selectExpr("*", "doc_id AS token", "'x' AS n_shingles")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path / "full")).columns == docs.columns, name
