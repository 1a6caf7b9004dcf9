import math
import random
import zlib

import numpy as np
import pytest

from flowloom.llm.toxicity import (
    _bins, _features, bin_counts, drop_toxic, fit, fold, op3_toxicity, score, telling_bins, training_rows,
)
from tests.llm.helpers import documents


def corpus(count=400, seed=2):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefghiklmnorstu", k=rng.randint(2, 7))) for _ in range(200)]
    rows, labels = [], []
    for i in range(count):
        toxic = int(i % 5 == 0)
        text = rng.choices(plain, k=rng.randint(20, 200))
        for _ in range(3 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(["zzyxfoul", "Vxwqnasty", "Qjjvil"]))
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    return rows, labels


def frames(spark, rows, labels):
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, label int, text string")


def test_held_out_accuracy_and_edges(spark):
    rows, labels = corpus()
    edges = [(1000, None), (1001, ""), (1002, "clean " * 30_000 + "zzyxfoul vxwqnasty qjjvil"), (None, "zzyxfoul vxwqnasty"), (3, rows[3][1])]
    extra = [(1000, 0), (1001, 1), (5000, 1), (None, 1), (7, None), (3, 0)]
    docs, table = frames(spark, rows + edges, [(*x, "no text") for x in labels + extra])
    model = fit(docs, table)
    scored = score(docs, model)
    assert scored.columns == [*docs.columns, "score"]
    got = [(r.doc_id, r.score) for r in scored.collect()]
    assert len(got) == len(rows + edges) and all(0 <= s <= 1 for _, s in got)
    truth = dict(labels)
    held = [(s >= 0.5) == truth[d] for d, s in got if d in truth and zlib.crc32(str(d).encode()) % 5 == 0]
    assert len(held) > 50 and sum(held) / len(held) > 0.95
    assert dict(got)[1002] > 0.5 and dict(got)[1000] == dict(got)[1001] < 0.5
    kept = {r.doc_id for r in drop_toxic(docs, table).collect()}
    assert kept == {d for d, s in got if s < 0.5}


def test_fold_and_sample(spark):
    rows, labels = corpus(100)
    docs, table = frames(spark, rows, [(*x, None) for x in labels])
    folds = {r.doc_id: r.f for r in docs.select("doc_id", fold(docs.doc_id).alias("f")).collect()}
    assert folds == {i: zlib.crc32(str(i).encode()) % 5 for i in range(100)}
    assert training_rows(docs, table, 1000).count() == sum(f != 0 for f in folds.values())
    assert training_rows(docs, table, 10).count() == 10


@pytest.mark.parametrize("labels, least, most", [([], 0, 1e-9), ([(1, 1, None)], 0.5, 1), ([(1, 0, None), (2, 0, None)], 0, 0.5)])
def test_without_both_labels(spark, labels, least, most):
    docs, table = frames(spark, [(1, "a"), (2, "b"), (3, "")], labels)
    assert all(least <= r.score <= most for r in score(docs, fit(docs, table)).collect())


def test_empty_documents(spark):
    docs, table = frames(spark, [], [(1, 1, None), (2, 0, None)])
    assert score(docs, fit(docs, table)).collect() == []


def test_whole_query(spark, data):
    rows = op3_toxicity(spark, data).collect()
    assert len(rows) == spark.read.parquet(f"{data}/documents.parquet").count()
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_a_task_of_the_fit_has_one_worker(spark):
    rows = spark.createDataFrame([("zzyxfoul", 1), (None, 0)], "text string, label int")
    plan = _features(rows, np.arange(1024), np.ones(1 << 18))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "MapInArrow" not in plan


def test_the_fit_brings_the_kept_bins_alone_to_the_driver(spark, monkeypatch):
    rows, labels = corpus(60)
    docs, table = frames(spark, rows, [(*x, None) for x in labels])
    seen, kind = [], type(docs)
    for name in ("collect", "toPandas"):
        monkeypatch.setattr(kind, name, lambda self, f=getattr(kind, name): (seen.append(len(out := f(self))), out)[1])
    model = fit(docs, table, kept=16)
    assert 0 < np.count_nonzero(model.weights) <= 16 and max(seen) <= 16


def test_kept_bins_are_those_that_tell_most(spark):
    texts = [("zzyxfoul day", 1), ("zzyxfoul", 1), ("a fine day", 0), ("a fine night", 0), ("", 0), (None, 1), ("night", 0)]
    rows = spark.createDataFrame(texts, "text string, label int")
    has = [(set(_bins([text or ""])[1].tolist()), label) for text, label in texts]
    found = {r.bin: (r.n0, r.n1) for r in bin_counts(rows).collect()}
    assert found == {b: tuple(sum(b in bins and label == want for bins, label in has) for want in (0, 1))
                     for b in set().union(*(bins for bins, _ in has))}

    def tells(n0, n1):
        cells = [(n, total, side) for n, total in ((n0, 4), (n1, 3)) for side, n in ((n0 + n1, n), (7 - n0 - n1, total - n))]
        return sum(n / 7 * math.log(n * 7 / (side * total)) for n, total, side in cells if n)

    best = sorted((-round(tells(*n), 12), b) for b, n in found.items())
    for kept in (1, 5, 20):
        got = [(-round(tells(r.n0, r.n1), 12), r.bin) for r in telling_bins(bin_counts(rows), np.array([4, 3]), kept).collect()]
        assert got == best[:kept]
