import pytest

from flowloom.llm.token_ledger import TokenLedger

SCHEMA = "doc_id long, version string, op string, source string, lang string, n_tokens long, seq long, batch string"


def changes(spark, rows):
    return spark.createDataFrame([(*r, "x") if len(r) == 7 else (*r, 0, "x") for r in rows], SCHEMA)


def totals(ledger):
    return {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in ledger.totals().collect()}


def test_deltas_add_up(spark):
    ledger = TokenLedger(spark)
    assert totals(ledger) == {}
    first = changes(spark, [(1, "v1", "insert", "a", "en", 10), (2, "v1", "insert", "a", "en", 5), (3, "v1", "insert", None, None, 7),
                            (None, "v1", "insert", "a", "en", 2), (1, "v2", "insert", "a", "en", 12), (2, "v1", "insert", "a", "en", 5)])
    assert ledger.commit("b1", first) is True
    want = {("a", "en", "v1"): (3, 17), (None, None, "v1"): (1, 7), ("a", "en", "v2"): (1, 12)}
    assert totals(ledger) == want
    assert ledger.commit("b1", first) is False and totals(ledger) == want
    second = changes(spark, [(1, "v1", "revise", "b", "en", 11), (2, "v1", "delete", "a", "en", 0), (9, "v1", "delete", "a", "en", 3),
                             (8, "v1", "revise", "a", "fr", 4), (None, "v1", "delete", None, None, None)])
    assert ledger.commit("b2", second)
    want = {("b", "en", "v1"): (1, 11), (None, None, "v1"): (1, 7), ("a", "fr", "v1"): (1, 4), ("a", "en", "v2"): (1, 12)}
    assert totals(ledger) == want
    assert TokenLedger(spark, ledger.folder).commit("b2", second) is False
    third = changes(spark, [(1, "v1", "insert", "b", "en", 1, 2), (1, "v1", "delete", "b", "en", 0, 3), (8, "v1", "delete", None, None, 0, 1),
                            (8, "v1", "insert", "a", "fr", 6, 2)])
    assert ledger.commit("b3", third)
    assert totals(ledger) == {(None, None, "v1"): (1, 7), ("a", "fr", "v1"): (1, 6), ("a", "en", "v2"): (1, 12)}
    assert {(r.doc_id, r.version, r.n_tokens) for r in ledger.current().collect()} == {(3, "v1", 7), (8, "v1", 6), (1, "v2", 12)}


def test_a_batch_without_its_mark_does_not_count(spark):
    ledger = TokenLedger(spark)
    rows = changes(spark, [(1, "v1", "insert", "a", "en", 10)])

    def broken(*_):
        raise RuntimeError("lost")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(spark, "range", broken, raising=False)
        with pytest.raises(RuntimeError):
            ledger.commit("b1", rows)
    assert totals(ledger) == {}
    assert ledger.commit("b1", rows) and totals(ledger) == {("a", "en", "v1"): (1, 10)}


def test_empty_batch(spark):
    ledger = TokenLedger(spark)
    assert ledger.commit("none", changes(spark, [])) and totals(ledger) == {}
    assert ledger.commit("none", changes(spark, [])) is False
