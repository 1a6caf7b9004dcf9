import re

from flowloom.llm.decontaminate import (
    _blocks, benchmark_windows, cut_contaminated, drop_contaminated, mark_contaminated, n_hit,
)
from tests.llm.helpers import documents, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_force(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = split(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1) if k else ():
            windows.setdefault(tuple(w[i:i + k]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[tuple(w[i:i + k])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


ITEMS = [(1, words(100, 25)), (2, "Only, three words"), (3, words(100, 25)), (4, None), (5, "... !"), (None, words(500, 12)),
         (10, "ÄÖÜ straße " + words(300, 9)), (11, "a a a a a a a a a a a")]
DOCS = [(1, "x " + words(100, 25).upper() + " y"), (2, "so ONLY\nthree-words here"), (3, words(101, 9)), (4, None), (5, ""),
        (6, words(0, 5000) + " only three " + words(300, 12)), (7, "ÄÖÜ straße " + words(300, 9)),
        (8, "äöü straße " + words(300, 9)), (9, "a " * 30), (None, words(500, 12)), (1, words(100, 12)), (1, words(100, 12))]


def run(spark, docs, items, **options):
    marked = mark_contaminated(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string, hash long"),
                               **options)
    assert marked.columns.count("n_words") == 1 and {"gid", "row"} <= set(marked.columns)
    rows = marked.select("doc_id", "n_words", n_hit().alias("n"), "items").collect()
    return sorted(((r.doc_id, r.n_words, r.n, r["items"]) for r in rows), key=repr)


def test_equals_brute_force_in_one_and_many_blocks(spark):
    items = [(*i, 0) for i in ITEMS if i[0] is not None]
    want = brute_force(DOCS, [i for i in ITEMS if i[0] is not None])
    assert run(spark, DOCS, items) == want
    assert run(spark, DOCS, items, block_windows=8) == want


def test_items_without_an_id_hit_words_and_are_listed_last(spark):
    docs = [*DOCS, (20, words(500, 12) + " / only three words"), (21, words(500, 10) + " x " + words(100, 12))]
    items = [*ITEMS, (None, "only three words")]
    want = [(doc, n, hit, [None if i == "None" else i for i in found]) for doc, n, hit, found in brute_force(docs, items)]
    assert (20, 15, 15, ["2", None]) in want and (21, 23, 22, ["1", "3", None]) in want
    items = [(*i, 0) for i in items]
    assert run(spark, docs, items) == sorted(want, key=repr)
    assert run(spark, docs, items, block_windows=8) == sorted(want, key=repr)


def test_windows_of_items_without_an_id_count_towards_the_bytes_of_a_block(spark):
    items = spark.createDataFrame([(None, words(500, 19)), (None, "only three words")], "item_id long, text string")
    windows = benchmark_windows(items)
    assert windows.count() == 11 and _blocks(windows, 100, 11 * (16 + 49)) == 1
    assert _blocks(windows, 100, 5 * (16 + 49)) == 3
    assert _blocks(windows, 4, 1 << 20) == 3


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b", 0)]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [])]


def test_documents_or_spans_are_removed(spark):
    items = spark.createDataFrame([(1, words(100, 25)), (2, "only three words")], "item_id long, text string")
    docs = documents(spark, [(1, "Before, " + words(100, 25) + "; after É."), (2, "clean"), (3, None), (4, "only three words")])
    assert {r.doc_id for r in drop_contaminated(docs, items).collect()} == {2, 3}
    cut = {r.doc_id: r.text for r in cut_contaminated(docs, items).collect()}
    assert cut == {1: "Before, ; after É.", 2: "clean", 3: "", 4: ""}


def test_spans_are_removed_alike_in_one_and_many_blocks(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    extra = [(20, "É, " + words(100, 14) + "; ß " + words(300, 5) + "! only THREE words? Ö" + words(101, 24) + "."),
             (21, words(90, 60)), (22, "x" * (3 << 20) + " only three words")]
    docs = documents(spark, DOCS + extra)
    one = cut_contaminated(docs, items)
    many = cut_contaminated(docs, items, block_windows=8)
    assert many.columns == one.columns == docs.columns and many.schema["text"] == one.schema["text"]
    want = sorted(map(repr, one.collect()))
    assert sorted(map(repr, many.collect())) == want
    cut = {r.doc_id: r.text for r in many.collect()}
    assert cut[20] == "É, ; ß " + words(300, 5) + "! ? Ö" + words(101, 24)[:4] + " ." and cut[4] == ""
    assert cut[21] == words(90, 10) + "  " + words(125, 25) and cut[22] == "x" * (3 << 20) + " "
    marked = mark_contaminated(docs, items, block_windows=8).collect()
    assert all(r.clean_text is None for r in marked) and len(marked) == len(DOCS + extra)
