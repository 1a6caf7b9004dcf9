from collections import defaultdict

from flowloom.llm.line_dedup import LineRuns, dedup_lines, line_hashes
from tests.llm.helpers import documents

LONG = "The same line of more than forty characters, again and again."


def brute_force(rows, min_length=40, min_docs=5):
    strip = " \t\n\x0b\x0c\r"
    upper = {c: c + 32 for c in range(65, 91)}

    def key(line):
        return line.strip(strip).translate(upper)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_length or len(holders[key(x)]) < min_docs or doc == max(
            holders[key(x)], key=lambda d: (d is not None, d or 0))]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    done = dedup_lines(documents(spark, rows), **options)
    assert {"n_words", "row", "lang", "text"} <= set(done.columns) and done.columns.count("kept") == 1
    return sorted(((r.doc_id, r.kept, r.n_lines, r.n_dropped) for r in done.collect()), key=repr)


def test_equals_brute_force(spark):
    rows = [(i, f"{LONG}\nown line {i}\n\t{LONG.upper()} \n") for i in range(7)]
    rows += [(20, None), (21, ""), (22, "\n\n"), (23, LONG[:20]), (24, "É" * 45), (25, "é" * 45), (None, LONG),
             (3, LONG), (3, LONG), (30, "x" * 200_000 + "\n" + LONG)]
    rows += [(40 + i, f"  {'ÄÖ short but ' * 4}{i % 2}") for i in range(12)]
    for batches in (1, 4):
        assert run(spark, rows, batches=batches) == brute_force(rows)


def test_all_lines_of_a_document_may_go(spark):
    got = run(spark, [(i, LONG) for i in range(5)])
    assert got == [(i, "" if i < 4 else LONG, 1, int(i < 4)) for i in range(5)]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_runs_are_compacted_and_a_batch_may_come_again(spark):
    runs = LineRuns(spark, fanout=2)
    for k in range(5):
        rows = [(10 * k + i, f"{LONG} {i if i else 'all'}") for i in range(3 + k)]
        new = runs.add(f"b{k}", line_hashes(documents(spark, rows)))
        assert new.count() == (3 if k == 0 else 1)
    assert runs.add("b4", line_hashes(documents(spark, rows))).count() == 1
    assert len(runs.paths()) == 2 and [len(x) for x in runs.levels] == [1, 0, 1]
    totals = {r.n_docs: r.last_doc for r in runs.totals().collect()}
    assert totals[5] == 42 and sum(r.n_docs for r in runs.totals().collect()) == 25
