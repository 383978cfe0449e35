import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from boxlake.llm import line_runs
from tests.llm.data import EDGE, docs

BLANKS = " \t\n\x0b\f\r"


def brute(rows, min_chars=line_runs.MIN_CHARS, min_docs=line_runs.MIN_DOCS):
    holders = defaultdict(set)
    low = str.maketrans({c: c.lower() for c in line_runs._UPPER})
    key = lambda line: line.strip(BLANKS).translate(low)
    rank = lambda i: -1 if i is None else i
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(rank(i))
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == rank(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def some(n, seed):
    r = random.Random(seed)
    common = [f"Shared line number {k} with enough characters, {'é' * (k % 3)}" for k in range(12)]
    rows = []
    for i in range(n):
        lines = [r.choice([r.choice(common), "  " + r.choice(common).upper() + "\t", f"own {i} " + "x" * 40, "", "short", "\x1f" + common[0], " " * 50]) for _ in range(r.randint(1, 12))]
        rows.append((r.choice([i, i, i, i // 2, None]), "\n".join(lines), "en", "s"))
    return rows


@pytest.mark.parametrize("n, batches, fanout, heavy", [(60, 8, 4, 1000), (60, 5, 2, 1), (40, 1, 2, 20)])
def test_matches_brute_force(spark, monkeypatch, n, batches, fanout, heavy):
    monkeypatch.setattr(line_runs, "HEAVY", heavy)
    rows = [*EDGE, *some(n, n + batches)]
    got = line_runs.dedup(docs(spark, rows), batches=batches, fanout=fanout).collect()
    want = [(x.doc_id, x.n_lines, x.n_dropped, hashlib.sha256(x.text.encode()).hexdigest()) for x in got]
    assert sorted(want, key=str) == brute(rows)


def test_query_form_and_empty_table(spark):
    rows = some(30, 3)
    got = line_runs.repeated_lines(docs(spark, rows)).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute(rows)
    assert line_runs.repeated_lines(docs(spark, [])).count() == 0


def test_a_line_in_every_document(spark):
    line = "the same line stands in every single document"
    rows = [(i, f"{line}\nown {i}\n{line.upper()}", "en", "s") for i in range(500)]
    got = {x.doc_id: x for x in line_runs.dedup(docs(spark, rows).repartition(6)).collect()}
    assert got[499].n_dropped == 0 and all(got[i].n_dropped == 2 and got[i].text == f"own {i}" for i in range(499))


def test_levels(spark):
    runs = line_runs.Runs(spark, fanout=3, buckets=2)
    keys = lambda ids, keeper: spark.createDataFrame([(i, i, 1, keeper) for i in ids], "h1 bigint, h2 bigint, docs bigint, keeper bigint")
    runs.add(keys([1, 2], 90))
    assert all(x.fresh for x in runs.runs()[0].collect())
    runs.add(keys([2, 3], 80))
    second = {x.h1: x for x in runs.runs()[1].collect()}
    assert not second[2].fresh and second[2].keeper is None and second[3].keeper == 80
    plan = runs.marked(keys([4], 1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1 and "SortMergeJoin" in plan  # only the batch moves
    sizes = []
    for k in range(3, 12):
        runs.add(keys([2, k + 1], 100 - 10 * k))
        sizes.append([len(level) for level in runs.levels])
    assert all(n < 3 for level in sizes for n in level) and sizes[-1] == [2, 0, 1]
    total = {x.h1: (x.docs, x.keeper) for x in runs.totals().collect()}
    assert total[2] == (11, 90) and total[1] == (1, 90) and total[12] == (1, -10) and len(total) == 12
    runs.close()
    with pytest.raises(ValueError):
        line_runs.Runs(spark, fanout=1)


def test_key(spark):
    row = spark.range(1).select(line_runs.line_key(F.lit("\t\x0b Ünd DAS\x1f \r")).alias("k")).first()
    assert row.k == "Ünd das\x1f"
