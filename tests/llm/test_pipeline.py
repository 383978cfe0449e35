import random

import corpus_pipeline
from boxlake.llm import secrets
from boxlake.llm.common import scratch_dir
from tests.llm.data import docs, prose
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_mixing import brute as mixed
from tests.llm.test_near_copies import brute_kept


def test_stages_and_result_match_brute_force(spark):
    r = random.Random(6)
    passage = prose(500, 30, ("zeta", "eta", "theta", "iota"))
    rows = [(i, prose(i, r.randint(20, 120)), "en", r.choice(["src0", "src0", "src1", "src2"])) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "src3") for i in range(0, 20, 2)]  # exact copies
    rows += [(200, prose(1, 30) + " " + passage, "en", "src0"), (201, "12 34 !!", "en", "src1"), (202, None, None, None), (203, "", "en", "src1")]
    rows += [(3, prose(800, 70), "en", "src2"), (None, rows[4][1], "en", "src2"), (None, prose(801, 70), "en", "src2"), (None, prose(802, 70), "en", "src2")]  # ids that repeat or are null
    rows += [(204, prose(700, 50) + " token = abcdef123456", "en", "src1")]
    path = scratch_dir(spark)
    table = docs(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    table.write.parquet(f"{path}/documents.parquet")
    items = [(1, passage)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")

    left = [x for x in rows if any(c.isalpha() for c in x[1] or "")]
    left = brute_kept(left)
    left = [x for x in left if not leaks(x[1], items)[4]]
    left = [(x[0], secrets.redacted(x[1]), *x[2:]) for x in left]
    assert {100, 200, 201, 202, 203}.isdisjoint(x[0] for x in left)
    want = sorted(((i, e) for i, _, e in mixed(left)), key=str)

    got = corpus_pipeline.run(spark, path).collect()
    assert sorted(((x.doc_id, x.epoch) for x in got), key=str) == want
    texts = {(x[0], x[1]) for x in left}
    assert {(x.doc_id, x.text) for x in got} <= texts

    stage = table
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, path)
        assert stage.columns == table.columns
    assert sorted(((x.doc_id, x.text) for x in stage.collect()), key=str) == sorted(((x[0], x[1]) for x in left), key=str)


def test_empty_table(spark):
    path = scratch_dir(spark)
    docs(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
