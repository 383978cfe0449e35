import os

import pandas as pd
import pytest

from boxlake.llm import registry
from tests.compare import canonical, sql_rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = canonical(registry.queries()[name](spark, SF).toPandas())
    pd.testing.assert_frame_equal(got, sql_rows(registry.oracle_sql()[name], SF))


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


def test_near_duplicates_match_brute_force(spark):
    from tests.llm.test_simhash import brute_components, brute_fingerprint

    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in rows]
    want = sorted((d, f"{fp:016x}", c) for (d, fp), (_, c) in zip(fps, brute_components(fps), strict=True))
    got = registry.queries()["op8_simhash"](spark, SF).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
