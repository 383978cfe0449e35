import os

import pandas as pd
import pytest

from boxlake.plans import registry
from tests.compare import canonical, sql_rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def test_every_query_has_sql_or_is_stateful():
    assert set(registry.queries()) - set(registry.oracle_sql()) == {"link_tracks", "link_tracks_stream"}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = canonical(registry.queries()[name](spark, SF).toPandas())
    pd.testing.assert_frame_equal(got, sql_rows(registry.oracle_sql()[name], SF))


def test_linking_stream_equals_batch(spark):
    names = ["video_id", "frame_number", "det_no", "tracker_id"]
    batch, stream = (canonical(registry.queries()[q](spark, SF).select(*names).toPandas()) for q in ("link_tracks", "link_tracks_stream"))
    pd.testing.assert_frame_equal(batch, stream)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.queries()) <= set(__spark_entry__.queries()) and set(registry.oracle_sql()) <= set(__spark_entry__.oracle_sql())
