import random

import pytest

from tests.test_streams import SCHEMA, close, comments, ids, kept, write
from voxscope.operators import dedup
from voxscope.streaming import jobs


@pytest.mark.parametrize("groups", [1, 2])
def test_users_of_one_key_do_not_follow_each_other(spark, tmp_path, monkeypatch, groups):
    monkeypatch.setattr(jobs, "_USER_GROUPS", groups)
    rows = comments(random.Random(groups))
    for k in range(0, len(rows), 120):
        write(spark, str(tmp_path / "in"), rows[k:k + 120])
    write(spark, str(tmp_path / "beats"), [])
    kept(spark, tmp_path, "2 hours", 600)
    close(spark, tmp_path)
    want = ids(dedup.burst_spam_filter(spark.createDataFrame(rows, SCHEMA), 10, 20))
    assert ids(kept(spark, tmp_path, "2 hours", 600)) == want and len(want) < len(rows)
