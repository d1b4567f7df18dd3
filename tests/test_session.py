import os
import subprocess
import sys

import pytest

from voxscope import session
from voxscope.session import drop_staged, stage, staged_folder

UNSET = """
from voxscope.session import build_session, checkpoint_root, stage
spark = build_session("unset", "local[1]")
assert spark.conf.get("spark.checkpoint.dir", None) is None
print(stage(spark.range(7), "numbers").count(), checkpoint_root(spark) == checkpoint_root(spark))
"""


def test_a_local_session_without_the_setting_has_one_folder_of_its_own(tmp_path):
    done = subprocess.run([sys.executable, "-c", UNSET], capture_output=True, text=True, timeout=120,
                          env={**os.environ, "SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)}, check=False)
    assert done.stdout.split() == ["7", "True"], done.stderr
    assert any(name.startswith("voxscope-checkpoint-") for name in os.listdir(tmp_path))


def test_a_cluster_without_the_setting_is_refused():
    class Context:
        master = "spark://one:1"

    class Session:
        sparkContext, conf = Context, {}

    with pytest.raises(RuntimeError, match="every executor"):
        session.checkpoint_root(Session)


def test_staged_tables_go_without_those_of_other_applications(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/shared"
    monkeypatch.setattr(session, "checkpoint_root", lambda _: root)
    assert not drop_staged(spark)
    first, second = (stage(spark.range(n), "numbers") for n in (3, 4))
    assert (first.count(), second.count()) == (3, 4) and len(os.listdir(staged_folder(spark))) == 2
    for other in ("application-one", "application-two"):
        spark.range(5).write.parquet(f"{staged_folder(spark, other)}/numbers-x")
    spark.range(6).write.parquet(f"{root}/elsewhere")
    assert drop_staged(spark) and drop_staged(spark, "application-one")
    assert os.listdir(f"{root}/voxscope") == ["application-two"]
    assert spark.read.parquet(f"{root}/elsewhere").count() == 6 and stage(spark.range(2), "again").count() == 2
