"""Session settings, the shared folder and published versions."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_submitted_settings_win(tmp):
    import pyspark
    script = f"{tmp}/job.py"
    with open(script, "w") as f:
        f.write(f"import sys; sys.path.insert(0, {ROOT!r})\n"
                "from refmart.session import get_spark\n"
                "s = get_spark(master='local[1]', shuffle_partitions=4)\n"
                "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))\n")
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    out = subprocess.run([submit, "--master", "local[3]", "--conf", "spark.sql.shuffle.partitions=500", "--conf",
                          "spark.ui.enabled=false", script], capture_output=True, text=True, timeout=120,
                         env=os.environ | {"PYSPARK_PYTHON": sys.executable})
    assert "GOT local[3] 500" in out.stdout, out.stderr[-2000:]


def test_cluster_needs_a_shared_folder():
    from refmart.session import ensure_checkpoint_dir
    unset = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: unset)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=unset))


def test_stage_is_built_once_by_many_threads():
    import threading
    from refmart.plans.fixtures import _once
    memo, built = {}, []
    threads = [threading.Thread(target=_once, args=(memo, ("k",), lambda: built.append(1) or 7)) for _ in range(16)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert built == [1] and memo == {("k",): 7}


def test_pointers_are_never_lost(spark, tmp):
    from refmart.sources.sinks import current_version, read_current, write_full_refresh
    assert current_version(spark, tmp + "/t") is None
    with pytest.raises(FileNotFoundError):
        read_current(spark, tmp + "/t")
    write_full_refresh(spark.range(2), tmp + "/t", "z-first")
    write_full_refresh(spark.range(3), tmp + "/t", "a-second")       # the order of publishing counts, not the name
    assert current_version(spark, tmp + "/t") == "a-second" and read_current(spark, tmp + "/t").count() == 3
    pointers = [f for f in os.listdir(tmp + "/t/_current") if f.startswith("part-")]
    assert len(pointers) == 2


def test_unreadable_state_is_an_error_not_a_first_load(spark, tmp):
    from refmart.streaming.stream import apply_delta_batch
    os.makedirs(tmp + "/s/_current/part-0.txt")                       # a folder where a pointer file should be
    os.chmod(tmp + "/s/_current", 0o755)
    with open(tmp + "/s/_current/part-1.txt", "w") as f:
        f.write("not a pointer\n")
    with pytest.raises(Exception):
        apply_delta_batch(tmp + "/s", spark.range(1), "c")(spark.range(1), 0)
    assert not [x for x in os.listdir(tmp + "/s") if x != "_current"]


def test_new_checkpoint_goes_on_from_the_state(spark, tmp, monkeypatch):
    from refmart.sources.sinks import read_current
    from refmart.streaming import stream
    monkeypatch.setattr(stream, "apply_delta", lambda state, batch: state.unionByName(batch))
    start = spark.range(0, 2)
    stream.apply_delta_batch(tmp + "/s", start, "one")(spark.range(10, 11), 0)
    stream.apply_delta_batch(tmp + "/s", start, "one")(spark.range(10, 11), 0)      # replayed: skipped
    stream.apply_delta_batch(tmp + "/s", start, "two")(spark.range(20, 22), 0)      # new checkpoint: applied
    assert sorted(r.id for r in read_current(spark, tmp + "/s").collect()) == [0, 1, 10, 20, 21]


def test_null_current_flag_stays_in_the_dimension(spark):
    import datetime as dt
    from refmart.operators.dims import scd2_by_current, scd2_by_version
    day = dt.date(2024, 1, 1)
    dim = spark.createDataFrame([("A", "x", day, None, None, 1), ("B", "y", day, None, True, 2)],
                                "k STRING, v STRING, ValidFromDate DATE, ValidToDate DATE, IsCurrent BOOLEAN, sk LONG")
    src = spark.createDataFrame([], "k STRING, v STRING, ValidFromDate DATE, ValidToDate DATE")
    for load in (scd2_by_current, scd2_by_version):
        assert sorted(r.sk for r in load(dim, src, ["k"], {"v": "string"}, "sk").collect()) == [1, 2]
