"""Count windows over a stream against the batch table."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from vitalis.operators import signal
from vitalis.session import configured
from vitalis.streaming import count_windows, features

START = datetime.datetime(2024, 1, 1)
SCHEMA = "who string, ts timestamp, n bigint, accx double, accy double"


def samples(who, n, seed):
    rng = random.Random(seed)
    return [(who, START + datetime.timedelta(seconds=k // 2), 1000 * seed + k, rng.random(), rng.random()) for k in range(n)]  # two share a second


def run(spark, folder, path, state, length, shift):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    with configured(spark, spark__sql__streaming__stateStore__providerClass=count_windows.PROVIDER):
        made = count_windows.count_window_features(stream, ["who"], "ts", "n", "accx", "accy", 256.0, length, shift, "20 seconds")
        features.run_to_table(made, path, state)
    return spark.read.schema(made.schema).parquet(path)


@pytest.mark.parametrize("shift", [16, 6])
def test_late_samples_restarts_and_overlaps(spark, tmp_path, shift):
    folder, path, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    data = samples("a", 100, 1) + samples("b", 49, 2) + samples("c", 16, 3)
    batches = [[], [], [], []]
    rng = random.Random(7)
    for s in data:  # 13 seconds a batch, each sample at most one batch late
        batches[min(3, int((s[1] - START).total_seconds()) // 13 + rng.randint(0, 1))].append(s)
    batches[3].append((None, START, 5, 0.0, 0.0))
    end = [("z", START + datetime.timedelta(days=1), -1, 0.0, 0.0)]
    too_late = [("a", START + datetime.timedelta(seconds=1), -7, 9.0, 9.0)]
    counts = []
    for part in (*batches, end, too_late, [("z", START + datetime.timedelta(days=2), -2, 0.0, 0.0)]):
        random.Random(3).shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        counts.append(run(spark, folder, path, state, 16, shift).count())  # each run starts again from the checkpoint
    got = run(spark, folder, path, state, 16, shift)
    assert counts == sorted(counts) and counts[0] < counts[-1] == got.count()
    numbered = spark.createDataFrame([(*s, sum(o[0] == s[0] and o[1:3] < s[1:3] for o in data), sum(o[0] == s[0] for o in data)) for s in data], SCHEMA + ", seq bigint, total bigint")
    want = {(r.who, r.window): r for r in signal.featurize(numbered, ["who"], "seq", "total", 256.0, 16, shift).collect()}
    rows = {(r.who, r.window): r for r in got.collect()}
    assert set(rows) == set(want) and len(rows) == got.count() and {w for w, _ in rows} == {"a", "b"}
    for k, r in rows.items():
        for name in signal.FEATURE_NAMES:
            assert r[name] == pytest.approx(want[k][name], rel=1e-6, abs=1e-9)


def test_shift_beyond_the_length(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="shift"):
        count_windows.count_window_features(df, ["who"], "ts", "n", "accx", "accy", 256.0, 4, 5, "1 second")
    assert df.select(F.count(F.lit(1))).first()[0] == 0
