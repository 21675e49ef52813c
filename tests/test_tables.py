"""Encoding, profiles, scaling, splits, evaluation and sources on tiny frames."""

import math
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from vitalis.functions import text as tx
from vitalis.operators import evaluate, joins, profile, project, scale, splits
from vitalis.sources import files, tables
from vitalis.sources.runlog import RunLog


def test_encode_binary_counts_null_as_one(spark):
    df = spark.createDataFrame([("no",), ("yes",), (None,)], "c string")
    assert [r[0] for r in df.select(project.encode_binary("c", "no")).collect()] == [0, 1, 1]


def test_map_labels_missing_rules(spark):
    df = spark.createDataFrame([(0,), (9,), (None,)], "c int")
    assert [r[0] for r in df.select(project.map_labels("c", {0: "x"})).collect()] == ["x", None, None]
    with pytest.raises(Exception, match="label without mapping"):
        df.select(project.map_labels("c", {0: "x"}, missing="error")).collect()


def test_one_hot_drops_first_level_and_refuses_too_many(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    assert [tuple(r) for r in project.one_hot(df, "c").orderBy("id").collect()] == [(1, 1), (2, 0), (3, 0)]
    with pytest.raises(ValueError, match="levels"):
        project.sorted_levels(spark.range(20), "id", max_levels=5)


def test_argmax_takes_first_of_ties(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "v array<double>")
    assert df.select(project.argmax("v")).first()[0] == 1


def test_null_counts_see_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, y string")
    assert {r["column_name"]: r["n_missing"] for r in profile.null_counts(df).collect()} == {"x": 2, "y": 1}


def test_histogram_last_bin_closed_and_empty_bins_kept(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (4.0,), (None,)], "x double")
    got = profile.histogram(df, ["x"], 4).orderBy("bin").collect()
    assert [r["n"] for r in got] == [2, 0, 0, 1]


def test_corr_of_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "a double, b double")
    got = {(r["x"], r["y"]): r["r"] for r in profile.corr_matrix(df, ["a", "b"]).collect()}
    assert got["a", "a"] == pytest.approx(1) and got["a", "b"] is None


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "x double, c double")
    scaler = scale.StdScale.fit(df, ["x", "c"])
    assert scaler.std["x"] == pytest.approx(1.2472191)
    assert [r["c"] for r in scaler.transform(df).collect()] == [0.0, 0.0, 0.0]
    assert scale.minmax(df, ["x", "c"]).orderBy("x").collect()[2][:] == (1.0, None)


def test_split_is_stable_under_repartition(spark):
    df = spark.range(1000)
    parts = {"train": 0.8, "test": 0.2}
    one = splits.split(df, ["id"], parts, "s").filter("split = 'test'").select("id")
    two = splits.split(df.repartition(7), ["id"], parts, "s").filter("split = 'test'").select("id")
    assert one.exceptAll(two).count() == 0 and 150 < one.count() < 250


def test_stratified_and_counts(spark):
    df = spark.range(100).withColumn("label", (F.col("id") < 90).cast("int"))
    got = splits.split_stratified(df, ["id"], "label", 0.2, "s").filter("split = 'test'").groupBy("label").count()
    assert {r[0]: r[1] for r in got.collect()} == {0: 2, 1: 18}
    cut = splits.split_counts(df, ["id"], {"a": 0.5, "b": 30, "c": None}, "s").groupBy("split").count()
    assert {r[0]: r[1] for r in cut.collect()} == {"a": 50, "b": 30, "c": 20}


def test_no_group_is_on_both_sides(spark):
    df = spark.range(30).withColumn("g", F.col("id") % 3)
    seen = 0
    for held, train, test in splits.logo_frames(df, "g"):
        assert train.filter(F.col("g") == held).count() == 0
        assert test.filter(F.col("g") != held).count() == 0
        seen += test.count()
    assert seen == 30


def test_label_gap_gives_zero_cells_and_scores(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "a")], "t string, p string")
    matrix = {(r["truth"], r["pred"]): r["n"] for r in evaluate.confusion(df, "t", "p", ["a", "b", "c"]).collect()}
    assert len(matrix) == 9 and matrix["c", "c"] == 0 and matrix["a", "b"] == 1
    scores = {r["label"]: r for r in evaluate.per_class(df, "t", "p", ["a", "b", "c"]).collect()}
    assert scores["c"]["precision"] == 0 and scores["b"]["recall"] == 0 and scores["a"]["precision"] == 0.5
    shares = evaluate.normalize_rows(evaluate.confusion(df, "t", "p", ["a", "b", "c"])).filter("truth = 'c'").collect()
    assert all(r["share"] is None for r in shares)


def test_top_features_takes_later_feature_on_ties(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (2, 0.1)], "f int, s double")
    assert [r["f"] for r in joins.top_features(df, "s", "f", 2).collect()] == [1, 0]


def test_sentences_and_edges(spark):
    df = spark.createDataFrame([("no marks here",), ("One. Two",), ("A. B! C? D",), ("",)], "t string")
    got = [r[0] for r in df.select(tx.edge_sentences(tx.sentences("t"))).collect()]
    assert got == [["no marks here"], ["One.", "One."], ["A.", "C?"], []]


def test_clean_text_removes_other_digits(spark):
    df = spark.createDataFrame([("Ab-1² ٣x/(y)",)], "t string")
    assert df.select(tx.clean_text("t")).first()[0] == "ab xy"


def test_ngrams_of_short_arrays(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [r[0] for r in df.select(tx.ngrams("t", (1, 2, 3))).collect()]
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_template_without_value_fails_early():
    with pytest.raises(ValueError, match="nums of words"):
        tx.render_prompt("x {a} {nums of words}", {"a": F.lit(1)})


def _png(path, width, height, rgb):
    def part(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    lines = b"".join(b"\0" + bytes(rgb) * width for _ in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b""))


def test_images_from_folder(spark, tmp_path):
    from vitalis.operators import images

    _png(tmp_path / "mask" / "a.png", 6, 4, (255, 0, 0))
    _png(tmp_path / "clear" / "b.png", 2, 2, (0, 0, 255))
    rows = files.read_images(spark, str(tmp_path))
    assert {r["label"] for r in rows.collect()} == {"mask", "clear"}
    ready = {r["label"]: r for r in images.prep_images(rows.select("label", "image"), 3, "rgb").collect()}
    assert list(ready["mask"]["pixels"][:3]) == [1.0, 0.0, 0.0] and len(ready["clear"]["pixels"]) == 27
    manifest = spark.createDataFrame([(1, "mask/a.png"), (2, "mask/none.png")], "id int, image_path string")
    joined = files.join_manifest(manifest, rows, ["image_path"], root=str(tmp_path)).orderBy("id").collect()
    assert joined[0]["image_path_image"]["width"] == 6 and joined[1]["image_path_image"] is None


def test_rotation_keeps_a_flat_picture():
    import numpy as np

    from vitalis.operators.images import resize, rotate

    flat = np.full((5, 7, 3), 9.0)
    assert (rotate(flat, 13.0) == 9.0).all()
    turned = rotate(np.arange(9.0).reshape(3, 3, 1), 90.0)[:, :, 0]
    assert sorted(turned.ravel()) == list(range(9)) and turned[1, 1] == 4
    assert np.allclose(resize(np.arange(16.0).reshape(4, 4, 1), 2, 2).ravel(), [2.5, 4.5, 10.5, 12.5])


def test_documents_pages_and_entity_files(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "x.txt").write_text("one\ntwo\fthree")
    pages = tables.read_documents(spark, str(tmp_path / "docs")).orderBy("page_no").collect()
    assert [p["text"] for p in pages] == ["one\ntwo", "three"]
    (tmp_path / "ent").mkdir()
    (tmp_path / "ent" / "s1_run.csv").write_text("accx\n1.5\n\n2.5\n")
    got = files.read_entity_files(spark, str(tmp_path / "ent"), ["subject", "activity"], "accx double").collect()
    assert {(r["subject"], r["activity"], r["accx"]) for r in got} == {("s1", "run", 1.5), ("s1", "run", 2.5)}


def test_csv_keeps_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", b\nnext line')], "id int, t string")
    tables.write_csv(df, str(tmp_path / "c"), header=True, quote_all=True)
    assert tables.read_table(spark, str(tmp_path / "c"), df.schema, line_breaks=True).first()["t"] == df.first()["t"]


def test_run_log(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"), "e")
    log.log("r1", "param", {"k": 5})
    log.log("r1", "metric", {"acc": 0.5})
    log.log("r1", "metric", {"acc": 0.7})
    log.log("r2", "metric", {"acc": 0.6})
    log.end("r2")
    assert log.best("acc").first()["run_id"] == "r1"
    assert {(r["run_id"], r["k"], r["acc"], r["ended"]) for r in log.runs(("k",), ("acc",)).collect()} == {
        ("r1", "5", 0.7, False), ("r2", None, 0.6, True)
    }
    with pytest.raises(ValueError):
        log.log("r1", "other", {})


def test_student_t():
    from vitalis.functions.stats import t_quantile, t_two_sided

    assert t_two_sided(2.228138851964939, 10) == pytest.approx(0.05, abs=1e-9)
    assert t_two_sided(1.0, 1) == pytest.approx(0.5)
    assert t_quantile(0.975, 19) == pytest.approx(2.093024054, abs=1e-7)
    assert math.isclose(t_two_sided(0.0, 5), 1.0)
