"""Models in three dimensions, cropped volumes on disk, and results that become visible as a whole."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from sliceworks.functions.labels import BoxParams
from sliceworks.operators import grid, slices
from sliceworks.plans import methods, models
from sliceworks.sources import files
from sliceworks.sources.results import Results
from sliceworks.stages import Stages

from .test_volumes import turn

CUBES = {1: (4, 5, 37), 2: (3, 3, 1), 3: (5, 4, 16), 4: (2, 6, 8)}


def cubes():
    rng = np.random.default_rng(8)
    return {c: rng.integers(-500, 500, shape).astype("<i2") for c, shape in CUBES.items()}


def rows_of(spark, made, **more):
    rows = [(c, z, *cube.shape[:2], 1.0, 1.0, 2.0, slices.packed(cube[:, :, z])) for c, cube in made.items() for z in range(cube.shape[2])]
    return spark.createDataFrame(rows, "case_no int, z int, nx int, ny int, sx double, sy double, sz double, hu binary").repartition(4)


def smooth(cube):
    """Looks two slices up and down."""
    wide = np.pad(cube.astype(np.int64), ((0, 0), (0, 0), (2, 2)))
    return sum(wide[:, :, k : k + cube.shape[2]] for k in range(5))


@pytest.mark.parametrize("depth, halo", [(4, 2), (8, 3), (64, 2), (1, 2)])
def test_slabs_equal_the_whole_volume(spark, depth, halo):
    own = cubes()
    got = models.modelled(rows_of(spark, own), lambda: lambda hu, spacing: (smooth(hu) > 0) * int(spacing[2]), "label", depth, halo).collect()
    assert len(got) == sum(s[2] for s in CUBES.values())
    for r in got:
        assert (slices.plane(r["label"], r) == 2 * (smooth(own[r["case_no"]])[:, :, r["z"]] > 0)).all()
        assert (slices.plane(r["hu"], r) == own[r["case_no"]][:, :, r["z"]]).all()


@pytest.mark.parametrize("depth, halo, margin", [(4, 3, 2), (8, 4, 2), (64, 2, 2)])
def test_merged_scores_equal_the_whole_volume(spark, depth, halo, margin):
    own = cubes()
    load = lambda: lambda hu, spacing: np.stack([np.zeros(hu.shape), smooth(hu), smooth(hu) - 300 + 2 * abs(smooth(hu) - 300)])
    got = models.scored(rows_of(spark, own), load, "label", depth, halo, margin).collect()
    assert len(got) == sum(s[2] for s in CUBES.values())
    for r in got:
        want = load()(own[r["case_no"]], None).argmax(axis=0)[:, :, r["z"]]
        assert (slices.plane(r["label"], r) == want).all()


def test_a_model_is_loaded_once_a_worker_and_may_fail(spark):
    own = cubes()
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)

        def predict(hu, spacing):
            if hu.shape[0] == 3:
                raise ValueError("too thin")
            return hu > 0

        return predict

    models.modelled(rows_of(spark, own).where("case_no <> 2"), load, "label", 1, 0).write.format("noop").mode("overwrite").save()
    assert 1 <= loads.value <= 8  # 61 slabs, 8 workers
    for how in (models.modelled, lambda rows, *a: models.scored(rows, lambda: lambda hu, s, f=load(): np.stack([f(hu, s) * 0, f(hu, s)]), "label", 4, 2)):
        got = how(slices.guarded(rows_of(spark, own)), load, "label", 4, 2).collect()
        assert {r["case_no"] for r in got if r["fault"]} == {2} and all((r["label"] is None) == bool(r["fault"]) for r in got)
    with pytest.raises(Exception, match="too thin"):
        models.modelled(rows_of(spark, own), load, "label", 4, 0).collect()
    broken = slices.guarded(rows_of(spark, own)).withColumn("hu", F.when((F.col("case_no") == 3) & (F.col("z") == 9), F.lit(b"x")).otherwise(F.col("hu")))
    got = models.modelled(broken, lambda: lambda hu, s: hu > 0, "label", 4, 0).where("fault IS NOT NULL").collect()
    assert {(r["case_no"], r["z"]) for r in got} == {(3, z) for z in range(8, 12)}


def test_a_cropped_volume_lies_where_it_lay(spark, tmp_path):
    """Crop, write and read: the same values at the same place in millimetres, of a straight and of a tilted scan."""
    rng = np.random.default_rng(6)
    (tmp_path / "hu").mkdir()
    affines, vert = {}, {}
    for case, degrees in (("a", 0), ("b", 10)):
        affine = np.eye(4)
        affine[:3, :3] = turn(0, degrees) @ np.diag([-1.5, 1.0, -2.0])
        affine[:3, 3] = (40, -10, 5)
        data = rng.integers(-100, 100, (7, 8, 9)).astype("<i2")
        (tmp_path / "hu" / f"{case}.nii.gz").write_bytes(files.encode(data, affine, (1.5, 1.0, 2.0)))
        affines[case], vert[case] = affine, data
    rows = files.as_slices(files.volumes(spark, str(tmp_path / "hu")), "hu")
    marked = slices.with_planes(rows, lambda row: {"vert": (np.add.outer(np.arange(row.nx), np.zeros(row.ny)) == 4) * (3 <= row.z <= 6) * 15}, ("vert",))
    p = BoxParams((15,), (True,) * 6, (1.5, 1.5, -1.0, -1.0, 2.0, 2.0))
    boxes = grid.bounding_boxes(slices.bounds(marked, "vert", p.roi), p, inclusive_end=True)
    small = slices.cropped(marked, boxes)
    found = {r["case_no"]: r for r in boxes.collect()}
    files.write_volumes(files.packed_volumes(files.as_volume(small, "hu", "crop")), str(tmp_path))
    for case, data in vert.items():
        b = found[case]
        turned, whole, _ = files.oriented(data, affines[case], (1.5, 1.0, 2.0))
        got, affine, spacing = files.decode((tmp_path / "crop" / f"{case}.nii.gz").read_bytes())
        assert (got == turned[b["x0"] : b["x1"], b["y0"] : b["y1"], b["z0"] : b["z1"]]).all() and np.allclose(spacing, (1.5, 1.0, 2.0)) and b["z0"] > 0 and b["x0"] > 0
        assert np.allclose(affine @ [1, 2, 3, 1], whole @ [1 + b["x0"], 2 + b["y0"], 3 + b["z0"], 1], atol=1e-4)
    gone = files.as_volume(small.where("z <> 4"), "hu", "gaps")
    assert {r["error"] for r in files.packed_volumes(gone).collect()} == {"slices are missing"}
    files.write_errors(spark.createDataFrame([("a", "no")], "case_no string, error string"), str(tmp_path / "errors"))
    files.write_errors(spark.createDataFrame([("b", "nor")], "case_no string, error string"), str(tmp_path / "errors"))
    assert {tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "errors")).collect()} == {("a", "no"), ("b", "nor")}


def test_runs_become_visible_as_a_whole(spark, tmp_path):
    out = Results(spark, str(tmp_path / "out"))
    frame = lambda *rows: spark.createDataFrame(rows, "case_no string, v int")
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "case_no string")
    assert out.read("raw") is None and out.remaining(ids("a", "b"), "w").count() == 2
    out.commit({"raw": frame(("a", 1), ("a", 2))}, ids("a", "quiet"), "w")
    assert [r["case_no"] for r in out.remaining(ids("a", "b", "quiet"), "w").collect()] == ["b"]
    assert out.remaining(ids("a"), "elsewhere").count() == 1

    def broken(v):
        raise ValueError("half way")

    bad = frame(("b", 1), ("c", 2)).select("case_no", F.udf(broken, "int")("v").alias("v"))
    with pytest.raises(Exception, match="half way"):
        out.commit({"raw": frame(("b", 1)), "more": bad}, ids("b", "c"), "w")
    assert {r["case_no"] for r in out.read("raw").collect()} == {"a"} and out.read("more") is None and out.remaining(ids("b"), "w").count() == 1
    out.commit({"raw": frame(("a", 7), ("b", 8))}, ids("a", "b", "c"), "w", spark.createDataFrame([("c", "bad")], "case_no string, error string"))
    out.commit({"raw": frame(("a", 9))}, ids("a"), "elsewhere")
    assert {(r["workspace"], r["case_no"], r["v"]) for r in out.read("raw").collect()} == {("w", "a", 7), ("w", "b", 8), ("elsewhere", "a", 9)}
    assert [r["case_no"] for r in out.remaining(ids("a", "b", "c"), "w").collect()] == ["c"]
    assert {(r["case_no"], r["status"]) for r in out.cases().where("workspace = 'w'").collect()} == {("a", "done"), ("b", "done"), ("c", "error"), ("quiet", "done")}


def test_a_batch_is_done_once(spark, tmp_path):
    for n, v in (("hu", 50), ("tissue", 3), ("vert", 15)):
        (tmp_path / n).mkdir()
        for case in ("a", "b", "c"):
            if (case, n) != ("c", "vert"):
                (tmp_path / n / f"{case}.nii.gz").write_bytes(files.encode(np.full((3, 3, 4), v, "<i2"), np.diag([1.0, 1, 2, 1]), (1.0, 1.0, 2.0)))
    out, labels = Results(spark, str(tmp_path / "out")), {n: str(tmp_path / n) for n in ("tissue", "vert")}
    go = lambda **how: methods.run_open(spark, str(tmp_path / "hu"), labels, out, "w", min_voxels=1, **how)
    assert go() and sorted(r["case_no"] for r in out.read("l3_mean").collect()) == ["a", "b"]
    n = out.read("raw").count()
    # c lacked a volume: it alone is open, and is done once it has it
    assert [tuple(r) for r in out.read("errors").select("case_no", "error").collect()] == [("c", "vert: no volume")]
    assert go() and out.read("raw").count() == n
    (tmp_path / "vert" / "c.nii.gz").write_bytes((tmp_path / "vert" / "a.nii.gz").read_bytes())
    assert go() and out.read("raw").count() == n // 2 * 3 and out.read("errors").count() == 0
    assert go() is None and go(again=True) and out.read("raw").count() == n // 2 * 3


def test_ordered_files_and_lists_of_volumes(spark, tmp_path):
    from sliceworks.operators import frame

    rows = [(c, level, i) for c in ("a", "b") for i, level in enumerate(("L3", "T12", "0", "SACRUM", "L1"))]
    df = spark.createDataFrame(rows, "case_no string, level string, v int").repartition(4)
    files.write_frame(df, str(tmp_path / "out"), order=(frame.place("level"), "level"))
    for case in "ab":
        parts = list((tmp_path / "out" / f"case_no={case}").glob("*.csv"))
        assert len(parts) == 1 and [x.split(",")[0] for x in parts[0].read_text().split()] == ["level", "0", "T12", "L1", "L3", "SACRUM"]
    assert [r["level"] for r in frame.ordered(df, "level").collect()] == ["0", "T12", "L1", "L3", "SACRUM"] * 2
    for name in ("x", "y", "z"):
        (tmp_path / f"{name}.nii").write_bytes(files.encode(np.zeros((2, 2, 2), "<i2"), np.eye(4), (1.0, 1.0, 1.0)))
        files.write_slices(files.volumes(spark, str(tmp_path / f"{name}.nii"), f"v{name}"), str(tmp_path / "slices"))
    assert {r["volume"] for r in files.stored(spark, str(tmp_path / "slices"), ["vx", "vz", "none"]).collect()} == {"vx", "vz"}
    assert files.stored(spark, str(tmp_path / "slices"), "vy").count() == 2
