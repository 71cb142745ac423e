"""Stage tables, components by tables, faults within a case, counters."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sliceworks.operators import cases, components, frame, morph, slices
from sliceworks.plans import methods
from sliceworks.plans.queries import queries
from sliceworks.sources import files, synthetic
from sliceworks.stages import Stages

NEED = ("hu", "tissue", "vert", "trunk")


def table(spark, middle, n_cases=10):
    return slices.stacked(synthetic.voxels(spark, middle).where(F.col("case_no") < n_cases), NEED, synthetic.SHAPE, synthetic.SPACING)


def test_each_file_is_decoded_once(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(7)
    for n, low, high in (("hu", -250, 200), ("tissue", 0, 4), ("vert", 14, 17), ("trunk", 0, 2)):
        (tmp_path / n).mkdir()
        for case in ("a", "b"):
            (tmp_path / n / f"{case}.nii.gz").write_bytes(files.encode(rng.integers(low, high, (6, 5, 8)).astype("<i2"), np.diag([1.0, 1, 2, 1]), (1.0, 1.0, 2.0)))
    opened, decode = spark.sparkContext.accumulator(0), files._slices

    def counted(batches):
        for batch in batches:
            opened.add(batch.num_rows)
            yield from decode([batch])

    monkeypatch.setattr(files, "_slices", counted)
    with Stages(spark) as stages:
        out = methods.run_files(spark, str(tmp_path / "hu"), {n: str(tmp_path / n) for n in ("tissue", "vert", "trunk")}, "whole_trunk", stages=stages, min_voxels=1, tissue=methods.TissueParams(least_mm3={"imat": 4.0}))
        assert out["raw"].count() == 16 and out["errors"].count() == 0
        plan = out["raw"]._jdf.queryExecution().optimizedPlan().toString()
        assert "binaryFile" not in plan and "MapIn" not in plan
    assert opened.value == 8
    place = stages._place(stages.path)
    assert not place.getFileSystem(stages._conf()).exists(place)


def test_one_corrupt_slice_costs_one_case(spark, middle):
    """Ten cases, one slice of one volume of one of them cut short: nine results, one error."""
    good = table(spark, middle).cache()
    for name, method, column in (("whole_trunk", "whole_trunk", "trunk"), ("lumbar_quick", "lumbar_quick", "tissue"), ("lumbar_quick", "lumbar_quick", "vert")):
        bad = good.withColumn(column, F.when((F.col("case_no") == 3) & (F.col("z") == 8), F.substring(column, 1, 7)).otherwise(F.col(column)))
        want = methods.run(good, method, synthetic.MIN_VOXELS)["raw"].where("case_no <> 3")
        out = methods.run(bad, method, synthetic.MIN_VOXELS)
        assert sorted(map(str, out["raw"].collect())) == sorted(map(str, want.collect()))
        errors = [r for r in out["errors"].collect() if r["case_no"] == 3]
        assert len(errors) == 1 and errors[0]["error"].startswith("slice 8: ")


def test_a_model_may_fail_on_a_slice(spark, middle):
    rows = slices.guarded(table(spark, middle, 3))

    def predict(hu):
        if hu[0, 0] % 7 == 0:
            raise ValueError("no answer")
        return hu > 0

    got = methods.modelled(rows, predict, "label").select("case_no", "z", "hu", "nx", "ny", "label", "fault").collect()
    for r in got:
        bad = slices.plane(r["hu"], r)[0, 0] % 7 == 0
        assert (r["fault"] == "no answer") == bad and (r["label"] is None) == bad
    assert any(r["fault"] for r in got) and not all(r["fault"] for r in got)
    with pytest.raises(Exception, match="no answer"):
        methods.modelled(rows.drop("fault"), predict, "label").collect()


@pytest.mark.parametrize("most", [0, 40, 10**9])
def test_roots_by_tables_and_in_memory(spark, most):
    """Random graphs, a long chain and a star, cases of few and of many edges."""
    rng = np.random.default_rng(3)
    edges = [(c, int(a), int(b)) for c, n in enumerate((5, 60, 200)) for a, b in rng.integers(0, n, (n, 2))]
    edges += [(7, i, i + 1) for i in range(100)] + [(8, 0, i) for i in range(1, 90)] + [(9, 4, 4)]
    with Stages(spark) as stages:
        got = {(r["case_no"], r["node"]): r["root"] for r in components.roots(stages.cut(spark.createDataFrame(edges, "case_no int, a long, b long"), "e"), stages, most).collect()}
    for case in {e[0] for e in edges}:
        own = np.array([e[1:] for e in edges if e[0] == case])
        root = components.joined(int(own.max()) + 1, own[:, 0], own[:, 1])
        assert {n: r for (c, n), r in got.items() if c == case} == {i: r for i, r in enumerate(root.tolist()) if i != r}


def test_noise_of_many_pieces(spark, monkeypatch):
    """A case of 170,000 pieces over eleven slabs, its seams joined by tables, equals labels of the whole volume."""
    rng = np.random.default_rng(1)
    shape = (100, 100, 170)
    cube = rng.random(shape) < 0.12
    rows = [(1, z, 100, 100, 1.0, 1.0, 1.0, slices.packed(cube[:, :, z])) for z in range(shape[2])]
    df = spark.createDataFrame(rows, "case_no int, z int, nx int, ny int, sx double, sy double, sz double, mask binary").repartition(8)
    monkeypatch.setattr(components.roots, "__defaults__", (100,))
    whole = morph.labelled(cube, True)
    names, n = np.unique(whole[whole >= 0], return_counts=True)
    want = np.isin(whole, names[n >= 6])
    with Stages(spark) as stages:
        got = morph.without_small(df, "mask", 6.0, three_d=True, stages=stages).collect()
    assert len(got) == 170 and all((slices.plane(r["mask"], r) == want[:, :, r["z"]]).all() for r in got)


def test_counters(spark):
    df = spark.createDataFrame([(i, i % 2 == 0, None if i % 5 == 0 else i > 10) for i in range(30)], "case_id int, even boolean, late boolean")
    steps = {"all": F.lit(True), "even": F.col("even"), "late": F.col("late")}
    assert [tuple(r) for r in cases.counted(df, steps).collect()] == [("all", 30), ("even", 15), ("late", 8)]
    left, seen = cases.observed(df, steps)
    assert left.count() == 8 and seen.get == {"all": 30, "even": 15, "late": 8}
    listing = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "a"), (3, "x")], "case_id int, item string")
    assert {tuple(r) for r in cases.have(listing, {"one": ["a"], "both": ["a", "b"]}).collect()} == {(1, True, True), (2, True, False)}


def test_metadata_and_thickness(spark, tmp_path):
    for n, v in (("hu", 50), ("tissue", 3), ("vert", 15)):
        (tmp_path / n).mkdir()
        for case in ("AB-12-x", "plain", "AB-7"):
            (tmp_path / n / f"{case}.nii.gz").write_bytes(files.encode(np.full((3, 3, 4), v, "<i2"), np.diag([1.0, 1, 2.5, 1]), (1.0, 1.0, 2.5)))
    (tmp_path / "meta").mkdir()
    (tmp_path / "meta" / "AB-12-x.csv").write_text("AcquisitionDate,20240229\nPatientSex,F\nPatientSize,1.7\nPatientWeight,60\n")
    (tmp_path / "meta" / "AB-7.csv").write_text("AcquisitionDate,20241399\nPatientSex,M\n")
    out = methods.run_files(spark, str(tmp_path / "hu"), {n: str(tmp_path / n) for n in ("tissue", "vert")}, "lumbar_quick", metadata=str(tmp_path / "meta"), min_voxels=1)
    got = {r["case_no"]: r for r in out["l3_mean"].collect()}
    assert out["l3_mean"].columns[1:11] == list(frame.CASE)
    tail = lambda c: tuple(got[c][k] for k in frame.CASE if k not in ("case_id", "case_timestamp"))
    assert tail("AB-12-x") == ("12", "AB", "x", "F", "1.7", "60", "2024-02-29", 2.5) and tail("plain") == ("plain", "", "", None, None, None, None, 2.5)
    assert tail("AB-7") == ("7", "AB", None, "M", None, None, None, 2.5)
    assert [tuple(r) for r in out["errors"].collect()] == [("AB-7", "no date: 20241399")]
    df = spark.createDataFrame([("c1",)], "c string")
    assert df.select(cases.path_of("{case}_{method}/{timestamp}.csv", F.col("c"), method="m", timestamp=F.lit("t"))).first()[0] == "c1_m/t.csv"
    with pytest.raises(ValueError):
        cases.path_of("{other}", F.col("c"))


def test_small_groups_come_together(spark):
    rows = spark.createDataFrame([(f"c{i % 70}", i // 70, i) for i in range(1400)], "case_no string, z int, n int")

    def sums(part, starts):
        ends = [*starts[1:], len(part)]
        yield pd.DataFrame([(part["case_no"].iloc[a], part["z"].iloc[a:b].tolist(), int(part["n"].iloc[a:b].sum()), len(starts)) for a, b in zip(starts, ends)], columns=["case_no", "zs", "n", "together"])

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    found = {}
    try:
        for most in (3, 10000):
            spark.conf.set(name, most)
            found[most] = slices.by_groups(rows, ("case_no",), ("z",), sums, "case_no string, zs array<int>, n int, together int").collect()
    finally:
        spark.conf.set(name, was)
    for got in found.values():
        assert sorted((r["case_no"], list(r["zs"]), r["n"]) for r in got) == sorted((f"c{k}", list(range(20)), sum(range(k, 1400, 70))) for k in range(70))
    assert max(r["together"] for r in found[10000]) > 1


@pytest.mark.parametrize("name", ["model_scores", "method_whole_trunk", "method_muscle_a", "method_muscle_b", "trunk_restrict"])
def test_no_small_group_is_a_python_call_of_its_own(spark, small, name, capsys):
    queries()[name](spark, small).explain()
    assert "FlatMapGroupsInPandas" not in capsys.readouterr().out


def test_voxels_leave_by_the_batch_and_stay_in_their_slice(spark):
    from pyspark.errors import PythonException

    voxels = spark.createDataFrame([(1, x, y, z, 10 * z + x) for z in range(300) for x in range(2) for y in range(3)], "case_no int, x int, y int, z int, v int").coalesce(1)
    rows = slices.stacked(voxels, ("v",), (2, 3, 300), (1.0, 1.0, 1.0))
    back = slices.unstacked(rows.coalesce(1), ("v",))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, voxels.collect()))
    with pytest.raises(PythonException, match="outside their slice"):
        slices.stacked(voxels, ("v",), (2, 2, 300), (1.0, 1.0, 1.0)).collect()
