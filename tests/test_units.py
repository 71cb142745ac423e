"""Edge cases of the volume engine by hand."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from sliceworks.functions.labels import BoxParams, LevelParams, Method, TissueParams
from sliceworks.operators import cases, frame, grid, hist, levels, morph, slices
from sliceworks.plans import methods
from sliceworks.sources import files, synthetic


@pytest.mark.parametrize("counts, level", [({0: 900, 15: 25, 16: 25}, 15), ({0: 900, 15: 19}, 0), ({0: 900, 19: 500, 17: 25}, 17), ({0: 900, 19: 500}, 19), ({0: 900, 19: 1, 17: 19}, 19), ({17: 10, 18: 10}, 17)])
def test_dominance(spark, counts, level):
    h = spark.createDataFrame([(1, 0, k, n) for k, n in counts.items()], "case_no int, z int, label int, n long")
    assert hist.dominant(h, LevelParams()).first()["level"] == level


def test_boxes(spark):
    v = spark.createDataFrame([(1, 0, 0, z, 15 if 5 <= z <= 9 else 0) for z in range(20)] + [(2, 0, 0, 0, 0)], "case_no int, x int, y int, z int, vert int")

    def box(low, high, s):
        p = BoxParams((15,), margin_mm=(0, 0, 0, 0, low, high))
        volumes = spark.createDataFrame([(c, 1, 1, 20, 1.0, 1.0, float(s)) for c in (1, 2)], "case_no int, nx int, ny int, nz int, sx double, sy double, sz double")
        found = {r["case_no"]: (r["z0"], r["z1"], r["error"]) for r in grid.bounding_boxes(grid.bounds(v, "vert", p, volumes), p).collect()}
        same = grid.bounding_boxes(slices.bounds(slices.stacked(v, ("vert",), volumes=volumes), "vert", (15,)).withColumn("nz", F.lit(20)), p)
        assert found == {r["case_no"]: (r["z0"], r["z1"], r["error"]) for r in same.collect()}
        return found

    assert box(0, 0, 2) == {1: (5, 9, None), 2: (0, 20, None)} and box(3, 1, 2)[1] == (3, 10, None) and box(-20, -20, 5)[1] == (9, 5, "the box holds no voxel")


def test_components():
    two = np.zeros((3, 3), bool)
    two[0, 0] = two[1, 1] = True
    assert len(np.unique(morph.labelled(two, True)[two])) == 1 and len(np.unique(morph.labelled(two, False)[two])) == 2


def test_holes(spark):
    cube = [(1, x, y, z, int((x, y, z) != (2, 2, 2) and min(x, y, z) >= 1 and max(x, y, z) <= 3)) for x in range(5) for y in range(5) for z in range(5)]
    df = spark.createDataFrame(cube, "case_no int, x int, y int, z int, mask int")
    full = morph.fill_holes(slices.stacked(df, ("mask",), (5, 5, 5), (1.0, 1.0, 1.0)), "mask")
    assert slices.unstacked(full, ("mask",)).where("mask > 0").count() == 27


def test_pieces_equal_whole_volumes(spark):
    """Components by pieces of slices against labels of whole random volumes of up to three slabs, cases of other sizes and spacings."""
    rng = np.random.default_rng(5)
    kinds = {c: (int(rng.integers(3, 9)), int(rng.integers(3, 9)), int(rng.integers(1, 40)), 1.0 + c % 2, 1.0, 2.0) for c in range(6)}
    cubes = {c: rng.random(k[:3]) < (0.3, 0.45, 0.6)[c % 3] for c, k in kinds.items()}
    rows = [(c, x, y, z, int(v)) for c, cube in cubes.items() for (x, y, z), v in np.ndenumerate(cube)]
    volumes = spark.createDataFrame([(c, *k) for c, k in kinds.items()], "case_no int, nx int, ny int, nz int, sx double, sy double, sz double")
    own = slices.stacked(spark.createDataFrame(rows, "case_no int, x int, y int, z int, mask int"), ("mask",), volumes=volumes)

    def largest(comp):
        names, n = np.unique(comp[comp >= 0], return_counts=True)
        return comp == names[n.argmax()] if len(names) else comp >= 0

    def sized(cube, least):
        comp = morph.labelled(cube, True)
        names, n = np.unique(comp[comp >= 0], return_counts=True)
        return np.isin(comp, names[n >= least])

    def flat(cube, least):
        return np.stack([sized(cube[:, :, z], least) for z in range(cube.shape[2])], axis=2)

    want = {
        "largest": (morph.keep_largest(own, "mask"), lambda cube, k: largest(morph.labelled(cube, False))),
        "holes": (morph.fill_holes(own, "mask"), lambda cube, k: ~largest(morph.labelled(~np.pad(cube, 1), False))[1:-1, 1:-1, 1:-1]),
        "sized": (morph.without_small(own, "mask", 12.0, three_d=True), lambda cube, k: sized(cube, 12.0 / (k[3] * k[4] * k[5]))),
        "flat": (morph.without_small(own, "mask", 4.0), lambda cube, k: flat(cube, 4.0 / (k[3] * k[4]))),
    }
    for name, (got, plain) in want.items():
        found = {(r["case_no"], r["x"], r["y"], r["z"]) for r in slices.unstacked(got, ("mask",)).where("mask > 0").collect()}
        assert found == {(c, *i) for c, cube in cubes.items() for i in map(tuple, np.argwhere(plain(cube, kinds[c])).tolist())}, name


def test_median_equals_plain(spark):
    rng = np.random.default_rng(6)
    cube = rng.integers(-100, 100, (7, 5, 2))
    df = spark.createDataFrame([(1, x, y, z, int(v)) for (x, y, z), v in np.ndenumerate(cube)], "case_no int, x int, y int, z int, hu int")
    got = slices.unstacked(slices.median_filtered(slices.stacked(df, ("hu",), (7, 5, 2), (1.0, 1.0, 1.0)), kernel=(3, 5)), ("hu_median",)).collect()
    wide = np.pad(cube, ((1, 1), (2, 2), (0, 0)), mode="symmetric")
    assert len(got) == cube.size and all(r["hu_median"] == np.sort(wide[r["x"] : r["x"] + 3, r["y"] : r["y"] + 5, r["z"]].ravel())[7] for r in got)


def test_many_gaps(spark):
    """800 slices with 400 gaps; windows grow until a level dominates."""
    rows = [(1, z, 0, 500) for z in range(800)] + [(1, z, 17 - z // 200, 40) for z in range(0, 800, 2)]
    h = spark.createDataFrame(rows, "case_no int, z int, label int, n long")
    p = LevelParams()
    base = hist.dominant(h, p)
    got = {r["z"]: r["level"] for r in levels.settled(h, base, p).collect()}
    assert len(got) == 799 and all(got[z] == 17 - z // 200 for z in range(0, 799, 2)) and 0 not in got.values()
    none = spark.createDataFrame([(1, 0, 0, 500), (2, 0, 15, 500)], "case_no int, z int, label int, n long")
    assert [tuple(r) for r in levels.without_levels(none, p).collect()] == [(1, "no vertebral level found")]


def test_names_and_subsets(spark):
    ids = spark.createDataFrame([("AB-123-x",), ("AB--x",), ("AB-",), ("123",)], "c string").select(*cases.patient_id(F.col("c"))).collect()
    assert [tuple(r) for r in ids] == [("AB", "123", "x"), ("AB", None, "x"), ("AB", None, None), ("", "123", "")]
    assert frame.wanted_levels("L") == ["L1", "L2", "L3", "L4", "L5", "L6"]
    with pytest.raises(ValueError):
        frame.wanted_levels("X")


def test_volume_round_trip(spark, tmp_path):
    data = np.random.default_rng(1).integers(-1000, 1000, (4, 3, 5)).astype("<i2")
    affine = np.diag([-1.5, 1.5, 5.0, 1.0])
    (tmp_path / "ct_1.2.nii.gz").write_bytes(files.encode(data, affine, (1.5, 1.5, 5.0)))
    (tmp_path / "bad.nii").write_bytes(b"no volume")
    rows = files.volumes(spark, str(tmp_path))
    assert rows.where("error IS NOT NULL").count() == 1 and rows.where("case_id = 'ct_1'").count() == 5
    got = {(r["x"], r["y"], r["z"]): r["hu"] for r in files.voxels_of(rows).collect()}
    right = data[::-1]  # slices run to the right, anterior, superior
    assert all(got[i] == v for i, v in np.ndenumerate(right)) and len(got) == data.size
    back, a, _ = files.decode(files.packed_volumes(rows).first()["content"])
    assert (back == right).all() and np.allclose(a, [[1.5, 0, 0, -4.5], [0, 1.5, 0, 0], [0, 0, 5.0, 0], [0, 0, 0, 1]]) and grid.canonical(a.ravel().tolist()) == ((0, 1, 2), (False,) * 3)
    files.write_slices(rows.where("error IS NULL"), str(tmp_path / "slices"))
    assert spark.read.parquet(str(tmp_path / "slices")).count() == 5


def test_a_model_plugs_in(spark):
    df = spark.createDataFrame([(1, x, y, 0, 10 * x + y) for x in range(2) for y in range(3)], "case_no int, x int, y int, z int, hu int")
    got = methods.modelled(slices.stacked(df, ("hu",), (2, 3, 1), (1.0, 1.0, 1.0)), lambda hu: hu > 10, "label")
    assert {(r["x"], r["y"]) for r in slices.unstacked(got, ("label",)).where("label = 1").collect()} == {(1, 1), (1, 2)}


def test_stored_volumes_are_reused(spark, tmp_path):
    for case in ("1", "2"):
        (tmp_path / f"{case}.nii.gz").write_bytes(files.encode(np.full((2, 2, 3), int(case), "<i2"), np.eye(4), (1.0, 1.0, 1.0)))
    (tmp_path / "3.nii.gz").write_bytes(b"no volume")
    rows, out = files.volumes(spark, str(tmp_path / "*.nii.gz")), str(tmp_path / "made")

    def plus(n):
        return lambda df: slices.with_planes(df.where("error IS NULL"), lambda row: {"data": slices.plane(row.data, row) + n}, ("data",)).unionByName(df.where("error IS NOT NULL"))

    def values(df):
        return {(r["case_id"], r["z"], np.frombuffer(r["data"], "<i2")[0]) for r in df.where("error IS NULL").collect()}

    first = files.reused(rows.where("case_id <> '2'"), out, "label", plus(10))
    assert values(first) == {("1", z, 11) for z in range(3)} and [r["case_id"] for r in first.where("error IS NOT NULL").collect()] == ["3"]
    assert values(files.reused(rows, out, "label", plus(20))) == {("1", z, 11) for z in range(3)} | {("2", z, 22) for z in range(3)}
    assert values(files.reused(rows.where("case_id = '2'"), out, "label", plus(30))) == {("2", z, 22) for z in range(3)}
    assert values(files.reused(rows, out, "other", plus(0))) == {("1", z, 1) for z in range(3)} | {("2", z, 2) for z in range(3)}
    assert files.stored(spark, out, "label").where("error IS NOT NULL").count() == 1  # made again, still no volume


def header(data, order="<", slope=1.0, inter=0.0, sform=None, qform=None, zooms=(1.0, 1.0, 1.0), dims=None, qfac=1.0):
    head = bytearray(352)
    struct.pack_into(order + "i", head, 0, 348)
    struct.pack_into(order + "8h", head, 40, *(dims or (3, *data.shape, 1, 1, 1, 1)))
    struct.pack_into(order + "2h", head, 70, 4, 16)
    struct.pack_into(order + "8f", head, 76, qfac, *zooms, 0, 0, 0, 0)
    struct.pack_into(order + "3f", head, 108, 352.0, slope, inter)
    struct.pack_into(order + "2h", head, 252, 1 if qform else 0, 1 if sform is not None else 0)
    if qform:
        struct.pack_into(order + "6f", head, 256, *qform)
    if sform is not None:
        struct.pack_into(order + "12f", head, 280, *np.asarray(sform)[:3].ravel())
    head[344:348] = b"n+1\x00"
    return bytes(head) + data.astype(order + "i2").tobytes(order="F")


def test_headers():
    data = np.arange(24).reshape(2, 3, 4)
    for slope, inter, want in ((float("nan"), 5.0, data), (0.0, 5.0, data), (1.0, 0.0, data), (2.0, -1.0, 2 * data - 1), (1.0, 3.0, data + 3)):
        for order in "<>":
            assert (files.decode(header(data, order, slope, inter))[0] == want).all()
    # half a turn about z, with an offset and a flipped third axis
    _, affine, _ = files.decode(header(data, qform=(0.0, 0.0, 1.0, 10.0, 20.0, 30.0), zooms=(1.5, 2.0, 5.0), qfac=-1.0))
    assert np.allclose(affine, [[-1.5, 0, 0, 10], [0, -2.0, 0, 20], [0, 0, -5.0, 30], [0, 0, 0, 1]])
    assert np.allclose(files.decode(header(data, zooms=(1.5, 2.0, 5.0)))[1], np.diag([1.5, 2.0, 5.0, 1.0]))
    with pytest.raises(ValueError):
        files.decode(header(data, dims=(4, 2, 3, 2, 2, 1, 1, 1)))
    turned, new, spacing = files.oriented(data, np.array([[0, 2.0, 0, 1], [-1.0, 0, 0, 2], [0, 0, 3.0, 3], [0, 0, 0, 1.0]]), (1.0, 2.0, 3.0))
    assert turned.shape == (3, 2, 4) and spacing == (2.0, 1.0, 3.0) and np.allclose(new, [[2, 0, 0, 1], [0, 1, 0, 1], [0, 0, 3, 3], [0, 0, 0, 1]])
    assert all(turned[y, 1 - x, z] == data[x, y, z] for x, y, z in np.ndindex(2, 3, 4))


def test_inputs_and_sinks(spark, tmp_path):
    for name in ("a.1.nii.gz", "b.nii", ".hidden"):
        (tmp_path / name).write_bytes(b"x")
    for sub in ("s1", "s2"):
        (tmp_path / "series" / sub).mkdir(parents=True)
    for name in ("s1/1", "s1/2", "s2/1"):
        (tmp_path / "series" / name).write_bytes(b"x")
    assert {r["case_id"] for r in files.inputs(spark, str(tmp_path)).collect()} == {"a", "b"}
    for content in ({"testing": [{"image": "a.1.nii.gz"}, {"image": "no.nii"}]}, ["a.1.nii.gz", "gone/x.nii"], [{"image": str(tmp_path / "a.1.nii.gz")}]):
        (tmp_path / "l.json").write_text(json.dumps(content))
        assert [r["case_id"] for r in files.inputs(spark, str(tmp_path / "l.json")).collect()] == ["a"]
    with pytest.raises(ValueError):
        files.inputs(spark, str(tmp_path / "x.txt"))
    assert [(r["dir"][-2:], r["n"]) for r in files.series_folders(spark, str(tmp_path / "series")).collect()] == [("s1", 2)]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "c1.csv").write_text('PatientSex,F,more\nPatientSize,"1,80"\nnothing\nPatientSex,M\n')
    pairs = files.metadata_pairs(spark, str(tmp_path / "m"))
    row = cases.pivoted(pairs, ["PatientSex", "PatientSize"])
    assert [tuple(r) for r in row.collect()] == [("c1", "M", "1,80")]
    assert {tuple(r) for r in files.unpivoted(row, ["PatientSex", "PatientSize"]).collect()} == {("c1", "PatientSex", "M"), ("c1", "PatientSize", "1,80")}
    out = str(tmp_path / "out")
    for rows in ([(1, "x"), (2, "x")], [(2, "y")]):
        files.write_frame(spark.createDataFrame(rows, "case_no int, v string"), out)
    assert {(r["case_no"], r["v"]) for r in spark.read.option("header", True).csv(out).collect()} == {(1, "x"), (2, "y")}
    dates = spark.createDataFrame([("a", "20240229"), ("b", "20241399"), ("c", None)], "case_id string, d string")
    assert [tuple(r) for r in cases.date_errors(dates, "d").collect()] == [("b", "no date: 20241399")]
    assert dates.select(cases.path_of("labels/{case}_x.nii.gz", F.col("case_id")).alias("p")).first()["p"] == "labels/a_x.nii.gz"


def test_scans_to_results(spark, tmp_path):
    """Two scans of other size, spacing and orientation, and faulty ones, from files to areas, against NumPy."""
    rng = np.random.default_rng(9)
    kinds = {"p1": ((8, 7, 6), (1.5, 1.0, 5.0), (1, 1, 1)), "p2": ((6, 9, 5), (0.5, 2.0, 2.0), (-1, -1, 1)), "flip": ((5, 5, 4), (1.0, 1.0, 1.0), (1, 1, -1))}
    for n in ("image", "tissue", "vert"):
        (tmp_path / n).mkdir()
    want = {}
    for case, (shape, spacing, signs) in kinds.items():
        hu, tissue = rng.integers(-250, 200, shape), rng.integers(0, 4, shape)
        vert = np.zeros(shape, int)
        vert[:, :, :] = 15
        affine = np.diag([*(g * v for g, v in zip(signs, spacing)), 1.0])
        for n, data in (("image", hu), ("tissue", tissue), ("vert", vert)):
            (tmp_path / n / f"{case}.nii.gz").write_bytes(files.encode(data.astype("<i2"), affine, spacing))
        muscle, fat = np.isin(tissue, (3, 4)), (hu >= -190) & (hu <= -30)
        new = np.where(muscle & fat, 5, np.where(muscle & ~((hu >= -29) & (hu <= 150)), 0, np.where(np.isin(tissue, (1, 2)) & ~fat, 0, tissue)))
        new = new[:, :, ::-1] if signs[2] < 0 else new
        depth = shape[2]
        want[case] = {z: {k: round(float((new[:, :, z] == k).sum()) * (float(np.float32(spacing[0])) * float(np.float32(spacing[1])))) for k in range(1, 6)} for z in range(depth - 1)}
    (tmp_path / "image" / "bad.nii.gz").write_bytes(b"no volume")
    (tmp_path / "image" / "alone.nii.gz").write_bytes(files.encode(np.zeros((2, 2, 2), "<i2"), np.eye(4), (1.0, 1.0, 1.0)))
    for n, spacing in (("image", (1.0, 1.0, 1.0)), ("tissue", (1.0, 1.0, 2.0)), ("vert", (1.0, 1.0, 1.0))):
        (tmp_path / n / "odd.nii.gz").write_bytes(files.encode(np.full((3, 3, 3), 15, "<i2"), np.diag([*spacing, 1.0]), spacing))
    for n in ("image", "tissue", "vert"):
        (tmp_path / n / "none.nii.gz").write_bytes(files.encode(np.zeros((3, 3, 3), "<i2"), np.eye(4), (1.0, 1.0, 1.0)))
    out = methods.run_files(spark, str(tmp_path / "image"), {n: str(tmp_path / n) for n in ("tissue", "vert")}, "lumbar_quick", min_voxels=12)
    got = {}
    for r in out["raw"].collect():
        got.setdefault(r["case_no"], {})[r["slice"]] = {k: r[c] for k, c in zip(range(1, 6), frame.MEASURES)}
        assert r["level"] == "L3"
    assert got == want
    errors = {}
    for r in out["errors"].collect():
        errors.setdefault(r["case_no"], set()).add(r["error"])
    assert set(errors) == {"bad", "alone", "odd", "none"} and errors["none"] == {"no vertebral level found"} and errors["odd"] == {"tissue: affines differ"}
    packed = files.packed_volumes(files.volumes(spark, str(tmp_path / "image"), "image").where("case_id = 'p1'"))
    files.write_volumes(packed, str(tmp_path / "again"))
    a, b = (files.decode((tmp_path / d / "p1.nii.gz").read_bytes()) for d in ("again/image", "image"))
    assert (a[0] == b[0]).all() and np.allclose(a[1], b[1])


@pytest.mark.parametrize("how", [{"median": (3, 3), "clip": (-150, 120)}, {"least_mm2": {"imat": 5.0, "sm": 4.0}}, {"least_mm3": {"imat": 20.0, "vat": 16.0}}])
def test_tissue_options(spark, how):
    """Denoising and size filters inside the tissue mask against NumPy."""
    rng = np.random.default_rng(12)
    shape = (6, 7, 4)
    hu, tissue = rng.integers(-250, 200, shape), rng.integers(0, 4, shape)
    df = spark.createDataFrame([(1, *i, int(hu[i]), int(tissue[i])) for i in np.ndindex(shape)], "case_no int, x int, y int, z int, hu int, tissue int")
    p = TissueParams(**how)
    got = slices.unstacked(methods.tissues(slices.stacked(df, ("hu", "tissue"), shape, (1.0, 2.0, 1.0)), Method(tissue=p)), ("tissue",)).collect()
    if p.clip:
        hu = np.clip(hu, *p.clip)
    if p.median:
        wide = np.pad(hu, ((1, 1), (1, 1), (0, 0)), mode="symmetric")
        hu = np.stack([np.median(np.lib.stride_tricks.sliding_window_view(wide[:, :, z], (3, 3)).reshape(6, 7, 9), axis=2) for z in range(4)], axis=2)

    def big(name, mask):
        for z in range(4):
            if p.least_mm2.get(name):
                mask[:, :, z] = morph.large_ones(mask[:, :, z], p.least_mm2[name] / 2)
        return morph.large_ones(mask, p.least_mm3[name] / 2) if p.least_mm3.get(name) else mask

    out = tissue.copy()
    out[big("imat", (hu >= -190) & (hu <= -30)) & np.isin(out, (3, 4))] = 5
    for name, labels, (low, high) in (("sm", (3, 4), p.sm), ("vat", (2,), p.vat), ("sat", (1,), p.sat)):
        out[big(name, np.isin(out, labels) & ~((hu >= low) & (hu <= high)))] = 0
    assert all(r["tissue"] == out[r["x"], r["y"], r["z"]] for r in got) and len(got) == out.size


@pytest.mark.parametrize("name", ["whole_trunk", "lumbar_quick"])
def test_methods_of_mixed_spacing(spark, middle, name):
    """Cases of other shapes and spacings in one run equal runs of their own."""
    v = synthetic.voxels(spark, middle).where("case_no < 2").where("case_no = 0 or (x < 4 and z < 16)")
    kinds = {0: ((5, 10, 20), (1.5, 1.5, 5.0)), 1: ((4, 10, 16), (0.7, 0.9, 2.5))}
    volumes = spark.createDataFrame([(c, *n, *s) for c, (n, s) in kinds.items()], "case_no int, nx int, ny int, nz int, sx double, sy double, sz double")
    got = methods.run(slices.stacked(v, methods.needed(name), volumes=volumes), name, 12)["raw"]
    for c, (n, s) in kinds.items():
        want = methods.run(slices.stacked(v.where(f"case_no = {c}"), methods.needed(name), n, s), name, 12)["raw"]
        assert sorted(map(str, got.where(f"case_no = {c}").collect())) == sorted(map(str, want.collect()))
    if name == "whole_trunk":
        assert got.where("case_no = 1").count() == 16


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert {n for n in __spark_entry__.oracle_sql()} <= set(__spark_entry__.queries())
