"""Volumes as streams: orientation, slabs, the data source, arrays."""

import gzip
import io
import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from sliceworks.operators import grid
from sliceworks.sources import files, nifti, source

from .test_units import header


def turn(axis, degrees):
    a, (i, j) = np.radians(degrees), [k for k in range(3) if k != axis]
    m = np.eye(3)
    m[i, i] = m[j, j] = np.cos(a)
    m[i, j], m[j, i] = -np.sin(a), np.sin(a)
    return m


@pytest.mark.parametrize("degrees", [0.0, 1e-5, 0.1, 5.0, 20.0])
def test_tilted_scans_go_to_the_nearest_axes(degrees):
    """Every order and direction of axes, tilted about all three: the voxels stay where they are in space."""
    rng = np.random.default_rng(4)
    data = rng.integers(-500, 500, (3, 4, 5)).astype("<i2")
    spacing = (0.7, 1.5, 5.0)
    for perm, signs in itertools.product(itertools.permutations(range(3)), itertools.product((1, -1), repeat=3)):
        straight = np.zeros((3, 3))
        for column, (row, sign) in enumerate(zip(perm, signs)):
            straight[row, column] = sign * spacing[column]
        affine = np.eye(4)
        affine[:3, :3] = turn(0, degrees) @ turn(1, -degrees / 2) @ turn(2, degrees / 3) @ straight
        affine[:3, 3] = (10, -20, 30)
        axes, flips = grid.canonical(affine.ravel().tolist())
        assert axes == tuple(perm.index(r) for r in range(3)) and flips == tuple(signs[perm.index(r)] < 0 for r in range(3))
        turned, new, step = files.oriented(data, affine, spacing)
        assert step == tuple(spacing[a] for a in axes) and np.allclose(np.sqrt((new[:3, :3] ** 2).sum(axis=0)), step)
        for at in ((0, 0, 0), (2, 1, 3), (1, 3, 4)):
            place = affine @ [*at, 1]
            back = np.linalg.solve(new, place)[:3]
            assert np.allclose(back, np.rint(back), atol=1e-6) and turned[tuple(np.rint(back).astype(int))] == data[at]
        # the stream gives the same slices, whole or in slabs of one
        raw = header(data, sform=affine, zooms=spacing)
        for content, slab in itertools.product((raw, gzip.compress(raw)), (1, 1 << 20)):
            got = {z: plane for _, z, plane in nifti.slices_of(lambda content=content: io.BytesIO(content), slab_bytes=slab)}
            assert all((got[z] == turned[:, :, z]).all() for z in range(turned.shape[2])) and len(got) == turned.shape[2]


def test_flat_affines_are_errors():
    for bad in (np.zeros((4, 4)), np.diag([1.0, 0.0, 1.0, 1.0]), np.array([[1.0, 1, 0, 0], [0, 0, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]), np.full((4, 4), np.nan)):
        with pytest.raises(ValueError):
            grid.canonical(bad.ravel().tolist())


def test_parts_and_ranges_read_no_more_than_they_need():
    data = np.arange(6 * 5 * 40).reshape(6, 5, 40).astype("<i2")

    class Counted(io.BytesIO):
        bytes_read = 0

        def read(self, n=-1):
            got = super().read(n)
            Counted.bytes_read += len(got)
            return got

    for sign in (1.0, -1.0):
        affine = np.diag([1.0, 1.0, sign, 1.0])
        raw = header(data, sform=affine)
        want = data if sign > 0 else data[:, :, ::-1]
        seen = {}
        for i in range(4):
            seen |= {z: p for _, z, p in nifti.slices_of(lambda: io.BytesIO(raw), part=(i, 4))}
        assert sorted(seen) == list(range(40)) and all((seen[z] == want[:, :, z]).all() for z in seen)
        Counted.bytes_read = 0
        got = [z for _, z, _ in nifti.slices_of(lambda: Counted(raw), low=10, high=12)]
        assert sorted(got) == [10, 11] and Counted.bytes_read < 348 + 2 + 3 * 6 * 5 * 2
    with pytest.raises(ValueError, match="ends before"):
        list(nifti.slices_of(lambda: io.BytesIO(raw[:-10])))
    with pytest.raises(ValueError, match="16 bits"):
        list(nifti.slices_of(lambda: io.BytesIO(header(data, slope=1e6))))


def written(spark, sf_dir, folder):
    """Volumes made of the event table: hu of each case, packed and unpacked, straight, flipped and with slices along the first axis."""
    from sliceworks.sources.synthetic import SHAPE, SPACING, voxels

    folder.mkdir()
    rows = voxels(spark, sf_dir).where("case_no < 6").select("case_no", "x", "y", "z", "hu").toPandas()
    cubes = {}
    for case, own in rows.groupby("case_no"):
        cube = np.zeros(SHAPE, "<i2")
        cube[own.x, own.y, own.z] = own.hu
        cubes[f"c{case}"] = cube
        stored, affine, spacing = cube, np.diag([*SPACING, 1.0]), SPACING
        if case % 3 == 1:
            stored, affine = cube[:, :, ::-1], np.array([[1.5, 0, 0, 0], [0, 1.5, 0, 0], [0, 0, -5.0, 95.0], [0, 0, 0, 1]])
        if case % 3 == 2:
            stored, affine, spacing = cube.transpose(2, 0, 1), np.array([[0, 1.5, 0, 0], [0, 0, 1.5, 0], [5.0, 0, 0, 0], [0, 0, 0, 1.0]]), (5.0, 1.5, 1.5)
        packed = files.encode(np.ascontiguousarray(stored), affine, spacing)
        (folder / (f"c{case}.nii.gz" if case % 2 else f"c{case}.nii")).write_bytes(packed if case % 2 else gzip.decompress(packed))
    return cubes


def cubes_of(df):
    return {(r["case_id"], r["z"]): np.frombuffer(r["data"], "<i2").reshape(r["nx"], r["ny"]) for r in df.collect()}


def test_data_source(spark, middle, tmp_path):
    cubes = written(spark, middle, tmp_path / "hu")
    (tmp_path / "hu" / "bad.nii").write_bytes(b"no volume")
    (tmp_path / "hu" / ".hidden").write_bytes(b"x")
    source.register(spark)
    read = spark.read.format("volumes").option("volumes", json.dumps({"hu": str(tmp_path / "hu"), "none": str(tmp_path / "nothing")}))
    for df in (read.load(), read.option("partbytes", 500).load(), files.volumes(spark, str(tmp_path / "hu"), "hu")):
        got = cubes_of(df.where("error IS NULL"))
        assert len(got) == 20 * len(cubes) and all((got[c, z] == cube[:, :, z]).all() for c, cube in cubes.items() for z in range(20))
        assert [r["case_id"] for r in df.where("error IS NOT NULL").collect()] == ["bad"] and {r["volume"] for r in df.collect()} == {"hu"}
    assert read.option("partbytes", 500).load().rdd.getNumPartitions() > 6
    few = read.load().where("case_id IN ('c1', 'c2') AND z >= 3 AND z < 5 AND volume = 'hu'")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert sorted(cubes_of(few)) == [(c, z) for c in ("c1", "c2") for z in (3, 4)] and "case_id" not in plan.split("Filter")[1].split("\n")[0]
    assert read.load().where("volume = 'none'").count() == 0
    with pytest.raises(Exception, match="mounted"):
        spark.read.format("volumes").load("s3://x/y").count()


def test_pushed_conditions(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, LessThanOrEqual

    for n in ("a", "b"):
        (tmp_path / f"{n}.nii").write_bytes(b"x" * 10)
    r = source.VolumeReader({"hu": str(tmp_path), "vert": str(tmp_path)}, 1 << 20)
    kept = list(r.pushFilters([EqualTo(("volume",), "hu"), In(("case_id",), ("b", "c")), GreaterThan(("z",), 4), LessThanOrEqual(("z",), 9), IsNull(("error",))]))
    assert len(kept) == 3 and (r.low, r.high) == (5, 10)
    assert [i[1:3] for p in r.partitions() for i in p.items] == [("b", "hu")]


def test_an_array_equals_its_file(spark, tmp_path):
    rng = np.random.default_rng(2)
    data = rng.integers(-900, 900, (6, 5, 9)).astype("<i2")
    affine = np.eye(4)
    affine[:3, :3] = turn(1, 12) @ np.array([[0, -1.5, 0], [0.8, 0, 0], [0, 0, 3.0]])
    (tmp_path / "tmp.nii.gz").write_bytes(files.encode(data, affine, (0.8, 1.5, 3.0)))
    want = files.volumes(spark, str(tmp_path)).orderBy("z").collect()
    got = files.from_array(spark, data, affine, spacing=(0.8, 1.5, 3.0), slab=4).orderBy("z").collect()
    assert len(got) == 9
    for a, b in zip(got, want):
        assert a.asDict(True) | {"affine": None, "spacing": None} == b.asDict(True) | {"affine": None, "spacing": None}
        assert np.allclose(a["affine"], b["affine"], atol=1e-5) and np.allclose(a["spacing"], b["spacing"])
    assert files.from_array(spark, data.astype(float) + 0.5, np.eye(4)).count() == 9
    for bad in (np.zeros((2, 2)), np.full((2, 2, 2), np.nan), np.full((2, 2, 2), 1e6)):
        with pytest.raises(ValueError):
            files.from_array(spark, bad, np.eye(4))
