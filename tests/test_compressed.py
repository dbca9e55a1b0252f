import numpy as np
import pytest

from slabworks.sources import compressed as C


def entries(spark, rows):
    return spark.createDataFrame(rows, "major long, minor long, value double")


def put(folder, first, indptr, indices, data):
    folder.mkdir(parents=True)
    for name, array in (("indptr", np.array(indptr, np.int32)), ("indices", np.array(indices, np.int32)), ("data", np.array(data, np.float32))):
        np.save(folder / f"{name}.npy", array)
    (folder / "part.json").write_text(f'{{"first": {first}}}')


@pytest.mark.parametrize("piece,gap", [(4_000_000, 16_384), (7, 2), (1, 0)])
def test_round_trip_and_selections(spark, tmp_path, monkeypatch, piece, gap):
    monkeypatch.setattr(C, "PIECE", piece)
    monkeypatch.setattr(C, "GAP", gap)
    rng = np.random.default_rng(1)
    rows = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 90, 600) ** 2 // 90, rng.integers(0, 40, 600))})
    rows = [(a, b, float(i)) for i, (a, b) in enumerate(rows) if a not in (5, 6, 44)]
    path = f"file://{tmp_path}/m"
    C.write_compressed(entries(spark, rows).repartition(3), path, 95, 4)
    read = lambda wanted: sorted(tuple(r) for r in C.read_compressed(spark, path, wanted).collect())
    assert read(None) == rows
    for wanted in ([], [0], [5], [94], [3, 3, 70, 200, -1], list(range(0, 95, 7)), list(range(20, 60))):
        assert read(wanted) == [r for r in rows if r[0] in set(wanted)]


def test_arrays_of_others_are_read_by_range(spark, tmp_path):
    put(tmp_path / "m" / "part-0", 0, [0, 2, 2, 5], [1, 3, 0, 1, 2], [1, 2, 3, 4, 5])
    put(tmp_path / "m" / "part-1", 3, [0, 1], [7], [6])
    got = sorted(tuple(r) for r in C.read_compressed(spark, f"file://{tmp_path}/m", [2, 3]).collect())
    assert got == [(2, 0, 3.0), (2, 1, 4.0), (2, 2, 5.0), (3, 7, 6.0)]


def test_only_wanted_runs_are_planned():
    indptr = np.array([0, 10, 20, 20, 100_020, 100_025])
    p = list(C.pieces("p", 100, indptr, np.array([100, 101, 104, 999])))
    assert [(x.first, x.end, x.lines) for x in p] == [(0, 20, [100, 101]), (100_020, 100_025, [104])]
    assert sum(x.end - x.first for x in C.pieces("p", 0, indptr, None)) == 100_025


def test_damaged_matrices_are_errors(spark, tmp_path):
    put(tmp_path / "a" / "part-0", 0, [0, 2, 9], [1, 3], [1, 2])
    put(tmp_path / "b" / "part-0", 0, [0, 2, 1, 3], [1, 3, 4], [1, 2, 3])
    for name in "ab":
        with pytest.raises(Exception, match="pointers"):
            C.read_compressed(spark, f"file://{tmp_path}/{name}").collect()
    with pytest.raises(Exception, match="twice"):
        C.write_compressed(entries(spark, [(0, 1, 1.0), (0, 1, 2.0)]), f"file://{tmp_path}/c", 2, 1)
    with pytest.raises(Exception, match="outside"):
        C.write_compressed(entries(spark, [(7, 1, 1.0)]), f"file://{tmp_path}/d", 2, 1)
