"""Arrow files: versions that appear whole, merged schemas, patterns."""

import os
from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from drayage import registry
from drayage.sources import arrow_ipc, arrow_schema


def put(path, table):
    path.parent.mkdir(parents=True, exist_ok=True)
    with pa.ipc.new_file(str(path), table.schema) as out:
        out.write_table(table)


def values(spark, path, **options):
    return sorted(r["id"] for r in registry.read(spark, "arrow", path=str(path), **options).collect())


class Crash(Exception):
    pass


class Fragile:
    """A local file system that dies before its n-th change."""

    def __init__(self, system, steps):
        self._system, self._left = system, steps

    def __getattr__(self, name):
        call = getattr(self._system, name)
        if name not in ("move", "delete_file", "delete_dir", "create_dir", "open_output_stream"):
            return call

        def change(*args, **options):
            if self._left == 0:
                raise Crash(name)
            self._left -= 1
            return call(*args, **options)

        return change


@pytest.mark.parametrize("overwrite", [False, True])
@pytest.mark.parametrize("logged", [False, True])
def test_a_crash_between_any_two_steps_leaves_one_version(spark, tmp_path, monkeypatch, overwrite, logged):
    schema = T.StructType([T.StructField("id", T.LongType())])
    batch = lambda *ids: pa.record_batch({"id": pa.array(ids, pa.int64())})
    old, new = [1, 2, 3], ([7, 8, 9] if overwrite else [1, 2, 3, 7, 8, 9])
    done = False
    for steps in range(40):
        folder = tmp_path / f"{steps}"
        put(folder / "other.arrow", pa.table({"id": [3]}))
        if logged:
            registry.write(spark.createDataFrame([(1,), (2,)], schema).coalesce(1), "arrow", path=str(folder))
        else:
            put(folder / "more.arrow", pa.table({"id": [1, 2]}))
        writer = arrow_ipc.ArrowWriter(schema, {"path": str(folder)}, overwrite)
        messages = [writer.write(iter([batch(7, 8)])), writer.write(iter([batch(9)])), None]
        real = arrow_ipc.open_path
        fragile = lambda path: (Fragile(real(path)[0], steps), real(path)[1])  # noqa: B023, E731
        monkeypatch.setattr(arrow_ipc, "open_path", fragile)
        try:
            writer.commit(messages)
            done = True
        except Crash:
            pass
        monkeypatch.setattr(arrow_ipc, "open_path", real)
        found = sorted(
            v for f in arrow_ipc.list_files(str(folder))[1] for v in pa.ipc.open_file(f.path).read_all()["id"].to_pylist()
        )
        assert found in (old, new), steps
        if done:
            assert found == new and not list(folder.glob("_staging*"))
            break
    assert done and steps > 5
    assert values(spark, folder) == new
    if overwrite:
        assert len(list(folder.glob("*.arrow"))) == 2


def test_of_two_writers_of_one_version_one_goes_on_to_the_next(tmp_path):
    system, folder = arrow_ipc.open_path(str(tmp_path))
    arrow_ipc.publish_version(system, folder, 0, ["a.arrow"])
    with pytest.raises(arrow_ipc.VersionTaken):
        arrow_ipc.publish_version(system, folder, 0, ["b.arrow"])
    assert arrow_ipc.files_of(system, folder, 0) == ["a.arrow"] and os.listdir(tmp_path / "_log") == ["0.json"]


def test_patterns_in_any_part(spark, tmp_path):
    for n, name in enumerate(("a1/x/p.arrow", "a2/x/p.arrow", "a2/y/q.arrow", "b/x/p.arrow", "a2/x/p.txt")):
        put(tmp_path / name, pa.table({"id": [n]}))
    assert values(spark, tmp_path / "a*" / "x" / "*.arrow") == [0, 1]
    assert values(spark, tmp_path / "a[2-9]" / "?" / "*.arrow") == [1, 2]
    assert values(spark, tmp_path / "*" / "x" / "p.arrow") == [0, 1, 3]
    with pytest.raises(Exception, match="no Arrow file"):
        values(spark, tmp_path / "c*" / "*.arrow")


def test_added_and_widened_columns_are_read_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrow_schema, "FOOTERS_PER_TASK", 1)
    monkeypatch.setattr(arrow_schema, "SCHEMAS_PER_TASK", 2)
    tables = [
        pa.table({"id": pa.array([1], pa.int8()), "d": [date(2024, 1, 2)], "s": [{"x": 1}]}),
        pa.table({"id": pa.array([2**40], pa.int64()), "n": pa.array([1.5], pa.float32())}),
        pa.table({"n": pa.array([7], pa.int32()), "id": pa.array([3], pa.int32()), "s": [{"y": "t", "x": 2.5}]}),
        pa.table({"id": pa.array([None], pa.null()), "d": pa.array([datetime(2024, 1, 3, 4)], pa.timestamp("us"))}),
    ]
    for number, table in enumerate(tables):
        put(tmp_path / f"{number}.arrow", table)
    frame = registry.read(spark, "arrow", path=str(tmp_path), mergeSchema="true")
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    assert kinds == {"id": "bigint", "d": "timestamp_ntz", "s": "struct<x:double,y:string>", "n": "double"}
    rows = {r["id"]: r for r in frame.collect()}
    assert set(rows) == {1, 2**40, 3, None} and rows[3]["n"] == 7.0 and rows[2**40]["n"] == 1.5
    assert rows[1]["d"] == datetime(2024, 1, 2) and rows[None]["d"] == datetime(2024, 1, 3, 4)
    assert rows[3]["s"].asDict() == {"x": 2.5, "y": "t"} and rows[1]["s"].asDict() == {"x": 1.0, "y": None}


def test_widening_is_an_order():
    kinds = [T.ByteType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(5, 2), T.DecimalType(30, 10), T.DateType(),
             T.TimestampNTZType(), T.StringType(), T.NullType(), T.ArrayType(T.ByteType())]

    def join(a, b):
        try:
            return arrow_schema.wider(a, b)
        except TypeError:
            return None

    for a in kinds:
        assert join(a, a) == a
        for b in kinds:
            assert join(a, b) == join(b, a)
            for c in kinds:
                left, right = join(a, b) and join(join(a, b), c), join(b, c) and join(a, join(b, c))
                assert left == right
    assert join(T.LongType(), T.DecimalType(5, 2)) == T.DecimalType(21, 2) and join(T.StringType(), T.LongType()) is None
    assert Decimal(1) == 1
    with pytest.raises(TypeError, match="column a"):
        arrow_schema.merged(T.StructType.fromDDL("a int"), T.StructType.fromDDL("a string"))
