"""Archiving after a run that died half-way."""

from helpers import rows

from tidemark.plans.housekeeping import archive_files
from tidemark.plans.warehouse import CONTROL, Warehouse

NOW = "2024-03-01 00:00:00"


def test_nothing_is_archived_twice(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path))
    data = [(k, "t", "f", str(k), "p", k != 3, f"2024-0{1 + k % 2}-20 00:00:00", None, "CC" if k else "PC", 1) for k in range(6)]
    schema = CONTROL["file_loads"].replace("insert_date_time timestamp", "insert_date_time string")
    files = spark.createDataFrame(data, schema.replace("update_date_time timestamp", "update_date_time string"))
    files = files.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in CONTROL["file_loads"].split(", ")])
    wh.control("file_loads").write(files)
    store = type(wh.control("file_loads"))
    plain = store.write

    def dies(self, df):
        raise OSError("lost")

    monkeypatch.setattr(store, "write", dies)
    try:
        archive_files(wh, "CC", NOW)
    except OSError:
        pass
    monkeypatch.setattr(store, "write", plain)
    assert wh.control_rows("file_loads").count() == 6
    for _ in range(2):
        archive_files(wh, "CC", NOW)
        assert rows(wh.control_rows("file_loads_archive"), "file_load_id") == [(2,), (4,)]
        assert rows(wh.control_rows("file_loads"), "file_load_id") == [(0,), (1,), (3,), (5,)]
