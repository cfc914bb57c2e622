import os

from daygrain.functions import storage


def test_a_run_leaves_nothing_behind(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(storage, "_written", [])
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base))
    table = storage.reliable(spark.range(5))
    assert table.count() == 5 and len(set(os.listdir(base)) - before) == 1
    assert storage.remove_stored(spark) == 1 and storage.remove_stored(spark) == 0
    assert set(os.listdir(base)) == before


class _Session:
    """The settings of a session that names no checkpoint folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return "file:/shared/warehouse/" if key == "spark.sql.warehouse.dir" else default


def test_folder_of_a_session_that_names_none():
    assert storage.checkpoint_base(_Session) == "file:/shared/warehouse/_checkpoints"
