from __future__ import annotations

from campusgrid.session import scratch_dir


def test_scratch_folder_lies_in_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark), scratch_dir(spark)
    assert first.startswith(shared) and first != second


def test_scratch_folder_without_the_setting():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    try:
        scratch_dir(Session())
    except ValueError as error:
        assert "spark.checkpoint.dir" in str(error)
    else:
        raise AssertionError("a cluster without a shared folder must be refused")
