import os

from outpost.llm import store


def test_clear(spark):
    df = store.write_table(spark.range(5), "five")
    assert df.count() == 5 and store.tables_dir(spark).startswith(store.shared_dir(spark))
    folder = store.tables_dir(spark).removeprefix("file://")
    assert os.listdir(folder)
    store.clear(spark)
    assert not os.path.exists(folder)
    assert store.write_table(spark.range(3), "three").count() == 3
