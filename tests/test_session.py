import threading
import time

import pytest
from outpost.session import cancel, tagged
from pyspark.sql import functions as F


def test_cancel_by_tag(spark):
    failed, slow = [], F.udf(lambda x: time.sleep(2) or x, "long")

    def work():
        with tagged(spark, "slow"):
            try:
                spark.range(0, 64, 1, 64).select(slow("id")).collect()
            except Exception as e:  # noqa: BLE001
                failed.append(str(e))

    t = threading.Thread(target=work)
    t.start()
    time.sleep(4)
    began = time.time()
    while t.is_alive() and time.time() < began + 20:
        cancel(spark, "slow")
        t.join(0.5)
    assert not t.is_alive() and failed
    cancel(spark, "nothing")


def test_errors_keep_their_kind(spark):
    from pyspark.errors import AnalysisException, PySparkException

    with pytest.raises(AnalysisException):
        spark.sql("select nope from range(3)")
    with pytest.raises(PySparkException, match="stop here"):
        spark.sql("select raise_error('stop here') from range(3)").collect()
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        spark.sql("select cast('x' || id as int) from range(3)").collect()
