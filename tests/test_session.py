from clanweave.plans import catalog
from clanweave.session import materialize, release


def test_release_removes_scratch_tables(spark):
    catalog.forget_views()
    release(spark)
    df = materialize(spark.range(5).toDF("x"))
    assert df.count() == 5
    assert release(spark) == 1 and release(spark) == 0
    assert not spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]))
