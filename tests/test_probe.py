"""The probe's outcomes where an address is tried more than once."""

import os

import duckdb

from factweave.plans import catalog

SF = "/root/testdata/sf0.001"


def test_each_attempt_has_its_own_answers(spark, tmp_path):
    # u2@d1.example twice: the second attempt's accepting host breaks off, so the last one decides
    for t in os.listdir(SF):
        if t != "customer.parquet":
            os.symlink(f"{SF}/{t}", tmp_path / t)
    spark.createDataFrame([(2, 1), (6802, 1), (3, 0)], "c_custkey long, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    got = catalog.probe_outcomes(spark, str(tmp_path))
    c = duckdb.connect()
    c.execute(f"create view customer as select * from '{tmp_path}/customer.parquet/*.parquet'")
    c.execute(f"create view nation as select * from '{SF}/nation.parquet'")
    want = c.execute(f"select {', '.join(got.columns)} from ({catalog.ORACLES['probe_outcomes']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert [(r[0], r[3], r[6]) for r in sorted(want)] == [(2, "a.mx1", "ok"), (3, None, "network"), (6802, "b.mx1", "temp")]
