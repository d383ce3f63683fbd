from meshloom.streaming import monthly


def test_ingest_takes_up_new_months_once(spark, tmp_path):
    src, out = str(tmp_path / "steps"), str(tmp_path / "means")

    def add(month, *values):
        rows = [(f"/r/clmforc.v.T.2000-{month:02}.nc", i, c, v + c) for c in range(2) for i, v in enumerate(values)]
        spark.createDataFrame(rows, monthly.STEPS).coalesce(1).write.mode("append").parquet(src)

    def take():
        monthly.ingest(spark, src, out, str(tmp_path / "state"), "T", 2000, 2000).awaitTermination()
        return {r.cell: r.series for r in monthly.months(spark, out).collect()}

    add(2, 1.0, 3.0)
    assert take() == {0: [2.0], 1: [3.0]}
    add(1, 5.0, float("nan"))
    assert take() == {0: [5.0, 2.0], 1: [6.0, 3.0]}
    assert take() == {0: [5.0, 2.0], 1: [6.0, 3.0]}
