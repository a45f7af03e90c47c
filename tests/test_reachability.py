from dialmesh.operators import reachability as ops


def test_report(spark):
    sites = [(i, f"https://s{i}.example") for i in range(19)] + [(19, "https://s0.example"), (20, "https://new.example")]
    log = [(u, 200, None) for _, u in sites[:13]] + [
        (sites[13][1], 404, None), (sites[14][1], 404, None), (sites[15][1], 503, None),
        (sites[16][1], 0, "no such host"), (sites[17][1], None, "bad certificate"), (sites[18][1], 200, None),
        (sites[0][1], 200, None)]
    urls = spark.createDataFrame(sites, "idx int, url string")
    results = ops.check_results(urls, spark.createDataFrame(log, "url string, status int, error string"))
    rows = results.orderBy("idx").collect()
    assert [r["idx"] for r in rows] == list(range(21))
    assert (rows[17]["status"], rows[17]["error"]) == (0, "bad certificate")
    assert (rows[20]["status"], rows[20]["error"]) == (0, "no_probe")
    assert tuple(ops.reachability_summary(results).first()) == (15, 3, 3)
    histogram = {r["status"]: r["n"] for r in ops.bad_status_histogram(results).collect()}
    assert histogram == {404: 2, 503: 1}
    good = [r["idx"] for r in ops.successful_urls(results).orderBy("idx").collect()]
    assert good == list(range(13)) + [18, 19]


def test_success_comes_before_error(spark):
    df = spark.createDataFrame([(200, "late"), (0, "x"), (301, None)], "status int, error string")
    kinds = [r[0] for r in df.select(ops.classify_status()).collect()]
    assert kinds == ["successful", "failed", "bad"]
