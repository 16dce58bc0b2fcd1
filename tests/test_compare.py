from __future__ import annotations

from adevents.operators.compare import compare_results


def test_equal_after_rounding_and_duplicates(spark):
    a = spark.createDataFrame([("x", 1.00000001), ("y", 2.0), ("y", 2.0)], "k string, v double")
    b = spark.createDataFrame([("y", 2.0), ("x", 1.0)], "k string, v double")
    r = compare_results(a, b).collect()[0]
    assert (r.rows_a, r.rows_b, r.only_a, r.only_b, r.same_header, r.matched) == (2, 2, 0, 0, True, True)


def test_differences_are_counted(spark):
    a = spark.createDataFrame([("x", 1.0), ("z", None)], "k string, v double")
    b = spark.createDataFrame([("x", 1.1), ("z", None)], "k string, v double")
    r = compare_results(a, b).collect()[0]
    assert (r.only_a, r.only_b, r.matched) == (1, 1, False)


def test_header_mismatch(spark):
    a = spark.createDataFrame([("x", 1.0)], "k string, v double")
    b = spark.createDataFrame([(1.0, "x")], "v double, k string")
    r = compare_results(a, b).collect()[0]
    assert (r.same_header, r.matched, r.rows_a, r.rows_b) == (False, False, 1, 1)


def test_empty_sides(spark):
    a = spark.createDataFrame([], "k string")
    r = compare_results(a, a).collect()[0]
    assert (r.rows_a, r.rows_b, r.matched) == (0, 0, True)


def test_compare_written_results(spark, events, scratch):
    from adevents.operators.compare import compare_result_files
    from adevents.plans.answer import answer, write_reports
    from adevents.plans.prepare import prepare
    from adevents.plans.reports import SPECS

    store = prepare(events, scratch + "/store")
    sources = write_reports(spark, store, SPECS, scratch + "/out")
    assert sources == {"q1": "daily_revenue", "q2": "daily_revenue", "q3": "purchases", "q4": "counts", "q5": "revenue"}
    for name, spec in SPECS.items():
        from adevents.operators.report import report
        from adevents.sources.results import write_result_csv

        write_result_csv(report(store.events(spark), **spec), f"{scratch}/base/{name}")
        r = compare_result_files(spark, f"{scratch}/base/{name}", f"{scratch}/out/{name}").collect()[0]
        assert r.matched and r.same_header and r.rows_a == r.rows_b > 0, name
    # a spec no summary table covers falls back to the events
    _, source = answer(spark, store, select=["country", "MEDIAN(bid_price)"], group_by=["country"])
    assert source == "events"


def test_parallel_write_reports(spark, events, scratch):
    from adevents.operators.compare import compare_result_files
    from adevents.plans.answer import write_reports
    from adevents.plans.prepare import prepare
    from adevents.plans.reports import SPECS

    store = prepare(events, scratch + "/store")
    a = write_reports(spark, store, SPECS, scratch + "/seq")
    b = write_reports(spark, store, SPECS, scratch + "/par", max_parallel=5)
    assert a == b
    for name in SPECS:
        assert compare_result_files(spark, f"{scratch}/seq/{name}", f"{scratch}/par/{name}").collect()[0].matched


def test_number_suffixes_are_text(spark, scratch):
    from adevents.operators.compare import compare_result_files
    from adevents.sources.results import write_result_csv

    for name, v in (("a", "12d"), ("b", "12f"), ("c", 'a "q", b\\')):
        write_result_csv(spark.createDataFrame([(v,)], "v string"), f"{scratch}/{name}", single_file=True)
    assert not compare_result_files(spark, scratch + "/a", scratch + "/b").collect()[0].matched
    assert compare_result_files(spark, scratch + "/c", scratch + "/c").collect()[0].matched
    import glob

    text = "".join(open(f).read() for f in glob.glob(scratch + "/c/part-*.csv"))
    assert text == 'v\n"a ""q"", b\\"\n'


def test_folders_with_a_missing_result_fail(spark, scratch):
    from adevents.operators.compare import compare_result_folders
    from adevents.sources.results import write_result_csv

    one = spark.createDataFrame([(1.0000000001,)], "v double")
    write_result_csv(one, scratch + "/x/q1")
    write_result_csv(spark.createDataFrame([(1.0,)], "v double"), scratch + "/y/q1")
    write_result_csv(one, scratch + "/x/q2")
    rows = {r.query: r.status for r in compare_result_folders(spark, scratch + "/x", scratch + "/y", ["q1", "q2"]).collect()}
    assert rows == {"q1": "PASS", "q2": "FAIL"}
