"""Row numbers hold between scans, however many cores there are."""

from __future__ import annotations

import pytest

from adevents.llm import contamination, jaccard_join, mixing, quality, sharding
from adevents.llm import common

from .conftest import written


@pytest.fixture(scope="module")
def many_files(spark, rows, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "seven")
    docs.repartition(7).write.parquet(path)
    return path


def _sorted(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("operator", ["good", "one_of_each", "clean", "mix", "shard", "lines"])
def test_rows_stay_the_same_when_the_cores_change_between_scans(spark, many_files, pairs, operator, monkeypatch, tmp_path):
    items = written(spark, [(1, " ".join(next(t for _, t in pairs if t and len(t) > 400).split()[:12]))], "item_id long, text string", tmp_path / "i")
    run = {
        "good": quality.keep_good,
        "one_of_each": jaccard_join.keep_one_of_each,
        "clean": lambda d: contamination.clean_documents(d, items),
        "mix": mixing.mix_documents,
        "shard": lambda d: sharding.shard_documents(d, 4),
        "lines": quality.remove_common_lines,
    }[operator]
    want = _sorted(run(spark.read.parquet(many_files)))
    module = {"good": quality, "one_of_each": jaccard_join, "clean": contamination, "mix": mixing, "shard": sharding, "lines": quality}[operator]
    settings = {"spark.sql.files.openCostInBytes": "1", "spark.sql.leafNodeDefaultParallelism": "5"}
    saved = common.saved

    def after_the_first_table(df, name):
        out = saved(df, name)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
        return out

    for name, value in settings.items():
        spark.conf.set(name, value)
    monkeypatch.setattr(module, "saved", after_the_first_table)
    if operator == "clean":
        build = contamination.build_index

        def index(*args):
            out = build(*args)
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
            return out

        monkeypatch.setattr(contamination, "build_index", index)
    try:
        assert _sorted(run(spark.read.parquet(many_files))) == want
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_tables_that_are_no_files_are_written_first(spark, rows, docs):
    in_memory = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, None)], "doc_id long, text string")
    with pytest.raises(ValueError, match="write the table first"):
        common.with_row_id(in_memory, "n")
    assert common.as_table(docs) is docs
    found = common.with_row_id(common.as_table(in_memory), "doc_ID2")
    assert found.count() == 3 == found.select("doc_ID2").distinct().count()
    assert sorted(r.doc_id for r in jaccard_join.keep_one_of_each(in_memory).collect()) in ([1, 3], [2, 3])
