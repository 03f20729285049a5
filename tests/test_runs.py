"""Runs: all tables of a procedure become current at once, and a repeated run changes nothing."""

import pytest

from conftest import SF_SMALL
from quillprice.operators.routines import PricingInputs
from quillprice.plans import procedures as P
from quillprice.sources.fixtures import LOAD_TS, Fixtures
from quillprice.sources.runs import ConcurrentRun, Run, current, published


def table(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "v string")


def read(spark, root, name):
    df = published(spark, root, name)
    return None if df is None else sorted(r.v for r in df.collect())


def test_readers_see_all_of_a_run_or_nothing(spark, tmp_path):
    root = str(tmp_path)
    first = Run(spark, root, "one")
    for name in ("staging", "matrix", "queue"):
        first.publish(table(spark, f"old {name}"), name)
        assert read(spark, root, name) is None
    first.commit()
    names = ["staging", "matrix", "queue"]
    for failing in range(4):
        run = Run(spark, root, f"failing {failing}")
        for name in names[:failing]:
            assert [r.v for r in run.publish(table(spark, "new"), name).collect()] == ["new"]
        del run                                        # the run fails here
        assert [read(spark, root, n) for n in names] == [[f"old {n}"] for n in names]
    second = Run(spark, root, "two")
    second.publish(table(spark, "new"), "matrix")
    second.commit()
    assert [read(spark, root, n) for n in names] == [["old staging"], ["new"], ["old queue"]]
    assert current(spark, root)["runs"] == {"one": sorted(names), "two": ["matrix"]}


def test_an_append_under_the_same_id_leaves_its_rows_once(spark, tmp_path):
    root = str(tmp_path)
    for run_id, row in (("a", "1"), ("a", "1"), ("b", "2"), ("a", "1"), ("b", "2"), (None, "3"), (None, "3")):
        run = Run(spark, root, run_id)
        got = run.append(table(spark, row), "queue")
        assert row in [r.v for r in got.collect()]
        run.commit()
    assert read(spark, root, "queue") == ["1", "2", "3", "3"]
    # Rows of an attempt that failed before its commit are not there after it was repeated.
    Run(spark, root, "c").append(table(spark, "4"), "queue")
    run = Run(spark, root, "c")
    run.append(table(spark, "4"), "queue")
    run.append(table(spark, "5"), "queue")
    run.commit()
    assert read(spark, root, "queue") == ["1", "2", "3", "3", "4", "5"]


def test_of_two_runs_at_once_one_is_refused_whole(spark, tmp_path):
    root = str(tmp_path)
    one, two = Run(spark, root), Run(spark, root)
    one.publish(table(spark, "one"), "matrix")
    two.publish(table(spark, "two"), "matrix")
    two.publish(table(spark, "two"), "queue")
    one.commit()
    with pytest.raises(ConcurrentRun):
        two.commit()
    assert read(spark, root, "matrix") == ["one"] and read(spark, root, "queue") is None
    assert current(spark, root)["number"] == 1


def test_a_procedure_that_fails_at_any_step_leaves_the_tables_of_the_run_before(spark, tmp_path):
    fx, root = Fixtures(spark, SF_SMALL), str(tmp_path)
    first = Run(spark, root, "day 1")
    P.price_sheet_procedure(PricingInputs.from_fixtures(fx, LOAD_TS), fx.matrix, fx.upload_queue, first.publish)
    before = first.commit()["tables"]
    assert sorted(before) == ["landing", "matrix", "queue", "temp_price_load"]
    for failing in range(4):
        run, done = Run(spark, root, "day 2"), []

        def publish(df, name):
            if len(done) == failing:
                raise OSError("lost")
            done.append(name)
            return run.publish(df, name)
        with pytest.raises(OSError):
            P.price_sheet_procedure(PricingInputs.from_fixtures(fx, LOAD_TS), fx.matrix, fx.upload_queue, publish)
        assert len(done) == failing and current(spark, root)["tables"] == before


GROUPED = "k string, v int"


def add(spark, rows):
    """A refresh that adds rows to their groups."""
    return lambda old: old.unionByName(spark.createDataFrame(rows, GROUPED))


def refresh(spark, root, rows, initial=()):
    run = Run(spark, root)
    added = spark.createDataFrame(rows, GROUPED)
    run.refresh_groups("t", "k", spark.createDataFrame(list(initial), GROUPED), added.select("k"), add(spark, rows))
    return run.commit()["tables"]["t"]


def pairs(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=str)


def test_a_refresh_writes_and_reads_touched_groups_only(spark, tmp_path):
    root = str(tmp_path)
    names = ["a", "b/c", "d=%1", "", None, "{x}*", "ä ö", "1", "01", "2017-01-01"]
    rows = [(n, i) for i, n in enumerate(names)]
    first = refresh(spark, root, [], rows)
    assert len(first) == len(names)
    seen, run = [], Run(spark, root)

    def change(old):
        seen.extend(old.inputFiles())
        return old.selectExpr("k", "v + 100 AS v")
    run.refresh_groups("t", "k", None, spark.createDataFrame([("b/c",), (None,), ("01",), ("new",)], "k string"), change)
    second = run.commit()["tables"]["t"]
    kept = set(first) & set(second)
    assert len(kept) == len(names) - 3 and len(second) == len(names)
    assert seen and not any(k.rsplit("/", 1)[1] == f.rsplit("/", 2)[1] for k in kept for f in seen)
    want = [(k, v + 100 if k in ("b/c", None, "01") else v) for k, v in rows]
    assert pairs(published(spark, root, "t")) == sorted(want, key=str)


def test_groups_of_an_empty_table_and_a_group_that_ends_empty(spark, tmp_path):
    root = str(tmp_path)
    assert refresh(spark, root, []) == []
    assert pairs(published(spark, root, "t")) == []
    assert len(refresh(spark, root, [("a", 1), ("b", 2)])) == 2
    run = Run(spark, root)
    left = run.refresh_groups("t", "k", None, spark.createDataFrame([("a",)], "k string"), lambda old: old.filter("false"))
    assert pairs(left) == [("b", 2)]
    assert pairs(published(spark, root, "t")) == [("a", 1), ("b", 2)]          # not committed yet
    run.commit()
    assert pairs(published(spark, root, "t")) == [("b", 2)]
    with pytest.raises(ValueError, match="kept by groups"):
        Run(spark, root).append(left, "t")
    with pytest.raises(ValueError, match="kept by k"):
        Run(spark, root).refresh_groups("t", "v", None, left, lambda old: old)
    whole = Run(spark, root)
    whole.publish(left, "t")
    whole.commit()
    assert pairs(published(spark, root, "t")) == [("b", 2)] and current(spark, root)["groups"] == {}


def test_values_equal_under_a_collation_share_a_group(spark, tmp_path):
    from quillprice.functions.collation import collated
    root, lcase = str(tmp_path), "UTF8_LCASE_RTRIM"
    run = Run(spark, root)
    start = collated(spark.createDataFrame([("Ab ", 1), ("b", 2)], GROUPED), lcase)
    run.refresh_groups("t", "k", start, start.select("k"), lambda old: old)
    run.commit()
    run = Run(spark, root)
    touched = spark.createDataFrame([("aB",)], "k string")
    got = run.refresh_groups("t", "k", None, touched, lambda old: old.filter(old.k != "AB"))
    assert pairs(got) == [("b", 2)] and got.schema["k"].dataType.collation == lcase
    with pytest.raises(ValueError, match="groups are of text"):
        Run(spark, root).refresh_groups("u", "k", collated(start, "UNICODE_CI"), touched, lambda old: old)


def test_the_matrix_by_price_group_equals_the_whole_refresh(spark, tmp_path):
    from quillprice.plans import market
    fx, root = Fixtures(spark, SF_SMALL), str(tmp_path)
    inp = PricingInputs.from_fixtures(fx, LOAD_TS)
    whole = P.price_sheet_procedure(inp, fx.matrix, fx.upload_queue, Run(spark, root).publish)
    run = Run(spark, root)
    made = P.price_sheet_procedure(inp, fx.matrix, fx.upload_queue, run.publish, None, run.refresh_groups)
    first = run.commit()["tables"]["matrix"]
    assert made["matrix"].exceptAll(whole["matrix"]).isEmpty() and whole["matrix"].exceptAll(made["matrix"]).isEmpty()
    # A second sheet with prices of one group: the folders of the others stay.
    group = made["staging"].selectExpr("min(PriceGroup) g").first().g
    st = made["staging"].filter(made["staging"].PriceGroup == group).withColumn("CalcPrice", made["staging"].CalcPrice + 1)
    run = Run(spark, root)
    part = run.refresh_groups("matrix", "PriceGroup", None, st.select("PriceGroup"),
                              lambda old: market.market_price_matrix_refresh(old, st))
    second = run.commit()["tables"]["matrix"]
    assert len(first) > 2 and len(set(first) - set(second)) == 1 and len(second) == len(first)
    want = market.market_price_matrix_refresh(whole["matrix"], st)
    assert part.exceptAll(want).isEmpty() and want.exceptAll(part).isEmpty()
