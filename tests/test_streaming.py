"""The micro-batch competitor upsert equals the batch procedure."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quillprice.plans.competitor import competitor_incremental_upsert
from quillprice.sources.fixtures import Fixtures
from quillprice.streaming.competitor_stream import SheetVersions, start_competitor_stream


def _run(spark, tmp_path, files, max_files):
    fx = Fixtures(spark, SF_SMALL)
    feed = fx.comp_feed
    feed_dir = str(tmp_path / "feed")
    feed.repartition(files, "MFRLINE").write.parquet(feed_dir)
    q = start_competitor_stream(spark, feed_dir, feed.schema, fx.line_map,
                                str(tmp_path / "sheet"), str(tmp_path / "ckpt"),
                                initial_sheet=fx.comp_sheet, max_files_per_trigger=max_files)
    q.awaitTermination(300)
    assert q.exception() is None
    return fx, feed, SheetVersions(spark, str(tmp_path / "sheet")).read()


def test_single_batch_equals_batch_pipeline(spark, tmp_path):
    fx, feed, streamed = _run(spark, tmp_path, 3, None)
    batch = competitor_incremental_upsert(feed, fx.line_map, fx.comp_sheet)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_marks_only_move_forward(spark, tmp_path):
    fx, feed, streamed = _run(spark, tmp_path, 4, 1)
    old_mark = fx.comp_sheet.agg(F.max("PS_Date_Created")).first()[0]
    new_mark = streamed.agg(F.max("PS_Date_Created")).first()[0]
    assert new_mark >= old_mark
    assert streamed.count() >= fx.comp_sheet.count()


def test_a_foreign_or_emptied_checkpoint_is_refused(spark, tmp_path):
    import pytest
    fx, feed, streamed = _run(spark, tmp_path, 2, None)
    before = sorted(map(tuple, streamed.collect()))
    for checkpoint in ("other", "ckpt"):
        if checkpoint == "ckpt":
            (tmp_path / "ckpt").rename(tmp_path / "moved")
        with pytest.raises(ValueError):
            start_competitor_stream(spark, str(tmp_path / "feed"), feed.schema, fx.line_map,
                                    str(tmp_path / "sheet"), str(tmp_path / checkpoint),
                                    initial_sheet=fx.comp_sheet)
    assert sorted(map(tuple, SheetVersions(spark, str(tmp_path / "sheet")).read().collect())) == before
