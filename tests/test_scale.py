"""Work that grows no faster than the input: staging by several tasks, narrow de-duplication, digests in one pass, bitmaps that are not shuffled."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dexflow import schemas, session
from dexflow.operators import checks
from dexflow.plans import events as E
from dexflow.sources import fixtures, partials, store
from dexflow.streaming import replay
from helpers import plan_text


def events(spark, ids, month=202401):
    base = {f.name: None for f in schemas.PROTOCOL_EVENTS.fields}
    rows = [tuple({**base, "id": i, "event_month": month, "timestamp": t, "protocol": "uniswap-v2"}.values()) for t, i in enumerate(ids)]
    return spark.createDataFrame(rows, schemas.PROTOCOL_EVENTS)


def test_chunks_have_equally_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "ROWS_PER_FILE", 10)
    logs, path = fixtures.decoded_logs(spark, SF_SMALL), str(tmp_path / "source")
    assert replay.stage_chunks(logs, path, 4, files_per_chunk=3) == (4, 3)
    names = replay._staged(spark, path)
    assert len(names) == 12
    spans = [spark.read.parquet(*[f"{path}/{n}" for n in names[i:i + 3]]).agg(F.min("block_number"), F.max("block_number"), F.count("*")).first()
             for i in range(0, 12, 3)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and sum(s[2] for s in spans) == logs.count()
    replay._append(logs.limit(1), path, 5)
    assert len(replay._staged(spark, path)) == 17


def test_stream_of_several_files_a_batch_equals_batch(spark, fx_dims, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "ROWS_PER_FILE", 10)
    logs = fixtures.decoded_logs(spark, SF_SMALL)
    job = replay.run_file_stream(spark, logs, fx_dims, root=str(tmp_path / "s"))
    cols = [c for c in schemas.EVENT_COLUMNS if c != "created_at"]
    batch = E.build_event_table(logs, fx_dims).select(*cols)
    assert job.files_per_batch > 1
    for _ in range(2):
        stored = spark.read.parquet(job.events_path)
        assert stored.select("batch_id").distinct().count() == 4
        assert stored.select(*cols).exceptAll(batch).count() == 0 and stored.count() == batch.count()
        replay.replay_last_batch(job, str(tmp_path / "s" / "source"))


def test_only_repeated_ids_are_sorted(spark):
    rows = events(spark, ["a", "b", "a", None, "c", None, "d"])
    assert store.repeated_ids(rows).count() == 2
    assert store.repeated_ids(rows, F.col("id") == "b").count() == 0
    once, several = store.split_repeated(rows, store.repeated_ids(rows))
    assert once.count() == 3 and several.count() == 4
    assert store.one_per_id(rows).exceptAll(store.dedupe_by_id(rows)).count() == 0
    assert store.one_per_id(rows).count() == 5


def test_copies_are_read_once_for_differences(spark, tmp_path):
    path = str(tmp_path / "base_copy")
    events(spark, [f"i{k}" for k in range(20)]).write.parquet(path)
    base = spark.read.parquet(path)
    found = checks.copy_differences({"base": base, "short": base.filter("id <> 'i3'")}, "base")
    assert "base_copy" not in plan_text(found)
    assert [(r["copy"], r["base_rows"] - r["rows"]) for r in found.collect()] == [("short", 1)]


def test_bitmaps_are_not_shuffled(spark):
    codes = spark.range(70_000).selectExpr("concat('p', id % 3) AS protocol", "concat('e', id % 2) AS event_type", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id % 2) AS hour", "id AS code")
    sets = partials.bitmaps(codes)
    assert sets.agg(F.sum(F.bitmap_count("bits"))).first()[0] == 70_000
    plan = plan_text(sets, "simple")
    assert plan.count("Exchange") == 1 and plan.index("Exchange") > plan.rindex("bitmap_construct_agg")


def test_limit_of_methods_is_only_lowered(spark):
    key, before = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        for given, want in (("65535", session.DEFAULT_CONF[key]), ("100", "100")):
            spark.conf.set(key, given)
            session.limit_methods(spark)
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)
