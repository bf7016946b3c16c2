"""Event table round trip, idempotent replay, lookups."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dexflow import schemas
from dexflow.plans import catalog
from dexflow.sources import store

COLS = [c for c in schemas.EVENT_COLUMNS if c != "created_at"]


def test_round_trip(spark, tmp_path):
    ev = catalog.context(spark, SF_SMALL).events
    path = str(tmp_path / "t")
    store.write_events(ev, path, mode="overwrite")
    back = store.read_events(spark, path)
    assert back.select(*COLS).exceptAll(ev.select(*COLS)).count() == 0
    assert ev.select(*COLS).exceptAll(back.select(*COLS)).count() == 0
    assert back.schema["event_month"].dataType.simpleString() == "int"


def test_replayed_batch_replaces_itself(spark, tmp_path):
    ev = catalog.context(spark, SF_SMALL).events
    path = str(tmp_path / "t")
    store.write_events(ev, path, batch_id=0)
    store.write_events(ev.limit(10), path, batch_id=1)
    store.write_events(ev.limit(10), path, batch_id=1)     # replay of batch 1
    back = spark.read.parquet(path)
    assert back.count() == ev.count() + 10
    assert store.dedupe_by_id(back.drop("batch_id")).count() == ev.count()


def test_bloom_and_lookup(spark, tmp_path):
    ev = catalog.context(spark, SF_SMALL).events
    path = str(tmp_path / "t")
    store.write_events(ev, path, mode="overwrite", bloom=True)
    back = store.read_events(spark, path)
    hit = back.filter(F.col("pool_address") == catalog.LOOKUP_POOL).count()
    assert hit == ev.filter(F.col("pool_address") == catalog.LOOKUP_POOL).count() > 0


def test_rollup_table(spark, tmp_path):
    from dexflow.operators import reports
    ev = catalog.context(spark, SF_SMALL).events
    path = str(tmp_path / "rollup")
    store.write_rollup(reports.hourly_rollup(ev), path)
    back = spark.read.parquet(path)
    assert back.agg(F.sum("event_count")).first()[0] == ev.count()
    assert back.select("event_month").distinct().count() >= 1


def test_sample_events_round_trip(spark, tmp_path):
    """FX5: the two sample events of the reference's setup script, written and read back."""
    from dexflow.plans.events import Dimensions, build_event_table
    from dexflow.sources import dims
    seeds = spark.createDataFrame([("uniswap-v2", 1, "0xpoolv2", dims.KNOWN_TOKENS[0][0], dims.KNOWN_TOKENS[0][0]),
                                   ("uniswap-v3", 1, "0xpoolv3", dims.KNOWN_TOKENS[0][0], dims.KNOWN_TOKENS[0][0])],
                                  schemas.POOL_SEED)
    d = Dimensions(seeds, dims.known_tokens(spark))
    base = {f.name: None for f in schemas.DECODED_LOGS.fields}
    rows = [
        {**base, "chain_id": 1, "protocol": "uniswap-v2", "event_name": "Swap", "pool_address": "0xpoolv2",
         "transaction_hash": "0xsample1", "block_number": 12345, "log_index": 1, "observed_at_ms": 1704067200000,
         "sender": "0xs", "recipient": "0xr", "amount0_in": "1000000000000000000", "amount1_in": "0",
         "amount0_out": "0", "amount1_out": "2000000000000000000"},
        {**base, "chain_id": 1, "protocol": "uniswap-v3", "event_name": "Mint", "pool_address": "0xpoolv3",
         "transaction_hash": "0xsample2", "block_number": 12346, "log_index": 2, "observed_at_ms": 1704067201000,
         "sender": "0xs", "owner": "0xo", "amount0": "1000000000000000000", "amount1": "2000000000000000000",
         "liquidity": "1000000000000000000000"},
    ]
    logs = spark.createDataFrame([tuple(r[f.name] for f in schemas.DECODED_LOGS.fields) for r in rows],
                                 schemas.DECODED_LOGS)
    ev = build_event_table(logs, d)
    path = str(tmp_path / "t")
    store.write_events(ev, path, mode="overwrite")
    back = {r.id: r for r in store.read_events(spark, path).collect()}
    assert set(back) == {"0xsample1-1-swap", "0xsample2-2-mint"}
    swap, mint = back["0xsample1-1-swap"], back["0xsample2-2-mint"]
    assert (swap.token0_symbol, swap.token0_decimals, swap.event_month) == ("WETH", 18, 202401)
    assert '"amount0In":"1000000000000000000"' in swap.event_data
    assert mint.event_data == ('{"type":"mint","sender":"0xs","owner":"0xo","amount0":"1000000000000000000",'
                               '"amount1":"2000000000000000000","liquidity":"1000000000000000000000"}')


def test_kafka_style_json_values(spark):
    from dexflow.sources import tables
    raw = spark.createDataFrame([('{"chain_id": "1", "protocol": "uniswap-v3", "event_name": "Swap", '
                                  '"tick": "-12", "block_number": 7, "amount0": "-' + "9" * 77 + '"}',)], "value string")
    r = tables.decoded_logs_from_json(raw).first()
    assert (r.chain_id, r.tick, r.block_number, r.amount0) == (1, -12, 7, "-" + "9" * 77)


def test_compact_month_removes_cross_batch_duplicates(spark, tmp_path):
    ev = catalog.context(spark, SF_SMALL).events
    path, out = str(tmp_path / "t"), str(tmp_path / "c")
    store.write_events(ev, path, batch_id=0, shuffle=False)
    store.write_events(ev.limit(25), path, batch_id=1, shuffle=False)   # re-delivered rows in a later batch
    month = spark.read.parquet(path).select("event_month").first()[0]
    store.compact_month(spark, path, month, out)
    back = spark.read.parquet(out)
    assert back.count() == ev.filter(F.col("event_month") == month).count()
    assert back.select("id").distinct().count() == back.count()


def test_create_if_missing(spark, tmp_path):
    path = str(tmp_path / "fresh")
    t = store.create_if_missing(spark, path)
    assert t.count() == 0 and set(t.columns) == set(schemas.EVENT_COLUMNS)
    ev = catalog.context(spark, SF_SMALL).events
    store.write_events(ev, path)
    assert store.create_if_missing(spark, path).count() == ev.count()   # existing table left as is


def test_refresh_rollup_replaces_only_given_months(spark, tmp_path):
    from dexflow.operators import reports
    ev = catalog.context(spark, SF_SMALL).events
    from dexflow.functions import exprs as X
    shifted = ev.withColumn("timestamp", F.col("timestamp") + F.lit(31 * 24 * 3600 * 1000)) \
                .withColumn("event_month", X.year_month("timestamp")).withColumn("id", F.concat(F.lit("s-"), "id"))
    path, rollup = str(tmp_path / "t"), str(tmp_path / "r")
    store.write_events(ev.unionByName(shifted), path, mode="overwrite")
    store.write_rollup(reports.hourly_rollup(store.read_events(spark, path)), rollup)
    # late rows for January arrive (a re-delivered copy of some rows plus new ones)
    late = ev.limit(30).withColumn("id", F.concat(F.lit("late-"), "id"))
    store.write_events(late.unionByName(ev.limit(5)), path, mode="append")
    store.refresh_rollup(spark, path, rollup, [202401])
    r = spark.read.parquet(rollup)
    jan = r.filter("event_month = 202401").agg(F.sum("event_count")).first()[0]
    later = r.filter("event_month > 202401").agg(F.sum("event_count")).first()[0]
    assert jan == ev.count() + 30 and later == shifted.count()
