import json
import os
import tempfile

from conftest import SF0001
from pyspark.sql import functions as F

from txnrisk import schema as S
from txnrisk.sources import load_transactions, read_transactions, write_transactions
from txnrisk.sources.requests import parse_request_arrays, read_requests, reply_records


def test_day_partitioned_roundtrip_prunes(spark):
    tx = load_transactions(spark, SF0001)
    path = os.path.join(tempfile.mkdtemp(prefix="txnrisk-test-"), "tx")
    write_transactions(tx, path)
    back = read_transactions(spark, path)
    assert back.count() == tx.count()
    assert back.exceptAll(tx.select(*back.columns)).count() == 0
    q = back.where(F.col(S.TX_TIME_DAYS).between(14, 20))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "TX_TIME_DAYS" in plan


def test_request_body_array_and_files(spark):
    body = json.dumps([
        {"TRANSACTION_ID": 11, "TX_DATETIME": 1704103200250, "CUSTOMER_ID": 5, "TERMINAL_ID": 6, "TX_AMOUNT": 12.5},
        {"TRANSACTION_ID": 12, "TX_DATETIME": "2024-03-10 02:30:00", "CUSTOMER_ID": 7, "TERMINAL_ID": 8, "TX_AMOUNT": 0.99}])
    frame = spark.createDataFrame([(body,)], "body string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):      # 02:30 does not exist there on that day
            spark.conf.set("spark.sql.session.timeZone", z)
            rows = {r[S.TX_ID]: r for r in parse_request_arrays(frame).collect()}
            assert str(rows[11][S.TX_DATETIME]) == "2024-01-01 10:00:00.250000"
            assert str(rows[12][S.TX_DATETIME]) == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    df = parse_request_arrays(frame)
    assert rows[12][S.TX_AMOUNT] == 0.99
    d = tempfile.mkdtemp(prefix="txnrisk-req-")
    with open(os.path.join(d, "batch.json"), "w") as fh:
        fh.write(body)
    assert read_requests(spark, d, multi_line=True).count() == 2
    out = reply_records(df.withColumn("prob_fraud", F.lit(0.25))).collect()
    assert json.loads(out[0]["value"]).keys() == {"TRANSACTION_ID", "prob_fraud"}


def test_malformed_records_are_quarantined(spark, tmp_path):
    from txnrisk.sources.requests import sort_out_arrays, sort_out_files, sort_out_lines
    good = '{"TRANSACTION_ID":1,"TX_DATETIME":1704103200250,"CUSTOMER_ID":5,"TERMINAL_ID":6,"TX_AMOUNT":1.5,"more":[1]}'
    bad = ['{"TRANSACTION_ID":2,"TX_DATETIME":17041', "", "[]", "null", '{"TX_DATETIME":1704103200250}', '{"TRANSACTION_ID":3,"TX_DATETIME":"soon"}',
           '{"TRANSACTION_ID":"x4","TX_DATETIME":1704103200250}', '{"TRANSACTION_ID":5,"CUSTOMER_ID":{"a":1}}']
    sparse = '{"TRANSACTION_ID":9}'
    parsed = sort_out_lines(spark.createDataFrame([(x,) for x in [good, sparse, *bad, None]], "value string"))
    assert sorted(r[S.TX_ID] for r in parsed.requests.collect()) == [1, 9]
    assert sorted(r["raw"] for r in parsed.quarantined.collect()) == sorted([*bad, ""])
    arrays = sort_out_arrays(spark.createDataFrame([(f"[{good}, {sparse}]",), (f"[{good},",), (f'[{sparse}, {bad[4]}, 7]',), ("[]",), (None,)], "body string"))
    assert sorted(r[S.TX_ID] for r in arrays.requests.collect()) == [1, 9, 9]
    assert sorted(r["raw"] for r in arrays.quarantined.collect()) == sorted([f"[{good},", bad[4], "7", ""])
    (tmp_path / "a.json").write_text("\n".join([good, bad[0], sparse, ""]))
    files = sort_out_files(spark, str(tmp_path))
    assert files.requests.count() == 2 and [r["raw"] for r in files.quarantined.collect()] == [bad[0]]


def test_streams_leave_malformed_records_out(spark, tmp_path):
    from txnrisk.streaming.scoring import request_stream
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"TRANSACTION_ID":1,"TX_DATETIME":"1704103200250"}\n{"TRANSACTION_ID":2,"TX\n{"CUSTOMER_ID":3}\n')
    q = (request_stream(spark, str(tmp_path / "in")).writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r[S.TX_ID] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]
