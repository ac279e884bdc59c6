"""Ledger text, telemetry lines, reports and traffic."""

import json
import re

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from finsieve.constants import MODEL_FEATURES, TX_COLUMNS
from finsieve.operators import prep, telemetry as tm, validation as dq
from finsieve.sources import ledger as src, telemetry as tel

HEADER = ("Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,Amount Paid,"
          "Payment Currency,Payment Format,Is Laundering\n")


def test_scan_ledger_keeps_both_account_columns(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(HEADER + "2022/09/01 10:00,1,A1,2,A2,5.5,USD,6.5,EUR,ACH,1\n")
    row = src.parse_timestamps(src.scan_ledger_text(spark, str(tmp_path / "tx.csv"))).first()
    assert (row.account, row.counterparty, row.amount_paid, row.ts.hour) == ("A1", "A2", 6.5, 10)
    assert tuple(row.asDict()) == TX_COLUMNS


def test_missing_path_is_named(spark, tmp_path):
    with pytest.raises(AnalysisException, match="nowhere.csv"):
        src.scan_ledger_text(spark, str(tmp_path / "nowhere.csv"))


def test_bad_text_fails_or_is_kept(spark, tmp_path):
    (tmp_path / "tx.csv").write_text(HEADER + "2022/09/01 10:00,1,A1,2,A2,oops,USD,6.5,EUR,ACH,1\nnot a time,1,A,2,B,1,USD,1,USD,ACH,0\n")
    path = str(tmp_path / "tx.csv")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED|FAILED_READ_FILE"):
        src.scan_ledger_text(spark, path).collect()
    kept = src.scan_ledger_text(spark, path, "PERMISSIVE")
    assert [r._corrupt_record is not None for r in kept.collect()] == [True, False]
    with pytest.raises(Exception, match="not a time|CANNOT_PARSE"):
        src.parse_timestamps(kept).collect()
    assert src.parse_timestamps(kept, strict=False).filter("ts is null").count() == 1


def test_prepared_table_prunes_by_fold(spark, tmp_path, signal):
    path = str(tmp_path / "prepared")
    src.write_prepared(prep.split_by_hash(signal), path)
    train = src.read_prepared(spark, path, "train")
    assert "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().toString()
    assert train.count() + src.read_prepared(spark, path, "test").count() == 60000


def test_fingerprint_ignores_order_and_sees_changes(spark, signal):
    cols = ("row_id", *TX_COLUMNS)
    a = src.fingerprint(signal, cols).first()
    assert src.fingerprint(signal.orderBy(F.rand(1)).repartition(3), cols).first() == a
    assert src.fingerprint(signal.withColumn("to_bank", F.col("to_bank") + F.when(F.col("row_id") == 5, 1).otherwise(0)), cols).first() != a


def test_synthetic_traffic(spark):
    rows = src.synthetic_traffic(spark)
    assert rows.count() == 70 and set(rows.columns) == set(MODEL_FEATURES)
    by = {(r.payment_format, r.amount_paid): r for r in rows.collect()}
    assert (by["Cheque", 25.0].is_business_hours, by["Cheque", 25.0].same_account) == (0, 1)
    assert (by["Credit Card", 100.0].is_business_hours, by["Credit Card", 100.0].same_account) == (0, 0)
    assert (by["ACH", 100.0].is_business_hours, by["ACH", 100.0].same_account) == (1, 1)
    assert by["Bitcoin", 500000.0].sender_previous_tx_count == 500
    assert rows.groupBy("payment_format").count().filter("count <> 10").count() == 0


def test_reports_hold_aggregates_only(spark, tmp_path):
    path = str(tmp_path / "report")
    src.write_report(spark.createDataFrame([("x", 0.5)], "feature string, psi double"), path)
    assert spark.read.json(path).first().psi == 0.5
    for leak in ("row_id", "account"):
        with pytest.raises(src.AggregateOnlyError, match=leak):
            src.write_report(spark.range(1).select(F.struct(F.col("id").alias(leak)).alias("s")), path + leak)


ROW = {"Payment Format": "ACH", "Amount Paid": 1.5, "sender_previous_tx_count": 2, "is_business_hours": 1, "same_account": 0}
OUT = {"score": 0.9, "alert": True, "threshold": 0.5, "model_version": "0.1.0"}


def lines(tmp_path, inputs, outputs):
    for name, rows in (("inputs", inputs), ("outputs", outputs)):
        (tmp_path / name).mkdir()
        text = [r if isinstance(r, str) else json.dumps(r) for r in rows]
        (tmp_path / name / "part.txt").write_text("\n".join(text) + "\n", encoding="utf-8")
    return str(tmp_path)


def env(cid, row):
    return {"correlationid": cid, "data": [row]}


def test_clean_pairs_pass(spark, tmp_path):
    path = lines(tmp_path, ["﻿" + json.dumps(env("a", ROW)), "", "   ", env("b", ROW)], [env("b", OUT), env("a", OUT)])
    found = tel.scan_envelopes(spark, path)
    checks = tm.acceptance_checks(found).first()
    assert checks.status == "PASS" and checks.failed == []
    pairs = tm.typed_pairs(tm.pair(found)).orderBy("correlationid").collect()
    assert [p.correlationid for p in pairs] == ["a", "b"] and pairs[0].amount_paid == 1.5 and pairs[0].alert is True


def test_last_record_of_an_id_wins(spark, tmp_path):
    path = lines(tmp_path, [env("a", {**ROW, "Amount Paid": float(i)}) for i in range(50)], [env("a", OUT)])
    found = tel.scan_envelopes(spark, path)
    assert tm.typed_pairs(tm.pair(found)).first().amount_paid == 49.0
    assert tm.acceptance_checks(found).first().failed == [
        "input_output_record_counts_match", "input_correlation_ids_unique"]


@pytest.mark.parametrize("bad,missing,shape,fields", [
    ({"data": [ROW]}, 1, 0, 0), (env("", ROW), 1, 0, 0), (env(7, ROW), 1, 0, 0), (env(None, ROW), 1, 0, 0),
    ({"correlationid": "x", "data": ROW}, 0, 1, 0), ({"correlationid": "x", "data": [ROW, ROW]}, 0, 1, 0),
    ({"correlationid": "x", "data": []}, 0, 1, 0), ({"correlationid": "x", "data": [3]}, 0, 1, 0),
    ({"correlationid": "x"}, 0, 1, 0), (env("x", {**ROW, "extra": 1}), 0, 0, 1), (env("x", {"Payment Format": "ACH"}), 0, 0, 1),
])
def test_audit_defects(spark, tmp_path, bad, missing, shape, fields):
    found = tel.scan_envelopes(spark, lines(tmp_path, [env("a", ROW), bad], [env("a", OUT)]))
    got = tm.audit(found).filter("collection = 'inputs'").first()
    assert (got.records, got.missing_ids, got.invalid_shapes, got.schema_mismatches) == (2, missing, shape, fields)
    if missing or shape:
        with pytest.raises(PySparkException, match="no id or not exactly one row"):
            tm.pair(found).collect()


def test_one_sided_ids(spark, tmp_path):
    found = tel.scan_envelopes(spark, lines(tmp_path, [env("a", ROW), env("b", ROW)], [env("a", OUT), env("c", OUT)]))
    assert tuple(tm.pairing_audit(found).first()) == (1, 1, 1)
    with pytest.raises(PySparkException, match="do not match"):
        tm.pair(found).collect()
    assert tm.pair(found, strict=False).count() == 1


@pytest.mark.parametrize("bad", ["{not json", "[1, 2]", '"text"'])
def test_invalid_json_names_the_file(spark, tmp_path, bad):
    path = lines(tmp_path, [env("a", ROW), bad], [env("a", OUT)])
    with pytest.raises(PySparkException, match="part.txt"):
        tel.scan_envelopes(spark, path).collect()
    assert tel.scan_envelopes(spark, path, strict=False).count() == 2


def test_emit_samples_pairs(spark, tmp_path, signal):
    from finsieve.operators.features import build_features
    from finsieve.operators.models import with_contract
    rows = with_contract(build_features(signal.filter("row_id < 500")), F.lit(0.25))
    tel.emit(rows, str(tmp_path), rate=0.4)
    found = tel.scan_envelopes(spark, str(tmp_path))
    audit = tm.pairing_audit(found).first()
    assert audit.input_only == audit.output_only == 0 and 100 < audit.matched < 300


def test_emit_splits_a_busy_hour(spark, tmp_path, signal):
    from finsieve.operators.features import build_features
    from finsieve.operators.models import with_contract
    one_hour = build_features(signal.filter("row_id < 400")).withColumn("ts", F.lit("2024-01-01 05:10:00").cast("timestamp"))
    tel.emit(with_contract(one_hour, F.lit(0.25)), str(tmp_path), rows_per_file=60)
    files = spark.read.text(f"{tmp_path}/inputs/event_date=2024-01-01/event_hour=5").select("_metadata.file_path").distinct()
    assert files.count() > 2
    assert tuple(tm.pairing_audit(tel.scan_envelopes(spark, str(tmp_path))).first()) == (400, 0, 0)


def test_contract_rules_in_order(spark, signal):
    assert dq.validate_ledger(signal) is signal
    with pytest.raises(dq.SchemaContractError, match="amount_paid, payment_format"):
        dq.validate_ledger(signal.drop("amount_paid", "payment_format"))
    with pytest.raises(dq.SchemaContractError, match="9"):
        dq.validate_ledger(signal.withColumn("is_laundering", F.when(F.col("row_id") == 3, 9).otherwise(F.col("is_laundering"))))
    with pytest.raises(dq.SchemaContractError, match="amount_paid"):
        dq.validate_ledger(signal.withColumn("amount_paid", F.lit("many")))
    nulls = signal.withColumn("is_laundering", F.when(F.col("row_id") > 9, F.col("is_laundering")))
    assert dq.validate_ledger(nulls) is nulls


def test_columns_are_found_by_name(spark, tmp_path):
    head = "Note,To Bank,Account,Timestamp,Amount Paid,Account,From Bank,Is Laundering,Payment Format,Amount Received,Receiving Currency,Payment Currency"
    (tmp_path / "a.csv").write_text(head + "\nx,2,A1,2022/09/01 10:00,5.5,A2,1,0,ACH,6.5,EUR,USD\n")
    (tmp_path / "b.csv").write_text(head + "\n\"y,z\",4,A3,2022/09/01 11:00,7.5,A4,3,1,Wire,8.5,USD,EUR\n")
    rows = src.scan_ledger_text(spark, str(tmp_path)).orderBy("ts").collect()
    assert [(r.from_bank, r.account, r.to_bank, r.counterparty, r.amount_paid, r.amount_received, r.is_laundering) for r in rows] == [
        (1, "A1", 2, "A2", 5.5, 6.5, 0), (3, "A3", 4, "A4", 7.5, 8.5, 1)]
    assert [(r.receiving_currency, r.payment_currency, r.payment_format) for r in rows] == [("EUR", "USD", "ACH"), ("USD", "EUR", "Wire")]


def test_all_missing_names_are_told(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Timestamp,Account,Account,To Bank\n2022/09/01 10:00,A,B,1\n")
    with pytest.raises(src.HeaderError, match="From Bank, Amount Received, .*Is Laundering"):
        src.scan_ledger_text(spark, str(tmp_path / "a.csv"))
    (tmp_path / "b.csv").write_text("Timestamp,Account\n")
    with pytest.raises(src.HeaderError, match="different headers"):
        src.scan_ledger_text(spark, str(tmp_path))


def test_header_is_read_without_the_text(tmp_path, monkeypatch):
    """A file is read up to its first line's end; long headers, compressed and empty files too."""
    import gzip
    import pyarrow as pa
    from finsieve.sources import ledger

    (tmp_path / "big.csv").write_bytes(b"a,b\n" + b"1,2\n" * 2_000_000)
    long = ",".join(f"column{i}" for i in range(20_000))
    (tmp_path / "long.csv").write_text(long + "\r\n1\n")
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(b"a,b\n1,2\n"))
    (tmp_path / "no.csv").write_bytes(b"")
    read, keep = [], ledger.pa_fs.FileSystem

    class Watched:
        @staticmethod
        def from_uri(uri):
            system, at = keep.from_uri(uri)

            class Opening:
                def open_input_stream(self, *args, **kw):
                    stream = system.open_input_stream(*args, **kw)

                    class Reading:
                        __enter__ = lambda s: s
                        __exit__ = lambda s, *a: stream.close()

                        def read(self, n):
                            read.append(n)
                            return stream.read(n)
                    return Reading()
            return Opening(), at

    monkeypatch.setattr(ledger.pa_fs, "FileSystem", Watched)
    names = ("big.csv", "long.csv", "z.csv.gz", "no.csv")
    batch = pa.RecordBatch.from_arrays([pa.array([f"file://{tmp_path}/{n}" for n in names])], names=["path"])
    lines = [x for out in ledger._first_lines([batch]) for x in out.column(0).to_pylist()]
    assert lines == ["a,b", long, "a,b", ""]
    assert len(read) <= 1 + len(long) // ledger.HEADER_READ + 1 + 1 + 1


def test_defective_envelopes_read_alike_from_many_compressed_files(spark, sf, monkeypatch):
    """Lines of a request that is sent twice keep their order where a file ends between them."""
    from finsieve.operators import telemetry as tm
    from finsieve.plans import catalog_monitoring as cm

    found = []
    for lines in (1_000_000, 7):
        monkeypatch.setattr(cm, "FILE_LINES", lines)
        path = cm._write_defective(spark, sf)
        files = spark.read.format("binaryFile").load(f"{path}/inputs").select("path").collect()
        assert files and all(r.path.endswith(".txt.gz") for r in files)
        pairs = tm.typed_pairs(tm.pair(cm.src.scan_envelopes(spark, path), strict=False))
        found.append((len(files), sorted(map(str, pairs.collect()))))
    assert found[0][1] == found[1][1] and found[1][0] > found[0][0]


def test_a_line_is_parsed_once(spark, tmp_path):
    found = tel.scan_envelopes(spark, lines(tmp_path, [env("a", ROW)], [env("a", OUT)]), strict=False)
    for df in (tm.pair(found, strict=False), tm.pairing_audit(found)):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall("parse_?json", text, re.I)) == 1  # both collections by one expression


IDS = ["ab", "AB", "abc", "0a\n", "é", "00", "0", "deadbeef", "x01", "ab "]


def test_ids_of_any_text_stay_apart_where_they_are_packed(spark, tmp_path):
    found = tel.scan_envelopes(spark, lines(tmp_path, [env(i, ROW) for i in [*IDS, "ab"]], [env(i, OUT) for i in IDS[1:]]))
    assert {r.correlationid for r in tm.pair(found, strict=False).collect()} == set(IDS[1:])
    assert {r.correlationid: r.records for r in tm.per_id(found).filter("collection = 'inputs'").collect()} == {i: 2 if i == "ab" else 1 for i in IDS}
    assert tuple(tm.pairing_audit(found).first()) == (len(IDS) - 1, 1, 0)
    assert tm.audit(found).filter("collection = 'inputs'").first().duplicate_ids == 1


def test_checks_move_each_record_once_by_a_packed_id(spark, tmp_path):
    from finsieve.session import made

    found = tel.scan_envelopes(spark, lines(tmp_path, [env("a", ROW)], [env("a", OUT)]))
    before = list(made(spark))
    for df in (tm.acceptance_checks(found), tm.pairing_audit(found), tm.pair(found)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"hashpartitioning\((\w+)#", plan.split("Initial Plan")[0])
        assert len(keys) == 1 and keys != ["correlationid"]
    assert made(spark) == before


def test_written_tables_leave_no_shuffle_files_and_no_steps(spark, sf, monkeypatch):
    import time

    from finsieve.plans import views
    from finsieve.session import made, stage

    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = disk.getAllFiles().size()
    stage(spark.range(1000).repartition(7, "id"))
    for _ in range(100):
        if disk.getAllFiles().size() <= before:
            break
        time.sleep(0.1)
    assert disk.getAllFiles().size() <= before
    monkeypatch.setattr(views, "_PREPARED", {})
    known = set(made(spark))
    assert views.features(spark, sf).count() > 0
    assert sorted(p.rsplit("/", 1)[1].split("-")[0] for p in set(made(spark)) - known) == ["features", "ledger"]
