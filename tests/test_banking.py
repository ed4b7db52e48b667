"""The banking jobs on a small hand-made batch with known defects (expected counts worked out by hand)."""

import uuid

import pytest
from pyspark.sql import functions as F

from stratamart.operators import quality
from stratamart.plans import banking as bank, flows
from stratamart.session import scratch_path

RUN = bank.Run("2026-09-03")


def _accounts():
    """13 rows: a replay, a missing customer, a missing branch, an odd status and a NULL key."""
    base = [(f"ACC-{i}", f"CUST-{i}", "SAVINGS", "BR-1", "INR", 1000.0 * (i - 1000), "ACTIVE", "2020-01-15", i % 5 + 1) for i in range(1001, 1011)]
    base[6] = (*base[6][:6], "active", *base[6][7:])
    base[7] = (*base[7][:3], None, *base[7][4:])
    return [*base, base[2], ("ACC-1011", None, "SAVINGS", "BR-1", "INR", 10.0, "ACTIVE", "2023-08-17", 1),
            (None, "CUST-512", "CURRENT", "BR-1", "INR", 44000.0, "ACTIVE", "2022-10-05", 2)]


def _txn(i, account, time, amount, currency="INR", country="IN"):
    return (f"TXN-{i}" if i else None, account, f"2026-09-03 {time}", amount, currency, "DEBIT", "UPI", "Shop", country)


def _txns():
    """21 rows: two replays, lower-case currency, zero and negative amounts, unknown account, NULL key."""
    good = [_txn(i, f"ACC-{1001 + i % 10}", f"{8 + i % 12:02d}:00:00", 100.0 + i) for i in range(1, 12)]
    burst = [_txn(20, "ACC-1003", "02:17:44", 9800.0, "USD", "US"), _txn(21, "ACC-1003", "02:19:03", 9750.0, "USD", "US"), _txn(22, "ACC-1003", "02:21:38", 9900.0, "USD", "US")]
    return [*good, *burst, good[0], burst[0], _txn(30, "ACC-1002", "18:00:00", 5000.0, "inr"), _txn(31, "ACC-1006", "15:12:30", 0.0), _txn(32, "ACC-1001", "20:44:18", -750.0),
            _txn(33, "ACC-9999", "22:05:41", 1800.0), _txn(None, "ACC-1010", "23:59:59", 250.0)]


@pytest.fixture(scope="module")
def bronze(spark):
    accounts = spark.createDataFrame(_accounts(), bank.ACCOUNT_SCHEMA)
    txns = spark.createDataFrame(_txns(), bank.TXN_SCHEMA)
    return bank.bronze_accounts(accounts, RUN), bank.bronze_transactions(txns, RUN)


def test_bronze_gate(bronze):
    results = bank.validate_bronze(*bronze, RUN)
    got = {(r.table_name, r.check_name): (round(r.observed, 4), r.status) for r in results.collect()}
    a, t = "raw_accounts", "raw_transactions"
    assert got == {
        (a, "table_not_empty"): (13.0, "PASS"), (t, "table_not_empty"): (21.0, "PASS"),
        (a, "primary_key_not_null"): (0.9231, "FAIL"), (t, "primary_key_not_null"): (0.9524, "FAIL"),
        (a, "primary_key_unique"): (0.9167, "FAIL"), (t, "primary_key_unique"): (0.9, "FAIL"),
        (t, "currency_in_whitelist"): (1.0, "PASS"), (t, "amount_is_positive"): (0.9048, "FAIL"), (t, "txn_account_resolves"): (0.9524, "FAIL"),
    }
    assert quality.gate_verdict(results).head().verdict == "FAIL"


def test_quarantine_buckets(bronze):
    out = bank.quarantine_records(*bronze, RUN)
    got = {(r.source_entity[4:5], r.reject_reason): r.records for r in quality.triage(out).collect()}
    assert got == {("a", "NULL_PRIMARY_KEY"): 1, ("a", "DUPLICATE_PRIMARY_KEY"): 2, ("a", "MISSING_CUSTOMER"): 1, ("t", "NULL_PRIMARY_KEY"): 1,
                   ("t", "DUPLICATE_PRIMARY_KEY"): 4, ("t", "NON_POSITIVE_AMOUNT"): 2, ("t", "UNKNOWN_ACCOUNT"): 1}
    payload = out.where("reject_reason = 'MISSING_CUSTOMER'").head().record_payload
    assert '"account_id":"ACC-1011"' in payload and "customer_id" not in payload and "_batch_id" not in payload


def test_silver_and_its_gate(bronze):
    accounts, txns = bronze
    dim = bank.dim_account(accounts, RUN)
    keyed = bank.keyed_transactions(txns)
    clean, rejects = bank.txn_clean(keyed, dim, RUN), bank.txn_rejects(txns, keyed)
    assert (dim.count(), clean.count(), rejects.count()) == (11, 15, 3)
    results = bank.validate_silver(dim, clean, rejects, txns, RUN)
    assert {r.status for r in results.collect()} == {"PASS"} and results.count() == 10
    assert results.where("check_name = 'row_reconciliation'").head().observed == 1.0
    signals = bank.txn_signals(clean)
    assert {r.txn_id: r.txns_in_window for r in signals.where("account_id = 'ACC-1003' AND txn_hour = 2").collect()} == {"TXN-20": 1, "TXN-21": 2, "TXN-22": 3}
    top = bank.fraud_signal_summary(signals, RUN).where("account_id = 'ACC-1003'").head()
    assert (top.velocity_hits, top.high_value_hits, top.peak_txn_score, top.countries_seen) == (1, 3, 95, ["IN", "US"])


@pytest.mark.parametrize("threshold,verdicts", [(0.98, ["FAIL", "NOT_RUN"]), (0.5, ["PASS", "PASS"])])
def test_flow_branches_on_the_gate(spark, threshold, verdicts):
    name = f"t_{uuid.uuid4().hex[:8]}"
    flow = flows.BankFlow(spark, name, scratch_path(spark, name))
    audit = flow.run(spark.createDataFrame(_accounts(), bank.ACCOUNT_SCHEMA), spark.createDataFrame(_txns(), bank.TXN_SCHEMA), bank.Run("2026-09-03", threshold))
    gates = [r.status for r in audit.where(F.startswith("table_name", F.lit("GATE"))).orderBy("table_name").collect()]
    assert gates == verdicts and audit.count() == 10
    assert flows.run_status(audit).head().run_status == ("SUCCESS" if verdicts == ["PASS", "PASS"] else "DEGRADED")


def test_every_key_is_somewhere(bronze):
    """A published row that goes missing, comes twice or from nowhere is found; nothing else fails."""
    accounts, txns = bronze
    dim, keyed = bank.dim_account(accounts, RUN), bank.keyed_transactions(txns)
    clean, rejects = bank.txn_clean(keyed, dim, RUN), bank.txn_rejects(txns, keyed, dim)
    assert sorted(r.reject_reason for r in rejects.collect()) == ["NON_POSITIVE_AMOUNT", "NON_POSITIVE_AMOUNT", "NULL_TXN_ID", "UNKNOWN_ACCOUNT"]

    def found(c, r):
        return {x.outcome: (x["keys"], x.status) for x in bank.txn_outcomes(bank.key_ledger(keyed, c, r)).collect()}

    sound = {"NULL_VALUE": (0, "PASS"), "REJECTED": (2, "PASS"), "UNKNOWN_ACCOUNT": (1, "PASS"), "CLEAN": (15, "PASS"),
             "NOWHERE": (0, "PASS"), "TWICE": (0, "PASS"), "UNEXPECTED": (0, "PASS")}
    assert found(clean, rejects) == sound
    short = clean.where("txn_id <> 'TXN-20'")
    assert found(short, rejects) == {**sound, "CLEAN": (14, "PASS"), "NOWHERE": (1, "FAIL")}
    assert found(clean.unionByName(clean.where("txn_id = 'TXN-20'")), rejects) == {**sound, "CLEAN": (14, "PASS"), "TWICE": (1, "FAIL")}
    odd = rejects.unionByName(rejects.limit(1).withColumn("txn_id", F.lit("TXN-0")))
    assert found(clean, odd) == {**sound, "UNEXPECTED": (1, "FAIL")}
    for held, status in ((clean, "PASS"), (short, "FAIL")):
        results = bank.validate_silver(dim, held, rejects, txns, RUN, bank.key_ledger(keyed, held, rejects))
        assert results.count() == 11 and results.where("check_name = 'every_key_once'").head().status == status
    assert results.where("check_name = 'row_reconciliation'").head().status == "FAIL"


def test_null_values_are_rejected_when_accounts_are_known(spark, bronze):
    accounts, _ = bronze
    rows = [_txn(1, "ACC-1001", "08:00:00", None), _txn(2, "ACC-1001", "08:00:00", 5.0, None), _txn(3, None, "08:00:00", -5.0, "XXX"), _txn(4, "ACC-1001", "08:00:00", 5.0)]
    txns = bank.bronze_transactions(spark.createDataFrame(rows, bank.TXN_SCHEMA), RUN)
    keyed, dim = bank.keyed_transactions(txns), bank.dim_account(accounts, RUN)
    got = sorted((r.txn_id, r.reject_reason) for r in bank.txn_rejects(txns, keyed, dim).collect())
    assert got == [("TXN-1", "NULL_VALUE"), ("TXN-2", "NULL_VALUE"), ("TXN-3", "INVALID_CURRENCY"), ("TXN-3", "NON_POSITIVE_AMOUNT"), ("TXN-3", "UNKNOWN_ACCOUNT")]
    assert {r.reject_reason for r in bank.txn_rejects(txns, keyed).collect()} == {"INVALID_CURRENCY", "NON_POSITIVE_AMOUNT"}


def test_quarantine_tests_all_rules_in_one_scan(spark, bronze, tmp_path):
    """Beside the counted keys, written before, each feed is scanned once; nothing is aggregated between shuffle and join."""
    paths = [str(tmp_path / n) for n in ("accounts", "txns")]
    for df, path in zip(bronze, paths):
        df.write.parquet(path)
    out = bank.quarantine_records(*(spark.read.parquet(p) for p in paths), RUN)
    assert len(out.collect()) == bank.quarantine_records(*bronze, RUN).count()
    final = out._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    scans = [line for line in final.splitlines() if "FileScan parquet" in line]
    assert sum("customer_id" in line for line in scans) == 1 and sum("txn_ts" in line for line in scans) == 1
    assert "HashAggregate" not in final


def test_a_batch_is_audited_by_its_own_rows(spark):
    """What an earlier batch left in silver and gold is not there for the one whose bronze gate failed."""
    name = f"t_{uuid.uuid4().hex[:8]}"
    feeds = spark.createDataFrame(_accounts(), bank.ACCOUNT_SCHEMA), spark.createDataFrame(_txns(), bank.TXN_SCHEMA)
    flow = flows.BankFlow(spark, name, scratch_path(spark, name))
    assert flows.run_status(flow.run(*feeds, bank.Run("2026-09-02", 0.5))).head().run_status == "SUCCESS"
    audit = {r.table_name: (r.row_count, r.status) for r in flow.run(*feeds, RUN).collect()}
    assert audit["silver.txn_clean"] == (0, "ABSENT") and audit["gold.fraud_signal_summary"] == (0, "ABSENT")
    assert audit["GATE:bronze_quality"] == (9, "FAIL") and audit["GATE:silver_quality"] == (0, "NOT_RUN")
    assert audit["bronze.raw_accounts"] == (13, "PRESENT")


def test_a_strict_flow_holds_gold_back(spark):
    """A time that cannot be parsed fails the silver gate; the strict flow then builds no marts."""
    rows = [*_txns(), ("TXN-40", "ACC-1001", "soon", 10.0, "INR", "DEBIT", "UPI", "Shop", "IN")]
    feeds = spark.createDataFrame(_accounts(), bank.ACCOUNT_SCHEMA), spark.createDataFrame(rows, bank.TXN_SCHEMA)
    for strict, gold in ((True, "ABSENT"), (False, "PRESENT")):
        name = f"t_{uuid.uuid4().hex[:8]}"
        audit = {r.table_name: r for r in flows.BankFlow(spark, name, scratch_path(spark, name), strict).run(*feeds, bank.Run(RUN.date, 0.5)).collect()}
        assert (audit["GATE:silver_quality"].status, audit["GATE:silver_quality"].row_count) == ("FAIL", 10 + strict)
        assert audit["gold.account_balance_daily"].status == gold
