"""Banking queries over accounts derived from customers and transactions derived from events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratamart.operators import quality
from stratamart.plans import banking as bank
from stratamart.registry.core import ENTRIES, Context, latest_, pctn_, query, relation, rnd

RUN = bank.Run("2024-01-20")
_CCY = "('INR', 'USD', 'EUR', 'GBP', 'AED', 'SGD')"


def accounts(ctx: Context):
    return bank.bronze_accounts(ctx["src_accounts"], RUN)


def txns(ctx: Context):
    return bank.bronze_transactions(ctx["src_txns"], RUN)


def dim(ctx: Context):
    return bank.dim_account(accounts(ctx), RUN)


def keyed(ctx: Context):
    return bank.keyed_transactions(txns(ctx))


def clean(ctx: Context):
    return bank.txn_clean(keyed(ctx), dim(ctx), RUN)


def rejects(ctx: Context):
    return bank.txn_rejects(txns(ctx), keyed(ctx))


def all_rejects(ctx: Context):
    return bank.txn_rejects(txns(ctx), keyed(ctx), dim(ctx))


def silver(ctx: Context, name: str):
    """Published banking tables, as the gold jobs read them."""
    build = {"bank_dim": dim, "bank_clean": clean, "bank_rejects": rejects, "bank_rejects_all": all_rejects}[name]
    return ctx.retail.once(name, lambda: build(ctx))


def balances(ctx: Context):
    return bank.account_balance_daily(silver(ctx, "bank_clean"), silver(ctx, "bank_dim"), RUN)


def signals(ctx: Context):
    return bank.txn_signals(silver(ctx, "bank_clean"))


def summary(ctx: Context):
    return bank.fraud_signal_summary(signals(ctx), RUN)


# --- expected relations --------------------------------------------------------------------

_ACC = "customer_id account_type branch_code currency opening_balance status opened_on risk_band"
_TXN = "account_id txn_ts amount currency direction channel merchant country"
_LINEAGE = f"'batch_20240120' AS _batch_id, '{RUN.date}' AS _run_date"
# months_between: whole months plus a 31-day fraction, whole when both days are equal or both month ends
_MONTHS = """(CASE WHEN day(opened) = 20 OR (opened = last_day(opened) AND false) THEN (2024 - year(opened)) * 12 + (1 - month(opened))
  ELSE round(CAST((2024 - year(opened)) * 12 + (1 - month(opened)) AS DOUBLE) + CAST(20 - day(opened) AS DOUBLE) / 31, 8) END)"""
relation("b_dim", f"""SELECT account_id, coalesce(customer_id, 'UNASSIGNED') AS customer_id, upper(trim(account_type)) AS account_type, coalesce(branch_code, 'UNKNOWN') AS branch_code,
  upper(trim(currency)) AS currency, {rnd('coalesce(opening_balance, 0.0)', 2)} AS opening_balance, st AS status, st = 'ACTIVE' AS is_active, opened AS opened_on,
  {rnd(f'{_MONTHS} / 12', 1)} AS account_age_years, coalesce(risk_band, 3) AS risk_band,
  CASE WHEN coalesce(risk_band, 3) > 3 THEN 'HIGH' WHEN coalesce(risk_band, 3) > 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category
  FROM (SELECT *, CASE WHEN upper(trim(status)) IN ('ACTIVE', 'DORMANT', 'CLOSED', 'FROZEN') THEN upper(trim(status)) ELSE 'UNKNOWN' END AS st, TRY_CAST(opened_on AS DATE) AS opened
    FROM ({latest_('{src_accounts}', 'account_id', '', _ACC)}) WHERE account_id IS NOT NULL)""")
relation("b_keyed", f"SELECT * REPLACE (upper(trim(currency)) AS currency) FROM ({latest_('{src_txns}', 'txn_id', '', _TXN)}) WHERE txn_id IS NOT NULL")
relation("b_rejects", f"""SELECT txn_id, account_id, amount, currency, 'NULL_TXN_ID' AS reject_reason FROM {{src_txns}} WHERE txn_id IS NULL
  UNION ALL SELECT txn_id, account_id, amount, currency, 'NON_POSITIVE_AMOUNT' FROM {{b_keyed}} WHERE amount <= 0
  UNION ALL SELECT txn_id, account_id, amount, currency, 'INVALID_CURRENCY' FROM {{b_keyed}} WHERE currency NOT IN {_CCY}""")
relation("b_rejects_all", """SELECT * FROM {b_rejects} UNION ALL SELECT txn_id, account_id, amount, currency, 'NULL_VALUE' FROM {b_keyed} WHERE amount IS NULL OR currency IS NULL
  UNION ALL SELECT txn_id, account_id, amount, currency, 'UNKNOWN_ACCOUNT' FROM {b_keyed} k WHERE NOT EXISTS (SELECT 1 FROM {b_dim} d WHERE d.account_id = k.account_id)""")
relation("b_clean", f"""SELECT *, CASE WHEN direction = 'CREDIT' THEN amount_inr ELSE -amount_inr END AS signed_amount_inr FROM (
  SELECT txn_id, k.account_id, customer_id AS acct_customer_id, branch_code AS acct_branch_code, account_type AS acct_type, risk_category AS acct_risk_category, is_active AS acct_is_active,
  ts AS txn_ts, CAST(ts AS DATE) AS txn_date, hour(ts) AS txn_hour, hour(ts) < 6 OR hour(ts) >= 22 AS is_night_txn, amount, k.currency,
  rate AS fx_rate_to_inr, {rnd('amount * rate', 2)} AS amount_inr, upper(trim(direction)) AS direction, upper(trim(channel)) AS channel, merchant, country
  FROM (SELECT *, TRY_CAST(txn_ts AS TIMESTAMP) AS ts FROM {{b_keyed}} WHERE amount > 0) k
  JOIN (VALUES ('INR', 1.0::DOUBLE), ('USD', 83.2), ('EUR', 90.1), ('GBP', 105.4), ('AED', 22.6), ('SGD', 61.8)) fx(code, rate) ON k.currency = code
  JOIN {{b_dim}} d ON k.account_id = d.account_id)""")
_M = "CAST({} AS DECIMAL(18,2))"
relation("b_balance", f"""SELECT d.*, customer_id, branch_code, account_type, a.currency, status, risk_category, opening_balance,
  CASE WHEN txn_count >= 5 THEN 'HIGH' WHEN txn_count >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS activity_tier,
  CAST(opening_balance AS DECIMAL(18,2)) + cumulative_movement_inr AS closing_balance_inr, CAST(opening_balance AS DECIMAL(18,2)) + cumulative_movement_inr < 0 AS is_overdrawn,
  a.currency <> 'INR' AS mixes_currencies
  FROM (SELECT *, sum(net_movement_inr) OVER (PARTITION BY account_id ORDER BY txn_date NULLS FIRST ROWS UNBOUNDED PRECEDING) AS cumulative_movement_inr FROM (
    SELECT account_id, txn_date, count(*) AS txn_count, sum(CASE WHEN direction = 'DEBIT' THEN {_M.format('amount_inr')} ELSE 0 END) AS total_debit_inr,
    sum(CASE WHEN direction = 'CREDIT' THEN {_M.format('amount_inr')} ELSE 0 END) AS total_credit_inr, sum({_M.format('signed_amount_inr')}) AS net_movement_inr,
    {rnd(f"CAST(sum({_M.format('amount_inr')}) AS DOUBLE) / count(*)", 2, 9)} AS avg_txn_inr, max(amount_inr) AS max_txn_inr, count(DISTINCT channel) AS channels_used,
    count(DISTINCT merchant) AS distinct_merchants FROM {{b_clean}} GROUP BY 1, 2)) d JOIN {{b_dim}} a USING (account_id)""")
relation("b_signals", """SELECT *, 30 * CAST(sig_velocity AS INT) + 25 * CAST(sig_high_value AS INT) + 20 * CAST(coalesce(sig_cross_border, false) AS INT) + 10 * CAST(sig_foreign_currency AS INT)
  + 10 * CAST(coalesce(sig_night_activity, false) AS INT) + 5 * CAST(sig_structuring AS INT) AS txn_risk_score FROM (
  SELECT *, txns_in_window >= 3 AS sig_velocity, amount_inr > 50000 AS sig_high_value, country <> 'IN' AS sig_cross_border, currency <> 'INR' AS sig_foreign_currency, is_night_txn AS sig_night_activity,
  amount_inr % 10000 > 9000 OR amount_inr % 10000 < 1000 AS sig_structuring FROM (
    SELECT *, count(*) OVER (PARTITION BY account_id ORDER BY epoch(txn_ts) RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) AS txns_in_window FROM {b_clean}))""")
relation("b_summary", f"""SELECT *, CASE WHEN account_risk_score >= 60 THEN 'CRITICAL' WHEN account_risk_score >= 40 THEN 'HIGH' WHEN account_risk_score >= 20 THEN 'WATCH' ELSE 'NORMAL' END AS risk_tier,
  account_risk_score >= 40 AS requires_review FROM (SELECT *, least(100.0, {rnd('peak_txn_score * 0.6::DOUBLE + avg_txn_score * 0.4::DOUBLE', 0)}) AS account_risk_score FROM (
  SELECT account_id, acct_customer_id, acct_branch_code, acct_risk_category, count(*) AS txn_count, sum({_M.format('amount_inr')}) AS total_amount_inr, max(amount_inr) AS largest_txn_inr,
  count(*) FILTER (sig_velocity) AS velocity_hits, count(*) FILTER (sig_high_value) AS high_value_hits, CASE WHEN count(sig_night_activity) > 0 THEN count(*) FILTER (sig_night_activity) END AS night_hits,
  count(*) FILTER (sig_foreign_currency) AS foreign_ccy_hits, CASE WHEN count(sig_cross_border) > 0 THEN count(*) FILTER (sig_cross_border) END AS cross_border_hits,
  count(*) FILTER (sig_structuring) AS structuring_hits, max(txn_risk_score) AS peak_txn_score,
  {rnd('avg(txn_risk_score)', 1)} AS avg_txn_score, array_to_string(list_sort(list(DISTINCT country) FILTER (country IS NOT NULL)), ',') AS countries_seen,
  array_to_string(list_sort(list(DISTINCT channel)), ',') AS channels_seen FROM {{b_signals}} GROUP BY 1, 2, 3, 4))""")


def _joined(df):
    return df.withColumns({c: F.concat_ws(",", c) for c in ("countries_seen", "channels_seen") if c in df.columns})


# --- queries ---------------------------------------------------------------------------------

query("bank_bronze_accounts", "account_id:s customer_id:s account_type:s branch_code:s currency:s opening_balance:f status:s opened_on:s risk_band:i _batch_id:s _run_date:s _source_system:s _source_file:s",
      f"SELECT *, {_LINEAGE}, 'core-banking-cbs' AS _source_system, 'accounts.csv' AS _source_file FROM {{src_accounts}}")(accounts)
query("bank_bronze_txns", "txn_id:s account_id:s txn_ts:s amount:f currency:s direction:s channel:s merchant:s country:s _batch_id:s _run_date:s _source_system:s _source_file:s",
      f"SELECT *, {_LINEAGE}, 'payments-switch' AS _source_system, 'txns.json' AS _source_file FROM {{src_txns}}")(txns)
query("bank_txn_by_channel", "channel:s txn_count:i total_amount:f", f"SELECT channel, count(*) AS txn_count, CAST(round(sum(CAST(amount AS DECIMAL(28,6))), 2) AS DOUBLE) AS total_amount FROM {{src_txns}} GROUP BY 1")(
    lambda ctx: bank.txn_by_channel(txns(ctx)))
query("dq_reconcile_strict", "outcome:s keys:i share_pct:f status:s", f"""SELECT outcome, coalesce(n, 0) AS keys, {pctn_('coalesce(n, 0)', 'sum(n) OVER ()', 4)} AS share_pct, 'PASS' AS status FROM
  (VALUES ('NULL_VALUE'), ('REJECTED'), ('UNKNOWN_ACCOUNT'), ('CLEAN'), ('NOWHERE'), ('TWICE'), ('UNEXPECTED')) o(outcome) LEFT JOIN (
  SELECT CASE WHEN amount IS NULL OR currency IS NULL THEN 'NULL_VALUE' WHEN amount <= 0 OR currency NOT IN ('INR', 'USD', 'EUR', 'GBP', 'AED', 'SGD') THEN 'REJECTED'
    WHEN account_id IS NULL OR account_id NOT IN (SELECT account_id FROM {{b_dim}} WHERE account_id IS NOT NULL) THEN 'UNKNOWN_ACCOUNT' ELSE 'CLEAN' END AS outcome, count(*) AS n FROM {{b_keyed}} GROUP BY 1) USING (outcome)""")(
    lambda ctx: bank.txn_outcomes(bank.key_ledger(keyed(ctx), silver(ctx, "bank_clean"), silver(ctx, "bank_rejects_all"))).withColumn(
        "share_pct", F.round(F.col("keys") / F.sum("keys").over(Window.partitionBy()) * 100, 4)))
query("bank_dim_account", "account_id:s customer_id:s account_type:s branch_code:s currency:s opening_balance:f status:s is_active:b opened_on:d account_age_years:f risk_band:i risk_category:s",
      "SELECT * FROM {b_dim}")(dim)
query("bank_account_mix", "risk_category:s status:s accounts:i", "SELECT risk_category, status, count(*) AS accounts FROM {b_dim} GROUP BY 1, 2")(lambda ctx: bank.account_mix(dim(ctx)))
query("bank_txn_clean", "txn_id:s account_id:s acct_customer_id:s acct_branch_code:s acct_type:s acct_risk_category:s acct_is_active:b txn_ts:t txn_date:d txn_hour:i is_night_txn:b amount:f currency:s "
      "fx_rate_to_inr:f amount_inr:f signed_amount_inr:f direction:s channel:s merchant:s country:s", "SELECT * FROM {b_clean}")(clean)
query("bank_txn_rejects", "txn_id:s account_id:s amount:f currency:s reject_reason:s", "SELECT * FROM {b_rejects}")(rejects)
query("dq_reject_multi", "reject_reason:s lines:i", "SELECT reject_reason, count(*) AS lines FROM {b_rejects} GROUP BY 1")(
    lambda ctx: rejects(ctx).groupBy("reject_reason").agg(F.count("*").alias("lines")))
query("bank_txn_rejects_all", "txn_id:s account_id:s amount:f currency:s reject_reason:s", "SELECT * FROM {b_rejects_all}")(all_rejects)
query("bank_balance_daily", "txn_date:d account_id:s customer_id:s branch_code:s account_type:s currency:s status:s risk_category:s txn_count:i channels_used:i distinct_merchants:i activity_tier:s "
      "total_debit_inr:f total_credit_inr:f net_movement_inr:f avg_txn_inr:f max_txn_inr:f opening_balance:f cumulative_movement_inr:f closing_balance_inr:f is_overdrawn:b mixes_currencies:b",
      "SELECT * FROM {b_balance}")(balances)
query("bank_branch_rollup", "branch_code:s accounts:i transactions:i debits_inr:f credits_inr:f closing_inr:f",
      "SELECT branch_code, count(DISTINCT account_id) AS accounts, sum(txn_count) AS transactions, sum(total_debit_inr) AS debits_inr, sum(total_credit_inr) AS credits_inr, sum(closing_balance_inr) AS closing_inr FROM {b_balance} GROUP BY 1")(
    lambda ctx: bank.branch_rollup(balances(ctx)))
query("bank_txn_signals", "txn_id:s account_id:s amount_inr:f txns_in_window:i sig_velocity:b sig_high_value:b sig_cross_border:b sig_foreign_currency:b sig_night_activity:b sig_structuring:b txn_risk_score:i",
      "SELECT * FROM {b_signals}")(signals)
_SUMMARY = ("account_id:s acct_customer_id:s acct_branch_code:s acct_risk_category:s txn_count:i total_amount_inr:f largest_txn_inr:f velocity_hits:i high_value_hits:i night_hits:i foreign_ccy_hits:i "
            "cross_border_hits:i structuring_hits:i peak_txn_score:i avg_txn_score:f countries_seen:s channels_seen:s account_risk_score:f risk_tier:s requires_review:b")
query("bank_fraud_summary", _SUMMARY, "SELECT * FROM {b_summary}")(lambda ctx: _joined(summary(ctx)))
query("bank_review_list", "account_id:s acct_customer_id:s risk_tier:s account_risk_score:f largest_txn_inr:f countries_seen:s", "SELECT * FROM {b_summary} WHERE requires_review")(
    lambda ctx: _joined(bank.review_list(summary(ctx))))
query("bank_tier_distribution", "risk_tier:s accounts:i", "SELECT risk_tier, count(*) AS accounts FROM {b_summary} GROUP BY 1")(lambda ctx: bank.tier_distribution(summary(ctx)))
query("detect_late_facts", "txn_id:s account_id:s txn_date:d", f"SELECT txn_id, account_id, txn_date FROM {{b_clean}} WHERE txn_date < DATE '{RUN.date}'")(
    lambda ctx: bank.late_transactions(clean(ctx), RUN))

# --- gates -------------------------------------------------------------------------------------


def _check(table: str, name: str, observed: str, threshold: float, detail: str) -> str:
    return (f"SELECT 'batch_20240120' AS batch_id, '{RUN.date}' AS run_date, '{table}' AS table_name, '{name}' AS check_name, CAST(({observed}) AS DOUBLE) AS observed, "
            f"{threshold} AS threshold, CASE WHEN ({observed}) >= {threshold} THEN 'PASS' ELSE 'FAIL' END AS status, ({detail}) AS detail")


def _ratio(a: str, b: str) -> str:
    return f"(SELECT CAST({a} AS DOUBLE) / {b} FROM "


_A, _T = "FROM {src_accounts}", "FROM {src_txns}"
_KNOWN = "account_id IN (SELECT account_id FROM {src_accounts} WHERE account_id IS NOT NULL)"
relation("b_gate_bronze", " UNION ALL ".join([
    _check("raw_accounts", "table_not_empty", f"SELECT count(*) {_A}", 1, f"SELECT count(*) || ' rows landed' {_A}"),
    _check("raw_transactions", "table_not_empty", f"SELECT count(*) {_T}", 1, f"SELECT count(*) || ' rows landed' {_T}"),
    _check("raw_accounts", "primary_key_not_null", f"SELECT count(account_id)::DOUBLE / count(*) {_A}", 0.98, f"SELECT (count(*) - count(account_id)) || ' null account_id' {_A}"),
    _check("raw_transactions", "primary_key_not_null", f"SELECT count(txn_id)::DOUBLE / count(*) {_T}", 0.98, f"SELECT (count(*) - count(txn_id)) || ' null txn_id' {_T}"),
    _check("raw_accounts", "primary_key_unique", f"SELECT count(DISTINCT account_id)::DOUBLE / count(account_id) {_A}", 0.98, f"SELECT (count(account_id) - count(DISTINCT account_id)) || ' duplicate account_id' {_A}"),
    _check("raw_transactions", "primary_key_unique", f"SELECT count(DISTINCT txn_id)::DOUBLE / count(txn_id) {_T}", 0.98, f"SELECT (count(txn_id) - count(DISTINCT txn_id)) || ' duplicate txn_id' {_T}"),
    _check("raw_transactions", "currency_in_whitelist", f"SELECT (count(*) FILTER (upper(currency) IN {_CCY}))::DOUBLE / count(*) {_T}", 0.98,
           f"SELECT (count(*) - count(*) FILTER (upper(currency) IN {_CCY})) || ' rows outside [''INR'', ''USD'', ''EUR'', ''GBP'', ''AED'', ''SGD'']' {_T}"),
    _check("raw_transactions", "amount_is_positive", f"SELECT (count(*) FILTER (amount > 0))::DOUBLE / count(*) {_T}", 0.98, f"SELECT (count(*) - count(*) FILTER (amount > 0)) || ' rows with amount <= 0' {_T}"),
    _check("raw_transactions", "txn_account_resolves", f"SELECT (count(*) FILTER ({_KNOWN}))::DOUBLE / count(*) {_T}", 0.98,
           f"SELECT (count(*) - count(*) FILTER ({_KNOWN})) || ' transactions reference an unknown account' {_T}"),
]))
_D, _C = "FROM {b_dim}", "FROM {b_clean}"
_ACCOUNTED = "((SELECT count(*) FROM {b_clean}) + (SELECT count(*) FROM {b_rejects}))"
_KEYS = "(SELECT count(DISTINCT txn_id) FROM {src_txns})"
relation("b_gate_silver", " UNION ALL ".join([
    _check("dim_account", "table_not_empty", f"SELECT count(*) {_D}", 1, f"SELECT count(*) || ' rows' {_D}"),
    _check("txn_clean", "table_not_empty", f"SELECT count(*) {_C}", 1, f"SELECT count(*) || ' rows' {_C}"),
    _check("dim_account", "account_id_unique", f"SELECT count(DISTINCT account_id)::DOUBLE / count(*) {_D}", 1.0, f"SELECT (count(*) - count(DISTINCT account_id)) || ' duplicate account_id survived dedupe' {_D}"),
    _check("dim_account", "account_id_not_null", f"SELECT CASE WHEN count(account_id) = count(*) THEN 1.0 ELSE 0.0 END {_D}", 1.0, f"SELECT (count(*) - count(account_id)) || ' null account_id' {_D}"),
    _check("txn_clean", "txn_id_unique", f"SELECT count(DISTINCT txn_id)::DOUBLE / count(*) {_C}", 1.0, f"SELECT (count(*) - count(DISTINCT txn_id)) || ' duplicate txn_id survived dedupe' {_C}"),
    _check("txn_clean", "no_orphan_transactions", f"SELECT 1.0 - (count(*) FILTER (account_id NOT IN (SELECT account_id {_D})))::DOUBLE / count(*) {_C}", 1.0,
           f"SELECT (count(*) FILTER (account_id NOT IN (SELECT account_id {_D}))) || ' transaction(s) with no matching account' {_C}"),
    _check("txn_clean", "amount_inr_positive", f"SELECT CASE WHEN min(amount_inr) > 0 THEN 1.0 ELSE 0.0 END {_C}", 1.0, f"SELECT (count(*) FILTER (amount_inr <= 0)) || ' row(s) with amount_inr <= 0' {_C}"),
    _check("txn_clean", "fx_conversion_complete", f"SELECT CASE WHEN count(amount_inr) = count(*) THEN 1.0 ELSE 0.0 END {_C}", 1.0, f"SELECT (count(*) - count(amount_inr)) || ' row(s) missing an FX conversion' {_C}"),
    _check("txn_clean", "txn_date_parsed", f"SELECT 1.0 - (count(*) - count(txn_date))::DOUBLE / count(*) {_C}", 1.0, f"SELECT (count(*) - count(txn_date)) || ' row(s) with an unparseable timestamp' {_C}"),
    _check("txn_clean", "row_reconciliation", f"SELECT {_ACCOUNTED}::DOUBLE / {_KEYS}", 0.95, f"SELECT {_ACCOUNTED} || ' accounted for out of ' || {_KEYS} || ' distinct bronze transactions'"),
]))
_RESULT = "batch_id:s run_date:s table_name:s check_name:s observed:f threshold:f status:s detail:s"


def bronze_gate(ctx: Context):
    return ctx.retail.once("bank_gate_bronze", lambda: bank.validate_bronze(accounts(ctx), txns(ctx), RUN))


def silver_gate(ctx: Context):
    return ctx.retail.once("bank_gate_silver", lambda: bank.validate_silver(
        silver(ctx, "bank_dim"), silver(ctx, "bank_clean"), silver(ctx, "bank_rejects"), txns(ctx), RUN))


query("dq_results_table", _RESULT, "SELECT * FROM {b_gate_bronze} UNION ALL SELECT * FROM {b_gate_silver}")(
    lambda ctx: bronze_gate(ctx).unionByName(silver_gate(ctx)))
# single checks, as parts of the two gates
_ONE = {
    "dq_check_volume": ("table_not_empty",), "dq_check_pk_not_null": ("primary_key_not_null",),
    "dq_check_pk_unique": ("primary_key_unique", "account_id_unique", "txn_id_unique"), "dq_check_whitelist": ("currency_in_whitelist",),
    "dq_check_positive": ("amount_is_positive", "amount_inr_positive"), "dq_check_ref_integrity": ("txn_account_resolves", "no_orphan_transactions"),
    "dq_check_not_null": ("account_id_not_null", "fx_conversion_complete", "txn_date_parsed"), "dq_check_reconcile": ("row_reconciliation",),
}
for _name, _checks in _ONE.items():
    _in = ", ".join(f"'{c}'" for c in _checks)
    query(_name, _RESULT, f"SELECT * FROM (SELECT * FROM {{b_gate_bronze}} UNION ALL SELECT * FROM {{b_gate_silver}}) WHERE check_name IN ({_in})")(
        lambda ctx, cs=_checks: bronze_gate(ctx).unionByName(silver_gate(ctx)).where(F.col("check_name").isin(*cs)))
_VERDICT = "SELECT '{l}' AS layer, CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict, count(*) AS checks, count(*) FILTER (status = 'FAIL') AS failed FROM {{b_gate_{l}}}"


def verdicts(ctx: Context):
    b, s = (quality.gate_verdict(g(ctx)).withColumn("layer", F.lit(n)) for g, n in ((bronze_gate, "bronze"), (silver_gate, "silver")))
    return b.unionByName(s)


query("dq_gate_verdict", "layer:s verdict:s checks:i failed:i", _VERDICT.format(l="bronze") + " UNION ALL " + _VERDICT.format(l="silver"))(verdicts)
query("dq_gate_status", "layer:s dq_status:s", "SELECT layer, verdict AS dq_status FROM (" + _VERDICT.format(l="bronze") + ")")(
    lambda ctx: quality.gate_verdict(bank.validate_bronze(accounts(ctx), txns(ctx), RUN)).select(F.lit("bronze").alias("layer"), F.col("verdict").alias("dq_status")))

# --- quarantine -----------------------------------------------------------------------------------


def _bucket(entity: str, reason: str, key: str, where: str) -> str:
    return f"SELECT {key} AS record_key, '{entity}' AS source_entity, '{reason}' AS reject_reason, '{bank.REMEDIATION[reason]}' AS remediation FROM {{src_{entity[4:].replace('transactions', 'txns')}}} WHERE {where}"


relation("b_quarantine", " UNION ALL ".join([
    _bucket("raw_accounts", "NULL_PRIMARY_KEY", "customer_id", "account_id IS NULL"),
    _bucket("raw_accounts", "DUPLICATE_PRIMARY_KEY", "account_id", "account_id IN (SELECT account_id FROM {src_accounts} GROUP BY 1 HAVING count(*) > 1)"),
    _bucket("raw_accounts", "MISSING_CUSTOMER", "account_id", "account_id IS NOT NULL AND customer_id IS NULL"),
    _bucket("raw_transactions", "NULL_PRIMARY_KEY", "account_id", "txn_id IS NULL"),
    _bucket("raw_transactions", "DUPLICATE_PRIMARY_KEY", "txn_id", "txn_id IN (SELECT txn_id FROM {src_txns} GROUP BY 1 HAVING count(*) > 1)"),
    _bucket("raw_transactions", "INVALID_CURRENCY", "txn_id", f"upper(currency) NOT IN {_CCY}"),
    _bucket("raw_transactions", "NON_POSITIVE_AMOUNT", "txn_id", "amount <= 0"),
    _bucket("raw_transactions", "UNKNOWN_ACCOUNT", "txn_id", f"NOT coalesce({_KNOWN}, false)"),
    _bucket("raw_transactions", "NULL_VALUE", "txn_id", "amount IS NULL OR currency IS NULL"),
]))


def quarantined(ctx: Context):
    return bank.quarantine_records(accounts(ctx), txns(ctx), RUN)


query("dq_quarantine", "record_key:s source_entity:s reject_reason:s remediation:s payload_names_key:b",
      "SELECT *, true AS payload_names_key FROM {b_quarantine}")(
    lambda ctx: quarantined(ctx).withColumn("payload_names_key", F.col("record_key").isNull() | F.contains("record_payload", F.concat(F.lit('"'), "record_key", F.lit('"')))))
query("dq_triage", "source_entity:s reject_reason:s remediation:s records:i", "SELECT source_entity, reject_reason, remediation, count(*) AS records FROM {b_quarantine} GROUP BY 1, 2, 3")(
    lambda ctx: quality.triage(quarantined(ctx)))

# --- profile --------------------------------------------------------------------------------------

def profile_sql(table: str, rel: str, types: dict[str, str]) -> str:
    """Expected profile of a relation."""
    def distinct(c: str, t: str) -> str:
        return f"count(DISTINCT {c}) + CASE WHEN count({c}) < count(*) THEN 1 ELSE 0 END" if t in quality.COUNTED_TYPES else "-1"

    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{t}' AS data_type, count(*) AS table_row_count, count(*) - count({c}) AS null_count, "
        f"{rnd(f'(count(*) - count({c})) * 100.0::DOUBLE / count(*)', 2)} AS null_pct, {distinct(c, t)} AS distinct_count FROM {{{rel}}}" for c, t in types.items())


def schema_types(ddl: str) -> dict[str, str]:
    return dict(part.split() for part in ddl.split(", "))


def shape_types(name: str, **other: str) -> dict[str, str]:
    """Types of a published table, from the shape of its query; ``other`` names those that the shape leaves open."""
    kinds = {"s": "string", "b": "boolean", "d": "date", "t": "timestamp", "f": "double", "i": "bigint"}
    return {**{c: kinds[k] for c, _, k in (part.partition(":") for part in ENTRIES[name].shape.split())}, **other}


_PROFILE = profile_sql("raw_transactions", "src_txns", schema_types(bank.TXN_SCHEMA))
PROFILES = [
    ("bronze", "raw_accounts", "src_accounts", schema_types(bank.ACCOUNT_SCHEMA)), ("bronze", "raw_transactions", "src_txns", schema_types(bank.TXN_SCHEMA)),
    ("silver", "dim_account", "b_dim", shape_types("bank_dim_account", risk_band="int")), ("silver", "txn_clean", "b_clean", shape_types("bank_txn_clean", txn_hour="int")),
    ("silver", "txn_rejects", "b_rejects_all", shape_types("bank_txn_rejects_all")),
    ("gold", "account_balance_daily", "b_balance", shape_types("bank_balance_daily")),
    ("gold", "fraud_signal_summary", "b_summary", shape_types("bank_fraud_summary", peak_txn_score="int", countries_seen="array<string>", channels_seen="array<string>")),
]
query("dq_profile", "table_name:s column_name:s data_type:s table_row_count:i null_count:i null_pct:f distinct_count:i", _PROFILE)(
    lambda ctx: quality.profile(txns(ctx), "raw_transactions", RUN.batch_id, RUN.date))

# --- reconciliation -------------------------------------------------------------------------------


def compared(ctx: Context):
    """Keyed transactions and the cleaned ones, in one shape."""
    return (keyed(ctx).where("amount > 0").select(F.upper("channel").alias("channel"), "txn_id", "amount", "currency"),
            clean(ctx).select("channel", "txn_id", "amount", "currency"))


def controls(ctx: Context):
    """Both by channel."""
    left, right = compared(ctx)
    return quality.compare_controls(
        quality.control_totals(left, F.col("channel"), "amount", "bronze"),
        quality.control_totals(right, F.col("channel"), "amount", "silver"), "bronze", "silver")


_CONTROL = """SELECT coalesce(b.channel, s.channel) AS domain, bn AS bronze_rows, sn AS silver_rows, ba AS bronze_amount, sa AS silver_amount,
  CASE WHEN bn IS NOT DISTINCT FROM sn THEN 'PASS' ELSE 'FAIL' END AS rows_status, CASE WHEN ba IS NOT DISTINCT FROM sa THEN 'PASS' ELSE 'FAIL' END AS amount_status
  FROM (SELECT upper(channel) AS channel, count(*) AS bn, sum(CAST(amount AS DECIMAL(18,2))) AS ba FROM {b_keyed} WHERE amount > 0 GROUP BY 1) b
  FULL JOIN (SELECT channel, count(*) AS sn, sum(CAST(amount AS DECIMAL(18,2))) AS sa FROM {b_clean} GROUP BY 1) s ON b.channel = s.channel"""
relation("b_controls", _CONTROL)
query("recon_rowcount", "domain:s bronze_rows:i silver_rows:i rows_status:s", "SELECT * FROM {b_controls}")(controls)
query("recon_sum", "domain:s bronze_amount:f silver_amount:f amount_status:s", "SELECT * FROM {b_controls}")(controls)
# the expected side has no digest: it compares the rows themselves
_BOTH = ("SELECT upper(channel) AS channel, txn_id, amount, currency FROM {b_keyed} WHERE amount > 0", "SELECT channel, txn_id, amount, currency FROM {b_clean}")
relation("b_differing", f"""SELECT channel, txn_id, amount, currency, sum(l) AS left_copies, sum(r) AS right_copies FROM (
  SELECT *, 1 AS l, 0 AS r FROM ({_BOTH[0]}) UNION ALL SELECT *, 0, 1 FROM ({_BOTH[1]})) GROUP BY 1, 2, 3, 4 HAVING sum(l) <> sum(r)""")
query("recon_checksum", "domain:s checksum_status:s", """SELECT domain, CASE WHEN EXISTS (SELECT 1 FROM {b_differing} d WHERE d.channel IS NOT DISTINCT FROM c.domain) THEN 'FAIL' ELSE 'PASS' END AS checksum_status
  FROM {b_controls} c""")(controls)
query("recon_locate", "channel:s txn_id:s amount:f currency:s left_copies:i right_copies:i", "SELECT * FROM {b_differing}")(
    lambda ctx: quality.differing_rows(*compared(ctx), ["txn_id"]))
query("recon_variance", "domain:s bronze_amount:f silver_amount:f variance_pct:f status:s",
      f"SELECT *, CASE WHEN variance_pct <= 0.5 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT *, {rnd('abs(CAST(silver_amount - bronze_amount AS DOUBLE)) * 100 / CAST(bronze_amount AS DOUBLE)', 4, 9)} AS variance_pct FROM {{b_controls}})")(
    lambda ctx: quality.variance_check(controls(ctx), "silver_amount", "bronze_amount", 0.5))
