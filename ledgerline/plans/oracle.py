"""Independent DuckDB SQL for every registered query that SQL can express.

The views ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are assumed to be
registered.  Only the derivation of the raw stand-in text is shared with the
Spark side (it is input preparation, not an operator under test).
"""

from __future__ import annotations

from ledgerline import presets
from ledgerline.plans import standins
from ledgerline.plans.queries import (CALLS_FROM, DEV_SUBSET_ROWS, ORDER_PRIORITY_TIERS, ORDER_RANGES,
                                      POLICY_REGION, PRICE_STEPS, PROMPT_VERSIONS, READER_GROUPS, STREAM_BATCHES)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _round(expr: str, digits: int) -> str:
    """Spark's ``round`` on a double: HALF_UP on the double's shortest decimal
    text (DuckDB's own ``round`` works on the binary value, which differs at
    ties such as 9.575)."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def _avg(expr: str, digits: int) -> str:
    return _round(f"avg({expr})", digits)


def _sum(expr: str, digits: int) -> str:
    return _round(f"sum({expr})", digits)


def _in_list(values) -> str:
    return ", ".join(_q(v) for v in values)


def _tier_case(col: str, groups, default: str) -> str:
    whens = " ".join(f"WHEN {col} IN ({_in_list(v)}) THEN {_q(label)}" for v, label in groups)
    return f"CASE {whens} ELSE {_q(default)} END"


def _decode_case(col: str, mapping, default: str) -> str:
    whens = " ".join(f"WHEN {col} = {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {_q(default)} END"


LOANS_RAW = standins.loans_raw_sql()
MORTGAGE_RAW = standins.mortgage_raw_sql()

LOAN_TYPED = f"""
SELECT id, TRY_CAST(loan_amnt AS DOUBLE) AS loan_amnt, TRY_CAST(funded_amnt AS DOUBLE) AS funded_amnt,
       term, TRY_CAST(replace(int_rate, '%', '') AS DOUBLE) AS int_rate, grade, sub_grade, emp_length,
       home_ownership, TRY_CAST(annual_inc AS DOUBLE) AS annual_inc, loan_status, purpose, addr_state,
       TRY_CAST(dti AS DOUBLE) AS dti, issue_d,
       TRY_CAST(replace(term, ' months', '') AS INTEGER) AS term_months,
       CAST(try_strptime(issue_d, '%b-%Y') AS DATE) AS issue_date
FROM ({LOANS_RAW}) raw
"""

LOAN_SILVER = f"""
SELECT * FROM ({LOAN_TYPED}) t
WHERE loan_status IN ({_in_list(presets.LOAN_STATUSES)}) AND loan_amnt IS NOT NULL AND annual_inc IS NOT NULL
"""

RISK_TIER = _tier_case("grade", presets.RISK_TIERS, presets.RISK_TIER_DEFAULT)

LOAN_GOLD = f"""
SELECT grade, loan_status, count(id) AS loan_count,
       {_avg("loan_amnt", 2)} AS avg_loan_amt, {_avg("int_rate", 2)} AS avg_interest_rate,
       {_avg("annual_inc", 2)} AS avg_annual_income, {_avg("dti", 2)} AS avg_dti,
       {_sum("loan_amnt", 2)} AS total_loan_volume, {RISK_TIER} AS risk_tier
FROM ({LOAN_SILVER}) s GROUP BY grade, loan_status
"""

DECL_TYPED = f"""
SELECT id, TRY_CAST(loan_amnt AS DOUBLE) AS loan_amnt, funded_amnt, term,
       TRY_CAST(replace(int_rate, '%', '') AS DOUBLE) AS int_rate, grade, sub_grade, home_ownership,
       TRY_CAST(annual_inc AS DOUBLE) AS annual_inc, loan_status, purpose, addr_state,
       TRY_CAST(dti AS DOUBLE) AS dti, issue_d
FROM ({LOANS_RAW}) raw
"""

MORTGAGE_PROJ = f"""
SELECT activity_year, lei, loan_type, loan_purpose, action_taken, loan_amount, interest_rate, loan_term,
       property_value, income, debt_to_income_ratio, "applicant_race-1" AS applicant_race, applicant_sex,
       applicant_age, county_code
FROM ({MORTGAGE_RAW}) raw
"""

MORTGAGE_SILVER = f"""
SELECT activity_year, lei, loan_type, loan_purpose, action_taken,
       TRY_CAST(loan_amount AS DOUBLE) AS loan_amount, TRY_CAST(interest_rate AS DOUBLE) AS interest_rate,
       TRY_CAST(loan_term AS INTEGER) AS loan_term, TRY_CAST(property_value AS DOUBLE) AS property_value,
       TRY_CAST(income AS DOUBLE) AS income, debt_to_income_ratio, applicant_race, applicant_sex,
       applicant_age, county_code,
       {_decode_case('action_taken', presets.ACTION_LABELS, presets.CODE_DEFAULT)} AS action_label,
       {_decode_case('loan_purpose', presets.PURPOSE_LABELS, presets.CODE_DEFAULT)} AS loan_purpose_label,
       {_decode_case('loan_type', presets.LOAN_TYPE_LABELS, presets.CODE_DEFAULT)} AS loan_type_label
FROM ({MORTGAGE_PROJ}) p
WHERE action_taken IN ({_in_list(presets.KEPT_ACTIONS)}) AND TRY_CAST(loan_amount AS DOUBLE) IS NOT NULL
"""

MORTGAGE_GOLD = f"""
SELECT loan_purpose_label, action_label, loan_type_label, count(*) AS application_count,
       {_avg("loan_amount", 2)} AS avg_loan_amount, {_avg("interest_rate", 2)} AS avg_interest_rate,
       {_avg("income", 2)} AS avg_income,
       {_avg("TRY_CAST(replace(debt_to_income_ratio, '%', '') AS DOUBLE)", 2)} AS avg_dti,
       {_sum("loan_amount", 2)} AS total_loan_volume,
       {_decode_case('action_label', presets.APPROVAL_TIERS, presets.CODE_DEFAULT)} AS approval_tier
FROM ({MORTGAGE_SILVER}) s GROUP BY loan_purpose_label, action_label, loan_type_label
"""

ORDER_CHANGES = """
SELECT o_orderkey AS id, o_orderstatus AS old_status, 'F' AS new_status, o_totalprice * 1.05 AS loan_amnt
FROM orders WHERE o_orderstatus = 'P'
"""

ORDERS_MERGED = f"""
SELECT t.o_orderkey, t.o_custkey,
       CASE WHEN c.id IS NOT NULL THEN c.new_status ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN c.id IS NOT NULL THEN c.loan_amnt ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderdate, t.o_orderpriority
FROM orders t LEFT JOIN ({ORDER_CHANGES}) c ON t.o_orderkey = c.id
"""

EVENT_BATCHES = f"""
SELECT e.*, CAST(((event_id - b.lo) * {STREAM_BATCHES}) // (b.hi - b.lo + 1) + 1 AS INTEGER) AS arrival_batch
FROM events e, (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events) b
"""

STREAM_PREFIX = f"""
SELECT CAST(n.batch AS INTEGER) AS batch, e.event_type, count(e.event_id) AS count, {_avg("e.value", 2)} AS avg_amount,
       {_avg("e.user_id", 0)} AS avg_score
FROM ({EVENT_BATCHES}) e JOIN range(1, {STREAM_BATCHES + 1}) n(batch) ON e.arrival_batch <= n.batch
GROUP BY n.batch, e.event_type
"""


def _render_sql(template: str) -> str:
    """The DuckDB form of a ``str.format`` template over the gold columns."""
    import string
    parts = []
    for literal, field, spec, _ in string.Formatter().parse(template):
        if literal:
            parts.append(_q(literal))
        if field is None:
            continue
        if spec == ",.2f":
            parts.append(f"coalesce(format('{{:,.2f}}', CAST({field} AS DOUBLE)), 'n/a')")
        else:
            parts.append(f"coalesce(CAST({field} AS VARCHAR), 'n/a')")
    return " || ".join(parts)


PROMPTS = " UNION ALL ".join(
    f"SELECT grade, loan_status, risk_tier, {_q(v)} AS prompt_version, "
    f"{_q(presets.PROMPT_REGISTRY[v]['model'])} AS model, "
    f"{_render_sql(presets.PROMPT_REGISTRY[v]['template'])} AS prompt "
    f"FROM ({LOAN_GOLD}) g WHERE loan_status IN ({_in_list(presets.NARRATIVE_STATUSES)})"
    for v in PROMPT_VERSIONS)

_PRICE = presets.PRICES[presets.DEFAULT_MODEL]


def _counted(prompts: str) -> str:
    """What the stand-in text model says to each prompt."""
    return f"SELECT *, 'Segment text of ' || length(prompt) || ' characters.' AS narrative FROM ({prompts}) p"


NARRATED = _counted(
    f"SELECT grade, loan_status, risk_tier, {_render_sql(presets.SEGMENT_NARRATIVE_TEMPLATE)} AS prompt "
    f"FROM ({LOAN_GOLD}) g WHERE loan_status IN ({_in_list(presets.NARRATIVE_STATUSES)})")

COST_LOG = f"""
SELECT prompt_version, model, narrative, input_tokens, output_tokens,
       CAST(input_tokens + output_tokens AS INTEGER) AS total_tokens,
       {_round(f"input_tokens / 1000 * {_PRICE['input_cost_per_1k']} + output_tokens / 1000 * {_PRICE['output_cost_per_1k']}", 6)} AS cost_usd,
       true AS timed
FROM (SELECT prompt_version, model, narrative, CAST(ceil(length(prompt) / 4) AS INTEGER) AS input_tokens,
             CAST(ceil(length(narrative) / 4) AS INTEGER) AS output_tokens FROM ({_counted(PROMPTS)}) n) t
"""

CALLS = f"""
SELECT conv_id,
       CASE WHEN conv_id % 2 = 0 THEN {_q(PROMPT_VERSIONS[0])} ELSE {_q(PROMPT_VERSIONS[1])} END AS prompt_version,
       {_q(presets.DEFAULT_MODEL)} AS model,
       CAST(coalesce(sum(CASE WHEN role <> 'assistant' THEN CAST(ceil(length(text) / 4) AS INTEGER) END), 0) AS INTEGER) AS input_tokens,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN CAST(ceil(length(text) / 4) AS INTEGER) END), 0) AS INTEGER) AS output_tokens
FROM conversations GROUP BY conv_id
"""

COSTS = f"""
SELECT conv_id, prompt_version, model, input_tokens, output_tokens,
       CAST(input_tokens + output_tokens AS INTEGER) AS total_tokens,
       {_round(f"input_tokens / 1000 * {_PRICE['input_cost_per_1k']} + output_tokens / 1000 * {_PRICE['output_cost_per_1k']}", 6)} AS cost_usd
FROM ({CALLS}) c
"""


_PRICE_ROWS = ", ".join(f"({_q(presets.DEFAULT_MODEL)}, {i}, {o}, {'CAST(NULL AS TIMESTAMP)' if at is None else f'TIMESTAMP {_q(str(at))}'})"
                        for at, i, o in PRICE_STEPS)


def _pct(num: str, den: str) -> str:
    return f"{_round(f"CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE {num}) / nullif(count(*) FILTER (WHERE {den}), 0)", 1)}"


# DuckDB forms of presets.BRONZE_LOAN_EXPECTATIONS
BRONZE_CHECKS_SQL = {
    "id_present": "id IS NOT NULL",
    "loan_amnt_numeric": "TRY_CAST(loan_amnt AS DOUBLE) IS NOT NULL",
    "annual_inc_numeric": "TRY_CAST(annual_inc AS DOUBLE) IS NOT NULL",
    "loan_status_known": f"loan_status IN ({_in_list(presets.LOAN_STATUSES)})",
    "issue_d_month_year": "try_strptime(issue_d, '%b-%Y') IS NOT NULL",
}

INCOME_BAND = ("CASE WHEN income IS NULL THEN 'unknown' WHEN income < 50 THEN 'under 50' "
               "WHEN income < 100 THEN '50 to 100' ELSE '100 and over' END")

ORACLE: dict[str, str] = {
    "loan_gold": LOAN_GOLD,
    "gold_summary": f"""
SELECT o_orderpriority AS grade, o_orderstatus AS loan_status, count(o_orderkey) AS loan_count,
       {_avg("o_totalprice", 2)} AS avg_loan_amt, {_sum("o_totalprice", 2)} AS total_loan_volume,
       {_tier_case('o_orderpriority', ORDER_PRIORITY_TIERS, 'Unknown')} AS risk_tier
FROM orders GROUP BY o_orderpriority, o_orderstatus""",
    "silver_clean": LOAN_SILVER,
    "silver_profile": f"""
SELECT grade, count(*) AS loan_count, {_avg("loan_amnt", 2)} AS avg_loan_amt,
       {_avg("int_rate", 2)} AS avg_interest_rate, {_avg("dti", 2)} AS avg_dti
FROM ({LOAN_SILVER}) s GROUP BY grade""",
    "bronze_profile": f"""
SELECT loan_status, count(*) AS loan_count, {_avg("TRY_CAST(loan_amnt AS DOUBLE)", 2)} AS avg_loan_amount
FROM ({LOANS_RAW}) r GROUP BY loan_status""",
    "loan_chain_e2e": LOAN_GOLD,
    "declarative_gold": f"""
SELECT grade, loan_status, count(id) AS loan_count, {_avg("loan_amnt", 2)} AS avg_loan_amt,
       {_avg("int_rate", 2)} AS avg_interest_rate, {_avg("dti", 2)} AS avg_dti,
       {_sum("loan_amnt", 2)} AS total_loan_volume, {RISK_TIER} AS risk_tier
FROM ({DECL_TYPED}) t
WHERE loan_status IN ({_in_list(presets.LOAN_STATUSES)}) AND loan_amnt IS NOT NULL
GROUP BY grade, loan_status""",
    "expectation_report": " UNION ALL ".join(
        f"SELECT {_q(name)} AS expectation, count(*) AS total_rows, "
        f"count(*) FILTER (WHERE coalesce({cond}, false)) AS passed_rows, "
        f"count(*) FILTER (WHERE NOT coalesce({cond}, false)) AS failed_rows FROM ({DECL_TYPED}) t"
        for name, cond in presets.LOAN_EXPECTATIONS.items()),
    "bronze_validation": " UNION ALL ".join(
        f"SELECT {_q(name)} AS expectation, count(*) AS total_rows, "
        f"count(*) FILTER (WHERE coalesce({cond}, false)) AS passed_rows, "
        f"count(*) FILTER (WHERE NOT coalesce({cond}, false)) AS failed_rows FROM ({LOANS_RAW}) r"
        for name, cond in BRONZE_CHECKS_SQL.items()),
    "layer_reconcile": f"""
WITH s AS ({LOAN_SILVER}), g AS (SELECT grade, loan_status, count(id) AS loan_count FROM s GROUP BY grade, loan_status),
c AS (SELECT (SELECT count(*) FROM lineitem) AS bronze_rows, (SELECT count(*) FROM s) AS silver_rows,
             (SELECT count(*) FROM g) AS gold_rows, (SELECT CAST(sum(loan_count) AS BIGINT) FROM g) AS gold_count_sum)
SELECT 'bronze_rows' AS measure, CAST(bronze_rows AS BIGINT) AS value FROM c
UNION ALL SELECT 'silver_rows', silver_rows FROM c
UNION ALL SELECT 'gold_rows', gold_rows FROM c
UNION ALL SELECT 'gold_count_sum', gold_count_sum FROM c
UNION ALL SELECT 'dropped_rows', bronze_rows - silver_rows FROM c
UNION ALL SELECT 'gold_matches_silver', CAST(gold_count_sum = silver_rows AS BIGINT) FROM c""",
    "default_rate": f"""
SELECT grade,
       count(*) FILTER (WHERE loan_status = 'Charged Off') AS numerator_rows,
       count(*) FILTER (WHERE loan_status IN ('Charged Off', 'Fully Paid')) AS denominator_rows,
       {_pct("loan_status = 'Charged Off'", "loan_status IN ('Charged Off', 'Fully Paid')")} AS charged_off_pct
FROM ({LOAN_SILVER}) s GROUP BY grade""",
    "gold_regroup": f"""
SELECT grade, risk_tier, CAST(sum(loan_count) AS BIGINT) AS total_loans, {_sum("total_loan_volume", 2)} AS total_volume
FROM ({LOAN_GOLD}) g GROUP BY grade, risk_tier""",
    "rename_dashed": MORTGAGE_PROJ,
    "label_decode": MORTGAGE_SILVER,
    "label_profile": f"""
SELECT loan_purpose_label, action_label, count(*) AS application_count, {_avg("loan_amount", 2)} AS avg_loan_amount
FROM ({MORTGAGE_SILVER}) s GROUP BY loan_purpose_label, action_label""",
    "gold_three_key": MORTGAGE_GOLD,
    "combo_topk": f"""
SELECT action_taken, loan_purpose, loan_type, count(*) AS application_count
FROM ({MORTGAGE_RAW}) r GROUP BY action_taken, loan_purpose, loan_type
ORDER BY application_count DESC, action_taken NULLS FIRST, loan_purpose NULLS FIRST, loan_type NULLS FIRST
LIMIT 10""",
    "denial_rate": f"""
SELECT loan_purpose_label, count(*) FILTER (WHERE action_label = 'Denied') AS numerator_rows,
       count(*) AS denominator_rows, {_pct("action_label = 'Denied'", "true")} AS denial_pct
FROM ({MORTGAGE_SILVER}) s GROUP BY loan_purpose_label""",
    "denial_rate_by_group": f"""
SELECT applicant_race, {INCOME_BAND} AS income_band, count(*) FILTER (WHERE action_label = 'Denied') AS numerator_rows,
       count(*) AS denominator_rows, {_pct("action_label = 'Denied'", "true")} AS denial_pct
FROM ({MORTGAGE_SILVER}) s GROUP BY applicant_race, {INCOME_BAND}""",
    "mortgage_chain_e2e": MORTGAGE_GOLD,
    "mortgage_quality": " UNION ALL ".join(
        f"SELECT {_q(name)} AS expectation, count(*) AS total_rows, "
        f"count(*) FILTER (WHERE coalesce({cond}, false)) AS passed_rows, "
        f"count(*) FILTER (WHERE NOT coalesce({cond}, false)) AS failed_rows FROM ({MORTGAGE_SILVER}) s"
        for name, cond in {
            "dti_numeric": "TRY_CAST(replace(debt_to_income_ratio, '%', '') AS DOUBLE) IS NOT NULL",
            "interest_rate_present": "interest_rate IS NOT NULL",
            "income_present": "income IS NOT NULL",
            "loan_term_present": "loan_term IS NOT NULL",
        }.items()),
    "ordered_subset": f"SELECT * FROM orders ORDER BY o_orderkey LIMIT {DEV_SUBSET_ROWS}",
    "bronze_csv_roundtrip": "SELECT * FROM customer",
    "export_roundtrip": LOAN_GOLD,
    "export_manifest": f"""
SELECT 'loan_risk' AS "table", CAST(1 AS BIGINT) AS files, count(*) AS rows, true AS sound FROM ({LOAN_GOLD}) g
UNION ALL
SELECT 'mortgage_risk', CAST(1 AS BIGINT), count(*), true FROM ({MORTGAGE_GOLD}) m
UNION ALL
SELECT 'narratives', CAST(1 AS BIGINT), count(*), true FROM ({NARRATED}) n""",
    "export_verify": f"""
SELECT 'loan_risk' AS "table", count(*) AS expected_rows, count(*) AS exported_rows, true AS matches,
       true AS digest_matches FROM ({LOAN_GOLD}) g
UNION ALL
SELECT 'mortgage_risk', count(*), count(*), true, true FROM ({MORTGAGE_GOLD}) m
UNION ALL
SELECT 'narratives', count(*), count(*), true, true FROM ({NARRATED}) n""",
    "gold_readback": f"""
SELECT risk_tier, grade, loan_status, loan_count, avg_loan_amt, avg_interest_rate, avg_dti, total_loan_volume
FROM ({LOAN_GOLD}) g WHERE loan_status IN ({_in_list(presets.NARRATIVE_STATUSES)})""",
    "bronze_rejects": """
SELECT line, CAST(length(line) - length(replace(line, ',', '')) + 1 AS INTEGER) AS n_fields
FROM (SELECT CASE WHEN c_custkey % 7 = 0 THEN concat_ws(',', c_custkey, c_name, c_nationkey)
                  ELSE concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'surplus') END AS line
      FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0) l""",
    "bronze_fitting": "SELECT * FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0",
    "catalog_layers": "SELECT * FROM orders",
    "source_shape": f"""
SELECT 'loans_raw' AS source, count(*) AS row_count, CAST({len(standins.LOANS_RAW)} AS BIGINT) AS column_count
FROM lineitem""",
    "merge_update": ORDERS_MERGED,
    "replay_changes": ORDERS_MERGED,
    "merge_bucketed": ORDERS_MERGED,
    "merge_ranged": f"""
SELECT o.o_orderkey, o.o_custkey, CASE WHEN hit THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN hit THEN o_totalprice * 1.05 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, o_orderstatus = 'P'
                AND o_orderkey // ((SELECT max(o_orderkey) FROM orders) // {ORDER_RANGES} + 1) IN (3, 4) AS hit
      FROM orders) o""",
    "gold_refresh": f"""
SELECT o_orderpriority, o_orderstatus, count(o_orderkey) AS loan_count, {_avg("o_totalprice", 2)} AS avg_loan_amt,
       {_sum("o_totalprice", 2)} AS total_loan_volume
FROM (SELECT o_orderkey, o_orderstatus,
             CASE WHEN low THEN '2-HIGH' ELSE o_orderpriority END AS o_orderpriority,
             CASE WHEN low THEN o_totalprice - 100 ELSE o_totalprice END AS o_totalprice
      FROM (SELECT *, o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AS low FROM ({ORDERS_MERGED}) m) l) o
GROUP BY o_orderpriority, o_orderstatus""",
    "key_lookup": f"""
SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(length(CAST(o_orderkey AS VARCHAR)) AS INTEGER) AS id_length
FROM ({ORDERS_MERGED}) m WHERE o_orderkey IN (SELECT id FROM ({ORDER_CHANGES}) c)""",
    "change_log": f"""
SELECT id AS o_orderkey, old_status, new_status, loan_amnt, {_q(presets.CHANGE_OPERATION)} AS operation,
       {_q(presets.CHANGE_SOURCE_SYSTEM)} AS source_system, TIMESTAMP '2026-06-20 12:00:00' AS change_timestamp
FROM ({ORDER_CHANGES}) c""",
    "version_history": f"""
SELECT CAST(1 AS BIGINT) AS version, 'MERGE' AS operation, (SELECT count(*) FROM orders) AS num_output_rows,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS num_updated_rows
UNION ALL
SELECT CAST(0 AS BIGINT), 'WRITE', (SELECT count(*) FROM orders), CAST(NULL AS BIGINT)""",
    "as_of_before_after": f"""
SELECT b.o_orderkey, b.o_orderstatus AS o_orderstatus_before, a.o_orderstatus AS o_orderstatus_after,
       b.o_totalprice AS o_totalprice_before, a.o_totalprice AS o_totalprice_after
FROM orders b JOIN ({ORDERS_MERGED}) a ON a.o_orderkey = b.o_orderkey
WHERE b.o_orderkey IN (SELECT id FROM ({ORDER_CHANGES}) c)""",
    "stream_prefix_agg": STREAM_PREFIX,
    "stream_available_now": STREAM_PREFIX,
    "stream_keyed": f"SELECT event_type, count, avg_amount, avg_score FROM ({STREAM_PREFIX}) p WHERE batch = {STREAM_BATCHES}",
    "dated_cost": f"""
WITH steps(model, p_in, p_out, valid_from) AS (VALUES {_PRICE_ROWS}),
spans AS (SELECT *, lead(valid_from) OVER (PARTITION BY model ORDER BY valid_from NULLS FIRST) AS valid_to FROM steps)
SELECT conv_id, prompt_version, c.model, input_tokens, output_tokens, called_at,
       CAST(input_tokens + output_tokens AS INTEGER) AS total_tokens,
       {_round("input_tokens / 1000 * p_in + output_tokens / 1000 * p_out", 6)} AS cost_usd
FROM (SELECT *, CAST(DATE '{CALLS_FROM}' + CAST(conv_id % 365 AS INTEGER) AS TIMESTAMP) AS called_at FROM ({CALLS}) c) c
JOIN spans s ON s.model = c.model AND (s.valid_from IS NULL OR called_at >= s.valid_from)
     AND (s.valid_to IS NULL OR called_at < s.valid_to)""",
    "narratives_resumed": f"""
SELECT grade, loan_status, risk_tier, narrative AS ai_risk_narrative,
       CASE WHEN loan_status = {_q(presets.NARRATIVE_STATUSES[0])} THEN 'first' ELSE 'second' END AS run,
       CAST(ceil(length(prompt) / 4) AS INTEGER) AS input_tokens,
       CAST(ceil(length(narrative) / 4) AS INTEGER) AS output_tokens
FROM ({NARRATED}) n""",
    "version_compare_runs": f"""
SELECT version_a, version_b, calls_a, total_tokens_a, cost_usd_a, calls_b, total_tokens_b, cost_usd_b,
       {_round("cost_usd_b - cost_usd_a", 6)} AS cost_difference, true AS timed
FROM (
  SELECT {_q(PROMPT_VERSIONS[0])} AS version_a, {_q(PROMPT_VERSIONS[1])} AS version_b,
         count(*) FILTER (WHERE prompt_version = {_q(PROMPT_VERSIONS[0])}) AS calls_a,
         CAST(sum(total_tokens) FILTER (WHERE prompt_version = {_q(PROMPT_VERSIONS[0])}) AS BIGINT) AS total_tokens_a,
         {_sum(f"CASE WHEN prompt_version = {_q(PROMPT_VERSIONS[0])} THEN cost_usd END", 6)} AS cost_usd_a,
         count(*) FILTER (WHERE prompt_version = {_q(PROMPT_VERSIONS[1])}) AS calls_b,
         CAST(sum(total_tokens) FILTER (WHERE prompt_version = {_q(PROMPT_VERSIONS[1])}) AS BIGINT) AS total_tokens_b,
         {_sum(f"CASE WHEN prompt_version = {_q(PROMPT_VERSIONS[1])} THEN cost_usd END", 6)} AS cost_usd_b
  FROM ({COST_LOG}) c) v""",
    "prompt_render": PROMPTS,
    "token_cost": COSTS,
    "cost_by_version": f"""
SELECT prompt_version, count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
       CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
       {_sum("cost_usd", 6)} AS total_cost_usd, {_avg("cost_usd", 6)} AS avg_cost_usd
FROM ({COSTS}) c GROUP BY prompt_version""",
    "version_compare": f"""
SELECT {_q(PROMPT_VERSIONS[0])} AS version_a, {_q(PROMPT_VERSIONS[1])} AS version_b,
       calls_a, total_tokens_a, cost_usd_a, calls_b, total_tokens_b, cost_usd_b,
       {_round("cost_usd_b - cost_usd_a", 6)} AS cost_difference,
       duration_ms_a, duration_ms_b, duration_ms_b - duration_ms_a AS duration_difference_ms
FROM (
  SELECT count(*) FILTER (WHERE prompt_version = {_q(PROMPT_VERSIONS[0])}) AS calls_a,
         CAST(sum(total_tokens) FILTER (WHERE prompt_version = {_q(PROMPT_VERSIONS[0])}) AS BIGINT) AS total_tokens_a,
         {_sum(f"CASE WHEN prompt_version = {_q(PROMPT_VERSIONS[0])} THEN cost_usd END", 6)} AS cost_usd_a,
         count(*) FILTER (WHERE prompt_version = {_q(PROMPT_VERSIONS[1])}) AS calls_b,
         CAST(sum(total_tokens) FILTER (WHERE prompt_version = {_q(PROMPT_VERSIONS[1])}) AS BIGINT) AS total_tokens_b,
         {_sum(f"CASE WHEN prompt_version = {_q(PROMPT_VERSIONS[1])} THEN cost_usd END", 6)} AS cost_usd_b,
         sum(output_tokens * 20.0::DOUBLE) FILTER (WHERE prompt_version = {_q(PROMPT_VERSIONS[0])}) AS duration_ms_a,
         sum(output_tokens * 20.0::DOUBLE) FILTER (WHERE prompt_version = {_q(PROMPT_VERSIONS[1])}) AS duration_ms_b
  FROM ({COSTS}) c WHERE prompt_version IN ({_in_list(PROMPT_VERSIONS)})
) v""",
    "narratives": f"SELECT grade, loan_status, risk_tier, narrative AS ai_risk_narrative FROM ({NARRATED}) n",
    "cost_log": COST_LOG,
    "masked_view": """
SELECT c_custkey,
       regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name,
       c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
    "row_policy": f"""
SELECT * FROM customer WHERE c_nationkey IN (
  SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = {_q(POLICY_REGION)})""",
    "row_policy_view": f"""
SELECT c_custkey,
       regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name,
       c_nationkey, c_acctbal, c_mktsegment, r_name AS reader
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ({_in_list(READER_GROUPS)})""",
}
