"""The SQL (DuckDB dialect) that each query must agree with, from the test tables up."""

from __future__ import annotations

from catalogue.views import FINAL_INSTALLMENT, STARTED_BEFORE

LMS = [
    "loan_id", "customer_id", "loan_start_date", "tenure", "installment_num", "loan_amt", "due_amt",
    "paid_amt", "overdue_amt", "balance", "snapshot_date",
]
CLICKSTREAM = ["customer_id", "fe_1", "fe_2", "fe_3", "fe_4", "snapshot_date"]
ATTRIBUTES = ["customer_id", "name", "age", "ssn", "occupation", "snapshot_date"]
NUMBERS = [
    "annual_income", "monthly_inhand_salary", "interest_rate", "changed_credit_limit",
    "outstanding_debt", "credit_utilization_ratio", "total_emi_per_month", "amount_invested_monthly",
]
INTEGERS = [
    "num_credit_inquiries", "num_of_delayed_payment", "delay_from_due_date", "num_credit_card",
    "num_bank_accounts",
]
FINANCIALS = [
    "customer_id", *NUMBERS, "monthly_balance", *INTEGERS, "credit_history_age", "credit_mix",
    "payment_behaviour", "type_of_loan", "num_of_loan", "snapshot_date",
]

CUSTOMER = "' CUS_' || o_custkey || ' '"
SHIP_MONTH = "CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR)"
ORDER_MONTH = "CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR)"


def _dec(c: str, scale: int = 2) -> str:
    return f"CAST({c} AS DECIMAL(18,{scale}))"


def _txt(c: str, scale: int = 2) -> str:
    return f"CAST({_dec(c, scale)} AS VARCHAR)"


PRICE = _dec("l_extendedprice")

RAW_LMS = f"""
raw_lms AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS loan_id, {CUSTOMER} AS customer_id,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS loan_start_date, '7' AS tenure,
    CAST(l_linenumber AS VARCHAR) AS installment_num, CAST({PRICE} AS VARCHAR) AS loan_amt,
    CASE WHEN l_quantity = 1 THEN '0.00' ELSE {_txt(f"{PRICE} * {_dec('0.02')}", 4)} END AS due_amt,
    {_txt(f"{PRICE} * {_dec('l_tax')}", 4)} AS paid_amt,
    CASE WHEN l_tax = 0.08::DOUBLE AND l_linenumber = 1 THEN ''
         ELSE {_txt(f"{PRICE} * {_dec('l_discount')}", 4)} END AS overdue_amt,
    {_txt('o_totalprice')} AS balance, {SHIP_MONTH} AS snapshot_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RAW_CLICKSTREAM = f"""
raw_clickstream AS (
  SELECT {CUSTOMER} AS customer_id, {_txt('l_quantity')} AS fe_1, {_txt('l_discount')} AS fe_2,
    {_txt('l_tax')} AS fe_3,
    CASE WHEN l_quantity = 50 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS fe_4,
    {SHIP_MONTH} AS snapshot_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

AGE = "CAST(18 + (o_custkey + o_orderkey) % 60 AS VARCHAR)"
RAW_ATTRIBUTES = f"""
raw_attributes AS (
  SELECT {CUSTOMER} AS customer_id, replace(c_name, '#', '   ') AS name,
    CASE WHEN o_custkey % 11 = 0 THEN '-500' WHEN o_custkey % 13 = 0 THEN ''
         WHEN o_custkey % 7 = 0 THEN {AGE} || '_' ELSE {AGE} END AS age,
    CASE WHEN o_custkey % 5 = 0 THEN '#F%$D@*&8'
         ELSE lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') || '-'
           || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') || '-'
           || lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS ssn,
    CASE WHEN o_custkey % 9 = 0 THEN '_______'
         ELSE '  __' || c_mktsegment || ' (' || o_orderpriority || ')__ ' END AS occupation,
    {ORDER_MONTH} AS snapshot_date
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

RAW_FINANCIALS = f"""
raw_financials AS (
  SELECT {CUSTOMER} AS customer_id,
    {_txt('o_totalprice')} || CASE WHEN o_custkey % 6 = 0 THEN '_' ELSE '' END AS annual_income,
    CASE WHEN l_linenumber = 3 THEN '' ELSE {_txt('c_acctbal')} END AS monthly_inhand_salary,
    l_linenumber || '.0.5' AS interest_rate,
    CASE l_linenumber WHEN 2 THEN '_' WHEN 6 THEN '1.5e6' ELSE {_txt('l_discount')} END AS changed_credit_limit,
    {_txt('l_extendedprice')} || CASE WHEN l_returnflag = 'R' THEN '_' ELSE '' END AS outstanding_debt,
    {_txt('p_retailprice')} AS credit_utilization_ratio,
    CASE WHEN l_linestatus = 'F' AND l_linenumber = 4
         THEN {_txt('l_quantity')} || '-' || {_txt('l_quantity')}
         ELSE {_txt('l_quantity')} END AS total_emi_per_month,
    CASE WHEN l_returnflag = 'A' THEN '__10000__' ELSE '--' || {_txt('l_quantity')} END
      AS amount_invested_monthly,
    CASE WHEN l_linenumber = 5 THEN '__-333333333333333333333333333__'
         ELSE {_txt('c_acctbal')} END AS monthly_balance,
    CAST(p_size AS VARCHAR) AS num_credit_inquiries, l_linenumber || '_' AS num_of_delayed_payment,
    CAST(l_linenumber - 3 AS VARCHAR) AS delay_from_due_date, p_size || '.0' AS num_credit_card,
    CASE WHEN l_linenumber = 7 THEN '99999999999' WHEN l_linenumber = 6 THEN '_'
         ELSE CAST(l_linenumber AS VARCHAR) END AS num_bank_accounts,
    CASE WHEN l_linenumber > 1 THEN p_size || ' Years and ' || l_linenumber || ' Months' END
      AS credit_history_age,
    CASE l_returnflag WHEN 'A' THEN '_' WHEN 'N' THEN 'Standard' END AS credit_mix,
    CASE WHEN l_linestatus = 'F' THEN '!@9#%8' ELSE 'High_spent_Small_value_payments' END
      AS payment_behaviour,
    CASE WHEN l_linenumber = 1 THEN ', ' || p_type || ' Loan ,, ' || p_name || ' and '
         WHEN l_linenumber = 2 THEN ''
         ELSE p_type || ' Loan, ' || p_name || ' Loan, and ' || p_type || ' Loan' END AS type_of_loan,
    '99' AS num_of_loan, {SHIP_MONTH} AS snapshot_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey)"""


def _normal(name: str, columns: list[str]) -> str:
    """Blank → NULL, trimmed, lower-case text; the snapshot as a date."""
    cells = [f"lower(trim(nullif({c}, ''))) AS {c}" for c in columns if c != "snapshot_date"]
    return f"""
normal_{name} AS (
  SELECT {', '.join(cells)}, CAST(snapshot_date AS DATE) AS snapshot_date FROM raw_{name})"""


def _kept(name: str, columns: list[str]) -> str:
    """The smallest row per customer and snapshot."""
    rest = [f"{c} ASC NULLS FIRST" for c in columns if c not in ("customer_id", "snapshot_date")]
    return f"""
kept_{name} AS (
  SELECT * FROM normal_{name}
  QUALIFY row_number() OVER (PARTITION BY customer_id, snapshot_date ORDER BY {', '.join(rest)}) = 1)"""


def _number(c: str) -> str:
    first = rf"regexp_extract(regexp_replace({c}, '[^0-9.\-]', '', 'g'), '-?[0-9]*\.?[0-9]+')"
    whole = rf"regexp_full_match({c}, '-?[0-9]*\.?[0-9]+(e[+-]?[0-9]+)?')"
    return f"coalesce(TRY_CAST(CASE WHEN {whole} THEN {c} ELSE {first} END AS DOUBLE), 0.0::DOUBLE)"


def _integer(c: str) -> str:
    digits = f"split_part(regexp_replace({c}, '[^0-9.]', '', 'g'), '.', 1)"
    return f"CASE WHEN coalesce({digits}, '') = '' THEN 0 ELSE TRY_CAST({digits} AS INTEGER) END"


def _unknown(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR regexp_matches({c}, '^[!_-]') THEN 'unknown' ELSE {c} END"


OCCUPATION = (
    "coalesce(nullif(trim(regexp_replace(regexp_replace(occupation, '[^a-zA-Z0-9_]', '', 'g'),"
    " '_+', '_', 'g'), '_'), ''), 'unknown')"
)
NAME = r"regexp_replace(name, '\s+', ' ', 'g')"
SSN = (
    "CASE WHEN regexp_full_match(ssn, '[0-9]{3}-[0-9]{2}-[0-9]{4}') THEN ssn ELSE 'unknown' END"
)
YEARS = (
    "coalesce(TRY_CAST(regexp_extract(credit_history_age, '([0-9]+) years', 1) AS DOUBLE), 0)"
    " + coalesce(TRY_CAST(regexp_extract(credit_history_age, '([0-9]+) months', 1) AS DOUBLE), 0)"
    " / 12.0::DOUBLE"
)
# Distinct items in order of first appearance: an item stays if it is not among those before it.
LOANS = (
    "[trim(x) FOR x IN string_split(replace(coalesce(type_of_loan, ''), ' and ', ','), ',')"
    " IF trim(x) <> '']"
)
DISTINCT_LOANS = "list_filter(loans, lambda x, i: list_position(loans, x) = i)"

SILVER_LMS = """
typed_lms AS (
  SELECT loan_id, customer_id, TRY_CAST(loan_start_date AS DATE) AS loan_start_date,
    coalesce(TRY_CAST(tenure AS INTEGER), 0) AS tenure,
    coalesce(TRY_CAST(installment_num AS INTEGER), 0) AS installment_num,
    coalesce(TRY_CAST(loan_amt AS DOUBLE), 0) AS loan_amt,
    coalesce(TRY_CAST(due_amt AS DOUBLE), 0) AS due_amt,
    coalesce(TRY_CAST(paid_amt AS DOUBLE), 0) AS paid_amt,
    coalesce(TRY_CAST(overdue_amt AS DOUBLE), 0) AS overdue_amt,
    coalesce(TRY_CAST(balance AS DOUBLE), 0) AS balance, snapshot_date
  FROM kept_lms),
missed_lms AS (
  SELECT *, installment_num AS mob,
    coalesce(CAST(ceil(overdue_amt / nullif(due_amt, 0)) AS BIGINT), 0) AS installments_missed
  FROM typed_lms),
dated_lms AS (
  SELECT *, CASE WHEN installments_missed > 0
    THEN CAST(snapshot_date - to_months(CAST(installments_missed AS INTEGER)) AS DATE) END AS first_missed_date
  FROM missed_lms),
silver_lms AS (
  SELECT *, CASE WHEN overdue_amt > 0
    THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INTEGER) ELSE 0 END AS dpd
  FROM dated_lms)"""

SILVER_CLICKSTREAM = """
silver_clickstream AS (
  SELECT customer_id, TRY_CAST(fe_1 AS DOUBLE) AS fe_1, TRY_CAST(fe_2 AS DOUBLE) AS fe_2,
    TRY_CAST(fe_3 AS DOUBLE) AS fe_3, TRY_CAST(fe_4 AS DOUBLE) AS fe_4, snapshot_date
  FROM kept_clickstream)"""


def _aged(source: str, target: str) -> str:
    return f"""
aged_{target} AS (
  SELECT *, CASE WHEN {_integer('age')} BETWEEN 1 AND 120 THEN {_integer('age')} END AS valid_age
  FROM {source}),
median_{target} AS (
  SELECT snapshot_date, median(valid_age) AS m FROM aged_{target} GROUP BY snapshot_date),
{target} AS (
  SELECT a.* REPLACE (coalesce(CAST(valid_age AS DOUBLE), m, 30.0::DOUBLE) AS age)
  FROM aged_{target} a JOIN median_{target} USING (snapshot_date))"""


SILVER_ATTRIBUTES = (
    _aged("kept_attributes", "repaired_attributes")
    + f""",
silver_attributes AS (
  SELECT customer_id, {NAME} AS name, age, {SSN} AS ssn, {OCCUPATION} AS occupation, snapshot_date
  FROM repaired_attributes)"""
)

SILVER_FINANCIALS = f"""
listed_financials AS (SELECT *, {LOANS} AS loans FROM kept_financials),
silver_financials AS (
  SELECT customer_id, {', '.join(f'{_number(c)} AS {c}' for c in NUMBERS)}, monthly_balance,
    {', '.join(f'{_integer(c)} AS {c}' for c in INTEGERS)}, {YEARS} AS credit_history_age,
    {_unknown('credit_mix')} AS credit_mix, {_unknown('payment_behaviour')} AS payment_behaviour,
    array_to_string({DISTINCT_LOANS}, ', ') AS type_of_loan,
    CAST(len({DISTINCT_LOANS}) AS INTEGER) AS num_of_loan, snapshot_date
  FROM listed_financials)"""

CLICKSTREAM_FEATURES = """
f_clickstream AS (
  SELECT customer_id, snapshot_date, avg((fe_1 + fe_2 + fe_3 + fe_4) / 4) AS clickstream_total_mean
  FROM silver_clickstream GROUP BY customer_id, snapshot_date)"""
ATTRIBUTES_FEATURES = """
f_attributes AS (
  SELECT customer_id, snapshot_date,
    CASE WHEN age >= 14 AND age <= 24 THEN '14-24' WHEN age >= 25 AND age <= 34 THEN '25-34'
         WHEN age >= 35 AND age <= 44 THEN '35-44' WHEN age >= 45 AND age <= 56 THEN '45-56'
         ELSE 'other' END AS age_group, occupation
  FROM silver_attributes)"""
FINANCIALS_FEATURES = """
f_financials AS (
  SELECT customer_id, snapshot_date,
    CASE WHEN annual_income > 0 THEN outstanding_debt / annual_income END AS debt_to_income,
    CASE WHEN monthly_inhand_salary > 0 THEN total_emi_per_month / monthly_inhand_salary END
      AS emi_to_salary,
    CASE WHEN outstanding_debt > 0 THEN TRY_CAST(monthly_balance AS DOUBLE) / outstanding_debt END
      AS balance_to_debt,
    credit_history_age
  FROM silver_financials)"""
LMS_FEATURES = """
gold_lms AS (
  SELECT customer_id, snapshot_date, loan_start_date, installment_num, mob,
    CASE WHEN due_amt > 0 THEN ceil(overdue_amt / due_amt) ELSE 0 END AS missed
  FROM silver_lms WHERE mob = 6),
f_lms AS (
  SELECT customer_id, snapshot_date, avg(CAST(mob AS DOUBLE)) AS mob, avg(missed) AS installments_missed,
    min(CASE WHEN missed > 0 THEN loan_start_date + installment_num * 30 END) AS first_missed_date,
    avg(CAST(CASE WHEN missed > 0
      THEN date_diff('day', loan_start_date + installment_num * 30, snapshot_date) ELSE 0 END AS DOUBLE)) AS dpd
  FROM gold_lms GROUP BY customer_id, snapshot_date)"""

LABELS = """
label_store AS (
  SELECT loan_id, customer_id, CASE WHEN coalesce(dpd >= 30, installments_missed > 0) THEN 1 ELSE 0 END AS label,
    '30dpd_6mob' AS label_def, snapshot_date
  FROM silver_lms WHERE mob = 6)"""

FEATURE_COLUMNS = """customer_id, snapshot_date, clickstream_total_mean, age_group, occupation,
  debt_to_income, emi_to_salary, balance_to_debt, credit_history_age, mob, installments_missed,
  first_missed_date, dpd"""

INNER_STORE = f"""
inner_store AS (
  SELECT {FEATURE_COLUMNS} FROM f_clickstream
    JOIN f_attributes USING (customer_id, snapshot_date)
    JOIN f_financials USING (customer_id, snapshot_date)
    JOIN f_lms USING (customer_id, snapshot_date))"""

KEY_ROWS = """
key_rows AS (
  SELECT 'clickstream' AS s, customer_id, snapshot_date FROM silver_clickstream
  UNION ALL SELECT 'attributes', customer_id, snapshot_date FROM silver_attributes
  UNION ALL SELECT 'financials', customer_id, snapshot_date FROM silver_financials
  UNION ALL SELECT 'lms', customer_id, snapshot_date FROM silver_lms WHERE mob = 6),
per_customer AS (
  SELECT snapshot_date, customer_id, count(*) FILTER (s = 'clickstream') AS c,
    count(*) FILTER (s = 'attributes') AS a, count(*) FILTER (s = 'financials') AS f,
    count(*) FILTER (s = 'lms') AS l
  FROM key_rows GROUP BY snapshot_date, customer_id)"""

SKIP_STORE = f"""
needed AS (
  SELECT snapshot_date, max(c) > 0 AS c, max(l) > 0 AS l
  FROM per_customer GROUP BY snapshot_date),
skip_store AS (
  SELECT {FEATURE_COLUMNS}
  FROM (SELECT p.snapshot_date, p.customer_id FROM per_customer p JOIN needed n
          ON p.snapshot_date = n.snapshot_date
        WHERE (p.c > 0 OR NOT n.c) AND p.a > 0 AND p.f > 0 AND (p.l > 0 OR NOT n.l))
    LEFT JOIN f_clickstream USING (customer_id, snapshot_date)
    LEFT JOIN f_attributes USING (customer_id, snapshot_date)
    LEFT JOIN f_financials USING (customer_id, snapshot_date)
    LEFT JOIN f_lms USING (customer_id, snapshot_date))"""

OBSERVATIONS = f"""
obs AS (
  SELECT *, CASE WHEN coalesce(dpd >= 30, installments_missed > 0) THEN 1 ELSE 0 END AS dpd_flag
  FROM silver_lms WHERE loan_start_date < DATE '{STARTED_BEFORE}')"""

_RAW = {
    "lms": (RAW_LMS, LMS, SILVER_LMS),
    "clickstream": (RAW_CLICKSTREAM, CLICKSTREAM, SILVER_CLICKSTREAM),
    "attributes": (RAW_ATTRIBUTES, ATTRIBUTES, SILVER_ATTRIBUTES),
    "financials": (RAW_FINANCIALS, FINANCIALS, SILVER_FINANCIALS),
}


def _with(parts: list[str], body: str) -> str:
    return f"WITH {','.join(parts)}\n{body}"


def _normal_parts(name: str) -> list[str]:
    raw, columns, _ = _RAW[name]
    return [raw, _normal(name, columns)]


def _kept_parts(name: str) -> list[str]:
    return [*_normal_parts(name), _kept(name, _RAW[name][1])]


def _silver_parts(name: str) -> list[str]:
    return [*_kept_parts(name), _RAW[name][2]]


def _normal_sql(name: str, body: str) -> str:
    return _with(_normal_parts(name), body)


def _silver_sql(name: str, body: str, *more: str) -> str:
    return _with([*_silver_parts(name), *more], body)


def _all_silver_sql(body: str, *more: str) -> str:
    parts = [p for name in _RAW for p in _silver_parts(name)]
    return _with([*parts, *more], body)


FEATURE_PARTS = [CLICKSTREAM_FEATURES, ATTRIBUTES_FEATURES, FINANCIALS_FEATURES, LMS_FEATURES]


LAST_FIRST = "installment_num DESC, snapshot_date DESC, dpd_flag DESC, " + ", ".join(
    f"{c} DESC NULLS LAST" for c in LMS if c not in ("loan_id", "installment_num", "snapshot_date")
)


def _obs_sql(body: str) -> str:
    return _silver_sql("lms", body, OBSERVATIONS)


def _latest_sql(name: str, where: str = "TRUE") -> str:
    rest = [f"{c} DESC NULLS LAST" for c in _RAW[name][1] if c not in ("customer_id", "snapshot_date")]
    return _silver_sql(
        name,
        f"""SELECT * FROM silver_{name} WHERE {where}
QUALIFY row_number() OVER (PARTITION BY customer_id
  ORDER BY snapshot_date DESC, {', '.join(rest)}) = 1""",
    )


def _split_sql(thresholds: list[int], where: str = "TRUE") -> str:
    values = ", ".join(f"({t})" for t in thresholds)
    return f"""counted AS (
  SELECT CAST(t AS INTEGER) AS threshold, count(dpd_key) AS n_obs,
    count(*) FILTER (dpd >= t) AS n_at_or_above
  FROM (VALUES {values}) v(t) LEFT JOIN (SELECT dpd, 1 AS dpd_key FROM obs WHERE {where}) ON TRUE
  GROUP BY t)"""


def _histogram_sql(bins: int, where: str = "TRUE") -> str:
    return _obs_sql(
        f"""SELECT b.bin, low2 / 2.0::DOUBLE + b.bin * (width2 / (2 * {bins})::DOUBLE) AS bin_start,
  low2 / 2.0::DOUBLE + (b.bin + 1) * (width2 / (2 * {bins})::DOUBLE) AS bin_end,
  (SELECT count(*) FROM obs WHERE dpd IS NOT NULL AND {where}
     AND least(((2 * CAST(dpd AS BIGINT) - low2) * {bins}) // width2, {bins - 1}) = b.bin) AS n_obs
FROM (SELECT CAST(unnest(range({bins})) AS INTEGER) AS bin) b,
  (SELECT CASE WHEN lo = hi THEN 2 * lo - 1 ELSE 2 * lo END AS low2,
          CASE WHEN lo = hi THEN 2 ELSE 2 * (hi - lo) END AS width2
   FROM (SELECT CAST(min(dpd) AS BIGINT) AS lo, CAST(max(dpd) AS BIGINT) AS hi FROM obs WHERE {where}))"""
    )


# Clickstream or loans without a row in the snapshot take no part: no step, and a factor of one.
JOIN_STEPS = [
    ("attributes", "x", "a", "sum(c) > 0"),
    ("financials", "x*a", "f", "TRUE"),
    ("lms", "x*a*f", "l", "sum(l) > 0"),
]
CHAIN = """
chain AS (
  SELECT *, CASE WHEN sum(c) OVER (PARTITION BY snapshot_date) > 0 THEN c ELSE 1 END AS x FROM per_customer)"""


def _audit_step(i: int, name: str, before: str, right: str, having: str) -> str:
    after = f"{before}*{right}"

    def total(e: str) -> str:
        return f"CAST(sum({e}) AS BIGINT)"

    return f"""SELECT snapshot_date, {i} AS step, '{name}' AS joined_source,
  {total(before)} AS rows_before, count(*) FILTER ({before} > 0) AS customers_before,
  {total(right)} AS right_rows, count(*) FILTER ({right} > 0) AS right_customers,
  {total(after)} AS rows_after, count(*) FILTER ({after} > 0) AS customers_after,
  greatest({total(before)} - {total(after)}, 0) AS rows_lost,
  {total(after)} > count(*) FILTER ({after} > 0) AS has_duplicates
FROM chain GROUP BY snapshot_date HAVING {having}"""


AUDIT = "\nUNION ALL\n".join(
    _audit_step(i, *step) for i, step in enumerate(JOIN_STEPS, start=1)
)

BRONZE_METRICS = "\nUNION ALL\n".join(
    f"""SELECT 'bronze' AS layer, '{name}' AS source, snapshot_date, metric, value FROM (
  SELECT snapshot_date, count(*) AS loaded, count(DISTINCT customer_id) AS kept
  FROM normal_{name} GROUP BY snapshot_date) t,
  LATERAL (VALUES ('rows_loaded', loaded), ('rows_kept', kept),
                  ('duplicates_removed', loaded - kept)) v(metric, value)"""
    for name in _RAW
)
LMS_METRICS = """SELECT 'silver' AS layer, 'lms' AS source, snapshot_date, metric, value FROM (
  SELECT snapshot_date, count(*) FILTER (mob = 6) AS at_mob,
    count(*) FILTER (dpd IS NULL AND installments_missed = 0) AS unknown,
    count(*) FILTER (dpd IS NULL AND installments_missed > 0) AS beyond
  FROM silver_lms GROUP BY snapshot_date) t,
  LATERAL (VALUES ('rows_at_mob', at_mob), ('dpd_unknown', unknown), ('dpd_out_of_range', beyond)) v(metric, value)"""
YEAR = "BETWEEN DATE '1997-01-01' AND DATE '1997-12-01'"
OFF_CALENDAR = "\nUNION ALL\n".join(
    f"""SELECT 'bronze', '{name}', snapshot_date, 'rows_off_calendar',
  count(*) FILTER (snapshot_date NOT {YEAR}) FROM normal_{name} GROUP BY snapshot_date"""
    for name in _RAW
)

COUNTED_METRICS = "\nUNION ALL\n".join(
    f"""SELECT 'bronze' AS layer, '{name}' AS source, snapshot_date, metric, value FROM (
  SELECT snapshot_date, count(*) AS loaded, count(DISTINCT customer_id) AS kept
  FROM normal_{name} WHERE snapshot_date {YEAR} GROUP BY snapshot_date) t,
  LATERAL (VALUES ('rows_loaded', loaded), ('rows_kept', kept),
                  ('duplicates_removed', loaded - kept)) v(metric, value)
UNION ALL
SELECT 'bronze', '{name}', NULL, 'rows_unreadable', count(*) FILTER (snapshot_date IS NULL) FROM normal_{name}
UNION ALL
SELECT 'bronze', '{name}', NULL, 'rows_off_calendar', count(*) FILTER (snapshot_date NOT {YEAR}) FROM normal_{name}"""
    for name in ("lms", "attributes")
)
RAGGED_LINES = f"""WITH {RAW_LMS}
SELECT CAST(snapshot_date AS DATE) AS snapshot_date,
  concat_ws(',', loan_id, customer_id, loan_start_date, tenure, installment_num, loan_amt, due_amt, paid_amt,
            overdue_amt, snapshot_date, CASE WHEN installment_num <> '7' THEN balance END,
            CASE WHEN installment_num = '6' THEN 'more' END) AS line,
  count(*) OVER () AS rows_ragged
FROM raw_lms WHERE installment_num IN ('6', '7')"""

BACKFILL_LABELS = _silver_sql("lms", "SELECT * FROM label_store", LABELS)

ORACLE: dict[str, str] = {
    "month_calendar": """SELECT CAST(unnest(generate_series(
  CAST(date_trunc('month', min(l_shipdate)) AS TIMESTAMP), max(l_shipdate), INTERVAL 1 MONTH)) AS DATE)
  AS snapshot_date FROM lineitem""",
    "bronze_slice": _with(
        [RAW_LMS],
        f"""SELECT {', '.join(f"nullif({c}, '') AS {c}" for c in LMS if c not in ('snapshot_date', 'customer_id'))},
  customer_id AS "Customer_ID", CAST(snapshot_date AS DATE) AS snapshot_date
FROM raw_lms WHERE CAST(snapshot_date AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-01'""",
    ),
    "normalize_text": _normal_sql("attributes", "SELECT * FROM normal_attributes"),
    "dedup_customer_snapshot": _with(_kept_parts("lms"), "SELECT * FROM kept_lms"),
    "clean_numeric": _normal_sql(
        "financials",
        f"""SELECT customer_id, snapshot_date, {', '.join(f'{_number(c)} AS {c}' for c in NUMBERS)}
FROM normal_financials""",
    ),
    "clean_integer": _normal_sql(
        "financials",
        f"""SELECT customer_id, snapshot_date, {', '.join(f'{_integer(c)} AS {c}' for c in INTEGERS)}
FROM normal_financials""",
    ),
    "clean_age_median": _with(
        [*_normal_parts("attributes"), _aged("normal_attributes", "repaired")],
        "SELECT customer_id, snapshot_date, age FROM repaired",
    ),
    "clean_occupation": _normal_sql(
        "attributes", f"SELECT customer_id, {OCCUPATION} AS occupation FROM normal_attributes"
    ),
    "clean_name": _normal_sql("attributes", f"SELECT customer_id, {NAME} AS name FROM normal_attributes"),
    "valid_ssn": _normal_sql("attributes", f"SELECT customer_id, {SSN} AS ssn FROM normal_attributes"),
    "junk_category": _normal_sql(
        "financials",
        f"""SELECT customer_id, {_unknown('payment_behaviour')} AS payment_behaviour,
  {_unknown('credit_mix')} AS credit_mix FROM normal_financials""",
    ),
    "credit_history_years": _normal_sql(
        "financials", f"SELECT customer_id, {YEARS} AS credit_history_age FROM normal_financials"
    ),
    "loan_list": _normal_sql(
        "financials",
        f"""SELECT customer_id, CAST(len({DISTINCT_LOANS}) AS INTEGER) AS num_of_loan,
  array_to_string({DISTINCT_LOANS}, ', ') AS type_of_loan
FROM (SELECT customer_id, {LOANS} AS loans FROM normal_financials)""",
    ),
    "lms_delinquency": _silver_sql("lms", "SELECT * FROM silver_lms"),
    "silver_clickstream": _silver_sql("clickstream", "SELECT * FROM silver_clickstream"),
    "silver_attributes": _silver_sql("attributes", "SELECT * FROM silver_attributes"),
    "silver_financials": _silver_sql("financials", "SELECT * FROM silver_financials"),
    "label_store": _silver_sql("lms", "SELECT * FROM label_store", LABELS),
    "clickstream_features": _silver_sql(
        "clickstream", "SELECT * FROM f_clickstream", CLICKSTREAM_FEATURES
    ),
    "attributes_features": _silver_sql(
        "attributes", "SELECT * FROM f_attributes", ATTRIBUTES_FEATURES
    ),
    "financials_features": _silver_sql(
        "financials", "SELECT * FROM f_financials", FINANCIALS_FEATURES
    ),
    "lms_features": _silver_sql("lms", "SELECT * FROM f_lms", LMS_FEATURES),
    "latest_attributes": _latest_sql("attributes"),
    "latest_financials": _latest_sql("financials", "snapshot_date <= DATE '1998-06-01'"),
    "merged_features": _all_silver_sql("SELECT * FROM inner_store", *FEATURE_PARTS, INNER_STORE),
    "feature_store": _all_silver_sql(
        "SELECT * FROM skip_store", *FEATURE_PARTS, KEY_ROWS, SKIP_STORE
    ),
    "feature_store_mob8": _all_silver_sql(
        "SELECT * FROM skip_store", *(p.replace("mob = 6", "mob = 8") for p in (*FEATURE_PARTS, KEY_ROWS, SKIP_STORE))
    ),
    "feature_store_strict": _all_silver_sql("SELECT * FROM inner_store", *FEATURE_PARTS, INNER_STORE),
    "join_audit": _all_silver_sql(AUDIT, KEY_ROWS, CHAIN),
    "source_coverage": _all_silver_sql(
        """SELECT snapshot_date, count(*) FILTER (c > 0) AS customers_clickstream,
  count(*) FILTER (a > 0) AS customers_attributes, count(*) FILTER (f > 0) AS customers_financials,
  count(*) FILTER (l > 0) AS customers_lms,
  count(*) FILTER (c > 0 AND a > 0 AND f > 0 AND l > 0) AS customers_in_all, count(*) AS customers_in_any
FROM per_customer GROUP BY snapshot_date""",
        KEY_ROWS,
    ),
    "bad_rate_by_mob": _obs_sql("SELECT mob, avg(dpd_flag) AS bad_rate FROM obs GROUP BY mob ORDER BY mob"),
    "mob_counts": _obs_sql("SELECT mob, count(*) AS n_obs FROM obs GROUP BY mob ORDER BY mob"),
    "dpd_by_mob": _obs_sql("SELECT mob, avg(dpd) AS avg_dpd FROM obs GROUP BY mob ORDER BY mob"),
    "mob_profile": _obs_sql(
        """SELECT mob, count(*) AS n_obs, avg(dpd_flag) AS bad_rate, avg(dpd) AS avg_dpd
FROM obs GROUP BY mob"""
    ),
    "final_installment": _obs_sql(f"SELECT * FROM obs WHERE installment_num = {FINAL_INSTALLMENT}"),
    "actual_bads_last_obs": _obs_sql(
        f"""SELECT * FROM (SELECT * FROM obs
  QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY {LAST_FIRST}) = 1)
WHERE dpd_flag = 1"""
    ),
    "actual_bads_summary": _obs_sql(
        f"""SELECT count(*) AS n_loans, count(*) FILTER (dpd_flag = 1) AS n_bad_loans
FROM (SELECT * FROM obs
  QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY {LAST_FIRST}) = 1)"""
    ),
    "dpd_histogram": _histogram_sql(50),
    "dpd_histogram_60": _histogram_sql(30, "dpd <= 60"),
    "dpd_thresholds": _silver_sql(
        "lms",
        """SELECT threshold, n_obs, n_at_or_above, n_obs - n_at_or_above AS n_below,
  n_at_or_above * 100.0::DOUBLE / n_obs AS pct_at_or_above FROM counted""",
        OBSERVATIONS,
        _split_sql([1, 5, 10, 15, 20, 30, 60, 90]),
    ),
    "default_split_at_mob": _silver_sql(
        "lms",
        """SELECT threshold, n_obs - n_at_or_above AS n_non_default, n_at_or_above AS n_default,
  n_at_or_above * 100.0::DOUBLE / n_obs AS default_rate_pct FROM counted""",
        OBSERVATIONS,
        _split_sql([20, 30, 60, 90], "mob = 6"),
    ),
    "eda_summary": _obs_sql(
        """SELECT count(*) AS n_obs, count(DISTINCT loan_id) AS n_loans, min(mob) AS min_mob,
  max(mob) AS max_mob, min(dpd) AS min_dpd, max(dpd) AS max_dpd, avg(dpd_flag) AS bad_rate FROM obs"""
    ),
    "run_metrics": _all_silver_sql(f"{BRONZE_METRICS}\nUNION ALL\n{LMS_METRICS}"),
    "store_summary": _all_silver_sql(
        """SELECT 'label_store' AS store, count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers
FROM label_store
UNION ALL SELECT 'feature_store', count(*), count(DISTINCT customer_id) FROM inner_store""",
        LABELS,
        *FEATURE_PARTS,
        INNER_STORE,
    ),
    "preview_top_rows": _silver_sql(
        "lms", "SELECT * FROM label_store ORDER BY snapshot_date, customer_id LIMIT 20", LABELS
    ),
    "backfill_label_store": BACKFILL_LABELS,
    "backfill_feature_store": _all_silver_sql(
        "SELECT * FROM skip_store", *FEATURE_PARTS, KEY_ROWS, SKIP_STORE
    ),
    "widened_clickstream": _silver_sql(
        "clickstream",
        """SELECT customer_id, snapshot_date,
  CASE WHEN snapshot_date <= DATE '1998-06-01' THEN (fe_1 + fe_2) / 2 ELSE (fe_1 + fe_2 + fe_3 + fe_4) / 4 END
    AS clickstream_total_mean
FROM (SELECT customer_id, snapshot_date, TRY_CAST(fe_1 AS DOUBLE) AS fe_1, TRY_CAST(fe_2 AS DOUBLE) AS fe_2,
        TRY_CAST(fe_3 AS DOUBLE) AS fe_3, TRY_CAST(fe_4 AS DOUBLE) AS fe_4
      FROM normal_clickstream
      QUALIFY row_number() OVER (PARTITION BY customer_id, snapshot_date
        ORDER BY fe_1 ASC NULLS FIRST, fe_2 ASC NULLS FIRST, fe_3 ASC NULLS FIRST, fe_4 ASC NULLS FIRST) = 1)""",
    ),
    "stored_run_metrics": _all_silver_sql(
        f"{BRONZE_METRICS}\nUNION ALL\n{OFF_CALENDAR}\nUNION ALL\n"
        f"SELECT * FROM ({LMS_METRICS}) WHERE snapshot_date {YEAR}"
    ),
    "counted_run_metrics": _all_silver_sql(COUNTED_METRICS),
    "quarantined_lines": RAGGED_LINES,
    "csv_export": _silver_sql("lms", "SELECT * FROM silver_lms"),
    "csv_export_clickstream": _silver_sql("clickstream", "SELECT * FROM silver_clickstream"),
    "csv_export_attributes": _silver_sql("attributes", "SELECT * FROM silver_attributes"),
    "csv_export_financials": _silver_sql("financials", "SELECT * FROM silver_financials"),
}

# The same tables by another way: what is stored, counted on a cube, or brought up to date.
for _name, _same in {
    "write_that_fails": "label_store",
    "version_before_rerun": "label_store",
    "audited_feature_store": "feature_store",
    "bucketed_feature_store": "feature_store",
    "merged_store_summary": "store_summary",
    "stored_join_audit": "join_audit",
    "cube_mob_profile": "mob_profile",
    "cube_dpd_histogram_60": "dpd_histogram_60",
    "cube_dpd_thresholds": "dpd_thresholds",
    "cube_default_split": "default_split_at_mob",
    "incremental_eda_summary": "eda_summary",
    "incremental_actual_bads": "actual_bads_last_obs",
}.items():
    ORACLE[_name] = ORACLE[_same]
