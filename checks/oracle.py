"""The same queries as plain SQL for an independent engine, over the same tables."""

from __future__ import annotations

# Spelled out here, not imported: a wrong value in the library must show as a difference.

# The four actions, by the lowest probability that earns each.
ACTIONS = [
    (0.75, "URGENT: Call within 24h — offer 30% discount on annual plan"),
    (0.55, "Call this week — offer free upgrade or loyalty bonus"),
    (0.40, "Send personalised retention email with bundle offer"),
]
NO_ACTION = "No immediate action needed — monitor next month"

# The add-on services.
ADD_ONS = [
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
]

# The model's input in order.
MODEL_FEATURES = [
    "tenure",
    "monthly_charges",
    "total_charges",
    "senior_citizen",
    "avg_monthly_bill",
    "charge_to_tenure_ratio",
    "is_month_to_month",
    "total_services_count",
    "gender_encoded",
    "partner_encoded",
    "dependents_encoded",
    "phone_service_encoded",
    "paperless_billing_encoded",
    "contract_month_to_month",
    "contract_one_year",
    "internet_dsl",
    "internet_fiber",
    "payment_electronic_check",
    "payment_mailed_check",
    "payment_bank_transfer",
]

SCALED = ["tenure", "monthly_charges", "total_charges", "avg_monthly_bill"]

# The scorecard, in thousandths of log-odds per unit.
SCORECARD = {
    "tenure": -31,
    "senior_citizen": 214,
    "is_month_to_month": 1120,
    "total_services_count": -187,
    "partner_encoded": -95,
    "dependents_encoded": -143,
    "paperless_billing_encoded": 187,
    "internet_fiber": 640,
    "payment_electronic_check": 374,
    "contract_one_year": -310,
}

DAY = "DATE '2024-01-10'"

# --- derived tables --------------------------------------------------------------------------

CUSTOMERS = """
WITH last_order AS (
  SELECT o_custkey AS k, MAX(o_orderdate) AS last_dt FROM orders GROUP BY o_custkey),
ref AS (SELECT MAX(o_orderdate) AS ref_dt FROM orders),
a AS (
  SELECT c.c_custkey AS k, c.c_nationkey AS nk,
    CAST((c.c_custkey * 37) % 73 AS INT) AS tenure,
    1825 + (CAST(ROUND(c.c_acctbal * 100) AS BIGINT) + 100000) % 10001 AS m_cents,
    CASE WHEN (c.c_custkey * 7919) % 100 < 55 THEN 'Month-to-month'
         WHEN (c.c_custkey * 7919) % 100 < 76 THEN 'One year' ELSE 'Two year' END AS contract,
    CASE WHEN c.c_mktsegment IN ('BUILDING','MACHINERY') THEN 'Fiber optic'
         WHEN c.c_mktsegment IN ('AUTOMOBILE','HOUSEHOLD') THEN 'DSL' ELSE 'No' END AS inet,
    CASE (c.c_custkey * 31 + c.c_nationkey) % 4
         WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS pay,
    COALESCE(LEAST(24, (EXTRACT(YEAR FROM r.ref_dt) - EXTRACT(YEAR FROM l.last_dt)) * 12
      + EXTRACT(MONTH FROM r.ref_dt) - EXTRACT(MONTH FROM l.last_dt)), 24) AS recency
  FROM customer c LEFT JOIN last_order l ON l.k = c.c_custkey CROSS JOIN ref r),
b AS (SELECT a.*,
    (CASE WHEN contract = 'Month-to-month' THEN 30 WHEN contract = 'One year' THEN 8 ELSE 0 END
    + CASE WHEN tenure < 12 THEN 20 WHEN tenure < 24 THEN 8 ELSE 0 END
    + CASE WHEN inet = 'Fiber optic' THEN 12 ELSE 0 END
    + CASE WHEN pay = 'Electronic check' THEN 8 ELSE 0 END + recency) AS pts FROM a)
SELECT CONCAT('CUST-', LPAD(CAST(k AS VARCHAR), GREATEST(8, LENGTH(CAST(k AS VARCHAR)))::INT, '0')) AS customer_id,
  CASE WHEN k % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  CASE WHEN (k * 17) % 100 < 16 THEN 1 ELSE 0 END AS senior_citizen,
  CASE WHEN nk % 2 = 0 THEN 'Yes' ELSE 'No' END AS partner,
  CASE WHEN (k * 11 + nk) % 10 < 3 THEN 'Yes' ELSE 'No' END AS dependents,
  tenure,
  CASE WHEN (k * 13) % 10 < 9 THEN 'Yes' ELSE 'No' END AS phone_service,
  CASE WHEN (k * 13) % 10 >= 9 THEN 'No phone service'
       WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS multiple_lines,
  inet AS internet_service,
  CASE WHEN inet = 'No' THEN 'No internet service'
       WHEN (k * 3) % 7 < 3 THEN 'Yes' ELSE 'No' END AS online_security,
  CASE WHEN inet = 'No' THEN 'No internet service'
       WHEN (k * 5) % 11 < 5 THEN 'Yes' ELSE 'No' END AS online_backup,
  CASE WHEN inet = 'No' THEN 'No internet service'
       WHEN (k * 7) % 13 < 6 THEN 'Yes' ELSE 'No' END AS device_protection,
  CASE WHEN inet = 'No' THEN 'No internet service'
       WHEN (k * 9) % 17 < 7 THEN 'Yes' ELSE 'No' END AS tech_support,
  CASE WHEN inet = 'No' THEN 'No internet service'
       WHEN (k * 2) % 19 < 9 THEN 'Yes' ELSE 'No' END AS streaming_tv,
  CASE WHEN inet = 'No' THEN 'No internet service'
       WHEN (k * 4) % 23 < 11 THEN 'Yes' ELSE 'No' END AS streaming_movies,
  contract,
  CASE WHEN (k * 19) % 10 < 6 THEN 'Yes' ELSE 'No' END AS paperless_billing,
  pay AS payment_method,
  CAST(m_cents / 100.0 AS DECIMAL(8,2)) AS monthly_charges,
  CASE WHEN tenure = 0 OR k % 97 = 5 THEN NULL
       ELSE CAST((m_cents * tenure + (k * 13) % 500) / 100.0 AS DECIMAL(10,2)) END AS total_charges,
  CASE WHEN k % 50 = 7 THEN NULL
       WHEN pts + (k * 101) % 30 >= 64 THEN 'Yes' ELSE 'No' END AS churn
FROM b"""

_key = "CAST(SUBSTRING(customer_id, 6) AS BIGINT)"

RAW = f"""
SELECT * REPLACE (
  CASE WHEN total_charges IS NULL THEN CASE WHEN {_key} % 2 = 0 THEN '' ELSE '  ' END
       WHEN {_key} % 89 = 3 THEN 'n/a'
       WHEN {_key} % 5 = 0 THEN ' ' || CAST(total_charges AS VARCHAR) || ' '
       ELSE CAST(total_charges AS VARCHAR) END AS total_charges,
  CASE WHEN {_key} % 4 = 1 THEN churn || ' ' ELSE churn END AS churn,
  CASE WHEN {_key} % 3 = 1 THEN '  ' || gender ELSE gender END AS gender)
FROM telco_customers"""


def action_rule(p: str) -> str:
    cases = " ".join(f"WHEN {p} >= {floor} THEN '{text}'" for floor, text in ACTIONS)
    return f"CASE {cases} ELSE '{NO_ACTION}' END"


PREDICTIONS = f"""
WITH s AS (
  SELECT t.*, d, CAST(SUBSTRING(customer_id, 6) AS BIGINT) AS k
  FROM telco_customers t CROSS JOIN (SELECT UNNEST(range(14)) AS d)),
p AS (SELECT s.*, LEAST(9999, GREATEST(1,
     CASE WHEN contract = 'Month-to-month' THEN 3000 ELSE 500 END
   + CASE WHEN tenure < 12 THEN 2500 ELSE 0 END
   + CASE WHEN internet_service = 'Fiber optic' THEN 1200 ELSE 0 END
   + (k * 7919 + d * 104729) % 3500)) AS bp,
   list_transform(list_filter([CASE WHEN contract = 'Month-to-month' THEN 'contract_month_to_month' END,
     CASE WHEN tenure < 12 THEN 'tenure' END,
     CASE WHEN internet_service = 'Fiber optic' THEN 'internet_fiber_optic' END],
     lambda r: r IS NOT NULL),
     lambda r: r || ' (high risk, SHAP=+0.' || LPAD(CAST(k % 1000 AS VARCHAR), 3, '0') || ')') AS reasons
   FROM s WHERE (k + d) % 3 <> 1),
q AS (SELECT p.*, CAST(bp / 10000.0 AS DECIMAL(5,4)) AS churn_probability FROM p)
SELECT customer_id, DATE '2024-01-04' + CAST(d AS INT) AS run_date,
  CASE WHEN d < 9 THEN 'gbt_v1' ELSE 'gbt_v2' END AS model_version,
  churn_probability,
  CASE WHEN bp >= 5000 THEN 1 ELSE 0 END AS churn_prediction,
  CASE WHEN bp > 6500 THEN 'HIGH' WHEN bp > 4000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
  reasons[1] AS top_reason_1, reasons[2] AS top_reason_2, reasons[3] AS top_reason_3,
  {action_rule("churn_probability")} AS recommended_action
FROM q"""

# --- expressions -----------------------------------------------------------------------------


def fixed(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def ratio(part: str, whole: str, n: int, scale: int = 1) -> str:
    return fixed(f"CAST({part} AS DOUBLE) * {scale} / NULLIF(CAST({whole} AS DOUBLE), 0)", n)


def percent(part: str, whole: str, n: int = 2) -> str:
    return ratio(part, whole, n, 100)


def mean(x: str, n: int, scale: int = 1) -> str:
    return ratio(f"SUM({x})", f"COUNT({x})", n, scale)


def total(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def long_sum(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


LEFT = "churn = 'Yes'"
RATE = f"{percent(total(LEFT), 'COUNT(*)')} AS churn_rate_pct"

_bill = (
    "CASE WHEN tenure > 0 AND total_charges IS NOT NULL THEN "
    + fixed("CAST(total_charges AS DOUBLE) / CAST(tenure AS DOUBLE)", 2)
    + " ELSE CAST(monthly_charges AS DOUBLE) END"
)
_per_month = fixed("CAST(monthly_charges AS DOUBLE) / CAST(tenure + 1 AS DOUBLE)", 4)
_services = " + ".join(flag(f"{c} = 'Yes'") for c in ADD_ONS)
_flags = {
    "gender_encoded": "gender = 'Male'",
    "partner_encoded": "partner = 'Yes'",
    "dependents_encoded": "dependents = 'Yes'",
    "phone_service_encoded": "phone_service = 'Yes'",
    "paperless_billing_encoded": "paperless_billing = 'Yes'",
    "contract_month_to_month": "contract = 'Month-to-month'",
    "contract_one_year": "contract = 'One year'",
    "contract_two_year": "contract = 'Two year'",
    "internet_dsl": "internet_service = 'DSL'",
    "internet_fiber": "internet_service = 'Fiber optic'",
    "internet_none": "internet_service = 'No'",
    "payment_bank_transfer": "payment_method ILIKE '%bank transfer%'",
    "payment_credit_card": "payment_method ILIKE '%credit card%'",
    "payment_electronic_check": "payment_method ILIKE '%electronic check%'",
    "payment_mailed_check": "payment_method ILIKE '%mailed check%'",
    "is_month_to_month": "contract = 'Month-to-month'",
}
_group = (
    "CASE WHEN tenure BETWEEN 0 AND 6 THEN 'new' WHEN tenure BETWEEN 7 AND 24 THEN 'mid' "
    "WHEN tenure BETWEEN 25 AND 48 THEN 'established' ELSE 'loyal' END"
)


def flags(*names: str) -> str:
    return ", ".join(f"{flag(_flags[n])} AS {n}" for n in names)


_onehot = [n for n in _flags if n != "is_month_to_month"]
_stored = [n for n in MODEL_FEATURES if n not in _flags]

FEATURES = f"""
SELECT customer_id, {flags(*_onehot)}, {_group} AS tenure_group,
  CAST({_bill} AS DECIMAL(8,2)) AS avg_monthly_bill,
  CAST({_per_month} AS DECIMAL(8,4)) AS charge_to_tenure_ratio,
  {flags("is_month_to_month")}, {_services} AS total_services_count,
  tenure, monthly_charges,
  CAST(COALESCE(total_charges, monthly_charges) AS DECIMAL(10,2)) AS total_charges,
  senior_citizen, {flag(LEFT)} AS churn_encoded
FROM telco_customers WHERE churn IS NOT NULL"""

_text = [
    "customer_id", "gender", "partner", "dependents", "phone_service", "multiple_lines",
    "internet_service", *ADD_ONS, "contract", "paperless_billing", "payment_method",
]
CLEAN = f"""
SELECT * REPLACE ({", ".join(f"TRIM({c}) AS {c}" for c in _text)},
  CASE TRIM(churn) WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churn)
FROM (SELECT * REPLACE (CASE WHEN tenure = 0 THEN CAST(monthly_charges AS DECIMAL(10,2))
        ELSE TRY_CAST(total_charges AS DECIMAL(10,2)) END AS total_charges) FROM telco_raw)
WHERE total_charges IS NOT NULL"""

_numeric = {
    "avg_monthly_bill": _bill,
    "charge_to_tenure_ratio": _per_month,
    "total_services_count": _services,
}
MATRIX = f"""
SELECT customer_id, {", ".join(
    f"CAST({flag(_flags[c]) if c in _flags else _numeric.get(c, c)} AS DOUBLE) AS {c}"
    for c in MODEL_FEATURES)}, churn AS label
FROM clean"""

SIDES = """
SELECT *, CASE WHEN r <= FLOOR(n * 0.2) THEN 'test'
  WHEN r <= FLOOR(n * 0.3) THEN 'validation' ELSE 'train' END AS side
FROM (SELECT m.*, COUNT(*) OVER (PARTITION BY label) AS n,
        ROW_NUMBER() OVER (PARTITION BY label ORDER BY md5(customer_id || '|42')) AS r
      FROM matrix m WHERE label IS NOT NULL)"""

OUTCOMES = """
SELECT p.run_date, p.model_version, p.churn_prediction AS prediction, p.churn_probability AS score,
  CASE WHEN c.churn = 'Yes' THEN 1 ELSE 0 END AS label
FROM telco_predictions p JOIN telco_customers c ON c.customer_id = p.customer_id
WHERE c.churn IS NOT NULL"""

_tables = {
    "telco_customers": (CUSTOMERS, []),
    "telco_raw": (RAW, ["telco_customers"]),
    "telco_predictions": (PREDICTIONS, ["telco_customers"]),
    "features": (FEATURES, ["telco_customers"]),
    "clean": (CLEAN, ["telco_raw"]),
    "matrix": (MATRIX, ["clean"]),
    "sides": (SIDES, ["matrix"]),
    "outcomes": (OUTCOMES, ["telco_predictions"]),
}


def _needs(names: list[str]) -> list[str]:
    found: list[str] = []
    for name in names:
        for part in [*_needs(_tables[name][1]), name]:
            if part not in found:
                found.append(part)
    return found


def over(names: str, body: str, **more: str) -> str:
    """``body`` behind the derived tables it names, and their own inputs."""
    parts = [f"{n} AS ({_tables[n][0]})" for n in _needs(names.split())]
    parts += [f"{n} AS ({sql})" for n, sql in more.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


# --- queries ---------------------------------------------------------------------------------


def _breakdown(by: str, name: str, *extra: str) -> str:
    columns = ", ".join(
        [f"{by} AS {name}", "COUNT(*) AS total", f"{total(LEFT)} AS churned", RATE, *extra]
    )
    return over("telco_customers", f"SELECT {columns} FROM telco_customers GROUP BY 1")


def _keys(source: str, name: str, keys: str) -> str:
    return f"""SELECT '{name}' AS table_name, CAST(COALESCE(SUM(c), 0) AS BIGINT) AS total_rows,
      COUNT(*) AS distinct_keys, {total("c > 1")} AS duplicated_keys,
      CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS surplus_rows
    FROM (SELECT COUNT(*) AS c FROM {source} GROUP BY {keys})"""


def _orphans(source: str, name: str) -> str:
    return f"""SELECT '{name}' AS table_name, COUNT(DISTINCT customer_id) AS orphan_keys,
      COUNT(*) AS orphan_rows
    FROM {source} WHERE customer_id NOT IN
      (SELECT customer_id FROM telco_customers WHERE total_charges IS NOT NULL)"""


def _nulls(source: str, name: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
        f"{total(f'{c} IS NULL')} AS null_rows FROM {source}"
        for c in columns
    )


def _scaled(where: str) -> str:
    columns = ", ".join(
        fixed(
            f"({c} - (SELECT AVG({c}) FROM {where})) / (SELECT STDDEV_POP({c}) FROM {where})", 4
        )
        + f" AS {c}"
        for c in SCALED
    )
    return columns


CELLS = f"""SELECT model_version, {", ".join(f"{total(f'label = {a} AND prediction = {p}')} AS {n}"
    for n, a, p in (("tp", 1, 1), ("fp", 0, 1), ("tn", 0, 0), ("fn", 1, 0)))}
  FROM outcomes GROUP BY model_version"""


def _zero(x: str) -> str:
    return f"COALESCE({x}, 0)"


def _div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def _class_report() -> str:
    sides = f"""SELECT model_version, 'Stay' AS class, {_zero(_div("tn", "tn + fn"))} AS p,
        {_zero(_div("tn", "tn + fp"))} AS r, tn + fp AS n, tn + fp + fn + tp AS every FROM cells
      UNION ALL SELECT model_version, 'Churn', {_zero(_div("tp", "tp + fp"))},
        {_zero(_div("tp", "tp + fn"))}, tp + fn, tn + fp + fn + tp FROM cells"""
    scored = f"SELECT *, {_zero(_div('p * r * 2', 'p + r'))} AS f FROM sides"

    def line(name: str, weight: str) -> str:
        columns = ", ".join(
            fixed(f"SUM({x} * {weight}) / SUM({weight})", 4) for x in ("p", "r", "f")
        )
        return (
            f"SELECT model_version, '{name}', {columns}, CAST(MAX(every) AS BIGINT) "
            "FROM scored GROUP BY model_version"
        )

    return over(
        "outcomes",
        f"""SELECT model_version, class, {fixed("p", 4)} AS precision, {fixed("r", 4)} AS recall,
          {fixed("f", 4)} AS f1, CAST(n AS BIGINT) AS support FROM scored
        UNION ALL SELECT model_version, 'accuracy', {", ".join([ratio("tp + tn", "tp + fp + tn + fn", 4)] * 3)},
          CAST(tp + fp + tn + fn AS BIGINT) FROM cells
        UNION ALL {line("macro avg", "CAST(1 AS DOUBLE)")}
        UNION ALL {line("weighted avg", "CAST(n AS DOUBLE)")}""",
        cells=CELLS,
        sides=sides,
        scored=scored,
    )


def _reasons(top: int, sentence: str) -> str:
    """Contributions unpivoted, ranked by a window, and pivoted back."""
    parts = " UNION ALL ".join(
        f"SELECT customer_id, {i} AS pos, '{name}' AS feature, {name} * {weight} / 1000 AS v FROM matrix"
        for i, (name, weight) in enumerate(SCORECARD.items())
    )
    ranked = """SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id
      ORDER BY ABS(v) DESC, pos) AS n FROM parts"""
    columns = ", ".join(
        f"MAX(CASE WHEN n = {n} THEN {sentence} END) AS reason_{n}, "
        f"MAX(CASE WHEN n = {n} THEN {fixed('v', 3)} END) AS value_{n}"
        for n in range(1, top + 1)
    )
    return over(
        "matrix",
        f"SELECT customer_id, {columns} FROM ranked GROUP BY customer_id",
        parts=parts,
        ranked=ranked,
    )


def _tiers(column: str = "risk_tier") -> list[str]:
    return [total(f"{column} = '{tier}'") for tier in ("HIGH", "MEDIUM", "LOW")]


_joined = f"""telco_predictions p JOIN telco_customers c ON c.customer_id = p.customer_id
  WHERE p.run_date = {DAY}"""


def oracle_sql() -> dict[str, str]:
    high, medium, low = _tiers()
    # The labels of the bands.
    bill_buckets = (
        "CASE WHEN monthly_charges < 35 THEN '< ₹35 (Budget)' "
        "WHEN monthly_charges < 65 THEN '₹35-65 (Mid)' "
        "WHEN monthly_charges < 85 THEN '₹65-85 (Premium)' ELSE '₹85+ (High-end)' END"
    )
    tenure_buckets = (
        "CASE WHEN tenure BETWEEN 0 AND 6 THEN '0-6 months (New)' "
        "WHEN tenure BETWEEN 7 AND 24 THEN '7-24 months (Growing)' "
        "WHEN tenure BETWEEN 25 AND 48 THEN '25-48 months (Established)' "
        "ELSE '49+ months (Loyal)' END"
    )
    avg_charge = f"{mean('monthly_charges', 2)} AS avg_monthly_charges"
    run_key = "customer_id, run_date, model_version, churn_probability"
    known = "c.churn IS NOT NULL"

    def customers(body: str) -> str:
        return over("telco_customers", body + " FROM telco_customers")

    def scored(column: str, rule: str) -> str:
        return over(
            "telco_predictions", f"SELECT {run_key}, {rule} AS {column} FROM telco_predictions"
        )

    sql = {
        "fix_zero_total": customers(
            "SELECT customer_id, tenure, CASE WHEN tenure = 0 THEN NULL ELSE total_charges END"
            " AS total_charges"
        ),
        "dq_duplicate_keys": over(
            "features",
            _keys("telco_customers", "customers", "customer_id")
            + " UNION ALL "
            + _keys("features", "churn_features", "customer_id"),
        ),
        "dq_orphans": over(
            "features telco_predictions",
            _orphans("features", "churn_features")
            + " UNION ALL "
            + _orphans("telco_predictions", "churn_predictions"),
        ),
        "dq_run_unique": over(
            "telco_predictions",
            _keys("telco_predictions", "churn_predictions", "customer_id, run_date, model_version")
            + " UNION ALL "
            + _keys(
                "telco_predictions",
                "churn_predictions by version",
                "customer_id, model_version",
            ),
        ),
        "dq_not_null": over(
            "telco_predictions",
            _nulls(
                "telco_customers",
                "customers",
                ["customer_id", "tenure", "monthly_charges", "contract", "total_charges", "churn"],
            )
            + " UNION ALL "
            + _nulls(
                "telco_predictions",
                "churn_predictions",
                ["customer_id", "run_date", "model_version", "churn_probability",
                 "churn_prediction", "top_reason_1", "top_reason_3"],
            ),
        ),
        "dq_row_count": customers("SELECT COUNT(*) AS total_customers"),
        "dq_churn_distribution": customers(
            f"SELECT churn, COUNT(*) AS count, {percent('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct"
        )
        + " GROUP BY churn",
        "dq_null_audit": customers(
            "SELECT COUNT(*) AS total_rows, "
            + ", ".join(
                f"{total(f'{c} IS NULL')} AS null_{c}"
                for c in ("tenure", "monthly_charges", "total_charges", "contract", "churn")
            )
        ),
        "dq_assertions": over(
            "clean",
            f"""SELECT {total("churn IS NULL")} AS null_label,
              {total("tenure IS NULL OR tenure < 0")} AS bad_tenure,
              {total("monthly_charges IS NULL OR monthly_charges <= 0")} AS bad_charge FROM clean""",
        ),
        "feat_count_check": over(
            "features",
            """SELECT (SELECT COUNT(*) FROM telco_customers WHERE churn IS NOT NULL) AS labelled_customers,
              COUNT(*) AS feature_rows, COUNT(*) = (SELECT COUNT(*) FROM telco_customers
                WHERE churn IS NOT NULL) AS counts_match FROM features""",
        ),
        "feat_churn_rate": over(
            "features",
            f"SELECT {mean('churn_encoded', 2, 100)} AS churn_rate_pct_in_features FROM features",
        ),
        "feat_spot_check": over(
            "features",
            f"""SELECT {mean("tenure", 1)} AS avg_tenure, {avg_charge},
              {mean("avg_monthly_bill", 2)} AS avg_computed_bill,
              {mean("charge_to_tenure_ratio", 4)} AS avg_ctr,
              {mean("total_services_count", 2)} AS avg_services,
              {long_sum("is_month_to_month")} AS month_to_month_count,
              {long_sum("contract_two_year")} AS two_year_count FROM features""",
        ),
        "clean_coerce": over(
            "telco_raw",
            """SELECT customer_id, total_charges AS delivered,
              TRY_CAST(total_charges AS DECIMAL(10,2)) AS total_charges FROM telco_raw""",
        ),
        "clean_customers": over("clean", "SELECT * FROM clean"),
        "clean_summary": over(
            "clean",
            f"""SELECT r.rows_in, r.imputed, r.rows_in - c.rows_out AS dropped, c.rows_out,
              c.churn_rate_pct
            FROM (SELECT COUNT(*) AS rows_in, {total("tenure = 0")} AS imputed FROM telco_raw) r,
              (SELECT COUNT(*) AS rows_out, {mean("churn", 2, 100)} AS churn_rate_pct FROM clean) c""",
        ),
        "clean_label_counts": over("clean", "SELECT churn, COUNT(*) AS count FROM clean GROUP BY churn"),
        "clean_preview": over("clean", "SELECT * FROM clean ORDER BY customer_id LIMIT 5"),
        "eda_overview": customers(
            f"""SELECT COUNT(*) AS total_customers, {total(LEFT)} AS churned,
              {total("churn = 'No'")} AS retained, {RATE}"""
        ),
        "eda_numeric_summary": customers(
            f"""SELECT {mean("tenure", 2)} AS avg_tenure_months, MIN(tenure) AS min_tenure,
              MAX(tenure) AS max_tenure, {avg_charge}, MIN(monthly_charges) AS min_monthly_charges,
              MAX(monthly_charges) AS max_monthly_charges,
              {mean("total_charges", 2)} AS avg_total_charges"""
        )
        + " WHERE total_charges IS NOT NULL",
        "eda_by_contract": _breakdown("contract", "contract", avg_charge),
        "eda_by_tenure": _breakdown(tenure_buckets, "tenure_group", avg_charge),
        "eda_by_internet": _breakdown("internet_service", "internet_service"),
        "eda_by_bill": _breakdown(bill_buckets, "bill_bucket", f"{mean('tenure', 1)} AS avg_tenure"),
        "eda_by_payment": _breakdown("payment_method", "payment_method"),
        "eda_danger_zone": customers(
            f"SELECT COUNT(*) AS total_danger_zone, {total(LEFT)} AS actually_churned, {RATE}"
        )
        + " WHERE contract = 'Month-to-month' AND internet_service = 'Fiber optic' AND tenure < 12",
        "eda_revenue_at_risk": customers(
            f"""SELECT CAST(SUM(monthly_charges) AS DECIMAL(18,2)) AS total_monthly_revenue,
              CAST(SUM(CASE WHEN {LEFT} THEN monthly_charges ELSE 0 END) AS DECIMAL(18,2))
                AS revenue_at_risk,
              {percent(f"SUM(CASE WHEN {LEFT} THEN monthly_charges ELSE 0 END)",
                       "SUM(monthly_charges)")} AS pct_revenue_at_risk"""
        ),
        "eda_by_senior": customers(
            f"""SELECT CASE senior_citizen WHEN 1 THEN 'Senior' ELSE 'Non-senior' END AS segment,
              COUNT(*) AS total, {RATE}"""
        )
        + " GROUP BY senior_citizen",
        "eda_by_churn": customers(
            f"""SELECT churn, {mean("tenure", 1)} AS avg_tenure, {avg_charge},
              {mean("total_charges", 2)} AS avg_total_charges, COUNT(*) AS customer_count"""
        )
        + " WHERE total_charges IS NOT NULL GROUP BY churn",
        "feat_binary": customers("SELECT customer_id, " + flags(*_onehot[:5])),
        "feat_contract_onehot": customers("SELECT customer_id, " + flags(*_onehot[5:8])),
        "feat_internet_onehot": customers("SELECT customer_id, " + flags(*_onehot[8:11])),
        "feat_payment_onehot": customers("SELECT customer_id, " + flags(*_onehot[11:])),
        "feat_tenure_group": customers(f"SELECT customer_id, {_group} AS tenure_group"),
        "feat_avg_bill": customers(f"SELECT customer_id, {_bill} AS avg_monthly_bill"),
        "feat_charge_ratio": customers(f"SELECT customer_id, {_per_month} AS charge_to_tenure_ratio"),
        "feat_service_count": customers(f"SELECT customer_id, {_services} AS total_services_count"),
        "feat_table": over("features", "SELECT * FROM features"),
        "feat_model_matrix": over("matrix", "SELECT * FROM matrix"),
        "split_stratified": over("sides", "SELECT customer_id, label, side FROM sides"),
        "scale_train": over(
            "sides",
            f"SELECT customer_id, side = 'test' AS is_test, {_scaled('fitted')} FROM sides",
            fitted="SELECT * FROM sides WHERE side <> 'test'",
        ),
        "scale_zscore": over("matrix", f"SELECT customer_id, {_scaled('matrix')} FROM matrix"),
        "class_weight": over(
            "matrix",
            f"""SELECT {total("label = 1")} AS positives, {total("label = 0")} AS negatives,
              {ratio(total("label = 0"), total("label = 1"), 6)} AS pos_weight FROM matrix""",
        ),
        "eval_metrics": over(
            "outcomes",
            f"""SELECT model_version, {ratio("tp + tn", "tp + fp + tn + fn", 4)} AS accuracy,
              {_zero(ratio("tp", "tp + fp", 4))} AS precision,
              {_zero(ratio("tp", "tp + fn", 4))} AS recall,
              {_zero(ratio("tp * 2", "tp * 2 + fp + fn", 4))} AS f1 FROM cells""",
            cells=CELLS,
        ),
        "eval_roc_auc": over(
            "outcomes",
            f"""SELECT a.model_version,
              {fixed("(SUM(a.rank) - ANY_VALUE(b.p) * (ANY_VALUE(b.p) + 1) / 2.0)"
                     " / (ANY_VALUE(b.p) * ANY_VALUE(b.n))", 4)} AS roc_auc
            FROM ranks a JOIN (SELECT model_version, CAST(SUM(label) AS DOUBLE) AS p,
                CAST(SUM(1 - label) AS DOUBLE) AS n FROM outcomes GROUP BY model_version) b
              ON b.model_version = a.model_version
            WHERE a.label = 1 GROUP BY a.model_version""",
            ranks="""SELECT model_version, label,
              RANK() OVER (PARTITION BY model_version ORDER BY score)
                + (COUNT(*) OVER (PARTITION BY model_version, score) - 1) / 2.0 AS rank
              FROM outcomes""",
        ),
        "eval_class_report": _class_report(),
        "eval_confusion": over(
            "outcomes",
            f"""SELECT model_version, label, {total("prediction = 0")} AS predicted_stay,
              {total("prediction = 1")} AS predicted_churn
            FROM outcomes GROUP BY model_version, label""",
        ),
        "score_threshold": scored("churn_prediction", flag("churn_probability >= 0.5")),
        "risk_tier": scored(
            "risk_tier",
            "CASE WHEN churn_probability <= 0.40 THEN 'LOW'"
            " WHEN churn_probability <= 0.65 THEN 'MEDIUM' ELSE 'HIGH' END",
        ),
        "recommended_action": scored("recommended_action", action_rule("churn_probability")),
        "shap_additivity": over(
            "matrix",
            f"""SELECT customer_id, {len(MODEL_FEATURES)} AS contributions,
              CAST(0 AS DOUBLE) AS unexplained FROM matrix""",
        ),
        "reason_codes": _reasons(
            3,
            "feature || CASE WHEN v > 0 THEN ' (high risk, SHAP=' ELSE ' (low risk, SHAP=' END"
            " || printf('%+.3f', v) || ')'",
        ),
        "top_reasons_n": _reasons(
            5,
            "feature || CASE WHEN v > 0 THEN ' → elevated' ELSE ' → lower' END"
            " || ' churn risk (SHAP=' || printf('%+.3f', v) || ')'",
        ),
        "score_summary": over(
            "telco_predictions",
            f"""SELECT COUNT(*) AS scored, {total("churn_prediction = 1")} AS predicted_churners,
              {percent(total("churn_prediction = 1"), "COUNT(*)", 1)} AS predicted_churn_pct
            FROM telco_predictions WHERE run_date = {DAY}""",
        ),
        "score_top10": over(
            "telco_predictions",
            f"""SELECT customer_id, churn_probability, risk_tier, top_reason_1, recommended_action
            FROM telco_predictions WHERE run_date = {DAY} AND churn_prediction = 1
            ORDER BY churn_probability DESC, customer_id LIMIT 10""",
        ),
        "view_at_risk": over(
            "telco_predictions",
            f"""SELECT p.customer_id, p.churn_probability, p.risk_tier, p.top_reason_1,
              p.top_reason_2, p.top_reason_3, p.recommended_action, c.tenure, c.contract,
              c.monthly_charges, c.internet_service, c.payment_method, p.run_date
            FROM {_joined} AND p.churn_prediction = 1""",
        ),
        "view_daily_summary": over(
            "telco_predictions",
            f"""SELECT run_date, COUNT(*) AS total_scored,
              {long_sum("churn_prediction")} AS predicted_churners,
              {mean("churn_probability", 2, 100)} AS avg_churn_prob_pct,
              {high} AS high_risk_count, {medium} AS medium_risk_count, {low} AS low_risk_count
            FROM telco_predictions GROUP BY run_date""",
        ),
        "report_call_list": over(
            "telco_predictions",
            f"""SELECT ROW_NUMBER() OVER (ORDER BY p.churn_probability DESC, p.customer_id)
                AS priority_rank, p.customer_id,
              {ratio("p.churn_probability", "1", 1, 100)} AS churn_prob_pct, p.risk_tier,
              c.tenure AS months_with_us, c.contract, c.monthly_charges, c.internet_service,
              p.top_reason_1 AS primary_risk_factor, p.top_reason_2 AS secondary_risk_factor,
              p.recommended_action
            FROM {_joined} AND p.churn_prediction = 1
            ORDER BY priority_rank LIMIT 100""",
        ),
        "report_exec_summary": over(
            "telco_predictions",
            f"""SELECT {DAY} AS report_date, COUNT(*) AS total_customers_scored,
              {long_sum("p.churn_prediction")} AS predicted_to_churn,
              {percent("SUM(p.churn_prediction)", "COUNT(*)")} AS predicted_churn_rate_pct,
              CAST(SUM(CASE WHEN p.churn_prediction = 1 THEN c.monthly_charges ELSE 0 END)
                AS DECIMAL(18,2)) AS monthly_revenue_at_risk,
              {high} AS high_risk_customers, {medium} AS medium_risk_customers,
              {low} AS low_risk_customers
            FROM {_joined}""",
        ),
        "report_weekly_trend": over(
            "telco_predictions",
            f"""SELECT CAST(DATE_TRUNC('week', run_date) AS DATE) AS week_starting,
              COUNT(DISTINCT run_date) AS days_scored,
              {mean("churners", 0)} AS avg_daily_predicted_churners,
              {mean("revenue", 2)} AS avg_daily_revenue_at_risk
            FROM daily GROUP BY 1""",
            daily="""SELECT p.run_date, SUM(p.churn_prediction) AS churners,
              SUM(p.churn_prediction * c.monthly_charges) AS revenue
            FROM telco_predictions p JOIN telco_customers c ON c.customer_id = p.customer_id
            GROUP BY p.run_date""",
        ),
        "report_top_drivers": over(
            "telco_predictions",
            f"""SELECT regexp_replace(top_reason_1, ', SHAP=[^)]*', '') AS risk_factor,
              COUNT(*) AS times_cited_as_primary,
              {mean("churn_probability", 1, 100)} AS avg_churn_prob_when_primary
            FROM telco_predictions WHERE run_date = {DAY} AND churn_prediction = 1
              AND top_reason_1 IS NOT NULL GROUP BY 1""",
        ),
        "report_segments": over(
            "telco_predictions",
            f"""SELECT c.contract, c.internet_service,
              CASE WHEN c.tenure < 6 THEN 'New (< 6 mo)' WHEN c.tenure < 24 THEN 'Mid (6-24 mo)'
                ELSE 'Loyal (24+ mo)' END AS tenure_band,
              COUNT(*) AS customer_count, {long_sum("p.churn_prediction")} AS predicted_churners,
              {percent("SUM(p.churn_prediction)", "COUNT(*)")} AS predicted_churn_rate_pct,
              {mean("c.monthly_charges", 2)} AS avg_monthly_charges
            FROM {_joined} GROUP BY 1, 2, 3 HAVING COUNT(*) >= 10""",
        ),
        "report_retention_roi": over(
            "telco_predictions",
            """SELECT COUNT(*) AS high_risk_customers, CAST(SUM(m) AS DECIMAL(18,2))
                AS monthly_revenue_at_risk,
              CAST(ROUND(SUM(m) * 0.30, 2) AS DECIMAL(18,2)) AS retained_revenue_30pct_success,
              CAST(ROUND(SUM(m) * 0.30 * 0.80, 2) AS DECIMAL(18,2))
                AS net_retained_revenue_after_20pct_discount,
              CAST(ROUND(SUM(m) * 0.30 * 0.80 * 12, 2) AS DECIMAL(18,2)) AS annual_net_retention_value
            FROM high""",
            high=f"SELECT c.monthly_charges AS m FROM {_joined} AND p.risk_tier = 'HIGH'",
        ),
        "report_model_tracking": over(
            "telco_predictions",
            f"""SELECT p.run_date, p.model_version, COUNT(*) AS total_predictions,
              {total("p.churn_prediction = 1 AND c.churn = 'Yes'")} AS true_positives,
              {total("p.churn_prediction = 1 AND c.churn = 'No'")} AS false_positives,
              {total("p.churn_prediction = 0 AND c.churn = 'No'")} AS true_negatives,
              {total("p.churn_prediction = 0 AND c.churn = 'Yes'")} AS false_negatives,
              {percent(total("(p.churn_prediction = 1) = (c.churn = 'Yes')"), "COUNT(*)")}
                AS accuracy_pct
            FROM telco_predictions p JOIN telco_customers c ON c.customer_id = p.customer_id
            WHERE {known} GROUP BY p.run_date, p.model_version""",
        ),
    }
    # Reports from sums per run, and what can be said of the trained model's results without it.
    for name, same in (("daily_summary", "view_daily_summary"), ("weekly_trend", "report_weekly_trend"), ("model_tracking", "report_model_tracking")):
        sql[f"{name}_from_sums"] = sql[same]
    names, values = (", ".join(f(c) for c in MODEL_FEATURES) for f in ("'{}'".format, "CAST({} AS DOUBLE)".format))
    pairs = f"SELECT customer_id, unnest([{names}]) AS feature, unnest([{values}]) AS value FROM matrix"
    test = "FROM sides WHERE side = 'test'"
    support = {"'Stay'": "label = 0", "'Churn'": "label = 1", "'accuracy'": "true", "'macro avg'": "true", "'weighted avg'": "true"}
    sql["shap_pair_values"] = over("matrix", f"SELECT customer_id, feature, value, true AS has_shap FROM ({pairs})")
    sql["shap_global_features"] = over("matrix", f"SELECT DISTINCT feature, true AS is_magnitude FROM ({pairs})")
    sql["gbt_confusion_rows"] = over("sides", f"SELECT label, COUNT(*) AS test_rows {test} GROUP BY label")
    sql["gbt_class_support"] = over(
        "sides",
        " UNION ALL ".join(f"SELECT {name} AS class, COUNT(*) AS support, true AS sound {test} AND {which}" for name, which in support.items()),
    )
    sql["score_consistency"] = over(
        "matrix",
        """SELECT customer_id, true AS tier_agrees, true AS prediction_agrees, true AS action_agrees,
          3 AS reasons FROM matrix""",
    )
    return sql
