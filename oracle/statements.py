"""SQL counterparts of the registered queries, over the raw test tables.

The statements are written for DuckDB and share no code with the package.  Money
is summed in cents and rounded once, as the package documents.
"""

from __future__ import annotations

from collections.abc import Callable

_PATIENTS = """
patients AS (
  SELECT c_custkey AS patient_id,
         CAST(18 + (c_custkey * 37) % 78 AS INTEGER) AS age,
         CASE (c_custkey // 6) % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender,
         CASE n_regionkey WHEN 0 THEN 'Northeast' WHEN 1 THEN 'Southeast' WHEN 2 THEN 'Midwest'
                          WHEN 3 THEN 'West' WHEN 4 THEN 'Southwest' END AS region,
         CASE WHEN c_acctbal < 0 THEN 'Self-Pay'
              WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Medicare'
              WHEN c_mktsegment = 'BUILDING' THEN 'Medicaid'
              WHEN c_mktsegment = 'FURNITURE' THEN 'BlueCross'
              WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Aetna'
              WHEN c_mktsegment = 'MACHINERY' THEN 'UnitedHealth' END AS payer,
         CAST(10000 + c_custkey % 90000 AS VARCHAR) AS zip_code,
         CAST(c_custkey % 6 AS INTEGER) AS chronic_conditions,
         DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS enrollment_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

_CLAIMS = """
raw_claims AS (
  SELECT l_orderkey * 8 + l_linenumber AS claim_id,
         o_custkey AS patient_id,
         CAST(l_shipdate AS DATE) AS service_date,
         ['E11', 'I10', 'J45', 'M54', 'F32', 'I25', 'N18', 'J44', 'Z51', 'S72']
           [CAST(l_partkey % 10 AS INTEGER) + 1] AS diagnosis_code,
         ['99213', '93000', '71046', '80053', '85025', '99232', '27447', '43239', '99285', '36415']
           [CAST(l_suppkey % 10 AS INTEGER) + 1] AS procedure_code,
         CASE p_type WHEN 'LARGE' THEN 'Hospital' WHEN 'STANDARD' THEN 'Hospital'
                     WHEN 'PROMO' THEN 'ER' WHEN 'MEDIUM' THEN 'Outpatient Clinic'
                     WHEN 'SMALL' THEN 'Specialist Office'
                     WHEN 'ECONOMY' THEN 'Primary Care' END AS facility_type,
         region, payer,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS total_cost,
         CASE payer WHEN 'Medicare' THEN 0.80 WHEN 'Medicaid' THEN 0.65 WHEN 'BlueCross' THEN 0.78
                    WHEN 'Aetna' THEN 0.75 WHEN 'UnitedHealth' THEN 0.77
                    WHEN 'Self-Pay' THEN 0.45 END AS rate,
         CAST(l_quantity AS INTEGER) % 15 AS days,
         l_linenumber, l_returnflag
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN patients ON o_custkey = patient_id
),
priced_claims AS (
  SELECT *, CAST(round(total_cost * CAST(rate AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS paid_amount
  FROM raw_claims
),
claims AS (
  SELECT claim_id, patient_id, service_date,
         CAST(year(service_date) AS INTEGER) AS service_year,
         CAST(month(service_date) AS INTEGER) AS service_month,
         'Q' || quarter(service_date) AS service_quarter,
         diagnosis_code,
         CASE diagnosis_code
           WHEN 'E11' THEN 'Type 2 Diabetes' WHEN 'I10' THEN 'Hypertension'
           WHEN 'J45' THEN 'Asthma' WHEN 'M54' THEN 'Back Pain' WHEN 'F32' THEN 'Depression'
           WHEN 'I25' THEN 'Coronary Artery Disease' WHEN 'N18' THEN 'Chronic Kidney Disease'
           WHEN 'J44' THEN 'COPD' WHEN 'Z51' THEN 'Chemotherapy'
           WHEN 'S72' THEN 'Hip Fracture' END AS diagnosis_desc,
         procedure_code,
         CASE procedure_code
           WHEN '99213' THEN 'Office Visit' WHEN '93000' THEN 'EKG' WHEN '71046' THEN 'Chest X-Ray'
           WHEN '80053' THEN 'Comprehensive Metabolic Panel'
           WHEN '85025' THEN 'Complete Blood Count' WHEN '99232' THEN 'Subsequent Hospital Care'
           WHEN '27447' THEN 'Knee Replacement' WHEN '43239' THEN 'Upper GI Endoscopy'
           WHEN '99285' THEN 'Emergency Dept Visit' WHEN '36415' THEN 'Blood Draw'
         END AS procedure_desc,
         facility_type, region, payer, total_cost, paid_amount,
         CAST(total_cost - paid_amount AS DECIMAL(12,2)) AS patient_oop,
         CASE WHEN facility_type = 'Hospital' THEN days ELSE 0 END AS length_of_stay,
         CASE WHEN facility_type = 'Hospital' AND l_linenumber = 7 THEN 1 ELSE 0 END
           AS readmission_30d,
         CASE l_returnflag WHEN 'R' THEN 'Denied' WHEN 'N' THEN 'Pending' WHEN 'A' THEN 'Approved'
         END AS claim_status,
         CAST(total_cost * 100 AS BIGINT) AS cost_c,
         CAST(paid_amount * 100 AS BIGINT) AS paid_c,
         CAST((total_cost - paid_amount) * 100 AS BIGINT) AS oop_c
  FROM priced_claims
)"""

_FAULTY = """
repeated AS (
  SELECT *, unnest(range(1 + CASE WHEN claim_id % 929 = 0 THEN 1 ELSE 0 END
                           + CASE WHEN claim_id % 919 = 0 THEN 2 ELSE 0 END)) AS copy_no
  FROM claims
),
faulty AS (
  SELECT claim_id,
         CASE WHEN claim_id % 997 = 0 THEN NULL WHEN claim_id % 991 = 0 THEN -1
              ELSE patient_id END AS patient_id,
         CASE WHEN claim_id % 983 <> 0 THEN service_date END AS service_date,
         CASE WHEN claim_id % 977 = 0 THEN 0 ELSE total_cost END AS total_cost,
         CASE WHEN claim_id % 971 = 0 THEN total_cost + 10 WHEN claim_id % 967 = 0 THEN -1
              ELSE paid_amount END AS paid_amount,
         CASE WHEN claim_id % 953 = 0 THEN 45 ELSE length_of_stay END AS length_of_stay,
         CASE WHEN claim_id % 947 = 0 THEN 2 ELSE readmission_30d END AS readmission_30d,
         CASE WHEN claim_id % 941 = 0 THEN 'Unknown' ELSE region END AS region,
         CASE WHEN claim_id % 937 <> 0 THEN diagnosis_code END AS diagnosis_code,
         CASE WHEN claim_id % 937 <> 0 THEN diagnosis_desc END AS diagnosis_desc,
         procedure_code, procedure_desc, facility_type
  FROM repeated
)"""


# --- expression texts ------------------------------------------------------


def _mean(cents: str, rows: str) -> str:
    return f"round(CAST({cents} AS DOUBLE) / nullif({rows}, 0), 0) / 100"


def _mean_of(column: str) -> str:
    return _mean(f"sum({column})", f"count({column})")


def _raw_mean(cents: str, rows: str) -> str:
    return f"CAST({cents} AS DOUBLE) / nullif(100 * {rows}, 0)"


def _total(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / 100"


def _pct(part: str, whole: str) -> str:
    return f"round(10000.0::DOUBLE * CAST({part} AS DOUBLE) / nullif({whole}, 0), 0) / 100"


def _even(value: str) -> str:
    return f"round_even({value}, 0) / 100"


def _coverage() -> str:
    return (
        "round(1000.0::DOUBLE * CAST(sum(paid_c) AS DOUBLE) / nullif(sum(cost_c), 0)"
        " * (CAST(count(cost_c) AS DOUBLE) / nullif(count(paid_c), 0)), 0) / 10"
    )


def _int(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _hundredths(column: str) -> str:
    return f"CAST(round({column} * 100, 0) AS BIGINT)"


_READMITS = _int("sum(readmission_30d)")
_DENIED = "count(*) FILTER (WHERE claim_status = 'Denied')"
_IN_HOSPITAL = "facility_type = 'Hospital'"
_TRAITS = "p.patient_id, p.age, p.gender, p.region, p.payer, p.chronic_conditions"


# --- marts as CTEs ---------------------------------------------------------

_SUMMARY_KEYS = "service_year, service_quarter, region, payer, facility_type, diagnosis_desc"
_SUMMARY = f"""
summary AS (
  SELECT {_SUMMARY_KEYS}, count(*) AS claims, {_mean_of('cost_c')} AS avg_cost,
         {_total('cost_c')} AS total_spend, {_total('paid_c')} AS total_paid,
         {_READMITS} AS readmissions, {_pct('sum(readmission_30d)', 'count(*)')} AS readmit_pct
  FROM claims GROUP BY {_SUMMARY_KEYS}
)"""
_REGIONAL = f"""
regional AS (
  SELECT region, service_year, count(*) AS claims, {_mean_of('cost_c')} AS avg_cost,
         {_total('cost_c')} AS total_spend
  FROM claims GROUP BY region, service_year
)"""
_PAYER = f"""
payers AS (
  SELECT payer, service_year, count(*) AS claims, {_mean_of('cost_c')} AS avg_billed,
         {_mean_of('paid_c')} AS avg_paid, {_pct(_DENIED, 'count(*)')} AS denial_rate_pct
  FROM claims GROUP BY payer, service_year
)"""
_STAYS = f"""
stays AS (
  SELECT region, service_year, diagnosis_desc, facility_type, count(*) AS admits,
         {_READMITS} AS readmissions, {_pct('sum(readmission_30d)', 'count(*)')} AS readmit_pct,
         {_mean_of('cost_c')} AS avg_cost
  FROM claims WHERE {_IN_HOSPITAL}
  GROUP BY region, service_year, diagnosis_desc, facility_type
)"""
_QUALITY = f"""
quality AS (
  SELECT region, service_year AS year, count(*) AS total_claims,
         {_even('CAST(sum(cost_c) AS DOUBLE) / nullif(count(cost_c), 0)')} AS avg_cost_per_claim,
         {_total('cost_c')} AS total_spend,
         coalesce({_even(f"10000.0::DOUBLE * CAST(sum(readmission_30d) FILTER (WHERE {_IN_HOSPITAL}) AS DOUBLE)"
                         f" / nullif(count(readmission_30d) FILTER (WHERE {_IN_HOSPITAL}), 0)")}, 0.0::DOUBLE)
           AS readmission_rate_pct,
         {_even(f"10000.0::DOUBLE * CAST({_DENIED} AS DOUBLE) / count(*)")} AS denial_rate_pct,
         coalesce({_even(f"100.0::DOUBLE * CAST(sum(length_of_stay) FILTER (WHERE {_IN_HOSPITAL}) AS DOUBLE)"
                         f" / nullif(count(length_of_stay) FILTER (WHERE {_IN_HOSPITAL}), 0)")}, 0.0::DOUBLE)
           AS avg_los_hospital,
         {_even("10000.0::DOUBLE * CAST(count(*) FILTER (WHERE facility_type = 'ER') AS DOUBLE) / count(*)")}
           AS er_visit_rate_pct
  FROM claims GROUP BY region, service_year
)"""
_PATIENT_MART = f"""
patient_mart AS (
  SELECT {_TRAITS}, count(claim_id) AS total_claims, {_total('cost_c')} AS total_cost,
         {_READMITS} AS readmissions
  FROM patients p LEFT JOIN claims c ON p.patient_id = c.patient_id
  GROUP BY {_TRAITS}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([_PATIENTS, _CLAIMS, *ctes])


def _claims(select: str) -> str:
    return f"{_with()}\n{select}"


def _faulty(select: str) -> str:
    return f"{_with(_FAULTY)}\n{select}"


def _summary(select: str) -> str:
    return f"{_with(_SUMMARY)}\n{select}"


def _quality(select: str) -> str:
    return f"{_with(_QUALITY)}\n{select}"


_GROUPS = """
  SELECT count(*) AS n FROM {source}
  GROUP BY patient_id, service_date, diagnosis_code, procedure_code HAVING count(*) > 1"""
_KNOWN = "('Northeast', 'Southeast', 'Midwest', 'West', 'Southwest')"
_RULES = {
    "null_patient": ("QC-01 Null patient_id", "patient_id IS NULL"),
    "null_date": ("QC-02 Null service_date", "service_date IS NULL"),
    "nonpositive_cost": ("QC-03 Non-positive total_cost", "total_cost <= 0"),
    "overpaid": ("QC-04 Paid > billed (overpayment)", "paid_amount > total_cost"),
    "orphans": ("QC-05 Orphaned claims", None),
    "long_stay": ("QC-06 LOS > 30 days", "length_of_stay > 30"),
    "duplicates": ("QC-07 Duplicate (patient+date+diag+proc)", None),
    "future": ("QC-08 Future-dated claims", "service_date > DATE '2001-06-01'"),
    "bad_flag": ("QC-09 Invalid readmission flag", "readmission_30d NOT IN (0, 1)"),
    "unknown_region": ("QC-10 Unknown region", f"region NOT IN {_KNOWN}"),
}


def _rule(name: str, source: str) -> str:
    """A statement that counts what the rule flags in `source`."""
    if name == "orphans":
        return (
            f"SELECT count(*) AS flagged_records FROM {source} f"
            " WHERE NOT EXISTS (SELECT 1 FROM patients p WHERE p.patient_id = f.patient_id)"
        )
    if name == "duplicates":
        return (
            f"SELECT {_int('coalesce(sum(n - 1), 0)')} AS flagged_records"
            f" FROM ({_GROUPS.format(source=source)})"
        )
    return f"SELECT count(*) AS flagged_records FROM {source} WHERE {_RULES[name][1]}"


def _report(source: str) -> str:
    rows = [
        f"SELECT '{label}' AS \"check\", flagged_records FROM ({_rule(name, source)})"
        for name, (label, _) in _RULES.items()
    ]
    union = "\nUNION ALL ".join(rows)
    return (
        'SELECT "check", flagged_records,'
        " CASE WHEN flagged_records = 0 THEN 'PASS' ELSE 'FLAG' END AS status"
        f" FROM ({union})"
    )


def _check(label: str, condition: str) -> str:
    return _faulty(
        f"SELECT '{label}' AS check_name, count(*) AS records_flagged FROM faulty WHERE {condition}"
    )


# The values that the test tables have; a cell of any other value shows up in `rest`.
_YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]
_REGIONS = ["Northeast", "Southeast", "Midwest", "West", "Southwest"]


def _matrix(source: str, row: str, column: str, cell: str, values: list, empty: str = "NULL") -> str:
    """One column per value, and how many cells are in none of them."""
    cells = f"SELECT {row}, CAST({column} AS VARCHAR) AS c, {cell} AS v FROM {source} GROUP BY {row}, {column}"
    columns = [f"coalesce(max(v) FILTER (WHERE c = '{value}'), {empty}) AS \"{value}\"" for value in values]
    listed = ", ".join(f"'{value}'" for value in values)
    rest = f"count(*) FILTER (WHERE c IS NULL OR c NOT IN ({listed})) AS rest"
    return f"SELECT {row}, {', '.join(columns)}, {rest} FROM ({cells}) GROUP BY {row}"


_KPIS = f"""
SELECT {_total('cost_c')} AS total_spend, count(*) AS total_claims,
       {_raw_mean('sum(cost_c)', 'count(cost_c)')} AS avg_cost,
       CAST(100 * sum(readmission_30d) FILTER (WHERE {_IN_HOSPITAL}) AS DOUBLE)
         / nullif(count(readmission_30d) FILTER (WHERE {_IN_HOSPITAL}), 0) AS readmit_rate,
       CAST(100 * {_DENIED} AS DOUBLE) / nullif(count(*), 0) AS denial_rate
FROM claims"""
_SELECTION = """
WHERE service_year IN (1997, 1998) AND region IN ('Northeast', 'West')
  AND payer IN ('Medicare', 'Aetna') AND facility_type IN ('Hospital', 'ER')"""
_MONTHLY_VOLUME = f"""
SELECT service_year, service_month, count(*) AS total_claims,
       {_mean_of('cost_c')} AS avg_claim_cost, {_total('cost_c')} AS total_spend
FROM claims GROUP BY service_year, service_month"""
_PATIENT_SUMMARY = f"""
SELECT {_TRAITS}, count(claim_id) AS total_claims, {_total('cost_c')} AS total_cost,
       {_mean_of('cost_c')} AS avg_cost_per_claim, {_total('oop_c')} AS total_oop,
       {_READMITS} AS readmissions, max(service_date) AS last_service_date
FROM patients p LEFT JOIN claims c ON p.patient_id = c.patient_id
GROUP BY {_TRAITS}"""
_TILES = """
SELECT patient_id, sum(cost_c) AS spend,
       ntile(20) OVER (ORDER BY sum(cost_c) DESC NULLS LAST, patient_id) AS tile
FROM claims GROUP BY patient_id"""
_DENIALS = f"""
SELECT payer, count(*) AS total_claims, {_DENIED} AS denied,
       {_pct(_DENIED, 'count(*)')} AS denial_rate_pct
FROM claims GROUP BY payer"""


def _percentile(name: str, point: str) -> str:
    inner = f"percentile_cont({point}) WITHIN GROUP (ORDER BY cost_c)"
    return f"round(round({inner}, 4), 0) / 100 AS {name}"


def _yearly_change(current: str, previous: str) -> str:
    return _pct(f"({current} - {previous})", previous)


def _spend_yoy(latest: str) -> str:
    cents = _hundredths("total_spend")
    return f"""
SELECT y AS year, CAST(cur AS DOUBLE) / 100000000 AS spend_m,
       CAST(prev AS DOUBLE) / 100000000 AS prev_spend_m,
       CAST((cur - prev) * 100 AS DOUBLE) / nullif(prev, 0) AS spend_yoy_pct
FROM (SELECT max(latest) AS y,
             sum({cents}) FILTER (WHERE service_year = latest) AS cur,
             sum({cents}) FILTER (WHERE service_year = latest - 1) AS prev
      FROM summary, (SELECT max(service_year) AS latest FROM summary {latest}))"""


def _cost_rank(where: str) -> str:
    return f"""
SELECT * FROM (
  SELECT region, avg_cost_per_claim,
         CAST(dense_rank() OVER (ORDER BY avg_cost_per_claim DESC) AS INTEGER) AS cost_rank
  FROM (SELECT region,
               {_raw_mean(f"sum({_hundredths('total_spend')})", 'sum(claims)')} AS avg_cost_per_claim
        FROM summary GROUP BY region)) {where}"""


def _age_band() -> str:
    edges = [18, 30, 40, 50, 60, 70, 80, 95]
    labels = ["18-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80+"]
    whens = " ".join(
        f"WHEN age >= {low} AND age < {high} THEN '{label}'"
        for low, high, label in zip(edges, edges[1:], labels)
    )
    return f"CASE {whens} END"


# --- digests of whole tables ------------------------------------------------

# The columns of the tables that are written; `:d` marks doubles, `:m` money.
_MART_COLUMNS = {
    "claims_summary": (
        "service_year service_quarter region payer facility_type diagnosis_desc claims avg_cost:d total_spend:d"
        " total_paid:d readmissions readmit_pct:d"
    ),
    "regional_cost": "region service_year claims avg_cost:d total_spend:d",
    "payer_analysis": "payer service_year claims avg_billed:d avg_paid:d denial_rate_pct:d",
    "readmissions": (
        "region service_year diagnosis_desc facility_type admits readmissions readmit_pct:d avg_cost:d"
    ),
    "quality_metrics": (
        "region year total_claims avg_cost_per_claim:d total_spend:d readmission_rate_pct:d denial_rate_pct:d"
        " avg_los_hospital:d er_visit_rate_pct:d"
    ),
    "patient_level": "patient_id age gender region payer chronic_conditions total_claims total_cost:d readmissions",
}
_TABLE_COLUMNS = {
    "patients": "patient_id age gender region payer zip_code chronic_conditions enrollment_date",
    "claims": (
        "claim_id patient_id service_date service_year service_month service_quarter diagnosis_code diagnosis_desc"
        " procedure_code procedure_desc facility_type region payer total_cost:m paid_amount:m patient_oop:m"
        " length_of_stay readmission_30d claim_status"
    ),
    "quality_metrics": _MART_COLUMNS["quality_metrics"],
}
# Panel: the statement behind it, and its columns; YEARS and REGIONS are those of a matrix.
_PANEL_COLUMNS = {
    "kpi_summary": ("exec_kpis", "total_spend:d total_claims avg_cost:d readmit_rate:d denial_rate:d"),
    "kpi_measures": (None, "measure value:d"),
    "kpi_quarterly": (
        "quarterly_kpis", "service_year service_quarter total_spend:d claims avg_cost:d readmissions"
    ),
    "kpi_monthly_spend": ("monthly_spend", "service_year service_month total_cost:d"),
    "regional_cost": ("regional_cost", "region claims avg_cost:d min_cost:d max_cost:d total_spend:d"),
    "regional_rank": ("region_cost_rank", "region avg_cost_per_claim:d cost_rank"),
    "regional_change": ("yoy_avg_cost", "region service_year avg_cost:d yoy_change:d"),
    "regional_spend_vs_readmission": (
        "region_spend_vs_readmit", "region total_spend:d readmit_pct:d claims"
    ),
    "readmission_by_region": (
        "readmit_by_region", "region hospital_claims readmissions readmission_rate_pct:d"
    ),
    "readmission_by_diagnosis": ("top_readmit_diagnoses", "diagnosis_desc readmit_pct:d admits"),
    "readmission_by_year": (
        "readmit_by_year", "service_year hospital_claims readmissions readmission_rate_pct:d"
    ),
    "readmission_matrix": ("readmit_matrix", "region YEARS"),
    "payer_mix": (
        "payer_mix", "payer claims claims_pct:d avg_billed:d avg_paid:d avg_oop:d coverage_pct:d"
    ),
    "utilization_heatmap": ("utilization_matrix", "facility_type REGIONS"),
    "cost_trend": ("cost_trend", "service_year service_month avg_cost:d total_spend:d claims period"),
    "cost_trend_regional": ("regional_yearly", "region service_year avg_cost:d"),
    "denial_rates": ("denial_alert", "payer denial_rate_pct:d severity"),
    "quality_stay_length": ("los_matrix", "region YEARS"),
    "quality_stay_by_region": ("los_by_region", "region avg_los:d"),
    "quality_er_visits": ("er_matrix", "region YEARS"),
    "demographics_age": ("cost_by_age_group", "age_group avg_cost:d"),
    "demographics_decades": ("age_decades", "age_decade patients avg_total_cost:d"),
    "demographics_payer_region": ("payer_region_cost", "payer region total_cost:d"),
    "demographics_chronic": ("cost_by_chronic", "chronic_conditions avg_cost:d"),
    "demographics_gender": ("gender_mix", "gender patients pct:d"),
}
_MEASURES = {
    "spend_m": "measure_spend_m", "total_claims": "measure_claims", "avg_cost_per_claim": "measure_avg_cost",
    "readmission_rate_pct": "measure_readmit_pct", "spend_yoy_pct": "measure_spend_yoy",
    "denial_rate_pct": "measure_denial_pct", "payer_coverage_pct": "payer_coverage",
    "cost_per_readmission": "cost_per_readmission",
}
_SELECTED = {
    "service_year": "service_year IN (1997, 1998)",
    "region": "region IN ('Northeast', 'West')",
    "payer": "payer IN ('Medicare', 'Aetna')",
    "facility_type": "facility_type IN ('Hospital', 'ER')",
}


def _digest(key: str, name: str, statement: str, columns: str) -> str:
    """Rows of a statement, and the exclusive or and the sum of their hashes."""

    def text(column: str, kind: str) -> str:
        value = f'"{column}"'
        if kind:
            value = f"CAST(round({value} * {10000 if kind == 'd' else 100}, 0) AS BIGINT)"
        return f"coalesce(CAST({value} AS VARCHAR), '~')"

    kinds = sorted((column.partition(":")[0], column.partition(":")[2]) for column in columns.split())
    row = ", ".join(text(column, kind) for column, kind in kinds)
    number = f"CAST('0x' || substr(md5(concat_ws('|', {row})), 1, 15) AS BIGINT)"
    return (
        f"SELECT '{name}' AS {key}, count(*) AS rows, CAST(coalesce(bit_xor(h), 0) AS BIGINT) AS hash_xor,"
        f" {_int('coalesce(sum(h % 1000000007), 0)')} AS hash_sum FROM (SELECT {number} AS h FROM ({statement}))"
    )


def _columns(table: str) -> str:
    return ", ".join(column.partition(":")[0] for column in _TABLE_COLUMNS[table].split())


def _selected(statement: str, without: str = "") -> str:
    """The statement over the selected claims, and the patients that have some of them."""
    conditions = " AND ".join(each for name, each in _SELECTED.items() if name != without)
    every = _PATIENTS.replace("patients AS (", "every_patient AS (")
    claims = _CLAIMS.replace("LEFT JOIN patients ON", "LEFT JOIN every_patient ON")
    claims = claims.replace("\nclaims AS (", "\nevery_claim AS (")
    chosen = f"""
claims AS (SELECT * FROM every_claim WHERE {conditions}),
patients AS (
  SELECT * FROM every_patient WHERE {_SELECTED['region']} AND {_SELECTED['payer']}
    AND patient_id IN (SELECT patient_id FROM claims)
)"""
    assert f"{_PATIENTS},{_CLAIMS}" in statement
    return statement.replace(f"{_PATIENTS},{_CLAIMS}", ",".join([every, claims, chosen]))


def _digests(key: str, tables: dict[str, tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(_digest(key, name, *table) for name, table in tables.items())


def _marts(known: dict[str, str], wrap: Callable[[str], str] = str) -> str:
    return _digests(
        "mart",
        {
            name: (wrap(known["mart_patient_level" if name == "patient_level" else f"mart_{name}"]), columns)
            for name, columns in _MART_COLUMNS.items()
        },
    )


def _panels(known: dict[str, str], selected: bool) -> str:
    years, regions = ([1997, 1998], ["Northeast", "West"]) if selected else (_YEARS, _REGIONS)
    matrix = {"YEARS": " ".join(f"{year}:d" for year in years), "REGIONS": " ".join(regions)}

    def over(query: str) -> str:
        if not selected:
            return known[query]
        without = {"measure_spend_yoy": "service_year", "region_cost_rank": "region"}.get(query, "")
        query = {"measure_spend_yoy": "measure_spend_yoy_1998"}.get(query, query)
        return _selected(known[query], without)

    def statement(query: str | None) -> str:
        if query is None:
            return " UNION ALL ".join(
                f"SELECT '{name}' AS measure, CAST({name} AS DOUBLE) AS value FROM ({over(each)})"
                for name, each in _MEASURES.items()
            )
        found = over(query)
        if query == "region_cost_rank" and selected:
            found = f"SELECT * FROM ({found}) WHERE {_SELECTED['region']}"
        return found

    tables = {}
    for name, (query, columns) in _PANEL_COLUMNS.items():
        for word, values in matrix.items():
            columns = columns.replace(word, values)
        tables[name] = (statement(query), columns)
    return _digests("panel", tables)


def statements() -> dict[str, str]:
    """One SQL statement per query name."""
    spend = f"sum({_hundredths('total_spend')})"
    rules = {f"rule_{name}": _faulty(_rule(name, "faulty")) for name in _RULES}
    known = rules | {
        # sources and sinks
        "register_tables": _claims(
            f"""
            SELECT p.gender, count(*) AS claims, {_total('cost_c')} AS total_cost,
                   (SELECT count(*) FROM claims) AS all_claims
            FROM claims c JOIN patients p ON c.patient_id = p.patient_id GROUP BY p.gender"""
        ),
        "coerce_schema": _summary(
            "SELECT * REPLACE (CAST(service_year AS BIGINT) AS service_year) FROM summary"
        ),
        "store_claims": _claims(
            f"""
            SELECT service_year, service_month, {_total('cost_c')} AS total_cost
            FROM claims WHERE service_year IN (1997, 1998) GROUP BY service_year, service_month"""
        ),
        "write_qc_report": _faulty(_report("faulty")),
        # enrichment
        "enrich_calendar": _claims(
            "SELECT claim_id, service_date, service_year, service_month, service_quarter FROM claims"
        ),
        "enrich_codes": _faulty(
            """
            SELECT claim_id, diagnosis_code, procedure_code, diagnosis_desc, procedure_desc
            FROM faulty"""
        ),
        "apply_rate_card": _claims(
            """
            SELECT claim_id, payer, CAST(total_cost AS DOUBLE) AS total_cost,
                   CAST(paid_amount AS DOUBLE) AS paid_amount,
                   CAST(patient_oop AS DOUBLE) AS patient_oop FROM claims"""
        ),
        "date_table": _claims(
            """
            SELECT CAST(d AS DATE) AS "Date", CAST(year(d) AS INTEGER) AS "Year",
                   'Q' || quarter(d) AS "Quarter", CAST(month(d) AS INTEGER) AS "Month",
                   strftime(d, '%b') AS "MonthName", strftime(d, '%Y-%m') AS "YearMonth"
            FROM (SELECT unnest(generate_series(min(service_date), max(service_date),
                                                INTERVAL 1 DAY)) AS d FROM claims)"""
        ),
        # filters
        "slice_claims": _claims(
            "SELECT claim_id, service_year, region, payer, facility_type,"
            f" CAST(total_cost AS DOUBLE) AS total_cost FROM claims {_SELECTION}"
        ),
        "sliced_kpis": _claims(f"{_KPIS} {_SELECTION}"),
        # detailed quality checks
        "qc_null_fields": _faulty(
            f"""
            SELECT 'QC-01 Null critical fields' AS check_name,
                   {_int('sum(CASE WHEN patient_id IS NULL THEN 1 ELSE 0 END)')} AS null_patient_id,
                   {_int('sum(CASE WHEN service_date IS NULL THEN 1 ELSE 0 END)')}
                     AS null_service_date,
                   {_int('sum(CASE WHEN total_cost IS NULL THEN 1 ELSE 0 END)')} AS null_total_cost,
                   {_int('sum(CASE WHEN diagnosis_code IS NULL THEN 1 ELSE 0 END)')}
                     AS null_diag_code
            FROM faulty"""
        ),
        "qc_nonpositive": _check("QC-02 Non-positive costs", "total_cost <= 0 OR paid_amount < 0"),
        "qc_overpayment": _faulty(
            f"""
            SELECT 'QC-03 Overpayment anomaly' AS check_name, count(*) AS records_flagged,
                   {_mean('sum(CAST((paid_amount - total_cost) * 100 AS BIGINT))', 'count(*)')}
                     AS avg_overpayment
            FROM faulty WHERE paid_amount > total_cost"""
        ),
        "qc_orphans": _faulty(
            f"""
            SELECT 'QC-04 Orphaned claims' AS check_name, flagged_records AS records_flagged
            FROM ({_rule('orphans', 'faulty')})"""
        ),
        "qc_long_stay": _check("QC-05 LOS > 30 days (review)", "length_of_stay > 30"),
        "qc_duplicates": _faulty(
            f"""
            SELECT 'QC-06 Duplicate claims' AS check_name, count(*) AS duplicate_groups
            FROM ({_GROUPS.format(source='faulty')})"""
        ),
        "qc_future": _check("QC-07 Future-dated claims", "service_date > DATE '2001-06-01'"),
        "qc_report": _faulty(_report("faulty")),
        "qc_report_clean": _claims(_report("claims")),
        "qc_total_flags": _faulty(
            f"SELECT {_int('sum(flagged_records)')} AS total_flagged FROM ({_report('faulty')})"
        ),
        # utilization
        "monthly_volume": _claims(_MONTHLY_VOLUME),
        "facility_utilization": _claims(
            f"""
            SELECT facility_type, count(*) AS claim_count,
                   {_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct_of_total,
                   {_mean_of('cost_c')} AS avg_cost, {_total('cost_c')} AS total_spend
            FROM claims GROUP BY facility_type"""
        ),
        "top_diagnoses": _claims(
            f"""
            SELECT diagnosis_code, diagnosis_desc, count(*) AS claim_count,
                   {_mean_of('cost_c')} AS avg_cost, {_total('cost_c')} AS total_cost
            FROM claims GROUP BY diagnosis_code, diagnosis_desc
            ORDER BY claim_count DESC, diagnosis_code LIMIT 10"""
        ),
        "procedure_utilization": _claims(
            f"""
            SELECT procedure_code, procedure_desc, count(*) AS times_performed,
                   {_mean_of('cost_c')} AS avg_cost
            FROM claims GROUP BY procedure_code, procedure_desc"""
        ),
        "utilization_matrix": _claims(
            _matrix("claims", "facility_type", "region", "count(*)", _REGIONS, "0")
        ),
        "utilization_matrix_faulty": _faulty(
            _matrix("faulty", "facility_type", "region", "count(*)", [*_REGIONS, "Unknown"], "0")
        ),
        # cost
        "cost_by_payer": _claims(
            f"""
            SELECT payer, count(*) AS claims, {_mean_of('cost_c')} AS avg_allowed,
                   {_mean_of('paid_c')} AS avg_paid, {_mean_of('oop_c')} AS avg_oop,
                   {_coverage()} AS payer_coverage_pct
            FROM claims GROUP BY payer"""
        ),
        "payer_mix": _claims(
            f"""
            SELECT payer, count(*) AS claims,
                   {_pct('count(*)', 'sum(count(*)) OVER ()')} AS claims_pct,
                   {_mean_of('cost_c')} AS avg_billed, {_mean_of('paid_c')} AS avg_paid,
                   {_mean_of('oop_c')} AS avg_oop, {_coverage()} AS coverage_pct
            FROM claims GROUP BY payer"""
        ),
        "regional_cost": _claims(
            f"""
            SELECT region, count(*) AS claims, {_mean_of('cost_c')} AS avg_cost,
                   CAST(min(total_cost) AS DOUBLE) AS min_cost,
                   CAST(max(total_cost) AS DOUBLE) AS max_cost, {_total('cost_c')} AS total_spend
            FROM claims GROUP BY region"""
        ),
        "cost_percentiles": _claims(
            f"""
            SELECT region, {_percentile('p25', '0.25')}, {_percentile('median', '0.5')},
                   {_percentile('p75', '0.75')}, {_percentile('p90', '0.9')},
                   {_mean_of('cost_c')} AS mean
            FROM claims GROUP BY region"""
        ),
        "high_cost_cohort": _claims(
            f"""
            SELECT 'Top 5% high-cost patients' AS cohort, count(*) AS patient_count,
                   {_total('spend')} AS cohort_spend,
                   {_pct('sum(spend)', '(SELECT sum(cost_c) FROM claims)')} AS pct_of_total_spend
            FROM ({_TILES}) WHERE tile = 1"""
        ),
        "patient_ntile": _claims(
            f"""
            SELECT patient_id, CAST(spend AS DOUBLE) / 100 AS total_patient_cost,
                   CAST(tile AS INTEGER) AS tile FROM ({_TILES})"""
        ),
        "yoy_cost": _claims(
            f"""
            SELECT region, service_year AS year, cur / 100 AS avg_cost,
                   prev / 100 AS prev_year_cost, {_yearly_change('cur', 'prev')} AS yoy_pct_change
            FROM (SELECT region, service_year, cur,
                         lag(cur) OVER (PARTITION BY region ORDER BY service_year) AS prev
                  FROM (SELECT region, service_year,
                               round(CAST(sum(cost_c) AS DOUBLE) / nullif(count(cost_c), 0), 0)
                                 AS cur
                        FROM claims GROUP BY region, service_year))"""
        ),
        "cost_trend": _claims(
            f"""
            SELECT service_year, service_month, {_mean_of('cost_c')} AS avg_cost,
                   {_total('cost_c')} AS total_spend, count(*) AS claims,
                   service_year || '-' || lpad(CAST(service_month AS VARCHAR), 2, '0') AS period
            FROM claims GROUP BY service_year, service_month"""
        ),
        "regional_yearly": _claims(
            f"""
            SELECT region, service_year, {_mean_of('cost_c')} AS avg_cost
            FROM claims GROUP BY region, service_year"""
        ),
        "monthly_spend": _claims(
            f"""
            SELECT service_year, service_month, {_total('cost_c')} AS total_cost
            FROM claims GROUP BY service_year, service_month"""
        ),
        # readmission
        "readmit_by_region": _claims(
            f"""
            SELECT region, count(*) AS hospital_claims, {_READMITS} AS readmissions,
                   {_pct('sum(readmission_30d)', 'count(*)')} AS readmission_rate_pct
            FROM claims WHERE {_IN_HOSPITAL} GROUP BY region"""
        ),
        "readmit_by_diagnosis": _claims(
            f"""
            SELECT diagnosis_code, diagnosis_desc, count(*) AS hospital_admits,
                   {_READMITS} AS readmissions,
                   {_pct('sum(readmission_30d)', 'count(*)')} AS readmission_rate_pct,
                   {_mean_of('cost_c')} AS avg_cost
            FROM claims WHERE {_IN_HOSPITAL} GROUP BY diagnosis_code, diagnosis_desc
            HAVING count(*) >= 10"""
        ),
        "readmit_by_year": _claims(
            f"""
            SELECT service_year, count(*) AS hospital_claims, {_READMITS} AS readmissions,
                   {_pct('sum(readmission_30d)', 'count(*)')} AS readmission_rate_pct
            FROM claims WHERE {_IN_HOSPITAL} GROUP BY service_year"""
        ),
        "readmit_by_chronic": _claims(
            f"""
            SELECT chronic_conditions, count(claim_id) AS hospital_claims,
                   {_READMITS} AS readmissions,
                   {_pct('sum(readmission_30d)', 'count(*)')} AS readmission_rate_pct,
                   {_mean_of('cost_c')} AS avg_cost
            FROM claims c JOIN patients p ON c.patient_id = p.patient_id
            WHERE {_IN_HOSPITAL} GROUP BY chronic_conditions"""
        ),
        "top_readmit_diagnoses": _claims(
            f"""
            SELECT diagnosis_desc, {_pct('sum(readmission_30d)', 'count(*)')} AS readmit_pct,
                   count(*) AS admits
            FROM claims WHERE {_IN_HOSPITAL} GROUP BY diagnosis_desc HAVING count(*) >= 10
            ORDER BY readmit_pct DESC, diagnosis_desc LIMIT 8"""
        ),
        "readmit_matrix": _claims(
            _matrix(
                f"(SELECT * FROM claims WHERE {_IN_HOSPITAL})", "region", "service_year",
                _pct("sum(readmission_30d)", "count(*)"), _YEARS,
            )
        ),
        # denial
        "denial_by_payer": _claims(_DENIALS),
        "status_distribution": _claims(
            f"""
            SELECT claim_status, count(*) AS claims,
                   {_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct,
                   {_total('cost_c')} AS value_at_risk
            FROM claims GROUP BY claim_status"""
        ),
        "denial_alert": _claims(
            f"""
            SELECT payer, denial_rate_pct,
                   CASE WHEN denial_rate_pct > 5 THEN 'alert' WHEN denial_rate_pct > 3 THEN 'warn'
                        ELSE 'ok' END AS severity
            FROM ({_DENIALS})"""
        ),
        # patients
        "patient_summary": _claims(_PATIENT_SUMMARY),
        "patient_summary_view": _claims(
            f"""
            SELECT region, count(*) AS patients, {_int('sum(total_claims)')} AS total_claims,
                   max(last_service_date) AS last_service_date
            FROM ({_PATIENT_SUMMARY}) GROUP BY region"""
        ),
        "cost_by_age_group": _claims(
            f"""
            SELECT age_group, {_raw_mean('sum(cost_c)', 'count(cost_c)')} AS avg_cost
            FROM claims c
            JOIN (SELECT patient_id, {_age_band()} AS age_group FROM patients) p
              ON c.patient_id = p.patient_id
            WHERE age_group IS NOT NULL GROUP BY age_group"""
        ),
        "cost_by_chronic": _claims(
            f"""
            SELECT chronic_conditions, {_raw_mean('sum(cost_c)', 'count(cost_c)')} AS avg_cost
            FROM claims c JOIN patients p ON c.patient_id = p.patient_id
            GROUP BY chronic_conditions"""
        ),
        "gender_mix": _claims(
            f"""
            SELECT gender, count(*) AS patients,
                   {_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct
            FROM patients GROUP BY gender"""
        ),
        "age_decades": (
            _with(_PATIENT_MART)
            + f"""
            SELECT CAST(age // 10 * 10 AS INTEGER) AS age_decade, count(*) AS patients,
                   {_raw_mean(f"sum({_hundredths('total_cost')})", 'count(total_cost)')}
                     AS avg_total_cost
            FROM patient_mart GROUP BY 1"""
        ),
        "payer_region_cost": (
            _with(_PATIENT_MART)
            + f"""
            SELECT payer, region, {_total(_hundredths('total_cost'))} AS total_cost
            FROM patient_mart GROUP BY payer, region"""
        ),
        # quality mart
        "quality_metrics": _quality("SELECT * FROM quality"),
        "sliced_quality": _quality("SELECT * FROM quality WHERE year = 1997"),
        "los_matrix": _quality(
            _matrix("quality", "region", "year", "max(avg_los_hospital)", _YEARS, "0.0::DOUBLE")
        ),
        "er_matrix": _quality(
            _matrix("quality", "region", "year", "max(er_visit_rate_pct)", _YEARS, "0.0::DOUBLE")
        ),
        "los_by_region": _quality(
            f"""
            SELECT region,
                   {_raw_mean(f"sum({_hundredths('avg_los_hospital')})", 'count(avg_los_hospital)')}
                     AS avg_los
            FROM quality GROUP BY region"""
        ),
        # measures
        "exec_kpis": _claims(_KPIS),
        "measure_spend_m": _summary(f"SELECT CAST({spend} AS DOUBLE) / 100000000 AS spend_m FROM summary"),
        "measure_claims": _summary(f"SELECT {_int('sum(claims)')} AS total_claims FROM summary"),
        "measure_avg_cost": _summary(
            f"SELECT {_raw_mean(spend, 'sum(claims)')} AS avg_cost_per_claim FROM summary"
        ),
        "measure_readmit_pct": _summary(
            """
            SELECT CAST(100 * sum(readmissions) AS DOUBLE) / nullif(sum(claims), 0)
                     AS readmission_rate_pct FROM summary"""
        ),
        "measure_spend_yoy": _summary(_spend_yoy("")),
        "measure_spend_yoy_selected": _summary(_spend_yoy("WHERE service_year IN (1997, 1999)")),
        "region_cost_rank": _summary(_cost_rank("")),
        "region_cost_rank_selected": _summary(_cost_rank("WHERE region IN ('Midwest', 'West')")),
        "measure_denial_pct": (
            _with(_PAYER)
            + """
            SELECT CAST(100 * sum(claims) FILTER (WHERE denial_rate_pct > 0) AS DOUBLE)
                     / nullif(sum(claims), 0) AS denial_rate_pct FROM payers"""
        ),
        "yoy_avg_cost": (
            _with(_REGIONAL)
            + f"""
            SELECT region, service_year, CAST(cur AS DOUBLE) / 100 AS avg_cost,
                   CAST(cur - prev AS DOUBLE) / nullif(abs(prev), 0) AS yoy_change
            FROM (SELECT region, service_year, cur,
                         lag(cur) OVER (PARTITION BY region ORDER BY service_year) AS prev
                  FROM (SELECT region, service_year,
                               coalesce({_hundredths('avg_cost')}, 0) AS cur FROM regional))"""
        ),
        "cost_per_readmission": _summary(
            f"SELECT {_raw_mean(spend, 'sum(readmissions)')} AS cost_per_readmission FROM summary"
        ),
        "payer_coverage": (
            _with(_PAYER)
            + f"""
            SELECT CAST(100 * sum({_hundredths('avg_paid')}) AS DOUBLE)
                     / nullif(sum({_hundredths('avg_billed')}), 0) AS payer_coverage_pct
            FROM payers"""
        ),
        "quarterly_kpis": _summary(
            f"""
            SELECT service_year, service_quarter, CAST({spend} AS DOUBLE) / 100 AS total_spend,
                   {_int('sum(claims)')} AS claims,
                   {_raw_mean(f"sum({_hundredths('avg_cost')})", 'count(avg_cost)')} AS avg_cost,
                   {_int('sum(readmissions)')} AS readmissions
            FROM summary GROUP BY service_year, service_quarter"""
        ),
        "region_spend_vs_readmit": _summary(
            f"""
            SELECT region, CAST({spend} AS DOUBLE) / 100 AS total_spend,
                   {_pct('sum(readmissions)', 'sum(claims)')} AS readmit_pct,
                   {_int('sum(claims)')} AS claims
            FROM summary GROUP BY region"""
        ),
        # marts
        "mart_claims_summary": _summary("SELECT * FROM summary"),
        "mart_regional_cost": _with(_REGIONAL) + "\nSELECT * FROM regional",
        "mart_payer_analysis": _with(_PAYER) + "\nSELECT * FROM payers",
        "mart_readmissions": _with(_STAYS) + "\nSELECT * FROM stays",
        "mart_quality_metrics": _quality("SELECT * FROM quality"),
        "mart_patient_level": _with(_PATIENT_MART) + "\nSELECT * FROM patient_mart",
    }
    stored = {
        "patients": _claims(f"SELECT {_columns('patients')} FROM patients"),
        "claims": _claims(f"SELECT {_columns('claims')} FROM claims"),
        "quality_metrics": known["quality_metrics"],
    }
    datasets = _digests("table_name", {name: (stored[name], _TABLE_COLUMNS[name]) for name in stored})
    hidden = known | {"measure_spend_yoy_1998": _summary(_spend_yoy("WHERE service_year IN (1997, 1998)"))}
    return known | {
        "enrich_codes_table": known["enrich_codes"],
        "apply_rate_table": known["apply_rate_card"],
        "read_tables": datasets,
        "write_datasets": datasets,
        "export_marts": _marts(known),
        "export_marts_sliced": _marts(known, _selected),
        "export_dashboard": _panels(hidden, selected=False),
        "export_dashboard_sliced": _panels(hidden, selected=True),
    }
