"""Independent SQL definitions (DuckDB dialect) of every registered query.

Only the given base tables exist as views on the DuckDB side, so each query
is ``WITH <derived raw tables and models> <final select>``.  These strings
are written from the model definitions, not generated from the Spark code,
so a mismatch points at a real difference.
"""

from __future__ import annotations

# --- raw layer -----------------------------------------------------------------
RAW = r"""
raw_patients AS (
  SELECT 'p' || CAST(c.c_custkey AS VARCHAR) AS id,
         DATE '1930-01-01' + CAST(c.c_custkey * 37 % 22000 AS INTEGER) AS birthdate,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
         n.n_name AS city,
         r.r_name AS state,
         CASE WHEN c.c_custkey % 50 <> 49
              THEN CAST(40 + n.n_nationkey * 0.1 + (c.c_custkey % 3) * 0.00001 AS DOUBLE) END AS lat,
         CASE WHEN c.c_custkey % 50 <> 49
              THEN CAST(-70 - n.n_nationkey * 0.1 - (c.c_custkey % 3) * 0.00001 AS DOUBLE) END AS lon,
         CASE WHEN c.c_custkey % 10 = 0
              THEN CAST(DATE '2001-09-01' + CAST(c.c_custkey % 365 AS INTEGER) AS TIMESTAMP) END
           AS deceased_datetime
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
raw_encounters AS (
  SELECT 'e' || CAST(o_orderkey AS VARCHAR) AS encounter_id,
         o_orderstatus AS status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'EMER' WHEN '2-HIGH' THEN 'IMP' ELSE 'AMB' END
           AS class_code,
         'T' || substr(o_orderpriority, 1, 1) AS type_code,
         o_orderpriority AS type_display,
         'p' || CAST(o_custkey AS VARCHAR) AS patient_id,
         CAST(o_orderdate AS TIMESTAMP) AS period_start,
         CASE WHEN o_orderkey % 97 <> 0
              THEN CAST(o_orderdate AS TIMESTAMP)
                   + CAST(o_orderkey % 180 AS INTEGER) * INTERVAL '1' MINUTE
                   + CAST(o_orderkey % 60 AS INTEGER) * INTERVAL '1' SECOND END AS period_end,
         'Practitioner ' || CAST(o_custkey % 40 AS VARCHAR) AS practitioner_display,
         'Clinic ' || CAST(o_orderkey % 13 AS VARCHAR) AS location_display,
         'Provider ' || CAST(o_custkey % 11 AS VARCHAR) AS service_provider_display,
         CASE WHEN o_orderkey % 3 = 0 THEN 'R1' END AS reason_code,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Routine check' END AS reason_display
  FROM orders
),
condition_batch AS (
  SELECT 'c' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS condition_id,
         'p' || CAST(o.o_custkey AS VARCHAR) AS patient_id,
         CASE WHEN l.l_linenumber <> 7 THEN 'e' || CAST(l.l_orderkey AS VARCHAR) END AS encounter_id,
         CASE WHEN l.l_returnflag <> 'N' THEN 'resolved' ELSE 'active' END AS clinical_status,
         'confirmed' AS verification_status,
         'encounter-diagnosis' AS category_code,
         CASE WHEN l.l_partkey % 5 = 0 THEN 'A' || lpad(CAST(l.l_partkey % 30 AS VARCHAR), 2, '0')
              ELSE CAST(38341000 + l.l_partkey % 50 AS VARCHAR) END AS condition_code,
         CASE WHEN l.l_partkey % 5 = 0 THEN 'http://hl7.org/fhir/sid/icd-10'
              ELSE 'http://snomed.info/sct' END AS condition_code_system,
         CASE l.l_partkey % 6 WHEN 0 THEN 'Chronic pain (finding)'
                              WHEN 1 THEN 'Joint pain (finding)'
                              WHEN 2 THEN 'Viral sinusitis (disorder)'
                              WHEN 3 THEN 'Hypertension'
                              WHEN 4 THEN 'Prediabetes'
                              ELSE 'Anemia (disorder)' END AS condition_display,
         CAST(o.o_orderdate AS TIMESTAMP) AS onset_datetime,
         CAST(o.o_orderdate AS DATE) AS recorded_date,
         CASE WHEN l.l_returnflag <> 'N' THEN CAST(l.l_shipdate AS TIMESTAMP) END AS abatement_datetime,
         l.l_partkey AS o_partkey, l.l_suppkey AS o_suppkey, l.l_shipdate AS o_shipdate,
         l.l_quantity AS o_quantity, l.l_extendedprice AS o_extendedprice,
         l.l_returnflag <> 'N' AS o_returned,
         row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber
                            ORDER BY l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_quantity,
                                     l.l_extendedprice, l.l_returnflag = 'N' DESC) AS batch_rank
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
raw_conditions AS (
  SELECT * EXCLUDE (batch_rank, o_partkey, o_suppkey, o_shipdate, o_quantity, o_extendedprice, o_returned)
  FROM condition_batch WHERE batch_rank = 1
),
weather_observations AS (
  SELECT CAST(40 + s.s_nationkey * 0.1 AS DOUBLE) AS lat,
         CAST(-70 - s.s_nationkey * 0.1 AS DOUBLE) AS lon,
         CAST(l.l_shipdate AS DATE) AS date,
         CAST(round(CAST(avg(l.l_quantity) - 15 AS DECIMAL(24,9)), 1) AS DOUBLE) AS tavg,
         min(l.l_quantity) - 15 AS tmin,
         max(l.l_quantity) - 15 AS tmax,
         CASE WHEN min(l.l_suppkey) % 11 <> 0
              THEN CAST(round(CAST(min(l.l_discount) * 100 AS DECIMAL(24,9)), 1) AS DOUBLE) END AS prcp,
         1000.0 + CAST(round(CAST(max(l.l_tax) * 100 AS DECIMAL(24,9)), 1) AS DOUBLE) AS pres
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY s.s_nationkey, CAST(l.l_shipdate AS DATE)
),
raw_weather AS (
  SELECT lat, lon, date,
         CASE WHEN NOT isnan(tavg) THEN tavg END AS tavg,
         CASE WHEN NOT isnan(tmin) THEN tmin END AS tmin,
         CASE WHEN NOT isnan(tmax) THEN tmax END AS tmax,
         CASE WHEN NOT isnan(prcp) THEN prcp END AS prcp,
         CASE WHEN NOT isnan(pres) THEN pres END AS pres
  FROM weather_observations
  WHERE NOT (coalesce(isnan(tavg), true) AND coalesce(isnan(prcp), true)
             AND coalesce(isnan(pres), true))
),
raw_icd AS (
  SELECT DISTINCT 'A' || lpad(CAST(p_partkey % 30 AS VARCHAR), 2, '0') AS code,
         'Title ' || CAST(p_partkey % 30 AS VARCHAR) AS title,
         'Codes of group ' || CAST(p_partkey % 30 AS VARCHAR) AS description,
         CASE WHEN p_partkey % 30 < 10 THEN 'A00-A09'
              WHEN p_partkey % 30 < 20 THEN 'A10-A19' ELSE 'A20-A29' END AS parent_code
  FROM part WHERE p_partkey % 30 <> 17
)"""

# --- staging / intermediate / marts -----------------------------------------
MODELS = r"""
stg_patients AS (
  SELECT id AS patient_id, birthdate, gender, city, state, lat, lon, deceased_datetime,
         deceased_datetime IS NOT NULL AS is_deceased,
         CASE WHEN deceased_datetime IS NOT NULL
              THEN CAST(date_part('year', age(CAST(deceased_datetime AS DATE), birthdate)) AS INTEGER)
         END AS age_at_death
  FROM raw_patients
),
stg_encounters AS (
  SELECT encounter_id, patient_id, status, class_code, type_code, type_display,
         period_start, period_end, practitioner_display, location_display,
         service_provider_display, reason_code, reason_display,
         CASE WHEN period_start IS NOT NULL AND period_end IS NOT NULL
              THEN CAST(round(epoch(period_end - period_start) / 60.0) AS BIGINT) END AS duration_minutes
  FROM raw_encounters
),
stg_conditions AS (
  SELECT condition_id, patient_id, encounter_id, clinical_status, verification_status,
         category_code, condition_code, condition_code_system, condition_display,
         onset_datetime, recorded_date, abatement_datetime,
         abatement_datetime IS NULL AS is_chronic
  FROM raw_conditions
),
stg_weather AS (
  SELECT lat, lon, date AS weather_date, tavg, tmin, tmax, prcp, pres FROM raw_weather
),
stg_icd_codes AS (
  SELECT code, title, description, parent_code FROM raw_icd
),
int_encounters_weather AS (
  SELECT e.encounter_id, e.patient_id, e.period_start, e.period_end, e.duration_minutes,
         e.class_code, e.type_display, e.reason_code, e.reason_display,
         CAST(CAST(p.lat AS DECIMAL(9,4)) AS DOUBLE) AS lat,
         CAST(CAST(p.lon AS DECIMAL(9,4)) AS DOUBLE) AS lon,
         w.tavg, w.tmin, w.tmax, w.prcp, w.pres
  FROM stg_encounters e
  JOIN stg_patients p ON p.patient_id = e.patient_id
  LEFT JOIN stg_weather w
    ON w.lat = CAST(CAST(p.lat AS DECIMAL(9,4)) AS DOUBLE)
   AND w.lon = CAST(CAST(p.lon AS DECIMAL(9,4)) AS DOUBLE)
   AND w.weather_date = CAST(e.period_start AS DATE)
),
fct_encounters AS (
  SELECT e.encounter_id, e.patient_id, CAST(e.period_start AS DATE) AS encounter_date,
         c.condition_id, e.class_code, e.type_display, e.reason_code, e.reason_display,
         e.lat, e.lon, e.duration_minutes, e.tavg, e.tmin, e.tmax, e.prcp, e.pres,
         c.condition_code, c.condition_display, c.is_chronic, c.clinical_status,
         c.onset_datetime, c.abatement_datetime
  FROM int_encounters_weather e
  LEFT JOIN stg_conditions c ON c.patient_id = e.patient_id AND c.encounter_id = e.encounter_id
),
region_locations AS (
  SELECT DISTINCT state, city,
         CAST(CAST(lat AS DECIMAL(9,4)) AS DOUBLE) AS lat,
         CAST(CAST(lon AS DECIMAL(9,4)) AS DOUBLE) AS lon
  FROM stg_patients WHERE lat IS NOT NULL AND lon IS NOT NULL
),
weather_region_day AS (
  SELECT l.state, l.city, w.weather_date,
         count(*) AS n_locations,
         round(avg(w.tavg), 6) AS tavg, min(w.tmin) AS tmin, max(w.tmax) AS tmax,
         round(avg(w.prcp), 6) AS prcp, round(avg(w.pres), 6) AS pres
  FROM region_locations l JOIN stg_weather w ON w.lat = l.lat AND w.lon = l.lon
  GROUP BY l.state, l.city, w.weather_date
),
pain_keys AS (
  SELECT DISTINCT patient_id, encounter_id FROM stg_conditions
  WHERE condition_display ILIKE '%chronic%pain%' OR condition_display ILIKE '%joint pain%'
     OR condition_display ILIKE '%arthralgia%'
),
visits_patient_day AS (
  SELECT e.patient_id, CAST(e.period_start AS DATE) AS weather_date,
         count(*) AS n_visits, count(k.patient_id) AS pain_visits
  FROM stg_encounters e
  LEFT JOIN pain_keys k ON k.patient_id = e.patient_id AND k.encounter_id = e.encounter_id
  GROUP BY e.patient_id, CAST(e.period_start AS DATE)
),
visits_region_day AS (
  SELECT p.state, p.city, v.weather_date,
         CAST(sum(v.n_visits) AS BIGINT) AS n_visits, count(*) AS n_patients,
         CAST(sum(v.pain_visits) AS BIGINT) AS pain_visits,
         count(*) FILTER (WHERE v.pain_visits > 0) AS pain_patients
  FROM visits_patient_day v JOIN stg_patients p ON p.patient_id = v.patient_id
  GROUP BY p.state, p.city, v.weather_date
),
region_panel AS (
  SELECT w.state, w.city, w.weather_date, w.n_locations, w.tavg, w.tmin, w.tmax, w.prcp, w.pres,
         CASE WHEN w.prcp IS NOT NULL THEN w.prcp > 0 END AS is_rainy,
         coalesce(v.n_visits, 0) AS n_visits,
         coalesce(v.n_patients, 0) AS n_patients,
         coalesce(v.pain_visits, 0) AS pain_visits,
         coalesce(v.pain_patients, 0) AS pain_patients
  FROM weather_region_day w
  LEFT JOIN visits_region_day v
    ON v.state = w.state AND v.city = w.city AND v.weather_date = w.weather_date
)"""

PAIN = ("(condition_display ILIKE '%chronic%pain%' OR condition_display ILIKE '%joint pain%' "
        "OR condition_display ILIKE '%arthralgia%')")


def _with_t_test(columns: str, source: str) -> str:
    """``columns`` of ``source`` (r and n among its columns) and the two-sided p-value of r.

    With sin(a) = |r| it is 2 / B(1/2, (n-2)/2) times the integral of cos^(n-3) from a
    to pi/2; Simpson's rule over the part of it that counts, cos(a)^(n-3) taken out.
    """
    return f"""
SELECT {columns}, round(exp(log_p), 6) AS p_value, round(log_p / ln(10), 6) AS log10_p
FROM (
  SELECT *, ln(2) + lgamma((n - 1) / 2.0) - lgamma((n - 2) / 2.0) - ln(pi()) / 2 + (n - 3) * ln(cos(a))
            + ln(w / 20000 / 3 * list_sum(list_transform(range(0, 20001), lambda i:
                (CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                * exp((n - 3) * (ln(cos(a + w * i / 20000)) - ln(cos(a))))))) AS log_p
  FROM (SELECT *, least(pi() / 2 - a, 14 / sqrt(n - 3), 60 / ((n - 3) * tan(a))) AS w
        FROM (SELECT *, asin(abs(r)) AS a FROM ({source}))))"""


def _q(final: str) -> str:
    if final.lstrip().upper().startswith("WITH"):
        return final
    return "WITH " + RAW + "," + MODELS + "\n" + final


FINAL = {
    # --- staging ---------------------------------------------------------------
    "stg_patients": "SELECT * FROM stg_patients",
    "stg_encounters": "SELECT * FROM stg_encounters",
    "stg_conditions": "SELECT * FROM stg_conditions",
    "stg_weather": "SELECT row_number() OVER (ORDER BY lat, lon, weather_date) AS weather_id, * FROM stg_weather",
    "stg_icd_codes": "SELECT * FROM stg_icd_codes",
    # --- intermediate -------------------------------------------------------------
    "int_patient_conditions": """
SELECT p.patient_id, p.gender, p.birthdate, p.city, p.state, p.lat, p.lon, p.is_deceased,
       c.condition_id, c.encounter_id, c.condition_code, c.condition_code_system,
       c.condition_display, c.clinical_status, c.verification_status, c.category_code,
       c.onset_datetime, c.recorded_date, c.abatement_datetime, c.is_chronic
FROM stg_patients p LEFT JOIN stg_conditions c ON c.patient_id = p.patient_id""",
    "int_encounters_weather": "SELECT * FROM int_encounters_weather",
    # --- marts ------------------------------------------------------------------------
    "dim_patients": """
SELECT patient_id, gender, birthdate,
       CAST(date_part('year', age(current_date, birthdate)) AS INTEGER) AS current_age,
       city, state, lat, lon, is_deceased, deceased_datetime, age_at_death
FROM stg_patients""",
    "dim_dates": """
SELECT CAST(d AS DATE) AS date,
       CAST(year(d) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month,
       rpad(monthname(d), 9, ' ') AS month_name,
       CAST(quarter(d) AS INTEGER) AS quarter,
       rpad(dayname(d), 9, ' ') AS day_of_week,
       dayofweek(d) IN (0, 6) AS is_weekend,
       CASE month(d) WHEN 12 THEN 'Winter' WHEN 1 THEN 'Winter' WHEN 2 THEN 'Winter'
                     WHEN 3 THEN 'Spring' WHEN 4 THEN 'Spring' WHEN 5 THEN 'Spring'
                     WHEN 6 THEN 'Summer' WHEN 7 THEN 'Summer' WHEN 8 THEN 'Summer'
                     WHEN 9 THEN 'Autumn' WHEN 10 THEN 'Autumn' WHEN 11 THEN 'Autumn' END AS season
FROM (SELECT unnest(generate_series(
        (SELECT min(CAST(period_start AS DATE)) FROM stg_encounters),
        (SELECT max(CAST(period_end AS DATE)) FROM stg_encounters),
        INTERVAL 1 DAY)) AS d)""",
    "dim_conditions": """
SELECT c.condition_id, c.condition_code, c.condition_code_system, c.condition_display,
       c.clinical_status, c.verification_status, c.category_code, c.is_chronic,
       i.title AS icd_title, i.description AS icd_description, i.parent_code AS icd_parent_code
FROM (SELECT DISTINCT condition_id, condition_code, condition_code_system, condition_display,
                      clinical_status, verification_status, category_code, is_chronic
      FROM stg_conditions) c
LEFT JOIN stg_icd_codes i ON i.code = c.condition_code""",
    "dim_weather": """
SELECT row_number() OVER (ORDER BY lat, lon, weather_date) AS weather_id, lat, lon, weather_date, tavg, tmin, tmax, prcp, pres,
       CASE WHEN prcp IS NULL THEN 'Unknown' WHEN prcp = 0 THEN 'Dry'
            WHEN prcp < 2.5 THEN 'Light rain' WHEN prcp < 7.6 THEN 'Moderate rain'
            ELSE 'Heavy rain' END AS rain_category,
       CASE WHEN tavg IS NULL THEN 'Unknown' WHEN tavg < 0 THEN 'Freezing'
            WHEN tavg < 10 THEN 'Cold' WHEN tavg < 20 THEN 'Mild' ELSE 'Warm' END AS temp_category
FROM stg_weather""",
    "fct_encounters": "SELECT * FROM fct_encounters",
    # --- KPIs ------------------------------------------------------------------------
    "k_pain_patients_by_region": f"""
SELECT p.state, p.city, count(*) AS pain_patients
FROM stg_patients p
WHERE p.patient_id IN (SELECT patient_id FROM stg_conditions WHERE {PAIN})
GROUP BY p.state, p.city""",
    "k_rainy_pain_patients_by_region": f"""
SELECT p.state, p.city, count(*) AS rainy_pain_patients
FROM stg_patients p
WHERE p.patient_id IN (SELECT patient_id FROM fct_encounters WHERE {PAIN} AND prcp > 0)
GROUP BY p.state, p.city""",
    "k_rainy_day_share": """
SELECT state, city, count(prcp) AS known_days,
       count(*) FILTER (WHERE prcp > 0) AS rainy_days,
       round(CASE WHEN count(prcp) <> 0
                  THEN 100.0 * count(*) FILTER (WHERE prcp > 0) / count(prcp) END, 6) AS rainy_day_pct
FROM weather_region_day GROUP BY state, city""",
    "k_top_diagnoses_by_region": """
SELECT state, city, diagnosis_rank, condition_display, n_diagnoses FROM (
  SELECT state, city, condition_display, n_diagnoses,
         CAST(row_number() OVER (PARTITION BY state, city
                                 ORDER BY n_diagnoses DESC, condition_display ASC NULLS LAST)
              AS INTEGER) AS diagnosis_rank
  FROM (SELECT p.state, p.city, c.condition_display, count(*) AS n_diagnoses
        FROM stg_conditions c JOIN stg_patients p ON p.patient_id = c.patient_id
        GROUP BY p.state, p.city, c.condition_display))
WHERE diagnosis_rank <= 3""",
    "k_fact_diagnosis_region": """
SELECT p.state, p.city, c.condition_code, c.condition_display,
       count(*) AS n_diagnoses, count(DISTINCT c.patient_id) AS n_patients
FROM stg_conditions c JOIN stg_patients p ON p.patient_id = c.patient_id
GROUP BY p.state, p.city, c.condition_code, c.condition_display""",
    "k_fact_weather_region_day": "SELECT * FROM weather_region_day",
    "k_fact_pain_weather_analysis": "SELECT * FROM region_panel",
    "k_rain_effect": """
SELECT rainy_pain_days, rainy_no_pain_days, dry_pain_days, dry_no_pain_days,
       CAST(a + b + c + d AS BIGINT) AS n,
       round(chi2, 6) AS chi2,
       round(exp(-chi2 / 2) * scaled, 6) AS p_value,
       round(log10(scaled) - chi2 / 2 / ln(10), 6) AS log10_p,
       round(CASE WHEN b * c <> 0 THEN a * d / (b * c) END, 6) AS odds_ratio,
       round(CASE WHEN a + b <> 0 THEN a / (a + b) END, 6) AS rate_row1,
       round(CASE WHEN c + d <> 0 THEN c / (c + d) END, 6) AS rate_row2
FROM (
  -- exp(x^2) erfc(x) = 2/sqrt(pi) * integral of exp(-u^2 - 2xu) from 0, by Simpson's rule
  SELECT *, 2 / sqrt(pi()) * (40.0 / (2 * sqrt(chi2 / 2) + 6)) / 20000 / 3
            * list_sum(list_transform(range(0, 20001), lambda i:
                (CASE WHEN i = 0 OR i = 20000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                * exp(-pow(i * (40.0 / (2 * sqrt(chi2 / 2) + 6)) / 20000, 2)
                      - 2 * sqrt(chi2 / 2) * i * (40.0 / (2 * sqrt(chi2 / 2) + 6)) / 20000))) AS scaled
  FROM (
    SELECT *, CASE WHEN (a + b) * (c + d) * (a + c) * (b + d) <> 0
                   THEN (a + b + c + d) * (a * d - b * c) * (a * d - b * c)
                        / ((a + b) * (c + d) * (a + c) * (b + d)) END AS chi2
    FROM (
      SELECT rainy_pain_days, rainy_no_pain_days, dry_pain_days, dry_no_pain_days,
             CAST(rainy_pain_days AS DOUBLE) AS a, CAST(rainy_no_pain_days AS DOUBLE) AS b,
             CAST(dry_pain_days AS DOUBLE) AS c, CAST(dry_no_pain_days AS DOUBLE) AS d
      FROM (
        SELECT count(*) FILTER (WHERE is_rainy AND pain_patients > 0) AS rainy_pain_days,
               count(*) FILTER (WHERE is_rainy AND NOT pain_patients > 0) AS rainy_no_pain_days,
               count(*) FILTER (WHERE NOT is_rainy AND pain_patients > 0) AS dry_pain_days,
               count(*) FILTER (WHERE NOT is_rainy AND NOT pain_patients > 0) AS dry_no_pain_days
        FROM region_panel WHERE is_rainy IS NOT NULL))))""",
    "k_weather_correlation": _with_t_test(
        """factor, n, round(r, 6) AS pearson_r, slope, intercept, r2,
       round(CASE WHEN n > 2 AND 1 - r * r <> 0 THEN r * sqrt((n - 2.0) / (1.0 - r * r)) END, 6) AS t_stat""", """
SELECT factor, regr_count(y, x) AS n, corr(x, y) AS r,
       round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
       round(regr_r2(y, x), 6) AS r2
FROM (
  SELECT 'tavg' AS factor, tavg AS x, CAST(pain_patients AS DOUBLE) AS y FROM region_panel
  UNION ALL SELECT 'prcp', prcp, CAST(pain_patients AS DOUBLE) FROM region_panel
  UNION ALL SELECT 'pres', pres, CAST(pain_patients AS DOUBLE) FROM region_panel)
GROUP BY factor"""),
    "k_icd_validation": """
SELECT c.condition_code_system, count(*) AS n_conditions, count(i.code) AS n_icd_matched,
       round(CASE WHEN count(*) <> 0 THEN 100.0 * count(i.code) / count(*) END, 6) AS match_pct
FROM stg_conditions c LEFT JOIN stg_icd_codes i ON i.code = c.condition_code
GROUP BY c.condition_code_system""",
    "k_dim_region": """
SELECT state || '/' || city AS region_key, state, city, count(*) AS n_patients,
       count(*) FILTER (WHERE lat IS NOT NULL AND lon IS NOT NULL) AS n_located
FROM stg_patients GROUP BY state, city""",
    "k_dim_diagnosis": f"""
SELECT d.condition_code, d.condition_display, d.condition_code_system, d.n_diagnoses,
       i.title AS icd_title, i.parent_code AS icd_parent_code,
       coalesce({PAIN.replace('condition_display', 'd.condition_display')}, false) AS is_pain
FROM (SELECT condition_code, condition_display, condition_code_system, count(*) AS n_diagnoses
      FROM stg_conditions GROUP BY condition_code, condition_display, condition_code_system) d
LEFT JOIN stg_icd_codes i ON i.code = d.condition_code""",
    "k_region_day_keys": """
SELECT e.encounter_id, e.patient_id, p.state, p.city, e.lat, e.lon,
       CAST(e.period_start AS DATE) AS encounter_date,
       (e.tavg IS NOT NULL OR e.prcp IS NOT NULL OR e.pres IS NOT NULL) AS has_weather
FROM int_encounters_weather e JOIN stg_patients p ON p.patient_id = e.patient_id""",
    # --- sources -------------------------------------------------------------------
    "weather_request_plan": """
SELECT CAST(CAST(p.lat AS DECIMAL(9,4)) AS DOUBLE) AS lat,
       CAST(CAST(p.lon AS DECIMAL(9,4)) AS DOUBLE) AS lon,
       CAST(min(e.period_start) AS DATE) AS date_from,
       least(CAST(max(e.period_end) AS DATE), current_date) AS date_to
FROM raw_patients p JOIN raw_encounters e ON e.patient_id = p.id
WHERE p.lat IS NOT NULL AND p.lon IS NOT NULL
GROUP BY CAST(CAST(p.lat AS DECIMAL(9,4)) AS DOUBLE), CAST(CAST(p.lon AS DECIMAL(9,4)) AS DOUBLE)""",
    "weather_coverage_gaps": """
SELECT * FROM (
  SELECT CAST(CAST(p.lat AS DECIMAL(9,4)) AS DOUBLE) AS lat,
         CAST(CAST(p.lon AS DECIMAL(9,4)) AS DOUBLE) AS lon,
         CAST(min(e.period_start) AS DATE) AS date_from,
         least(CAST(max(e.period_end) AS DATE), current_date) AS date_to
  FROM raw_patients p JOIN raw_encounters e ON e.patient_id = p.id
  WHERE p.lat IS NOT NULL AND p.lon IS NOT NULL
  GROUP BY 1, 2) plan
WHERE NOT EXISTS (SELECT 1 FROM raw_weather w WHERE w.lat = plan.lat AND w.lon = plan.lon)""",
}


# --- data quality ---------------------------------------------------------------
def _dq(check: str, table: str, column: str, failed: str, total: str, source: str) -> str:
    return (f"SELECT '{check}' AS \"check\", '{table}' AS table_name, '{column}' AS column_name, "
            f"CAST(coalesce({failed}, 0) AS BIGINT) AS failed_rows, CAST({total} AS BIGINT) AS total_rows, "
            f"coalesce({failed}, 0) = 0 AS passed FROM {source}")


_RAW_NAME = {"patients": "raw_patients", "encounters": "raw_encounters",
             "conditions": "raw_conditions", "weather": "raw_weather", "icd_codes": "raw_icd"}
_NOT_NULL = {"patients": ["id"], "encounters": ["encounter_id", "patient_id"],
             "conditions": ["condition_id", "patient_id"], "weather": ["lat", "lon", "date"],
             "icd_codes": ["code"]}
_KEYS = {"patients": ["id"], "encounters": ["encounter_id"], "conditions": ["condition_id"],
         "weather": ["lat", "lon", "date"], "icd_codes": ["code"]}
_RANGES = {
    "patients": {"lat_range": "lat BETWEEN -90 AND 90", "lon_range": "lon BETWEEN -180 AND 180",
                 "birth_before_death": "birthdate <= CAST(deceased_datetime AS DATE)"},
    "encounters": {"end_after_start": "period_end >= period_start"},
    "weather": {"lat_range": "lat BETWEEN -90 AND 90", "lon_range": "lon BETWEEN -180 AND 180",
                "prcp_non_negative": "prcp >= 0",
                "tavg_between_min_max": "tmin <= tavg AND tavg <= tmax",
                "pres_range": "pres BETWEEN 850 AND 1100"},
}
_FKS = (("encounters", ["patient_id"], "patients", ["id"]),
        ("conditions", ["patient_id"], "patients", ["id"]),
        ("conditions", ["encounter_id"], "encounters", ["encounter_id"]))


def _dq_not_null() -> list[str]:
    out = []
    for t, cols in _NOT_NULL.items():
        for c in cols:
            out.append(_dq("not_null", t, c, f"count(*) FILTER (WHERE {c} IS NULL)", "count(*)",
                           _RAW_NAME[t]))
    return out


def _dq_unique() -> list[str]:
    out = []
    for t, key in _KEYS.items():
        k = ", ".join(key)
        src = f"(SELECT {k}, count(*) AS n FROM {_RAW_NAME[t]} GROUP BY {k})"
        out.append(_dq("unique", t, ",".join(key), "sum(n) FILTER (WHERE n > 1)", "sum(n)", src))
    return out


def _dq_range() -> list[str]:
    out = []
    for t, rules in _RANGES.items():
        for name, cond in rules.items():
            out.append(_dq("value_range", t, name, f"count(*) FILTER (WHERE NOT ({cond}))",
                           "count(*)", _RAW_NAME[t]))
    return out


def _dq_referential() -> list[str]:
    out = []
    for child, ck, parent, pk in _FKS:
        on = " AND ".join(f"p.{p} = c.{c}" for c, p in zip(ck, pk))
        has = " AND ".join(f"c.{c} IS NOT NULL" for c in ck)
        failed = (f"count(*) FILTER (WHERE {has} AND NOT EXISTS "
                  f"(SELECT 1 FROM {_RAW_NAME[parent]} p WHERE {on}))")
        out.append(_dq("referential", child, ",".join(ck), failed, "count(*)",
                       f"{_RAW_NAME[child]} c"))
    return out


_RAW_COLUMNS = {
    "patients": "id, birthdate, gender, city, state, lat, lon, deceased_datetime",
    "encounters": ("encounter_id, status, class_code, type_code, type_display, patient_id, "
                   "period_start, period_end, practitioner_display, location_display, "
                   "service_provider_display, reason_code, reason_display"),
    "conditions": ("condition_id, patient_id, encounter_id, clinical_status, verification_status, "
                   "category_code, condition_code, condition_code_system, condition_display, "
                   "onset_datetime, recorded_date, abatement_datetime"),
    "weather": "lat, lon, date, tavg, tmin, tmax, prcp, pres",
    "icd_codes": "code, title, description, parent_code",
}


def _dq_dups() -> list[str]:
    out = []
    for t, cols in _RAW_COLUMNS.items():
        src = f"(SELECT count(*) AS n FROM {_RAW_NAME[t]} GROUP BY {cols})"
        out.append(_dq("duplicate_rows", t, "*", "sum(n - 1)", "sum(n)", src))
    return out


FINAL["upsert_ignore"] = """
, first_load AS (
  SELECT * EXCLUDE (load_rank) FROM (
    SELECT *, row_number() OVER (PARTITION BY condition_id
                                 ORDER BY o_partkey, o_suppkey, o_shipdate, o_quantity,
                                          o_extendedprice, o_returned) AS load_rank
    FROM condition_batch WHERE o_shipdate < TIMESTAMP '1997-01-01 00:00:00')
  WHERE load_rank = 1
)
SELECT condition_id, patient_id, encounter_id, clinical_status, verification_status, category_code,
       condition_code, condition_code_system, condition_display, onset_datetime, recorded_date,
       abatement_datetime
FROM first_load
UNION ALL
SELECT condition_id, patient_id, encounter_id, clinical_status, verification_status, category_code,
       condition_code, condition_code_system, condition_display, onset_datetime, recorded_date,
       abatement_datetime
FROM raw_conditions WHERE condition_id NOT IN (SELECT condition_id FROM first_load)"""

FINAL["upsert_replace"] = """
, revision AS (
  SELECT 'A' || lpad(CAST(p_partkey % 30 AS VARCHAR), 2, '0') AS code,
         'Title ' || CAST(p_partkey % 30 AS VARCHAR) || ' / ' || p_brand AS title,
         p_type AS description,
         CASE WHEN p_partkey % 30 < 10 THEN 'A00-A09'
              WHEN p_partkey % 30 < 20 THEN 'A10-A19' ELSE 'A20-A29' END AS parent_code,
         row_number() OVER (PARTITION BY p_partkey % 30 ORDER BY p_partkey DESC) AS latest
  FROM part
)
SELECT code, title, description, parent_code FROM revision WHERE latest = 1
UNION ALL
SELECT code, title, description, parent_code FROM raw_icd
WHERE code NOT IN (SELECT code FROM revision)"""

_H = "http://id.example.org/icd/release/10/2019"
FINAL["hierarchy_bfs"] = f"""
WITH RECURSIVE
parts AS (
  SELECT p_partkey, p_name, p_brand, p_type, p_size,
         CAST(regexp_extract(p_brand, '#([0-9]+)', 1) AS INTEGER) AS brand_n,
         CAST(floor((p_size - 1) / 10) AS INTEGER) AS band,
         '{_H}/P' || CAST(p_partkey AS VARCHAR) AS part_url,
         '{_H}/T-' || p_type AS type_url,
         '{_H}/BRAND' || regexp_extract(p_brand, '#([0-9]+)', 1) AS brand_url,
         '{_H}/' || CAST(CAST(floor((p_size - 1) / 10) AS INTEGER) * 10 AS VARCHAR) AS band_url,
         '{_H}/SIZE' || CAST(p_size AS VARCHAR) AS size_url
  FROM part
),
links AS (
  SELECT DISTINCT '{_H}' AS parent_url, type_url AS child_url,
         CAST(1000 + ascii(p_type) * 100 + length(p_type) AS BIGINT) AS ordinal FROM parts
  UNION ALL SELECT DISTINCT '{_H}', brand_url, CAST(brand_n * 2 AS BIGINT) FROM parts
  UNION ALL SELECT DISTINCT '{_H}', band_url, CAST(band * 10 + 3 AS BIGINT) FROM parts
  UNION ALL SELECT DISTINCT band_url, size_url, CAST(p_size AS BIGINT) FROM parts
  UNION ALL SELECT type_url, part_url, p_partkey FROM parts
  UNION ALL SELECT brand_url, part_url, p_partkey FROM parts
  UNION ALL SELECT size_url, part_url, p_partkey FROM parts
  UNION ALL SELECT part_url, '{_H}', CAST(0 AS BIGINT) FROM parts WHERE p_size = 50
  UNION ALL SELECT part_url, band_url, CAST(1 AS BIGINT) FROM parts WHERE p_size = 50
),
entities AS (
  SELECT DISTINCT type_url AS url, 'T-' || p_type AS code, p_type AS title,
         'Parts of type ' || p_type AS description FROM parts
  UNION ALL SELECT DISTINCT brand_url, 'BRAND' || CAST(brand_n AS VARCHAR), p_brand,
         CAST(NULL AS VARCHAR) FROM parts
  UNION ALL SELECT DISTINCT size_url, 'SIZE' || CAST(p_size AS VARCHAR),
         'Size ' || CAST(p_size AS VARCHAR), CAST(NULL AS VARCHAR) FROM parts
  UNION ALL SELECT part_url, 'P' || CAST(p_partkey AS VARCHAR), p_name, p_type FROM parts
),
walk(url, parent_url, depth, path) AS (
  SELECT '{_H}', CAST(NULL AS VARCHAR), 0, CAST([] AS BIGINT[])
  UNION ALL
  SELECT l.child_url, w.url, w.depth + 1, list_append(w.path, l.ordinal)
  FROM walk w JOIN links l ON l.parent_url = w.url
  WHERE w.depth < 4
),
first_seen AS (
  SELECT url, parent_url, depth FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY depth, path, parent_url) AS rn FROM walk)
  WHERE rn = 1
)
SELECT e.code, e.title, e.description,
       CASE WHEN regexp_matches(regexp_extract(rtrim(f.parent_url, '/'), '[^/]*$'), '[A-Za-z]')
            THEN regexp_extract(rtrim(f.parent_url, '/'), '[^/]*$') END AS parent_code,
       f.depth
FROM first_seen f JOIN entities e ON e.url = f.url"""

FINAL["bundle_patients"] = "SELECT * FROM raw_patients"
FINAL["bundle_encounters"] = "SELECT * FROM raw_encounters"
FINAL["bundle_conditions"] = "SELECT * FROM raw_conditions"

FINAL["stream_weather_landing"] = "SELECT row_number() OVER (ORDER BY lat, lon, date) AS id, * FROM raw_weather"
FINAL["stream_bundle_conditions"] = "SELECT * FROM raw_conditions"
FINAL["store_reload_compacted"] = """
SELECT condition_id, patient_id, encounter_id, clinical_status, verification_status, category_code,
       condition_code, condition_code_system, condition_display, onset_datetime, recorded_date,
       abatement_datetime
FROM (SELECT *, row_number() OVER (PARTITION BY condition_id
                ORDER BY CASE WHEN o_shipdate < TIMESTAMP '1995-01-01 00:00:00' THEN 1
                              WHEN o_shipdate < TIMESTAMP '1997-01-01 00:00:00' THEN 2 ELSE 3 END,
                         o_partkey, o_suppkey, o_shipdate, o_quantity, o_extendedprice, o_returned) AS load_rank
      FROM condition_batch)
WHERE load_rank = 1"""
FINAL["stream_rejected_rows"] = """
SELECT 'encounters' AS table_name,
       CASE WHEN encounter_id LIKE '%7' THEN 'NULL in patient_id' ELSE 'no patients for patient_id' END AS reason,
       encounter_id AS id
FROM raw_encounters WHERE encounter_id LIKE '%7' OR patient_id LIKE '%3'
UNION ALL
SELECT 'conditions',
       CASE WHEN patient_id LIKE '%3' THEN 'no patients for patient_id' ELSE 'no encounters for encounter_id' END,
       condition_id
FROM raw_conditions WHERE patient_id LIKE '%3' OR encounter_id LIKE '%7'"""

FINAL["k_weather_spearman"] = """
, factor_pairs AS (
  SELECT * FROM (
    SELECT 'tavg' AS factor, tavg AS x, CAST(pain_patients AS DOUBLE) AS y FROM region_panel
    UNION ALL SELECT 'prcp', prcp, CAST(pain_patients AS DOUBLE) FROM region_panel
    UNION ALL SELECT 'pres', pres, CAST(pain_patients AS DOUBLE) FROM region_panel)
  WHERE x IS NOT NULL AND y IS NOT NULL
),
ranked AS (
  SELECT factor,
         rank() OVER (PARTITION BY factor ORDER BY x)
           + (count(*) OVER (PARTITION BY factor, x) - 1) / 2.0 AS rx,
         rank() OVER (PARTITION BY factor ORDER BY y)
           + (count(*) OVER (PARTITION BY factor, y) - 1) / 2.0 AS ry
  FROM factor_pairs
)""" + _with_t_test("factor, n, round(r, 6) AS spearman_rho",
                    "SELECT factor, count(*) AS n, corr(rx, ry) AS r FROM ranked GROUP BY factor")

FINAL["k_visiting_patients_period"] = """
SELECT p.state, p.city, count(DISTINCT e.patient_id) AS patients, TRUE AS close
FROM stg_encounters e JOIN stg_patients p ON p.patient_id = e.patient_id
WHERE CAST(e.period_start AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'
GROUP BY p.state, p.city"""

_GAPPY = """
, gappy AS (
  SELECT lat, lon, date,
         CASE WHEN dayofyear(date) % 2 = 0 THEN missing ELSE tavg END AS tavg,
         CASE WHEN dayofyear(date) % 7 = 0 THEN missing ELSE tmin END AS tmin, tmax,
         CASE WHEN dayofyear(date) % 3 = 0 THEN missing ELSE prcp END AS prcp,
         CASE WHEN dayofyear(date) % 5 = 0 THEN missing ELSE pres END AS pres
  FROM (SELECT *, CASE WHEN year(date) % 2 = 1 THEN CAST('NaN' AS DOUBLE) END AS missing
        FROM weather_observations WHERE lat <> CAST(40 + 3 * 0.1 AS DOUBLE))
),
gappy_clean AS (
  SELECT lat, lon, date, CASE WHEN NOT isnan(tavg) THEN tavg END AS tavg,
         CASE WHEN NOT isnan(tmin) THEN tmin END AS tmin, CASE WHEN NOT isnan(tmax) THEN tmax END AS tmax,
         CASE WHEN NOT isnan(prcp) THEN prcp END AS prcp, CASE WHEN NOT isnan(pres) THEN pres END AS pres
  FROM gappy
)"""
FINAL["weather_clean_missing"] = _GAPPY + """
SELECT * FROM gappy_clean WHERE tavg IS NOT NULL OR prcp IS NOT NULL OR pres IS NOT NULL"""
FINAL["weather_gaps_left_out"] = _GAPPY + """
SELECT * FROM (
  SELECT CAST(CAST(p.lat AS DECIMAL(9,4)) AS DOUBLE) AS lat, CAST(CAST(p.lon AS DECIMAL(9,4)) AS DOUBLE) AS lon,
         CAST(min(e.period_start) AS DATE) AS date_from,
         least(CAST(max(e.period_end) AS DATE), current_date) AS date_to
  FROM raw_patients p JOIN raw_encounters e ON e.patient_id = p.id
  WHERE p.lat IS NOT NULL AND p.lon IS NOT NULL GROUP BY 1, 2)
WHERE (lat, lon) NOT IN (SELECT (lat, lon) FROM gappy_clean
                         WHERE tavg IS NOT NULL OR prcp IS NOT NULL OR pres IS NOT NULL)"""

FINAL["k_icd_validation_mapped"] = """
SELECT c.condition_code_system, count(*) AS n_conditions,
       count(*) FILTER (WHERE own OR mapped) AS n_icd_matched, count(*) FILTER (WHERE mapped AND NOT own) AS n_mapped,
       round(100.0 * count(*) FILTER (WHERE own OR mapped) / count(*), 6) AS match_pct
FROM (
  SELECT condition_code_system, condition_code IN (SELECT code FROM stg_icd_codes) AS own,
         condition_code IN (SELECT CAST(38341000 + p_partkey % 50 AS VARCHAR) FROM part
                            WHERE p_partkey % 50 < 30 AND 'A' || lpad(CAST(p_partkey % 50 AS VARCHAR), 2, '0')
                                  IN (SELECT code FROM stg_icd_codes)) AS mapped
  FROM stg_conditions) c
GROUP BY c.condition_code_system"""

FINAL["bundle_rejected"] = """
SELECT 'rejected' AS outcome,
       CASE c_custkey % 13 WHEN 1 THEN 'Patient without id' WHEN 2 THEN 'bundle cannot be read'
         WHEN 3 THEN 'bundle cannot be read' WHEN 4 THEN 'entry is not an object' WHEN 5 THEN 'resource is not an object'
         WHEN 6 THEN 'Patient cannot be read' WHEN 7 THEN 'Encounter cannot be read' WHEN 8 THEN 'Condition cannot be read'
         ELSE 'Encounter without id' END AS what, count(*) AS n
FROM customer WHERE c_custkey % 13 BETWEEN 1 AND 9 GROUP BY ALL
UNION ALL
SELECT 'read', t.kind, count(*) FROM customer, (VALUES ('Patient'), ('Encounter'), ('Condition')) t(kind)
WHERE c_custkey % 13 NOT BETWEEN 1 AND 9 GROUP BY ALL"""

# Node m's first finder is the one before its own prefix, where that has as many digits.
_NUMBERED = """
SELECT 'N' || CAST(p_partkey AS VARCHAR) AS code, p_name AS title, p_type AS description,
       CASE WHEN p_partkey < 10 THEN NULL
            WHEN p_partkey % 10 = 0
                 AND length(CAST(p_partkey // 10 - 1 AS VARCHAR)) = length(CAST(p_partkey // 10 AS VARCHAR))
                 AND p_partkey // 10 - 1 > 0
            THEN 'N' || CAST(p_partkey // 10 - 1 AS VARCHAR)
            ELSE 'N' || CAST(p_partkey // 10 AS VARCHAR) END AS parent_code,
       CAST(length(CAST(p_partkey AS VARCHAR)) AS INTEGER) AS depth
FROM part WHERE p_partkey > 0"""
FINAL["hierarchy_documents"] = _NUMBERED
FINAL["hierarchy_recursive"] = _NUMBERED

_DQ_PARTS = {
    "dq_not_null": _dq_not_null,
    "dq_unique": _dq_unique,
    "dq_value_range": _dq_range,
    "dq_referential": _dq_referential,
    "dq_duplicates": _dq_dups,
}
for _name, _fn in _DQ_PARTS.items():
    FINAL[_name] = "\nUNION ALL\n".join(_fn())
FINAL["dq_report"] = "\nUNION ALL\n".join(q for fn in _DQ_PARTS.values() for q in fn())


FINAL["k_rainy_pain_patients_period"] = f"""
SELECT p.state, p.city, count(*) AS rainy_pain_patients
FROM stg_patients p
WHERE p.patient_id IN (SELECT patient_id FROM fct_encounters
                       WHERE {PAIN} AND prcp > 0
                         AND encounter_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31')
GROUP BY p.state, p.city"""

FINAL["k_rainy_pain_patients_marts"] = FINAL["k_rainy_pain_patients_period"]

FINAL["k_pain_visits_by_season_rain"] = f"""
SELECT coalesce(d.season, 'Unknown') AS season, coalesce(w.rain_category, 'Unknown') AS rain_category,
       count(*) AS pain_visits
FROM (SELECT DISTINCT encounter_id, encounter_date, lat, lon FROM fct_encounters WHERE {PAIN}) f
LEFT JOIN ({FINAL["dim_dates"]}) d ON d.date = f.encounter_date
LEFT JOIN ({FINAL["dim_weather"]}) w
  ON w.lat = f.lat AND w.lon = f.lon AND w.weather_date = f.encounter_date
GROUP BY 1, 2"""

_DAMAGED = """,
bad_patients AS (SELECT * FROM raw_patients WHERE id NOT LIKE '%17'),
bad_encounters AS (SELECT * FROM raw_encounters
                   UNION ALL SELECT * FROM raw_encounters WHERE encounter_id LIKE '%01'),
bad_conditions AS (SELECT * REPLACE (CASE WHEN condition_id NOT LIKE '%5' THEN condition_id END AS condition_id)
                   FROM raw_conditions),
bad_weather AS (SELECT * REPLACE (CASE WHEN day(date) = 13 THEN tmax + 1 ELSE tmin END AS tmin,
                                  CASE WHEN day(date) = 13 THEN tmin - 1 ELSE tmax END AS tmax)
                FROM raw_weather),
bad_icd AS (SELECT * FROM raw_icd)
"""
FINAL["dq_damaged_report"] = "WITH " + RAW + _DAMAGED + FINAL["dq_report"].replace("raw_", "bad_")


def oracle_queries() -> dict[str, str]:
    return {name: _q(final) for name, final in FINAL.items()}
