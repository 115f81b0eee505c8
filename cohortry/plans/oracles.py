"""SQL counterparts of the registered queries, written for DuckDB on the same tables."""

from __future__ import annotations

# Fixed values, written here again so that a wrong limit or code of the package shows:
# code, lower limit (inclusive), upper limit (exclusive), label; first and last code of each variable.
_LIMITS = {
    "WHO_International": [
        (1, 0.0, 18.5, "Underweight"), (2, 18.5, 25.0, "Normal weight"), (3, 25.0, 30.0, "Overweight"), (4, 30.0, 999.0, "Obese"),
    ],
    "WHO_AsiaPacific": [
        (1, 0.0, 18.5, "Underweight"), (2, 18.5, 23.0, "Normal weight"), (3, 23.0, 25.0, "Overweight"), (4, 25.0, 999.0, "Obese"),
    ],
}
_LABELLED_CODES = {
    "GenHlth": (1, 5), "Age": (1, 13), "Education": (1, 6), "Income": (1, 11), "Sex": (0, 1), "Diabetes_binary": (0, 1),
}

_P = ["age", "bmi", "sex", "high_bp", "phys_activity", "gen_hlth", "income", "ment_hlth", "stroke", "heart_disease", "diff_walk"]
_PREDICTORS = ", ".join(_P)
_INDICATORS = ["income", "bmi", "ment_hlth", "phys_activity"]
_FEATURES = [
    *_P, *[f"{c}_missing" for c in _INDICATORS], "n_missing_fields",
    "bmi_band", "ment_hlth_band", "risk_points", "risk_flag", "condition_count",
]

_RESPONDENTS = f"""
WITH base AS (
  SELECT o_orderkey AS id,
    CAST(CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE 1 + (o_custkey * 7 + o_orderkey) % 13 END AS INT) AS age,
    CAST(CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE floor((14 + o_totalprice / 10000) * 10) / 10 END AS DOUBLE) AS bmi,
    CAST(o_custkey % 2 AS INT) AS sex,
    CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS INT) AS high_bp,
    CAST(CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS INT) AS phys_activity,
    CAST(substr(o_orderpriority, 1, 1) AS INT) AS gen_hlth,
    CAST(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 1 + c_nationkey % 11 END AS INT) AS income,
    CAST(CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey % 31 END AS INT) AS ment_hlth,
    CAST(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END AS INT) AS stroke,
    CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INT) AS heart_disease,
    CAST(CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS INT) AS diff_walk,
    o_orderkey, o_custkey, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey
), labelled AS (
  SELECT id, {_PREDICTORS},
    CAST(CASE WHEN o_orderkey % 37 = 0 THEN NULL
              WHEN 0.25 * coalesce(age, 7) + 0.08 * (14 + o_totalprice / 10000) + 1.5 * high_bp + 0.4 * (o_custkey % 10) > 8.5 THEN 1
              ELSE 0 END AS INT) AS target
  FROM base
), respondents AS (
  SELECT * FROM labelled
  UNION ALL
  SELECT id + 1000000000 AS id, {_PREDICTORS}, target FROM labelled WHERE id % 50 = 1
), known AS (
  SELECT * FROM respondents WHERE target IS NOT NULL
), capped AS (
  SELECT * REPLACE (CASE WHEN bmi > 60 THEN 60.0::DOUBLE ELSE bmi END AS bmi) FROM known
)"""


def _band(standard: str) -> str:
    """CASE over the fixed limits of one standard."""
    arms = [f"WHEN bmi >= {lower} AND bmi < {upper} THEN {code}" for code, lower, upper, _ in _LIMITS[standard]]
    return f"CAST(CASE {' '.join(arms)} END AS INT)"


def _bands_cte(standard: str) -> str:
    rows = [f"({code}::INT, {lower}::DOUBLE, {upper}::DOUBLE, '{label}')" for code, lower, upper, label in _LIMITS[standard]]
    return f"bands(band_code, lower, upper, band_label) AS (VALUES {', '.join(rows)})"


_LINEAR = "1 / (1 + exp(-(0.21 * age + 0.08 * bmi + 0.9 * high_bp + 0.45 * gen_hlth - 6.0)::DOUBLE))"

_LONG_BANDS = f"""{_RESPONDENTS}, third AS (
          SELECT id, CASE WHEN id % 3 = 0 THEN 25.0::DOUBLE ELSE bmi END AS bmi FROM known),
        long_bands AS (
          SELECT CASE WHEN i % 7 <> 0 THEN (i * 37) % 500 END::INT AS band_code, (140 + i) / 10::DOUBLE AS lower,
            (140 + i + CASE WHEN i % 50 = 0 THEN 400 WHEN i % 11 = 0 THEN 0 ELSE 1 + i % 9 END) / 10::DOUBLE AS upper
          FROM range(500) AS r(i))"""
_FIRST_LONG = """
        SELECT id, any_value(bmi) AS bmi, min(band_code) AS bmi_band
        FROM third LEFT JOIN long_bands ON bmi >= lower AND bmi < upper GROUP BY id"""


def _labels_cte() -> str:
    rows = [f"('{v}', {code}::INT)" for v, (first, last) in _LABELLED_CODES.items() for code in range(first, last + 1)]
    return f"labels_ref(variable, code) AS (VALUES {', '.join(rows)})"


_MENT_BAND = "CAST(CASE WHEN ment_hlth IS NULL THEN NULL WHEN ment_hlth = 0 THEN 0 WHEN ment_hlth <= 14 THEN 1 ELSE 2 END AS INT)"
_POINTS = """CAST(CASE WHEN age IS NULL OR bmi IS NULL OR sex IS NULL OR high_bp IS NULL OR phys_activity IS NULL THEN NULL
    ELSE (CASE WHEN age < 5 THEN 0 WHEN age < 7 THEN 1 WHEN age < 9 THEN 2 ELSE 3 END)
       + (CASE WHEN bmi < 25 THEN 0 WHEN bmi < 30 THEN 1 WHEN bmi < 40 THEN 2 ELSE 3 END)
       + (CASE WHEN sex = 1 THEN 1 ELSE 0 END) + (CASE WHEN high_bp = 1 THEN 1 ELSE 0 END)
       + (CASE WHEN phys_activity = 0 THEN 1 ELSE 0 END) END AS INT)"""
_CONDITIONS = """CAST(CASE WHEN stroke IS NULL OR heart_disease IS NULL OR diff_walk IS NULL THEN NULL
    ELSE (stroke = 1)::INT + (heart_disease = 1)::INT + (diff_walk = 1)::INT END AS INT)"""
_SPLIT = "CASE WHEN ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT % 10000 < 7000 THEN 'Training' ELSE 'Testing' END"
_NULLS = " + ".join(f"({c} IS NULL)::INT" for c in _P)

_POINTED = f"""{_RESPONDENTS}, scored AS (
  SELECT *, CASE WHEN risk_points IS NULL THEN NULL WHEN risk_points >= 5 THEN 1 ELSE 0 END::INT AS risk_flag
  FROM (SELECT *, {_POINTS} AS risk_points FROM capped)
), pointed AS (SELECT * FROM scored WHERE risk_points IS NOT NULL)"""

_PREPARED = f"""{_RESPONDENTS}, profiles AS (
  SELECT min(id) AS id, {_PREDICTORS}, target FROM known GROUP BY {_PREDICTORS}, target
), marked AS (
  SELECT id, {", ".join("CASE WHEN bmi > 60 THEN 60.0::DOUBLE ELSE bmi END AS bmi" if c == "bmi" else c for c in _P)}, target,
    {", ".join(f"({c} IS NULL)::INT AS {c}_missing" for c in _INDICATORS)}, ({_NULLS})::INT AS n_missing_fields
  FROM profiles
), prepared AS (
  SELECT *, CASE WHEN risk_points IS NULL THEN NULL WHEN risk_points >= 5 THEN 1 ELSE 0 END::INT AS risk_flag
  FROM (SELECT *, {_band("WHO_International")} AS bmi_band, {_MENT_BAND} AS ment_hlth_band,
          {_POINTS} AS risk_points, {_CONDITIONS} AS condition_count, {_SPLIT} AS "Partition"
        FROM marked)
)"""

_IMPUTED = f"""{_PREPARED}, medians AS (
  SELECT {", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in _FEATURES)}
  FROM prepared WHERE "Partition" = 'Training'
), imputed AS (
  SELECT id, target, "Partition", {", ".join(f"coalesce(p.{c}, m.{c}) AS {c}" for c in _FEATURES)}
  FROM prepared p CROSS JOIN medians m
), train AS (SELECT * FROM imputed WHERE "Partition" = 'Training'),
test AS (
  SELECT *, (bmi >= 30)::INT AS bmi_flag, (gen_hlth >= 4)::INT AS health_flag,
    bmi / 64.0::DOUBLE AS weight_score, risk_points / 9.0::DOUBLE AS risk_score, gen_hlth / 5.0::DOUBLE AS health_score
  FROM imputed WHERE "Partition" = 'Testing'
)"""


def _rate(a: str, b: str, empty: str = "NULL") -> str:
    return f"CASE WHEN ({b}) > 0 THEN ({a})::DOUBLE / ({b}) ELSE {empty} END"


def _cells(pred: str) -> str:
    return (
        f"count(*) AS n_rows, count(*) FILTER (target = 1 AND {pred} = 1) AS tp, "
        f"count(*) FILTER (target = 0 AND {pred} = 0) AS tn, "
        f"count(*) FILTER (target = 0 AND {pred} = 1) AS fp, count(*) FILTER (target = 1 AND {pred} = 0) AS fn"
    )


_RATES = f"""tp, tn, fp, fn, n_rows,
  round({_rate("tp + tn", "tp + tn + fp + fn", "0.0")}, 6) AS accuracy,
  round({_rate("tp", "tp + fp", "0.0")}, 6) AS precision,
  round({_rate("tp", "tp + fn", "0.0")}, 6) AS recall,
  round({_rate("2 * tp", "2 * tp + fp + fn", "0.0")}, 6) AS f1,
  tp + tn + fp + fn = n_rows AS reconciles"""


def _confusion(source: str, pred: str) -> str:
    return f"SELECT {_RATES} FROM (SELECT {_cells(pred)} FROM {source})"


def _ranked(source: str, score: str) -> str:
    return f"""SELECT *, row_number() OVER w AS rank,
      CAST(sum(target) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_positives
    FROM {source} WINDOW w AS (ORDER BY {score} DESC NULLS LAST, id)"""


def _size(source: str) -> str:
    return f"SELECT count(*) AS n, CAST(sum(target) AS BIGINT) AS p, CAST(ceil(count(*) * 0.20::DOUBLE) AS BIGINT) AS k FROM {source}"


def _top(source: str, score: str) -> str:
    return f"""SELECT k AS contacts, captured, round({_rate("captured", "p", "0.0")}, 6) AS capture_rate,
      round(({_rate("captured", "p", "0.0")}) / 0.20::DOUBLE, 6) AS lift, round({_rate("k", "captured")}, 6) AS contacts_per_case
    FROM (SELECT any_value(k) AS k, any_value(p) AS p, CAST(sum(CASE WHEN rank <= k THEN target ELSE 0 END) AS BIGINT) AS captured
          FROM ({_ranked(source, score)}) r CROSS JOIN ({_size(source)}) s)"""


def _depth(source: str, score: str) -> str:
    return f"""SELECT contacts, round(contacts::DOUBLE / n, 6) AS depth
    FROM (SELECT any_value(n) AS n, min(rank) FILTER (cum_positives >= p * 0.60::DOUBLE) AS contacts
          FROM ({_ranked(source, score)}) r CROSS JOIN ({_size(source)}) s)"""


def _auc(source: str, score: str) -> str:
    """Rank-sum form with mid-ranks."""
    return f"""SELECT round((sum(CASE WHEN target = 1 THEN mid ELSE 0 END) - sum(target) * (sum(target) + 1) / 2.0::DOUBLE)
        / (sum(target)::DOUBLE * (count(*) - sum(target))), 6) AS auc
    FROM (SELECT target, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0::DOUBLE AS mid FROM {source})"""


def _evaluation(model: str, source: str, score: str, pred: str) -> str:
    return f"""SELECT '{model}' AS model, a.auc, c.*, t.contacts AS top_contacts, t.captured AS top_captured,
      t.capture_rate AS top_capture, t.lift AS top_lift, t.contacts_per_case AS top_contacts_per_case,
      d.contacts AS contacts_to_target, d.depth AS depth_to_target
    FROM ({_auc(source, score)}) a, ({_confusion(source, pred)}) c, ({_top(source, score)}) t, ({_depth(source, score)}) d"""


_DEPTHS = "(VALUES (0.05::DOUBLE), (0.10), (0.15), (0.20), (0.25), (0.30), (0.40), (0.50)) AS d(depth)"
_CODED = {"gen_hlth": "GenHlth", "age": "Age", "income": "Income", "sex": "Sex", "target": "Diabetes_binary"}


def _codes(source: str) -> str:
    parts = [
        f"SELECT '{c}' AS variable, {c}::DOUBLE AS code, count(*) AS n_rows FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in _CODED
    ]
    return " UNION ALL ".join(parts)


def _violations(labels_filter: str) -> str:
    names = " ".join(f"WHEN '{ours}' THEN '{theirs}'" for ours, theirs in _CODED.items())
    return f"""{_RESPONDENTS}, {_labels_cte()}, observed AS ({_codes("known")})
    SELECT o.* FROM observed o LEFT JOIN (SELECT variable, code FROM labels_ref WHERE {labels_filter}) l
      ON l.variable = CASE o.variable {names} END AND l.code = o.code
    WHERE l.code IS NULL"""


def _profile_rows() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_known, round(avg({c}::DOUBLE), 6) AS mean,
          round(stddev_samp({c}::DOUBLE), 6) AS stddev, round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max FROM respondents"""
        for c in ["id", *_P, "target"]
    )


def _recalls(source: str, group: str, rules: dict[str, str], extra: str, by: str) -> str:
    tps = ", ".join(f"count(*) FILTER (target = 1 AND {p} = 1) AS {r}_tp" for r, p in rules.items())
    recall = {r: _rate(f"{r}_tp", "actual_positive") for r in rules}
    rates = ", ".join(f"round({x}, 6) AS {r}_recall" for r, x in recall.items())
    gaps = ", ".join(f"round(({x}) - ({recall['risk']}), 6) AS {r}_vs_risk" for r, x in recall.items() if r != "risk")
    return f"""SELECT *, {rates}, {gaps} FROM (
      SELECT {group} AS {group}, {extra} count(*) FILTER (target = 1) AS actual_positive, {tps} FROM {source} GROUP BY {by})"""


_RULES = {"risk": "risk_flag", "weight": "bmi_flag", "health": "health_flag"}


def _chi_square(bmi: str = "bmi", places: int = 6) -> str:
    values = {c: bmi if c == "bmi" else c for c in _FEATURES}
    tables = " UNION ALL ".join(f"SELECT '{c}' AS feature, ({v})::DOUBLE AS value, target AS y FROM train" for c, v in values.items())
    return f"""{_IMPUTED}, long AS ({tables}),
    cells AS (SELECT feature, value, y, count(*)::DOUBLE AS o FROM long GROUP BY ALL),
    vals AS (SELECT feature, value, sum(o) AS r FROM cells GROUP BY ALL),
    ys AS (SELECT feature, y, sum(o) AS c FROM cells GROUP BY ALL),
    totals AS (SELECT feature, sum(o) AS n FROM cells GROUP BY ALL),
    grid AS (
      SELECT v.feature, v.value, ys.y, r * c / n AS e, coalesce(o, 0) AS o
      FROM vals v JOIN ys USING (feature) JOIN totals USING (feature)
      LEFT JOIN cells k ON k.feature = v.feature AND k.value = v.value AND k.y = ys.y)
    SELECT feature, round(sum((o - e) * (o - e) / e), {places}) AS statistic,
      CAST((count(DISTINCT value) - 1) * (count(DISTINCT y) - 1) AS BIGINT) AS dof
    FROM grid GROUP BY feature"""


_HALF, _ODD = "(statistic / 2)", "(dof % 2)"
# The tail of the chi-square distribution: a finite sum by the logarithm of the gamma function, and for odd
# degrees of freedom the complementary error function by its series or its continued fraction.
_TAIL = f"""CASE WHEN dof <= 0 OR statistic <= 0 THEN 1.0 ELSE least(1.0,
    coalesce(list_sum(list_transform(range(0, dof // 2), lambda i: exp((i + {_ODD} / 2) * ln({_HALF}) - {_HALF} - lgamma(i + 1 + {_ODD} / 2)))), 0)
    + CASE WHEN {_ODD} = 0 THEN 0.0 WHEN {_HALF} < 3 THEN 1 - 2 / sqrt(pi()) * exp(-{_HALF}) * sqrt({_HALF}) * list_sum(list_transform(range(0, 60),
        lambda n: exp(2 * n * ln(2) + n * ln({_HALF}) + lgamma(n + 1) - lgamma(2 * n + 2))))
      ELSE exp(-{_HALF}) / sqrt(pi()) / list_reduce([sqrt({_HALF})] || list_transform(range(200, 0, -1), lambda k: k::DOUBLE),
        lambda f, k: sqrt({_HALF}) + k / 2 / f) END) END"""


def _weights(ratio: bool) -> str:
    weight = (
        "CASE WHEN label = 1 THEN greatest(neg, pos)::DOUBLE / least(neg, pos) ELSE 1.0::DOUBLE END"
        if ratio
        else "(neg + pos) / (2.0::DOUBLE * n_rows)"
    )
    return f"""{_PREPARED}, k AS (SELECT count(*) FILTER (target = 0) AS neg, count(*) FILTER (target = 1) AS pos
      FROM prepared WHERE "Partition" = 'Training')
    SELECT label, n_rows, round({weight}, 6) AS weight
    FROM (SELECT 0 AS label, neg AS n_rows, neg, pos FROM k UNION ALL SELECT 1, pos, neg, pos FROM k)"""


_AS_GIVEN = f"SELECT id, {_PREDICTORS}, target FROM respondents"
_PREPARED_COLUMNS = f'id, {_PREDICTORS}, target, {", ".join(_FEATURES[len(_P):])}, "Partition"'

ORACLES: dict[str, str] = {
    "csv_roundtrip": f"{_RESPONDENTS} {_AS_GIVEN}",
    "csv_inferred": f"{_RESPONDENTS} {_codes('respondents')}",
    "parquet_roundtrip": f"{_RESPONDENTS} {_AS_GIVEN}",
    "profile_columns": f"{_RESPONDENTS} {_profile_rows()}",
    "target_cleaning": f"""{_RESPONDENTS} SELECT count(*) AS rows_before, count(*) - count(target) AS rows_removed,
        count(target) AS rows_remaining FROM respondents""",
    "missing_indicators": f"{_RESPONDENTS} SELECT id, {', '.join(f'({c} IS NULL)::INT AS {c}_missing' for c in _INDICATORS)} FROM known",
    "missing_count": f"{_RESPONDENTS} SELECT id, ({_NULLS})::INT AS n_missing_fields FROM known",
    "bmi_cap": f"{_RESPONDENTS} SELECT id, bmi FROM capped",
    "bmi_cap_report": f"{_RESPONDENTS} SELECT count(bmi) AS rows_known, count(*) FILTER (bmi > 60) AS rows_capped FROM known",
    "health_day_bands": f"{_RESPONDENTS} SELECT id, ment_hlth, {_MENT_BAND} AS ment_hlth_band FROM known",
    "bmi_band_reference": f"{_RESPONDENTS} SELECT id, bmi, {_band('WHO_International')} AS bmi_band FROM capped",
    "bmi_band_asia_pacific": f"{_RESPONDENTS} SELECT id, bmi, {_band('WHO_AsiaPacific')} AS bmi_band FROM known",
    "risk_score": f"{_POINTED} SELECT id, risk_points, risk_flag FROM scored",
    "comorbidity_count": f"{_RESPONDENTS} SELECT id, {_CONDITIONS} AS condition_count FROM known",
    "stable_split": f'{_RESPONDENTS} SELECT id, {_SPLIT} AS "Partition" FROM known',
    "class_weights": _weights(ratio=False),
    "class_weights_ratio": _weights(ratio=True),
    "weighted_rows": f"""{_PREPARED}, k AS (SELECT target AS y, (SELECT count(*) FROM prepared WHERE "Partition" = 'Training')
          / (2.0::DOUBLE * count(*)) AS w FROM prepared WHERE "Partition" = 'Training' GROUP BY target)
        SELECT "Partition", target, count(*) AS n_rows, round(sum(w), 4) AS total_weight
        FROM prepared JOIN k ON y = target GROUP BY "Partition", target""",
    "observed_codes": f"{_RESPONDENTS} {_codes('known')}",
    "code_violations": _violations("NOT (variable = 'Age' AND code = 13) AND NOT (variable = 'Income' AND code = 3)"),
    "code_violations_clean": _violations("true"),
    "bmi_range_join": f"""{_RESPONDENTS}, {_bands_cte('WHO_International')}
        SELECT id, bmi, band_code, lower, upper, band_label FROM capped LEFT JOIN bands ON bmi >= lower AND bmi < upper""",
    "bmi_range_join_cells": f"""{_RESPONDENTS}, steps AS (
          SELECT i::INT AS band_code, i / 10::DOUBLE AS lower, (i + 7) / 10::DOUBLE AS upper FROM range(140, 640, 5) AS r(i))
        SELECT id, bmi, band_code, lower, upper FROM known LEFT JOIN steps ON bmi >= lower AND bmi < upper""",
    "bmi_band_long_table": _LONG_BANDS + _FIRST_LONG,
    "bmi_band_long_table_cells": _LONG_BANDS + _FIRST_LONG,
    "bmi_range_join_overlaps": f"""{_LONG_BANDS}
        SELECT id, bmi, band_code, lower, upper FROM third LEFT JOIN long_bands ON bmi >= lower AND bmi < upper""",
    "bmi_band_audit_long": f"""{_LONG_BANDS}, firsts AS ({_FIRST_LONG})
        SELECT count(*) AS rows_checked, count(*) FILTER (band_code IS NULL) AS rows_unmapped,
          count(*) FILTER (bmi_band <> band_code) AS rows_mismatched
        FROM (SELECT * FROM firsts WHERE bmi IS NOT NULL)
        LEFT JOIN (SELECT * FROM long_bands WHERE band_code IS NOT NULL) ON bmi >= lower AND bmi < upper""",
    "tree_table_scores": f"""{_RESPONDENTS}, margins AS (
          SELECT id, 0.1 * (CASE WHEN age <= 5 THEN -2 ELSE 2 END + CASE WHEN age <= 8 THEN -1 ELSE 1 END + CASE WHEN bmi <= 24.9 THEN -1 ELSE 1 END
            + CASE WHEN bmi <= 29.9 THEN -2 ELSE 2 END + CASE WHEN high_bp <= 0 THEN -1 ELSE 1 END)::DOUBLE AS m FROM known)
        SELECT id, round(1 / (1 + exp(-2 * m)), 9) AS score FROM margins""",
    "linear_table_scores": f"""{_RESPONDENTS}
        SELECT id, round({_LINEAR}, 9) AS score FROM known""",
    "linear_table_comparison": f"""{_POINTED}, given AS (
          SELECT *, CASE WHEN linear >= 0.5 THEN 1 ELSE 0 END AS said FROM (
            SELECT id, target, round({_LINEAR}, 9) AS linear, risk_points / 9.0::DOUBLE AS points, risk_flag FROM pointed
            WHERE age IS NOT NULL AND bmi IS NOT NULL AND high_bp IS NOT NULL AND gen_hlth IS NOT NULL))
        ({_evaluation('linear', 'given', 'linear', 'said')}) UNION ALL ({_evaluation('risk', 'given', 'points', 'risk_flag')})""",
    "centre_table_profile": f"""{_RESPONDENTS}, answered AS (
          SELECT * FROM known WHERE age IS NOT NULL AND bmi IS NOT NULL AND high_bp IS NOT NULL AND gen_hlth IS NOT NULL),
        means AS (SELECT gen_hlth AS cluster, round(avg(age), 6) AS a, round(avg(bmi), 6) AS b, round(avg(gen_hlth), 6) AS g FROM answered GROUP BY gen_hlth),
        placed AS (
          SELECT id, age, bmi, target, arg_min(cluster, {{'d': (age - a) ** 2 + (bmi - b) ** 2 + (gen_hlth - g) ** 2, 'c': cluster}}) AS cluster
          FROM answered, means GROUP BY id, age, bmi, target)
        SELECT cluster, count(*) AS n_rows, round(avg(age), 6) AS age_mean, round(avg(bmi), 6) AS bmi_mean, round(avg(target), 6) AS prevalence
        FROM placed GROUP BY cluster""",
    "bmi_band_audit": f"""{_RESPONDENTS}, {_bands_cte('WHO_International')}
        SELECT count(*) AS rows_checked, count(*) FILTER (band_code IS NULL) AS rows_unmapped,
          count(*) FILTER (stored <> band_code) AS rows_mismatched
        FROM (SELECT bmi, {_band('WHO_International')} AS stored FROM capped WHERE bmi IS NOT NULL)
        LEFT JOIN bands ON bmi >= lower AND bmi < upper""",
    "bmi_band_audit_planted": f"""{_RESPONDENTS}, {_bands_cte('WHO_AsiaPacific')}
        SELECT count(*) AS rows_checked, count(*) FILTER (band_code IS NULL) AS rows_unmapped,
          count(*) FILTER (stored <> band_code) AS rows_mismatched
        FROM (SELECT bmi, {_band('WHO_International')} AS stored FROM capped WHERE bmi IS NOT NULL)
        LEFT JOIN (SELECT * FROM bands WHERE band_code <> 3) ON bmi >= lower AND bmi < upper""",
    "dedup_profiles": f"{_RESPONDENTS} SELECT min(id) AS id, {_PREDICTORS}, target FROM known GROUP BY {_PREDICTORS}, target",
    "dedup_profiles_without_key": f"{_RESPONDENTS} SELECT DISTINCT {_PREDICTORS}, target FROM known",
    "risk_distribution": f"""{_POINTED} SELECT risk_points, count(*) AS n_rows, CAST(sum(target) AS BIGINT) AS positives
        FROM scored GROUP BY risk_points""",
    "band_distribution": f"""{_RESPONDENTS} SELECT bmi_band, count(*) AS n_rows
        FROM (SELECT {_band('WHO_International')} AS bmi_band FROM capped) GROUP BY bmi_band""",
    "comorbidity_distribution": f"""{_RESPONDENTS} SELECT condition_count, count(*) AS n_rows
        FROM (SELECT {_CONDITIONS} AS condition_count FROM known) GROUP BY condition_count""",
    "target_distribution": f"{_RESPONDENTS} SELECT target, count(*) AS n_rows FROM respondents GROUP BY target",
    "partition_distribution": f'{_PREPARED} SELECT "Partition", count(*) AS n_rows FROM prepared GROUP BY "Partition"',
    "confusion_table": f"{_POINTED} SELECT target, risk_flag, count(*) AS n_rows FROM scored GROUP BY target, risk_flag",
    "confusion_metrics": f"{_POINTED} {_confusion('scored', 'risk_flag')}",
    "confusion_metrics_reconciled": f"{_POINTED} {_confusion('pointed', 'risk_flag')}",
    "subgroup_recall": f"{_IMPUTED} {_recalls('test', 'income', _RULES, '', 'income')}",
    "subgroup_recall_raw": f"""{_PREPARED}, t AS (SELECT *, (bmi >= 30)::INT AS bmi_flag, (gen_hlth >= 4)::INT AS health_flag
          FROM prepared WHERE "Partition" = 'Testing')
        {_recalls('t', 'income', _RULES, 'grouping(income)::INT AS is_overall,', 'ROLLUP (income)')}""",
    "baseline_metrics": f"""{_IMPUTED} SELECT tp, tn, fp, fn, precision, recall, f1, tp + fp AS flagged,
          round({_rate('tp + fp', 'tp')}, 6) AS flagged_per_case FROM ({_confusion('test', 'risk_flag')})""",
    "baseline_summary": f"""{_IMPUTED} SELECT tp, tn, fp, fn, precision, recall, f1, tp + fp AS flagged,
          round({_rate('tp + fp', 'tp')}, 6) AS flagged_per_case, t.*
        FROM ({_confusion('test', 'risk_flag')}) c, ({_top('test', 'risk_points')}) t""",
    "cluster_profile": f"""{_IMPUTED} SELECT gen_hlth, count(*) AS n_rows, round(avg(age), 6) AS age_mean,
          round(avg(income), 6) AS income_mean, round(avg(bmi), 6) AS bmi_mean, round(avg(risk_points), 6) AS risk_points_mean,
          round(avg(condition_count), 6) AS condition_count_mean, round(avg(target), 6) AS prevalence FROM train GROUP BY gen_hlth""",
    "train_medians": f"{_IMPUTED} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::DOUBLE AS median FROM medians" for c in _FEATURES),
    "global_rank": f"{_RESPONDENTS}, t AS (SELECT * FROM known WHERE bmi IS NOT NULL) SELECT id, bmi, rank FROM ({_ranked('t', 'bmi')})",
    "rank_with_nulls": f"{_RESPONDENTS} SELECT id, bmi, rank FROM ({_ranked('known', 'bmi')})",
    "cumulative_positives": f"""{_RESPONDENTS}, t AS (SELECT * FROM known WHERE bmi IS NOT NULL)
        SELECT id, bmi, target, rank, cum_positives FROM ({_ranked('t', 'bmi')})""",
    "cumulative_positives_heavy_ties": f"""{_POINTED}
        SELECT id, risk_points, target, rank, cum_positives FROM ({_ranked('pointed', 'risk_points')})""",
    "top20_capture": f"{_RESPONDENTS}, t AS (SELECT * FROM known WHERE bmi IS NOT NULL) {_top('t', 'bmi')}",
    "depth_to_60": f"{_RESPONDENTS}, t AS (SELECT * FROM known WHERE bmi IS NOT NULL) {_depth('t', 'bmi')}",
    "gains_curve": f"""{_POINTED} SELECT depth, contacts, captured, round({_rate('captured', 'p')}, 6) AS capture FROM (
          SELECT depth, any_value(CAST(floor(n * depth) AS BIGINT)) AS contacts, any_value(p) AS p,
            CAST(coalesce(sum(target) FILTER (rank <= floor(n * depth)), 0) AS BIGINT) AS captured
          FROM ({_ranked('pointed', 'risk_points')}) r CROSS JOIN ({_size('pointed')}) s CROSS JOIN {_DEPTHS} GROUP BY depth)""",
    "baseline_top20": f"{_POINTED} {_top('pointed', 'risk_points')}",
    "baseline_top20_expected": f"""{_POINTED}, g AS (
          SELECT risk_points, count(*) AS n, sum(target) AS pos FROM pointed GROUP BY risk_points
        ), b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY risk_points DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g
        ), c AS (SELECT any_value(k) AS k, any_value(p) AS p,
            sum(pos * greatest(least((k - before)::DOUBLE / b.n, 1.0), 0.0))::DOUBLE AS captured
          FROM b CROSS JOIN ({_size('pointed')}) s)
        SELECT k AS contacts, round(captured, 6) AS captured, round(captured / p, 6) AS capture_rate,
          round(captured / p / 0.20::DOUBLE, 6) AS lift, round(k / captured, 6) AS contacts_per_case FROM c""",
    "threshold_sweep": f"""{_POINTED} SELECT t AS threshold, round({_rate('tp', 'tp + fn')}, 6) AS recall,
          round({_rate('tp', 'tp + fp')}, 6) AS precision, tp + fp AS contacted FROM (
          SELECT t, count(*) FILTER (s >= t AND target = 1) AS tp, count(*) FILTER (s >= t AND target = 0) AS fp,
            count(*) FILTER (s < t AND target = 1) AS fn
          FROM (SELECT risk_points / 9.0::DOUBLE AS s, target FROM pointed)
          CROSS JOIN (VALUES (0.3::DOUBLE), (0.4), (0.5), (0.6)) AS v(t) GROUP BY t)""",
    "evaluation_record": f"{_IMPUTED} {_evaluation('weight', 'test', 'weight_score', 'bmi_flag')}",
    "model_comparison": f"{_IMPUTED} " + " UNION ALL ".join(
        f"({_evaluation(rule, 'test', f'{rule}_score', flag)})" for rule, flag in _RULES.items()
    ),
    "auc_exact": f"{_RESPONDENTS}, t AS (SELECT * FROM known WHERE bmi IS NOT NULL) {_auc('t', 'bmi')}",
    "best_by": f"""{_RESPONDENTS} SELECT income, CAST(sum(target) AS BIGINT) AS positives FROM known
        WHERE income IS NOT NULL GROUP BY income ORDER BY positives DESC, income LIMIT 1""",
    "trace_rows": f"""{_PREPARED}, t AS (SELECT * FROM prepared WHERE "Partition" = 'Testing'),
        c AS (SELECT 'flagged' AS table_name, count(*) AS n_rows FROM t UNION ALL SELECT 'ranked', count(*) FROM t
          UNION ALL SELECT 'known_bmi', count(bmi) FROM t)
        SELECT table_name, n_rows, (SELECT count(*) FROM t) AS expected_rows,
          CASE WHEN n_rows = (SELECT count(*) FROM t) THEN 'OK' ELSE 'CHECK' END AS status FROM c""",
    "stage_audit": f"""{_RESPONDENTS}, n AS (SELECT (SELECT count(*) FROM respondents) AS source, (SELECT count(*) FROM known) AS known,
          count(*) AS kept, count(*) FILTER (bmi > 60) AS capped FROM (SELECT DISTINCT {_PREDICTORS}, target FROM known))
        SELECT '1 target' AS step, source AS rows_before, known AS rows_after, source - known AS rows_affected, '' AS detail FROM n
        UNION ALL SELECT '2 duplicates', known, kept, known - kept, '' FROM n
        UNION ALL SELECT '3 indicators', kept, kept, 0, '{",".join(sorted(f"{c}_missing" for c in _INDICATORS))}' FROM n
        UNION ALL SELECT '4 cap', kept, kept, capped, '' FROM n""",
    "prepared_table": f"{_PREPARED} SELECT {_PREPARED_COLUMNS} FROM prepared",
    "impute_train_median": f"{_IMPUTED} SELECT {_PREPARED_COLUMNS} FROM imputed",
    "recompute_after_impute": f"""{_IMPUTED} SELECT id, {_band('WHO_International')} AS bmi_band, {_MENT_BAND} AS ment_hlth_band,
          {_POINTS} AS risk_points, ({_POINTS} >= 5)::INT AS risk_flag, {_CONDITIONS} AS condition_count FROM imputed""",
    "chi_square_scores": _chi_square(),
    "selected_features": f"""WITH tests AS ({_chi_square("floor(bmi / 5.0::DOUBLE)", places=15)}),
        p AS (SELECT *, {_TAIL} AS p FROM tests),
        ranked AS (SELECT row_number() OVER (ORDER BY p, CASE WHEN dof > 0 THEN statistic / dof ELSE 0 END DESC, feature)::INT AS rank, * FROM p)
        SELECT rank, feature, round(statistic, 6) AS statistic, dof, round(p, 12) AS p_value, {len(_FEATURES)}::INT AS n_candidates FROM ranked WHERE rank <= 12""",
    "chi_square_binned": _chi_square("floor(bmi / 5.0::DOUBLE)"),
    "scale_unit_std": f"""{_IMPUTED}, sd AS (SELECT {", ".join(f"stddev_samp({c}::DOUBLE) AS {c}" for c in _FEATURES)} FROM train)
        SELECT i.id, i."Partition", {", ".join(f"round(CASE WHEN sd.{c} > 0 THEN i.{c} / sd.{c} ELSE 0.0 END, 6) AS {c}" for c in _FEATURES)}
        FROM imputed i CROSS JOIN sd""",
    "silhouette": """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        d AS (SELECT a.vec_id, a.label, b.label AS other, count(*) AS n,
            sum(list_inner_product(a.x, a.x) + list_inner_product(b.x, b.x) - 2 * list_inner_product(a.x, b.x)) AS s
          FROM v a CROSS JOIN v b WHERE a.vec_id <> b.vec_id GROUP BY ALL),
        ab AS (SELECT vec_id, max(s / n) FILTER (label = other) AS inner_d, min(s / n) FILTER (label <> other) AS outer_d
          FROM d GROUP BY vec_id)
        SELECT count(*) AS n_rows, round(avg(CASE WHEN inner_d IS NULL OR greatest(inner_d, outer_d) = 0 THEN 0
          ELSE (outer_d - inner_d) / greatest(inner_d, outer_d) END), 6) AS silhouette FROM ab""",
}

ORACLES |= {
    "rank_bigint_ties": """SELECT o_orderkey AS id,
        row_number() OVER (ORDER BY 9007199254740992 + o_orderkey % 2 DESC, o_orderkey) AS rank FROM orders""",
    "rank_decimal_ties": """SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey % 2 DESC, o_orderkey) AS rank FROM orders""",
    "rank_string_key": """SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey % 3 DESC, o_orderkey) AS rank FROM orders""",
}

# The forms for large tables, and a report read back, answer the same questions.
for _twin, _of in {
    "global_rank_buckets": "global_rank",
    "top20_capture_buckets": "top20_capture",
    "depth_to_60_buckets": "depth_to_60",
    "gains_curve_buckets": "gains_curve",
    "evaluation_record_buckets": "evaluation_record",
    "auc_exact_buckets": "auc_exact",
    "report_roundtrip": "risk_distribution",
}.items():
    ORACLES[_twin] = ORACLES[_of]
