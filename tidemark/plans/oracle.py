"""Reference SQL for the registered queries, written apart from the operators."""

from __future__ import annotations

from tidemark.plans.fixtures import CLAIMS_SQL, FEED_SQL, LABELS_SQL, TRACKED


def _plain(sql: str) -> str:
    for name in ("events", "orders", "customer"):
        sql = sql.replace("{" + name + "}", name)
    return sql.replace("TIMESTAMP_NTZ'", "TIMESTAMP '").strip()


_TYPES = (
    "'hit_and_run','animal_collision','single_vehicle','theft','parking','side_collision',"
    "'rollover','hail_damage','vandalism','rear_end'"
)
_CLAIM_RULES = {
    "valid_claim_id": "claim_id IS NOT NULL",
    "valid_policy_id": "policy_id IS NOT NULL",
    "valid_incident_date": '"timestamp" IS NOT NULL',
    "valid_amount": "claimed_amount_eur >= 0",
    "valid_incident_type": f"accident_type IN ({_TYPES})",
    "valid_parties": "n_parties_involved >= 1",
    "valid_telematics_anomaly": "telematics_anomaly IN (0, 1)",
    "valid_police_report": "police_report_filed IN (0, 1)",
    "valid_business_hours": "outside_business_hours IN (0, 1)",
}
_POLICY_RULES = {
    "valid_policy_id": "policy_id IS NOT NULL",
    "valid_updated_at": "policy_updated_at IS NOT NULL",
    "valid_age": "policyholder_age >= 18",
    "valid_gender": "gender IS NOT NULL",
    "valid_region": "trim(region_type) IN ('urban','suburban','rural')",
    "valid_premium": "annual_premium_eur > 0",
    "valid_vehicle_year": "vehicle_year > 1900 AND vehicle_year <= 2026",
    "valid_telematics_flag": "has_telematics IN (0, 1)",
}
_LABEL_RULES = {
    "valid_lbl_claim_id": "claim_id IS NOT NULL",
    "valid_fraud_flag": "is_fraud IS NOT NULL AND is_fraud IN (0, 1)",
    "valid_lbl_date": "label_available_timestamp IS NOT NULL",
}


def _all(rules: dict[str, str]) -> str:
    return " AND ".join(f"({r})" for r in rules.values())


def _same_as_before(columns) -> str:
    return " AND ".join(f"lag({c}) OVER w IS NOT DISTINCT FROM {c}" for c in columns)


def _scd2(source: str, columns, prefix: str, collapse: bool = True) -> list[str]:
    """Steps of a history: one row per key and time, changed rows, validity."""
    order = "w AS (PARTITION BY policy_id ORDER BY policy_updated_at)"
    unchanged = f"(lag(policy_id) OVER w IS NOT NULL AND {_same_as_before(columns)})" if collapse else "false"
    names = ", ".join(columns)
    return [
        f"""{prefix}one AS (SELECT * FROM {source} QUALIFY row_number() OVER (
            PARTITION BY policy_id, policy_updated_at ORDER BY feed_id DESC) = 1)""",
        f"""{prefix}marked AS (SELECT *, {unchanged} AS unchanged FROM {prefix}one WINDOW {order})""",
        f"""{prefix}history AS (SELECT policy_id, policy_updated_at, {names},
            policy_updated_at AS "__START_AT", lead(policy_updated_at) OVER w AS "__END_AT"
            FROM {prefix}marked WHERE NOT unchanged WINDOW {order})""",
    ]


_RANGE = "PARTITION BY policy_id ORDER BY epoch_ms(\"timestamp\") RANGE BETWEEN {ms} PRECEDING AND 1 PRECEDING"


def _rolling(source: str, name: str) -> str:
    day = 86_400_000
    windows = ", ".join(
        f"w{s} AS ({_RANGE.format(ms=d * day)})" for s, d in (("24h", 1), ("7d", 7), ("30d", 30))
    )
    return f"""{name} AS (SELECT *, coalesce(sum_7 / (avg_30 + 1e-6), 1.0) AS ratio FROM (
        SELECT claim_id, policy_id, "timestamp",
        count(claim_id) OVER w24h AS n_24, coalesce(sum(claimed_amount_eur) OVER w24h, 0.0) AS sum_24,
        count(claim_id) OVER w7d AS n_7, coalesce(sum(claimed_amount_eur) OVER w7d, 0.0) AS sum_7,
        avg(claimed_amount_eur) OVER w7d AS avg_7,
        count(claim_id) OVER w30d AS n_30, coalesce(sum(claimed_amount_eur) OVER w30d, 0.0) AS sum_30,
        avg(claimed_amount_eur) OVER w30d AS avg_30, max(claimed_amount_eur) OVER w30d AS max_30,
        coalesce(CAST(sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) OVER w30d AS BIGINT), 0) AS fraud_30
        FROM {source} WINDOW {windows}))"""


def _features(a: str) -> str:
    return f"""{a}.n_24 AS count_claims_24h, round({a}.sum_24, 6) AS sum_amount_24h,
        {a}.n_7 AS count_claims_7d, round({a}.sum_7, 6) AS sum_amount_7d,
        round({a}.avg_7, 8) AS avg_amount_7d, {a}.n_30 AS count_claims_30d,
        round({a}.sum_30, 6) AS sum_amount_30d, round({a}.avg_30, 8) AS avg_amount_30d,
        {a}.max_30 AS max_amount_30d, {a}.fraud_30 AS num_fraud_confirmed_30d,
        round({a}.ratio, 8) AS claims_7d_vs_avg_30d_ratio"""


_PROFILE_COLUMNS = (
    "age_group, vehicle_segment, risk_level_by_premium, driver_experience_years, "
    "is_new_policy_risk, gender, region_type, coverage_type, vehicle_type"
)
_BANDS = """CASE WHEN policyholder_age < 25 THEN 'novel' WHEN policyholder_age < 65 THEN 'standard'
        ELSE 'senior' END AS age_group,
        CASE WHEN vehicle_year >= 2022 THEN 'new' WHEN vehicle_year >= 2015 THEN 'mid_age'
        ELSE 'old' END AS vehicle_segment,
        CASE WHEN annual_premium_eur < 500 THEN 'low_risk' WHEN annual_premium_eur < 1200
        THEN 'medium_risk' ELSE 'high_risk' END AS risk_level_by_premium,
        bonus_malus_years AS driver_experience_years"""

_STEPS = [
    f"fx_claims AS ({_plain(CLAIMS_SQL)})",
    f"fx_labels AS ({_plain(LABELS_SQL)})",
    f"fx_policy_feed AS ({_plain(FEED_SQL)})",
    f"clean_claims AS (SELECT * FROM fx_claims WHERE {_all(_CLAIM_RULES)})",
    f"clean_labels AS (SELECT * FROM fx_labels WHERE {_all(_LABEL_RULES)})",
    f"clean_feed AS (SELECT * FROM fx_policy_feed WHERE {_all(_POLICY_RULES)})",
    """enriched AS (SELECT c.*, l.is_fraud, l.label_available_timestamp FROM clean_claims c
        LEFT JOIN clean_labels l ON c.claim_id = l.claim_id
        AND l.label_available_timestamp >= c."timestamp"
        AND l.label_available_timestamp <= c."timestamp" + INTERVAL 31 DAY)""",
    *_scd2("clean_feed", TRACKED, ""),
    f"""profile AS (SELECT policy_id, policyholder_age, gender, region_type, vehicle_year,
        annual_premium_eur, has_telematics, coverage_type, vehicle_type, policy_start_date,
        "__START_AT", "__END_AT", {_BANDS},
        CASE WHEN date_diff('day', policy_start_date, CAST("__START_AT" AS DATE)) < 90 THEN 1 ELSE 0 END
        AS is_new_policy_risk FROM history)""",
    """scored AS (SELECT *, claimed_amount_eur / 500 AS prob_fraud,
        CAST(CASE WHEN claimed_amount_eur / 500 >= 0.2::DOUBLE THEN 1 ELSE 0 END AS BIGINT) AS prediction,
        CASE WHEN day("timestamp") <= 15 THEN 'v1' ELSE 'v2' END AS model_version,
        "timestamp" + INTERVAL 2 HOUR AS inference_timestamp FROM enriched)""",
    """raw_labelled AS (SELECT c.*, coalesce(l.is_fraud, 0) AS is_fraud FROM fx_claims c
        LEFT JOIN clean_labels l USING (claim_id))""",
    _rolling("enriched", "rolled"),
    _rolling("raw_labelled", "rolled_raw"),
    """spine AS (SELECT claim_id, policy_id, "timestamp", is_fraud,
        date_trunc('millisecond', label_available_timestamp) AS label_available_timestamp, accident_type,
        claimed_amount_eur, n_parties_involved, telematics_anomaly, police_report_filed,
        outside_business_hours FROM enriched)""",
    f"""profiled AS (SELECT s.*, {', '.join('p.' + c.strip() for c in _PROFILE_COLUMNS.split(','))}
        FROM spine s ASOF LEFT JOIN profile p ON s.policy_id = p.policy_id
        AND s."timestamp" >= p."__START_AT")""",
    f"""training AS (SELECT p.* EXCLUDE (label_available_timestamp), {_features('r')}, r.n_30, r.ratio
        FROM profiled p JOIN rolled r USING (claim_id))""",
    """old_state AS (SELECT policy_id, gender, region_type, vehicle_year, annual_premium_eur FROM history
        WHERE "__START_AT" <= TIMESTAMP '2024-03-01'
        AND ("__END_AT" IS NULL OR "__END_AT" > TIMESTAMP '2024-03-01'))""",
    """new_state AS (SELECT policy_id, gender, region_type, vehicle_year, annual_premium_eur FROM history
        WHERE "__START_AT" <= TIMESTAMP '2024-05-01'
        AND ("__END_AT" IS NULL OR "__END_AT" > TIMESTAMP '2024-05-01') AND region_type <> 'rural')""",
    *_scd2("fx_policy_feed", ("region_type", "has_telematics"), "narrow_"),
    *_scd2("fx_policy_feed", ("region_type",), "every_", collapse=False),
    """cells AS (SELECT count(*) FILTER (is_fraud = 0 AND prediction = 0) AS tn,
        count(*) FILTER (is_fraud = 0 AND prediction = 1) AS fp,
        count(*) FILTER (is_fraud = 1 AND prediction = 0) AS fn,
        count(*) FILTER (is_fraud = 1 AND prediction = 1) AS tp FROM scored WHERE is_fraud IS NOT NULL)""",
    """class_rows AS (SELECT 'Legit' AS class_name, tn AS hit, fn AS wrong, fp AS missed FROM cells
        UNION ALL SELECT 'Fraud', tp, fp, fn FROM cells)""",
    """class_pr AS (SELECT class_name, CASE WHEN hit + wrong > 0 THEN hit / (hit + wrong) ELSE 0 END AS p,
        CASE WHEN hit + missed > 0 THEN hit / (hit + missed) ELSE 0 END AS r, hit,
        hit + missed AS support FROM class_rows)""",
    "class_f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM class_pr)",
    """by_score AS (SELECT prob_fraud AS threshold, count(*) FILTER (is_fraud = 1) AS pos,
        count(*) FILTER (is_fraud = 0) AS neg FROM scored WHERE is_fraud IS NOT NULL GROUP BY 1)""",
    """curve AS (SELECT threshold, pos, neg, CAST(sum(pos) OVER d AS BIGINT) AS tp,
        CAST(sum(neg) OVER d AS BIGINT) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
        FROM by_score WINDOW d AS (ORDER BY threshold DESC))""",
    """thresholds AS (SELECT 0.01::DOUBLE + i * 0.01::DOUBLE AS threshold FROM range(0, 99) r(i))""",
    """swept AS (SELECT t.threshold, count(*) FILTER (is_fraud = 1 AND prob_fraud >= t.threshold) AS tp,
        count(*) FILTER (is_fraud = 0 AND prob_fraud >= t.threshold) AS fp,
        count(*) FILTER (is_fraud = 1 AND prob_fraud < t.threshold) AS fn
        FROM scored, thresholds t WHERE is_fraud IS NOT NULL GROUP BY 1)""",
    """swept_pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r FROM swept)""",
    "swept_f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM swept_pr)",
    """scored_16 AS (SELECT claim_id, policy_id, "timestamp", CAST(CASE WHEN label_available_timestamp
        < TIMESTAMP '2024-01-16' THEN is_fraud END AS BIGINT) AS is_fraud, prob_fraud FROM scored
        WHERE "timestamp" < TIMESTAMP '2024-01-16')""",
    """scored_all AS (SELECT claim_id, policy_id, "timestamp", CAST(CASE WHEN label_available_timestamp
        < TIMESTAMP '2024-01-16' THEN is_fraud END AS BIGINT) AS is_fraud, prob_fraud FROM scored)""",
    """mark AS (SELECT max("timestamp") AS hwm FROM fx_claims WHERE "timestamp" < TIMESTAMP '2024-01-10')""",
    """sliced AS (SELECT c.* FROM fx_claims c, mark WHERE c."timestamp" > hwm
        AND c."timestamp" <= hwm + INTERVAL 48 HOUR)""",
]


def _with(select: str) -> str:
    return "WITH " + ",\n".join(_STEPS) + "\n" + select


def _rule_counts(source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, count(*) FILTER ({r}) AS passed, count(*) FILTER (NOT ({r})) AS failed,
        count(*) FILTER (({r}) IS NULL) AS undecided FROM {source}"""
        for name, r in rules.items()
    )


def _violations(source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT claim_id, '{name}' AS rule, CASE WHEN ({r}) IS NULL THEN 'undecided' ELSE 'failed' END
        AS outcome FROM {source} WHERE ({r}) IS NOT TRUE"""
        for name, r in rules.items()
    )


_FEATURE_NAMES = (
    "count_claims_24h, sum_amount_24h, count_claims_7d, sum_amount_7d, avg_amount_7d, "
    "count_claims_30d, sum_amount_30d, avg_amount_30d, max_amount_30d, num_fraud_confirmed_30d, "
    "claims_7d_vs_avg_30d_ratio"
)
_SPINE = (
    'claim_id, policy_id, "timestamp", is_fraud, accident_type, claimed_amount_eur, '
    "n_parties_involved, telematics_anomaly, police_report_filed, outside_business_hours"
)
_TRAINING = f"SELECT {_SPINE}, {_PROFILE_COLUMNS}, {_FEATURE_NAMES} FROM training"
_DAILY = """SELECT policy_id, CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS window_start, count(*) AS count_claims,
    round(coalesce(sum(claimed_amount_eur), 0), 6) AS sum_amount,
    round(avg(claimed_amount_eur), 8) AS avg_amount, max(claimed_amount_eur) AS max_amount
    FROM fx_claims GROUP BY 1, 2"""
_QUALITY_RATES = """round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 8) AS "precision",
    round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 8) AS recall,
    round(CASE WHEN tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn))
    ELSE 0 END, 8) AS f1,
    round(CASE WHEN n_labelled > 0 THEN (tp + tn) / n_labelled ELSE 0 END, 8) AS accuracy"""
_COUNTS = """count(*) AS n, count(*) FILTER (prediction = 1) AS n_flagged, count(is_fraud) AS n_labelled,
    count(*) FILTER (is_fraud = 1 AND prediction = 1) AS tp,
    count(*) FILTER (is_fraud = 0 AND prediction = 1) AS fp,
    count(*) FILTER (is_fraud = 1 AND prediction = 0) AS fn,
    count(*) FILTER (is_fraud = 0 AND prediction = 0) AS tn"""


def _fairness(rows: str, reference: str) -> str:
    return f""", g AS (SELECT grp, {_COUNTS} FROM {rows} GROUP BY 1),
    rates AS (SELECT *, tp / nullif(tp + fn, 0) AS tpr, tp / nullif(tp + fp, 0) AS prec,
        n_flagged / n AS pos FROM g),
    ref AS (SELECT sum(tp) / nullif(sum(tp + fn), 0) AS tpr, sum(tp) / nullif(sum(tp + fp), 0) AS prec,
        sum(n_flagged) / sum(n) AS pos FROM g WHERE {reference})
    SELECT grp AS "group", n, n_labelled, round(r.tpr, 8) AS tpr, round(r.prec, 8) AS "precision",
    round(r.pos, 8) AS positive_rate, round(r.tpr - ref.tpr, 8) AS equal_opportunity_diff,
    round(r.prec - ref.prec, 8) AS predictive_parity_diff,
    round(r.pos - ref.pos, 8) AS statistical_parity_diff FROM rates r, ref"""


def _numeric_drift(column: str) -> str:
    edge = " + ".join(
        f"CASE WHEN x > lo + (hi - lo) * ({i} / 10.0)::DOUBLE THEN 1 ELSE 0 END" for i in range(1, 10)
    )
    return f"""(WITH b AS (SELECT CAST({column} AS DOUBLE) AS x FROM fx_claims WHERE "timestamp" < TIMESTAMP '2024-01-16'),
    c AS (SELECT CAST({column} AS DOUBLE) AS x FROM fx_claims WHERE "timestamp" >= TIMESTAMP '2024-01-16'),
    e AS (SELECT min(x) AS lo, max(x) AS hi FROM b),
    bb AS (SELECT {edge} AS bin, count(*) AS n FROM b, e WHERE x IS NOT NULL GROUP BY 1),
    cb AS (SELECT {edge} AS bin, count(*) AS n FROM c, e WHERE x IS NOT NULL GROUP BY 1),
    t AS (SELECT greatest(coalesce(bb.n, 0) / (SELECT count(x) FROM b), 1e-6) AS then,
        greatest(coalesce(cb.n, 0) / (SELECT count(x) FROM c), 1e-6) AS now
        FROM bb FULL JOIN cb ON bb.bin = cb.bin)
    SELECT '{column}' AS "column", (SELECT count(*) FROM b) AS baseline_rows,
    (SELECT count(*) FROM c) AS current_rows,
    round((SELECT 1 - count(x) / count(*) FROM b), 8) AS baseline_null_rate,
    round((SELECT 1 - count(x) / count(*) FROM c), 8) AS current_null_rate,
    round((SELECT avg(x) FROM b), 8) AS baseline_mean, round((SELECT avg(x) FROM c), 8) AS current_mean,
    round((SELECT stddev_samp(x) FROM b), 8) AS baseline_std,
    round((SELECT stddev_samp(x) FROM c), 8) AS current_std,
    round((SELECT sum((now - "then") * ln(now / "then")) FROM t), 8) AS psi)""".replace(" AS then,", ' AS "then",')


def _quantile_drift(column: str) -> str:
    """As above, with edges at the ceil(share * n)-th smallest value."""
    edge = " + ".join(f"CASE WHEN x > q[{i}] THEN 1 ELSE 0 END" for i in range(1, 10))
    ranks = ", ".join(f"max(CASE WHEN k = ceil({i} / 10.0 * n) THEN x END)" for i in range(1, 10))
    plain = _numeric_drift(column)
    edges = "e AS (SELECT min(x) AS lo, max(x) AS hi FROM b)"
    assert edges in plain
    by_rank = f"""o AS (SELECT x, row_number() OVER (ORDER BY x) AS k, count(*) OVER () AS n FROM b WHERE x IS NOT NULL),
    e AS (SELECT [{ranks}] AS q FROM o)"""
    width = " + ".join(f"CASE WHEN x > lo + (hi - lo) * ({i} / 10.0)::DOUBLE THEN 1 ELSE 0 END" for i in range(1, 10))
    return plain.replace(edges, by_rank).replace(width, edge)


def _categorical_drift(column: str) -> str:
    return f"""(WITH v AS (SELECT {column} AS value, count(*) FILTER ("timestamp" < TIMESTAMP '2024-01-16') AS b,
    count(*) FILTER ("timestamp" >= TIMESTAMP '2024-01-16') AS c FROM fx_claims GROUP BY 1),
    t AS (SELECT sum(b) AS b, sum(c) AS c FROM v)
    SELECT '{column}' AS "column",
    round(coalesce(sum(v.b) FILTER (value IS NULL), 0) / any_value(t.b), 8) AS baseline_null_rate,
    round(coalesce(sum(v.c) FILTER (value IS NULL), 0) / any_value(t.c), 8) AS current_null_rate,
    round(sum(abs(v.c / t.c - v.b / t.b)) / 2, 8) AS total_variation FROM v, t)"""


def _split(ts: str, days: list[tuple[str, str, str]]) -> str:
    whens = " ".join(
        f"WHEN {ts} >= TIMESTAMP '{a}'" + (f" AND {ts} < TIMESTAMP '{b}'" if b else "") + f" THEN '{name}'"
        for name, a, b in days
    )
    return f"CASE {whens} END AS split"


_IMPUTED = (
    "claimed_amount_eur", "n_parties_involved", "driver_experience_years", "claims_7d_vs_avg_30d_ratio",
    "avg_amount_7d", "avg_amount_30d", "max_amount_30d",
)
_ZERO_FILLED = (
    "count_claims_24h", "sum_amount_24h", "count_claims_7d", "sum_amount_7d", "count_claims_30d", "sum_amount_30d",
    "num_fraud_confirmed_30d",
)
_FLAGS = ("telematics_anomaly", "police_report_filed", "outside_business_hours", "is_new_policy_risk")
_CATEGORICAL = (
    "accident_type", "age_group", "vehicle_segment", "risk_level_by_premium", "gender", "region_type",
    "coverage_type", "vehicle_type",
)


def _prepared(select: str) -> str:
    """Steps from the training set to long prepared features."""

    def middle(c: str) -> str:
        return f"""(SELECT x FROM (SELECT {c} AS x, row_number() OVER (ORDER BY {c}) AS k, count(*) OVER () AS n
            FROM learned WHERE {c} IS NOT NULL) WHERE k = ceil(n / 2.0)) AS {c}"""

    numbers = {
        **{f"{c}_filled": f"coalesce(t.{c}, f.{c})" for c in _IMPUTED},
        **{c: f"t.{c}" for c in _ZERO_FILLED},
        **{f"{c}_dbl": f"coalesce(t.{c}, 0)" for c in _FLAGS},
        "is_frequent_claimant": "CASE WHEN t.count_claims_30d > 1 THEN 1 ELSE 0 END",
        "is_immediate_fraud_risk": "CASE WHEN t.is_new_policy_risk = 1 AND t.count_claims_30d > 0 THEN 1 ELSE 0 END",
        "log_premium": "coalesce(ln(t.claimed_amount_eur + 1), 0)",
        "is_activity_spike": "CASE WHEN t.claims_7d_vs_avg_30d_ratio > 1.2 THEN 1 ELSE 0 END",
    }
    dense = " UNION ALL ".join(f"SELECT t.claim_id, t.part, '{name}' AS feature, CAST({x} AS DOUBLE) AS x FROM parts t, fills f" for name, x in numbers.items())
    coded = " UNION ALL ".join(f"SELECT claim_id, part, '{c}' AS col, {c} AS value FROM parts" for c in _CATEGORICAL)
    return _with("").rstrip() + f""",
parts AS (SELECT *, CASE WHEN "timestamp" < TIMESTAMP '2024-01-21' THEN 'train' WHEN "timestamp" < TIMESTAMP '2024-01-26' THEN 'val' ELSE 'test' END AS part
    FROM ({_TRAINING}) WHERE is_fraud IS NOT NULL AND "timestamp" >= TIMESTAMP '2024-01-01'),
learned AS (SELECT * FROM parts WHERE part = 'train'),
fills AS (SELECT {", ".join(map(middle, _IMPUTED))}),
numbers AS ({dense}),
coded AS ({coded}),
categories AS (SELECT col, value, count(*) AS n, row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, value) - 1 AS place
    FROM coded WHERE part = 'train' AND value IS NOT NULL GROUP BY 1, 2),
ones AS (SELECT claim_id, part, c.col || '_is_' || coalesce(k.value, '__unknown') AS feature, 1.0::DOUBLE AS x
    FROM coded c LEFT JOIN categories k ON k.col = c.col AND k.value = c.value),
shares AS (SELECT feature, count(*) / (SELECT count(*) FROM learned) AS p FROM ones WHERE part = 'train' GROUP BY 1),
varied AS (SELECT feature, var_samp(x) AS variance FROM numbers WHERE part = 'train' GROUP BY 1
    UNION ALL SELECT feature, p * (1 - p) * (SELECT count(*) / (count(*) - 1) FROM learned) FROM shares),
kept AS (SELECT feature, sqrt(variance) AS deviation FROM varied WHERE variance > 0.01)
{select}"""


_RUN_WEIGHTS = ((0.01, 0, 0), (0, 0.5, 0.25), (0.02, -0.30001, 0), (-0.01, 0, 0.50001), (0.005, 0.10001, -0.20003), (0.01, 0, 0))


def _board(select: str) -> str:
    """Steps from the labelled claims to the board of six runs."""
    runs = " UNION ALL ".join(
        f"""SELECT 'run_{k}' AS run_tag, CASE WHEN "timestamp" < TIMESTAMP '2024-01-16' THEN 'train' ELSE 'val' END AS side, is_fraud AS y,
        1 / (1 + exp(-(((-1.5::DOUBLE + claimed_amount_eur * {a}::DOUBLE) + n_parties_involved * {b}::DOUBLE) + police_report_filed * {c}::DOUBLE))) AS p
        FROM enriched WHERE is_fraud IS NOT NULL"""
        for k, (a, b, c) in enumerate(_RUN_WEIGHTS)
    )
    rates = ", ".join(
        f"CASE WHEN {n} + {w} > 0 THEN {n} / ({n} + {w}) ELSE 0 END AS p{k}, CASE WHEN {n} + {m} > 0 THEN {n} / ({n} + {m}) ELSE 0 END AS r{k}, {n} + {m} AS s{k}"
        for k, n, w, m in ((0, "tn", "fn", "fp"), (1, "tp", "fp", "fn"))
    )
    f1 = ", ".join(f"CASE WHEN p{k} + r{k} > 0 THEN 2 * p{k} * r{k} / (p{k} + r{k}) ELSE 0 END AS f{k}" for k in (0, 1))
    names = ("auc_roc", "auc_pr", "f1", "precision", "recall", "accuracy")
    wide = ", ".join(f"""max("{m}") FILTER (side = '{s}') AS {s}_{m}""" for s in ("train", "val") for m in names)
    return _with("").rstrip() + f""",
run_rows AS ({runs}),
run_scores AS (SELECT run_tag, side, p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM run_rows GROUP BY 1, 2, 3),
run_curve AS (SELECT *, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp FROM run_scores WINDOW d AS (PARTITION BY run_tag, side ORDER BY p DESC)),
run_areas AS (SELECT run_tag, side, sum(neg * (2 * tp - pos) / 2.0) / sum(pos) / sum(neg) AS auc_roc,
    sum(pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos) / (tp - pos + fp - neg) ELSE tp / (tp + fp) END) / 2.0) / sum(pos) AS auc_pr
    FROM run_curve GROUP BY 1, 2),
run_cells AS (SELECT run_tag, side, count(*) FILTER (y = 0 AND p <= 0.5) AS tn, count(*) FILTER (y = 0 AND p > 0.5) AS fp,
    count(*) FILTER (y = 1 AND p <= 0.5) AS fn, count(*) FILTER (y = 1 AND p > 0.5) AS tp FROM run_rows GROUP BY 1, 2),
run_rates AS (SELECT run_tag, side, {rates}, (tn + tp) / (tn + tp + fn + fp) AS accuracy FROM run_cells),
run_f AS (SELECT *, {f1} FROM run_rates),
run_metrics AS (SELECT run_tag, side, auc_roc, auc_pr, (f0 * s0 + f1 * s1) / (s0 + s1) AS f1, (p0 * s0 + p1 * s1) / (s0 + s1) AS "precision",
    (r0 * s0 + r1 * s1) / (s0 + s1) AS recall, accuracy FROM run_f JOIN run_areas USING (run_tag, side)),
run_wide AS (SELECT run_tag, {wide} FROM run_metrics GROUP BY 1),
board AS (SELECT *, train_auc_pr - val_auc_pr AS gap_auc_pr, train_auc_roc - val_auc_roc AS gap_auc_roc,
    row_number() OVER (ORDER BY round(val_auc_pr, 12) DESC, run_tag) AS position FROM run_wide)
{select}"""


_BOARD_VALUES = [f"{s}_{m}" for s in ("train", "val") for m in ("auc_roc", "auc_pr", "f1", "precision", "recall", "accuracy")] + ["gap_auc_pr", "gap_auc_roc"]

ORACLE: dict[str, str] = {
    "rolling_skewed": _with("").rstrip()
    + """,
skewed AS (SELECT * REPLACE (CASE WHEN claim_id % 3 = 0 THEN -1 ELSE policy_id END AS policy_id) FROM enriched),
"""
    + _rolling("skewed", "rolled_skewed")
    + """
SELECT claim_id, policy_id, "timestamp", n_24 AS count_claims_24h, round(sum_24, 6) AS sum_amount_24h, n_7 AS count_claims_7d,
    round(sum_7, 6) AS sum_amount_7d, n_30 AS count_claims_30d, round(sum_30, 6) AS sum_amount_30d, max_30 AS max_amount_30d,
    fraud_30 AS num_fraud_confirmed_30d FROM rolled_skewed""",
    "model_leaderboard": _board(f"SELECT run_tag, {', '.join(f'round({c}, 8) AS {c}' for c in _BOARD_VALUES)}, position FROM board"),
    "leaderboard_filters": _board("SELECT run_tag, gap_auc_pr > 0.002 AS overfits FROM board WHERE val_auc_pr > 0.04"),
    "leaderboard_decisions": _board(
        """SELECT 0 AS "case", a.run_tag AS champion, b.run_tag AS challenger, round(b.val_auc_pr, 12) > round(a.val_auc_pr, 12) AS promoted
        FROM board a, board b WHERE a.position = 1 AND b.position = 2
        UNION ALL SELECT 1, 'run_3', b.run_tag, b.val_auc_pr > (SELECT val_auc_pr FROM board WHERE run_tag = 'run_3')
        FROM board b WHERE b.position = (SELECT min(position) FROM board WHERE run_tag <> 'run_3')
        UNION ALL SELECT 2, NULL, run_tag, true FROM board WHERE position = 1"""
    ),
    "stream_label_outcomes": _with(
        """, firsts AS (SELECT c.claim_id, CAST(c."timestamp" AS DATE) AS day, l.label_available_timestamp >= c."timestamp"
            AND l.label_available_timestamp <= c."timestamp" + INTERVAL 31 DAY AS in_time, l.claim_id IS NOT NULL AS labelled
            FROM clean_claims c LEFT JOIN clean_labels l USING (claim_id) WHERE c."timestamp" < TIMESTAMP '2024-01-16')
        SELECT day, count(*) FILTER (claim_id % 2 = 0 AND in_time) AS matched, 0 AS waiting,
        count(*) FILTER (labelled AND NOT (claim_id % 2 = 0 AND in_time)) AS too_late FROM firsts GROUP BY 1
        HAVING count(*) FILTER (labelled) > 0
        UNION ALL SELECT CAST("timestamp" + INTERVAL 366 DAY AS DATE), 0, count(*), 0 FROM clean_claims WHERE "timestamp" >= TIMESTAMP '2024-01-16' GROUP BY 1"""
    ).replace("\n, firsts", ", firsts", 1),
    "publish_feed": _with("SELECT * FROM new_state"),
    # end to end
    "pipeline_policy_history": _with("SELECT * FROM history"),
    "pipeline_spine": _with("SELECT * FROM spine"),
    "pipeline_training_set": _with(f"SELECT * FROM ({_TRAINING}) WHERE is_fraud IS NOT NULL"),
    "pipeline_inference_spine": _with("SELECT * FROM fx_claims"),
    # preparation and model
    "prepared_features": _prepared(
        """SELECT claim_id, feature, round(x / deviation, 6) AS value FROM (SELECT * FROM numbers UNION ALL SELECT * FROM ones) JOIN kept USING (feature)
        WHERE part = 'test'"""
    ),
    "fitted_categories": _prepared('SELECT col AS "column", value, n, place FROM categories'),
    "model_optimality": _prepared("SELECT feature, true AS is_optimal FROM kept UNION ALL SELECT '(intercept)', true"),
    "model_score_checks": _prepared(
        """SELECT claim_id, policy_id, "timestamp", true AS label_is_open, true AS prediction_follows, true AS is_probability, 1 AS model_version
        FROM parts WHERE part = 'test'"""
    ),
    # sources and sinks
    "csv_policies": _with("SELECT *, true AS audited FROM fx_policy_feed"),
    "json_claims_stream": _with("SELECT * FROM fx_claims"),
    "json_by_month": """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
        count(*) AS n_orders, round(sum(o_totalprice), 4) AS total_price FROM orders GROUP BY 1, 2""",
    "event_time_parse": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS event_time
        FROM orders""",
    "high_water_mark": "SELECT max(ts) AS hwm FROM events",
    "next_slice": _with('SELECT claim_id, policy_id, "timestamp" FROM sliced'),
    "first_slice": _with(
        """SELECT claim_id, policy_id, "timestamp" FROM fx_claims
        WHERE "timestamp" <= (SELECT min("timestamp") FROM fx_claims) + INTERVAL 72 HOUR"""
    ),
    "labels_for_slice": _with(
        """SELECT l.* FROM fx_labels l, (SELECT min("timestamp") AS a, max("timestamp") AS z FROM sliced)
        WHERE l.label_available_timestamp BETWEEN a AND z AND l.claim_id NOT IN
        (SELECT claim_id FROM fx_claims WHERE "timestamp" < TIMESTAMP '2024-01-10')"""
    ),
    "snapshot_diff": _with(
        """SELECT n.*, 'insert' AS op FROM new_state n ANTI JOIN old_state o USING (policy_id)
        UNION ALL SELECT o.*, 'delete' FROM old_state o ANTI JOIN new_state n USING (policy_id)
        UNION ALL SELECT n.*, 'update' FROM new_state n JOIN old_state o USING (policy_id)
        WHERE n.gender IS DISTINCT FROM o.gender OR n.region_type IS DISTINCT FROM o.region_type
        OR n.vehicle_year IS DISTINCT FROM o.vehicle_year
        OR n.annual_premium_eur IS DISTINCT FROM o.annual_premium_eur"""
    ),
    "publish_changes": _with("SELECT * FROM new_state"),
    "snapshot_time_travel": _with(
        'SELECT claim_id, policy_id, "timestamp", is_fraud FROM spine WHERE is_fraud IS NOT NULL'
    ),
    "snapshot_history": _with(
        """SELECT CAST(0 AS BIGINT) AS snapshot_id, count(is_fraud) AS num_rows, 11 AS num_columns,
        'labelled' AS note, CAST(CAST(max("timestamp") FILTER (is_fraud IS NOT NULL) AS DATE) AS VARCHAR)
        AS max_event_date, CAST(NULL AS VARCHAR) AS previous_max_date FROM spine
        UNION ALL SELECT 1, count(*), 11, 'everything', CAST(CAST(max("timestamp") AS DATE) AS VARCHAR),
        CAST(CAST(max("timestamp") FILTER (is_fraud IS NOT NULL) AS DATE) AS VARCHAR) FROM spine"""
    ),
    # data quality
    "dq_rule_counts_policies": _with(_rule_counts("fx_policy_feed", _POLICY_RULES)),
    "dq_rule_counts_claims": _with(_rule_counts("fx_claims", _CLAIM_RULES)),
    "dq_rule_counts_labels": _with(_rule_counts("fx_labels", _LABEL_RULES)),
    "dq_quarantine": _with(f"SELECT * FROM fx_claims WHERE ({_all(_CLAIM_RULES)}) IS NOT TRUE"),
    "dq_clean": _with("SELECT * FROM clean_claims"),
    "dq_quarantine_three_valued": _with(
        f"SELECT claim_id, NOT ({_all(_CLAIM_RULES)}) AS is_quarantined FROM fx_claims"
    ),
    "dq_policies_quarantine": _with(f"SELECT * FROM fx_policy_feed WHERE ({_all(_POLICY_RULES)}) IS NOT TRUE"),
    "dq_violations": _with(_violations("fx_claims", _CLAIM_RULES)),
    # spines and row features
    "training_spine_rows": _with("SELECT * FROM spine"),
    "labelled_spine_rows": _with("SELECT * FROM spine WHERE is_fraud IS NOT NULL"),
    "inference_spine_rows": _with("SELECT * FROM fx_claims"),
    "production_rows": _with(
        """SELECT claim_id, "timestamp" FROM fx_claims WHERE "timestamp" >= TIMESTAMP '2024-01-21'"""
    ),
    "profile_bands": _with("SELECT * FROM profile"),
    "profile_bands_fixed_day": _with(
        f"""SELECT feed_id, {_BANDS}, CASE WHEN date_diff('day', policy_start_date, DATE '2024-06-01') < 90
        THEN 1 ELSE 0 END AS is_new_policy_risk FROM fx_policy_feed"""
    ),
    "row_feature_columns": _with(
        """SELECT claim_id, CASE WHEN n_30 > 1 THEN 1 ELSE 0 END AS is_frequent_claimant,
        CASE WHEN is_new_policy_risk = 1 AND n_30 > 0 THEN 1 ELSE 0 END AS is_immediate_fraud_risk,
        round(coalesce(ln(claimed_amount_eur + 1), 0), 8) AS log_premium,
        CASE WHEN ratio > 1.2 THEN 1 ELSE 0 END AS is_activity_spike FROM training"""
    ),
    "flag_columns": _with(
        "SELECT claim_id, "
        + ", ".join(
            f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}_dbl"
            for c in ("is_new_policy_risk", "police_report_filed", "telematics_anomaly", "outside_business_hours")
        )
        + " FROM training"
    ),
    # joins
    "late_label_join": _with("SELECT * FROM enriched"),
    "labels_or_zero": _with("SELECT claim_id, policy_id, is_fraud FROM raw_labelled"),
    "latest_label": _with(
        """SELECT claim_id, is_fraud, label_available_timestamp FROM (
        SELECT * FROM fx_labels UNION ALL SELECT claim_id, 1 - is_fraud,
        label_available_timestamp + (claim_id % 3 - 1) * INTERVAL 1 DAY FROM fx_labels)
        QUALIFY row_number() OVER (PARTITION BY claim_id
        ORDER BY label_available_timestamp DESC NULLS LAST, is_fraud DESC) = 1"""
    ),
    "asof_profile": _with(
        f"""SELECT s.claim_id, s.policy_id, s."timestamp", {_PROFILE_COLUMNS} FROM fx_claims s
        ASOF LEFT JOIN profile p ON s.policy_id = p.policy_id AND s."timestamp" >= p."__START_AT" """
    ),
    "asof_profile_valid": _with(
        """SELECT s.claim_id, s.policy_id, s."timestamp",
        CASE WHEN p."__END_AT" IS NULL OR s."timestamp" < p."__END_AT" THEN p.gender END AS gender,
        CASE WHEN p."__END_AT" IS NULL OR s."timestamp" < p."__END_AT" THEN p.vehicle_year END AS vehicle_year
        FROM fx_claims s ASOF LEFT JOIN history p
        ON s.policy_id = p.policy_id AND s."timestamp" >= p."__START_AT" """
    ),
    "asof_last_click": """SELECT b.event_id, b.user_id, b.ts, c.event_id AS click_id,
        c.value AS click_value, c.ts AS click_ts
        FROM (SELECT * FROM events WHERE event_type = 'purchase') b
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
        ON b.user_id = c.user_id AND b.ts >= c.ts""",
    "asof_behaviour": _with(
        f"""SELECT s.claim_id, s.policy_id, s."timestamp", {_features('r')} FROM clean_claims s
        ASOF LEFT JOIN rolled_raw r ON s.policy_id = r.policy_id AND s."timestamp" >= r."timestamp" """
    ),
    "training_set": _with(_TRAINING),
    "training_set_by_lookup": _with(_TRAINING),
    "inference_set": _with(
        f"""SELECT s.*, {', '.join('p.' + c.strip() for c in _PROFILE_COLUMNS.split(','))}, {_features('r')}
        FROM fx_claims s ASOF LEFT JOIN profile p ON s.policy_id = p.policy_id AND s."timestamp" >= p."__START_AT"
        JOIN rolled_raw r ON s.claim_id = r.claim_id WHERE s."timestamp" >= TIMESTAMP '2024-01-21'"""
    ),
    "pending_claims": _with(
        'SELECT claim_id, policy_id, "timestamp" FROM fx_claims ANTI JOIN scored_16 USING (claim_id)'
    ),
    "pending_labels": _with(
        """SELECT claim_id, is_fraud FROM clean_labels WHERE claim_id NOT IN
        (SELECT claim_id FROM scored_16 WHERE is_fraud IS NOT NULL)"""
    ),
    "merge_insert": _with(
        """SELECT * FROM scored_16 UNION ALL SELECT * FROM scored_all
        WHERE claim_id NOT IN (SELECT claim_id FROM scored_16)"""
    ),
    "merge_update": _with(
        """SELECT s.claim_id, s.policy_id, s."timestamp", coalesce(s.is_fraud, l.is_fraud) AS is_fraud,
        s.prob_fraud FROM scored_all s LEFT JOIN clean_labels l USING (claim_id)"""
    ),
    # checks and aggregates
    "row_counts": "SELECT count(*) AS n_rows FROM events",
    "null_profile": _with(
        " UNION ALL ".join(
            f"SELECT '{c.strip()}' AS \"column\", count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null FROM training"
            for c in f"{_SPINE}, {_PROFILE_COLUMNS}, {_FEATURE_NAMES}".split(",")
        ).replace("'\"timestamp\"'", "'timestamp'")
    ),
    "row_consistency": _with(
        "SELECT count(*) AS spine_rows, count(*) AS enriched_rows, true AS consistent FROM spine"
    ),
    "class_balance": _with(
        """SELECT is_fraud, count(*) AS n, round(count(*) / (SELECT count(*) FROM spine) * 100, 2) AS pct
        FROM spine GROUP BY 1"""
    ),
    "count_by_prediction": _with(
        """SELECT count(*) AS n_total, count(*) FILTER (prediction = 0) AS n_0,
        count(*) FILTER (prediction = 1) AS n_1,
        round(count(*) FILTER (prediction = 0) * 100 / count(*), 8) AS pct_0,
        round(count(*) FILTER (prediction = 1) * 100 / count(*), 8) AS pct_1 FROM scored"""
    ),
    "duplicate_versions": _with(
        """SELECT policy_id, policy_updated_at, count(*) AS n_rows FROM fx_policy_feed
        GROUP BY 1, 2 HAVING count(*) > 1"""
    ),
    "class_weights": _with(
        """SELECT n_total, n_fraud, n_total - n_fraud AS n_legit, round(n_total / (2 * n_fraud), 8) AS weight_fraud,
        round(n_total / (2 * (n_total - n_fraud)), 8) AS weight_legit FROM (SELECT count(*) AS n_total,
        count(*) FILTER (is_fraud = 1) AS n_fraud FROM enriched WHERE is_fraud IS NOT NULL)"""
    ),
    "training_rows_weighted": _with(
        """, r AS (SELECT claim_id, is_fraud FROM spine WHERE is_fraud IS NOT NULL
        AND "timestamp" >= TIMESTAMP '2024-01-01' AND "timestamp" < TIMESTAMP '2024-01-26')
        SELECT claim_id, is_fraud, round(count(*) OVER () / (2 * count(*) OVER (PARTITION BY is_fraud)), 8)
        AS class_weight FROM r"""
    ),
    # windows
    "rolling_training": _with(f'SELECT claim_id, policy_id, "timestamp", {_features("r")} FROM rolled r'),
    "rolling_inference": _with(f'SELECT claim_id, policy_id, "timestamp", {_features("r")} FROM rolled_raw r'),
    "fraud_confirmed_strict": _with(
        """SELECT t.claim_id, t.policy_id, t."timestamp", count(f.claim_id) AS num_fraud_confirmed_strict_30d
        FROM enriched t LEFT JOIN enriched f ON f.policy_id = t.policy_id AND f.is_fraud = 1
        AND epoch_ms(f."timestamp") BETWEEN epoch_ms(t."timestamp") - 2592000000 AND epoch_ms(t."timestamp") - 1
        AND epoch_ms(f.label_available_timestamp) < epoch_ms(t."timestamp")
        GROUP BY 1, 2, 3"""
    ),
    "scd2_history": _with("SELECT * FROM history"),
    "scd2_current": _with('SELECT * FROM history WHERE "__END_AT" IS NULL'),
    "scd2_collapsed": _with("SELECT * FROM narrow_history"),
    "scd2_uncollapsed": _with("SELECT * FROM every_history"),
    # streaming
    "stream_late_label_join": _with(
        'SELECT claim_id, policy_id, "timestamp", is_fraud, label_available_timestamp FROM enriched'
    ),
    "stream_quarantine": _with(
        f"SELECT * FROM fx_claims WHERE ({_all(_CLAIM_RULES)}) IS NOT TRUE"
    ),
    "stream_clean": _with("SELECT * FROM clean_claims"),
    "stream_spine": _with("SELECT * FROM spine"),
    "stream_scd2": _with("SELECT * FROM history"),
    "stream_tumbling": _with(_DAILY),
    "tumbling_daily": _with(_DAILY),
    # evaluation
    "confusion": _with(
        """SELECT 0 AS label, 0 AS prediction, tn AS n, round(tn * 100 / (tn + fp), 8) AS row_pct FROM cells
        UNION ALL SELECT 0, 1, fp, round(fp * 100 / (tn + fp), 8) FROM cells
        UNION ALL SELECT 1, 0, fn, round(fn * 100 / (fn + tp), 8) FROM cells
        UNION ALL SELECT 1, 1, tp, round(tp * 100 / (fn + tp), 8) FROM cells"""
    ),
    "class_report": _with(
        """SELECT class_name, round(p, 8) AS "precision", round(r, 8) AS recall, round(f, 8) AS f1, support FROM class_f
        UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM class_f
        UNION ALL SELECT 'macro avg', round(sum(p) / 2, 8), round(sum(r) / 2, 8), round(sum(f) / 2, 8),
        CAST(sum(support) AS BIGINT) FROM class_f
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 8),
        round(sum(r * support) / sum(support), 8), round(sum(f * support) / sum(support), 8),
        CAST(sum(support) AS BIGINT) FROM class_f"""
    ),
    "binary_metrics": _with(
        """, steps AS (SELECT *, tp / (tp + fp) AS prec, tp - pos AS tp0, fp - neg AS fp0 FROM curve),
        areas AS (SELECT sum(neg * (tp + tp0) * 0.5::DOUBLE / (p * n)) AS roc,
        sum(pos * (prec + CASE WHEN tp0 + fp0 > 0 THEN tp0 / (tp0 + fp0) ELSE prec END) * 0.5::DOUBLE / p) AS pr FROM steps),
        means AS (SELECT sum(p * support) / sum(support) AS p, sum(r * support) / sum(support) AS r,
        sum(f * support) / sum(support) AS f, sum(hit) / sum(support) AS a FROM class_f)
        SELECT round(roc, 8) AS auc_roc, round(pr, 8) AS auc_pr, round(f, 8) AS f1, round(p, 8) AS "precision",
        round(r, 8) AS recall, round(a, 8) AS accuracy FROM areas, means"""
    ),
    "pr_curve": _with(
        """SELECT threshold, tp, fp, round(tp / (tp + fp), 8) AS "precision", round(tp / p, 8) AS recall FROM curve
        UNION ALL SELECT NULL, 0, 0, 1, 0"""
    ),
    "roc_curve": _with(
        """SELECT threshold, tp, fp, round(fp / n, 8) AS fpr, round(tp / p, 8) AS tpr FROM curve
        UNION ALL SELECT NULL, 0, 0, 0, 0"""
    ),
    "threshold_sweep": _with(
        """SELECT round(threshold, 8) AS threshold, tp, fp, fn, round(p, 8) AS "precision", round(r, 8) AS recall,
        round(f, 8) AS f1 FROM swept_f"""
    ),
    "best_threshold": _with(
        """SELECT round(threshold, 8) AS threshold, round(f, 8) AS f1 FROM swept_f
        ORDER BY f DESC, swept_f.threshold LIMIT 1"""
    ),
    "calibration": _with(
        """SELECT CAST("""
        + " + ".join(f"CASE WHEN prob_fraud > {i} * 0.1::DOUBLE THEN 1 ELSE 0 END" for i in range(1, 10))
        + """ AS INT) AS bin, count(*) AS n, round(avg(prob_fraud), 8) AS mean_score,
        round(avg(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END), 8) AS fraction_positive
        FROM scored WHERE is_fraud IS NOT NULL GROUP BY 1"""
    ),
    # temporal split
    "temporal_split_rolling": "SELECT o_orderkey, o_orderdate, "
    + _split(
        "o_orderdate",
        [("train", "1996-12-31", "2000-01-01"), ("validation", "2000-01-01", "2001-01-01"), ("test", "2001-01-01", "")],
    )
    + " FROM orders",
    "temporal_split_fixed": "SELECT o_orderkey, ts, "
    + _split(
        "ts",
        [("train", "2019-12-31", "2023-01-01"), ("validation", "2023-01-01", "2024-01-01"), ("test", "2024-01-01", "")],
    )
    + " FROM (SELECT o_orderkey, o_orderdate + INTERVAL 24 YEAR AS ts FROM orders)",
    "temporal_split_midnight": """SELECT CASE WHEN ts >= TIMESTAMP '2024-01-01' AND ts <= TIMESTAMP '2024-01-20' THEN 'train'
        WHEN ts >= TIMESTAMP '2024-01-21' AND ts <= TIMESTAMP '2024-01-25' THEN 'validation'
        WHEN ts >= TIMESTAMP '2024-01-26' AND ts <= date_trunc('day', (SELECT max(ts) FROM events)) THEN 'test'
        END AS split, count(*) AS n_rows FROM events GROUP BY 1""",
    # monitoring
    "slice_metrics": _with(
        f""", s AS (SELECT 'all' AS slice, * FROM scored
        UNION ALL SELECT 'theft', * FROM scored WHERE accident_type = 'theft'
        UNION ALL SELECT 'no police report', * FROM scored WHERE police_report_filed = 0
        UNION ALL SELECT 'many parties', * FROM scored WHERE n_parties_involved >= 3),
        c AS (SELECT slice, {_COUNTS} FROM s GROUP BY 1)
        SELECT slice, n, n_flagged, n_labelled, tp, fp, fn, tn, {_QUALITY_RATES} FROM c"""
    ),
    "fairness": _with(
        """, gendered AS (SELECT s.*, h.gender AS grp FROM scored s ASOF LEFT JOIN history h
        ON s.policy_id = h.policy_id AND s."timestamp" >= h."__START_AT")"""
        + _fairness("gendered", "true")
    ),
    "fairness_reference": _with(
        ", typed AS (SELECT *, accident_type AS grp FROM scored)" + _fairness("typed", "grp = 'parking'")
    ),
    "metrics_over_time": _with(
        f""", c AS (SELECT CAST(date_trunc('day', inference_timestamp) AS TIMESTAMP) AS window_start, model_version, {_COUNTS}
        FROM scored GROUP BY 1, 2)
        SELECT window_start, model_version, n, n_flagged, n_labelled, tp, fp, fn, tn, {_QUALITY_RATES} FROM c"""
    ),
    "drift_numeric": _with(
        f"SELECT * FROM {_numeric_drift('claimed_amount_eur')} UNION ALL SELECT * FROM {_numeric_drift('n_parties_involved')}"
    ),
    "drift_numeric_quantile": _with(
        f"SELECT * FROM {_quantile_drift('claimed_amount_eur')} UNION ALL SELECT * FROM {_quantile_drift('n_parties_involved')}"
    ),
    "stream_rule_counts": _with(_rule_counts("fx_claims", _CLAIM_RULES)),
    "drift_categorical": _with(
        f"SELECT * FROM {_categorical_drift('accident_type')} UNION ALL SELECT * FROM {_categorical_drift('outside_business_hours')}"
    ),
}
