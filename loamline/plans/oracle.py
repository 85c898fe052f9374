"""DuckDB twins of the registered queries, for the correctness check.

Each statement reads the driver tables (views named after the tables) and
computes the same result with plain SQL windows and aggregates: one window
per station, no buckets -- the simplest formulation, against which the
bucketed Spark plans are checked.
"""

from __future__ import annotations

FEATS = ["hour_sin", "hour_cos", "soil_temp", "rain_fall",
         "prev_5", "prev_4", "prev_3", "prev_2", "prev_1"]
W = "PARTITION BY station_id ORDER BY ts, event_id"


def r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


def readings(guard: bool = False) -> str:
    temp = "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)"
    if guard:
        temp = f"CASE WHEN event_type = 'error' THEN NULL ELSE {temp} END"
    return f"""SELECT user_id AS station_id, event_id, ts, CAST(hour(ts) AS INTEGER) AS hour,
        {temp} AS soil_temp, value AS rain_fall, value / 500.0::DOUBLE AS soil_moisture
        FROM events"""


def normal(guard: bool = False) -> str:
    return f"""SELECT station_id, event_id, ts, hour,
        sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
        soil_temp, rain_fall, soil_moisture * 100 AS soil_moisture
        FROM ({readings(guard)})"""


FEATURES_CTE = f"""feat AS (
    SELECT * FROM (
        SELECT station_id, event_id, ts, hour_sin, hour_cos, soil_temp, rain_fall,
            lag(soil_moisture, 5) OVER w AS prev_5, lag(soil_moisture, 4) OVER w AS prev_4,
            lag(soil_moisture, 3) OVER w AS prev_3, lag(soil_moisture, 2) OVER w AS prev_2,
            lag(soil_moisture, 1) OVER w AS prev_1, lead(soil_moisture) OVER w AS future_moisture
        FROM ({normal()}) WINDOW w AS ({W}))
    WHERE prev_5 IS NOT NULL AND future_moisture IS NOT NULL)"""


def _missing(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}))"


def _f32(x: str) -> str:
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


def cycles_cte(name: str = "cyc", before: str | None = None) -> str:
    """The live loop replayed as windows (see ``features.compat_cycles``)."""
    where = "WHERE soil_moisture IS NOT NULL AND NOT isnan(soil_moisture)"
    if before:
        where += f" AND ts < TIMESTAMP '{before}'"
    complete = " OR ".join(_missing(c) for c in ["hour_sin", "hour_cos", "soil_temp", "rain_fall"])
    lags = ",\n            ".join(f"lag(chain, {k} IGNORE NULLS) OVER w AS prev_{k}" for k in range(1, 6))
    f32 = ", ".join([_f32("hour_sin") + " AS hour_sin", _f32("hour_cos") + " AS hour_cos",
                     _f32("round_even(soil_temp * 100, 0) / 100") + " AS soil_temp",
                     _f32("round_even(rain_fall * 100, 0) / 100") + " AS rain_fall"]
                    + [_f32(f"prev_{k}") + f" AS prev_{k}" for k in range(5, 0, -1)])
    acc = " OR ".join(_missing(c) for c in FEATS)
    return f"""{name}_a AS (
        SELECT *, NOT ({complete}) AS complete FROM ({normal(True)}) {where}),
    {name}_b AS (
        SELECT *, row_number() OVER w AS cycle_no, lag(complete) OVER w AS prev_ok,
            lead(soil_moisture) OVER w AS future_permanent
        FROM {name}_a WINDOW w AS ({W})),
    {name}_c AS (
        SELECT *, cycle_no <= 5 AS is_seed,
            CASE WHEN cycle_no <= 5 OR (cycle_no >= 7 AND coalesce(prev_ok, false))
                 THEN soil_moisture END AS chain
        FROM {name}_b),
    {name}_d AS (
        SELECT *, {lags}
        FROM {name}_c WINDOW w AS ({W})),
    {name}_e AS (
        SELECT station_id, event_id, ts, soil_moisture, is_seed, chain, future_permanent, {f32}
        FROM {name}_d),
    {name} AS (
        SELECT *, (NOT is_seed) AND NOT ({acc}) AS accepted FROM {name}_e)"""


def queue_cte(name: str = "queue", cyc: str = "cyc") -> str:
    cols = ", ".join(FEATS)
    return f"""{name} AS (
        SELECT station_id, event_id, ts, {cols},
            lead(soil_moisture) OVER (PARTITION BY station_id ORDER BY ts, event_id) AS future_moisture
        FROM {cyc} WHERE accepted)"""


COMPAT_CTE = f"""compat AS (
        SELECT station_id, event_id, ts, {", ".join(FEATS)}, future_permanent AS future_moisture
        FROM cyc WHERE accepted)"""

FIXED = "(0.0 + 0.65 * ((prev_1 - 0.0) / 1.0) + 0.25 * ((prev_4 - 0.0) / 1.0) + 0.04 * ((soil_temp - 0.0) / 1.0))"

PRED_LOG_CTE = f"""logged AS (
        SELECT station_id, event_id, ts, soil_moisture, {FIXED} AS predicted_moisture
        FROM cyc WHERE accepted),
    plog AS (
        SELECT station_id, event_id, ts, predicted_moisture, actual_moisture,
            abs(predicted_moisture - actual_moisture) AS absolute_error
        FROM (SELECT *, lead(soil_moisture) OVER (PARTITION BY station_id ORDER BY ts, event_id) AS actual_moisture
              FROM logged
              WHERE coalesce(predicted_moisture BETWEEN 0 AND 100 AND NOT isnan(predicted_moisture), false)))"""

NUTRIENTS = ["N", "P", "K", "pH", "EC", "OC", "S", "Zn", "Fe", "Cu", "Mn", "B"]
NUT_CTE = "nut AS (SELECT vec_id AS sample_id, " + ", ".join(
    f'CAST(list_extract(embedding, {i + 1}) AS DOUBLE) AS "{n}"' for i, n in enumerate(NUTRIENTS)) + \
    ', label AS "Output" FROM embeddings)'

PAIRS_CTE = "pairs AS (SELECT doc_id, quality AS actual, 1 - toxic AS predicted FROM labels)"


def _split_cte() -> str:
    return f"""{FEATURES_CTE},
    split AS (
        SELECT *, CASE WHEN row_number() OVER w <= count(*) OVER (PARTITION BY station_id)
                            - ceil(0.2::DOUBLE * count(*) OVER (PARTITION BY station_id))
                       THEN 'train' ELSE 'test' END AS split
        FROM feat WINDOW w AS ({W}))"""


def _gram_cols(prefix_scale: bool = False) -> str:
    cols = ["count(*) AS n", f"{r6('avg(future_moisture)')} AS m_y",
            f"{r6('avg(future_moisture * future_moisture)')} AS m_yy"]
    for i, a in enumerate(FEATS):
        za = f"(({a} - 0.0) / 1.0)"
        cols.append(f"{r6(f'avg({za})')} AS m_{a}")
        cols.append(f"{r6(f'avg({za} * future_moisture)')} AS m_{a}_y")
        for b in FEATS[i:]:
            zb = f"(({b} - 0.0) / 1.0)"
            cols.append(f"{r6(f'avg({za} * {zb})')} AS m_{a}_{b}")
    return ", ".join(cols)


def _sgd_cols() -> str:
    pred = "0.0" + "".join(f" + 0.0 * (({f} - 0.0) / 1.0)" for f in FEATS)
    resid = f"(({pred}) - future_moisture)"
    cols = [f"{r6(f'0.0 - 0.01 * avg({resid})')} AS intercept"]
    for f in FEATS:
        cols.append(f"{r6(f'0.0 - 0.01 * avg({resid} * (({f} - 0.0) / 1.0))')} AS w_{f}")
    return ", ".join(cols)


def _best_split_sql() -> str:
    values = " UNION ALL ".join(f'SELECT {i} AS feature, "{n}" AS value, w, w * "Output" AS w1 FROM train'
                                for i, n in enumerate(NUTRIENTS))
    gini = lambda one, all_: f"2 * {one} * ({all_} - {one}) / {all_}"
    return f"""WITH {NUT_CTE},
    split AS (SELECT *, row_number() OVER (ORDER BY md5(sample_id || ':42'), sample_id)
                  <= ceil(0.2::DOUBLE * count(*) OVER ()) AS test FROM nut WHERE "Output" IN (0, 1)),
    train AS (SELECT *, count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY "Output")) AS w FROM split WHERE NOT test),
    sums AS (SELECT feature, value, sum(w) AS w, sum(w1) AS w1 FROM ({values}) GROUP BY ALL),
    cuts AS (SELECT feature, value, lead(value) OVER v AS next, sum(w) OVER v AS l, sum(w1) OVER v AS l1,
                 sum(w) OVER (PARTITION BY feature) AS a, sum(w1) OVER (PARTITION BY feature) AS a1
             FROM sums WINDOW v AS (PARTITION BY feature ORDER BY value)),
    gains AS (SELECT *, round(({gini('a1', 'a')} - {gini('l1', 'l')} - {gini('(a1 - l1)', '(a - l)')}) / a, 12) AS gain
              FROM cuts WHERE next IS NOT NULL)
    SELECT CAST(feature AS INTEGER) AS feature, {r6('(value + next) / 2')} AS threshold, {r6('gain')} AS gain
    FROM gains ORDER BY gains.gain DESC, gains.feature, value LIMIT 1"""


# ------------------------------------------------- sequential SGD, row by row

def _sgd_rows(source: str, name: str, by: str = "") -> str:
    """``name``: the standardised rows (z, 1), y of ``source`` as a list in time
    order (per ``by``); the scaler is that of the training rows."""
    stats = ", ".join(f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) = 0 THEN 1.0 ELSE stddev_pop({f}) END AS s_{f}"
                      for f in FEATS)
    z = ", ".join(f"({f} - m_{f}) / s_{f}" for f in FEATS)
    row = f"{{'w': NULL::DOUBLE[], 'l': 0.0::DOUBLE, 'e': 0.0::DOUBLE, 'z': [{z}, 1.0::DOUBLE], 'y': future_moisture}}"
    return f"""{name}_stats AS (SELECT {stats} FROM split WHERE split = 'train'),
    {name} AS (SELECT {by + ',' if by else ''} list({row} ORDER BY ts, event_id, station_id) AS xs, count(*) AS n
        FROM ({source}), {name}_stats {'GROUP BY ' + by if by else ''})"""


def _epoch(w: str, eta: str) -> str:
    """The row lists stepped through one after another from weights ``w``."""
    resid = "(list_dot_product(a.w, x.z) - x.y)"
    start = f"{{'w': {w}, 'l': 0.0::DOUBLE, 'e': {eta}, 'z': NULL::DOUBLE[], 'y': 0.0::DOUBLE}}"
    return f"""list_reduce(xs, lambda a, x: {{'w': list_transform(a.w, lambda v, i: v - a.e * {resid} * x.z[i]),
        'l': a.l + {resid} * {resid} / 2, 'e': a.e, 'z': x.z, 'y': x.y}}, {start})"""


ZERO_WEIGHTS = "list_resize([]::DOUBLE[], 10, 0.0::DOUBLE)"
WEIGHT_ROWS = f"unnest({[*FEATS, 'intercept']}) AS feature, {r6('unnest(w)')} AS weight"


def _fit_cte(etas: list[float]) -> str:
    """``fits``: eta, n_iter and weights of the fit of every learning rate."""
    rates = ", ".join(f"({e}::DOUBLE)" for e in etas)
    return f"""WITH RECURSIVE {_split_cte()},
    {_sgd_rows("SELECT * FROM split WHERE split = 'train'", "train")},
    epochs AS (
        SELECT eta, 0::BIGINT AS n_iter, 'infinity'::DOUBLE AS best, 0 AS bad, {ZERO_WEIGHTS} AS w
        FROM (VALUES {rates}) AS e(eta)
        UNION ALL
        SELECT eta, n_iter + 1, least(best, r.l), CASE WHEN r.l > best - 1e-8 * n THEN bad + 1 ELSE 0 END, r.w
        FROM (SELECT epochs.*, n, {_epoch('w', 'eta')} AS r FROM epochs, train WHERE bad < 5 AND n_iter < 50000)),
    fits AS (SELECT * FROM epochs QUALIFY row_number() OVER (PARTITION BY eta ORDER BY n_iter DESC) = 1)"""


def _sweep_sql(etas: list[float]) -> str:
    z = " + ".join(f"w[{i + 1}] * (({f} - m_{f}) / s_{f})" for i, f in enumerate(FEATS))
    return f"""{_fit_cte(etas)}
    SELECT eta, CAST(n_iter AS INTEGER) AS n_iter,
        {r6('1.0 - sum((w[10] + ' + z + ' - future_moisture) ** 2) / (var_pop(future_moisture) * count(*))')} AS r2
    FROM split, train_stats, fits WHERE split = 'test' GROUP BY eta, n_iter"""


def _queue_epoch(by: str = "") -> str:
    return f"""WITH {_split_cte()}, {cycles_cte()}, {queue_cte()},
    {_sgd_rows("SELECT * FROM queue WHERE future_moisture IS NOT NULL", "done", by)},
    after AS (SELECT *, r.w AS w, r.l AS l FROM (SELECT *, {_epoch(ZERO_WEIGHTS, '0.01::DOUBLE')} AS r FROM done))"""


def _corr_union() -> str:
    parts = []
    for c in FEATS:
        both = f"({c} IS NOT NULL AND future_moisture IS NOT NULL AND NOT isnan({c}) AND NOT isnan(future_moisture))"
        x = f"CASE WHEN {both} THEN {c} END"
        y = f"CASE WHEN {both} THEN future_moisture END"
        corr = f"CASE WHEN stddev_pop({x}) * stddev_pop({y}) = 0 THEN NULL ELSE covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END"
        parts.append(f"SELECT '{c}' AS feature, {r6(corr)} AS correlation FROM feat")
    return " UNION ALL ".join(parts)


def _scaler_union() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r6(f'avg({c})')} AS mean, "
        f"{r6(f'CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END')} AS std FROM feat"
        for c in FEATS)


def _standardise() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}"
                      for c in FEATS)
    z = ", ".join(f"{r6(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in FEATS)
    return f"WITH {FEATURES_CTE}, st AS (SELECT {stats} FROM feat) SELECT station_id, event_id, {z} FROM feat, st"


def _null_profile() -> str:
    parts = []
    for c in ["hour", "soil_temp", "rain_fall", "soil_moisture"]:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS column_name, CAST(count_if({x} IS NULL) AS BIGINT) AS n_null,
            CAST(count_if(isnan({x})) AS BIGINT) AS n_nan, CAST(count_if(isinf({x})) AS BIGINT) AS n_inf FROM r""")
    return f"WITH r AS ({readings(True)}) " + " UNION ALL ".join(parts)


def _report() -> str:
    return f"""WITH {PAIRS_CTE},
    cm AS (SELECT actual, predicted, count(*) AS n FROM pairs GROUP BY 1, 2),
    cls AS (SELECT actual AS c FROM cm UNION SELECT predicted FROM cm),
    per AS (
        SELECT c,
            coalesce((SELECT sum(n) FROM cm WHERE actual = c), 0) AS support,
            coalesce((SELECT sum(n) FROM cm WHERE predicted = c), 0) AS predicted_n,
            coalesce((SELECT sum(n) FROM cm WHERE actual = c AND predicted = c), 0) AS tp
        FROM cls),
    per2 AS (
        SELECT *, CASE WHEN predicted_n = 0 THEN 0.0 ELSE tp / predicted_n END AS precision,
                  CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall
        FROM per),
    per3 AS (
        SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                       ELSE 2 * precision * recall / (precision + recall) END AS f1
        FROM per2)
    SELECT CAST(c AS VARCHAR) AS label, {r6('precision')} AS precision, {r6('recall')} AS recall,
           {r6('f1')} AS f1, CAST(support AS BIGINT) AS support FROM per3
    UNION ALL
    SELECT 'accuracy', NULL, NULL, {r6('sum(tp) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM per3
    UNION ALL
    SELECT 'macro avg', {r6('avg(precision)')}, {r6('avg(recall)')}, {r6('avg(f1)')},
           CAST(sum(support) AS BIGINT) FROM per3
    UNION ALL
    SELECT 'weighted avg', {r6('sum(precision * support) / sum(support)')},
           {r6('sum(recall * support) / sum(support)')}, {r6('sum(f1 * support) / sum(support)')},
           CAST(sum(support) AS BIGINT) FROM per3"""


def _model_comparison() -> str:
    preds = {
        "persistence": "prev_1",
        "mean5": "(prev_1 + prev_2 + prev_3 + prev_4 + prev_5) / 5.0",
        "fixed_linear": FIXED,
    }
    scored = " UNION ALL ".join(
        f"SELECT '{m}' AS model, {p} AS prediction, future_moisture FROM split WHERE split = 'test'"
        for m, p in preds.items())
    return f"""WITH {_split_cte()}, scored AS ({scored}),
    agg AS (SELECT model, sum(pow(prediction - future_moisture, 2)) AS ss_res,
                   var_pop(future_moisture) * count(future_moisture) AS ss_tot,
                   sqrt(avg(pow(prediction - future_moisture, 2))) AS rmse
            FROM scored GROUP BY model)
    SELECT model, {r6("CASE WHEN ss_tot = 0 THEN CASE WHEN ss_res = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 - ss_res / ss_tot END")} AS r2,
           {r6('rmse')} AS rmse FROM agg"""


def _cycle_outputs() -> str:
    feats = ", ".join(FEATS)
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in FEATS)
    none = "CAST(NULL AS DOUBLE)"
    missing = "concat_ws(',', " + ", ".join(f"CASE WHEN {_missing(c)} THEN '{c}' END" for c in FEATS) + ")"
    w = f"(PARTITION BY station_id ORDER BY ts, event_id)"
    return f"""WITH {cycles_cte()},
    s1 AS (SELECT *, CASE WHEN accepted THEN {FIXED} END AS predicted FROM cyc),
    s2 AS (SELECT *, coalesce(accepted AND predicted BETWEEN 0 AND 100 AND NOT isnan(predicted), false) AS logged
           FROM s1)
    SELECT 'permanent' AS store, station_id, event_id, {feats}, future_permanent AS label,
           {none} AS predicted, {none} AS absolute_error, CAST(NULL AS VARCHAR) AS reason
    FROM s2 WHERE accepted AND future_permanent IS NOT NULL
    UNION ALL
    SELECT 'training', station_id, event_id, {feats}, label, {none}, {none}, NULL FROM (
        SELECT *, lead(soil_moisture) OVER {w} AS label FROM s2 WHERE accepted) WHERE label IS NOT NULL
    UNION ALL
    SELECT 'prediction', station_id, event_id, {nulls}, actual, predicted, abs(predicted - actual), NULL FROM (
        SELECT *, lead(soil_moisture) OVER {w} AS actual FROM s2 WHERE logged) WHERE actual IS NOT NULL
    UNION ALL
    SELECT 'rejected', station_id, event_id, {feats}, {none}, {none}, {none}, 'incomplete: ' || {missing}
    FROM s2 WHERE NOT is_seed AND NOT accepted
    UNION ALL
    SELECT 'rejected', station_id, event_id, {feats}, {none}, predicted, {none}, 'prediction out of range'
    FROM s2 WHERE accepted AND NOT logged"""


LI_MEASURES = ["l_quantity", "l_discount", "l_tax"]
LI_TARGET = "l_extendedprice"


def _li_profile() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(count_if(CAST({c} AS DOUBLE) IS NULL) AS BIGINT) AS n_null,
            CAST(count_if(isnan(CAST({c} AS DOUBLE))) AS BIGINT) AS n_nan, CAST(count_if(isinf(CAST({c} AS DOUBLE))) AS BIGINT) AS n_inf
            FROM lineitem""" for c in LI_MEASURES + [LI_TARGET])


def _li_corr() -> str:
    parts = []
    for c in LI_MEASURES:
        both = f"({c} IS NOT NULL AND {LI_TARGET} IS NOT NULL AND NOT isnan({c}) AND NOT isnan({LI_TARGET}))"
        x, y = f"CASE WHEN {both} THEN {c} END", f"CASE WHEN {both} THEN {LI_TARGET} END"
        corr = (f"CASE WHEN stddev_pop({x}) * stddev_pop({y}) = 0 THEN NULL "
                f"ELSE covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END")
        parts.append(f"SELECT '{c}' AS feature, {r6(corr)} AS correlation FROM lineitem")
    return " UNION ALL ".join(parts)


def _li_scaler() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r6(f'avg({c})')} AS mean, "
        f"{r6(f'CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END')} AS std FROM lineitem"
        for c in LI_MEASURES + [LI_TARGET])


W_GAPS = "PARTITION BY station_id ORDER BY ts NULLS FIRST, event_id"


def _gappy_keys() -> str:
    return f"""SELECT CASE WHEN event_id % 97 <> 0 THEN station_id END AS station_id, event_id,
        CASE WHEN event_id % 89 <> 0 THEN ts END AS ts FROM ({readings()})"""


def _gappy(x: str, huge: str) -> str:
    return (f"CASE WHEN event_id % 101 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 103 = 0 THEN {huge} "
            f"WHEN event_id % 107 <> 0 THEN {x} END")


ORACLE: dict[str, str] = {
    "lineitem_profile": _li_profile(),
    "lineitem_correlation": _li_corr(),
    "lineitem_scaler_stats": _li_scaler(),
    "cycle_outputs": _cycle_outputs(),
    "moisture_features": f"WITH {FEATURES_CTE} SELECT * EXCLUDE (ts) FROM feat",
    "moisture_features_sql": f"WITH {FEATURES_CTE} SELECT * EXCLUDE (ts) FROM feat",
    "normalise_readings": """SELECT user_id AS station_id, event_id,
        sin(2 * pi() * hour(ts) / 24) AS hour_sin, cos(2 * pi() * hour(ts) / 24) AS hour_cos,
        TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS soil_temp, value AS rain_fall,
        (value / 500.0::DOUBLE) * 100 AS soil_moisture FROM events""",
    "drop_keys": f"WITH {FEATURES_CTE} SELECT * EXCLUDE (ts, station_id, event_id) FROM feat",
    "hour_encoding": f"SELECT station_id, event_id, hour, sin(2 * pi() * hour / 24) AS hour_sin, "
                     f"cos(2 * pi() * hour / 24) AS hour_cos FROM ({readings()})",
    "round_half_even": "SELECT event_id, value / 3.0::DOUBLE AS x, "
                       "round_even((value / 3.0::DOUBLE) * 100, 0) / 100 AS x_rounded FROM events",
    "float32_features": f"WITH {FEATURES_CTE} SELECT event_id, "
                        + ", ".join(f"{_f32(c)} AS {c}" for c in FEATS) + " FROM feat",
    "coerce_numeric": """SELECT event_id, raw_text, TRY_CAST(raw_text AS DOUBLE) AS number FROM (
        SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a'
                              ELSE json_extract_string(props, '$.k') END AS raw_text FROM events)""",
    "valid_labels": f"""SELECT event_id, TRY_CAST(trunc(x) AS INTEGER) AS label_int,
        coalesce(TRY_CAST(trunc(x) AS INTEGER) IN (0, 1), false) AS valid
        FROM (SELECT event_id, {_gappy("value / 100.0::DOUBLE", "1e300")} AS x FROM events)""",
    "row_ids_gaps": f"SELECT station_id, event_id, row_number() OVER ({W_GAPS}) AS row_id FROM ({_gappy_keys()})",
    "ordered_split_gaps": f"""SELECT station_id, event_id,
        CASE WHEN row_number() OVER ({W_GAPS}) <= n - ceil(0.2::DOUBLE * n) THEN 'train' ELSE 'test' END AS split
        FROM (SELECT *, count(*) OVER (PARTITION BY station_id) AS n FROM ({_gappy_keys()}))""",
    "ordered_split_30": f"""SELECT station_id, event_id,
        CASE WHEN row_number() OVER ({W}) <= floor(0.3::DOUBLE * n) THEN 'train' ELSE 'test' END AS split
        FROM (SELECT *, count(*) OVER (PARTITION BY station_id) AS n FROM ({readings()}))""",
    "regression_metrics_gaps": f"""WITH {FEATURES_CTE},
        g AS (SELECT future_moisture AS y, {_gappy("prev_1", "'Infinity'::DOUBLE")} AS p FROM feat),
        a AS (SELECT sum(pow(p - y, 2)) AS ss_res, var_pop(y) * count(y) AS ss_tot,
                     sqrt(avg(pow(p - y, 2))) AS rmse, count(*) AS n FROM g
              WHERE p IS NOT NULL AND NOT isnan(p) AND NOT isinf(p))
        SELECT {r6("1.0 - ss_res / ss_tot")} AS r2, {r6('rmse')} AS rmse, n FROM a""",
    "nutrient_correlation": f"WITH {NUT_CTE} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {r6(f'covar_pop("{c}", "Output") / (stddev_pop("{c}") * stddev_pop("Output"))')} AS correlation FROM nut"""
        for c in NUTRIENTS),
    "fertility_rejects": """SELECT vec_id AS sample_id, 'incomplete: ' || concat_ws(',',
            CASE WHEN vec_id % 50 = 0 THEN 'N' END, CASE WHEN vec_id % 75 = 0 THEN 'Fe' END) AS reason
        FROM embeddings WHERE vec_id % 50 = 0 OR vec_id % 75 = 0""",
    "null_profile_all": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(count(*) - count({e}) AS BIGINT) AS n_null,
            CAST({f'count_if(isnan({e}))' if c == 'value' else 0} AS BIGINT) AS n_nan,
            CAST({f'count_if(isinf({e}))' if c == 'value' else 0} AS BIGINT) AS n_inf FROM events"""
        for c, e in (("station_id", "CASE WHEN event_id % 97 <> 0 THEN user_id END"), ("event_id", "event_id"),
                     ("ts", "CASE WHEN event_id % 89 <> 0 THEN ts END"), ("event_type", "event_type"),
                     ("value", "value"))),
    "random_split": f"""WITH {NUT_CTE} SELECT sample_id, "Output",
        CASE WHEN row_number() OVER (ORDER BY md5(sample_id || ':42'), sample_id) <= ceil(0.2::DOUBLE * count(*) OVER ())
             THEN 'test' ELSE 'train' END AS split FROM nut WHERE "Output" IN (0, 1)""",
    "binary_labels": f'WITH {NUT_CTE} SELECT * FROM nut WHERE "Output" IN (0, 1)',
    "completed_rows": f"WITH {cycles_cte()}, {COMPAT_CTE} "
                      "SELECT * EXCLUDE (ts) FROM compat WHERE future_moisture IS NOT NULL",
    "pending_rows": f"WITH {cycles_cte()}, {queue_cte()} "
                    "SELECT * EXCLUDE (ts) FROM queue WHERE future_moisture IS NULL",
    "complete_cases": f"SELECT * EXCLUDE (ts) FROM ({readings(True)}) WHERE hour IS NOT NULL "
                      "AND soil_temp IS NOT NULL AND NOT isnan(soil_temp) AND rain_fall IS NOT NULL "
                      "AND NOT isnan(rain_fall) AND soil_moisture IS NOT NULL AND NOT isnan(soil_moisture)",
    "accepted_cycles": f"SELECT * EXCLUDE (ts) FROM ({readings(True)}) WHERE NOT ("
                       + " OR ".join(_missing(c) for c in ["CAST(hour AS DOUBLE)", "soil_temp", "rain_fall", "soil_moisture"])
                       + ")",
    "rejected_cycles": f"""SELECT * EXCLUDE (ts), 'incomplete: ' || concat_ws(',',
            CASE WHEN {_missing('CAST(hour AS DOUBLE)')} THEN 'hour' END,
            CASE WHEN {_missing('soil_temp')} THEN 'soil_temp' END,
            CASE WHEN {_missing('rain_fall')} THEN 'rain_fall' END,
            CASE WHEN {_missing('soil_moisture')} THEN 'soil_moisture' END) AS reason
        FROM ({readings(True)}) WHERE """
                       + " OR ".join(_missing(c) for c in ["CAST(hour AS DOUBLE)", "soil_temp", "rain_fall", "soil_moisture"]),
    "range_check": """SELECT event_id, value AS predicted,
        coalesce(value BETWEEN 0 AND 100 AND NOT isnan(value), false) AS valid,
        CASE WHEN value IS NULL THEN 'null' WHEN isnan(value) THEN 'nan'
             WHEN value < 0 THEN 'below' WHEN value > 100 THEN 'above' END AS reason FROM events""",
    "null_profile": _null_profile(),
    "row_ids": f"SELECT station_id, event_id, row_number() OVER ({W}) AS row_id FROM ({readings()})",
    "last_n_completed": f"""WITH {cycles_cte()}, {COMPAT_CTE}
        SELECT station_id, event_id, prev_1, future_moisture FROM (
            SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, event_id DESC) AS rk
            FROM compat WHERE future_moisture IS NOT NULL) WHERE rk <= 5""",
    "latest_pending": f"""WITH {cycles_cte()}, {queue_cte()}
        SELECT station_id, event_id, {", ".join(FEATS)} FROM (
            SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, event_id DESC) AS rk
            FROM queue WHERE future_moisture IS NULL) WHERE rk = 1""",
    "latest_reading": f"""SELECT station_id, event_id, soil_moisture FROM (
            SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, event_id DESC) AS rk
            FROM ({readings()})) WHERE rk = 1""",
    "preview_first_n": f"WITH {FEATURES_CTE} SELECT * EXCLUDE (ts) FROM feat "
                       "ORDER BY station_id, ts, event_id LIMIT 5",
    "history_union": f"""WITH {cycles_cte()}, {COMPAT_CTE},
        hist AS (SELECT station_id, event_id, soil_temp, prev_1, future_moisture FROM (
            SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, event_id DESC) AS rk
            FROM compat WHERE future_moisture IS NOT NULL) WHERE rk <= 5),
        cur AS (SELECT station_id, event_id, hour, soil_temp, soil_moisture FROM (
            SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, event_id DESC) AS rk
            FROM ({readings()})) WHERE rk = 1)
        SELECT * FROM hist UNION ALL BY NAME SELECT * FROM cur""",
    "feature_rows_compat": f"WITH {cycles_cte()}, {COMPAT_CTE} SELECT * EXCLUDE (ts) FROM compat",
    "backfill_future": f"""WITH {cycles_cte()}
        SELECT station_id, event_id, soil_moisture, future_permanent,
            lead(soil_moisture) OVER ({W}) AS future_training
        FROM cyc WHERE accepted""",
    "prediction_log": f"WITH {cycles_cte()}, {PRED_LOG_CTE} SELECT * EXCLUDE (ts) FROM plog",
    "pending_predictions": f"WITH {cycles_cte()}, {PRED_LOG_CTE} "
                           "SELECT * EXCLUDE (ts) FROM plog WHERE actual_moisture IS NULL",
    "flush_remaining": f"""WITH {cycles_cte()}, {queue_cte()},
        {cycles_cte('old', '2024-01-20 00:00:00')}, {queue_cte('old_queue', 'old')},
        mark AS (SELECT station_id, max((ts, event_id)) AS m FROM old_queue
                 WHERE future_moisture IS NOT NULL GROUP BY station_id)
        SELECT q.station_id, q.event_id, q.future_moisture
        FROM queue q LEFT JOIN mark k ON q.station_id = k.station_id
        WHERE k.m IS NULL OR (q.ts, q.event_id) > k.m""",
    "target_correlation": f"WITH {FEATURES_CTE} {_corr_union()}",
    "scaler_stats": f"WITH {FEATURES_CTE} {_scaler_union()}",
    "regression_metrics": f"""WITH {FEATURES_CTE},
        a AS (SELECT sum(pow(prev_1 - future_moisture, 2)) AS ss_res,
                     var_pop(future_moisture) * count(future_moisture) AS ss_tot,
                     sqrt(avg(pow(prev_1 - future_moisture, 2))) AS rmse, count(*) AS n FROM feat)
        SELECT {r6("CASE WHEN ss_tot = 0 THEN CASE WHEN ss_res = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 - ss_res / ss_tot END")} AS r2,
               {r6('rmse')} AS rmse, n FROM a""",
    "daily_mae": f"""WITH {cycles_cte()}, {PRED_LOG_CTE}
        SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, {r6('avg(absolute_error)')} AS mae,
               count(*) AS n
        FROM plog WHERE absolute_error IS NOT NULL GROUP BY 1""",
    "classification_report": _report(),
    "accuracy": f"WITH {PAIRS_CTE} SELECT {r6('avg(CAST(actual = predicted AS INTEGER))')} AS accuracy, "
                "count(*) AS n FROM pairs",
    "class_weights": f"""WITH {NUT_CTE}, c AS (SELECT "Output", count(*) AS n_c FROM nut
            WHERE "Output" IN (0, 1) GROUP BY 1)
        SELECT "Output", n_c, {r6('sum(n_c) OVER () / (count(*) OVER () * n_c)')} AS weight FROM c""",
    "queue_counts": f"""WITH {cycles_cte()}, {queue_cte()}
        SELECT count(*) AS total, CAST(count_if(future_moisture IS NOT NULL) AS BIGINT) AS completed,
               CAST(count_if(future_moisture IS NULL) AS BIGINT) AS pending FROM queue""",
    "distinct_labels": f'WITH {NUT_CTE} SELECT "Output" AS value, count(*) AS n FROM nut GROUP BY 1',
    "fertility_correct": f"""WITH {NUT_CTE},
        preds AS (SELECT sample_id, CASE WHEN "N" >= 0 THEN 1 ELSE 0 END AS predicted_fertility FROM nut),
        truth AS (SELECT sample_id, "Output" AS actual_fertility FROM nut WHERE "Output" IN (0, 1))
        SELECT p.sample_id, predicted_fertility, actual_fertility,
               CAST(predicted_fertility = actual_fertility AS INTEGER) AS correct
        FROM preds p LEFT JOIN truth t ON p.sample_id = t.sample_id""",
    "ordered_split": f"WITH {_split_cte()} SELECT station_id, event_id, split FROM split",
    "standardise": _standardise(),
    "gram_moments": f"WITH {FEATURES_CTE} SELECT {_gram_cols()} FROM feat",
    "online_epoch": f"{_queue_epoch()} SELECT {WEIGHT_ROWS} FROM after",
    "station_epochs": _queue_epoch("station_id") + " SELECT station_id, n, " + ", ".join(
        [f"{r6('l / n')} AS loss", f"{r6('w[10]')} AS intercept"]
        + [f"{r6(f'w[{i + 1}]')} AS w_{f}" for i, f in enumerate(FEATS)]) + " FROM after",
    "sgd_fit": f"{_fit_cte([0.01])} SELECT {WEIGHT_ROWS}, n_iter FROM fits",
    "learning_rate_sweep": _sweep_sql([0.1, 0.05, 0.01, 0.005, 0.001, 0.0005]),
    "best_split": _best_split_sql(),
    "sgd_step": f"WITH {FEATURES_CTE} SELECT {_sgd_cols()} FROM feat",
    "score_linear": f"WITH {FEATURES_CTE} SELECT station_id, event_id, {r6(FIXED)} AS prediction FROM feat",
    "model_comparison": _model_comparison(),
}
