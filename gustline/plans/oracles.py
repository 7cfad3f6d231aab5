"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from collections.abc import Mapping

from gustline.functions.split import KEY_RANGE, MODULUS, MULTIPLIER
from gustline.operators.features import SEED, TRAIN_SHARE
from gustline.operators.models import TREE_BINS, TREE_DEPTH
from gustline.plans.catalog import (
    CURVE_CELLS,
    CURVE_POINTS,
    GRID_OFFSET,
    HISTOGRAM_BINS,
    JOINT_BINS,
    SCORED_DAY,
)

# Instrument values of an event, as text-borne numbers of the given type.
_VALUES = {
    "power": "value * 12",
    "speed": "user_id % 25",
    "curve": "CAST(json_extract_string(props, '$.k') AS BIGINT) * 36",
    "direction": "event_id % 360",
}
_MAP_AVERAGES = {
    "power": "avg_ActivePower_kW",
    "speed": "avg_WindSpeed_m_s",
    "curve": "avg_PowerCurve_kWh",
    "direction": "avg_WindDirection_deg",
}
_TYPED_AVERAGES = {
    "power": "avg_active_power",
    "speed": "avg_wind_speed",
    "curve": "avg_theo_power",
    "direction": "avg_wind_direction",
}
_MAPPED = {
    "power": "active_power_average",
    "speed": "wind_speed_average",
    "curve": "theo_power_curve_average",
    "direction": "wind_direction_average",
}


def _cut(value: str, digits: int) -> str:
    """The same grid of decimals as the queries use."""
    scale = 10.0**digits
    return f"floor(({value}) * {scale} + {GRID_OFFSET}) / {scale}"


def _cuts(names: Mapping[str, str], digits: int, form: str = "{}") -> str:
    """Select list: each key, put into ``form``, under its value as name."""
    return ", ".join(f"{_cut(form.format(old), digits)} AS {new}" for old, new in names.items())


def _own(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def _band(power: str) -> str:
    return (
        f"CASE WHEN {power} < 200 THEN 'Low' WHEN {power} < 600 THEN 'Medium' "
        f"WHEN {power} < 1000 THEN 'High' ELSE 'Exceptional' END"
    )


def _rank(key: str) -> str:
    return f"((({key} + {SEED}) % {KEY_RANGE}) * {MULTIPLIER} % {MODULUS})"


def _position(key: str) -> str:
    return f"{_rank(key)} / {float(MODULUS)}"


_SIDE = f"CASE WHEN place <= ceil(round(n * {1 - TRAIN_SHARE}, 6)) THEN 'test' ELSE 'train' END"


_FEATURES = ("speed", "curve", "direction", "status_index")

_READINGS = "readings AS (SELECT event_id, event_type, ts AS signal_ts, CAST(ts AS DATE) AS signal_date, " + ", ".join(
    f"CAST(CAST({value} AS VARCHAR) AS FLOAT) AS {name}, CAST({value} AS DOUBLE) AS {name}_d"
    for name, value in _VALUES.items()
) + " FROM events)"

# one value per day and hour, unrounded
_HOURLY = (
    "hourly AS (SELECT signal_date, CAST(hour(signal_ts) AS INTEGER) AS hour, "
    + ", ".join(f"avg({name}) AS {name}" for name in _VALUES)
    + " FROM readings GROUP BY 1, 2)"
)
_STATUS = f"status AS (SELECT *, {_band('power')} AS generation_status FROM hourly)"

_HOUR_KEY = "date_diff('day', DATE '1970-01-01', signal_date) * 24 + hour"
_INDEXED = (
    "labels_by_size AS (SELECT generation_status, count(*) AS n FROM status GROUP BY 1), "
    "indexes AS (SELECT generation_status, "
    "CAST(row_number() OVER (ORDER BY n DESC, generation_status) - 1 AS DOUBLE) AS status_index FROM labels_by_size), "
    "indexed AS (SELECT s.*, i.status_index, "
    f"{_position(_HOUR_KEY)} < {TRAIN_SHARE} AS is_train "
    "FROM status s JOIN indexes i USING (generation_status))"
)


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def _linear() -> str:
    """Least squares over the four features by orthogonalisation: centre on the training means, then
    take the part along each feature out of the later features and of the label. What is left of the
    label is the residual, on training and test rows alike."""
    steps = [
        "means AS (SELECT avg(power) AS my, "
        + ", ".join(f"avg({name}) AS m{i}" for i, name in enumerate(_FEATURES))
        + " FROM indexed WHERE is_train)",
        "step0 AS (SELECT signal_date, hour, is_train, power, power - my AS y, "
        + ", ".join(f"{name} - m{i} AS x{i}" for i, name in enumerate(_FEATURES))
        + " FROM indexed, means)",
    ]
    last = len(_FEATURES)
    for i in range(last):
        later = [f"x{j}" for j in range(i + 1, last)] + ["y"]
        shares = ", ".join(f"sum(x{i} * {name}) / sum(x{i} * x{i}) AS c_{name}" for name in later)
        taken = ", ".join(f"{name} - c_{name} * x{i} AS {name}" for name in later)
        steps.append(f"coef{i} AS (SELECT {shares} FROM step{i} WHERE is_train)")
        steps.append(f"step{i + 1} AS (SELECT signal_date, hour, is_train, power, {taken} FROM step{i}, coef{i})")
    steps.append(
        "scored_all AS (SELECT signal_date, hour, is_train, power AS actual, power - y AS prediction, "
        f"y AS residual FROM step{last})"
    )
    steps.append("scored AS (SELECT * FROM scored_all WHERE NOT is_train)")
    return ", ".join(steps)


_MODEL = _with(_READINGS, _HOURLY, _STATUS, _INDEXED, _linear())
_FRAME = _with(_READINGS, _HOURLY, _STATUS, _INDEXED)

_HOUR_MEANS = (
    "hour_means AS (SELECT hour, avg(power) AS prediction FROM indexed WHERE is_train GROUP BY 1), "
    "tree_scored AS (SELECT f.signal_date, f.hour, f.power AS actual, m.prediction, "
    "f.power - m.prediction AS residual FROM indexed f JOIN hour_means m USING (hour) WHERE NOT f.is_train)"
)

def _tree() -> str:
    """A regression tree of the default depth, level by level: candidate thresholds of each feature,
    the squared-error gain of each candidate in each node, the best one per node, children.

    Up to ``TREE_BINS`` distinct values, thresholds are all midpoints. Beyond, the k-th threshold
    follows the value after which the running count passes k strides more closely than before it; at
    most one threshold falls between two neighbours, hence the running minimum. The index of the band
    is a category: in each node its values are ranked by their average label, and the ranks are cut.
    """
    *numeric, category = _FEATURES
    c = len(numeric)
    values = " UNION ALL ".join(f"SELECT id, {i} AS f, {name} AS x FROM rows_at_0" for i, name in enumerate(numeric))
    steps = [
        f"rows_at_0 AS (SELECT signal_date, hour, {_HOUR_KEY} AS id, is_train, power, "
        + ", ".join(_FEATURES)
        + ", 1 AS node FROM indexed)",
        f"cells AS MATERIALIZED ({values})",
        "sizes AS (SELECT f, x, count(*) AS c FROM cells JOIN rows_at_0 USING (id) WHERE is_train GROUP BY f, x)",
        "ranked AS (SELECT f, x, row_number() OVER w - 1 AS i, lag(x) OVER w AS x_before, "
        "2 * sum(c) OVER w - c AS middle, count(*) OVER (PARTITION BY f) AS n_values, "
        f"sum(c) OVER (PARTITION BY f) / {float(TREE_BINS)} AS stride "
        "FROM sizes WINDOW w AS (PARTITION BY f ORDER BY x))",
        "passed AS (SELECT *, i + min(CASE WHEN i = 0 THEN 0 ELSE ceil(middle / (2 * stride)) - 1 END - i) "
        "OVER (PARTITION BY f ORDER BY x) AS k FROM ranked)",
        "stepped AS (SELECT *, k - lag(k) OVER (PARTITION BY f ORDER BY x) AS rise FROM passed)",
        "thresholds AS MATERIALIZED (SELECT f, (x_before + x) / 2 AS threshold FROM stepped "
        f"WHERE i > 0 AND (n_values <= {TREE_BINS} OR rise > 0) "
        f"UNION ALL SELECT {c}, r + 0.5 FROM range((SELECT count(*) - 1 FROM indexes)) t(r))",
    ]
    for level in range(TREE_DEPTH):
        steps += [
            f"ranks_{level} AS (SELECT node, {category}, row_number() OVER (PARTITION BY node "
            f"ORDER BY avg(power), {category}) - 1 AS x FROM rows_at_{level} WHERE is_train GROUP BY node, {category})",
            f"cells_{level} AS MATERIALIZED (FROM cells UNION ALL SELECT r.id, {c}, coalesce(k.x, 1000) "
            f"FROM rows_at_{level} r LEFT JOIN ranks_{level} k ON k.node = r.node AND k.{category} = r.{category})",
            f"sums_{level} AS (SELECT r.node, t.f, t.threshold, count(*) AS n, sum(r.power) AS s, "
            "count(*) FILTER (WHERE v.x <= t.threshold) AS nl, "
            "sum(r.power) FILTER (WHERE v.x <= t.threshold) AS sl "
            f"FROM rows_at_{level} r JOIN cells_{level} v USING (id) JOIN thresholds t ON t.f = v.f "
            "WHERE r.is_train GROUP BY 1, 2, 3)",
            f"gains_{level} AS (SELECT node, f, threshold, "
            "sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain "
            f"FROM sums_{level} WHERE nl > 0 AND nl < n)",
            f"best_{level} AS MATERIALIZED (SELECT node, f, threshold FROM gains_{level} WHERE gain > 0 QUALIFY "
            "row_number() OVER (PARTITION BY node ORDER BY round(gain, 4) DESC, f, threshold) = 1)",
            f"rows_at_{level + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node "
            "ELSE 2 * r.node + CAST(v.x > b.threshold AS INTEGER) END AS node "
            f"FROM rows_at_{level} r LEFT JOIN best_{level} b ON r.node = b.node "
            f"LEFT JOIN cells_{level} v ON v.id = r.id AND v.f = b.f)",
        ]
    steps += [
        f"leaves AS (SELECT node, avg(power) AS prediction FROM rows_at_{TREE_DEPTH} WHERE is_train GROUP BY 1)",
        "grown_scored AS (SELECT signal_date, hour, power AS actual, prediction, power - prediction AS residual "
        f"FROM rows_at_{TREE_DEPTH} JOIN leaves USING (node) WHERE NOT is_train)",
    ]
    return ", ".join(steps)


# event_type and event_id of every message, and what is wrong with it
_DAMAGED = (
    "WITH damaged AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'not JSON' "
    "WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'no time' WHEN event_type = 'purchase' THEN 'bad time' "
    "WHEN event_type = 'signup' THEN 'not an object' WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'blank' "
    "END AS problem FROM events) "
)

# the narrower of two widths, the first of them not below half the square-root width
_AUTO_BINS = (
    "measured AS (SELECT count(*) AS n, max(residual) - min(residual) AS extent, "
    "quantile_cont(residual, 0.75) - quantile_cont(residual, 0.25) AS iqr FROM scored), "
    "auto AS (SELECT CAST(ceil(extent / least(extent / (log2(n) + 1), "
    "greatest(2 * iqr / power(n, 1.0 / 3), extent / sqrt(n) / 2))) AS INTEGER) AS bins FROM measured) "
)

_METRICS = "count(*) AS rows, " + _cuts(
    {
        "avg(residual * residual)": "mse",
        "sqrt(avg(residual * residual))": "rmse",
        "avg(abs(residual))": "mae",
        "1 - avg(residual * residual) / var_pop(actual)": "r2",
    },
    4,
)


def _histogram(source: str, bins: int | str, extra: str = "") -> str:
    place = f"LEAST(CAST(floor((residual - lo) / ((hi - lo) / {bins})) AS INTEGER), {bins} - 1)"
    return (
        f"SELECT CAST(g AS INTEGER) AS bin, {_cut(f'lo + g * (hi - lo) / {bins}', 4)} AS low, "
        f"{_cut(f'lo + (g + 1) * (hi - lo) / {bins}', 4)} AS high, "
        f"(SELECT count(*) FROM {source} WHERE {place} = g) AS rows{extra} "
        f"FROM range({bins}) t(g), (SELECT min(residual) AS lo, max(residual) AS hi FROM {source})"
    )


def _density(model: str = "", source: str = "scored", extra: str = "") -> str:
    cells, points = CURVE_CELLS, CURVE_POINTS
    curve = "sum(weight * exp(-0.5 * power((x - centre) / bw, 2)) / sqrt(2 * pi())) / any_value(n * bw)"
    return (
        (model or _MODEL)
        + ", stats AS (SELECT min(residual) AS lo, max(residual) AS hi, count(*) AS n, "
        f"stddev_samp(residual) * power(count(*), -0.2) AS bw FROM {source}), "
        f"dense AS (SELECT LEAST(CAST(floor((residual - lo) / ((hi - lo) / {cells})) AS INTEGER), {cells - 1}) AS cell, "
        f"count(*) AS weight, avg(residual) AS centre FROM {source}, stats GROUP BY 1), "
        f"grid AS (SELECT CAST(g AS INTEGER) AS point, lo + g * ((hi - lo) / {points - 1}) AS x, n, bw "
        f"FROM stats, range({points}) t(g)) "
        f"SELECT point, {_cut('x', 6)} AS x, {_cut(curve, 6)} AS density{extra} "
        "FROM grid, dense GROUP BY point, x"
    )


def _joint(model: str = "", source: str = "scored", extra: str = "") -> str:
    bins = JOINT_BINS

    def place(column: str) -> str:
        return f"GREATEST(LEAST(CAST(floor(({column} - lo) / ((hi - lo) / {bins})) AS INTEGER), {bins - 1}), 0)"

    return (
        (model or _MODEL)
        + ", stats AS (SELECT LEAST(min(actual), min(prediction)) AS lo, "
        f"GREATEST(max(actual), max(prediction)) AS hi, max(actual) AS line_end FROM {source}), "
        f"placed AS (SELECT {place('actual')} AS actual_bin, {place('prediction')} AS prediction_bin, "
        f"lo, hi, line_end FROM {source}, stats) "
        "SELECT actual_bin, prediction_bin, "
        f"{_cut(f'lo + actual_bin * (hi - lo) / {bins}', 4)} AS actual_low, "
        f"{_cut(f'lo + prediction_bin * (hi - lo) / {bins}', 4)} AS prediction_low, "
        f"count(*) AS rows, {_cut('line_end', 4)} AS line_end{extra} FROM placed "
        "GROUP BY actual_bin, prediction_bin, lo, hi, line_end"
    )


_STATUS_ROWS = f"SELECT signal_date, hour, {_cuts(_MAPPED, 6)}, generation_status FROM status"
_MAP_AVERAGE_ROWS = f"SELECT signal_date, hour, {_cuts(_MAP_AVERAGES, 6)} FROM hourly"

_LONG = " UNION ALL ".join(
    f"SELECT signal_date, hour, '{new}' AS sig_mapping_name, {old} AS value FROM hourly" for old, new in _MAPPED.items()
)

_MINUTES = "date_trunc('minute', signal_ts)"
_FLAT = _cuts(_own(*_VALUES), 6, "{}_d")
# rows that went through the landing directory
_LANDED = _cuts(
    {"CASE WHEN event_type = 'error' THEN NULL ELSE power_d END": "power"}
    | {f"{name}_d": name for name in _VALUES if name != "power"},
    6,
)
_TIME_TEXT = "strftime(signal_ts, '%d %m %Y %H:%M') AS time_text"
_R = _with(_READINGS)
_H = _with(_READINGS, _HOURLY)
_S = _with(_READINGS, _HOURLY, _STATUS)
_LANDED_ROWS = _R + f"SELECT signal_date, {_MINUTES} AS signal_ts, {_LANDED} FROM readings"
_SCORES = (
    f"SELECT signal_date, hour, {_cuts({'actual': 'active_power_average', 'prediction': 'prediction'}, 4)} FROM "
)

_LANDED_ROWS_ONLY = f"SELECT * FROM ({_LANDED_ROWS})"
_BOTH = _MODEL.rstrip() + ", " + _tree()

ORACLES: Mapping[str, str] = {
    "hourly_status": _S + _STATUS_ROWS,
    "daily_distinct_derived": "SELECT CAST(ts AS DATE) AS date, count(DISTINCT ts) AS distinct_datapoints "
    "FROM events GROUP BY 1 ORDER BY 1",
    "daily_distinct_stored": "SELECT CAST(ts AS DATE) AS signal_date, count(DISTINCT ts) AS distinct_signal_count "
    "FROM events GROUP BY 1",
    "hourly_averages_typed": _R
    + "SELECT signal_date AS date, CAST(hour(signal_ts) AS INTEGER) AS hour, "
    + _cuts(_TYPED_AVERAGES, 6, "avg({}_d)")
    + " FROM readings GROUP BY 1, 2 ORDER BY 1, 2",
    "hourly_averages_map": _H + _MAP_AVERAGE_ROWS,
    "repeated_ingestion": _H + _MAP_AVERAGE_ROWS,
    "repeated_distinct": "SELECT CAST(ts AS DATE) AS signal_date, count(DISTINCT ts) AS distinct_signal_count "
    "FROM events GROUP BY 1",
    "band_rows": _R + f"SELECT event_id, {_band('power_d')} AS generation_indicator FROM readings",
    "band_null": "WITH powers AS (SELECT CAST(ts AS DATE) AS signal_date, CAST(hour(ts) AS INTEGER) AS hour, "
    "avg(CASE WHEN user_id % 7 = 0 THEN CAST(CAST(value * 12 AS VARCHAR) AS FLOAT) END) AS power "
    f"FROM events GROUP BY 1, 2) SELECT signal_date, hour, {_band('power')} AS generation_indicator, "
    f"CASE WHEN power IS NULL THEN 'Unknown' ELSE {_band('power')} END AS with_null_label FROM powers",
    "absent_keys": _H
    + "SELECT signal_date AS date, hour, "
    + ", ".join(f"CAST(NULL AS DOUBLE) AS {name}" for name in _TYPED_AVERAGES.values())
    + ", 'Exceptional' AS generation_indicator FROM hourly",
    "mapping_union": _H
    + f"SELECT sig_mapping_name, count(value) AS hours, {_cut('avg(value)', 6)} AS value FROM ({_LONG}) GROUP BY 1",
    "mapping_inline": _R
    + "SELECT event_id, signal_ts, "
    + _cuts(_MAPPED, 6, "{}_d")
    + f", {_band('power_d')} AS generation_indicator FROM readings",
    "rename_columns": _H
    + "SELECT signal_date, hour, "
    + _cuts(_MAP_AVERAGES | {name: _MAPPED[name] for name in ("power", "speed")}, 6)
    + " FROM hourly",
    "mapping_broadcast_join": _H
    + f"SELECT signal_date, hour, sig_mapping_name, {_cut('value', 6)} AS value FROM ({_LONG})",
    "day_filter": _S + _STATUS_ROWS + f" WHERE signal_date = DATE '{SCORED_DAY}'",
    "top_hours": _H + _MAP_AVERAGE_ROWS + " ORDER BY signal_date, hour LIMIT 20",
    "preview_rows": "SELECT event_id, ts AS signal_ts, CAST(event_id % 360 AS VARCHAR) AS direction_text "
    "FROM events ORDER BY ts, event_id LIMIT 20",
    "feature_select": _FRAME
    + f"SELECT {_cuts(_MAPPED, 6)}, status_index AS generation_status_index FROM indexed",
    "payload_roundtrip": _R + f"SELECT {_MINUTES} AS signal_ts, {_FLAT} FROM readings",
    "parse_readings": _R + f"SELECT event_id, signal_date, {_MINUTES} AS signal_ts, {_FLAT} FROM readings",
    "invalid_rows": "WITH kept AS (SELECT event_type, event_type IN ('click', 'view') AS is_valid, "
    "event_type IN ('click', 'view', 'purchase') AS has_power FROM events "
    "WHERE NOT (event_type = 'view' AND event_id % 2 = 0)) "
    "SELECT event_type, is_valid, count(*) AS rows, count(*) FILTER (WHERE has_power) AS with_power "
    "FROM kept GROUP BY 1, 2",
    "quarantine": _DAMAGED
    + "SELECT event_id, problem, CASE WHEN problem IS NOT NULL THEN true END AS body_kept FROM damaged",
    "fan_out": _R.rstrip() + ", " + _DAMAGED.removeprefix("WITH ")
    + f"SELECT 'table' AS sink, NULL AS problem, {_cut('power_d', 6)} AS power "
    "FROM readings JOIN damaged USING (event_id) WHERE problem IS NULL "
    "UNION ALL SELECT 'tap', NULL, CASE WHEN problem IS NULL OR problem IN ('no time', 'bad time') "
    f"THEN {_cut('power_d', 6)} END FROM readings JOIN damaged USING (event_id) "
    "UNION ALL SELECT 'quarantine', problem, NULL FROM damaged WHERE problem IS NOT NULL",
    "append_then_read": _R
    + f"SELECT signal_date, signal_ts, {_FLAT} FROM readings "
    f"UNION ALL SELECT signal_date, signal_ts, {_FLAT} FROM readings",
    "overwrite_then_read": _S + _STATUS_ROWS,
    "failed_replacement": _S + _STATUS_ROWS + " WHERE hour % 2 = 0",
    "archived_landing": _LANDED_ROWS,
    "stream_totals": "SELECT CAST(12 AS BIGINT) AS batches, 2 * count(*) AS rows FROM events",
    "csv_stream": _R + f"SELECT {_TIME_TEXT}, {_LANDED} FROM readings",
    "stream_publish": _LANDED_ROWS,
    "raw_tap": _R + f"SELECT {_TIME_TEXT}, {_cut('power_d', 6)} AS power FROM readings",
    "stream_ingest": _LANDED_ROWS,
    "stream_to_hourly": _H
    + "SELECT signal_date AS date, hour, "
    + _cuts({name: f"avg_{name}" for name in _VALUES}, 6)
    + " FROM hourly",
    "batch_counts": "SELECT count(*) AS batch_rows, count(*) AS total_rows FROM events "
    "UNION ALL SELECT count(*), 2 * count(*) FROM events",
    "status_index": _FRAME
    + "SELECT signal_date, hour, generation_status, status_index AS generation_status_index FROM indexed",
    "feature_vector": _FRAME
    + "SELECT signal_date, hour, "
    + _cuts({name: f"feature_{i}" for i, name in enumerate(_FEATURES)}, 6)
    + " FROM indexed",
    "keyed_split": _FRAME
    + "SELECT signal_date, hour, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part FROM indexed",
    "keyed_split_events": f"SELECT CASE WHEN {_position('event_id')} < {TRAIN_SHARE} THEN 'train' ELSE 'test' END "
    "AS part, count(*) AS rows FROM events GROUP BY 1",
    "exact_split": _H.rstrip()
    + f", placed AS (SELECT signal_date, hour, row_number() OVER (ORDER BY {_rank(_HOUR_KEY)}) AS place, "
    f"count(*) OVER () AS n FROM hourly) SELECT signal_date, hour, {_SIDE} AS part FROM placed",
    "exact_split_events": f"WITH placed AS (SELECT event_id, row_number() OVER (ORDER BY {_rank('event_id')}) AS place, "
    f"count(*) OVER () AS n FROM events) SELECT event_id, {_SIDE} AS part FROM placed",
    "random_split_cover": _H
    + "SELECT signal_date, count(*) AS rows, count(DISTINCT hour) AS distinct_hours FROM hourly GROUP BY 1",
    "linear_one_feature": _FRAME
    + "SELECT "
    + _cuts({"regr_slope(power, speed)": "slope", "regr_intercept(power, speed)": "intercept"}, 6)
    + " FROM indexed WHERE is_train",
    "linear_model_scores": _MODEL + _SCORES + "scored",
    "tree_model_scores": _FRAME.rstrip() + ", " + _tree() + " " + _SCORES + "grown_scored",
    "tree_full_depth": _FRAME.rstrip() + ", " + _HOUR_MEANS + " " + _SCORES + "tree_scored",
    "score_day": _MODEL + _SCORES + f"scored_all WHERE signal_date = DATE '{SCORED_DAY}'",
    "regression_metrics": _MODEL + f"SELECT {_METRICS} FROM scored",
    "residuals": _MODEL + f"SELECT signal_date, hour, {_cut('residual', 4)} AS residual FROM scored",
    "residual_histogram": _MODEL + _histogram("scored", HISTOGRAM_BINS),
    "residual_histogram_auto": _MODEL.rstrip() + ", " + _AUTO_BINS + _histogram("scored", "(SELECT bins FROM auto)"),
    "event_quartiles": "SELECT "
    + _cuts({f"quantile_cont(value, {share})": name for share, name in ((0.25, "low"), (0.5, "middle"), (0.75, "high"))}, 6)
    + ", count(*) FILTER (WHERE value IS NULL) AS missing, count(*) FILTER (WHERE isnan(value)) AS not_a_number, "
    "count(*) FILTER (WHERE isinf(value)) AS infinite FROM events",
    "residual_density": _density(),
    "actual_vs_predicted_bins": _joint(),
    "model_comparison": _BOTH
    + f" SELECT 'linear' AS model, {_METRICS} FROM scored UNION ALL SELECT 'tree', {_METRICS} FROM grown_scored",
    "model_comparison_residuals": _BOTH
    + " "
    + _histogram("scored", HISTOGRAM_BINS, ", 'linear' AS model")
    + " UNION ALL "
    + _histogram("grown_scored", HISTOGRAM_BINS, ", 'tree' AS model"),
    "model_comparison_density": _density(_BOTH, "grown_scored", ", 'tree' AS model"),
    "model_comparison_bins": _joint(_BOTH, "grown_scored", ", 'tree' AS model"),
    "repeated_streams": " UNION ALL ".join([_LANDED_ROWS_ONLY] * 3),
    "trailing_time_text": _R + f"SELECT event_id, signal_date, {_MINUTES} AS signal_ts FROM readings",
    "old_landing_files": _R + f"SELECT {_TIME_TEXT}, {_LANDED} FROM readings",
}
