"""The same results in plain SQL, for comparison.

``_CTES`` builds, per panel, a chain of named subqueries; each oracle takes
the ones it mentions (and those they mention) in order.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from panelcast.config import MAIN_CONFIG
from panelcast.plans import tables as B
from panelcast.queries import PRICE_SIZED

CFG = MAIN_CONFIG
H, L, PERIOD = CFG.horizon, CFG.sequence_length, CFG.period
HALF = PERIOD // 2
BARS = ["open", "high", "low", "close", "volume"]
LAGS = CFG.lag_columns
SEASONAL = ["month", "day_of_week", "quarter", "sin_month", "cos_month"]
NOISE = ["entropy", "random_component", "ou_simulated"]
MACRO = ["macro_0", "macro_1"]
FULL = LAGS + ["ma_5"] + SEASONAL + NOISE + ["seasonal_adjusted_close"] + MACRO
STRICT = LAGS + ["ma_5"] + SEASONAL + NOISE + MACRO
BASIC = LAGS + ["ma_5"] + MACRO
INTEGER = {"month", "day_of_week", "quarter"}
W = "PARTITION BY series_id ORDER BY date"
UPTO = f"({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
S = "(PARTITION BY series_id)"
TWO_PI = "(2 * 3.141592653589793::DOUBLE)"


def r(column: str, digits: int | None = None, name: str | None = None) -> str:
    name = name or column
    digits = PRICE_SIZED.get(name, 6) if digits is None else digits
    return f"half_up({column}, {digits}) AS {name}"


def rs(columns, **digits) -> str:
    return ", ".join(c if c in INTEGER else r(c, digits.get(c)) for c in columns)


def _half_up(text: str) -> str:
    """Write out ``half_up(x, d)`` as floor(x * 10^d + 1/2) / 10^d."""
    while (at := text.find("half_up(")) >= 0:
        start = depth_at = at + len("half_up(")
        depth = 1
        while depth:
            depth += {"(": 1, ")": -1}.get(text[depth_at], 0)
            depth_at += 1
        x, digits = text[start : depth_at - 1].rsplit(",", 1)
        unit = f"{10 ** int(digits)}::DOUBLE"
        text = f"{text[:at]}(floor(({x}) * {unit} + 0.5::DOUBLE) / {unit}){text[depth_at:]}"
    return text


def hex_int(text: str) -> str:
    return f"('0x' || {text})::UBIGINT::DOUBLE"


def gaussian(name: str) -> str:
    digest = f"md5(concat_ws('|', '{CFG.seed}', series_id, (date - DATE '1970-01-01')::VARCHAR))"
    start = {"random": 1, "ou": 17}[name]
    u, v = hex_int(f"substr({digest}, {start}, 8)"), hex_int(f"substr({digest}, {start + 8}, 8)")
    return f"(sqrt(-2::DOUBLE * ln(({u} + 1) / 4294967296::DOUBLE)) * cos({TWO_PI} * {v} / 4294967296::DOUBLE))"


def period_date(period: str) -> str:
    pattern = r"^(\d{1,4})-Q([1-4])$"
    y, q = (f"try_cast(regexp_extract({period}, '{pattern}', {i}) AS INTEGER)" for i in (1, 2))
    return f"make_date({y}::BIGINT, ({q} * 3 - 2)::BIGINT, 1::BIGINT)::DATE"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)


def _area_rows(mapping: dict[str, list[str]]):
    for series, areas in mapping.items():
        full = areas if B.BASE_AREA in areas else [B.BASE_AREA, *areas]
        yield from ((series, a, i) for i, a in enumerate(full))


def _orders_bars() -> str:
    return """SELECT o_orderpriority AS series_id, o_orderdate::DATE AS date,
        arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
        arg_max(o_totalprice, o_orderkey) AS close, count(*)::DOUBLE AS volume
      FROM orders GROUP BY 1, 2"""


def _supplier_bars() -> str:
    key = "{'a': l_orderkey, 'b': l_linenumber, 'c': l_extendedprice}"
    return f"""SELECT l_suppkey::VARCHAR AS series_id, l_shipdate::DATE AS date,
        (min({key})).c AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
        (max({key})).c AS close, sum(l_quantity) AS volume
      FROM lineitem GROUP BY 1, 2"""


def _f_rows(frame: str) -> str:
    parts = []
    for i, c in enumerate(FULL):
        x = f"{c}::DOUBLE"
        parts.append(
            f"""SELECT series_id, {i} AS feature_pos, '{c}' AS feature, count({c}) AS n, min({x}) AS lo, max({x}) AS hi,
              covar_pop({x}, target) AS cxy, var_pop({x}) AS vx,
              var_pop(CASE WHEN {c} IS NOT NULL THEN target END) AS vy
            FROM {frame} GROUP BY 1"""
        )
    return " UNION ALL ".join(parts)


def _prediction(t: "Trial") -> str:
    if t.family == "naive":
        return f"l{t.n}"
    if t.family == "moving_average":
        return f"m{t.n}"
    return f"a{t.n} + b{t.n} * l{t.n}"


def _trial_rows(trials: list["Trial"]) -> str:
    return " UNION ALL ".join(
        f"""SELECT series_id, date, y AS actual, mu, sd, {t.trial_id} AS trial_id, '{t.family}' AS family,
          '{t.text}' AS params_str, {_prediction(t)} AS predicted FROM fitted"""
        for t in trials
    )


class Trial(NamedTuple):
    """One trial, written out here so that the grid under test does not check itself."""

    trial_id: int
    family: str
    n: int
    text: str


TRIALS = [
    Trial(0, "naive", 1, "family: naive; k: 1"),
    Trial(1, "naive", 7, "family: naive; k: 7"),
    Trial(2, "naive", 14, "family: naive; k: 14"),
    Trial(3, "moving_average", 3, "family: moving_average; w: 3"),
    Trial(4, "moving_average", 5, "family: moving_average; w: 5"),
    Trial(5, "moving_average", 7, "family: moving_average; w: 7"),
    Trial(6, "moving_average", 14, "family: moving_average; w: 14"),
    Trial(7, "ols_lag", 1, "family: ols_lag; k: 1"),
    Trial(8, "ols_lag", 2, "family: ols_lag; k: 2"),
    Trial(9, "ols_lag", 7, "family: ols_lag; k: 7"),
    Trial(10, "ols_lag", 14, "family: ols_lag; k: 14"),
]
NETWORKS = """SELECT (row_number() OVER (ORDER BY a, b, d, c) - 1)::INTEGER AS trial_id, rnn AS family,
    'rnn_type: ' || rnn || '; n_layers: ' || layers || '; units: 50; activation: ' || act
      || '; optimizer: adam; batch_size: 32; epochs: ' || epochs || '; dropout: 0.0' AS params_str
  FROM (VALUES (0, 'LSTM'), (1, 'GRU'), (2, 'SimpleRNN')) AS x(a, rnn), (VALUES (0, 1), (1, 2)) AS y(b, layers),
    (VALUES (0, 20), (1, 50)) AS z(c, epochs), (VALUES (0, 'relu'), (1, 'tanh')) AS v(d, act)"""
TRAINED = """SELECT (row_number() OVER (ORDER BY a, b, c) - 1)::INTEGER AS trial_id, 'linear' AS family, optimizer, batches, epochs,
    'family: linear; optimizer: ' || optimizer || '; rate: 0.002; batches: ' || batches || '; epochs: ' || epochs AS params_str
  FROM (VALUES (0, 'sgd'), (1, 'momentum'), (2, 'adam')) AS x(a, optimizer), (VALUES (0, 1), (1, 4)) AS y(b, batches), (VALUES (0, 20), (1, 50)) AS z(c, epochs)"""
RIDGES = """SELECT * FROM (VALUES (0, 0.1::DOUBLE, 'family: ridge; alpha: 0.1'), (1, 1.0, 'family: ridge; alpha: 1.0'),
    (2, 10.0, 'family: ridge; alpha: 10.0'), (3, 100.0, 'family: ridge; alpha: 100.0')) AS t(trial_id, alpha, params_str)"""
K, P = CFG.k_best, CFG.k_best * CFG.sequence_length + 1


def chain(panel: str = "orders", unknown: bool = False, trials: list[Trial] = TRIALS) -> dict[str, str]:
    """The named subqueries of one panel, in dependency order."""
    mapping = B.PRIORITY_AREAS_WITH_UNKNOWN if unknown else B.PRIORITY_AREAS
    if panel == "orders":
        areas = f"SELECT * FROM (VALUES {values(_area_rows(mapping))}) AS t(series_id, area, pos)"
    else:
        own = "supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
        areas = f"""SELECT s_suppkey::VARCHAR AS series_id, '{B.BASE_AREA}' AS area, 0 AS pos FROM supplier
          UNION ALL SELECT s_suppkey::VARCHAR, r_name, 1 FROM {own} WHERE r_name <> '{B.BASE_AREA}'"""
    lags = sorted({t.n for t in trials if t.family != "moving_average"})
    ols = sorted({t.n for t in trials if t.family == "ols_lag"})
    widths = sorted({t.n for t in trials if t.family == "moving_average"})
    context = [f"lag(y, {k}) OVER ({W}) AS l{k}" for k in lags]
    context += [f"avg(y) OVER ({W} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS m{w}" for w in widths]
    lines = [f"regr_slope(y, l{k}) AS b{k}, regr_intercept(y, l{k}) AS a{k}" for k in ols] or ["0 AS none"]
    in_frame = lambda c: f"({c} IS NOT NULL)"
    macros = "(macro_0 IS NOT NULL OR n_areas <= 0) AND (macro_1 IS NOT NULL OR n_areas <= 1)"

    def frame(columns, checked):
        cond = " AND ".join([in_frame(c) for c in checked if c not in MACRO] + [macros])
        return f"SELECT series_id, date, {', '.join(columns)}, n_areas, close AS target FROM lagged WHERE {cond}"

    everything = BARS + ["year", "month", "quarter", "day_name"] + STRICT + ["seasonal_adjusted_close"]
    places = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
    return {
        "bars": _orders_bars() if panel == "orders" else _supplier_bars(),
        "areas": areas,
        "limits": "SELECT min(date) AS first_day, max(date) AS last_day FROM bars",
        "cal": "SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY))::DATE AS date FROM limits",
        "ids": "SELECT DISTINCT series_id FROM bars",
        "dense": f"SELECT series_id, date, {', '.join(BARS)} FROM ids CROSS JOIN cal LEFT JOIN bars USING (series_id, date)",
        "filled": "SELECT series_id, date, "
        + ", ".join(f"last_value({c} IGNORE NULLS) OVER {UPTO} AS {c}" for c in BARS)
        + " FROM dense",
        "closes": "SELECT series_id, date, close FROM filled WHERE close IS NOT NULL",
        "totals": f"""SELECT r_name AS area, n_nationkey, date_trunc('quarter', o_orderdate)::DATE AS date,
            sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS total
          FROM orders JOIN ({places}) ON o_custkey = c_custkey GROUP BY ALL""",
        "region_totals": "SELECT area, date, sum(total)::BIGINT AS total FROM totals GROUP BY ALL",
        "macro_obs": """SELECT date, year(date)::INTEGER AS year, quarter(date)::INTEGER AS quarter, area,
            (total - past)::DOUBLE * 100::DOUBLE / past::DOUBLE AS value
          FROM (SELECT *, lag(total) OVER (PARTITION BY area ORDER BY date) AS past FROM region_totals)
          WHERE past IS NOT NULL""",
        "nation_obs": """SELECT date, year(date)::INTEGER AS year, quarter(date)::INTEGER AS quarter, area,
            (total - past)::DOUBLE * 100::DOUBLE / past::DOUBLE AS value
          FROM (SELECT *, lag(total) OVER (PARTITION BY area, n_nationkey ORDER BY date) AS past FROM totals)
          WHERE past IS NOT NULL""",
        "inside_obs": "SELECT macro_obs.* FROM macro_obs JOIN limits ON date BETWEEN first_day AND last_day",
        "area_days": """SELECT a.series_id, a.pos, c.date, o.year AS obs_year, o.quarter AS obs_quarter, o.value
          FROM (areas a CROSS JOIN cal c)
          ASOF LEFT JOIN inside_obs o ON a.area = o.area AND c.date >= o.date""",
        "macro_days": """SELECT series_id, date, max(obs_year) AS obs_year,
            arg_max(obs_quarter, obs_year) AS obs_quarter,
            max(CASE WHEN pos = 0 THEN value END) AS macro_0, max(CASE WHEN pos = 1 THEN value END) AS macro_1,
            count(*)::INTEGER AS n_areas
          FROM area_days GROUP BY series_id, date""",
        "panel": f"""SELECT series_id, date, year(date)::INTEGER AS year, month(date)::INTEGER AS month,
            quarter(date)::INTEGER AS quarter, dayname(date) AS day_name, {', '.join(BARS)}, macro_0, macro_1, n_areas
          FROM filled JOIN macro_days USING (series_id, date)""",
        "trended": f"""SELECT *, CASE WHEN t >= {HALF} AND t < n - {HALF} THEN
              (sum(close) OVER ({W} ROWS BETWEEN {HALF} PRECEDING AND {HALF} FOLLOWING)
               - 0.5::DOUBLE * (lag(close, {HALF}) OVER ({W}) + lead(close, {HALF}) OVER ({W}))) / {PERIOD}::DOUBLE END AS trend
          FROM (SELECT *, row_number() OVER ({W}) - 1 AS t, count(*) OVER {S} AS n FROM closes)""",
        "factors": f"SELECT series_id, t % {PERIOD} AS phase, avg(close / trend) AS factor FROM trended GROUP BY ALL",
        "seasons": f"SELECT series_id, phase, factor / avg(factor) OVER {S} AS seasonal FROM factors",
        "decomposed": f"""SELECT d.series_id, date, close, trend, seasonal, close / (trend * seasonal) AS resid, 'ok' AS decompose_status
          FROM trended d JOIN seasons s ON d.series_id = s.series_id AND d.t % {PERIOD} = s.phase""",
        "moments": "SELECT series_id, count(close) AS n, sum(close) AS total, avg(close) AS mean, stddev_samp(close) AS std FROM closes GROUP BY 1",
        "entropies": """SELECT series_id, -sum(close / total * log2(close / total + 1e-10)) AS entropy
          FROM closes JOIN moments USING (series_id) GROUP BY 1""",
        "noise": f"""SELECT series_id, date, std * {gaussian('random')} AS random_component FROM closes JOIN moments USING (series_id)""",
        "ou_terms": f"""SELECT series_id, date, mean, std, n, row_number() OVER ({W}) - 1 AS t,
            1 - {CFG.theta}::DOUBLE * (1::DOUBLE / n) AS a, {gaussian('ou')} AS z
          FROM closes JOIN moments USING (series_id)""",
        "ou": f"""SELECT series_id, date, mean + CASE WHEN t = 0 THEN 0 ELSE std * sqrt(1::DOUBLE / n) * pow(a, t)
              * sum(CASE WHEN t = 0 THEN 0 ELSE z * pow(a, -t) END) OVER {UPTO} END AS ou_simulated
          FROM ou_terms""",
        "prepared": f"""SELECT p.*, decompose_status, weekday AS day_of_week, sin(month * ({TWO_PI} / 12)) AS sin_month,
            cos(month * ({TWO_PI} / 12)) AS cos_month, entropy, random_component, ou_simulated,
            d.close / seasonal AS seasonal_adjusted_close
          FROM (SELECT *, (isodow(date) - 1)::INTEGER AS weekday FROM panel) p JOIN decomposed d USING (series_id, date)
          JOIN entropies USING (series_id) JOIN noise USING (series_id, date) JOIN ou USING (series_id, date)""",
        "recent": f"""SELECT * FROM (SELECT *, max(date) OVER {S} AS last_day FROM prepared)
          WHERE date >= (last_day - INTERVAL {CFG.n_years} YEAR)::DATE""",
        "lagged": f"""SELECT *, lag(close, {CFG.short_lag}) OVER ({W}) AS {LAGS[0]}, lag(close, {CFG.long_lag}) OVER ({W}) AS {LAGS[1]},
            CASE WHEN count(close) OVER f5 = 5 THEN avg(close) OVER f5 END AS ma_5
          FROM recent WINDOW f5 AS ({W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
        "frame": frame(FULL, FULL),
        "frame_strict": frame(STRICT, everything),
        "frame_basic": frame(BASIC, everything),
        "f_rows": _f_rows("frame"),
        "scores": """SELECT series_id, feature_pos, feature, CASE WHEN lo = hi THEN 0::DOUBLE
              ELSE (cxy * cxy / (vx * vy)) / (1 - cxy * cxy / (vx * vy)) * (n - 2) END AS f_score
          FROM f_rows WHERE n > 0""",
        "top": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY f_score DESC, feature_pos DESC) AS f_rank FROM scores)
          WHERE f_rank <= {CFG.k_best}""",
        "long_frame": "SELECT series_id, date, feature, value FROM ("
        + " UNION ALL ".join(f"SELECT series_id, date, '{c}' AS feature, {c}::DOUBLE AS value FROM frame" for c in FULL)
        + ")",
        "numbered": f"""SELECT *, train_size > t + 0 * n AS early FROM (SELECT *, row_number() OVER ({W}) - 1 AS t,
            count(*) OVER {S} AS n, count(*) OVER {S} - {H} - {L} AS train_size FROM frame) WHERE train_size > 0""",
        "target_state": f"SELECT series_id, avg(target) AS mu, stddev_pop(target) AS sd FROM numbered WHERE t < n - {H} GROUP BY 1",
        "scaled": "SELECT x.*, mu, sd, (target - mu) / sd AS y FROM numbered x JOIN target_state USING (series_id)",
        "context": f"SELECT *, {', '.join(context)} FROM scaled",
        "lines": f"SELECT series_id, {', '.join(lines)} FROM context WHERE t >= {L} AND t < n - {H} GROUP BY 1",
        "fitted": f"SELECT * FROM context JOIN lines USING (series_id) WHERE t >= n - {H}",
        "predictions": _trial_rows(trials),
        "trial_scores": """SELECT series_id, trial_id, family, params_str, avg(pow(actual - predicted, 2)) AS val_loss,
            1 - avg(pow(actual - predicted, 2)) / var_pop(actual) AS val_r2
          FROM predictions GROUP BY ALL""",
        "ranked": "SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY val_loss, trial_id) AS rank FROM trial_scores",
        "best": "SELECT * FROM ranked WHERE rank = 1",
        "chosen": "SELECT p.* FROM predictions p JOIN best b ON p.series_id = b.series_id AND p.trial_id = b.trial_id",
        "forecast": f"""SELECT series_id, date, actual * sd + mu AS actual,
            avg(predicted) OVER ({W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) * sd + mu AS predicted FROM chosen""",
        "resids": "SELECT series_id, date, actual - predicted AS residual FROM forecast",
        "bounds": "SELECT series_id, min(residual) AS lo, max(residual) AS hi FROM resids GROUP BY 1",
        "binned": """SELECT series_id, lo, (hi - lo) / 30 AS width,
            least(floor((residual - lo) / ((hi - lo) / 30)) + 1, 30)::INTEGER AS bin FROM resids JOIN bounds USING (series_id)""",
    }


def sql(select: str, ctes: dict[str, str]) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in ctes:
            if name not in needed and re.search(rf"\b(FROM|JOIN) \(?{name}\b", text):
                needed.add(name)
                visit(ctes[name])

    visit(select)
    if not needed:
        return select
    recursive = {name for name in needed if re.search(rf"\b(FROM|JOIN) \(?{name}\b", ctes[name])}
    body = ",\n".join(f"{name} AS {'' if name in recursive else 'MATERIALIZED '}({text})" for name, text in ctes.items() if name in needed)
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n{select}"


def _scaled(method: str) -> str:
    cells = []
    for c in FULL:
        x = f"CASE WHEN t < n - {H} THEN {c}::DOUBLE END"
        if method == "standard":
            center, size = f"avg({x})", f"CASE WHEN min({x}) = max({x}) THEN 1 ELSE stddev_pop({x}) END"
        elif method == "normalize":
            center, size = f"min({x})", f"max({x}) - min({x})"
        else:
            center, size = f"quantile_cont({x}, 0.5)", f"quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)"
        cells.append(f"{center} AS c_{c}, {size} AS s_{c}")
    state = f"SELECT series_id, {', '.join(cells)} FROM numbered GROUP BY 1"
    out = ", ".join(f"half_up(({c} - c_{c}) / (CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END), 6) AS {c}" for c in FULL)
    return f"SELECT series_id, date, {out} FROM numbered JOIN ({state}) USING (series_id)"


def _cells() -> str:
    return " UNION ALL ".join(
        f"""SELECT n.series_id, date, t, ({c}::DOUBLE - avg({c}::DOUBLE) FILTER (t < n - {H}) OVER {S})
          / (CASE WHEN min({c}) FILTER (t < n - {H}) OVER {S} = max({c}) FILTER (t < n - {H}) OVER {S} THEN 1
             ELSE stddev_pop({c}::DOUBLE) FILTER (t < n - {H}) OVER {S} END) AS v, '{c}' AS feature FROM numbered n"""
        for c in FULL
    )


def linear_chain(ctes: dict[str, str], batches: list[int]) -> dict[str, str]:
    """Gram matrices of the lagged features, written with whole columns as lists; batches 0 stands for the validation rows."""
    parts = [f"SELECT series_id, {b} AS batches, {k} AS part, {L} + (({k} * (n - {H} - {L})) // {b}) AS lo, {L} + (({k + 1} * (n - {H} - {L})) // {b}) AS hi FROM sizes" for b in batches for k in range(b)]
    parts.append(f"SELECT series_id, 0 AS batches, 0 AS part, n - {H} AS lo, n AS hi FROM sizes")
    return ctes | {
        "cells": _cells(),
        "sizes": "SELECT series_id, count(*)::INTEGER AS n, list(y ORDER BY t) AS ys FROM scaled GROUP BY 1",
        "columns_": "SELECT c.series_id, feature_pos, list(v ORDER BY t) AS xs FROM cells c JOIN top USING (series_id, feature) GROUP BY ALL",
        "variables": "SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY feature_pos) AS a FROM columns_",
        "parts": " UNION ALL ".join(parts),
        "design": f"""SELECT series_id, batches, part, (i - 1) * {K} + a AS pos, list_slice(xs, lo - i + 1, hi - i) AS v
            FROM variables JOIN parts USING (series_id) CROSS JOIN (SELECT unnest(range(1, {L + 1})) AS i)
          UNION ALL SELECT series_id, batches, part, {P}, list_transform(range(hi - lo), lambda x: 1::DOUBLE) FROM parts""",
        "targets": "SELECT series_id, batches, part, list_slice(ys, lo + 1, hi) AS y, (hi - lo)::DOUBLE AS n FROM parts JOIN sizes USING (series_id)",
        "grams": """SELECT a.series_id, a.batches, a.part, a.pos, list(list_inner_product(a.v, b.v) ORDER BY b.pos) AS g
          FROM design a JOIN design b ON a.series_id = b.series_id AND a.batches = b.batches AND a.part = b.part GROUP BY ALL""",
        "crosses": "SELECT d.series_id, d.batches, d.part, pos, list_inner_product(v, y) AS c FROM design d JOIN targets t ON d.series_id = t.series_id AND d.batches = t.batches AND d.part = t.part",
        "systems": """SELECT g.series_id, g.batches, g.part, list(g ORDER BY g.pos) AS gram, list(c ORDER BY g.pos) AS cross_
          FROM grams g JOIN crosses x ON g.series_id = x.series_id AND g.batches = x.batches AND g.part = x.part AND g.pos = x.pos GROUP BY ALL""",
        "sums": "SELECT s.*, n, list_inner_product(y, y) AS yy, y FROM systems s JOIN targets t ON s.series_id = t.series_id AND s.batches = t.batches AND s.part = t.part",
        "validation": "SELECT series_id, gram AS vg, cross_ AS vc, yy AS vyy, n AS vn, list_var_pop(y) AS spread FROM sums WHERE batches = 0",
        "ridges": RIDGES,
        "trained": TRAINED,
        "elimination": f"""SELECT s.series_id, trial_id, 1 AS step, generate_subscripts(gram, 1) AS r,
              unnest(list_transform(gram, lambda g, k: list_append(list_transform(g, lambda x, j: x + CASE WHEN j = k AND k < len(gram) THEN alpha ELSE 0 END), cross_[k]))) AS vec
            FROM sums s CROSS JOIN ridges WHERE batches = 1
          UNION ALL SELECT series_id, trial_id, step + 1, r, list_transform(list_zip(vec[2:], lead_row[2:]), lambda z: z[1] - vec[1] / lead_row[1] * z[2])
            FROM (SELECT *, first_value(vec) OVER (PARTITION BY series_id, trial_id ORDER BY r) AS lead_row FROM elimination) WHERE r > step""",
        "triangle": "SELECT series_id, trial_id, r, vec, max(r) OVER (PARTITION BY series_id, trial_id) AS size FROM elimination WHERE r = step",
        "solution": """SELECT series_id, trial_id, size + 1 AS r, []::DOUBLE[] AS w FROM triangle WHERE r = size
          UNION ALL SELECT s.series_id, s.trial_id, t.r, list_prepend((vec[len(vec)] - coalesce(list_inner_product(nullif(vec[2:len(vec) - 1], []), nullif(w, [])), 0)) / vec[1], w)
            FROM solution s JOIN triangle t ON s.series_id = t.series_id AND s.trial_id = t.trial_id AND t.r = s.r - 1""",
        "ridge_scores": """SELECT series_id, trial_id::INTEGER AS trial_id, 'ridge' AS family, params_str,
              (list_inner_product(w, list_transform(vg, lambda g: list_inner_product(g, w))) - 2 * list_inner_product(w, vc) + vyy) / vn AS val_loss, 1 - val_loss / spread AS val_r2
            FROM solution JOIN ridges USING (trial_id) JOIN validation USING (series_id) WHERE r = 1""",
        "paths": "SELECT optimizer, batches, max(epochs) AS epochs FROM trained GROUP BY ALL",
        "descent": """SELECT series_id, optimizer, p.batches, epochs, 0 AS step, list_transform(cross_, lambda x: 0::DOUBLE) AS w, list_transform(cross_, lambda x: 0::DOUBLE) AS m, list_transform(cross_, lambda x: 0::DOUBLE) AS v
            FROM paths p JOIN sums s ON s.batches = p.batches AND part = 0
          UNION ALL SELECT series_id, optimizer, batches, epochs, step,
              CASE optimizer WHEN 'sgd' THEN list_transform(list_zip(w, g), lambda z: z[1] - 0.002::DOUBLE * z[2])
                WHEN 'momentum' THEN list_transform(list_zip(w, m2), lambda z: z[1] - 0.002::DOUBLE * z[2])
                ELSE list_transform(list_zip(w, m2, v2), lambda z: z[1] - 0.002::DOUBLE * ((z[2] / (1 - pow(0.9::DOUBLE, step))) / (sqrt(z[3] / (1 - pow(0.999::DOUBLE, step))) + 1e-7::DOUBLE))) END, m2, v2
            FROM (SELECT *, CASE optimizer WHEN 'sgd' THEN m WHEN 'momentum' THEN list_transform(list_zip(m, g), lambda z: 0.9::DOUBLE * z[1] + z[2])
                    ELSE list_transform(list_zip(m, g), lambda z: 0.9::DOUBLE * z[1] + (1 - 0.9::DOUBLE) * z[2]) END AS m2,
                  CASE optimizer WHEN 'adam' THEN list_transform(list_zip(v, g), lambda z: 0.999::DOUBLE * z[1] + (1 - 0.999::DOUBLE) * z[2] * z[2]) ELSE v END AS v2
              FROM (SELECT d.series_id, d.optimizer, d.batches, d.epochs, d.step + 1 AS step, d.w, d.m, d.v,
                      list_transform(list_zip(list_transform(s.gram, lambda r: list_inner_product(r, d.w)), s.cross_), lambda z: 2 * (z[1] - z[2]) / s.n) AS g
                    FROM descent d JOIN sums s ON s.series_id = d.series_id AND s.batches = d.batches AND s.part = d.step % d.batches
                    WHERE d.step < d.epochs * d.batches))""",
        "points": """SELECT d.series_id, optimizer, d.batches, (step // d.batches)::INTEGER AS iteration,
              (list_inner_product(w, list_transform(s.gram, lambda g: list_inner_product(g, w))) - 2 * list_inner_product(w, s.cross_) + s.yy) / s.n AS train_loss,
              (list_inner_product(w, list_transform(vg, lambda g: list_inner_product(g, w))) - 2 * list_inner_product(w, vc) + vyy) / vn AS val_loss
            FROM descent d JOIN sums s ON s.series_id = d.series_id AND s.batches = 1 JOIN validation x ON x.series_id = d.series_id
            WHERE step > 0 AND step % d.batches = 0""",
        "curves": "SELECT p.series_id, trial_id, family, params_str, iteration, train_loss, val_loss FROM points p JOIN trained t ON t.optimizer = p.optimizer AND t.batches = p.batches AND iteration <= t.epochs",
        "waits": "SELECT *, arg_min(iteration, val_loss) OVER (PARTITION BY series_id, trial_id ORDER BY iteration ROWS UNBOUNDED PRECEDING) AS so_far FROM curves",
        "stops": "SELECT series_id, trial_id, coalesce(min(CASE WHEN iteration - so_far >= 10 THEN iteration END), max(iteration)) AS stopped_at FROM waits GROUP BY 1, 2",
        "stopped": """SELECT c.series_id, c.trial_id, c.family, c.params_str, stopped_at, so_far AS best_iteration, b.train_loss, b.val_loss
            FROM waits c JOIN stops s ON c.series_id = s.series_id AND c.trial_id = s.trial_id AND c.iteration = s.stopped_at
            JOIN curves b ON b.series_id = c.series_id AND b.trial_id = c.trial_id AND b.iteration = c.so_far""",
        "trained_scores": "SELECT series_id, trial_id, family, params_str, val_loss, 1 - val_loss / spread AS val_r2 FROM stopped JOIN validation USING (series_id)",
    }


def _sequence_sql(ctes: dict[str, str]) -> str:
    extra = {
        "cells": _cells(),
        "row_sums": "SELECT c.series_id, c.date, c.t, sum(v) AS s, count(*) AS k FROM cells c JOIN top USING (series_id, feature) GROUP BY ALL",
        "seqs": "SELECT series_id, date, t, "
        + ", ".join(f"lag(s, {L - i}) OVER ({W}) AS s{i}" for i in range(L))
        + ", k FROM row_sums",
    }
    weighted = " + ".join(f"s{i} * {i + 1}" for i in range(L))
    select = f"""SELECT q.series_id, q.date, {L} AS n_rows, k::INTEGER AS n_features, half_up(s0, 6) AS oldest,
        half_up(s{L - 1}, 6) AS newest, half_up({weighted}, 5) AS weighted, half_up(y, 6) AS target_scaled,
        x.t >= x.n - {H} AS is_val_target
      FROM seqs q JOIN scaled x ON q.series_id = x.series_id AND q.date = x.date WHERE q.t >= {L}"""
    return sql(select, ctes | extra)


def oracles() -> dict[str, str]:
    o = chain()
    u = chain(unknown=True)
    s = chain("supplier")
    q = lambda text: sql(text, o)
    sup = lambda text: sql(text, s)
    linear = linear_chain(o, [1, 4])
    lin = lambda text: sql(text, linear)
    reversion = f"""SELECT series_id, n, half_up(-slope, 6) AS theta, half_up(level + base / -slope, 2) AS mean,
        half_up(sqrt((ss - base * s - slope * xs) / (n - 2)), 2) AS sigma, CASE WHEN slope < 0 THEN half_up(ln(2::DOUBLE) / -slope, 4) END AS half_life
      FROM (SELECT *, (s - slope * xd) / d AS base FROM (SELECT *, (d * xs - xd * s) / (d * xxd - xd * xd) AS slope
        FROM (SELECT series_id, any_value(level) AS level, count(*) AS n, sum(d) AS d, sum(x * d) AS xd, sum(x * x * d) AS xxd, sum(s) AS s, sum(x * s) AS xs, sum(s * s / d) AS ss
          FROM (SELECT series_id, level, d, before - level AS x, close - before AS s
            FROM (SELECT series_id, close, avg(close) OVER {S} AS level, lag(close) OVER ({W}) AS before, (date - lag(date) OVER ({W}))::DOUBLE AS d FROM bars)) WHERE d > 0 GROUP BY 1)))"""
    layout = """SELECT series_id, kind, CASE kind WHEN 0 THEN 'Date,Close,Open,Volume,series_id' WHEN 1 THEN 'series_id,volume,open,close,date' ELSE 'Date,series_id,Adj Close,Close' END AS header
      FROM (SELECT DISTINCT series_id, substr(series_id, 1, 1)::INTEGER % 3 AS kind FROM bars)"""
    bars = f"SELECT series_id, date, {', '.join(BARS)} FROM "
    junk = """CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 THEN NULL ELSE o_orderdate::DATE END"""
    period = """CASE WHEN o_orderkey % 7 = 0 THEN year(o_orderdate)::VARCHAR
        WHEN o_orderkey % 11 = 0 THEN year(o_orderdate)::VARCHAR || '-Q5' WHEN o_orderkey % 13 = 0 THEN ''
        ELSE year(o_orderdate)::VARCHAR || '-Q' || quarter(o_orderdate)::VARCHAR END"""
    unknown_missing = "SELECT series_id, area, pos FROM areas WHERE area NOT IN (SELECT area FROM macro_obs)"
    picks = ", ".join(f"avg(CASE WHEN area = '{a}' THEN value END) AS m{i}" for i, a in enumerate(B.AREAS))
    wide = ", ".join(f"max(CASE WHEN series_id = '{p}' THEN close END) AS \"close_{p}\"" for p in B.PRIORITIES)
    panel_cols = ", ".join(["series_id", "date", "year", "month", "quarter", "day_name", *BARS]) + ", " + rs(MACRO) + ", n_areas"
    prepared_cols = panel_cols + ", decompose_status, " + rs(["day_of_week", "sin_month", "cos_month", *NOISE, "seasonal_adjusted_close"])
    decomposed = "SELECT series_id, date, close, " + rs(["trend", "seasonal", "resid"]) + ", decompose_status FROM decomposed"
    board = (
        "SELECT series_id, rank::INTEGER AS rank, params_str AS parameters, half_up(val_loss, 6) AS mean_mse, "
        "half_up(sqrt(val_loss), 6) AS rmse, half_up(val_r2, 6) AS r2 FROM ranked"
    )
    ranked = lambda scores: board.replace("FROM ranked", f"FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY val_loss, trial_id) AS rank FROM {scores})")
    trial_cols = "SELECT series_id, trial_id, family, params_str, half_up(val_loss, 6) AS val_loss, half_up(val_r2, 6) AS val_r2 FROM "
    unit = "pow(10::DOUBLE, floor(log10(avg(pow(actual - predicted, 2)))) - 6)"
    metrics = f"""SELECT series_id, count(*) AS n, floor(avg(pow(actual - predicted, 2)) / {unit} + 0.5::DOUBLE) * {unit} AS mse,
        {r('sqrt(avg(pow(actual - predicted, 2)))', None, 'rmse')},
        half_up(1 - avg(pow(actual - predicted, 2)) / var_pop(actual), 6) AS r2 FROM forecast GROUP BY 1"""
    frame_cols = lambda cols, **d: "SELECT series_id, date, " + rs(cols, ma_5=4, **d) + ", n_areas, target FROM "
    scores = f"SELECT series_id, feature_pos, feature, {r('f_score')} FROM scores"
    names = FULL + ["target"]
    corr = " UNION ALL ".join(
        f"""SELECT series_id, '{a}' AS a, '{b}' AS b, CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN
          half_up(covar_pop({a}, {b}) / sqrt(var_pop({a}) * var_pop({b})), 6) END AS r
          FROM (SELECT series_id, CASE WHEN {b} IS NOT NULL THEN {a}::DOUBLE END AS {a}{'' if a == b else f', CASE WHEN {a} IS NOT NULL THEN {b}::DOUBLE END AS {b}'} FROM frame) GROUP BY 1"""
        for a in names
        for b in names
    )
    family = values([(t.trial_id, t.family, t.text) for t in TRIALS])
    listed = "SELECT series_id, trial_id, family, params_str FROM (SELECT DISTINCT o_orderpriority AS series_id FROM orders) CROSS JOIN ({}) AS t(trial_id, family, params_str)"
    asof_areas = values([(p, a[0]) for p, a in B.PRIORITY_AREAS.items()])
    report = f"""SELECT series_id, date, 'train' AS kind, half_up(target, 3) AS value FROM numbered WHERE t >= {L} AND t < n - {H}
      UNION ALL SELECT series_id, date, 'actual', half_up(actual, 3) FROM forecast
      UNION ALL SELECT series_id, date, 'predicted', half_up(predicted, 3) FROM forecast"""
    components = " UNION ALL ".join(
        f"SELECT series_id, date, '{n}' AS component, half_up({c}, 5) AS value FROM decomposed"
        for n, c in [("observed", "close"), ("trend", "trend"), ("seasonal", "seasonal"), ("resid", "resid")]
    )
    found = {
        "ohlcv_daily": q(bars + "bars"),
        "ohlcv_events": f"""SELECT event_type AS series_id, ts::DATE AS date, half_up((min({{'a': ts, 'b': event_id, 'c': value}})).c, 6) AS open,
            half_up(max(value), 3) AS high, half_up(min(value), 3) AS low, half_up((max({{'a': ts, 'b': event_id, 'c': value}})).c, 6) AS close,
            count(*)::DOUBLE AS volume FROM events GROUP BY 1, 2""",
        "load_dated_table": q(
            """SELECT series_id, date, CASE WHEN day(date) % 13 <> 7 THEN open END AS open, high, low, close,
              CASE WHEN day(date) % 13 <> 5 THEN close END AS adj_close, volume FROM bars WHERE day(date) <> 31"""
        ),
        "rejected_cells": q(
            """SELECT series_id, count(*) AS n_rows, count(*) FILTER (day(date) = 31) AS n_undated,
              count(*) FILTER (day(date) % 13 IN (5, 7)) + count(*) FILTER (day(date) = 31) AS n_rejected_cells FROM bars GROUP BY 1"""
        ),
        "file_layouts": q(
            f"""SELECT header, 'wrong_cells' AS status, count(DISTINCT series_id) AS n_files, count(*) AS n_lines, count(*) FILTER (day(date) IN (13, 14)) AS n_wrong
              FROM ({layout}) JOIN bars USING (series_id) GROUP BY 1 UNION ALL SELECT NULL, 'unreadable', 1, 0, 0"""
        ),
        "load_layouts": q(
            f"""SELECT series_id, date, CASE WHEN kind < 2 THEN open END AS open, close, CASE WHEN kind = 2 THEN close END AS adj_close, CASE WHEN kind < 2 THEN volume END AS volume
              FROM ({layout}) JOIN bars USING (series_id) WHERE day(date) NOT IN (13, 14)"""
        ),
        "rejected_lines": q(
            """SELECT CASE WHEN day(date) NOT IN (13, 14) THEN series_id END AS series_id, count(*) AS n_rows, count(*) FILTER (day(date) IN (13, 14)) AS n_undated,
              count(*) FILTER (day(date) IN (13, 14)) AS n_rejected_cells FROM bars GROUP BY 1"""
        ),
        "restarted_sink": q("SELECT year(date)::INTEGER AS span, count(*) AS n_rows, min(date) AS first_day, max(date) AS last_day, true AS intact FROM bars GROUP BY 1"),
        "macro_sink": sql("SELECT series_id, date, obs_year, obs_quarter, " + rs(MACRO) + " FROM macro_days", u),
        "sink_order": q("SELECT year(date)::INTEGER AS span, count(*) AS n_rows, 0::BIGINT AS n_inside, 0::BIGINT AS n_across FROM bars GROUP BY 1"),
        "combined_sink": q(f"SELECT {panel_cols} FROM panel"),
        "results_sink": q(board),
        "normalize_bars": f"""SELECT series_id, strftime(date, '%Y-%m-%d') AS date, year(date)::INTEGER AS year, month(date)::INTEGER AS month,
            dayname(date) AS day_name, p AS open, p AS high, p AS low, p AS close, 1::DOUBLE AS volume
          FROM (SELECT o_orderpriority AS series_id, {junk} AS date, o_totalprice AS p FROM orders) WHERE date IS NOT NULL""",
        "calendar_densify": q(bars + "dense"),
        "forward_fill": q(bars + "filled"),
        "calendar_columns": q(
            """SELECT series_id, date, year(date)::INTEGER AS year, month(date)::INTEGER AS month, quarter(date)::INTEGER AS quarter,
              dayname(date) AS day_name, (isodow(date) - 1)::INTEGER AS day_of_week FROM dense"""
        ),
        "seasonal_features": q(
            f"""SELECT series_id, date, month(date)::INTEGER AS month, (isodow(date) - 1)::INTEGER AS day_of_week,
              quarter(date)::INTEGER AS quarter, half_up(sin(month(date) * ({TWO_PI} / 12)), 6) AS sin_month,
              half_up(cos(month(date) * ({TWO_PI} / 12)), 6) AS cos_month FROM dense"""
        ),
        "macro_filter": q(
            "SELECT date, year, quarter, area, half_up(value, 6) AS value FROM macro_obs "
            "WHERE area IN ('AMERICA', 'ASIA', 'EUROPE') AND date >= DATE '1997-01-01'"
        ),
        "macro_period_parse": f"""SELECT o_orderkey, period, date, year(date)::INTEGER AS year, quarter(date)::INTEGER AS quarter,
            date IS NULL AS rejected
          FROM (SELECT o_orderkey, period, {period_date('period')} AS date FROM (SELECT o_orderkey, {period} AS period FROM orders))""",
        "macro_pivot": q(
            "SELECT date, year, quarter, "
            + ", ".join(f"half_up(m{i}, 6) AS macro_{a.replace(' ', '_')}" for i, a in enumerate(B.AREAS))
            + f" FROM (SELECT date, year, quarter, {picks} FROM nation_obs GROUP BY ALL)"
        ),
        "macro_for_series": sql("SELECT series_id, date, obs_year, obs_quarter, " + rs(MACRO) + " FROM macro_days", u),
        "missing_areas": sql(unknown_missing, u),
        "macro_asof": q(
            f"""SELECT t.o_orderkey, t.area, t.date, half_up(o.value, 6) AS value
              FROM (SELECT o_orderkey, coalesce(area, '{B.BASE_AREA}') AS area, o_orderdate::DATE AS date FROM orders
                    LEFT JOIN (VALUES {asof_areas}) AS m(p, area) ON o_orderpriority = p) t
              ASOF LEFT JOIN macro_obs o ON t.area = o.area AND t.date >= o.date"""
        ),
        "asof_hot": sup(
            f"""SELECT t.o_orderkey, t.key, t.date, r.close
              FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'hot' ELSE o_orderpriority END AS key, o_orderdate::DATE AS date FROM orders) t
              ASOF LEFT JOIN (SELECT CASE WHEN series_id::BIGINT % 2 = 0 THEN 'hot' ELSE [{', '.join(f"'{p}'" for p in B.PRIORITIES)}][(series_id::BIGINT // 2) % 5 + 1] END AS key, date, max(close) AS close
                FROM bars GROUP BY 1, 2) r ON t.key = r.key AND t.date >= r.date"""
        ),
        "sdmx_observations": q("SELECT date, year, quarter, area, half_up(value, 6) AS value FROM macro_obs"),
        "combined_panel": q(f"SELECT {panel_cols} FROM panel"),
        "incremental_panel": q(f"SELECT {panel_cols} FROM panel"),
        "closing_prices": q("SELECT series_id, date, close FROM panel"),
        "wide_close": q(f"SELECT date, {wide} FROM filled GROUP BY date"),
        "last_n_years": q(
            f"SELECT series_id, date, close FROM (SELECT *, max(date) OVER {S} AS d FROM closes) WHERE date >= (d - INTERVAL 3 YEAR)::DATE"
        ),
        "lag_features": q(
            f"SELECT series_id, date, close, lag(close, 7) OVER ({W}) AS close_lag_7, lag(close, 30) OVER ({W}) AS close_lag_30 FROM closes"
        ),
        "ma5": q(
            f"""SELECT series_id, date, close, CASE WHEN count(close) OVER f = 5 THEN half_up(avg(close) OVER f, 4) END AS ma_5
              FROM closes WINDOW f AS ({W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""
        ),
        "seasonal_decompose": q(decomposed),
        "decomposition_report": q(components),
        "seasonal_adjusted": q("SELECT series_id, date, close, half_up(close / seasonal, 3) AS seasonal_adjusted_close FROM decomposed"),
        "close_moments": q("SELECT series_id, n, " + rs(["total", "mean", "std"]) + " FROM moments"),
        "price_entropy": q("SELECT series_id, date, close, half_up(entropy, 6) AS entropy FROM closes JOIN entropies USING (series_id)"),
        "random_component": q("SELECT series_id, date, close, " + r("random_component") + " FROM closes JOIN noise USING (series_id, date)"),
        "ou_noise": q("SELECT series_id, date, close, " + r("ou_simulated") + " FROM closes JOIN ou USING (series_id, date)"),
        "mean_reversion": q(reversion),
        "long_series": """SELECT *, CASE WHEN count(filled) OVER five = 5 THEN half_up(avg(filled) OVER five, 4) END AS ma_5,
              CASE WHEN count(filled) OVER year = 253 THEN half_up((sum(filled) OVER year - (lag(filled, 126) OVER w + lead(filled, 126) OVER w) / 2::DOUBLE) / 252::DOUBLE, 5) END AS trend
            FROM (SELECT 'all' AS series_id, ts, event_id, row_number() OVER w - 1 AS t, last_value(cents IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS filled,
                  (sum(cents) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT AS running
                FROM (SELECT *, CASE WHEN event_id % 7 > 0 THEN round(value * 100)::BIGINT END AS cents FROM events) WINDOW w AS (ORDER BY ts, event_id))
            WINDOW w AS (ORDER BY t), five AS (ORDER BY t ROWS 4 PRECEDING), year AS (ORDER BY t ROWS BETWEEN 126 PRECEDING AND 126 FOLLOWING)""",
        "prepared_panel": q(f"SELECT {prepared_cols} FROM prepared"),
        "feature_frame": q(frame_cols(FULL) + "frame"),
        "feature_frame_strict": q(frame_cols(STRICT) + "frame_strict"),
        "feature_frame_basic": q(frame_cols(BASIC) + "frame_basic"),
        "series_status": sql(
            f"""SELECT series_id, n_days, coalesce(n_features, 0) AS n_features, coalesce(n_features, 0) - {H + L} AS train_size,
              CASE WHEN coalesce(n_features, 0) = 0 THEN 'no_features' WHEN n_features <= {H + L} THEN 'not_enough_train' ELSE 'ok' END AS status
            FROM (SELECT series_id, count(*) AS n_days FROM closes GROUP BY 1)
            LEFT JOIN (SELECT series_id, count(*) AS n_features FROM frame GROUP BY 1) USING (series_id)""",
            u,
        ),
        "correlation_matrix": q(corr),
        "selected_correlation": q(
            f"""SELECT c.* FROM ({corr}) c
              WHERE (a = 'target' OR EXISTS (SELECT 1 FROM top t WHERE t.series_id = c.series_id AND t.feature = a))
                AND (b = 'target' OR EXISTS (SELECT 1 FROM top t WHERE t.series_id = c.series_id AND t.feature = b))"""
        ),
        "feature_f_scores": q(scores),
        "feature_ranks": q(f"SELECT series_id, feature_pos, feature, {r('f_score')}, f_rank::INTEGER AS f_rank FROM top"),
        "select_k_best": q(
            "SELECT l.series_id, date, feature, half_up(value, 3) AS value FROM long_frame l JOIN top USING (series_id, feature)"
        ),
        "scale_standard": q(_scaled("standard")),
        "scale_minmax": q(_scaled("normalize")),
        "scale_robust": q(_scaled("robust")),
        "inverse_scale": q("SELECT series_id, date, half_up(y, 6) AS scaled, half_up(y * sd + mu, 3) AS restored FROM scaled"),
        "train_val_split": q(
            f"""SELECT series_id, date, t::INTEGER AS t, n::INTEGER AS n, train_size::INTEGER AS train_size, t < n - {H} AS is_train,
              t >= train_size AS is_val, t >= {L} AND t < n - {H} AS is_train_target, t >= n - {H} AS is_val_target FROM numbered"""
        ),
        "sequences": _sequence_sql(o),
        "grid_trials": listed.format(f"VALUES {family}"),
        "grid_product": listed.format(NETWORKS),
        "grid_scores": q(trial_cols + "trial_scores"),
        "loss_curves": lin("SELECT series_id, trial_id, family, params_str, iteration, half_up(train_loss, 6) AS train_loss, half_up(val_loss, 6) AS val_loss FROM curves"),
        "best_iteration": lin(
            """SELECT series_id, trial_id, arg_min(iteration, (val_loss, iteration)) AS best_iteration, half_up(min(val_loss), 6) AS best_loss FROM curves GROUP BY 1, 2"""
        ),
        "early_stopping": lin(
            "SELECT series_id, trial_id, family, params_str, stopped_at, best_iteration, half_up(train_loss, 6) AS train_loss, half_up(val_loss, 6) AS val_loss FROM stopped"
        ),
        "trained_grid": lin(ranked("trained_scores")),
        "ridge_grid": lin(ranked("ridge_scores")),
        "joint_leaderboard": lin(
            ranked(
                """(SELECT * FROM trial_scores UNION ALL SELECT series_id, trial_id + 11, family, params_str, val_loss, val_r2 FROM ridge_scores
                  UNION ALL SELECT series_id, trial_id + 15, family, params_str, val_loss, val_r2 FROM trained_scores)"""
            )
        ),
        "supplier_ridge_grid": sql(ranked("ridge_scores"), linear_chain(s, [1])),
        "best_per_family": q(
            trial_cols
            + "(SELECT *, row_number() OVER (PARTITION BY series_id, family ORDER BY val_loss, trial_id) AS k FROM trial_scores) WHERE k = 1"
        ),
        "best_trial": q(trial_cols + "best"),
        "best_forecast": q(
            "SELECT series_id, date, trial_id, family, params_str, half_up(actual, 6) AS actual, half_up(predicted, 6) AS predicted FROM chosen"
        ),
        "grid_leaderboard": q(board),
        "smooth_predictions": q("SELECT series_id, date, half_up(actual, 3) AS actual, half_up(predicted, 3) AS predicted FROM forecast"),
        "forecast_metrics": q(metrics),
        "forecast_counts": q(f"SELECT series_id, {H}::BIGINT AS n_targets, count(*) AS n_predictions, count(DISTINCT date) AS n_days FROM forecast GROUP BY 1"),
        "residuals": q("SELECT series_id, date, " + r("residual") + " FROM resids"),
        "residual_histogram": q(
            """SELECT b.series_id, i::INTEGER AS bin, half_up(lo + (i - 1) * ((hi - lo) / 30), 3) AS low,
              half_up(lo + i * ((hi - lo) / 30), 3) AS high, coalesce(n, 0) AS n
            FROM (bounds b CROSS JOIN (SELECT unnest(range(1, 31)) AS i))
            LEFT JOIN (SELECT series_id, bin, count(*) AS n FROM binned GROUP BY ALL) c ON b.series_id = c.series_id AND i = bin"""
        ),
        "forecast_report": q(report),
        "supplier_bars": sup(bars + "bars"),
        "supplier_combined_panel": sup(f"SELECT {panel_cols} FROM panel"),
        "supplier_mean_reversion": sup(reversion),
        "supplier_quartiles": sup(
            " UNION ALL ".join(
                f"""SELECT series_id, '{c}' AS "column", count({c}) AS n, half_up(quantile_cont({c}, 0.25), 4) AS q1, half_up(quantile_cont({c}, 0.5), 4) AS median,
                  half_up(quantile_cont({c}, 0.75), 4) AS q3 FROM bars GROUP BY 1"""
                for c in ("close", "volume")
            )
        ),
        "supplier_seasonal_decompose": sup(decomposed),
        "supplier_feature_frame": sup(frame_cols(FULL, seasonal_adjusted_close=2, random_component=2, ou_simulated=2) + "frame"),
        "supplier_f_scores": sup(scores),
        "supplier_correlation_matrix": sup(corr),
        "supplier_sequences": _sequence_sql(s),
        "supplier_scale_standard": sup(_scaled("standard")),
        "supplier_grid_leaderboard": sup(board),
        "supplier_forecast_metrics": sup(metrics),
    }
    return {name: _half_up(text) for name, text in found.items()}
