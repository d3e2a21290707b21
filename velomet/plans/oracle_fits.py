"""Plain SQL for the fitted models: long-form designs, a sweep to invert, sums for the errors."""

from __future__ import annotations

from velomet.fixed_values import (
    CLIMATOLOGY_DRIVERS,
    DAYPARTS,
    EFFECT_GROUPS,
    HAC_MAX_LAGS,
    MODEL_TEMP_EDGES,
    MODEL_TEMP_LABELS,
    MODEL_TEMP_REFERENCE,
    RAIN_EDGES,
    RAIN_LABELS,
)


def _long(frame: str, numbers: list[str], levels: dict[str, str | None]) -> str:
    """Rows (t, g, c, v); a level equal to its reference gets no column."""
    parts = [f"SELECT t, g, '{c}' AS c, CAST({c} AS DOUBLE) AS v FROM {frame}" for c in numbers]
    for c, reference in levels.items():
        keep = "" if reference is None else f" WHERE CAST({c} AS VARCHAR) <> '{reference}'"
        parts.append(f"SELECT t, g, '{c}=' || {c}, 1.0::DOUBLE FROM {frame}{keep}")
    return " UNION ALL ".join(parts)


def fit(p: str, frame: str, numbers: list[str], levels: dict[str, str | None]) -> dict[str, str]:
    """CTEs from a frame (t, g, y, columns) to ``<p>beta`` (c, b) and ``<p>inv`` (c1, c2, x).

    The symmetric sweep inverts in place; a column that depends on earlier ones has no pivot left
    and is set to zero, which no estimable contrast notices.
    """
    ctes = {
        f"{p}long": _long(frame, numbers, levels),
        f"{p}col": f"SELECT c, row_number() OVER (ORDER BY c) AS k FROM (SELECT DISTINCT c FROM {p}long)",
        f"{p}n": f"SELECT g, count(*) AS n, sum(y) AS y FROM {frame} GROUP BY g",
        f"{p}sum": f"SELECT g, c, sum(v) AS v FROM {p}long GROUP BY g, c",
        f"{p}gram": f"""SELECT c1, c2, sum(x) AS x FROM (
            SELECT a.c AS c1, b.c AS c2, a.v * b.v AS x FROM {p}long a JOIN {p}long b ON a.t = b.t
            UNION ALL SELECT a.c, b.c, -a.v * b.v / n.n FROM {p}sum a JOIN {p}sum b ON a.g = b.g JOIN {p}n n ON n.g = a.g) GROUP BY 1, 2""",
        f"{p}xy": f"""SELECT c, sum(x) AS x FROM (
            SELECT l.c, l.v * f.y AS x FROM {p}long l JOIN {frame} f ON f.t = l.t
            UNION ALL SELECT s.c, -s.v * n.y / n.n FROM {p}sum s JOIN {p}n n ON n.g = s.g) GROUP BY 1""",
        f"{p}start": f"""SELECT list(cells ORDER BY k) AS m, list(d ORDER BY k) AS d0, max(k) AS size FROM (
            SELECT a.k, list(COALESCE(x.x, 0.0) ORDER BY b.k) AS cells, max(CASE WHEN a.k = b.k THEN x.x END) AS d
            FROM {p}col a CROSS JOIN {p}col b LEFT JOIN {p}gram x ON x.c1 = a.c AND x.c2 = b.c GROUP BY a.k)""",
        f"{p}sweep": f"""SELECT 1 AS k, m, d0, size FROM {p}start UNION ALL
            SELECT k + 1, list_transform(generate_series(1, size), lambda i: list_transform(generate_series(1, size), lambda j:
                CASE WHEN m[k][k] <= 1e-9 * d0[k] THEN CASE WHEN i = k OR j = k THEN 0.0 ELSE m[i][j] END
                     WHEN i = k AND j = k THEN -1.0 / m[k][k]
                     WHEN i = k THEN m[k][j] / m[k][k] WHEN j = k THEN m[i][k] / m[k][k]
                     ELSE m[i][j] - m[i][k] * m[k][j] / m[k][k] END)), d0, size
            FROM {p}sweep WHERE k <= size""",
        f"{p}inv": f"""SELECT a.c AS c1, b.c AS c2, -s.m[a.k][b.k] AS x FROM {p}col a CROSS JOIN {p}col b
            CROSS JOIN (SELECT m FROM {p}sweep WHERE k = size + 1) s""",
        f"{p}beta": f"SELECT i.c1 AS c, sum(i.x * x.x) AS b FROM {p}inv i JOIN {p}xy x ON x.c = i.c2 GROUP BY 1",
    }
    return ctes


def influences(p: str, frame: str, contrasts: str) -> dict[str, str]:
    """CTEs to ``<p>psi`` (label, t, g, psi) and ``<p>point`` for contrasts (label, c, w)."""
    return {
        f"{p}con": contrasts,
        f"{p}point": f"SELECT q.label, sum(q.w * COALESCE(b.b, 0)) AS b FROM {p}con q LEFT JOIN {p}beta b ON b.c = q.c GROUP BY 1",
        f"{p}a": f"SELECT q.label, i.c1 AS c, sum(i.x * q.w) AS a FROM {p}con q JOIN {p}inv i ON i.c2 = q.c GROUP BY 1, 2",
        f"{p}res": f"""SELECT t, g, e - avg(e) OVER (PARTITION BY g) AS u FROM (
            SELECT f.t, f.g, f.y - s.s AS e FROM {frame} f JOIN (SELECT l.t, sum(l.v * b.b) AS s FROM {p}long l JOIN {p}beta b ON b.c = l.c GROUP BY 1) s ON s.t = f.t)""",
        f"{p}h": f"""SELECT label, t, g, h - avg(h) OVER (PARTITION BY label, g) AS h FROM (
            SELECT a.label, l.t, l.g, sum(l.v * a.a) AS h FROM {p}long l JOIN {p}a a ON a.c = l.c GROUP BY 1, 2, 3)""",
        f"{p}psi": f"SELECT h.label, h.t, h.g, h.h * r.u AS psi FROM {p}h h JOIN {p}res r ON r.t = h.t",
    }


def hac(p: str) -> dict[str, str]:
    behind = " + ".join(
        f"{(HAC_MAX_LAGS + 1 - k)}::DOUBLE / {HAC_MAX_LAGS + 1} * COALESCE(lag(psi, {k}) OVER (PARTITION BY label ORDER BY t), 0)"
        for k in range(1, HAC_MAX_LAGS + 1)
    )
    return {f"{p}var": f"SELECT label, sum(psi * (psi + 2 * w)) AS v FROM (SELECT label, psi, {behind} AS w FROM {p}psi) GROUP BY 1"}


def clustered(p: str, frame: str, columns: str) -> dict[str, str]:
    return {
        f"{p}var": f"""SELECT label, sum(s * s) * max(f) AS v FROM (SELECT label, g, sum(psi) AS s FROM {p}psi GROUP BY 1, 2)
            CROSS JOIN (SELECT count(DISTINCT g)::DOUBLE / (count(DISTINCT g) - 1) * (count(*) - 1) / (count(*) - ({columns})) AS f FROM {frame}) GROUP BY 1"""
    }


def ends(r, digits: int = 4) -> str:
    """Effect and interval in percent; no interval where the variance is not a number."""
    se = "CASE WHEN v >= 0 AND NOT isnan(v) THEN sqrt(v) END"
    return ", ".join(
        f"{r(f'(exp(b{shift}) - 1) * 100', digits)} AS {name}"
        for name, shift in (("pct", ""), ("lo", f" - 1.96::DOUBLE * {se}"), ("hi", f" + 1.96::DOUBLE * {se}"))
    )


def _calendar(outcome: str) -> str:
    return f"""date AS t, year(date) * 12 + month(date) AS g, ln({outcome}) AS y, isodow(date) - 1 AS dow,
        CASE WHEN date IN (SELECT h FROM holiday_list) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS holiday"""


def impact_ctes(band) -> dict[str, str]:
    rain = band("prcp_inches", RAIN_EDGES, RAIN_LABELS)
    dry = band("COALESCE(prcp_inches, 0)", RAIN_EDGES, RAIN_LABELS)
    frame = f"""SELECT {_calendar('num_nyc_trips')}, {band('tavg_f', MODEL_TEMP_EDGES, MODEL_TEMP_LABELS)} AS temp_band, {rain} AS rain_band,
        COALESCE(snow_inches, 0) AS snow_inches, COALESCE(snow_depth_inches, 0) AS snow_depth_inches, wind_avg_mph,
        COALESCE(is_thunder, 0) AS is_thunder, COALESCE(is_foggy, 0) AS is_foggy
      FROM joined WHERE date IS NOT NULL AND num_nyc_trips > 0 AND tavg_f IS NOT NULL AND wind_avg_mph IS NOT NULL AND prcp_inches IS NOT NULL"""
    groups = EFFECT_GROUPS
    rows = [
        f"SELECT '{b}°F' AS label, '{groups['temperature']}' AS grp, 'temp_band={b}' AS c, 1.0::DOUBLE AS w"
        for b in MODEL_TEMP_LABELS if b != MODEL_TEMP_REFERENCE
    ]
    rows += [f"SELECT '{b} rain', '{groups['rain']}', 'rain_band={b}', 1.0" for b in RAIN_LABELS[1:]]
    rows += [
        f"SELECT 'typical snow day', '{groups['snow']}', '{c}', (SELECT avg({c}) FROM imp WHERE {c} > 0)"
        for c in ("snow_inches", "snow_depth_inches")
    ]
    rows += [
        f"""SELECT 'windy day (~' || CAST(round_even((SELECT avg(wind_avg_mph) FROM imp WHERE wind_avg_mph >= 10), 0) AS INTEGER) || ' mph)', '{groups['wind']}', 'wind_avg_mph',
            (SELECT avg(wind_avg_mph) FROM imp WHERE wind_avg_mph >= 10) - (SELECT avg(wind_avg_mph) FROM imp)""",
        f"SELECT 'thunderstorm', '{groups['storms']}', 'is_thunder', 1.0",
        f"SELECT 'fog', '{groups['storms']}', 'is_foggy', 1.0",
    ]
    numbers = ["holiday", "snow_inches", "snow_depth_inches", "wind_avg_mph", "is_thunder", "is_foggy"]
    ctes = {"imp": frame}
    ctes |= fit("imp_", "imp", numbers, {"dow": "0", "temp_band": MODEL_TEMP_REFERENCE, "rain_band": "dry"})
    ctes |= influences("imp_", "imp", " UNION ALL ".join(rows)) | hac("imp_")
    ctes |= fit("ctl_", "imp", ["holiday"], {"dow": "0"})
    warm = f"""SELECT {_calendar('num_nyc_trips')}, {dry} AS rain_band, tavg_f, dewpoint_f, wind_avg_mph
      FROM joined WHERE date IS NOT NULL AND num_nyc_trips > 0 AND tavg_f >= 68 AND dewpoint_f IS NOT NULL AND wind_avg_mph IS NOT NULL"""
    ctes |= {"hum": warm}
    ctes |= fit("hum_", "hum", ["holiday", "tavg_f", "dewpoint_f", "wind_avg_mph"], {"dow": "0", "rain_band": "dry"})
    ctes |= influences(
        "hum_", "hum",
        "SELECT 'per_F' AS label, 'dewpoint_f' AS c, 1.0::DOUBLE AS w UNION ALL SELECT 'ten', 'dewpoint_f', 10.0",
    ) | hac("hum_")
    return ctes


def impacts_sql(r) -> str:
    return f"""SELECT p.label, g.grp AS "group", {ends(r)} FROM imp_point p JOIN imp_var v ON v.label = p.label
        JOIN (SELECT DISTINCT label, grp FROM imp_con) g ON g.label = p.label
      UNION ALL SELECT '+10°F muggier (warm days)', '{EFFECT_GROUPS['humidity']}', {ends(r)} FROM hum_point p JOIN hum_var v ON v.label = p.label
        WHERE p.label = 'ten' AND (SELECT count(*) FROM hum) >= 100"""


def humidity_sql(r) -> str:
    return f"""SELECT {r('(exp((SELECT b FROM hum_point WHERE label = $$per_F$$)) - 1) * 100', 4)} AS "per_F", pct AS p10, lo AS lo10, hi AS hi10, (SELECT count(*) FROM hum) AS n
      FROM (SELECT {ends(r)} FROM hum_point p JOIN hum_var v ON v.label = p.label WHERE p.label = 'ten') WHERE (SELECT count(*) FROM hum) >= 100"""


LEADS = [("rain_lead2", 2), ("rain_lead1", 1), ("is_raining", 0), ("rain_lag1", -1), ("rain_lag2", -2), ("rain_lag3", -3), ("rain_lag4", -4)]


def _hour_frame(outcome: str) -> str:
    picks = ", ".join(f"x{k + 4}.is_raining AS {name}" for name, k in LEADS)
    joins = " ".join(f"LEFT JOIN hour_joined x{k + 4} ON x{k + 4}.hour_ts = h.hour_ts + to_hours({k})" for _, k in LEADS)
    parts = ", ".join(f"h.is_raining * CASE WHEN h.hour BETWEEN {a} AND {b} THEN 1 ELSE 0 END AS rain_{a}_{b}" for a, b, _ in DAYPARTS)
    return f"""SELECT h.hour_ts AS t, h.date AS g, ln(h.{outcome}) AS y, h.hour || '_' || CASE WHEN isodow(h.date) >= 6 THEN 1 ELSE 0 END AS hw,
        {picks}, h.is_snowing, CASE WHEN h.is_raining = 1 AND h.prcp_inches >= 0.10 THEN 1 ELSE 0 END AS heavy_rain, {parts}
      FROM hour_joined h {joins} WHERE h.{outcome} > 0"""


def hourly_ctes() -> dict[str, str]:
    ctes: dict[str, str] = {}
    names = [n for n, _ in LEADS]
    ctes["pro_all"] = _hour_frame("num_nyc_trips")
    ctes["pro"] = "SELECT * FROM pro_all WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in [*names, "is_snowing"])
    ctes |= fit("pro_", "pro", [*names, "is_snowing"], {"hw": None})
    single = [f"SELECT '{c}' AS label, '{c}' AS c, 1.0::DOUBLE AS w" for c in names]
    after = [f"SELECT 'all', '{c}', 1.0::DOUBLE" for c, at in LEADS if at <= 0]
    ctes |= influences("pro_", "pro", " UNION ALL ".join(single + after))
    ctes |= clustered("pro_", "pro", f"{len(names) + 1} + (SELECT count(DISTINCT hw) FROM pro_all) - 1")
    bands = [f"rain_{a}_{b}" for a, b, _ in DAYPARTS]
    for p, outcome in (("mem", "num_member_trips_nyc"), ("cas", "num_casual_trips_nyc")):
        ctes[f"{p}_all"] = _hour_frame(outcome)
        ctes[p] = f"SELECT * FROM {p}_all WHERE is_raining IS NOT NULL AND is_snowing IS NOT NULL"
        ctes |= fit(f"{p}_", p, [*bands, "heavy_rain", "is_snowing"], {"hw": None})
        parts = [f"SELECT '{label}' AS label, 'rain_{a}_{b}' AS c, 1.0::DOUBLE AS w" for a, b, label in DAYPARTS]
        ctes |= influences(f"{p}_", p, " UNION ALL ".join([*parts, "SELECT 'heavy', 'heavy_rain', 1.0::DOUBLE"]))
        ctes |= clustered(f"{p}_", p, f"{len(bands) + 2} + (SELECT count(DISTINCT hw) FROM {p}_all) - 1")
    return ctes


def profile_sql(r) -> str:
    k = " ".join(f"WHEN '{name}' THEN {-at}" for name, at in LEADS)
    return f"SELECT CAST(CASE p.label {k} END AS INTEGER) AS k, {ends(r)} FROM pro_point p JOIN pro_var v ON v.label = p.label WHERE p.label <> 'all'"


def totals_sql(r) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS effect, {ends(r)}, (SELECT count(*) FROM {p}) AS n, (SELECT count(DISTINCT g) FROM {p}) AS n_days "
        f"FROM {p}_point p JOIN {p}_var v ON v.label = p.label WHERE p.label = '{label}'"
        for name, p, label in (("hours 0 to 4", "pro", "all"), ("heavy rain, members", "mem", "heavy"))
    )


def squares(p: str, frame: str) -> str:
    """Residual squares of a fit, the absorbed means taken out."""
    return f"""(SELECT sum(u * u) FROM (SELECT e - avg(e) OVER (PARTITION BY g) AS u FROM (
        SELECT f.g, f.y - s.s AS e FROM {frame} f JOIN (SELECT l.t, sum(l.v * b.b) AS s FROM {p}long l JOIN {p}beta b ON b.c = l.c GROUP BY 1) s ON s.t = f.t)))"""


def impacts_meta_sql(r) -> str:
    return f"""SELECT n, {r('1 - controls / whole', 6)} AS r2_controls, {r('1 - rest / whole', 6)} AS r2_full, {r('(controls - rest) / controls', 6)} AS weather_partial_r2
      FROM (SELECT count(*) AS n, sum(y * y) - sum(y) * sum(y) / count(*) AS whole, {squares('ctl_', 'imp')} AS controls, {squares('imp_', 'imp')} AS rest FROM imp)"""


def daypart_sql(r) -> str:
    return " UNION ALL ".join(
        f"SELECT p.label AS daypart, {ends(r)}, '{rider}' AS rider FROM {p}_point p JOIN {p}_var v ON v.label = p.label WHERE p.label <> 'heavy'"
        for p, rider in (("mem", "Member"), ("cas", "Casual"))
    )


def _basis(x: str) -> list[str]:
    """Cubic basis functions 2 to 6 over the knots of the one-row CTE ``knots``."""
    t = ["lo"] * 4 + ["k1", "k2"] + ["hi"] * 4
    level = [
        None if t[i] == t[i + 1]
        else f"(CASE WHEN {x} >= {t[i]} AND {x} {'<=' if t[i + 1] == 'hi' else '<'} {t[i + 1]} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
        for i in range(9)
    ]
    for d in range(1, 4):
        level = [
            " + ".join(
                part
                for part in (
                    None if level[i] is None else f"({x} - {t[i]}) / ({t[i + d]} - {t[i]}) * {level[i]}",
                    None if level[i + 1] is None else f"({t[i + d + 1]} - {x}) / ({t[i + d + 1]} - {t[i + 1]}) * {level[i + 1]}",
                )
                if part
            )
            or None
            for i in range(len(level) - 1)
        ]
        level = [f"({c})" if c else None for c in level]
    return level[1:]


def adjusted_ctes() -> dict[str, str]:
    linear = [c for c in CLIMATOLOGY_DRIVERS if c != "tavg_f"]
    filled = ", ".join(f"COALESCE(d.{c}, n.{c}) AS {c}, n.{c} AS {c}_normal" for c in CLIMATOLOGY_DRIVERS)
    wide = ", ".join(f"max(value) FILTER (WHERE driver = '{c}') AS {c}" for c in CLIMATOLOGY_DRIVERS)
    spline = ", ".join(
        f"{e} AS bs{k}{tail}"
        for x, tail in (("tavg_f", ""), ("tavg_f_normal", "_normal"))
        for k, e in enumerate(_basis(x), 1)
    )
    numbers = ["holiday", *[f"bs{k}" for k in range(1, 6)], *linear]
    ctes = {
        "smooth": "SELECT a.driver, a.doy, avg(b.value) AS value FROM filled_slots a JOIN filled_slots b ON a.driver = b.driver AND (b.doy - a.doy + 7 + 366) % 366 <= 14 GROUP BY 1, 2",
        "normal_days": f"SELECT doy, {wide} FROM smooth GROUP BY doy",
        "kpi_filled": f"""SELECT {_calendar('d.y').replace('date', 'd.date')}, d.y AS actual, {filled}
            FROM kpi_days d LEFT JOIN normal_days n ON n.doy = dayofyear(d.date)""",
        "knots": "SELECT min(tavg_f) AS lo, max(tavg_f) AS hi, quantile_cont(tavg_f, 1.0 / 3) AS k1, quantile_cont(tavg_f, 2.0 / 3) AS k2 FROM kpi_filled",
        "kpi": f"SELECT f.*, {spline} FROM kpi_filled f CROSS JOIN knots",
    }
    ctes |= fit("kpi_", "kpi", numbers, {"dow": "0"})
    gaps = " UNION ALL ".join(
        f"SELECT t, '{c}' AS c, {c} - {c}_normal AS v FROM kpi" for c in [*[f"bs{k}" for k in range(1, 6)], *linear]
    )
    ctes["kpi_gap"] = f"SELECT q.t, sum(q.v * b.b) AS gap FROM ({gaps}) q JOIN kpi_beta b ON b.c = q.c GROUP BY 1"
    ctes["kpi_score"] = "SELECT l.t, sum(l.v * b.b) AS s FROM kpi_long l JOIN kpi_beta b ON b.c = l.c GROUP BY 1"
    return ctes


def adjusted_sql(r) -> str:
    return f"""SELECT k.t AS date, {r('k.actual', 6)} AS actual, {r('exp(s.s + avg(k.y - s.s) OVER (PARTITION BY k.g))', 6)} AS expected,
        {r('exp(q.gap) - 1', 6)} AS weather_effect, {r('k.actual / exp(q.gap)', 6)} AS adjusted
      FROM kpi k JOIN kpi_score s ON s.t = k.t JOIN kpi_gap q ON q.t = k.t"""


def lowess_ctes(points: int = 41, frac: str = "0.3", passes: int = 3, p_: str = "lo_") -> dict[str, str]:
    """Every pass written out: bandwidths, local lines at grid points, bisquare weights."""
    ctes = _lowess_ctes(points, frac, passes)
    if p_ == "lo_":
        return ctes
    return {k.replace("lo_", p_): v.replace("lo_", p_) for k, v in ctes.items()}


def _lowess_ctes(points: int, frac: str, passes: int) -> dict[str, str]:
    ctes = {
        "lo_rows": "SELECT row_number() OVER () AS id, date, season, tavg_f AS x, CAST(num_nyc_trips AS DOUBLE) AS y FROM joined WHERE date IS NOT NULL AND tavg_f IS NOT NULL AND season IS NOT NULL",
        "lo_span": f"SELECT season, min(x) AS lo, (max(x) - min(x)) / {points - 1} AS step, greatest(1, CAST(floor({frac}::DOUBLE * count(*) + 1e-10) AS BIGINT)) AS k FROM lo_rows GROUP BY 1",
        "lo_grid": f"SELECT season, j, lo + j * step AS g, lo, step, k FROM lo_span CROSS JOIN (SELECT unnest(generate_series(0, {points - 1})) AS j)",
        "lo_width": """SELECT season, j, g, lo, step, max(far) AS h FROM (
            SELECT q.*, abs(d.x - q.g) AS far, row_number() OVER (PARTITION BY q.season, q.j ORDER BY abs(d.x - q.g)) AS nth
            FROM lo_grid q JOIN lo_rows d ON d.season = q.season) WHERE nth <= k GROUP BY 1, 2, 3, 4, 5""",
        "lo_w0": "SELECT id, season, x, y, 1.0::DOUBLE AS r FROM lo_rows",
    }
    for p in range(passes + 1):
        ctes[f"lo_fit{p}"] = f"""SELECT season, j, g, lo, step, (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) AS fit FROM (
            SELECT season, j, g, lo, step, sum(w) AS s0, sum(w * d) AS s1, sum(w * d * d) AS s2, sum(w * y) AS t0, sum(w * d * y) AS t1 FROM (
              SELECT q.*, d.x - q.g AS d, d.y, CASE WHEN abs(d.x - q.g) < q.h THEN pow(1 - pow(abs(d.x - q.g) / q.h, 3), 3) * d.r ELSE 0 END AS w
              FROM lo_width q JOIN lo_w{p} d ON d.season = q.season) GROUP BY 1, 2, 3, 4, 5)"""
        if p < passes:
            ctes[f"lo_abs{p}"] = f"""SELECT d.id, d.season, d.x, d.y, abs(d.y - (a.fit + (b.fit - a.fit) * ((d.x - a.lo) / a.step - a.j))) AS a
                FROM lo_rows d JOIN lo_fit{p} a ON a.season = d.season AND a.j = least(greatest(CAST(floor((d.x - a.lo) / a.step) AS BIGINT), 0), {points - 2})
                JOIN lo_fit{p} b ON b.season = d.season AND b.j = a.j + 1"""
            ctes[f"lo_w{p + 1}"] = f"""SELECT q.id, q.season, q.x, q.y, CASE WHEN a < 6 * mad THEN pow(1 - pow(a / (6 * mad), 2), 2) ELSE 0 END AS r
                FROM lo_abs{p} q JOIN (SELECT season, median(a) AS mad FROM lo_abs{p} GROUP BY 1) m ON m.season = q.season"""
    return ctes


def lowess_fit_sql(r, p: str = "la_", passes: int = 3, points: int = 41) -> str:
    return f"""SELECT d.season, d.date, {r('d.x', 6)} AS x, {r('d.y', 6)} AS y, {r('a.fit + (b.fit - a.fit) * ((d.x - a.lo) / a.step - a.j)', 6)} AS fit
      FROM {p}rows d JOIN {p}fit{passes} a ON a.season = d.season AND a.j = least(greatest(CAST(floor((d.x - a.lo) / a.step) AS BIGINT), 0), {points - 2})
      JOIN {p}fit{passes} b ON b.season = d.season AND b.j = a.j + 1"""


def lowess_sql(r, passes: int = 3) -> str:
    return f"SELECT season, {r('g', 6)} AS x, {r('fit', 6)} AS fit FROM lo_fit{passes}"
