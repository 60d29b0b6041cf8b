"""DuckDB statements for the numerical queries: correlogram, unit-root test, components, spline.

Each solves its small system inside the database: recursive CTEs carry a list or matrix per series.
"""

from __future__ import annotations

from itertools import combinations

from panelkit.constants import CONFIDENCE_Z, PCA_VARIANCE_TARGET, SEASON, TRAIN_SHARE
from panelkit.operators import seasonal as SE
from panelkit.operators import tsstats as TS


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def rounded(expr: str) -> str:
    """Six digits, never a negative zero."""
    return f"CASE WHEN round({expr}, 6) = 0 THEN 0.0 ELSE round({expr}, 6) END"


# ------------------------------------------------------------------ partial autocorrelation
#: From ``ac (series_key, lag, acf, conf)``: the last coefficient of the autoregression of each order.
PACF_CTES = [
    "r0 AS MATERIALIZED (SELECT series_key, list(acf ORDER BY lag) AS r, any_value(conf) AS conf FROM ac GROUP BY 1)",
    """steps AS (
    SELECT series_key, conf, r, 0 AS k, []::DOUBLE[] AS phi, 1.0::DOUBLE AS left_var, NULL::DOUBLE AS x FROM r0
    UNION ALL
    SELECT series_key, conf, r, k + 1, list_append([phi[j] - x1 * phi[k + 1 - j] for j in range(1, k + 1)], x1),
           left_var * (1 - x1 * x1), x1
    FROM (SELECT *, (r[k + 1] - coalesce(list_sum([phi[j] * r[k + 1 - j] for j in range(1, k + 1)]), 0))
                    / left_var AS x1 FROM steps WHERE k < len(r)) s)"""]
PACF_SELECT = "SELECT series_key, CAST(k AS INTEGER) AS lag, round(x, 6) AS pacf, round(conf, 6) AS conf " \
              "FROM steps WHERE k > 0"


# ------------------------------------------------------------------ unit-root test
def _gram(name: str, rows: str) -> str:
    """``g``: the matrix of cross-products of the rows ``z`` of each series."""
    return f"""{name} AS MATERIALIZED (
    SELECT series_key, list(line ORDER BY a) AS g
    FROM (SELECT series_key, a, list(s ORDER BY b) AS line
          FROM (SELECT series_key, a, b, sum(z[a] * z[b]) AS s
                FROM (SELECT series_key, z, unnest(range(1, len(z) + 1)) AS a FROM ({rows}) q1) q2,
                     unnest(range(1, len(z) + 1)) u(b)
                GROUP BY ALL) q3
          GROUP BY ALL) q4
    GROUP BY ALL)"""


def _sweep(name: str, source: str, stop: str) -> str:
    """Regress on one more column per step: the last cell of ``g`` is then what the regression leaves."""
    return f"""{name} AS (
    SELECT series_key, g, 0 AS k, len(g) AS m, {stop} AS stop FROM {source}
    UNION ALL
    SELECT series_key,
           [[CASE WHEN i = k + 1 AND j = k + 1 THEN 1 / g[k + 1][k + 1]
                  WHEN i = k + 1 THEN g[i][j] / g[k + 1][k + 1]
                  WHEN j = k + 1 THEN -g[i][j] / g[k + 1][k + 1]
                  ELSE g[i][j] - g[i][k + 1] * g[k + 1][j] / g[k + 1][k + 1] END
             for j in range(1, m + 1)] for i in range(1, m + 1)],
           k + 1, m, stop
    FROM {name} WHERE k < stop)"""


#: From ``dx (series_key, t_idx, v)``, the values tested.
ADF_CTES = [
    """xs AS MATERIALIZED (SELECT series_key, list(v ORDER BY t_idx) AS v, count(*) AS n,
    CAST(least(count(*) // 2 - 2, ceil(12 * pow(count(*) / 100, 0.25))) AS BIGINT) AS ml
    FROM dx WHERE v IS NOT NULL GROUP BY series_key)""",
    "ds AS (SELECT *, [v[j + 1] - v[j] for j in range(1, n)] AS d FROM xs)",
    """zr AS MATERIALIZED (SELECT series_key, ml, j - 1 AS j,
    list_concat(list_concat([1.0, v[j]], [CASE WHEN j > i THEN d[j - i] ELSE 0 END for i in range(1, ml + 1)]),
                [d[j]]) AS z
    FROM (SELECT *, unnest(range(1, n)) AS j FROM ds) q)""",
    _gram("gc", "SELECT * FROM zr WHERE j >= ml"),
    _sweep("sc", "gc", "len(g) - 1"),
    """nc AS (SELECT series_key, count(*) FILTER (WHERE j >= ml) AS nc FROM zr GROUP BY series_key)""",
    """ic AS (SELECT series_key, k - 2 AS lags, nc * (ln(2 * pi()) + ln(g[m][m] / nc) + 1) + 2 * k AS ic
    FROM sc JOIN nc USING (series_key) WHERE k >= 2 AND nc > k)""",
    "pick AS MATERIALIZED (SELECT series_key, min(ic) AS ic, arg_min(lags, ic) AS lags FROM ic GROUP BY series_key)",
    _gram("gf", "SELECT zr.* FROM zr JOIN pick USING (series_key) WHERE j >= lags"),
    _sweep("sf", "(SELECT gf.*, lags FROM gf JOIN pick USING (series_key)) q", "lags + 2"),
    """fit AS (SELECT p.series_key, ic, lags, nf, g[2][m] / sqrt(g[m][m] / (nf - lags - 2) * g[2][2]) AS tau
    FROM sf JOIN pick p USING (series_key)
    JOIN (SELECT zr.series_key, count(*) AS nf FROM zr JOIN pick USING (series_key) WHERE j >= lags GROUP BY 1) c
      ON c.series_key = p.series_key
    WHERE k = lags + 2)"""]


def _poly(coefficients: list[float], x: str) -> str:
    return "(" + " + ".join(f"({c}) * pow({x}, {i})" for i, c in enumerate(coefficients)) + ")"


#: The normal distribution function by its series about zero.
_NORMAL = """CASE WHEN w < -7 THEN 0.0 WHEN w > 7 THEN 1.0 ELSE 0.5 + exp(-w * w / 2) / sqrt(2 * pi()) * list_sum(
    [pow(w, 2 * i + 1) / list_aggregate([x::DOUBLE for x in range(1, 2 * i + 2, 2)], 'product')
     for i in range(0, 120)]) END"""
ADF_SELECT = f"""SELECT series_key, round(tau, 6) AS adf_stat,
  {rounded(f"CASE WHEN tau > {TS.ADF_TAU_MAX} THEN 1.0 WHEN tau < {TS.ADF_TAU_MIN} THEN 0.0 ELSE {_NORMAL} END")}
    AS p_value,
  CAST(lags AS INTEGER) AS used_lag, CAST(nf AS INTEGER) AS nobs,
  round({_poly(TS.ADF_CRIT["1%"], "(1 / nf)")}, 6) AS crit_1, round({_poly(TS.ADF_CRIT["5%"], "(1 / nf)")}, 6) AS crit_5,
  round({_poly(TS.ADF_CRIT["10%"], "(1 / nf)")}, 6) AS crit_10, round(ic, 6) AS ic_best
FROM (SELECT *, CASE WHEN tau <= {TS.ADF_TAU_STAR} THEN {_poly(TS.ADF_SMALLP, "tau")}
                     ELSE {_poly(TS.ADF_LARGEP, "tau")} END AS w FROM fit) q"""


# ------------------------------------------------------------------ principal components
#: Rounds of rotations over all pairs of columns; the off-diagonal falls at least quadratically.
ROUNDS = 10


def pca_ctes(features: list[str]) -> list[str]:
    """From ``z``, the standardised rows: ``comp (series_key, component, v, value, ratio)`` by plane rotations."""
    p = len(features)
    pairs = list(combinations(range(1, p + 1), 2))
    cov = "[" + ", ".join("[" + ", ".join(f"covar_samp({a}, {b})" for b in features) + "]" for a in features) + "]"
    unit = "[[CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0 END for j in range(1, {0})] for i in range(1, {0})]".format(p + 1)
    whole = " AND ".join(f"{c} IS NOT NULL" for c in features)
    means = "[" + ", ".join(f"avg({c})" for c in features) + "]"
    return [
        f"cv AS MATERIALIZED (SELECT series_key, {cov} AS a, {means} AS mu FROM z WHERE {whole} "
        "GROUP BY series_key HAVING count(*) > 1)",
        f"""rot AS (
    SELECT series_key, mu, 0 AS k, a, {unit} AS v FROM cv
    UNION ALL
    SELECT series_key, mu, k + 1,
           [[CASE WHEN i = p THEN c * b[p][j] - s * b[q][j] WHEN i = q THEN s * b[p][j] + c * b[q][j] ELSE b[i][j] END
             for j in range(1, {p + 1})] for i in range(1, {p + 1})],
           [[CASE WHEN j = p THEN c * v[i][p] - s * v[i][q] WHEN j = q THEN s * v[i][p] + c * v[i][q] ELSE v[i][j] END
             for j in range(1, {p + 1})] for i in range(1, {p + 1})]
    FROM (SELECT *, [[CASE WHEN j = p THEN c * a[i][p] - s * a[i][q] WHEN j = q THEN s * a[i][p] + c * a[i][q]
                           ELSE a[i][j] END for j in range(1, {p + 1})] for i in range(1, {p + 1})] AS b
          FROM (SELECT *, 1 / sqrt(t * t + 1) AS c, t / sqrt(t * t + 1) AS s
                FROM (SELECT *, CASE WHEN a[p][q] = 0 THEN 0.0
                                     ELSE CASE WHEN h < 0 THEN -1 ELSE 1 END / (abs(h) + sqrt(h * h + 1)) END AS t
                      FROM (SELECT *, CASE WHEN a[p][q] <> 0 THEN (a[q][q] - a[p][p]) / (2 * a[p][q]) END AS h
                            FROM (SELECT *, {[x for x, _ in pairs]}[k % {len(pairs)} + 1] AS p,
                                         {[y for _, y in pairs]}[k % {len(pairs)} + 1] AS q
                                  FROM rot WHERE k < {ROUNDS * len(pairs)}) q1) q2) q3) q4) q5)""",
        f"""eig AS (SELECT series_key, mu, greatest(a[e][e], 0) AS value, [v[i][e] for i in range(1, {p + 1})] AS u
    FROM (SELECT *, unnest(range(1, {p + 1})) AS e FROM rot WHERE k = {ROUNDS * len(pairs)}) q)""",
        """comp AS MATERIALIZED (
    SELECT series_key, mu, value, value / sum(value) OVER (PARTITION BY series_key) AS ratio,
           CAST(row_number() OVER (PARTITION BY series_key ORDER BY value DESC) AS INTEGER) AS component,
           [x * CASE WHEN u[list_position([abs(y) for y in u], list_max([abs(y) for y in u]))] < 0 THEN -1 ELSE 1 END
            for x in u] AS v
    FROM eig)""",
        """scr AS (SELECT series_key, component, value, ratio,
           sum(ratio) OVER (PARTITION BY series_key ORDER BY component) AS cum_ratio FROM comp)"""]


SCREE_SELECT = f"SELECT series_key, component, {rounded('value')} AS eigenvalue, {rounded('ratio')} AS ratio, " \
               "round(cum_ratio, 6) AS cum_ratio FROM scr"
CHOOSE_K_SELECT = f"SELECT series_key, min(component) AS k FROM scr WHERE cum_ratio >= {PCA_VARIANCE_TARGET} - 1e-12 " \
                  "GROUP BY series_key"


def loadings_select(features: list[str]) -> str:
    names = "[" + ", ".join(f"'{c}'" for c in features) + "]"
    return f"""SELECT series_key, component, {names}[i] AS feature, {rounded('v[i]')} AS loading,
  {rounded('mu[i]')} AS mean, {rounded('value')} AS eigenvalue, {rounded('ratio')} AS ratio
FROM (SELECT *, unnest(range(1, {len(features) + 1})) AS i FROM comp) q"""


def scores_select(features: list[str], k: int, more: str = "") -> str:
    parts = []
    for c in range(1, k + 1):
        total = " + ".join(f"(z.{f} - c{c}.mu[{i}]) * c{c}.v[{i}]" for i, f in enumerate(features, 1))
        parts.append(f"{rounded(total)} AS PC{c}")
    joins = " ".join(f"LEFT JOIN comp c{c} ON c{c}.series_key = z.series_key AND c{c}.component = {c}"
                     for c in range(1, k + 1))
    return f"SELECT z.series_key, z.week_start, z.t_idx, {', '.join(parts)}{more} FROM z {joins}"


# ------------------------------------------------------------------ natural spline
def spline_ctes(cols: list[str]) -> list[str]:
    """From ``ob``: ``filled (series_key, week_start, var, f)`` by the natural cubic spline through the known cells."""
    cells = ", ".join(f"{{'var': '{c}', 'y': {c}}}" for c in cols)
    return [
        f"""cell AS MATERIALIZED (SELECT series_key, week_start, (week_start - DATE '1970-01-04') / 7.0 AS x, u.var AS var,
    u.y AS y FROM (SELECT series_key, week_start, unnest([{cells}]) AS u FROM ob) q)""",
        """knot AS MATERIALIZED (
    SELECT *, (y1 - y) / h1 - (y - y0) / h0 AS bend
    FROM (SELECT series_key, var, x, y, row_number() OVER g AS i, count(*) OVER (PARTITION BY series_key, var) AS m,
                 x - lag(x) OVER g AS h0, lead(x) OVER g - x AS h1, lag(y) OVER g AS y0, lead(y) OVER g AS y1
          FROM cell WHERE y IS NOT NULL WINDOW g AS (PARTITION BY series_key, var ORDER BY x)) q)""",
        """ahead AS (
    SELECT series_key, var, i, 0.0::DOUBLE AS c, 0.0::DOUBLE AS d FROM knot WHERE i = 1
    UNION ALL
    SELECT k.series_key, k.var, k.i, k.h1 / (2 * (k.h0 + k.h1) - k.h0 * f.c),
           (6 * k.bend - k.h0 * f.d) / (2 * (k.h0 + k.h1) - k.h0 * f.c)
    FROM ahead f JOIN knot k ON k.series_key = f.series_key AND k.var = f.var AND k.i = f.i + 1 AND k.i < k.m)""",
        "run AS MATERIALIZED (SELECT * FROM ahead)",
        """back AS (
    SELECT series_key, var, i, 0.0::DOUBLE AS bent FROM knot WHERE i = m
    UNION ALL
    SELECT r.series_key, r.var, r.i, r.d - r.c * b.bent
    FROM back b JOIN run r ON r.series_key = b.series_key AND r.var = b.var AND r.i = b.i - 1)""",
        """curve AS MATERIALIZED (
    SELECT k.*, bent, lead(bent) OVER g AS bent1, lag(bent) OVER g AS bent0
    FROM knot k JOIN back USING (series_key, var, i) WINDOW g AS (PARTITION BY series_key, var ORDER BY i))""",
        """filled AS (
    SELECT l.series_key, l.week_start, l.var,
           CASE WHEN l.y IS NOT NULL THEN l.y
                WHEN s.h1 IS NOT NULL THEN
                     ((s.x + s.h1 - l.x) * s.y + (l.x - s.x) * s.y1) / s.h1
                     + ((pow((s.x + s.h1 - l.x) / s.h1, 3) - (s.x + s.h1 - l.x) / s.h1) * s.bent
                        + (pow((l.x - s.x) / s.h1, 3) - (l.x - s.x) / s.h1) * s.bent1) * s.h1 * s.h1 / 6
                WHEN s.h0 IS NOT NULL THEN
                     s.y + ((s.y - s.y0) / s.h0 + s.h0 * (2 * s.bent + s.bent0) / 6) * (l.x - s.x)
                ELSE s.y END AS f
    FROM cell l ASOF LEFT JOIN curve s ON l.series_key = s.series_key AND l.var = s.var AND l.x >= s.x)"""]


def spline_select(cols: list[str], outcome: str) -> str:
    wide = ", ".join(f"max(f) FILTER (WHERE var = '{c}') AS {c}" for c in cols)
    return f"""SELECT ob.series_key, ob.week_start, ob.t_idx, {', '.join(f'round(w.{c}, 6) AS {c}' for c in cols)},
  round(ob.{outcome}, 6) AS {outcome}, ob.is_outlier
FROM ob JOIN (SELECT series_key, week_start, {wide} FROM filled GROUP BY ALL) w
  ON w.series_key = ob.series_key AND w.week_start = ob.week_start"""


# ------------------------------------------------------------------ seasonal grid
#: Lags of the long autoregression, and the terms of the candidates (name, lag) in the order of the cross-products.
LONG_LAGS = [*range(1, SE.LONG_AR + 1), SEASON, SEASON + 1]
TERMS = [(f"{kind}{lag}", lag) for kind in "ue" for lag in (1, SEASON, SEASON + 1)]


def _complete(cols: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def grid_ctes(features: list[str], k: int, outcome: str) -> list[str]:
    """From ``z`` and ``comp``: ``cand``, one row for each series and candidate.

    A series under one differencing is a group of its own; its key is the struct ``series_key``.
    """
    xs = [f"PC{i}" for i in range(1, k + 1)]
    ws = [f"w_{c}" for c in [*xs, "y"]]
    scores = ", ".join(" + ".join(f"(z.{f} - c{c}.mu[{i}]) * c{c}.v[{i}]" for i, f in enumerate(features, 1))
                       + f" AS PC{c}" for c in range(1, k + 1))
    joins = " ".join(f"JOIN comp c{c} ON c{c}.series_key = z.series_key AND c{c}.component = {c}" for c in range(1, k + 1))
    win = "OVER (PARTITION BY series_key ORDER BY t_idx)"

    def differenced(c: str) -> str:
        lag = lambda n: f"lag({c}, {n}) {win}"
        d, sd = "series_key.d", "series_key.sd"
        return (f"{c} - CASE WHEN {d} = 1 THEN {lag(1)} ELSE 0 END - CASE WHEN {sd} = 1 THEN {lag(SEASON)} ELSE 0 END"
                f" + CASE WHEN {d} = 1 AND {sd} = 1 THEN {lag(SEASON + 1)} ELSE 0 END AS w_{c}")

    lags = [f"l{n}" for n in LONG_LAGS]
    terms = [t for t, _ in TERMS]
    need = len(terms) + k + 1
    chosen = [(p, q, sp, sq, [n for n, on in enumerate((p, sp, p and sp, q, sq, q and sq), 1) if on])
              for p in (0, 1) for q in (0, 1) for sp in (0, 1) for sq in (0, 1)]
    combos = ", ".join(f"({p}, {q}, {sp}, {sq}, {cols}::BIGINT[])" for p, q, sp, sq, cols in chosen)

    def poly(first: int, sign: int) -> str:
        """Coefficients of the chosen terms first .. first + 2 at their lags, cut after the last lag."""
        at = [f"WHEN i = {lag} THEN {sign} * coalesce(b[list_position(cols, {n})], 0)"
              for n, (_, lag) in list(enumerate(TERMS, 1))[first - 1:first + 2]]
        deg = " ".join(f"WHEN list_contains(cols, {n}) THEN {lag}"
                       for n, (_, lag) in reversed(list(enumerate(TERMS, 1))[first - 1:first + 2]))
        return f"[CASE {' '.join(at)} ELSE 0.0 END for i in range(1, 1 + CASE {deg} ELSE 0 END)]"

    return [
        f"sc0 AS (SELECT z.series_key, z.t_idx, z.{outcome} AS y, {scores} FROM z {joins})",
        f"""tr AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY series_key) AS n FROM sc0) q
    WHERE t_idx < round_even({TRAIN_SHARE} * n, 0))""",
        f"""dd AS (SELECT {{'key': series_key, 'd': d, 'sd': sd}} AS series_key, t_idx, y, {', '.join(xs)}
    FROM tr, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) o(d, sd))""",
        f"dw AS MATERIALIZED (SELECT series_key, t_idx, {', '.join(differenced(c) for c in [*xs, 'y'])} FROM dd)",
        _gram("g0", f"SELECT series_key, [{', '.join(ws)}] AS z FROM dw WHERE {_complete(ws)}"),
        _sweep("s0", "g0", str(k)),
        f"""n0 AS (SELECT series_key, count(*) AS n0 FROM dw WHERE {_complete(ws)} GROUP BY 1)""",
        f"""reg AS MATERIALIZED (SELECT s0.series_key, [g[i][m] for i in range(1, {k + 1})] AS beta,
    [sqrt(greatest(g[m][m] / (n0 - {k}) * g[i][i], 0)) for i in range(1, {k + 1})] AS se
    FROM s0 JOIN n0 ON n0.series_key = s0.series_key WHERE k = {k})""",
        f"""us AS MATERIALIZED (SELECT dw.series_key, t_idx, w_y - ({' + '.join(f'w_{x} * beta[{i}]' for i, x in enumerate(xs, 1))}) AS u
    FROM dw JOIN reg ON reg.series_key = dw.series_key)""",
        f"ul AS MATERIALIZED (SELECT *, {', '.join(f'lag(u, {n}) {win} AS l{n}' for n in LONG_LAGS)} FROM us)",
        _gram("g1", f"SELECT series_key, [{', '.join(lags)}, u] AS z FROM ul WHERE {_complete([*lags, 'u'])}"),
        _sweep("s1", "g1", str(len(lags))),
        f"""es AS (SELECT ul.series_key, t_idx, u, u - ({' + '.join(f'{c} * g[{i}][m]' for i, c in enumerate(lags, 1))}) AS e
    FROM ul JOIN s1 ON s1.series_key = ul.series_key AND k = {len(lags)})""",
        f"zs AS (SELECT series_key, t_idx, u, {', '.join(f'lag({t[0]}, {n}) {win} AS {t}' for t, n in TERMS)} FROM es)",
        f"""own AS (SELECT *, count(*) OVER (PARTITION BY series_key) AS own FROM zs WHERE {_complete([*terms, 'u'])})""",
        f"""shared AS MATERIALIZED (SELECT * FROM (
    SELECT *, count(*) OVER (PARTITION BY series_key.key, t_idx) AS here FROM own WHERE own > {need}) q
    WHERE here = (SELECT count(DISTINCT o.series_key) FROM own o WHERE o.own > {need} AND o.series_key.key = q.series_key.key))""",
        _gram("g2", f"SELECT series_key, [{', '.join(terms)}, u] AS z FROM shared"),
        "n2 AS (SELECT series_key, count(*) AS n FROM shared GROUP BY 1)",
        f"""sub AS (SELECT {{'key': g2.series_key, 'p': p, 'q': q, 'sp': sp, 'sq': sq, 'n': n, 'cols': cols}} AS series_key,
    [[g[i][j] for j in list_append(cols, {len(terms) + 1})] for i in list_append(cols, {len(terms) + 1})] AS g
    FROM g2 JOIN n2 ON n2.series_key = g2.series_key, (VALUES {combos}) o(p, q, sp, sq, cols))""",
        _sweep("s2", "sub", "len(g) - 1"),
        """fitted AS MATERIALIZED (SELECT series_key AS id, series_key.cols AS cols, series_key.n AS n, g[m][m] AS ssr,
    [g[i][m] for i in range(1, m)] AS b, [g[i][i] for i in range(1, m)] AS inv FROM s2 WHERE k = stop)""",
        # all roots are outside the unit circle if each order's last coefficient, stepping the order down, is under one
        f"""down AS (
    SELECT id, kind, a, true AS ok FROM (SELECT id, 'ar' AS kind, {poly(1, -1)} AS a FROM fitted
                                         UNION ALL SELECT id, 'ma', {poly(4, 1)} FROM fitted) q
    UNION ALL
    SELECT id, kind, [(a[j] - a[len(a)] * a[len(a) - j]) / (1 - a[len(a)] * a[len(a)]) for j in range(1, len(a))],
           abs(a[len(a)]) < 1
    FROM down WHERE ok AND len(a) > 0)""",
        "roots AS (SELECT id, kind, bool_and(ok) AS ok FROM down GROUP BY ALL)",
        f"""cand AS MATERIALIZED (
    SELECT f.id.key.key AS series_key, f.id.key AS grp, f.id.p AS p, f.id.key.d AS d, f.id.q AS q, f.id.sp AS sp,
           f.id.key.sd AS sd, f.id.sq AS sq, n * ln(2 * pi() * ssr / n) + n + 2 * (len(cols) + {k + 1}) AS aic,
           ssr / n AS sigma2, n, a.ok AS stationary, m.ok AS invertible, cols, b,
           [sqrt(greatest(ssr / greatest(n - len(cols), 1) * v, 0)) for v in inv] AS se
    FROM fitted f JOIN roots a ON a.id = f.id AND a.kind = 'ar' JOIN roots m ON m.id = f.id AND m.kind = 'ma')""",
        """pos AS MATERIALIZED (SELECT *, (p * 4 + d * 2 + q) * 8 + sp * 4 + sd * 2 + sq AS grid_pos FROM cand)""",
        """won AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY aic, grid_pos) AS place
    FROM pos WHERE stationary AND invertible) q WHERE place = 1)"""]


_ORDERS = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in ("grid_pos", "p", "d", "q", "sp", "sd", "sq")) \
    + f", CAST({SEASON} AS INTEGER) AS s"
GRID_SELECT = f"""SELECT series_key, {_ORDERS}, round(aic, 6) AS aic, round(sigma2, 2) AS sigma2, n AS n_eff, stationary,
  invertible, CAST(NULL AS VARCHAR) AS error FROM pos"""
BEST_SELECT = f"SELECT series_key, {_ORDERS}, round(aic, 6) AS aic FROM won"


def coef_select(k: int) -> str:
    """Terms of the chosen model; the normal distribution by the same fixed polynomial (Abramowitz-Stegun 7.1.26)."""
    names = "[" + ", ".join(f"'{t}'" for t, _ in TERMS) + "]"
    erf = "(1 - r * (0.254829592 + r * (-0.284496736 + r * (1.421413741 + r * (-1.453152027 + r * 1.061405429)))) " \
          "* exp(-zs * zs / 2))"
    return f"""SELECT series_key, term, round(coef, 6) AS coef, round(std_err, 6) AS std_err, round(zv, 6) AS z,
  {rounded(f"2 * (1 - 0.5 * (1 + {erf}))")} AS p_value,
  round(coef - {CONFIDENCE_Z} * std_err, 6) AS ci_lo, round(coef + {CONFIDENCE_Z} * std_err, 6) AS ci_hi
FROM (SELECT *, coef / std_err AS zv, abs(coef / std_err) AS zs,
             1 / (1 + 0.3275911 * abs(coef / std_err) / sqrt(2)) AS r
      FROM (SELECT w.series_key, 'PC' || i AS term, beta[i] AS coef, reg.se[i] AS std_err
            FROM won w JOIN reg ON reg.series_key = w.grp, unnest(range(1, {k + 1})) u(i)
            UNION ALL
            SELECT series_key, {names}[cols[i]], b[i], se[i]
            FROM (SELECT *, unnest(range(1, len(cols) + 1)) AS i FROM won) q) t) v"""


def forecast_ctes(k: int) -> list[str]:
    """From ``won``, ``reg``, ``sc0``: ``fc (series_key, week_start, t_idx, predicted, ci_lo, ci_hi, observed)``.

    Two recursions over the weeks of a series: the innovations and levels (lists that grow by a week a step), and the
    psi weights of the full lag polynomial.
    """
    xs = [f"PC{i}" for i in range(1, k + 1)]
    win = "OVER (PARTITION BY series_key ORDER BY t)"
    lags = (1, SEASON, SEASON + 1)

    def differenced(c: str) -> str:
        return (f"{c} - CASE WHEN d = 1 THEN lag({c}, 1) {win} ELSE 0 END - CASE WHEN sd = 1 THEN lag({c}, {SEASON}) {win}"
                f" ELSE 0 END + CASE WHEN d = 1 AND sd = 1 THEN lag({c}, {SEASON + 1}) {win} ELSE 0 END")

    def past(of: str, lag: int, at: str = "t") -> str:  # the step's own value is not in the list yet
        return f"CASE WHEN {at} >= {lag} THEN {of}[{at} - {lag} + 1] ELSE 0 END"

    coefs = ", ".join(f"coalesce(b[list_position(cols, {n})], 0.0) AS c{n}" for n in range(1, len(TERMS) + 1))
    ar = " + ".join(f"c{n} * ({past('us', lag, 'i')})" for n, lag in enumerate(lags, 1))
    ma = " + ".join(f"c{n} * ({past('es', lag, 'i')})" for n, lag in enumerate(lags, 4))
    level = (f"drift + expected + CASE WHEN d = 1 THEN {past('ys', 1, 'i')} ELSE 0 END + CASE WHEN sd = 1 THEN "
             f"{past('ys', SEASON, 'i')} ELSE 0 END - CASE WHEN d = 1 AND sd = 1 THEN {past('ys', SEASON + 1, 'i')} ELSE 0 END")
    return [
        f"""fp AS MATERIALIZED (SELECT won.series_key, CAST(d AS INTEGER) AS d, CAST(sd AS INTEGER) AS sd, sigma2, beta, {coefs}
    FROM won JOIN reg ON reg.series_key = won.grp)""",
        f"""fw AS (SELECT series_key, t, y, d, sd, t >= n_tr AS ahead, {' + '.join(
            f'({differenced(x)}) * beta[{i}]' for i, x in enumerate(xs, 1))} AS drift, {differenced('y')} AS w
    FROM (SELECT *, t_idx AS t, round_even({TRAIN_SHARE} * count(*) OVER (PARTITION BY series_key), 0) AS n_tr FROM sc0) q
    JOIN fp USING (series_key))""",
        """fr AS MATERIALIZED (SELECT series_key, list({'y': y, 'ahead': ahead, 'drift': drift, 'w': w} ORDER BY t) AS rows,
    count(*) FILTER (WHERE ahead) AS steps FROM fw GROUP BY 1)""",
        f"""rec AS (
    SELECT series_key, 0 AS i, []::DOUBLE[] AS us, []::DOUBLE[] AS es, []::DOUBLE[] AS ys FROM fr
    UNION ALL
    SELECT series_key, i + 1,
           list_append(us, CASE WHEN ahead THEN expected ELSE coalesce(w - drift, 0) END),
           list_append(es, CASE WHEN ahead THEN 0 ELSE coalesce(w - drift - expected, 0) END),
           list_append(ys, CASE WHEN ahead THEN {level} ELSE y END)
    FROM (SELECT rec.*, r.rows[i + 1].y AS y, r.rows[i + 1].ahead AS ahead, r.rows[i + 1].drift AS drift,
                 r.rows[i + 1].w AS w, d, sd, {ar} + {ma} AS expected
          FROM rec JOIN fr r ON r.series_key = rec.series_key JOIN fp ON fp.series_key = rec.series_key
          WHERE i < len(r.rows)) q)""",
        f"""ap AS MATERIALIZED (SELECT series_key, sigma2, map_entries(map_from_entries(list((lag, c)))) AS poly, any_value(theta) AS theta
    FROM (SELECT series_key, sigma2, lag, sum(c) AS c, any_value(theta) AS theta
          FROM (SELECT fp.series_key, sigma2, a.l + e.l + g.l AS lag, a.c * e.c * g.c AS c,
                       [{{'l': 1, 'c': c4}}, {{'l': {SEASON}, 'c': c5}}, {{'l': {SEASON + 1}, 'c': c6}}] AS theta
                FROM fp, unnest([{{'l': 0, 'c': 1.0}}, {{'l': 1, 'c': -c1}}, {{'l': {SEASON}, 'c': -c2}},
                                 {{'l': {SEASON + 1}, 'c': -c3}}]) t1(a),
                     unnest([{{'l': 0, 'c': 1.0}}, {{'l': 1, 'c': -1.0 * d}}]) t2(e),
                     unnest([{{'l': 0, 'c': 1.0}}, {{'l': {SEASON}, 'c': -1.0 * sd}}]) t3(g)) x
          GROUP BY series_key, sigma2, lag HAVING lag > 0) y GROUP BY series_key, sigma2)""",
        """psi AS (
    SELECT series_key, 1 AS h, [1.0::DOUBLE] AS ps FROM ap
    UNION ALL
    SELECT series_key, h + 1, list_append(ps, coalesce(list_sum([x.c for x in theta if x.l = h]), 0)
           - coalesce(list_sum([x.value * ps[h - x.key + 1] for x in poly if x.key <= h]), 0))
    FROM (SELECT psi.*, poly, theta FROM psi JOIN ap ON ap.series_key = psi.series_key
          JOIN fr ON fr.series_key = psi.series_key WHERE h < steps) q)""",
        f"""fc AS MATERIALIZED (
    SELECT f.series_key, mf.week_start, f.t AS t_idx, f.y AS observed, ys[f.t + 1] AS predicted,
           ys[f.t + 1] - half AS ci_lo, ys[f.t + 1] + half AS ci_hi
    FROM (SELECT fw.*, row_number() OVER (PARTITION BY series_key ORDER BY t) AS h FROM fw WHERE ahead) f
    JOIN mf ON mf.series_key = f.series_key AND mf.t_idx = f.t
    JOIN (SELECT rec.* FROM rec JOIN fr ON fr.series_key = rec.series_key AND i = len(rows)) e ON e.series_key = f.series_key
    JOIN (SELECT series_key, h, {CONFIDENCE_Z} * sqrt(sigma2 * list_sum([x * x for x in ps])) AS half
          FROM psi JOIN ap USING (series_key)) v ON v.series_key = f.series_key AND v.h = f.h)"""]


def forecast_select(digits: int) -> str:
    return "SELECT series_key, week_start, " + ", ".join(
        f"round({c}, {digits}) AS {a}" for c, a in (("predicted", "predicted_orders"), ("ci_lo", "ci_lo"), ("ci_hi", "ci_hi"))) \
        + ", CAST('{run_ts}' AS DATE) AS load_dt FROM fc"


#: Accuracy over the test span; weeks without events have no relative error.
METRICS = """err AS (SELECT *, sqrt(avg((observed - predicted) ** 2) OVER w) AS rmse,
    avg(CASE WHEN observed <> 0 THEN abs((observed - predicted) / observed) END) OVER w AS mape
    FROM fc WINDOW w AS (PARTITION BY series_key))"""


def observed_select(digits: int) -> str:
    return f"""SELECT series_key, week_start, CAST(t_idx AS INTEGER) AS t_idx, {', '.join(f'round({c}, {digits}) AS {c}' for c in (
        'predicted', 'ci_lo', 'ci_hi', 'observed', 'rmse'))}, round(mape, 5) AS mape FROM err"""


def log_select(run_id: str, run_ts: str, digits: int) -> str:
    return f"""SELECT won.series_key, '{run_id}' AS run_id, TIMESTAMP '{run_ts}' AS run_ts,
  format('({{}}, {{}}, {{}})', p, d, q) AS "order", format('({{}}, {{}}, {{}}, {SEASON})', sp, sd, sq) AS seasonal_order,
  round(aic, 6) AS aic, round(m.rmse, {digits}) AS rmse, round(m.mape, 5) AS mape
FROM won JOIN (SELECT series_key, any_value(rmse) AS rmse, any_value(mape) AS mape FROM err GROUP BY 1) m
  ON m.series_key = won.series_key"""
