"""Building blocks of the SQL twins: the same panels and series as common table expressions."""

from __future__ import annotations

from seriesmill.sources.tables import FACTORS, PRIORITIES, TOTAL

COLS = ["y", *FACTORS]


def rnd(expr: str, name: str | None = None, k: int = 6) -> str:
    return f"round({expr}, {k}) + 0.0 AS {name or expr}"


def rnds(cols: str | list[str], k: int = 6) -> str:
    return ", ".join(rnd(c, k=k) for c in (cols.split() if isinstance(cols, str) else cols))


def _mean(cents: str, cond: str | None = None) -> str:
    if cond is None:
        return f"CAST(sum({cents}) AS DOUBLE) / count(*) / 100"
    return f"CAST(sum(CASE WHEN {cond} THEN {cents} END) AS DOUBLE) / nullif(count(CASE WHEN {cond} THEN 1 END), 0) / 100"


def _cents(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


_TP = _cents("o_totalprice")
_FACTOR_MEANS = ", ".join(f"{_mean(_TP, f'o_orderpriority = {p!r}')} AS {x}" for x, p in zip(FACTORS, PRIORITIES))


def panel(grain: str = "week") -> str:
    return (
        f"panel AS (SELECT 'ALL' AS panel_id, CAST(date_trunc('{grain}', o_orderdate) AS DATE) AS date, "
        f"{_mean(_TP)} AS y, {_FACTOR_MEANS} FROM orders GROUP BY 2)"
    )


def segment_panels(grain: str = "month") -> str:
    return (
        f"panel AS (SELECT c_mktsegment AS panel_id, CAST(date_trunc('{grain}', o_orderdate) AS DATE) AS date, "
        f"{_mean(_TP)} AS y, {_FACTOR_MEANS} FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"
    )


_LOG = ", ".join(f"ln({c} / lag({c}) OVER w) * 100 AS {c}" for c in COLS)
_ALL = " AND ".join(f"{c} IS NOT NULL" for c in COLS)

RETS_ALL = f"rets_all AS (SELECT panel_id, date, {_LOG} FROM panel WINDOW w AS (PARTITION BY panel_id ORDER BY date))"
RETS = f"{RETS_ALL}, rets AS (SELECT * FROM rets_all WHERE {_ALL})"

SERIES = (
    "series AS (SELECT l_suppkey AS series_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, "
    f"{_mean(_cents('l_extendedprice'))} AS value, {_mean(_cents('l_quantity'))} AS x FROM lineitem GROUP BY 1, 2)"
)
SERIES_RETS = (
    "srets AS (SELECT series_id, date, ret, xret FROM (SELECT series_id, date, ln(value / lag(value) OVER w) * 100 AS ret, "
    "ln(x / lag(x) OVER w) * 100 AS xret FROM series WINDOW w AS (PARTITION BY series_id ORDER BY date)) WHERE ret IS NOT NULL)"
)
SECTORS = (
    "base AS (SELECT c_mktsegment AS entity, o_orderpriority AS metric, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, "
    f"{_TP} AS cents FROM orders JOIN customer ON o_custkey = c_custkey), "
    f"both_ AS (SELECT * FROM base UNION ALL SELECT '{TOTAL}', metric, date, cents FROM base), "
    "sectors AS (SELECT entity || '|' || metric AS series_id, entity, metric, date, "
    "CAST(sum(cents) AS DOUBLE) / count(*) / 100 AS value, count(*) AS n FROM both_ GROUP BY 2, 3, 4)"
)
TICKS = "ticks AS (SELECT event_type AS asset, ts, event_id, value AS price FROM events)"
CLOSES = (
    "closes AS (SELECT asset, CAST(ts AS DATE) AS date, arg_max(price, struct_pack(ts := ts, id := event_id)) AS value "
    "FROM ticks GROUP BY 1, 2)"
)


def gram(cols: list[str], src: str, keys: str = "panel_id", over: str | None = None, n: str = "count(*)") -> str:
    """Select list with n, means and centred cross products (all ordered pairs)."""
    o = f" OVER {over}" if over else ""
    items = [f"avg({c}){o} AS m_{c}" for c in cols]
    items += [f"covar_pop({a}, {b}){o} * {n} AS s_{a}_{b}" for i, a in enumerate(cols) for b in cols[i:]]
    return ", ".join(items)


def s(cols: list[str], a: str, b: str) -> str:
    i, j = sorted((cols.index(a), cols.index(b)))
    return f"s_{cols[i]}_{cols[j]}"


def augmented(cols: list[str]) -> str:
    """[Sxx | Sxy | I] as a list of rows; the first column is the target."""
    y, xs = cols[0], cols[1:]
    rows = []
    for i, a in enumerate(xs):
        row = [s(cols, a, b) for b in xs] + [s(cols, a, y)] + ["1.0" if i == j else "0.0" for j in range(len(xs))]
        rows.append("[" + ", ".join(f"CAST({v} AS DOUBLE)" for v in row) + "]")
    return "[" + ", ".join(rows) + "]"


def eliminate(k: int, ids: str, src: str = "sys", out: str = "solved") -> str:
    """Gauss-Jordan elimination of ``m`` in ``src``, one pivot per recursion step."""
    w = 2 * k + 1
    return (
        f"elim AS (SELECT {ids}, 1 AS step, m FROM {src} UNION ALL SELECT {ids}, step + 1, "
        f"list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {w + 1}), lambda j: "
        "CASE WHEN i = step THEN m[step][j] / m[step][step] ELSE m[i][j] - m[i][step] * m[step][j] / m[step][step] END)) "
        f"FROM elim WHERE step <= {k}), {out} AS (SELECT {ids}, m FROM elim WHERE step = {k + 1})"
    )


def ols(cols: list[str] = COLS, src: str = "rets", keys: str = "panel_id") -> str:
    """CTEs up to ``fit``: (keys, n, b, se, r2, adj_r2, f) with b and se as lists, intercept first."""
    k, xs = len(cols) - 1, cols[1:]
    rss = "(s_y_y - (" + " + ".join(f"m[{i + 1}][{k + 1}] * {s(cols, x, 'y')}" for i, x in enumerate(xs)) + "))"
    b0 = "m_y - (" + " + ".join(f"m[{i + 1}][{k + 1}] * m_{x}" for i, x in enumerate(xs)) + ")"
    quad = " + ".join(f"m_{a} * m[{i + 1}][{k + 2 + j}] * m_{b}" for i, a in enumerate(xs) for j, b in enumerate(xs))
    b = ", ".join([b0] + [f"m[{i + 1}][{k + 1}]" for i in range(k)])
    se = ", ".join([f"sqrt(s2 * (1.0 / n + {quad}))"] + [f"sqrt(s2 * m[{i + 1}][{k + 2 + i}])" for i in range(k)])
    return (
        f"gr AS (SELECT {keys}, count(*) AS n, {gram(cols, src)} FROM {src} GROUP BY {keys}), "
        f"sys AS (SELECT {keys}, {augmented(cols)} AS m FROM gr), "
        f"{eliminate(k, keys)}, "
        f"f0 AS (SELECT gr.*, m, {rss} AS rss, {rss} / (n - {k + 1}) AS s2 FROM gr JOIN solved USING ({keys})), "
        f"fit AS (SELECT {keys}, n, [{b}] AS b, [{se}] AS se, 1 - rss / s_y_y AS r2, "
        f"1 - (rss / s_y_y) * (n - 1) / (n - {k + 1}) AS adj_r2, ((s_y_y - rss) / {k}) / s2 AS f FROM f0)"
    )


def resid(src: str = "rets", keys: str = "panel_id", xs: list[str] = FACTORS) -> str:
    pred = "b[1] + " + " + ".join(f"b[{i + 2}] * {x}" for i, x in enumerate(xs))
    return f"res AS (SELECT r.*, {pred} AS fitted, y - ({pred}) AS resid FROM {src} r JOIN fit USING ({keys}))"


def zscores(src: str, n: int, n_cum: int, value: str = "resid", keys: str = "panel_id") -> str:
    def frame(k: int) -> str:
        return f"(PARTITION BY {keys} ORDER BY date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"

    def z(col: str, k: int) -> str:
        f = frame(k)
        return (
            f"CASE WHEN count({col}) OVER {f} = {k} THEN ({col} - avg({col}) OVER {f}) / nullif(stddev_samp({col}) OVER {f}, 0) END"
        )

    return (
        f"cumd AS (SELECT *, sum({value}) OVER (PARTITION BY {keys} ORDER BY date ROWS UNBOUNDED PRECEDING) AS cum_resid FROM {src}), "
        f"zs AS (SELECT *, {z(value, n)} AS z, {z('cum_resid', n_cum)} AS z_cum FROM cumd)"
    )


def verdict(z: str) -> str:
    return (
        f"CASE WHEN {z} > 2 THEN 'EXPENSIVE' WHEN {z} > 1 THEN 'SLIGHTLY EXPENSIVE' WHEN {z} < -2 THEN 'CHEAP' "
        f"WHEN {z} < -1 THEN 'SLIGHTLY CHEAP' ELSE 'FAIR VALUE' END"
    )


def signal(value: str = "resid", keys: str = "panel_id", kind: str = "in_sample", k: int = 6) -> str:
    """Final select: one row per panel from ``zs``."""
    return (
        f"SELECT {keys}, date, {rnd(value, 'resid', k)}, {rnds('cum_resid z z_cum', k)}, {verdict('coalesce(z_cum, 0)')} AS verdict, "
        "CASE WHEN recent > 0 THEN 'Richening' ELSE 'Cheapening' END AS trend, z_cum IS NOT NULL AS has_history, "
        f"'{kind}' AS basis FROM (SELECT *, avg({value}) OVER (PARTITION BY {keys} ORDER BY date ROWS 3 PRECEDING) AS recent, "
        f"row_number() OVER (PARTITION BY {keys} ORDER BY date DESC) AS rn FROM zs) WHERE rn = 1"
    )


def kalman(k: int, q: float, h: float, src: str = "obs", key: str = "series_id") -> str:
    """Forward filter as a recursion over t. ``src`` has (key, t, date, y, x[]) with t from 1."""
    idx = f"range(1, {k + 1})"
    eye = f"list_transform({idx}, lambda i: list_transform({idx}, lambda j: CASE WHEN i = j THEN 1e6 ELSE 0e0 END))"
    zero = f"list_transform({idx}, lambda i: 0e0)"
    pred = (
        f"list_transform({idx}, lambda i: list_transform({idx}, lambda j: p[i][j] + CASE WHEN i = j AND t > 0 THEN CAST({q} AS DOUBLE) ELSE 0e0 END))"
    )
    return (
        f"kf AS (SELECT DISTINCT {key}, CAST(0 AS BIGINT) AS t, {zero} AS b, {eye} AS p, "
        f"CAST(NULL AS DOUBLE) AS innov, CAST(NULL AS DOUBLE) AS innov_var FROM {src} "
        f"UNION ALL SELECT {key}, t, "
        f"list_transform({idx}, lambda i: b[i] + px[i] * v / f), "
        f"list_transform({idx}, lambda i: list_transform({idx}, lambda j: pp[i][j] - px[i] * px[j] / f)), v, f FROM ("
        f"SELECT *, y - list_sum(list_transform({idx}, lambda i: b[i] * x[i])) AS v, "
        f"list_sum(list_transform({idx}, lambda i: px[i] * x[i])) + CAST({h} AS DOUBLE) AS f FROM ("
        f"SELECT *, list_transform({idx}, lambda i: list_sum(list_transform({idx}, lambda j: pp[i][j] * x[j]))) AS px FROM ("
        f"SELECT o.{key}, o.t, o.y, o.x, s.b, s.pp FROM (SELECT {key}, t, b, {pred} AS pp FROM kf) s "
        f"JOIN {src} o ON o.{key} = s.{key} AND o.t = s.t + 1))))"
    )


def smoother(k: int, q: float, h: float, src: str = "obs", key: str = "series_id") -> str:
    """``sm``: (key, t, date, y, x, sb, sv) with smoothed betas and their variances, from ``kf``.

    Betas step back from the last ones by q times the smoothed disturbances r. Variances meet the filter from the other
    end, each half of the rows in the form in which the wide prior of neither filter cancels.
    """
    idx = f"range(1, {k + 1})"

    def each(expr: str) -> str:
        return f"list_transform({idx}, lambda i: {expr})"

    def total(expr: str, j: str = "j") -> str:
        return f"list_sum(list_transform({idx}, lambda {j}: {expr}))"

    reverse = kalman(k, q, h, "rev", key).replace("kf", "kr")
    solve = eliminate(k, f"{key}, t", "sys_v", "solved_v").replace("elim", "elim_v")
    both = each(f"list_concat(list_transform({idx}, lambda j: p[i][j] + w[i][j]), [0e0], list_transform({idx}, lambda j: CASE WHEN i = j THEN 1e0 ELSE 0e0 END))")
    near = "CASE WHEN 2 * t <= n THEN w ELSE p END"
    inner = total(total(f"nr[i][j] * m[j][{k + 1} + l] * nr[l][i]", "l"))
    return (
        f"ok AS (SELECT o.*, kf.b, kf.p, kf.innov AS v, kf.innov_var AS f, max(o.t) OVER (PARTITION BY o.{key}) AS n, {each(total('kf.p[i][j] * o.x[j]') + f' / CAST({h} AS DOUBLE)')} AS g "
        f"FROM {src} o JOIN kf ON kf.{key} = o.{key} AND kf.t = o.t), "
        f"bk AS (SELECT {key}, max(t) AS t, {each('0e0')} AS r FROM {src} GROUP BY 1 UNION ALL "
        f"SELECT {key}, t - 1, {each('r[i] + x[i] * (v / f - gr)')} FROM (SELECT ok.{key}, ok.t, ok.x, ok.v, ok.f, bk.r, {total('ok.g[j] * bk.r[j]')} AS gr "
        f"FROM bk JOIN ok ON ok.{key} = bk.{key} AND ok.t = bk.t WHERE bk.t > 1)), "
        f"sl AS (SELECT {key}, t, first_value(b[i]) OVER z - CAST({q} AS DOUBLE) * sum(r[i]) OVER z AS beta, i FROM ("
        f"SELECT ok.{key}, ok.t, ok.b, bk.r, unnest({idx}) AS i FROM ok JOIN bk ON bk.{key} = ok.{key} AND bk.t = ok.t) "
        f"WINDOW z AS (PARTITION BY {key}, i ORDER BY t DESC ROWS UNBOUNDED PRECEDING)), "
        f"rev AS (SELECT {key}, n + 1 - t AS t, date, y, x FROM ok), {reverse}, "
        f"ends AS (SELECT ok.{key}, ok.t, ok.n, ok.p, {each(f'list_transform({idx}, lambda j: kr.p[i][j] + CASE WHEN i = j THEN CAST({q} AS DOUBLE) ELSE 0e0 END)')} AS w "
        f"FROM ok JOIN kr ON kr.{key} = ok.{key} AND kr.t = ok.n - ok.t), "
        f"sys_v AS (SELECT {key}, t, {both} AS m FROM ends), {solve}, "
        f"sv AS (SELECT {key}, t, {each('nr[i][i] - ' + inner)} AS sv FROM (SELECT e.{key}, e.t, m, {near} AS nr FROM (SELECT {key}, t, n, p, w FROM ends) e JOIN solved_v USING ({key}, t))), "
        f"sb AS (SELECT {key}, t, list(beta ORDER BY i) AS sb FROM sl GROUP BY 1, 2), "
        f"sm AS (SELECT ok.{key}, ok.t, ok.date, ok.y, ok.x, sb.sb, sv.sv FROM ok JOIN sb ON sb.{key} = ok.{key} AND sb.t = ok.t JOIN sv ON sv.{key} = ok.{key} AND sv.t = ok.t)"
    )


def likelihood_peak(k: int, rounds: int = 20, src: str = "obs", key: str = "panel_id") -> str:
    """``peak``: (key, n, h, q, loglik), the highest likelihood by grids around the best point so far, each half as wide."""
    idx, points = f"range(1, {k + 1})", "(SELECT unnest(range(-4, 5)) AS i)"
    eye = f"list_transform({idx}, lambda i: list_transform({idx}, lambda j: CASE WHEN i = j THEN 1e6 ELSE 0e0 END))"
    xx = f"list_sum(list_transform(x, lambda e: e * e)) / {k}"
    out = (
        f"g0 AS MATERIALIZED (SELECT {key}, count(*) AS n, log10(var_pop(y)) - 1 AS ch, log10(var_pop(y) / avg({xx})) - 4 AS cq, 0e0 AS ll FROM {src} GROUP BY 1)"
    )
    for r in range(rounds):
        shrink = 0.5**r
        out += (
            f", k{r} AS (SELECT {key}, n, ch + a.i * {2.0 / 4 * shrink!r}::DOUBLE AS ch, cq + c.i * {5.0 / 4 * shrink!r}::DOUBLE AS cq, CAST(0 AS BIGINT) AS t, "
            f"list_transform({idx}, lambda i: 0e0) AS b, {eye} AS p, 0e0 AS ll FROM g{r}, {points} a, {points} c UNION ALL "
            f"SELECT {key}, n, ch, cq, t, list_transform({idx}, lambda i: b[i] + px[i] * v / f), "
            f"list_transform({idx}, lambda i: list_transform({idx}, lambda j: p[i][j] - px[i] * px[j] / f)), ll - 0.5 * (ln(2 * pi() * f) + v * v / f) FROM ("
            f"SELECT *, y - list_sum(list_transform({idx}, lambda i: b[i] * x[i])) AS v, list_sum(list_transform({idx}, lambda i: px[i] * x[i])) + pow(10, ch) AS f FROM ("
            f"SELECT *, list_transform({idx}, lambda i: list_sum(list_transform({idx}, lambda j: p[i][j] * x[j]))) AS px FROM ("
            f"SELECT o.{key}, n, ch, cq, o.t, o.y, o.x, ll, b, list_transform({idx}, lambda i: list_transform({idx}, lambda j: "
            f"p[i][j] + CASE WHEN i = j AND s.t > 0 THEN pow(10, cq) ELSE 0e0 END)) AS p FROM k{r} s JOIN {src} o ON o.{key} = s.{key} AND o.t = s.t + 1)))), "
            f"g{r + 1} AS MATERIALIZED (SELECT {key}, any_value(n) AS n, arg_max(ch, ll) AS ch, arg_max(cq, ll) AS cq, max(ll) AS ll FROM k{r} WHERE t = n GROUP BY 1)"
        )
    return out + f", peak AS (SELECT {key}, n, ch, cq, ll AS loglik FROM g{rounds})"


def jacobi(k: int, sweeps: int = 10, src: str = "cm", key: str = "panel_id") -> str:
    """Eigenvalues and vectors of the symmetric matrix ``a`` by cyclic rotations, one per recursion step."""
    order = [(i, j) for i in range(1, k + 1) for j in range(i + 1, k + 1)]
    ps, qs = [i for i, _ in order], [j for _, j in order]
    idx = f"range(1, {k + 1})"
    eye = f"list_transform({idx}, lambda i: list_transform({idx}, lambda j: CASE WHEN i = j THEN 1e0 ELSE 0e0 END))"

    def right(m: str) -> str:
        return (
            f"list_transform({idx}, lambda i: list_transform({idx}, lambda j: CASE WHEN j = p THEN c * {m}[i][p] - s * {m}[i][q] "
            f"WHEN j = q THEN s * {m}[i][p] + c * {m}[i][q] ELSE {m}[i][j] END))"
        )

    left = (
        f"list_transform({idx}, lambda i: list_transform({idx}, lambda j: CASE WHEN i = p THEN c * b[p][j] - s * b[q][j] "
        "WHEN i = q THEN s * b[p][j] + c * b[q][j] ELSE b[i][j] END))"
    )
    theta = "(a[q][q] - a[p][p]) / (2 * a[p][q])"
    t = f"(CASE WHEN abs(a[p][q]) < 1e-300 THEN 0e0 ELSE CASE WHEN {theta} >= 0 THEN 1 ELSE -1 END / (abs({theta}) + sqrt({theta} * {theta} + 1)) END)"
    return (
        f"jac AS (SELECT {key}, 0 AS step, a, {eye} AS v FROM {src} UNION ALL SELECT {key}, step + 1, {left}, {right('v')} FROM ("
        f"SELECT *, {right('a')} AS b FROM (SELECT *, t / sqrt(t * t + 1) AS s, 1 / sqrt(t * t + 1) AS c FROM (SELECT *, {t} AS t FROM ("
        f"SELECT *, {ps}[step % {len(order)} + 1] AS p, {qs}[step % {len(order)} + 1] AS q FROM jac WHERE step < {sweeps * len(order)}))))), "
        f"eig AS (SELECT {key}, i, a[i][i] AS val, list_transform({idx}, lambda j: v[j][i]) AS vec FROM jac, range(1, {k + 1}) r(i) "
        f"WHERE step = {sweeps * len(order)}), "
        f"pcs AS (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY val DESC) AS pc, val / sum(val) OVER (PARTITION BY {key}) * 100 AS share, "
        "CASE WHEN abs(list_min(vec)) > list_max(vec) THEN -1 ELSE 1 END AS sgn, vec FROM eig)"
    )


def t_tail(t: str, dof: str) -> str:
    """Two-sided tail of the t distribution for whole degrees of freedom, as a finite sum of cosines."""
    th = f"atan(abs({t}) / sqrt({dof}))"
    even = (
        f"sin({th}) * list_sum(list_transform(range(0, ({dof} // 2)::BIGINT), lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1)) / sqrt(pi()) * pow(cos({th}), 2 * k)))"
    )
    odd = (
        f"2 / pi() * ({th} + sin({th}) * list_sum(list_transform(range(0, (({dof} - 1) // 2)::BIGINT), "
        f"lambda k: sqrt(pi()) / 2 * exp(lgamma(k + 1) - lgamma(k + 1.5)) * pow(cos({th}), 2 * k + 1))))"
    )
    return f"1 - CASE WHEN {dof} % 2 = 0 THEN {even} ELSE {odd} END"


def f_tail(f: str, d1: str, d2: str, terms: int = 4000) -> str:
    """Upper tail of the F distribution: the incomplete beta function as its series of positive terms."""
    a, b, x = f"({d2} / 2.0)", f"({d1} / 2.0)", f"({d2} / ({d2} + {d1} * {f}))"
    front = f"exp({a} * ln({x}) + {b} * ln(1 - {x}) + lgamma({a} + {b}) - lgamma({a} + 1) - lgamma({b}))"
    term = f"exp(lgamma({a} + {b} + k) - lgamma({a} + {b}) - lgamma({a} + 1 + k) + lgamma({a} + 1) + k * ln({x}))"
    return f"{front} * list_sum(list_transform(range(0, {terms}), lambda k: {term}))"


def lasso(k: int, src: str = "rets", key: str = "panel_id", folds: int = 10, sweeps: int = 40, l1: float = 1.0) -> str:
    """Contiguous cross-validation over 200 penalties; coordinate descent, one coordinate per recursion step.

    ``prob`` holds one problem per left-out fold and, as fold 0, the whole panel.
    ``best`` has the penalty with the lowest mean fold error and its coefficients.
    """
    cols = ["y"] + [f"x{i}" for i in range(1, k + 1)]
    idx = f"range(1, {k + 1})"
    x_of = ", ".join(cols[1:])
    mats = "[" + ", ".join("[" + ", ".join(s(cols, a, b) + " / n" for b in cols[1:]) + "]" for a in cols[1:]) + "]"
    rhs = "[" + ", ".join(s(cols, a, "y") + " / n" for a in cols[1:]) + "]"
    means = "[" + ", ".join(f"m_{c}" for c in cols[1:]) + "]"
    z = ", ".join(f"({c} - avg({c}) OVER w) / stddev_pop({c}) OVER w AS {c}" for c in cols[1:])
    rho = f"c[j] - list_sum(list_transform({idx}, lambda i: CASE WHEN i = j THEN 0e0 ELSE g[j][i] * w[i] END))"
    pred = " + ".join(f"w[{i}] * (x{i} - mx[{i}])" for i in range(1, k + 1))
    return (
        f"zz AS (SELECT {key}, date, y, {z}, ntile({folds}) OVER (PARTITION BY {key} ORDER BY date) AS fold FROM {src} WINDOW w AS (PARTITION BY {key})), "
        f"cases AS (SELECT zz.{key}, f AS left_out, y, {x_of} FROM zz, range(0, {folds + 1}) r(f) WHERE fold <> f), "
        f"gr AS (SELECT {key}, left_out, count(*) AS n, {gram(cols, 'cases')} FROM cases GROUP BY 1, 2), "
        f"prob AS (SELECT {key}, left_out, m_y AS my, {means} AS mx, {mats} AS g, {rhs} AS c, al, pow(10, -4 + 5e0 * al / 199) AS alpha FROM gr, range(0, 200) r(al)), "
        f"cd AS (SELECT {key}, left_out, al, 0 AS step, list_transform({idx}, lambda i: 0e0) AS w FROM prob UNION ALL "
        f"SELECT {key}, left_out, al, step + 1, list_transform({idx}, lambda i: CASE WHEN i = j THEN "
        f"sign(rho) * greatest(abs(rho) - alpha * {l1}::DOUBLE, 0) / (g[j][j] + alpha * (1 - {l1}::DOUBLE)) ELSE w[i] END) FROM (SELECT *, {rho} AS rho FROM ("
        f"SELECT cd.{key}, cd.left_out, cd.al, step, step % {k} + 1 AS j, w, g, c, alpha FROM cd JOIN prob "
        f"ON cd.{key} = prob.{key} AND cd.left_out = prob.left_out AND cd.al = prob.al WHERE step < {sweeps * k}))), "
        f"sol AS (SELECT prob.*, w FROM cd JOIN prob ON cd.{key} = prob.{key} AND cd.left_out = prob.left_out AND cd.al = prob.al WHERE step = {sweeps * k}), "
        f"mse AS (SELECT sol.{key}, al, fold, avg(pow(y - (my + {pred}), 2)) AS e FROM sol JOIN zz ON sol.{key} = zz.{key} AND sol.left_out = zz.fold GROUP BY 1, 2, 3), "
        f"pick AS (SELECT {key}, arg_min(al, e) AS al FROM (SELECT {key}, al, avg(e) AS e FROM mse GROUP BY 1, 2) GROUP BY 1), "
        f"best AS (SELECT sol.* FROM sol JOIN pick ON sol.{key} = pick.{key} AND sol.al = pick.al WHERE left_out = 0)"
    )
