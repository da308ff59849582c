"""Boosted trees as DuckDB statements: one common table per step of each level, for any number of fits."""

from __future__ import annotations

from collections.abc import Sequence

PRIME, SEED, BINS = 2**31 - 1, 88, 64
FIT_COLUMNS = "fit, n_estimators, max_depth, learning_rate, subsample, colsample, gamma, child, l1, l2, held_out"

#: Order of the values in ``FIT_COLUMNS`` and what stands for those not given.
DEFAULTS = {
    "n_estimators": 100, "max_depth": 6, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0, "gamma": 0.0,
    "min_child_weight": 1.0, "reg_alpha": 0.0, "reg_lambda": 1.0,
}


def hashed(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {PRIME}"


def fit_rows(fits: Sequence[tuple[dict, int | None]]) -> str:
    rows = []
    for number, (params, held_out) in enumerate(fits):
        values = [repr(float(params.get(name, default))) for name, default in DEFAULTS.items()]
        rows.append(f"({number}, {', '.join(values)}, {'NULL' if held_out is None else held_out})")
    return f"fits AS (SELECT * FROM (VALUES {', '.join(rows)}) AS v({FIT_COLUMNS}))"


def boosting(rows: str, features: Sequence[str], fits: Sequence[tuple[dict, int | None]]) -> str:
    """Common tables up to ``margins (fit, rid, margin)`` and ``splits``.

    ``rows`` is a query of ``rid, y, fold, in_fit, key_text`` and the features; all rows get a margin, the fits see
    those with ``in_fit`` outside their fold.
    """
    trees = max(int(p.get("n_estimators", 100)) for p, _ in fits)
    depth = max(int(p.get("max_depth", 6)) for p, _ in fits)
    unpivoted = " UNION ALL ".join(
        f"SELECT rid, in_fit, {i} AS f, CASE WHEN isnan(CAST({name} AS DOUBLE)) THEN NULL "
        f"ELSE CAST({name} AS DOUBLE) END AS x FROM base"
        for i, name in enumerate(features)
    )
    names = ", ".join(f"({i}, '{name}')" for i, name in enumerate(features))
    parts = [
        fit_rows(fits),
        f"base AS MATERIALIZED (SELECT *, {hashed('key_text')} AS draw_key FROM ({rows}))",
        f"long AS ({unpivoted})",
        "placed AS (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS rn, "
        "count(*) OVER (PARTITION BY f) AS n FROM long WHERE in_fit AND x IS NOT NULL)",
        f"""cuts AS (SELECT f, list_sort(list_distinct(list(x))) AS edges
  FROM placed JOIN range(1, {BINS}) AS g(i) ON rn = greatest(1, ceil(i * n / {BINS}.0)) GROUP BY f)""",
        f"""cell AS MATERIALIZED (SELECT rid, f, CASE WHEN x IS NULL THEN {BINS}
    ELSE len(list_filter(edges, lambda e: e <= x)) END AS bin FROM long JOIN cuts USING (f))""",
        f"named AS (SELECT * FROM (VALUES {names}) AS v(f, name))",
        "m0 AS MATERIALIZED (SELECT fit, rid, CAST(0 AS DOUBLE) AS margin FROM fits CROSS JOIN base)",
    ]
    for t in range(trees):
        parts += _tree(t, depth, len(features))
    union = " UNION ALL ".join(
        f"SELECT {t} AS tree, * FROM b{t}_{level} WHERE ok" for t in range(trees) for level in range(depth)
    )
    return ",\n".join([*parts, f"margins AS (SELECT * FROM m{trees})", f"splits AS ({union})"])


def _tree(t: int, depth: int, n_features: int) -> list[str]:
    draw = f"(draw_key * ({hashed(f"'{SEED}|{t}|a'")}) + ({hashed(f"'{SEED}|{t}|b'")})) % {PRIME}"
    parts = [
        f"""g{t} AS MATERIALIZED (SELECT fit, rid, 1 / (1 + exp(-margin)) - y AS g,
    (1 / (1 + exp(-margin))) * (1 - 1 / (1 + exp(-margin))) AS h
  FROM m{t} JOIN base USING (rid) JOIN fits USING (fit)
  WHERE in_fit AND {t} < n_estimators AND (held_out IS NULL OR fold <> held_out)
    AND {draw} < floor(subsample * {PRIME}))""",
        f"cols{t} AS (SELECT f, row_number() OVER (ORDER BY md5('{SEED}|{t}|' || name)) AS place FROM named)",
        f"n{t}_0 AS (SELECT fit, rid, 0 AS node FROM m{t})",
    ]
    for level in range(depth):
        here = f"{t}_{level}"
        score = "pow(greatest(abs({0}) - l1, 0), 2) / ({1} + l2)".format
        gain = f"{score('lg', 'lh')} + {score('tg - lg', 'th - lh')} - {score('tg', 'th')}"
        parts += [
            f"""s{here} AS (SELECT fit, node, f, bin, sum(g) AS g, sum(h) AS h
  FROM g{t} JOIN n{here} USING (fit, rid) JOIN cell USING (rid) JOIN cols{t} USING (f) JOIN fits USING (fit)
  WHERE node >= {2**level - 1} AND {level} < max_depth AND place <= greatest(1, floor(colsample * {n_features}))
  GROUP BY fit, node, f, bin)""",
            f"""w{here} AS (SELECT fit, node, f, bin, sum(g) OVER each AS tg, sum(h) OVER each AS th,
    sum(CASE WHEN bin = {BINS} THEN g ELSE 0 END) OVER each AS ng,
    sum(CASE WHEN bin = {BINS} THEN h ELSE 0 END) OVER each AS nh,
    sum(g) OVER upto AS bg, sum(h) OVER upto AS bh
  FROM s{here} WINDOW each AS (PARTITION BY fit, node, f),
    upto AS (PARTITION BY fit, node, f ORDER BY bin ROWS UNBOUNDED PRECEDING))""",
            f"""r{here} AS (SELECT fit, node, f, bin, tg, th, ml, bg + ml * ng AS lg, bh + ml * nh AS lh
  FROM w{here} CROSS JOIN (VALUES (0), (1)) AS v(ml))""",
            f"""q{here} AS (SELECT *, {gain} AS gain,
    bin < {BINS} AND lh >= child AND th - lh >= child AND lh > 0 AND th - lh > 0 AS fits_in
  FROM r{here} JOIN fits USING (fit))""",
            f"""b{here} AS MATERIALIZED (SELECT fit, node, f, bin, ml, tg, th, lg, lh, gain, l1, l2, learning_rate,
    fits_in AND gain > 1e-6 AND gain >= gamma AS ok
  FROM q{here} QUALIFY row_number() OVER (PARTITION BY fit, node
    ORDER BY fits_in AND gain > 1e-6 DESC, round(gain, 9) DESC, f, bin, ml) = 1)""",
            f"""n{t}_{level + 1} AS MATERIALIZED (SELECT n.fit, n.rid, CASE WHEN NOT coalesce(b.ok, false) THEN n.node
    WHEN CASE WHEN c.bin = {BINS} THEN b.ml = 1 ELSE c.bin <= b.bin END THEN 2 * n.node + 1
    ELSE 2 * n.node + 2 END AS node
  FROM n{here} n LEFT JOIN b{here} b ON b.fit = n.fit AND b.node = n.node
  LEFT JOIN cell c ON c.rid = n.rid AND c.f = b.f)""",
        ]
    sides = [f"SELECT fit, 0 AS node, tg AS g, th AS h, l1, l2, learning_rate FROM b{t}_0"]
    for level in range(depth):
        sides.append(f"SELECT fit, 2 * node + 1, lg, lh, l1, l2, learning_rate FROM b{t}_{level} WHERE ok")
        sides.append(f"SELECT fit, 2 * node + 2, tg - lg, th - lh, l1, l2, learning_rate FROM b{t}_{level} WHERE ok")
    parts += [
        f"""v{t} AS MATERIALIZED (SELECT fit, node, h AS cover,
    -learning_rate * sign(g) * greatest(abs(g) - l1, 0) / (h + l2) AS weight
  FROM ({" UNION ALL ".join(sides)}))""",
        f"""m{t + 1} AS MATERIALIZED (SELECT m.fit, m.rid, m.margin + coalesce(weight, 0) AS margin
  FROM m{t} m JOIN n{t}_{depth} n USING (fit, rid) LEFT JOIN v{t} v ON v.fit = n.fit AND v.node = n.node)""",
    ]
    return parts
