"""ANSI SQL with the same result as each query of the catalog that SQL can express."""

from __future__ import annotations

import math
from itertools import accumulate

#: Chances of at most 0, 1, 2 ... draws of a row (Poisson with mean 1).
DRAWS = tuple(accumulate(math.exp(-1) / math.factorial(k) for k in range(8)))

HASH_PART = """CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.8
            THEN 'train' ELSE 'test' END"""

RETURNED = "SELECT *, CAST(l_returnflag = 'R' AS INTEGER) AS returned FROM lineitem"
FINISHED = """SELECT *, CAST(o_orderstatus = 'F' AS INTEGER) AS finished,
           CAST(floor(o_totalprice / 500) AS DOUBLE) AS score FROM orders"""

THRESHOLD_RULES = "(VALUES (0, 'over 150k', 150000), (1, 'over 250k', 250000), (2, 'over 350k', 350000))"

CELLS = """CAST(count(*) FILTER (WHERE y = 0 AND p = 0) AS BIGINT) AS tn,
           CAST(count(*) FILTER (WHERE y = 0 AND p = 1) AS BIGINT) AS fp,
           CAST(count(*) FILTER (WHERE y = 1 AND p = 0) AS BIGINT) AS fn,
           CAST(count(*) FILTER (WHERE y = 1 AND p = 1) AS BIGINT) AS tp"""

MODEL_COUNTS = f"""
    tagged AS (
      SELECT o_orderkey, t.ordinal, t.model, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
             CAST(o_totalprice > t.cut AS INTEGER) AS p, -abs(o_totalprice - t.cut) AS score
      FROM orders, {THRESHOLD_RULES} AS t(ordinal, model, cut)
    ),
    counts AS (SELECT ordinal, model, {CELLS} FROM tagged GROUP BY ordinal, model)"""


def _metrics(source: str, keys: str) -> str:
    return f"""
      SELECT {keys} tn, fp, fn, tp, accuracy, "precision", recall, balanced_accuracy,
             CASE WHEN "precision" + recall > 0
                  THEN 2.0 * "precision" * recall / ("precision" + recall) ELSE 0.0 END AS f1
      FROM (
        SELECT *, CASE WHEN tn + fp + fn + tp > 0 THEN (tp + tn) / CAST(tn + fp + fn + tp AS DOUBLE) ELSE 0.0 END
                    AS accuracy,
               CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS "precision",
               CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS recall,
               CASE WHEN tp + fn > 0 AND tn + fp > 0
                    THEN (tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2.0 END AS balanced_accuracy
        FROM {source}
      )"""


def _bins(column: str, edges: tuple[int, ...], source: str = RETURNED) -> str:
    labels = [f"({low:g},{high:g}]" for low, high in zip(edges, edges[1:])] + [f">{edges[-1]:g}"]
    listed = ", ".join(f"({i}, '{text}')" for i, text in enumerate(labels))
    cases = " ".join(f"WHEN {column} <= {edge} THEN {i}" for i, edge in enumerate(edges[1:]))
    return f"""
      SELECT d.bin, d.bin_label, coalesce(m.n, 0) AS "rows", coalesce(m.pos, 0) AS positives,
             100.0::DOUBLE * m.pos / m.n AS rate_pct,
             printf('%.1f%%', round(100.0::DOUBLE * m.pos / m.n, 1)) AS rate_text
      FROM (VALUES {listed}) AS d(bin, bin_label)
      LEFT JOIN (
        SELECT bin, count(*) AS n, CAST(sum(returned) AS BIGINT) AS pos
        FROM (SELECT returned, CASE WHEN {column} IS NULL OR {column} <= {edges[0]} THEN NULL {cases}
                                    ELSE {len(edges) - 1} END AS bin FROM ({source}))
        WHERE bin IS NOT NULL GROUP BY bin
      ) AS m USING (bin)"""


def _rates(key: str, label: str, source: str) -> str:
    return f"""
      SELECT {key}, count({label}) AS "rows", CAST(sum({label}) AS BIGINT) AS positives,
             100.0::DOUBLE * CAST(sum({label}) AS BIGINT) / count({label}) AS rate_pct
      FROM ({source}) WHERE {key} IS NOT NULL GROUP BY {key}"""


def _segments() -> str:
    parts = []
    binned = (
        ("price", "l_extendedprice", (0, 20000, 40000, 60000, 80000)),
        ("quantity", "l_quantity", (0, 6, 12, 24, 48, 60)),
    )
    for number, (name, column, edges) in enumerate(binned):
        parts.append(
            f"""SELECT {number} AS segment_no, '{name}' AS segment, CAST(bin AS DOUBLE) AS position,
                bin_label AS value, "rows", positives, rate_pct FROM ({_bins(column, edges)})"""
        )
    keyed = (("status", "l_linestatus", "NULL"), ("line", "l_linenumber", "l_linenumber"))
    for number, (name, column, position) in enumerate(keyed, start=2):
        parts.append(
            f"""SELECT {number}, '{name}', CAST({position} AS DOUBLE), CAST({column} AS VARCHAR), "rows", positives,
                rate_pct FROM ({_rates(column, "returned", RETURNED)})"""
        )
    return " UNION ALL ".join(parts)


def _score_groups(score: str, source: str, by: str = "") -> str:
    """Score groups with running counts from the highest score down."""
    part = f"PARTITION BY {by[:-1]} " if by else ""
    return f"""
      groups AS (
        SELECT {by} CAST({score} AS DOUBLE) AS score, sum(CAST(y AS BIGINT)) AS pos, sum(CAST(1 - y AS BIGINT)) AS neg
        FROM ({source}) GROUP BY {by} {score}
      ),
      ranked AS (
        SELECT *, row_number() OVER ({part}ORDER BY score DESC) AS place,
               sum(pos) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
               sum(neg) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg,
               lead(pos) OVER ({part}ORDER BY score DESC) AS next_pos,
               lead(neg) OVER ({part}ORDER BY score DESC) AS next_neg,
               sum(pos) OVER ({part or "PARTITION BY 1 "}) AS all_pos,
               sum(neg) OVER ({part or "PARTITION BY 1 "}) AS all_neg
        FROM groups
      )"""


FINISHED_Y = f"SELECT *, finished AS y FROM ({FINISHED})"


def _curve(keep: str = "TRUE") -> str:
    return f"""
      WITH {_score_groups("score", FINISHED_Y)}
      SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
      UNION ALL
      SELECT score, CAST(cum_neg AS DOUBLE) / CAST(all_neg AS DOUBLE), CAST(cum_pos AS DOUBLE) / CAST(all_pos AS DOUBLE)
      FROM ranked WHERE {keep}"""


def _area(score: str, source: str, by: str = "") -> str:
    return f"""
      WITH {_score_groups(score, source, by)}
      SELECT {by} CAST(max(all_pos) AS BIGINT) AS positives, CAST(max(all_neg) AS BIGINT) AS negatives,
             CAST(sum(pos * (2 * (all_neg - cum_neg) + neg)) AS DOUBLE)
               / (2.0::DOUBLE * CAST(max(all_pos) AS DOUBLE) * CAST(max(all_neg) AS DOUBLE)) AS roc_auc
      FROM ranked {"GROUP BY " + by[:-1] if by else ""}"""


MODEL_AREAS = f"areas AS (SELECT model, roc_auc FROM ({_area('score', 'SELECT * FROM tagged', 'model,')}))"
REPORT_ROWS = f"""
    WITH {MODEL_COUNTS}, {MODEL_AREAS}
    SELECT m.*, roc_auc FROM ({_metrics("counts", "ordinal, model,")}) AS m JOIN areas USING (model)"""

PRIORITY_INDEX = """
      SELECT o_orderpriority, count(*) AS n,
             row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS idx
      FROM orders GROUP BY o_orderpriority"""

SLOTS = """
      flags AS (
        SELECT l_returnflag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS flag_idx
        FROM lineitem GROUP BY l_returnflag
      ),
      statuses AS (
        SELECT l_linestatus, row_number() OVER (ORDER BY count(*) DESC, l_linestatus) - 1 AS status_idx
        FROM lineitem GROUP BY l_linestatus
      ),
      slots AS (
        SELECT l_orderkey, l_linenumber, l_quantity AS x0, l_extendedprice AS x1,
               CAST(flag_idx = 0 AS INTEGER)::DOUBLE AS x2, CAST(flag_idx = 1 AS INTEGER)::DOUBLE AS x3,
               CAST(flag_idx = 2 AS INTEGER)::DOUBLE AS x4,
               CAST(status_idx = 0 AS INTEGER)::DOUBLE AS x5, CAST(status_idx = 1 AS INTEGER)::DOUBLE AS x6
        FROM lineitem JOIN flags USING (l_returnflag) JOIN statuses USING (l_linestatus)
      )"""


def _rule(name: str, source: str, condition: str, consequence: str) -> str:
    missing = f"count(*) FILTER (WHERE {condition} AND NOT ({consequence}))"
    unexpected = f"count(*) FILTER (WHERE NOT ({condition}) AND {consequence})"
    return f"""SELECT '{name}' AS rule, count(*) AS "rows", {missing} AS missing, {unexpected} AS unexpected,
               {missing} + {unexpected} AS violations FROM {source}"""


def _check(name: str, source: str, column: str, holds: str, applies: str = "TRUE") -> str:
    return f"""SELECT '{name}' AS "check", count(*) FILTER (WHERE {applies}) AS "rows",
               count(*) FILTER (WHERE {applies} AND {column} IS NULL) AS nulls,
               count(*) FILTER (WHERE {applies} AND NOT ({holds})) AS violations FROM {source}"""


#: Line items with a quantity band as the only feature: label rates of the training rows, and the best cut of one band
#: against the others by Gini impurity.
BANDED = """
    banded AS (
      SELECT l_orderkey, CAST(l_extendedprice * (1 - l_discount) / l_quantity > 2200 AS INTEGER) AS y,
             CAST(CAST(floor((l_quantity - 1) / 10) AS BIGINT) AS VARCHAR) AS band,
             CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 8) AS BIGINT)
               / 4294967296.0 < 0.8 AS in_train
      FROM lineitem),
    bands AS (SELECT band, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS p FROM banded WHERE in_train GROUP BY band),
    cuts AS (
      SELECT band, n, p, sum(n) OVER () - n AS other_n, sum(p) OVER () - p AS other_p FROM bands),
    best AS (
      SELECT band, p / n AS inside, other_p / other_n AS outside FROM cuts
      ORDER BY p * (n - p) / n + other_p * (other_n - other_p) / other_n LIMIT 1),
    tested AS (
      SELECT y, band, p / n AS saturated,
             CASE WHEN band = (SELECT band FROM best) THEN (SELECT inside FROM best)
                  ELSE (SELECT outside FROM best) END AS stump
      FROM banded JOIN bands USING (band) WHERE NOT in_train)"""


def _banded_rows(score: str) -> str:
    return f'SELECT band, round({score}, 4) AS score, count(*) AS "rows" FROM tested GROUP BY band, round({score}, 4)'


LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _unit(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / 4294967296.0"


def _forest(trees: int, depth: int, subset: int, bagging: bool, bins: int = 32) -> str:
    """Trees grown level by level: ``nodes`` (tree, path, feature, cut, threshold, n, positives, gain), ``tested`` rows."""
    listed = ", ".join(f"CAST({name} AS DOUBLE)" for name in LINE_FEATURES)
    binned = ", ".join(
        f"len(list_filter((SELECT list(threshold) FROM edges WHERE feature = {i}), lambda t: t < f[{i + 1}]))"
        for i in range(len(LINE_FEATURES))
    )
    draws = " + ".join(f"CAST({d!r} <= u AS INTEGER)" for d in DRAWS) if bagging else "1"
    drawn = _unit("'draw 42 ' || tree || ': ' || key")
    impurity = "CASE WHEN {n} > 0 THEN 2.0::DOUBLE * {p} * ({n} - {p}) / {n} ELSE 0.0::DOUBLE END"
    whole, left, right = (
        impurity.format(n=n, p=p) for n, p in (("n", "p"), ("left_n", "left_p"), ("(n - left_n)", "(p - left_p)"))
    )
    ctes = [
        f"""parted AS MATERIALIZED (
          SELECT l_orderkey, l_linenumber, row_number() OVER () AS row_no,
                 concat_ws('|', l_orderkey, l_linenumber) AS key, [{listed}] AS f,
                 CAST(l_extendedprice * (1 - l_discount) / l_quantity > 2200 AS INTEGER) AS y,
                 {_unit("concat_ws('|', l_orderkey, l_linenumber)")} < 0.8 AS in_train
          FROM lineitem)""",
        f"""cuts AS (
          SELECT *, lead(value) OVER (PARTITION BY feature ORDER BY value) AS above,
                 sum(n) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS so_far,
                 sum(n) OVER (PARTITION BY feature) AS total, count(*) OVER (PARTITION BY feature) AS kinds
          FROM (SELECT feature, value, count(*) AS n
                FROM (SELECT unnest(range({len(LINE_FEATURES)})) AS feature, unnest(f) AS value FROM parted WHERE in_train)
                GROUP BY feature, value))""",
        f"""edges AS MATERIALIZED (
          SELECT feature, (value + above) / 2 AS threshold,
                 row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS cut
          FROM cuts WHERE above IS NOT NULL
            AND (kinds <= {bins} OR so_far * {bins} // total > (so_far - n) * {bins} // total))""",
        f"binned AS MATERIALIZED (SELECT *, [{binned}] AS b FROM parted)",
        f"""rows_0 AS MATERIALIZED (
          SELECT tree, key, y, b, w, 1 AS path
          FROM (SELECT *, {draws} AS w FROM (SELECT *, {drawn} AS u FROM binned, range({trees}) AS t(tree) WHERE in_train))
          WHERE w > 0)""",
        f"""tested_0 AS (
          SELECT tree, row_no, l_orderkey, l_linenumber, b, 1 AS path FROM binned, range({trees}) AS t(tree)
          WHERE NOT in_train)""",
    ]
    for level in range(depth):
        look = _unit("'look 42 ' || tree || ' ' || path || ' : ' || feature")
        ctes += [
            f"""looked_{level} AS (
              SELECT tree, path, feature FROM (
                SELECT *, row_number() OVER (PARTITION BY tree, path ORDER BY {look}, feature) AS place
                FROM (SELECT DISTINCT tree, path FROM rows_{level}), range({len(LINE_FEATURES)}) AS f(feature))
              WHERE place <= {subset})""",
            f"""sums_{level} AS MATERIALIZED (
              SELECT tree, path, feature, b[feature + 1] AS bin, sum(w)::DOUBLE AS n, sum(w * y)::DOUBLE AS p
              FROM rows_{level} JOIN looked_{level} USING (tree, path) GROUP BY ALL)""",
            f"""running_{level} AS (
              SELECT tree, path, feature, bin,
                     sum(n) OVER (PARTITION BY tree, path, feature ORDER BY bin ROWS UNBOUNDED PRECEDING) AS left_n,
                     sum(p) OVER (PARTITION BY tree, path, feature ORDER BY bin ROWS UNBOUNDED PRECEDING) AS left_p,
                     sum(n) OVER (PARTITION BY tree, path, feature) AS n, sum(p) OVER (PARTITION BY tree, path, feature) AS p
              FROM sums_{level})""",
            f"""best_{level} AS MATERIALIZED (
              SELECT tree, path, n, p, CASE WHEN valid THEN feature END AS feature, CASE WHEN valid THEN bin END AS cut,
                     CASE WHEN valid THEN gain END AS gain
              FROM (
                SELECT *, left_n < n AND gain > 1e-12 AS valid,
                       row_number() OVER (PARTITION BY tree, path
                                          ORDER BY left_n < n AND gain > 1e-12 DESC, gain DESC, feature, bin) AS place
                FROM (SELECT *, ({whole} - ({left} + {right})) / n AS gain FROM running_{level}))
              WHERE place = 1)""",
        ]
        for rows in ("rows", "tested"):
            stays = f""" UNION ALL
                  SELECT t.* FROM tested_{level} t LEFT JOIN best_{level} s
                    ON s.tree = t.tree AND s.path = t.path AND s.feature IS NOT NULL WHERE s.tree IS NULL"""
            stays = stays if rows == "tested" else ""
            order = "r.tree, key, y, b, w" if rows == "rows" else "r.tree, row_no, l_orderkey, l_linenumber, b"
            ctes.append(
                f"""{rows}_{level + 1} AS MATERIALIZED (
                  SELECT {order}, 2 * r.path + CAST(b[feature + 1] > cut AS INTEGER) AS path
                  FROM {rows}_{level} r JOIN best_{level} s ON s.tree = r.tree AND s.path = r.path
                  WHERE feature IS NOT NULL{stays})"""
            )
    found = [f"SELECT * FROM best_{level}" for level in range(depth)]
    found.append(f"SELECT tree, path, sum(w)::DOUBLE, sum(w * y)::DOUBLE, NULL, NULL, NULL FROM rows_{depth} GROUP BY tree, path")
    ctes.append(
        f"""nodes AS MATERIALIZED (
          SELECT CAST(tree AS INTEGER) AS tree, path, feature, threshold, CAST(n AS BIGINT) AS n,
                 CAST(p AS BIGINT) AS positives, gain
          FROM ({" UNION ALL ".join(found)}) LEFT JOIN edges USING (feature, cut))"""
    )
    ctes.append(f"tested AS (SELECT * FROM tested_{depth})")
    return "WITH " + ", ".join(ctes)


SHOWN_NODES = """
    SELECT tree, path, CAST(feature AS INTEGER) AS feature, round(threshold, 6) AS threshold, n, positives,
           round(gain, 9) AS gain FROM nodes"""


def _evidence(name: str, violated: str, applies: str = "TRUE", null: str = "FALSE") -> str:
    """A line of the check report: counts, and of each of five remainders of the key's hash the least violating one."""
    keys = ", ".join(f"min(CASE WHEN {violated} AND h % 5 = {part} THEN h * 1::HUGEINT END) AS k{part}" for part in range(5))
    texts = ", ".join(f"(SELECT min(k) FROM hashed WHERE h = k{part} AND {violated})" for part in range(5))
    return f"""
      SELECT '{name}' AS "check", "rows", nulls, violations,
             array_to_string(list_sort(list_filter([{texts}], lambda k: k IS NOT NULL)), ', ') AS keys
      FROM (SELECT count(*) FILTER (WHERE {applies}) AS "rows", count(*) FILTER (WHERE {null}) AS nulls,
                   count(*) FILTER (WHERE {violated}) AS violations, {keys} FROM hashed)"""


def _class_lines(number: int, name: str, position: str, value: str, key: str, where: str = "TRUE") -> str:
    return f"""
      SELECT {number} AS segment_no, '{name}' AS segment, CAST({position} AS DOUBLE) AS position, {value} AS value,
             l_returnflag AS "class", count(*) AS "rows",
             100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY {key}) AS share_pct
      FROM lineitem WHERE {where} GROUP BY {key}, l_returnflag"""


def oracle_sql() -> dict[str, str]:
    return {
        "drop_nulls": """
          SELECT * FROM (
            SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
                   nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
                   CASE WHEN o_totalprice < 50000 THEN 'NaN'::DOUBLE ELSE o_totalprice END AS o_totalprice
            FROM orders)
          WHERE o_orderkey IS NOT NULL AND o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
            AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)""",
        "drop_nulls_subset": """
          SELECT o_orderkey, o_orderstatus FROM orders
          WHERE nullif(o_orderstatus, 'P') IS NOT NULL AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)""",
        "random_split": """
          SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS in_both, CAST(0 AS BIGINT) AS in_neither, true AS share_near
          FROM orders""",
        "null_report": """
          WITH gappy AS (
            SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
                   nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)
          SELECT 'read' AS item, CAST(NULL AS VARCHAR) AS "column", count(*) AS "rows" FROM gappy
          UNION ALL
          SELECT 'kept', NULL, count(*) FROM gappy
          WHERE o_orderkey IS NOT NULL AND o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
          UNION ALL SELECT 'null', 'o_orderkey', count(*) - count(o_orderkey) FROM gappy
          UNION ALL SELECT 'null', 'o_orderstatus', count(*) - count(o_orderstatus) FROM gappy
          UNION ALL SELECT 'null', 'o_orderpriority', count(*) - count(o_orderpriority) FROM gappy
          UNION ALL
          SELECT item, name, CAST(0 AS BIGINT)
          FROM (VALUES ('unparsable'), ('nan')) AS i(item),
               (VALUES ('o_orderkey'), ('o_orderstatus'), ('o_orderpriority')) AS c(name)""",
        "csv_text_round_trip": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
        "preview_topk": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5",
        "hash_split": f"SELECT o_orderkey, {HASH_PART} AS part FROM orders",
        "hash_split_rows": """
          SELECT l_orderkey, l_linenumber,
                 CASE WHEN CAST('0x' || substr(md5('fold 1: ' || concat_ws('|', l_orderkey, l_linenumber)), 1, 8)
                                AS BIGINT) / 4294967296.0 < 0.5 THEN 'train' ELSE 'test' END AS part
          FROM lineitem""",
        "split_counts": f'SELECT {HASH_PART} AS part, count(*) AS "rows" FROM orders GROUP BY 1',
        "class_distribution": f"""
          SELECT *, printf('%.1f%%', round(share_pct, 1)) AS share_text
          FROM (
            SELECT returned, count(*) AS "rows",
                   100.0::DOUBLE * count(*) / (SELECT count(*) FROM lineitem) AS share_pct
            FROM ({RETURNED}) GROUP BY returned)""",
        "rate_by_charge_bin": _bins("l_extendedprice", (0, 20000, 40000, 60000, 80000)),
        "rate_by_tenure_bin": _bins("l_quantity", (0, 6, 12, 24, 48)),
        "rate_by_category": _rates("o_orderpriority", "finished", FINISHED),
        "rate_by_ordinal": _rates("l_linenumber", "returned", RETURNED),
        "rate_by_complaints": _rates(
            "complaints",
            "returned",
            f"SELECT *, CAST(round(l_discount * 100) AS INTEGER) AS complaints FROM ({RETURNED})",
        ),
        "exact_split": """
          SELECT o_orderkey,
                 CASE WHEN row_number() OVER (ORDER BY CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT),
                                                       o_orderkey) <= floor(0.8 * count(*) OVER ())
                      THEN 'train' ELSE 'test' END AS part
          FROM orders""",
        "exact_split_counts": """
          SELECT 'train' AS part, CAST(floor(0.7 * count(*)) AS BIGINT) AS "rows" FROM lineitem
          UNION ALL SELECT 'test', count(*) - CAST(floor(0.7 * count(*)) AS BIGINT) FROM lineitem""",
        "zip_rows": """
          SELECT position, o_orderkey, o_totalprice, debt, c_custkey
          FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders)
          JOIN (SELECT c_custkey, -c_acctbal AS debt, row_number() OVER (ORDER BY -c_acctbal, c_custkey) - 1 AS position
                FROM customer) USING (position)""",
        "csv_table": """
          SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey END AS o_custkey, o_orderstatus,
                 CASE WHEN o_orderkey % 70 > 1 THEN o_totalprice END AS o_totalprice
          FROM orders""",
        "csv_rescued": """
          SELECT 'o_custkey' AS "column", 'c-' || o_custkey AS raw, count(*) AS cells FROM orders
          WHERE o_orderkey % 50 = 0 GROUP BY o_custkey
          UNION ALL
          SELECT 'o_totalprice', 'n/a', count(*) FROM orders WHERE o_orderkey % 70 = 0 HAVING count(*) > 0""",
        "logistic_newton": f"""
          WITH rows_ AS (
            SELECT *, CAST(l_extendedprice * (1 - l_discount) / l_quantity > 2200 AS INTEGER) AS y FROM lineitem
            WHERE {_unit("concat_ws('|', l_orderkey, l_linenumber)")} < 0.8)
          {" UNION ALL ".join(
              f"SELECT {i} AS idx, '{name}' AS feature, round(sum(y * {column}), 2) AS observed, 1.0::DOUBLE AS fitted_share FROM rows_"
              for i, (name, column) in enumerate([("(intercept)", "1.0::DOUBLE"), *[(c, f"CAST({c} AS DOUBLE)") for c in LINE_FEATURES]])
          )}""",
        "class_report": " UNION ALL ".join(
            [
                _class_lines(-1, "all", "NULL", "NULL", "1::INTEGER + 0"),
                f"""
                  SELECT 0, 'price', CAST(bin AS DOUBLE), label, l_returnflag, count(*),
                         100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY bin)
                  FROM (SELECT l_returnflag, CASE WHEN l_extendedprice <= 20000 THEN 0 WHEN l_extendedprice <= 40000 THEN 1
                               WHEN l_extendedprice <= 60000 THEN 2 WHEN l_extendedprice <= 80000 THEN 3 ELSE 4 END AS bin
                        FROM lineitem WHERE l_extendedprice > 0)
                  JOIN (VALUES (0, '(0,20000]'), (1, '(20000,40000]'), (2, '(40000,60000]'), (3, '(60000,80000]'),
                               (4, '>80000')) AS b(of_bin, label) ON bin = of_bin
                  GROUP BY bin, label, l_returnflag""",
                _class_lines(1, "status", "NULL", "l_linestatus", "l_linestatus"),
                _class_lines(2, "line", "l_linenumber", "CAST(l_linenumber AS VARCHAR)", "l_linenumber"),
            ]
        ),
        "check_report": """
          WITH hashed AS (
            SELECT *, concat_ws('|', l_orderkey, l_linenumber) AS k,
                   CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 8) AS BIGINT) AS h FROM lineitem)
          """
        + " UNION ALL ".join(
            [
                _evidence("returned follows final", "(l_linestatus = 'F') <> (l_returnflag = 'R')"),
                _evidence("big follows expensive", "(l_extendedprice > 50000) <> (l_quantity > 25)"),
                _evidence("l_quantity in [1, 50]", "NOT (l_quantity BETWEEN 1 AND 50)", null="l_quantity IS NULL"),
                _evidence(
                    "l_discount in [0, 0.05] if returned",
                    "(l_returnflag = 'R' AND NOT (l_discount BETWEEN 0 AND 0.05::DOUBLE))",
                    "l_returnflag = 'R'",
                    "l_returnflag = 'R' AND l_discount IS NULL",
                ),
                _evidence("l_linestatus in domain", "l_linestatus <> 'O'", null="l_linestatus IS NULL"),
            ]
        ),
        "segment_report": _segments(),
        "confusion_counts": f"SELECT {CELLS} FROM (SELECT quality AS y, toxic AS p FROM labels)",
        "binary_metrics": _metrics(f"(SELECT {CELLS} FROM (SELECT quality AS y, toxic AS p FROM labels))", ""),
        "metrics_by_model": f"WITH {MODEL_COUNTS} {_metrics('counts', 'ordinal, model,')}",
        "confusion_matrix": f"""
          WITH {MODEL_COUNTS}
          SELECT model, 0 AS label, tn AS pred_0, fp AS pred_1 FROM counts
          UNION ALL SELECT model, 1, fn, tp FROM counts""",
        "metrics_report": f"""
          WITH {MODEL_COUNTS}, {MODEL_AREAS}
          SELECT model, round(accuracy, 4) AS accuracy, round(f1, 4) AS f1_score,
                 round("precision", 4) AS "precision", round(recall, 4) AS recall,
                 round(balanced_accuracy, 4) AS auc, tp, tn, fp, fn,
                 round(roc_auc, 4) AS roc_auc,
                 printf('AUC %.3f', round(balanced_accuracy, 3)) AS auc_text,
                 printf('Acc %.3f', round(accuracy, 3)) AS accuracy_text,
                 row_number() OVER (ORDER BY balanced_accuracy DESC, ordinal) = 1 AS best
          FROM ({_metrics("counts", "ordinal, model,")}) JOIN areas USING (model)""",
        "best_model": f"""
          WITH {MODEL_COUNTS}
          SELECT model, balanced_accuracy FROM ({_metrics("counts", "ordinal, model,")})
          ORDER BY balanced_accuracy DESC, ordinal LIMIT 1""",
        "report_document": REPORT_ROWS,
        "report_json": REPORT_ROWS,
        "logistic_regression_saturated": f"WITH {BANDED} {_banded_rows('saturated')}",
        "decision_tree_stump": f"WITH {BANDED} {_banded_rows('stump')}",
        "random_forest_stumps": f"WITH {BANDED} {_banded_rows('stump')}",
        "feature_importance_stumps": f"""
          WITH {BANDED}
          SELECT CAST(row_number() OVER (ORDER BY n DESC, band) - 1 AS INTEGER) AS idx, 'band=' || band AS feature,
                 CAST(band = (SELECT band FROM best) AS INTEGER)::DOUBLE AS importance
          FROM bands""",
        "model_comparison_closed": f"""
          WITH {BANDED},
          outcomes AS (
            SELECT m.ordinal, m.model, y, CASE WHEN m.ordinal = 0 THEN saturated ELSE stump END AS score
            FROM tested, (VALUES (0, 'Logistic Regression'), (1, 'Decision Tree'), (2, 'Random Forest'))
                         AS m(ordinal, model)),
          grouped AS (
            SELECT ordinal, model, score, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
            FROM outcomes GROUP BY ordinal, model, score),
          ranked AS (
            SELECT *, sum(neg) OVER (PARTITION BY ordinal ORDER BY score) - neg AS lower,
                   sum(pos) OVER (PARTITION BY ordinal) AS all_pos, sum(neg) OVER (PARTITION BY ordinal) AS all_neg
            FROM grouped),
          areas AS (
            SELECT ordinal, round(sum(pos * (lower + neg / 2)) / max(all_pos * all_neg), 6) AS roc_auc
            FROM ranked GROUP BY ordinal)
          SELECT ordinal, model, {CELLS}, any_value(roc_auc) AS roc_auc
          FROM (SELECT *, CAST(score > 0.5 AS INTEGER) AS p FROM outcomes) JOIN areas USING (ordinal)
          GROUP BY ordinal, model""",
        "forest_nodes": _forest(20, 5, 2, True) + SHOWN_NODES,
        "forest_scores": _forest(20, 5, 2, True)
        + """
          SELECT l_orderkey, l_linenumber, round(sum(CAST(positives AS DOUBLE) / n) / 20, 6) AS score
          FROM tested JOIN nodes USING (tree, path) GROUP BY row_no, l_orderkey, l_linenumber""",
        "tree_nodes": _forest(1, 4, 4, False) + SHOWN_NODES,
        "tree_importances": _forest(1, 4, 4, False)
        + f"""
          SELECT idx, name AS feature, round(coalesce(g / (SELECT sum(gain * n) FROM nodes), 0), 9) AS importance
          FROM (VALUES {", ".join(f"({i}, '{name}')" for i, name in enumerate(LINE_FEATURES))}) AS v(idx, name)
          LEFT JOIN (SELECT feature, sum(gain * n) AS g FROM nodes GROUP BY feature) AS s ON s.feature = v.idx""",
        "prediction_preview": f"""
          WITH {MODEL_COUNTS}
          SELECT model, o_orderkey, y, p AS prediction, score
          FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY o_orderkey) AS place FROM tagged)
          WHERE place <= 5""",
        "roc_curve": _curve(),
        "roc_curve_corners": _curve(
            "place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg",
        ),
        "roc_auc": _area("score", FINISHED_Y),
        "roc_auc_fine": _area("o_totalprice", FINISHED_Y),
        "roc_auc_by_model": f"WITH {MODEL_COUNTS} SELECT * FROM ({_area('score', 'SELECT * FROM tagged', 'model,')})",
        "category_counts": " UNION ALL ".join(
            f"""SELECT {number} AS column_no, CAST({name} AS VARCHAR) AS label, count(*) AS "rows"
                FROM lineitem WHERE {name} IS NOT NULL GROUP BY {name}"""
            for number, name in enumerate(("l_returnflag", "l_linestatus", "l_linenumber"))
        ),
        "label_index": f"""
          SELECT o_orderpriority, CAST(idx AS INTEGER) AS label_index, n AS "rows" FROM ({PRIORITY_INDEX})""",
        "one_hot": f"""
          SELECT o_orderkey, {", ".join(f"CAST(idx = {i} AS INTEGER)::DOUBLE AS slot_{i}" for i in range(5))}
          FROM orders JOIN ({PRIORITY_INDEX}) USING (o_orderpriority)""",
        "assemble": f"WITH {SLOTS} SELECT * FROM slots",
        "feature_matrix": f"""
          WITH {SLOTS},
          spread AS (SELECT {", ".join(f"stddev_samp(x{i}) AS s{i}" for i in range(7))} FROM slots)
          SELECT l_orderkey, l_linenumber, {", ".join(f"round(x{i} / s{i}, 6) AS x{i}" for i in range(7))}
          FROM slots, spread""",
        "standard_scale": """
          SELECT o_orderkey, round(o_totalprice / (SELECT stddev_samp(o_totalprice) FROM orders), 6) AS scaled_0
          FROM orders""",
        "risk_scorecard": """
          SELECT c_custkey, round(logit, 6) AS logit, round(1.0 / (1.0 + exp(-logit)), 6) AS risk
          FROM (
            SELECT c_custkey,
                   (-0.5)::DOUBLE
                   + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0.75 WHEN 'BUILDING' THEN -0.25
                                       WHEN 'FURNITURE' THEN 0.5 WHEN 'HOUSEHOLD' THEN -0.75
                                       WHEN 'MACHINERY' THEN 0.125 END::DOUBLE
                   + CASE WHEN c_nationkey = 7 THEN 0.375 ELSE 0.0 END::DOUBLE
                   + CASE WHEN c_nationkey = 11 THEN -0.625 ELSE 0.0 END::DOUBLE
                   + 0.0003::DOUBLE * (c_acctbal - 5000) + (-0.02)::DOUBLE * (c_nationkey - 3) AS logit
            FROM customer)""",
        "tariff_rating": """
          SELECT l_orderkey, l_linenumber, monthly AS expected_monthly, monthly * l_quantity AS expected_total
          FROM (
            SELECT *, (8 + CASE l_returnflag WHEN 'A' THEN 3 WHEN 'R' THEN 7 ELSE 0 END
                      + CASE WHEN l_linestatus = 'O' THEN 2.5 ELSE 0 END
                      + CASE WHEN l_linenumber = 1 THEN 1.25 ELSE 0 END)::DOUBLE AS monthly
            FROM lineitem)""",
        "rule_violations": " UNION ALL ".join(
            [
                _rule("returned follows final", "lineitem", "l_linestatus = 'F'", "l_returnflag = 'R'"),
                _rule("big follows expensive", "lineitem", "l_extendedprice > 50000", "l_quantity > 25"),
                _rule("toxic follows poor", "labels", "quality = 0", "toxic = 1"),
            ]
        ),
        "domain_violations": " UNION ALL ".join(
            [
                _check(
                    "c_mktsegment in domain",
                    "customer",
                    "c_mktsegment",
                    "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')",
                ),
                _check("c_acctbal in [0, 9000]", "customer", "c_acctbal", "c_acctbal BETWEEN 0 AND 9000"),
                _check("l_quantity in [1, 50]", "lineitem", "l_quantity", "l_quantity BETWEEN 1 AND 50"),
                _check(
                    "l_discount in [0, 0.05] if returned",
                    "lineitem",
                    "l_discount",
                    "l_discount BETWEEN 0 AND 0.05::DOUBLE",
                    "l_returnflag = 'R'",
                ),
            ]
        ),
    }
