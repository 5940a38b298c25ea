"""SQL oracle text per registered query (DuckDB dialect).

Written from the reference semantics, not from the Spark code: global sorts
and windows are fine here because the oracle only runs on small inputs.
"""

from __future__ import annotations

from duelframe import config as C
from duelframe.plans.oracle_sql import (
    BR_COLS, CLEAN_COLUMNS, EXISTING, FEATURES, FEATURE_TABLE, LEAKAGE, PAIRED, RANK_PAIRS, RANKS, RAW_COLUMNS,
    RAW_TYPES, STANCE_COLS, WC_COLS, ZERO_FILLED, diff, feat_sql, filled_diff, lit, q, rank_diff, split_sql,
    with_ctes)

R = 9

# fixed values: the declared linear model of the catalog
DECLARED = {"odds_diff": 0.0001, "td_pct_diff": -0.5, "draws_diff": 0.03125, "is_male": 0.25, "wc_rank_diff": -0.0078125}


def rnd(expr: str) -> str:
    return f"round({expr}, {R})"


RAW_STAR = """SELECT * REPLACE (CAST("Date" AS VARCHAR) AS "Date",
                            CAST("TitleBout" AS INTEGER) AS "TitleBout") FROM bouts"""


def _column_audit() -> str:
    parts = []
    for c in C.LEAKAGE_COLUMNS + [C.TARGET_COLUMN]:
        if c in RAW_COLUMNS:
            parts.append(f"SELECT {lit(c)} AS column_name, 'found' AS status, "
                         f"count({q(c)}) AS non_null, count(*) AS total_rows FROM bouts")
        else:
            parts.append(f"SELECT {lit(c)} AS column_name, 'missing' AS status, "
                         f"CAST(NULL AS BIGINT) AS non_null, count(*) AS total_rows FROM bouts")
    return with_ctes("\nUNION ALL\n".join(parts))


def _dtype_census() -> str:
    by_type: dict[str, list[str]] = {}
    for c, t in RAW_TYPES.items():
        by_type.setdefault(t, []).append(c)
    parts = []
    for t, cols in by_type.items():
        nulls = " + ".join(f"count_if({q(c)} IS NULL)" for c in cols)
        parts.append(f"SELECT {lit(t)} AS dtype, CAST({len(cols)} AS BIGINT) AS n_columns, "
                     f"CAST({nulls} AS BIGINT) AS null_cells FROM bouts")
    return with_ctes("\nUNION ALL\n".join(parts))


def _missing_profile() -> str:
    parts = [f"SELECT {lit(c)} AS column_name, count_if({q(c)} IS NULL) AS missing, "
             f"count(*) AS total_rows FROM bouts" for c in RAW_COLUMNS]
    body = ("SELECT column_name, CAST(missing AS BIGINT) AS missing, "
            f"{rnd('100.0 * missing / total_rows')} AS pct FROM (" + " UNION ALL ".join(parts) +
            f") WHERE missing > 0 ORDER BY pct DESC, column_name LIMIT {C.MISSING_TOP_N}")
    return with_ctes(body)


def _feature_groups() -> str:
    groups = {
        "existing_diffs": EXISTING, "paired_diffs": PAIRED, "rank_diffs": RANKS,
        "contextual": ["TitleBout", "NumberOfRounds", "EmptyArena"],
        "stance_dummies": STANCE_COLS, "weightclass_dummies": WC_COLS,
        "betterrank_dummies": BR_COLS, "other": ["is_male"],
    }
    parts = []
    for g, cols in groups.items():
        nulls = " + ".join(f"count_if({q(c)} IS NULL)" for c in cols) or "0"
        nz = " + ".join(f"count_if({q(c)} <> 0)" for c in cols) or "0"
        parts.append(f"SELECT {lit(g)} AS feature_group, CAST({len(cols)} AS BIGINT) AS n_columns, "
                     f"CAST({nulls} AS BIGINT) AS null_cells, CAST({nz} AS BIGINT) AS nonzero_cells"
                     + (" FROM feat" if cols else ""))
    return feat_sql("\nUNION ALL\n".join(parts))


def _feature_nulls() -> str:
    parts = [f"SELECT {lit(c)} AS column_name, CAST(count_if({q(c)} IS NULL) AS BIGINT) AS missing FROM feat"
             for c in FEATURES]
    return feat_sql("SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE missing > 0")


def _feature_checks() -> str:
    nulls = " + ".join(f"count_if({q(c)} IS NULL)" for c in FEATURES)
    return feat_sql(f"""
        SELECT 'no_missing_values' AS check_name,
               CAST(({nulls}) = 0 AS INTEGER) AS passed, CAST({nulls} AS BIGINT) AS value FROM feat
        UNION ALL SELECT 'no_competitor_names', 1, CAST(0 AS BIGINT)
        UNION ALL SELECT 'no_duplicate_columns', 0, CAST(1 AS BIGINT)
        UNION ALL SELECT 'rows', 1, count(*) FROM feat""")


def _scaler_stats() -> str:
    parts = [f"SELECT {lit(c)} AS feature, {rnd(f'avg({q(c)})')} AS mean, "
             f"{rnd(f'stddev_pop({q(c)})')} AS std, "
             f"{rnd(f'CASE WHEN stddev_pop({q(c)}) = 0 THEN 1.0 ELSE stddev_pop({q(c)}) END')} AS scale "
             f"FROM train" for c in FEATURES]
    return split_sql(" UNION ALL ".join(parts))


def _standardized() -> str:
    stats = ", ".join(
        f"avg({q(c)}) AS m{i}, CASE WHEN stddev_pop({q(c)}) = 0 THEN 1.0 ELSE stddev_pop({q(c)}) END AS s{i}"
        for i, c in enumerate(FEATURES))
    cols = ", ".join(f"{rnd(f'(tv.{q(c)} - st.m{i}) / st.s{i}')} AS {q(c)}" for i, c in enumerate(FEATURES))
    return split_sql(f"SELECT tv.bout_id, tv.split, tv.target, {cols} FROM tv CROSS JOIN st",
                     f"st AS (SELECT {stats} FROM train)")


TV_COLS = ", ".join(q(c) for c in FEATURES)

AUC_BODY = """
SELECT {auc} AS roc_auc, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
FROM (SELECT score, pos, neg,
             coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT score, sum(target) AS pos, sum(1 - target) AS neg FROM rule
            WHERE score IS NOT NULL GROUP BY score))
""".format(auc=rnd("sum(CAST(pos AS DOUBLE) * (below + 0.5 * neg)) / "
                   "nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0)"))

REPORT_BODY = """
SELECT * FROM (
  SELECT 'Blue' AS label, {p0} AS precision, {r0} AS recall, {f0} AS f1_score, CAST(s0 AS BIGINT) AS support FROM m
  UNION ALL SELECT 'Red', {p1}, {r1}, {f1}, CAST(s1 AS BIGINT) FROM m
  UNION ALL SELECT 'accuracy', NULL, NULL, {acc}, CAST(s0 + s1 AS BIGINT) FROM m
  UNION ALL SELECT 'macro avg', {mp}, {mr}, {mf}, CAST(s0 + s1 AS BIGINT) FROM m
  UNION ALL SELECT 'weighted avg', {wp}, {wr}, {wf}, CAST(s0 + s1 AS BIGINT) FROM m)
"""


def _report(rule: str = "rule", *more: str) -> str:
    def z(a, b):
        return f"coalesce(({a}) / nullif(({b}), 0), 0.0)"
    p0, r0 = z("c00", "c00 + c10"), z("c00", "c00 + c01")
    p1, r1 = z("c11", "c11 + c01"), z("c11", "c11 + c10")
    m = (f"m AS (SELECT *, {z('2 * p0 * r0', 'p0 + r0')} AS f0, {z('2 * p1 * r1', 'p1 + r1')} AS f1 FROM "
         f"(SELECT *, {p0} AS p0, {r0} AS r0, {p1} AS p1, {r1} AS r1, c00 + c01 AS s0, c10 + c11 AS s1 FROM "
         "(SELECT CAST(count_if(target = 0 AND prediction = 0) AS DOUBLE) AS c00, "
         "CAST(count_if(target = 0 AND prediction = 1) AS DOUBLE) AS c01, "
         "CAST(count_if(target = 1 AND prediction = 0) AS DOUBLE) AS c10, "
         "CAST(count_if(target = 1 AND prediction = 1) AS DOUBLE) AS c11 FROM " + rule + ")))")
    body = REPORT_BODY.format(
        p0=rnd("p0"), r0=rnd("r0"), f0=rnd("f0"), p1=rnd("p1"), r1=rnd("r1"), f1=rnd("f1"),
        acc=rnd(z("c00 + c11", "s0 + s1")), mp=rnd("(p0 + p1) / 2"), mr=rnd("(r0 + r1) / 2"),
        mf=rnd("(f0 + f1) / 2"), wp=rnd("(p0 * s0 + p1 * s1) / nullif(s0 + s1, 0)"),
        wr=rnd("(r0 * s0 + r1 * s1) / nullif(s0 + s1, 0)"),
        wf=rnd("(f0 * s0 + f1 * s1) / nullif(s0 + s1, 0)"))
    return split_sql(body, *more, m)


CORR = ("covar_pop(a2, b2) / nullif(stddev_pop(a2) * stddev_pop(b2), 0)")


def _pair_corr(a: str, b: str, src: str) -> str:
    return (f"(SELECT {rnd(CORR)} AS corr FROM (SELECT CASE WHEN {q(b)} IS NOT NULL THEN CAST({q(a)} AS DOUBLE) END AS a2, "
            f"CASE WHEN {q(a)} IS NOT NULL THEN CAST({q(b)} AS DOUBLE) END AS b2 FROM {src}))")


def _histogram() -> str:
    cols = [c for c in C.HISTOGRAM_COLUMNS if c in FEATURES]
    long = " UNION ALL ".join(
        f"SELECT {lit(c)} AS feature, target, CAST({q(c)} AS DOUBLE) AS v FROM feat WHERE {q(c)} IS NOT NULL"
        for c in cols)
    n = C.HISTOGRAM_BINS
    body = f"""
    SELECT feature, target, bin,
           {rnd(f"CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END + bin * CASE WHEN hi = lo THEN 1.0 ELSE (hi - lo) / {n}.0 END")} AS bin_start,
           {rnd(f"CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END + (bin + 1) * CASE WHEN hi = lo THEN 1.0 ELSE (hi - lo) / {n}.0 END")} AS bin_end,
           count(*) AS n
    FROM (SELECT l.feature, l.target, r.lo, r.hi,
                 CAST(CASE WHEN r.hi = r.lo THEN {n // 2}
                           ELSE least(floor((l.v - r.lo) * {n}.0 / (r.hi - r.lo)), {n - 1}) END AS BIGINT) AS bin
          FROM long l JOIN (SELECT feature, target, min(v) AS lo, max(v) AS hi FROM long GROUP BY 1, 2) r
            USING (feature, target))
    GROUP BY feature, target, bin, lo, hi"""
    return feat_sql(body, f"long AS ({long})")


NEWTON_STEPS = 8


def _odds_baseline() -> str:
    """The one-feature model by Newton steps unrolled, a statement each; converged after ``NEWTON_STEPS``."""
    steps = ["s0 AS (SELECT 0.0::DOUBLE AS w, 0.0::DOUBLE AS b)"]
    for k in range(NEWTON_STEPS):
        steps.append(f"""s{k + 1} AS MATERIALIZED (
            SELECT w - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS w,
                   b - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b
            FROM (SELECT any_value(w) AS w, any_value(b) AS b,
                         avg((p - target) * x) + any_value(w) / count(*) AS g0, avg(p - target) AS g1,
                         avg(p * (1 - p) * x * x) + 1.0::DOUBLE / count(*) AS h00, avg(p * (1 - p) * x) AS h01,
                         avg(p * (1 - p)) AS h11
                  FROM (SELECT odds_diff AS x, target, w, b, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(b + w * odds_diff))) AS p
                        FROM train, s{k})))""")
    last = f"s{NEWTON_STEPS}"
    scored = f"""rule AS (SELECT bout_id, target, score, CAST(score > 0 AS INTEGER) AS prediction
                          FROM (SELECT bout_id, target, b + w * odds_diff AS score FROM test, {last}))"""
    body = AUC_BODY
    return split_sql(
        f"""SELECT 'Odds Only (LogReg)' AS model, {rnd('acc.accuracy')} AS accuracy, auc.roc_auc,
                   {rnd('w')} AS coefficient, {rnd('b')} AS intercept FROM acc, auc, {last}""",
        *steps, scored.replace("rule AS", "fitted AS"), f"auc AS ({body.replace('rule', 'fitted')})",
        "acc AS (SELECT avg(CAST(prediction = target AS DOUBLE)) AS accuracy FROM fitted)")


def build() -> dict[str, str]:
    s: dict[str, str] = {}
    s["scan_raw"] = with_ctes(RAW_STAR)
    s["clean_bouts"] = with_ctes(
        "SELECT * EXCLUDE (" + ", ".join(q(c) for c in LEAKAGE) + ') REPLACE (CAST("Date" AS VARCHAR) AS "Date", '
        'CAST("TitleBout" AS INTEGER) AS "TitleBout") FROM bouts')
    s["column_audit"] = _column_audit()
    s["leakage_census"] = with_ctes(" UNION ALL ".join(
        f"SELECT {lit(c)} AS column_name, count({q(c)}) AS non_null FROM bouts" for c in LEAKAGE))
    s["leakage_check"] = with_ctes(
        f"""SELECT count(*) AS rows_kept, count("Winner") AS target_non_null,
                   CAST(0 AS BIGINT) AS leakage_columns_left,
                   CAST({len(RAW_COLUMNS) - len(CLEAN_COLUMNS)} AS BIGINT) AS columns_removed,
                   1 AS target_preserved FROM bouts""")
    s["table_shape"] = feat_sql(
        f"""SELECT 'raw' AS table_name, count(*) AS n_rows, CAST({len(RAW_COLUMNS)} AS BIGINT) AS n_columns FROM bouts
            UNION ALL SELECT 'clean', count(*), CAST({len(CLEAN_COLUMNS)} AS BIGINT) FROM clean
            UNION ALL SELECT 'features', count(*), CAST({len(FEATURE_TABLE)} AS BIGINT) FROM feat""")
    s["head_rows"] = with_ctes(RAW_STAR + f" ORDER BY bout_id LIMIT {C.HEAD_ROWS}")
    s["dtype_census"] = _dtype_census()
    s["missing_profile"] = _missing_profile()
    s["complete_odds"] = with_ctes(
        'SELECT bout_id, "RedOdds", "BlueOdds", "Winner" FROM bouts '
        'WHERE "RedOdds" IS NOT NULL AND "BlueOdds" IS NOT NULL AND "Winner" IS NOT NULL')
    fav = ('SELECT bout_id, CAST("RedOdds" < "BlueOdds" AS INTEGER) AS favorite_is_red, '
           'CAST(("RedOdds" < "BlueOdds" AND "Winner" = \'Red\') OR '
           '(NOT ("RedOdds" < "BlueOdds") AND "Winner" = \'Blue\') AS INTEGER) AS favorite_won FROM bouts '
           'WHERE "RedOdds" IS NOT NULL AND "BlueOdds" IS NOT NULL AND "Winner" IS NOT NULL')
    s["favorite_outcome"] = with_ctes(fav)
    s["favorite_win_rate"] = with_ctes(
        f"SELECT count(*) AS n_bouts, CAST(sum(favorite_won) AS BIGINT) AS favorite_wins, "
        f"{rnd('avg(CAST(favorite_won AS DOUBLE))')} AS favorite_win_rate FROM ({fav})")
    s["winner_distribution"] = with_ctes(
        f'SELECT "Winner" AS value, count(*) AS n, {rnd("100.0 * count(*) / (SELECT count(*) FROM bouts)")} AS pct '
        'FROM bouts WHERE "Winner" IS NOT NULL GROUP BY "Winner"')
    s["weightclass_counts"] = with_ctes(
        'SELECT "WeightClass" AS value, count(*) AS n FROM bouts WHERE "WeightClass" IS NOT NULL GROUP BY 1')
    s["yearly_trend"] = with_ctes(
        f"""SELECT CAST(year("Date") AS BIGINT) AS year, count("Winner") AS fights,
                   CAST(count_if("Winner" = 'Red') AS BIGINT) AS red_wins,
                   {rnd("100.0 * count_if(\"Winner\" = 'Red') / nullif(count(\"Winner\"), 0)")} AS red_pct
            FROM bouts GROUP BY 1""")
    s["date_range"] = with_ctes(
        'SELECT count(*) AS n_rows, CAST(min("Date") AS VARCHAR) AS first_date, '
        'CAST(max("Date") AS VARCHAR) AS last_date FROM bouts')
    s["rank_coverage"] = with_ctes(
        " UNION ALL ".join(
            f"SELECT {lit(k)} AS rank_diff, count({q(red)}) AS red_ranked, "
            f"{rnd(f'100.0 * count({q(red)}) / count(*)')} AS red_ranked_pct FROM bouts"
            for k, (red, _) in RANK_PAIRS.items()))
    s["binary_target"] = with_ctes(
        "SELECT bout_id, \"Winner\", CASE WHEN \"Winner\" = 'Red' THEN 1 ELSE 0 END AS target FROM bouts")
    s["gender_binary"] = with_ctes(
        "SELECT bout_id, CASE WHEN \"Gender\" = 'MALE' THEN 1 ELSE 0 END AS is_male FROM bouts")
    s["paired_diffs"] = with_ctes(
        "SELECT bout_id, " + ", ".join(f"{diff(c)} AS {c}" for c in PAIRED) + " FROM bouts")
    s["neutral_fill"] = with_ctes(
        "SELECT bout_id, " + ", ".join(f"{filled_diff(c)} AS {c}" for c in ZERO_FILLED) +
        ', coalesce("EmptyArena", 0) AS "EmptyArena" FROM bouts')
    s["fill_counts"] = with_ctes(" UNION ALL ".join(
        [f"SELECT {lit(c)} AS column_name, CAST(count_if(({diff(c)}) IS NULL) AS BIGINT) AS filled FROM bouts"
         for c in ZERO_FILLED] +
        ["SELECT 'EmptyArena', CAST(count_if(\"EmptyArena\" IS NULL) AS BIGINT) FROM bouts"]))
    s["rank_diffs"] = with_ctes(
        "SELECT bout_id, " + ", ".join(f"{rank_diff(c)} AS {c}" for c in RANKS) + " FROM bouts")
    sm = "coalesce(\"RedStance\", 'Unknown') || '_vs_' || coalesce(\"BlueStance\", 'Unknown')"
    s["stance_matchup"] = with_ctes(f"SELECT bout_id, {sm} AS stance_matchup FROM bouts")
    s["stance_top5"] = with_ctes(
        f"SELECT {sm} AS value, count(*) AS n FROM bouts GROUP BY 1 ORDER BY n DESC, value LIMIT {C.STANCE_TOP_N}")
    s["category_vocab"] = with_ctes(
        f"""SELECT 'stance_matchup' AS column_name, {sm} AS category, count(*) AS n_rows FROM bouts GROUP BY 2
            UNION ALL SELECT 'WeightClass', "WeightClass", count(*) FROM bouts WHERE "WeightClass" IS NOT NULL GROUP BY 2
            UNION ALL SELECT 'BetterRank', "BetterRank", count(*) FROM bouts WHERE "BetterRank" IS NOT NULL GROUP BY 2""")
    s["stance_onehot"] = feat_sql("SELECT bout_id, " + ", ".join(q(c) for c in STANCE_COLS) + " FROM feat")
    s["weightclass_onehot"] = feat_sql("SELECT bout_id, " + ", ".join(q(c) for c in WC_COLS) + " FROM feat")
    s["betterrank_onehot"] = feat_sql("SELECT bout_id, " + ", ".join(q(c) for c in BR_COLS) + " FROM feat")
    s["feature_matrix"] = feat_sql('SELECT * REPLACE (CAST("Date" AS VARCHAR) AS "Date") FROM feat')
    s["feature_checks"] = _feature_checks()
    s["feature_groups"] = _feature_groups()
    s["feature_nulls"] = _feature_nulls()
    sample = [c for c in C.KEY_FEATURE_SAMPLE if c in FEATURE_TABLE]
    s["feature_sample"] = feat_sql('SELECT bout_id, CAST("Date" AS VARCHAR) AS "Date", ' +
                                   ", ".join(q(c) for c in sample) +
                                   f' FROM feat ORDER BY "Date", bout_id LIMIT {C.SAMPLE_ROWS}')
    s["class_balance"] = feat_sql(
        f"""SELECT count(*) AS n_rows, CAST(sum(target) AS BIGINT) AS red_wins,
                   CAST(sum(1 - target) AS BIGINT) AS blue_wins,
                   {rnd('avg(CAST(target AS DOUBLE))')} AS red_rate,
                   {rnd('1.0 - avg(CAST(target AS DOUBLE))')} AS blue_rate FROM feat""")
    s["class_histogram"] = _histogram()
    corr_cols = [c for c in C.CORRELATION_COLUMNS if c in FEATURE_TABLE]
    pairs = [(corr_cols[i], corr_cols[j]) for i in range(len(corr_cols)) for j in range(i)]
    s["corr_matrix"] = feat_sql(" UNION ALL ".join(
        f"SELECT {lit(a)} AS row_feature, {lit(b)} AS col_feature, {_pair_corr(a, b, 'feat')} AS corr"
        for a, b in pairs))
    s["target_corr"] = feat_sql(" UNION ALL ".join(
        f"SELECT {lit(c)} AS feature, corr, CASE WHEN corr > 0 THEN '(+)' ELSE '(-)' END AS direction "
        f"FROM (SELECT {_pair_corr(c, 'target', 'feat')} AS corr)"
        for c in corr_cols if c != "target"))
    s["date_quality"] = feat_sql(
        'SELECT count(*) AS n_rows, CAST(count_if("Date" IS NULL) AS BIGINT) AS invalid_dates, count("Date") AS valid_dates, '
        'CAST(min("Date") AS VARCHAR) AS first_date, CAST(max("Date") AS VARCHAR) AS last_date FROM feat')
    s["time_split"] = split_sql('SELECT bout_id, CAST("Date" AS VARCHAR) AS "Date", target, split FROM split')
    s["split_summary"] = split_sql(
        f"""SELECT split, count(*) AS n_rows, CAST(min("Date") AS VARCHAR) AS start_date,
                   CAST(max("Date") AS VARCHAR) AS end_date,
                   CAST(min("Date") AS VARCHAR) || ' to ' || CAST(max("Date") AS VARCHAR) AS date_range,
                   {rnd('avg(CAST(target AS DOUBLE))')} AS red_win_rate
            FROM split GROUP BY split""")
    s["training_view"] = split_sql("SELECT * FROM tv")
    s["odds_only_view"] = split_sql("SELECT bout_id, split, target, odds_diff FROM tv")
    s["scaler_stats"] = _scaler_stats()
    s["standardized_features"] = _standardized()
    s["class_weights"] = split_sql(
        f"""SELECT target AS class, count(*) AS n_class,
                   {rnd('CAST((SELECT count(*) FROM train) AS DOUBLE) / ((SELECT count(DISTINCT target) FROM train) * count(*))')} AS weight
            FROM train GROUP BY target""")
    s["majority_baseline"] = split_sql(
        f"""SELECT 'Majority Class' AS model,
                   CASE WHEN m.majority_class = 1 THEN 'Red' ELSE 'Blue' END AS majority_label,
                   m.majority_class,
                   {rnd('avg(CAST(t.target = m.majority_class AS DOUBLE))')} AS accuracy
            FROM test t CROSS JOIN (SELECT target AS majority_class FROM train GROUP BY target
                                    ORDER BY count(*) DESC, target LIMIT 1) m
            GROUP BY m.majority_class""")
    s["eval_accuracy"] = split_sql(
        f"SELECT count(*) AS n_rows, {rnd('avg(CAST(prediction = target AS DOUBLE))')} AS accuracy FROM rule")
    s["eval_roc_auc"] = split_sql(AUC_BODY)
    s["confusion_matrix"] = split_sql(
        """SELECT a.actual, p.predicted, count(r.bout_id) AS n
           FROM (VALUES (0), (1)) a(actual) CROSS JOIN (VALUES (0), (1)) p(predicted)
           LEFT JOIN rule r ON r.target = a.actual AND r.prediction = p.predicted
           GROUP BY a.actual, p.predicted""")
    s["classification_report"] = _report()
    s["lenient_dates"] = with_ctes(
        """SELECT bout_id, CASE WHEN bout_id % 6 <> 5 THEN CAST("Date" AS VARCHAR) END AS parsed FROM bouts""")
    s["text_date_quality"] = with_ctes(
        """SELECT count(*) AS n_rows, CAST(count_if(d IS NULL) AS BIGINT) AS invalid_dates, count(d) AS valid_dates,
                  CAST(min(d) AS VARCHAR) AS first_date, CAST(max(d) AS VARCHAR) AS last_date
           FROM (SELECT CASE WHEN bout_id % 6 <> 5 THEN "Date" END AS d FROM bouts)""")
    s["missing_summary"] = with_ctes(
        "SELECT CAST(sum(CAST(missing > 0 AS INTEGER)) AS BIGINT) AS columns_with_missing, count(*) AS n_columns FROM ("
        + " UNION ALL ".join(f"SELECT count_if({q(c)} IS NULL) AS missing FROM bouts" for c in RAW_COLUMNS) + ")")
    s["vocab_unbounded"] = with_ctes(
        """SELECT bout_id, CAST(dense_rank() OVER (ORDER BY "RedFighter") - 1 AS BIGINT) AS position
           FROM bouts WHERE "RedFighter" IS NOT NULL""")
    s["top_competitors"] = with_ctes(
        """SELECT "RedFighter" AS value, count(*) AS n FROM bouts WHERE "RedFighter" IS NOT NULL
           GROUP BY 1 ORDER BY n DESC, value LIMIT 10""")
    s["split_text_key"] = with_ctes(
        """SELECT bout_id, text_key, CASE WHEN row_number() OVER (ORDER BY "Date", text_key NULLS FIRST, bout_id)
                                               <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split
           FROM (SELECT bout_id, "Date", CASE WHEN bout_id % 5 <> 0 THEN "RedFighter" END AS text_key
                 FROM bouts WHERE "Date" IS NOT NULL)""")
    majority = """maj AS (SELECT avg(CAST(t.target = m.majority_class AS DOUBLE)) AS accuracy
                          FROM test t CROSS JOIN (SELECT target AS majority_class FROM train GROUP BY target
                                                  ORDER BY count(*) DESC, target LIMIT 1) m)"""
    auc = f"auc AS ({AUC_BODY})"
    acc = "acc AS (SELECT avg(CAST(prediction = target AS DOUBLE)) AS accuracy FROM rule)"
    s["rule_comparison"] = split_sql(
        f"""SELECT {rnd('acc.accuracy')} AS model_accuracy, roc_auc AS model_roc_auc,
                   {rnd('maj.accuracy')} AS majority_accuracy, roc_auc AS odds_roc_auc,
                   CAST(acc.accuracy > maj.accuracy AS INTEGER) AS beat_majority_baseline, 0 AS beat_odds_baseline
            FROM acc, auc, maj""", majority, auc, acc)
    s["rule_summary"] = split_sql(
        f"""SELECT 'Majority Class' AS model, {rnd('accuracy')} AS accuracy, CAST(NULL AS DOUBLE) AS roc_auc,
                   CAST(NULL AS INTEGER) AS auc_milestone FROM maj
            UNION ALL SELECT 'Odds Rule', {rnd('accuracy')}, roc_auc,
                   CAST(roc_auc > {C.ROC_AUC_MILESTONE} AS INTEGER) FROM acc, auc""", majority, auc, acc)
    s["rule_status"] = split_sql(
        f"""SELECT 'beats the majority class on accuracy' AS check_name,
                   CAST(acc.accuracy > maj.accuracy AS INTEGER) AS reached FROM acc, maj
            UNION ALL SELECT 'beats the odds alone on ROC-AUC', 0
            UNION ALL SELECT 'ROC-AUC above {C.ROC_AUC_MILESTONE}',
                             CAST(roc_auc > {C.ROC_AUC_MILESTONE} AS INTEGER) FROM auc""", majority, auc, acc)
    margin = "0.0 + " + " + ".join(f"{c} * CAST({w!r} AS DOUBLE)" for c, w in DECLARED.items())
    declared = f"""declared AS (SELECT bout_id, target, margin, CAST(margin > 0 AS INTEGER) AS prediction
                                FROM (SELECT bout_id, target, {margin} AS margin FROM test))"""
    s["declared_scores"] = split_sql(
        f"SELECT bout_id, target, prediction, {rnd('1.0::DOUBLE / (1.0::DOUBLE + exp(-margin))')} AS score FROM declared",
        declared)
    s["declared_coefficients"] = split_sql(
        "SELECT feature, coefficient, abs(coefficient) AS abs_coefficient FROM (VALUES "
        + ", ".join(f"({lit(c)}, CAST({w!r} AS DOUBLE))" for c, w in DECLARED.items())
        + ") v(feature, coefficient) WHERE EXISTS (SELECT 1 FROM test) ORDER BY abs_coefficient DESC, feature LIMIT 3")
    s["odds_baseline"] = _odds_baseline()
    s["declared_report"] = _report("declared", declared)
    return s


SQL = build()
