"""DuckDB SQL that states, independently of the Spark code, what each
registered query must return.  The ``bouts`` CTE is the fixture definition
(see ``duelframe.sources.fixtures``); later CTEs mirror the pipeline stages.
"""

from __future__ import annotations

EXISTING = ["LoseStreakDif", "WinStreakDif", "LongestWinStreakDif", "WinDif", "LossDif", "TotalRoundDif",
            "TotalTitleBoutDif", "KODif", "SubDif", "HeightDif", "ReachDif", "AgeDif", "SigStrDif", "AvgSubAttDif",
            "AvgTDDif"]
# output name -> (red column, blue column), for the pairs counted from the key
COUNTED_PAIRS = {
    "ev_diff": ("RedExpectedValue", "BlueExpectedValue"), "dec_odds_diff": ("RedDecOdds", "BlueDecOdds"),
    "sub_odds_diff": ("RSubOdds", "BSubOdds"), "ko_odds_diff": ("RKOOdds", "BKOOdds"),
    "dec_maj_wins_diff": ("RedWinsByDecisionMajority", "BlueWinsByDecisionMajority"),
    "dec_unan_wins_diff": ("RedWinsByDecisionUnanimous", "BlueWinsByDecisionUnanimous"),
    "tko_doc_wins_diff": ("RedWinsByTKODoctorStoppage", "BlueWinsByTKODoctorStoppage"),
}
DOUBLES = {"HeightDif", "ReachDif", "SigStrDif"} | {c for k in list(COUNTED_PAIRS)[:4] for c in COUNTED_PAIRS[k]}
COUNTED = EXISTING + [c for pair in COUNTED_PAIRS.values() for c in pair]
# the thirteen further rank pairs: output name -> name of the division in both columns
DIVISIONS = {"pfp": "PFP", "hw": "Heavyweight", "lhw": "LightHeavyweight", "mw": "Middleweight", "ww": "Welterweight",
             "lw": "Lightweight", "fw": "Featherweight", "bw": "Bantamweight", "flw": "Flyweight",
             "w_sw": "WStrawweight", "w_flw": "WFlyweight", "w_bw": "WBantamweight", "w_fw": "WFeatherweight"}
RANK_PAIRS = {"wc_rank_diff": ("RMatchWCRank", "BMatchWCRank")} | {
    f"{k}_rank_diff": (f"R{v}Rank", f"B{v}Rank") for k, v in DIVISIONS.items()}
RANKED = [c for k, pair in RANK_PAIRS.items() if k != "wc_rank_diff" for c in pair]

_KEY_COLUMNS = "".join(
    f"""         CASE WHEN o.o_orderkey % {31 + i} <> 0 THEN {{}} END AS "{c}",\n""".format(
        f"CAST(o.o_orderkey * {2 * i + 7} % {41 + i} - 20 + {i % 3} AS DOUBLE) / 4" if c in DOUBLES
        else f"o.o_orderkey * {2 * i + 7} % {41 + i} - 20 + {i % 3}")
    for i, c in enumerate(COUNTED)) + "".join(
    f"""         CAST(CASE WHEN (o.o_orderkey * 3 + {j}) % 7 < 2 THEN (o.o_orderkey + {j}) % 15 + 1 END AS INTEGER) AS "{c}",\n"""
    for j, c in enumerate(RANKED))

BOUTS_CTES = """
li AS (
  SELECT l_orderkey,
         min(l_suppkey) AS suppkey, min(l_partkey) AS partkey,
         CAST(count(*) AS BIGINT) AS n_lines,
         CAST(count_if(l_returnflag = 'R') AS BIGINT) AS n_r,
         CAST(count_if(l_returnflag = 'A') AS BIGINT) AS n_a,
         CAST(count_if(l_linestatus = 'O') AS BIGINT) AS n_o,
         CAST(count_if(l_linestatus = 'F') AS BIGINT) AS n_f,
         max(CASE WHEN l_returnflag = 'R' THEN l_discount END) AS disc_r,
         max(CASE WHEN l_returnflag = 'A' THEN l_discount END) AS disc_a,
         max(CASE WHEN l_linestatus = 'O' THEN l_tax END) AS tax_o,
         max(CASE WHEN l_linestatus = 'F' THEN l_tax END) AS tax_f
  FROM lineitem GROUP BY l_orderkey),
cr AS (
  SELECT c_custkey, c_name, c_acctbal, c_mktsegment,
         row_number() OVER (PARTITION BY c_mktsegment
                            ORDER BY c_acctbal DESC, c_custkey) AS seg_rank
  FROM customer),
sr AS (
  SELECT s_suppkey, s_name, s_acctbal, r_name,
         row_number() OVER (PARTITION BY r_name
                            ORDER BY s_acctbal DESC, s_suppkey) AS reg_rank
  FROM supplier
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
bouts AS (
  SELECT o.o_orderkey AS bout_id,
         CAST(o.o_orderdate AS DATE) AS "Date",
         cr.c_name AS "RedFighter",
         sr.s_name AS "BlueFighter",
         CASE WHEN o.o_orderkey % 101 = 0 THEN NULL
              WHEN o.o_orderkey % 97 = 0 THEN 'Draw'
              WHEN cr.c_acctbal - coalesce(sr.s_acctbal, 0)
                   + ((o.o_orderkey * 7919) % 1000) * 20 - 8400 > 0 THEN 'Red'
              ELSE 'Blue' END AS "Winner",
         cr.c_acctbal AS "RedOdds",
         sr.s_acctbal AS "BlueOdds",
         li.disc_r AS "RedAvgSigStrPct",
         li.disc_a AS "BlueAvgSigStrPct",
         li.tax_o AS "RedAvgTDPct",
         li.tax_f AS "BlueAvgTDPct",
         li.n_r AS "RedWinsByDecisionSplit",
         li.n_a AS "BlueWinsByDecisionSplit",
         li.n_o AS "RedDraws",
         li.n_f AS "BlueDraws",
         CAST(CASE WHEN cr.seg_rank <= 15 THEN cr.seg_rank END AS INTEGER) AS "RMatchWCRank",
         CAST(CASE WHEN sr.reg_rank <= 5 THEN sr.reg_rank END AS INTEGER) AS "BMatchWCRank",
         CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE cr.c_mktsegment END AS "RedStance",
         sr.r_name AS "BlueStance",
         CASE WHEN p.p_type = 'ECONOMY' THEN 'Women''s Economy' WHEN p.p_type = 'LARGE' THEN 'St. Large'
              WHEN p.p_type = 'MEDIUM' AND o.o_orderkey % 2 = 0 THEN 'medium'
              WHEN p.p_type = 'MEDIUM' THEN 'Medium' ELSE p.p_type END AS "WeightClass",
         CASE WHEN cr.c_custkey % 4 = 0 THEN 'FEMALE' ELSE 'MALE' END AS "Gender",
         CASE WHEN cr.seg_rank <= 15 AND (sr.reg_rank IS NULL OR sr.reg_rank > 5) THEN 'Red'
              WHEN sr.reg_rank <= 5 AND cr.seg_rank > 15 THEN 'Blue'
              WHEN cr.seg_rank <= 15 THEN 'neither' END AS "BetterRank",
         o.o_orderpriority = '1-URGENT' AS "TitleBout",
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 5 ELSE 3 END AS "NumberOfRounds",
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL
              WHEN year(o.o_orderdate) = 1998 THEN 1 ELSE 0 END AS "EmptyArena",
""" + _KEY_COLUMNS + """         o.o_orderstatus AS "Finish",
         CASE WHEN o.o_orderkey % 3 = 0 THEN 'Punch' END AS "FinishDetails",
         li.n_lines AS "FinishRound",
         CASE WHEN o.o_orderkey % 4 <> 0 THEN (o.o_orderkey % 5) || ':00' END AS "FinishRoundTime",
         CASE WHEN o.o_orderkey % 9 <> 0 THEN CAST(o.o_orderkey % 1500 AS DOUBLE) END AS "TotalFightTimeSecs"
  FROM orders o
  JOIN cr ON o.o_custkey = cr.c_custkey
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey
  LEFT JOIN sr ON li.suppkey = sr.s_suppkey
  LEFT JOIN part p ON li.partkey = p.p_partkey)
"""


def with_ctes(body: str, *extra_ctes: str) -> str:
    ctes = [BOUTS_CTES.strip()] + [c.strip() for c in extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()


# --- fixture vocabularies and schema (what the SQL side states) -------------
# FIXED VALUES: value sets of the TPC-H-style columns behind the fixture.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
WEIGHT_CLASSES = ["Medium", "PROMO", "SMALL", "STANDARD", "St. Large", "Women's Economy", "medium"]
BETTER_RANKS = ["Blue", "Red", "neither"]

STANCES = sorted(f"{r}_vs_{b}" for r in SEGMENTS + ["Unknown"] for b in REGIONS + ["Unknown"])

RAW_TYPES = {
    "bout_id": "bigint", "Date": "date", "RedFighter": "string", "BlueFighter": "string",
    "Winner": "string", "RedOdds": "double", "BlueOdds": "double",
    "RedAvgSigStrPct": "double", "BlueAvgSigStrPct": "double",
    "RedAvgTDPct": "double", "BlueAvgTDPct": "double",
    "RedWinsByDecisionSplit": "bigint", "BlueWinsByDecisionSplit": "bigint",
    "RedDraws": "bigint", "BlueDraws": "bigint",
    "RMatchWCRank": "int", "BMatchWCRank": "int",
    "RedStance": "string", "BlueStance": "string", "WeightClass": "string",
    "Gender": "string", "BetterRank": "string", "TitleBout": "boolean",
    "NumberOfRounds": "int", "EmptyArena": "int",
    **{c: "double" if c in DOUBLES else "bigint" for c in COUNTED}, **{c: "int" for c in RANKED},
    "Finish": "string", "FinishDetails": "string", "FinishRound": "bigint", "FinishRoundTime": "string",
    "TotalFightTimeSecs": "double",
}
RAW_COLUMNS = list(RAW_TYPES)
LEAKAGE = ["Finish", "FinishDetails", "FinishRound", "FinishRoundTime", "TotalFightTimeSecs"]
CLEAN_COLUMNS = [c for c in RAW_COLUMNS if c not in LEAKAGE]

PAIRS = {"sig_str_pct_diff": ("RedAvgSigStrPct", "BlueAvgSigStrPct"), "td_pct_diff": ("RedAvgTDPct", "BlueAvgTDPct"),
         "odds_diff": ("RedOdds", "BlueOdds"), **COUNTED_PAIRS,
         "dec_split_wins_diff": ("RedWinsByDecisionSplit", "BlueWinsByDecisionSplit"),
         "draws_diff": ("RedDraws", "BlueDraws")}
PAIRED = list(PAIRS)
ZERO_FILLED = ["sig_str_pct_diff", "td_pct_diff", "odds_diff", "ev_diff", "dec_odds_diff", "sub_odds_diff", "ko_odds_diff"]
RANKS = list(RANK_PAIRS)
CONTEXT = ["TitleBout", "NumberOfRounds", "EmptyArena"]
STANCE_COLS = [f"stance_{s}" for s in STANCES]
# names of encoded columns: a dot becomes an underscore, the second spelling gets its place
WC_COLS = ["wc_Medium", "wc_PROMO", "wc_SMALL", "wc_STANDARD", "wc_St_ Large", "wc_Women's Economy", "wc_medium__6"]
BR_COLS = [f"better_rank_{v}" for v in BETTER_RANKS]
FEATURES = EXISTING + PAIRED + RANKS + CONTEXT + STANCE_COLS + WC_COLS + BR_COLS + ["is_male"]
FEATURE_TABLE = FEATURES + ["target", "RedFighter", "BlueFighter", "Date", "bout_id", "stance_matchup"]


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _onehots(expr: str, names: list[str], values: list[str]) -> list[str]:
    return [f"CASE WHEN {expr} = {lit(v)} THEN 1 ELSE 0 END AS {q(n)}" for n, v in zip(names, values)]


def diff(name: str) -> str:
    red, blue = PAIRS[name]
    return f"{q(red)} - {q(blue)}"


def filled_diff(name: str) -> str:
    return f"coalesce({diff(name)}, 0)" if name in ZERO_FILLED else diff(name)


def rank_diff(name: str) -> str:
    red, blue = RANK_PAIRS[name]
    return f"coalesce({q(red)}, 99) - coalesce({q(blue)}, 99)"


CLEAN_CTE = "clean AS (SELECT * EXCLUDE (" + ", ".join(q(c) for c in LEAKAGE) + ") FROM bouts)"

FEAT_CTE = "feat AS (SELECT " + ",\n  ".join(
    [
        *[q(c) for c in EXISTING],
        *[f"{filled_diff(c)} AS {c}" for c in PAIRED],
        *[f"{rank_diff(c)} AS {c}" for c in RANKS],
        'CAST("TitleBout" AS INTEGER) AS "TitleBout"',
        '"NumberOfRounds"',
        'coalesce("EmptyArena", 0) AS "EmptyArena"',
    ]
    + _onehots("sm", STANCE_COLS, STANCES)
    + _onehots('"WeightClass"', WC_COLS, WEIGHT_CLASSES)
    + _onehots('"BetterRank"', BR_COLS, BETTER_RANKS)
    + [
        "CASE WHEN \"Gender\" = 'MALE' THEN 1 ELSE 0 END AS is_male",
        "CASE WHEN \"Winner\" = 'Red' THEN 1 ELSE 0 END AS target",
        '"RedFighter"', '"BlueFighter"', '"Date"', "bout_id", "sm AS stance_matchup",
    ]) + """
  FROM (SELECT *, coalesce("RedStance", 'Unknown') || '_vs_' || coalesce("BlueStance", 'Unknown') AS sm
        FROM clean))"""

SPLIT_CTES = [
    """ordered AS (SELECT *, row_number() OVER (ORDER BY "Date", bout_id) AS pos,
                       count(*) OVER () AS n_all
                FROM feat WHERE "Date" IS NOT NULL)""",
    """split AS (SELECT * EXCLUDE (pos, n_all),
                     CASE WHEN pos <= floor(n_all * 0.8) THEN 'train' ELSE 'test' END AS split
              FROM ordered)""",
    "tv AS (SELECT bout_id, split, target, " + ", ".join(
        f"CAST(coalesce({q(c)}, 0) AS DOUBLE) AS {q(c)}" for c in FEATURES) + " FROM split)",
    "train AS (SELECT * FROM tv WHERE split = 'train')",
    "test AS (SELECT * FROM tv WHERE split = 'test')",
    """rule AS (SELECT bout_id, target, odds_diff AS score,
                    CAST(odds_diff > 0 AS INTEGER) AS prediction FROM test)""",
]


def feat_sql(body: str, *more: str) -> str:
    return with_ctes(body, CLEAN_CTE, FEAT_CTE, *more)


def split_sql(body: str, *more: str) -> str:
    return with_ctes(body, CLEAN_CTE, FEAT_CTE, *SPLIT_CTES, *more)
