"""Oracle SQL fragments (DuckDB dialect) shared by several registered keys."""

DAY_US = 86_400_000_000

TX = """tx AS (
  SELECT event_id AS TRANSACTION_ID, ts AS TX_DATETIME, epoch_us(ts) AS TX_US,
         user_id AS CUSTOMER_ID,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS TERMINAL_ID,
         CAST(value AS DECIMAL(18,2)) AS TX_AMOUNT,
         CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000000) AS BIGINT) AS TX_TIME_SECONDS,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS TX_TIME_DAYS,
         CAST(CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END AS BIGINT) AS TX_FRAUD
  FROM events)"""


def customer_cols(key="CUSTOMER_ID", windows=(1, 7, 30)) -> str:
    out = []
    for n in windows:
        w = f"(PARTITION BY {key} ORDER BY TX_US RANGE BETWEEN {n * DAY_US - 1} PRECEDING AND CURRENT ROW)"
        out.append(f"count(TX_AMOUNT) OVER {w} AS {key}_NB_TX_{n}DAY_WINDOW")
        out.append(f"CAST(sum(TX_AMOUNT) OVER {w} AS DOUBLE) / CAST(count(TX_AMOUNT) OVER {w} AS DOUBLE)"
                   f" AS {key}_AVG_AMOUNT_{n}DAY_WINDOW")
    return ",\n  ".join(out)


def terminal_cols(key="TERMINAL_ID", delay=7, windows=(1, 7, 30)) -> str:
    out = []
    for n in windows:
        w = (f"(PARTITION BY {key} ORDER BY TX_US RANGE BETWEEN {(delay + n) * DAY_US - 1} PRECEDING"
             f" AND {delay * DAY_US} PRECEDING)")
        out.append(f"count(TX_FRAUD) OVER {w} AS {key}_NB_TX_{n}DAY_WINDOW")
        out.append(f"CASE WHEN count(TX_FRAUD) OVER {w} = 0 THEN 0.0 ELSE CAST(sum(TX_FRAUD) OVER {w} AS DOUBLE)"
                   f" / CAST(count(TX_FRAUD) OVER {w} AS DOUBLE) END AS {key}_RISK_{n}DAY_WINDOW")
    return ",\n  ".join(out)


FLAGS = """CAST(isodow(TX_DATETIME) >= 6 AS BIGINT) AS TX_DURING_WEEKEND,
  CAST(hour(TX_DATETIME) <= 6 OR hour(TX_DATETIME) >= 22 AS BIGINT) AS TX_DURING_NIGHT"""

FEAT = f"""feat AS (
  SELECT *, {terminal_cols()}
  FROM (SELECT *, {customer_cols()}
        FROM (SELECT *, {FLAGS} FROM tx WHERE CUSTOMER_ID IS NOT NULL) t0) t1
  WHERE TERMINAL_ID IS NOT NULL)"""


def split_ctes(start="2024-01-01", train=7, delay=7, test=7, src="tx") -> str:
    """train / s / test CTEs of the delayed split, written as the reference's
    day-by-day rule (EXISTS per test row) rather than the closed form."""
    return f"""trn AS (SELECT * FROM {src} WHERE TX_DATETIME >= TIMESTAMP '{start}'
                  AND TX_DATETIME < TIMESTAMP '{start}' + INTERVAL {train} DAY),
s AS (SELECT min(TX_TIME_DAYS) AS s FROM trn),
tst AS (SELECT x.* FROM {src} x, s
  WHERE x.TX_TIME_DAYS BETWEEN s.s + {train + delay} AND s.s + {train + delay + test - 1}
    AND NOT EXISTS (SELECT 1 FROM trn t WHERE t.TX_FRAUD = 1 AND t.CUSTOMER_ID = x.CUSTOMER_ID)
    AND NOT EXISTS (SELECT 1 FROM {src} f WHERE f.TX_FRAUD = 1 AND f.CUSTOMER_ID = x.CUSTOMER_ID
                    AND f.TX_TIME_DAYS BETWEEN s.s + {train - 1} AND x.TX_TIME_DAYS - {delay + 1}))"""


def fold_ctes(start="2024-01-08", n_folds=2, train=7, delay=7, val=7, src="tx") -> str:
    return f"""folds AS (SELECT i AS fold, TIMESTAMP '{start}' - to_days(CAST(i * {val} AS INTEGER)) AS st
          FROM range({n_folds}) r(i)),
ftrn AS (SELECT f.fold, x.* FROM folds f JOIN {src} x
         ON x.TX_DATETIME >= f.st AND x.TX_DATETIME < f.st + INTERVAL {train} DAY),
fs AS (SELECT fold, min(TX_TIME_DAYS) AS s FROM ftrn GROUP BY fold),
fval AS (SELECT fs.fold, x.* FROM fs JOIN {src} x
         ON x.TX_TIME_DAYS BETWEEN fs.s + {train + delay} AND fs.s + {train + delay + val - 1}
  WHERE NOT EXISTS (SELECT 1 FROM ftrn t WHERE t.fold = fs.fold AND t.TX_FRAUD = 1
                    AND t.CUSTOMER_ID = x.CUSTOMER_ID)
    AND NOT EXISTS (SELECT 1 FROM {src} f WHERE f.TX_FRAUD = 1 AND f.CUSTOMER_ID = x.CUSTOMER_ID
                    AND f.TX_TIME_DAYS BETWEEN fs.s + {train - 1} AND x.TX_TIME_DAYS - {delay + 1})),
cvf AS (SELECT fold, 'train' AS role, * EXCLUDE (fold) FROM ftrn
        UNION ALL SELECT fold, 'val' AS role, * EXCLUDE (fold) FROM fval)"""


def ranking_sql(scored: str, group: list[str] = (), score: str = "score", label: str = "TX_FRAUD",
                digits: int = 9) -> str:
    """AP and AUC from grouped scores and cumulative counts (descending score)."""
    gk = ", ".join(group)
    gsel = (gk + ", ") if group else ""
    part = f"PARTITION BY {gk}" if group else ""
    rnd = (lambda e: f"round({e}, {digits})") if digits is not None else (lambda e: e)
    ap = rnd("CASE WHEN sum(tp) > 0 THEN sum(CAST(tp AS DOUBLE) * ctp / ccnt) / sum(tp) END")
    auc = rnd("""CASE WHEN sum(tp) > 0 AND sum(cnt) > sum(tp) THEN
        sum(CAST(cnt - tp AS DOUBLE) * ((ctp - tp) + tp / 2.0)) / (CAST(sum(tp) AS DOUBLE) * (sum(cnt) - sum(tp))) END""")
    return f"""SELECT {gsel}CAST(sum(cnt) AS BIGINT) AS n, CAST(sum(tp) AS BIGINT) AS n_pos,
  {ap} AS average_precision,
  {auc} AS auc
FROM (SELECT {gsel}tp, cnt,
        sum(tp) OVER ({part} ORDER BY {score} DESC) AS ctp,
        sum(cnt) OVER ({part} ORDER BY {score} DESC) AS ccnt
      FROM (SELECT {gsel}{score}, sum({label}) AS tp, count(*) AS cnt FROM {scored}
            WHERE {score} IS NOT NULL GROUP BY {gsel}{score}) g) c
{"GROUP BY " + gk if group else ""}"""
