"""Column names, feature lists and the fixed values the workload is defined by."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference workload for identical results)
# ---------------------------------------------------------------------------
# Window sizes in days for customer and terminal features: 1, 7, 30
WINDOWS_DAYS = (1, 7, 30)
# Label delay in days used by the terminal risk features and the splits: 7
DELAY_DAYS = 7
# Rule 1: a transaction amount strictly above 220 is fraud
AMOUNT_RULE_THRESHOLD = 220
# Rule 2: 2 terminals compromised per day for 28 days
TERMINALS_PER_DAY = 2
TERMINAL_COMPROMISE_DAYS = 28
# Rule 3: 3 customers compromised per day for 14 days; a third of their
# transactions in that period get the amount multiplied by 5
CUSTOMERS_PER_DAY = 3
CUSTOMER_COMPROMISE_DAYS = 14
CUSTOMER_AMOUNT_FACTOR = 5
# Weekend: weekday >= 5 with Monday = 0.  Night: hour <= 6 or hour >= 22.
WEEKEND_FIRST_WEEKDAY = 5
NIGHT_LAST_MORNING_HOUR = 6
NIGHT_FIRST_EVENING_HOUR = 22
# Probability threshold for hard predictions (strictly greater)
DECISION_THRESHOLD = 0.5
# Precision top-k default
TOP_K = 100
# ---------------------------------------------------------------------------

DAY_US = 86_400_000_000  # microseconds per day

TX_ID = "TRANSACTION_ID"
TX_DATETIME = "TX_DATETIME"
TX_US = "TX_US"
CUSTOMER_ID = "CUSTOMER_ID"
TERMINAL_ID = "TERMINAL_ID"
TX_AMOUNT = "TX_AMOUNT"
TX_TIME_SECONDS = "TX_TIME_SECONDS"
TX_TIME_DAYS = "TX_TIME_DAYS"
TX_FRAUD = "TX_FRAUD"
TX_FRAUD_SCENARIO = "TX_FRAUD_SCENARIO"
WEEKEND = "TX_DURING_WEEKEND"
NIGHT = "TX_DURING_NIGHT"


def customer_feature_names(windows=WINDOWS_DAYS, key=CUSTOMER_ID) -> list[str]:
    out = []
    for n in windows:
        out += [f"{key}_NB_TX_{n}DAY_WINDOW", f"{key}_AVG_AMOUNT_{n}DAY_WINDOW"]
    return out


def terminal_feature_names(windows=WINDOWS_DAYS, key=TERMINAL_ID) -> list[str]:
    out = []
    for n in windows:
        out += [f"{key}_NB_TX_{n}DAY_WINDOW", f"{key}_RISK_{n}DAY_WINDOW"]
    return out


# The 15 model inputs, in the reference order.
INPUT_FEATURES = ([TX_AMOUNT, WEEKEND, NIGHT]
                  + customer_feature_names() + terminal_feature_names())

BASE_COLUMNS = [TX_ID, TX_DATETIME, TX_US, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT,
                TX_TIME_SECONDS, TX_TIME_DAYS, TX_FRAUD]
