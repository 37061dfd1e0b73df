"""txnrisk: card-transaction risk analytics as Spark DataFrame plans.

Sub-packages
------------
sources    table loading, the transactions view, JSON request batches, persistence
functions  column expressions (calendar flags, time offsets, safe ratios)
operators  DataFrame operators (rolling windows, splits, labelling, ranking, metrics)
plans      composite jobs (feature table, leaderboard, reports, batch scoring)
ml         Spark ML pipelines, custom estimators and tuning loops
streaming  Structured Streaming scoring
"""

__version__ = "0.1.0"
