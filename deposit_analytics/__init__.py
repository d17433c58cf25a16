"""Deposit reports on Spark: wealth by product group, tenure, lookback sums."""
