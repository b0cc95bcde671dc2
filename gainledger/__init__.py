"""Gain-and-loss ledger of securities accounts, computed with Spark DataFrames."""
