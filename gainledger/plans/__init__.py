"""Universes, flow rules, reconciliation, report and the batch run."""
