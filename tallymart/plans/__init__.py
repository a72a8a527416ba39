"""Whole plans: the batch run, the marts over gold and the dashboard tables."""
