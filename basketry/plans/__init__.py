"""Logical plans: raw layer, mart, features, and the job that runs them in order."""
