"""Relational operators shared by the jobs in ``fundlens.plans``."""
