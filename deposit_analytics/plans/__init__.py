"""Whole jobs: one lazy DataFrame per report, over all snapshot dates."""
