"""Whole jobs and the registered workload."""
