"""Compositions of operators: silver, gold, KPI measures, alert rules."""
