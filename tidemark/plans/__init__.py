"""The retail tables, built from the operators: silver, gold, marts, KPIs, gate, full run."""
