"""tidemark: retail lakehouse operators for PySpark (landing, bronze, silver, gold)."""
