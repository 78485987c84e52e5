"""Training-operations KPI engine on PySpark."""
