"""Fleet-maintenance analytics as plain PySpark DataFrame functions."""
