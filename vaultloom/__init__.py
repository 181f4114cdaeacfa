"""A data-vault loader written with the PySpark DataFrame API."""
