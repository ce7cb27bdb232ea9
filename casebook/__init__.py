"""casebook: incident-warehouse operators written as Spark DataFrame jobs."""
