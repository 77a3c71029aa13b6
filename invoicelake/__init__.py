"""Electronic fiscal invoices on Spark: XML files -> keyed JSON messages -> layered Parquet tables."""
