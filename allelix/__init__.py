"""allelix: gene-variant-phenotype evidence integration and training-data preparation on Spark."""
