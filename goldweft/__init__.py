"""Record consolidation on Spark: five message shapes in, one record per person out."""
