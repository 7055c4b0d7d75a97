"""Daily station observations on Spark: layers, rules, quality gate, lookups."""
