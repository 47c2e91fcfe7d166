"""Table movement on Spark: scans, audits, keyed operators, incremental exports and reshaping."""
