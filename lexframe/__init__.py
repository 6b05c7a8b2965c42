"""lexframe: lexical dataset building, verification and upkeep as Spark DataFrame jobs."""
