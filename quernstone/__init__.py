"""quernstone: a Spark-first analytics engine. Each module declares DataFrame plans and leaves execution to Spark."""
