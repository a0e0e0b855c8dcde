"""cuewright: a Spark-first engine for timed, bilingual text."""
