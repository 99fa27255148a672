"""dialoom: dialogue datasets as declarative Spark plans."""
