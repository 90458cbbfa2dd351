"""corpusmill: text corpora and tuning data sets as Spark DataFrame jobs."""
