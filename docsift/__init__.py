"""docsift: labelled-document analytics written as Spark DataFrame jobs."""
