"""Raw job postings to a star schema and market reports, as Spark DataFrame operators."""
