"""pagemill: Spark jobs over tables and streams of fetched web pages."""
