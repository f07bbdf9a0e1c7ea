"""postlake: crawl records to a monthly post index, as PySpark jobs."""
