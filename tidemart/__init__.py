"""Product- and commerce-analytics marts as Spark DataFrame jobs."""
