"""moodline: sentiment analytics over short messages, as Spark DataFrame jobs."""
