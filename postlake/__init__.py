"""postlake: job-posting analytics as Spark DataFrame transforms."""
