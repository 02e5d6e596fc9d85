"""Monthly demand, skill, salary and trajectory marts over job postings, on Spark."""
