"""moodloom: social-text sentiment analytics on Spark DataFrames."""
