"""End-to-end plans: the pipeline job and the warehouse queries read from."""
