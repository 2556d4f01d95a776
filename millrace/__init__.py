"""Manufacturing logistics and machine health analytics on Spark."""
