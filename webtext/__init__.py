"""Web pages to clean, traceable text on Spark."""
