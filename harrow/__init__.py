"""harrow: contact-table building and web-text analytics as PySpark DataFrame jobs."""
