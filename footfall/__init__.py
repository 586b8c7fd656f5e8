"""Web-event behaviour analytics as DataFrame-to-DataFrame functions on PySpark."""
