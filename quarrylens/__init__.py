"""Source-composition analytics on PySpark."""
