"""Sales and billing analytics as reusable PySpark DataFrame operators."""
