"""Consumer credit-risk analytics as plain PySpark DataFrame code."""
