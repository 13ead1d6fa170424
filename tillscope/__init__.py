"""tillscope: payments analytics as lazy PySpark DataFrame functions."""
