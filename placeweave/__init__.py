"""Address and place knowledge-base operators as PySpark DataFrame functions."""
