"""Restaurant order analytics on Spark: layers, metrics and reports as DataFrame functions."""
