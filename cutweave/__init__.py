"""Temporal segmentation analytics on PySpark: recorded window results become ordered, labelled task segments."""
