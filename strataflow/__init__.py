"""strataflow: layered (raw, conformed, feature) analytics on PySpark."""
