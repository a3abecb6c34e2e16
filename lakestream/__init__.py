"""Spark operators for keyed event logs and the lakes built from them."""
