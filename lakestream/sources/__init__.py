"""Reading the log and the zones of the lake."""
