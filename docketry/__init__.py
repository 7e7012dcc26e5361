"""Document-publication analytics on Spark: text repair, rule classification, field extraction,
canonical selection, layered publication, marts and run-log sessions, all as DataFrame code."""
