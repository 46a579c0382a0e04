"""chainmetrics.sources"""
