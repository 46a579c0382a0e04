"""chainmetrics.streaming"""
