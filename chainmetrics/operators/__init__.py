"""chainmetrics.operators"""
