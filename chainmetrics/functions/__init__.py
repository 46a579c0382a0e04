"""chainmetrics.functions"""
